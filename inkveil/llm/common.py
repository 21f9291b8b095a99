"""What the operators share: written intermediate tables, free column names, word blocks."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: `[^\x20\x09-\x0D]`: what words are made of; in bytes, `split()` cuts at the others.
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_BYTES = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def shared_folder(spark: SparkSession) -> str:
    """A folder for this job's tables below `spark.checkpoint.dir`; Spark removes it when it ends.

    Where that setting is missing, a local master (as in tests) gets a folder of its own.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="inkveil-")
        spark.conf.set("spark.checkpoint.dir", root)
    folder = f"{root}/inkveil-{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read again from there.

    Files of a lost executor stay readable, the lineage is cut, and what depends on the
    layout of partitions (row numbers) is the same for every later reader.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def merged(left: DataFrame, right: DataFrame, *on, how: str = "inner") -> DataFrame:
    """A join of two tables that grow with the corpus, by sorted runs.

    Spark takes a table behind an explode for no larger than its input, and a written one for
    its compressed size, and would send either to the driver and to all workers.
    """
    return left.join(right.hint("merge"), *on, how=how)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that `df` has not, whatever the case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bucket(doc_id: str, folds: int) -> Column:
    """crc32 of the number as text, modulo `folds`; null ids get no fold."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


_RESIDENT: dict[str, Any] = {}


def resident(key: str, make: Callable[[], Any]) -> Any:
    """What a worker keeps between tasks: one model at a time, whichever operator's it is.

    Workers outlive a stage, so a model of the stage before would take memory of the next.
    """
    if key not in _RESIDENT:
        _RESIDENT.clear()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def word_blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, a block of bytes at a time; no word is cut."""
    begin = 0
    while begin < len(data):
        end = begin + size
        if end < len(data):
            gap = _GAP.search(data, end)
            end = gap.start() if gap else len(data)
        yield data[begin:end].split()
        begin = end


def raw(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes | None]:
    """Texts as UTF-8, some hundred at a time."""
    plain = column.cast(pa.binary()) if not pa.types.is_large_string(column.type) else column.cast(
        pa.large_binary()
    )
    for begin in range(0, len(plain), 256):
        yield from plain.slice(begin, 256).to_pylist()
