"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches of ascending ids. The hashes of all lines seen so far lie in runs:
tables sorted by hash, of which no two hold the same hash. A new batch is merged against the
runs; its unseen hashes become a run of level 0. As soon as a level holds FANOUT runs they
are merged into one run of the next level, so a batch meets few runs however many came before.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkveil.llm.common import free_name, shared_folder, staged

STRIPPED = " \t\n\x0b\f\r"
LEAST = 10
BATCHES = 6
FANOUT = 3
#: Rows without an id come after all others.
LAST = (1 << 63) - 1


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.btrim(line, F.lit(STRIPPED)), upper, upper.lower())


class LineRuns:
    """The runs below a folder. `add` takes keys (line hash, place) of one more batch."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT) -> None:
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.levels: list[list[str]] = []

    def read(self, *paths: str) -> DataFrame:
        return self.spark.read.schema("hash binary, first long").parquet(*paths)

    def seen(self) -> DataFrame | None:
        """(hash, first): all hashes so far with the place of the first line."""
        paths = [path for level in self.levels for path in level]
        return self.read(*paths) if paths else None

    def _write(self, rows: DataFrame, level: int) -> None:
        path = f"{self.folder}/run-{level}-{uuid.uuid4().hex}"
        rows.repartition("hash").sortWithinPartitions("hash").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def add(self, keys: DataFrame) -> None:
        """Add the hashes of a batch that no run has; places must not be less than those before."""
        fresh = keys.groupBy("hash").agg(F.min("place").alias("first"))
        before = self.seen()
        if before is not None:
            fresh = fresh.join(before.select("hash"), "hash", "left_anti")
        self._write(fresh, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            self._write(self.read(*merged), level + 1)
            level += 1


def _bounds(keys: DataFrame, batches: int) -> list[int]:
    """Places that part the rows into batches of like size."""
    shares = [k / batches for k in range(1, batches)]
    found = keys.agg(F.percentile_approx("place", shares, 1000)).first()[0] or []
    return sorted(set(found))


def dropped_lines(
    docs: DataFrame, doc_id: str, text: str, least: int, batches: int, fanout: int
) -> DataFrame:
    """(place, print, dropped): positions of the lines to drop, sorted, where there are any.

    `print` tells rows of equal ids apart: rows equal in both lose the same lines.
    """
    spark = docs.sparkSession
    lines = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("place"),
        F.xxhash64(text).alias("print"),
        F.posexplode(split_lines(F.col(text))).alias("at", "line"),
    )
    keys = staged(
        lines.withColumn("key", line_key(F.col("line")))
        .filter(F.char_length("key") >= least)
        .select("place", "print", "at", F.unhex(F.md5("key")).alias("hash")),
        "lines",
    )
    runs = LineRuns(spark, f"{shared_folder(spark)}/runs-{uuid.uuid4().hex}", fanout)
    bounds = _bounds(keys, batches)
    for low, high in zip([None, *bounds], [*bounds, None], strict=True):
        batch = keys if low is None else keys.filter(F.col("place") > low)
        runs.add(batch if high is None else batch.filter(F.col("place") <= high))
    return (
        keys.join(runs.seen(), "hash")
        .filter("place > first")
        .groupBy("place", "print")
        .agg(F.sort_array(F.collect_set("at")).alias("dropped"))
    )


def without(lines: Column, dropped: Column) -> Column:
    """The lines but those at the (sorted) positions, in time linear in the lines."""
    stretches = F.transform(
        F.sequence(F.lit(0), F.size(dropped)),
        lambda k: F.slice(
            lines,
            F.coalesce(F.get(dropped, k - 1) + 2, F.lit(1)),
            F.coalesce(F.get(dropped, k), F.size(lines))
            - F.coalesce(F.get(dropped, k - 1) + 1, F.lit(0)),
        ),
    )
    return F.flatten(stretches)


def drop_repeated_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    n_lines: str = "n_lines",
    n_dropped: str = "n_dropped",
    least: int = LEAST,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """`docs` without lines of an earlier document, and the numbers of lines before and dropped.

    A line's key is stripped of white space and lower-cased (A-Z). Lines whose key has `least`
    code points or more stay only in the smallest id that holds the key, there all of them.
    Null and empty texts are one empty line and become "". Rows of equal ids never take lines
    from each other; rows without an id come last and are one document. Other columns stay,
    but the two numbers replace columns of their names. Empty tables are fine.
    """
    gone = dropped_lines(docs, doc_id, text, least, batches, fanout)
    place, mark, cut = (free_name(docs, c) for c in ("place", "print", "dropped"))
    gone = gone.select(
        F.col("place").alias(place), F.col("print").alias(mark), F.col("dropped").alias(cut)
    )
    keyed = docs.withColumns(
        {place: F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)), mark: F.xxhash64(text)}
    )
    joined = keyed.join(gone, [place, mark], "left")
    lines = split_lines(F.col(text))
    kept = F.when(F.col(cut).isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(
        F.array_join(without(lines, F.col(cut)), "\n")
    )
    others = [c for c in docs.columns if c.lower() not in (n_lines.lower(), n_dropped.lower())]
    return joined.select(
        *[kept.alias(c) if c == text else F.col(c) for c in others],
        F.size(lines).cast("long").alias(n_lines),
        F.coalesce(F.size(cut), F.lit(0)).cast("long").alias(n_dropped),
    )


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 for each row."""
    return drop_repeated_lines(docs.select("doc_id", "text")).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )
