"""Redacted packages (O8): new texts put into the nodes they came from."""

from __future__ import annotations

import io
import json
import os
import uuid
import xml.parsers.expat
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from xml.sax.saxutils import escape

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from inkveil.session import staged
from inkveil.sources.packages import local_name

RESULT_SUFFIX = "-result.docx"
_SCHEMA = "doc_id string, path string, content binary"


def splice(data: bytes, texts: dict[int, str]) -> bytes:
    """The XML of a part with new texts for some nodes and every other byte kept."""
    places: dict[int, tuple[int, int]] = {}
    open_nodes: list[int] = []
    begins: dict[int, int] = {}
    count = 0
    parser = xml.parsers.expat.ParserCreate(namespace_separator=" ")

    def start(_: str, __: dict) -> None:
        nonlocal count
        open_nodes.append(count)
        count += 1

    def text(_: str) -> None:
        if open_nodes and open_nodes[-1] in texts:
            begins.setdefault(open_nodes[-1], parser.CurrentByteIndex)

    def end(_: str) -> None:
        node = open_nodes.pop()
        if node in begins:
            places[node] = (begins[node], parser.CurrentByteIndex)

    parser.StartElementHandler = start
    parser.CharacterDataHandler = text
    parser.EndElementHandler = end
    parser.Parse(data, True)

    out, done = [], 0
    for node, (begin, stop) in sorted(places.items()):
        out += [data[done:begin], escape(texts[node]).encode("utf-8")]
        done = stop
    return b"".join([*out, data[done:]])


def _rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, path, content, edits in batch.itertuples(index=False):
            by_part: dict[str, dict[int, str]] = {}
            for edit in edits if edits is not None else ():
                by_part.setdefault(edit["part"], {})[edit["node_id"]] = edit["text"]
            target = io.BytesIO()
            with (
                zipfile.ZipFile(io.BytesIO(content)) as old,
                zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as new,
            ):
                for item in old.infolist():
                    data = old.read(item)
                    if item.filename in by_part:
                        data = splice(data, by_part[item.filename])
                    new.writestr(item, data)
            rows.append((doc_id, path, target.getvalue()))
        yield pd.DataFrame(rows, columns=["doc_id", "path", "content"])


def rewritten(packages: DataFrame, segments: DataFrame) -> DataFrame:
    """Packages with the texts of `segments` (`doc_id, part, node_id, text`) put back.

    Only changed segments need to be given. They are grouped per package, which bounds a
    group by the size of one file.
    """
    edits = segments.groupBy("doc_id").agg(
        F.collect_list(F.struct("part", "node_id", "text")).alias("edits")
    )
    return (
        packages.join(edits, "doc_id", "left")
        .select("doc_id", "path", "content", "edits")
        .mapInPandas(_rewrite, _SCHEMA)
    )


def result_name(path: str, root: str = "") -> str:
    """Where the result of a package goes, relative to the folder of all results: as the
    package lies below `root`."""
    below = path.removeprefix(root) if root else os.path.basename(path)
    return below.lstrip("/").removesuffix(".docx") + RESULT_SUFFIX


def common_folder(packages: DataFrame) -> str:
    """The folder that holds all packages. What the least and the greatest path begin with,
    all paths between them begin with."""
    ends = packages.agg(F.min("path").alias("low"), F.max("path").alias("high")).first()
    if ends["low"] is None:
        return ""
    return os.path.commonprefix([ends["low"], ends["high"]]).rpartition("/")[0]


def result_table(packages: DataFrame) -> DataFrame:
    """`result, content`: each package under its own name; fails if two would share one."""
    root = common_folder(packages)
    stem = F.regexp_replace(F.substring("path", len(root) + 1, 1 << 30), "^/", "")
    named = packages.select(
        F.concat(F.regexp_replace(stem, "\\.docx$", ""), F.lit(RESULT_SUFFIX)).alias("result"),
        "content",
    )
    twice = named.groupBy("result").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1)
    shared = [row["result"] for row in twice.collect()]
    if shared:
        raise ValueError(f"two packages would be written to {shared[0]}")
    return named


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it. A folder without a scheme is a
    local one, which executors have to share."""
    scheme, mark, rest = folder.partition("://")
    if mark and scheme in ("s3a", "s3n"):
        return fs.FileSystem.from_uri(f"s3://{rest}")
    if folder.startswith("file:") or mark:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), os.path.abspath(folder)


@dataclass
class Written(WriterCommitMessage):
    """Where a task has written the names of the results it has put aside, below the folder of
    all that is put aside: the driver holds the names of one task at a time."""

    names: str


class PackageWriter(DataSourceWriter):
    """Results put aside in a folder of the job's own, and moved to their places when all tasks
    are done. A job that fails leaves nothing, a task that is repeated writes the same file."""

    def __init__(self, folder: str) -> None:
        self.folder = folder
        self.aside = f".writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Written:
        store, folder = store_of(self.folder)
        names = f".names-{uuid.uuid4().hex}"
        store.create_dir(f"{folder}/{self.aside}", recursive=True)
        with store.open_output_stream(f"{folder}/{self.aside}/{names}") as told:
            for row in iterator:
                target = f"{folder}/{self.aside}/{row['result']}"
                store.create_dir(os.path.dirname(target), recursive=True)
                with store.open_output_stream(target) as out:
                    out.write(row["content"])
                told.write(json.dumps(row["result"]).encode() + b"\n")
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = store_of(self.folder)

        def move(result: str) -> None:
            store.create_dir(os.path.dirname(f"{folder}/{result}"), recursive=True)
            store.move(f"{folder}/{self.aside}/{result}", f"{folder}/{result}")

        with ThreadPoolExecutor(32) as pool:
            for message in filter(None, messages):
                with store.open_input_stream(f"{folder}/{self.aside}/{message.names}") as told:
                    results = [json.loads(line) for line in told.read().splitlines()]
                for _ in pool.map(move, results):
                    pass
        self._clear(store, folder)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*store_of(self.folder))

    def _clear(self, store: fs.FileSystem, folder: str) -> None:
        aside = f"{folder}/{self.aside}"
        if store.get_file_info(aside).type != fs.FileType.NotFound:
            store.delete_dir(aside)


class PackageSink(DataSource):
    """`result, content` as files below the option `path`: format `packages`."""

    @classmethod
    def name(cls) -> str:
        return "packages"

    def schema(self) -> str:
        return "result string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> PackageWriter:
        return PackageWriter(self.options["path"])


def write_packages(packages: DataFrame, folder: str) -> None:
    """Write each package below `folder`, a path of any store that Arrow's file systems know,
    as `<name>-result.docx` in the same place as it has below the folder that holds all
    packages. No file appears under its name before all of them are written. The packages are
    staged first: their names are read twice before the contents are written, and `packages`,
    mostly a rewriting of them, is worked out once.
    """
    packages.sparkSession.dataSource.register(PackageSink)
    rows = result_table(staged(packages.select("path", "content"), "results"))
    rows.write.format("packages").mode("append").option("path", folder).save()


__all__ = ["local_name", "result_name", "result_table", "rewritten", "splice", "write_packages"]
