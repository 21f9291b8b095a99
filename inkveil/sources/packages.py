"""Word-processor packages as tables (O1, O2, O7): `packages` and `nodes`."""

from __future__ import annotations

import fnmatch
import io
import os
import posixpath
import re
import xml.parsers.expat
import zipfile
from collections.abc import Iterator
from itertools import islice
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkveil.session import staged

# --- fixed values -------------------------------------------------------------------
WORD_NAMESPACES = (
    "http://schemas.openxmlformats.org/wordprocessingml/2006/main",
    "http://purl.oclc.org/ooxml/wordprocessingml/main",
)
# story parts of a package, in the order their text is read
STORY_PARTS = ("document", "header", "footer", "endnotes", "footnotes", "comments")
# last words of relationship types: of the package to its document
DOCUMENT_TYPE = "officeDocument"
# ------------------------------------------------------------------------------------

NODE_SCHEMA = (
    "doc_id string, part_rank int, part string, node_id int, edge int, pos bigint, "
    "parent_id int, tag string, text string, "
    "ancestors array<struct<node_id:int,tag:string>>"
)
_NODE_COLUMNS = [
    "doc_id", "part_rank", "part", "node_id", "edge", "pos", "parent_id", "tag", "text",
    "ancestors",
]
_NODE_TYPES = [
    pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int32(),
    pa.string(), pa.string(),
]
# a batch of nodes ends with the part that fills it
BATCH_NODES = 8_192
BATCH_CHARS = 4_000_000
FILES_PER_TASK = 1_000


def read_packages(spark: SparkSession, path: str, glob: str = "*.docx") -> DataFrame:
    """`doc_id, path, content` from any path Spark can read; the path is the key.

    A local folder, which executors have to share, is listed by a task and its files are read by
    tasks: the driver holds no list of them. Of other stores Spark's driver holds one.
    """
    folder = _local_folder(spark, path)
    if folder is not None and not set(glob) & set("{}[]\\"):
        return _read_folder(spark, folder, glob)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select(F.col("path").alias("doc_id"), "path", "content")


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """The absolute path of a local folder; None for all else, patterns of paths too."""
    if set(path) & set("*?{}[]\\%"):
        return None
    if path.startswith("file:"):
        path = re.sub("^file:/+", "/", path)
    elif "://" in path or not _is_local(spark):
        return None
    path = os.path.abspath(path)
    return path if os.path.isdir(path) else None


def _is_local(spark: SparkSession) -> bool:
    store = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    return store is None or store.startswith("file:")


def _hidden(name: str) -> bool:
    """What Spark's readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith(
        "._COPYING_"
    )


def _files_below(folder: str, glob: str) -> Iterator[str]:
    open_ = [folder]
    while open_:
        with os.scandir(open_.pop()) as found:
            for entry in found:
                if _hidden(entry.name):
                    continue
                if entry.is_dir():
                    open_.append(entry.path)
                elif fnmatch.fnmatchcase(entry.name, glob):
                    yield entry.path


def _read_folder(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    def listed(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _files_below(folder, glob)
        while some := list(islice(names, BATCH_NODES)):
            yield pa.RecordBatch.from_pydict({"path": pa.array(some, pa.string())})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open(path, "rb") as file:
                    rows.append((f"file:{path}", file.read()))
                size += len(rows[-1][1])
                if size >= BATCH_CHARS or len(rows) >= BATCH_NODES:
                    yield _packages(rows)
                    rows, size = [], 0
        yield _packages(rows)

    names = staged(spark.range(0, 1, 1, 1).mapInArrow(listed, "path string"), "listed")
    tasks = max(spark.sparkContext.defaultParallelism, -(-names.count() // FILES_PER_TASK))
    return names.repartition(tasks).mapInArrow(read, "doc_id string, path string, content binary")


def _packages(rows: list[tuple[str, bytes]]) -> pa.RecordBatch:
    path = pa.array([p for p, _ in rows], pa.string())
    content = pa.array([c for _, c in rows], pa.binary())
    return pa.RecordBatch.from_arrays([path, path, content], ["doc_id", "path", "content"])


def related(package: zipfile.ZipFile, part: str) -> list[tuple[str, str]]:
    """(last word of the type, name) of the parts that `part` ("" is the package) relates to."""
    folder, base = posixpath.split(part)
    name = posixpath.join(folder, "_rels", f"{base}.rels")
    if name not in package.NameToInfo:
        return []
    found = []
    for relation in ElementTree.fromstring(package.read(name)):
        target = relation.get("Target", "")
        if relation.get("TargetMode") != "External" and target:
            path = posixpath.normpath(posixpath.join("/", folder, target)).lstrip("/")
            found.append((relation.get("Type", "").rpartition("/")[2], path))
    return found


def story_parts(package: zipfile.ZipFile) -> list[tuple[int, str]]:
    """Story parts of a package with their place in the reading order.

    They are found by relationship, whatever their names; parts under the usual names are
    read too, related or not, so no text is passed over.
    """
    ranked = {}
    for name in package.namelist():
        folder, _, base = name.rpartition("/")
        stem = base.removesuffix(".xml").rstrip("0123456789")
        if folder == "word" and base.endswith(".xml") and stem in STORY_PARTS:
            ranked[name] = STORY_PARTS.index(stem)
    for kind, document in related(package, ""):
        if kind == DOCUMENT_TYPE:
            ranked[document] = 0
    for document in [name for name, rank in ranked.items() if rank == 0]:
        for kind, name in related(package, document):
            if kind in STORY_PARTS[1:]:
                ranked[name] = STORY_PARTS.index(kind)
    return sorted((rank, name) for name, rank in ranked.items() if name in package.NameToInfo)


def local_name(name: str) -> str:
    """`t` for `w:t`; names of other vocabularies keep their namespace."""
    space, _, local = name.rpartition(" ")
    return local if space in WORD_NAMESPACES else name


class PartReader:
    """Start and end events of one part, numbered in document order."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self._open: list[dict] = []
        self._count = 0
        self.parser = xml.parsers.expat.ParserCreate(namespace_separator=" ")
        self.parser.buffer_text = True
        self.parser.StartElementHandler = self._start
        self.parser.EndElementHandler = self._end
        self.parser.CharacterDataHandler = self._text

    def _start(self, name: str, _: dict) -> None:
        tag = local_name(name)
        path = [{"node_id": e["id"], "tag": e["tag"]} for e in self._open]
        element = {"id": self._count, "tag": tag, "text": [], "path": path, "row": len(self.rows)}
        self._count += 1
        self.rows.append(None)
        self._add(element, 0, element["row"])
        self._open.append(element)

    def _add(self, element: dict, edge: int, place: int) -> None:
        path = element["path"]
        text = "".join(element["text"]) if element["tag"] in ("t", "delText") else None
        parent = path[-1]["node_id"] if path else None
        self.rows[place] = (element["id"], edge, place, parent, element["tag"], text, path)

    def _end(self, _: str) -> None:
        element = self._open.pop()
        if element["text"]:
            self._add(element, 0, element["row"])
        if element["tag"] in ("tc", "p"):
            self.rows.append(None)
            self._add(element, 1, len(self.rows) - 1)

    def _text(self, data: str) -> None:
        if self._open and self._open[-1]["tag"] in ("t", "delText"):
            self._open[-1]["text"].append(data)


class NodeTable:
    """Rows of NODE_SCHEMA of any packages, a list for each column, for one Arrow batch."""

    def __init__(self) -> None:
        self.columns: list[list] = [[] for _ in range(9)]
        # ancestors of all rows one after the other, and how many each row has
        self.nodes: list[int] = []
        self.tags: list[str] = []
        self.depths: list[int] = [0]
        self.chars = 0

    def add(self, doc_id: str, rank: int, part: str, base: int, rows: list[tuple]) -> None:
        for node, edge, pos, parent, tag, text, path in rows:
            row = (doc_id, rank, part, node, edge, base + pos, parent, tag, text)
            for column, value in zip(self.columns, row, strict=True):
                column.append(value)
            for ancestor in path:
                self.nodes.append(ancestor["node_id"])
                self.tags.append(ancestor["tag"])
            self.depths.append(len(self.nodes))
            self.chars += len(text or "")

    def full(self) -> bool:
        return len(self.columns[0]) >= BATCH_NODES or self.chars >= BATCH_CHARS

    def batch(self) -> pa.RecordBatch:
        ancestors = pa.ListArray.from_arrays(
            pa.array(self.depths, pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array(self.nodes, pa.int32()), pa.array(self.tags, pa.string())],
                ["node_id", "tag"],
            ),
        )
        own = [pa.array(c, t) for c, t in zip(self.columns, _NODE_TYPES, strict=True)]
        return pa.RecordBatch.from_arrays([*own, ancestors], _NODE_COLUMNS)


def _flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = NodeTable()
    for batch in batches:
        for doc_id, content in zip(*batch.to_pydict().values(), strict=True):
            with zipfile.ZipFile(io.BytesIO(content)) as package:
                base = 0  # positions run on over the parts of a package
                for rank, part in story_parts(package):
                    reader = PartReader()
                    reader.parser.Parse(package.read(part), True)
                    found.add(doc_id, rank, part, base, reader.rows)
                    base += len(reader.rows)
                    if found.full():
                        yield found.batch()
                        found = NodeTable()
    yield found.batch()


def nodes(packages: DataFrame, parts: tuple[str, ...] = STORY_PARTS) -> DataFrame:
    """O1, O2: one row per element (and per end of a cell or paragraph)."""
    ranks = [STORY_PARTS.index(p) for p in parts]
    all_nodes = packages.select("doc_id", "content").mapInArrow(_flatten, NODE_SCHEMA)
    return all_nodes.filter(F.col("part_rank").isin(ranks))
