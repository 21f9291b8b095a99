"""Token ids in binary files: canonical length-limited Huffman codes in independent blocks.

A folder of token files holds two tables:

* `codes`: id and code length of every id that occurs, from counts over the whole corpus;
* `blocks`: the ids in order of documents. A block has some 65,536 ids at most, packed for
  itself, with the bit offset of every 256th id, so any block (and any stretch of one) is
  decoded alone. It names its documents and how many of its ids are theirs; only a document
  longer than a block goes on in the next.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkveil.llm.common import resident, shared_folder, staged
from inkveil.llm.huffman import Code, code_lengths, limit_for
from inkveil.session import constant

BLOCK = 1 << 16
STEP = 1 << 8
#: Characters encoded at a time, longer texts cut between words; pieces that a worker
#: remembers, twice as many at most, some 200 bytes each.
SEGMENT = 1 << 20
REMEMBERED = 300_000
LEARNT = 1 << 12
END = 2

_GAP = re.compile(r"(?<=\S) ")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_WORD = re.compile(f" ?[{_LETTERS}]+")

# kinds of characters: blanks, other white space, white space that is not cut at, letters,
# digits, signs, apostrophes, all else
_BLANK, _BREAK, _SPACE, _LETTER, _DIGIT, _SIGN, _QUOTE, _OTHER = range(8)
#: White space that is not cut at; stands between texts.
_BETWEEN = "\x1c"


def _kinds() -> np.ndarray:
    """The kind of every code point."""
    kinds = np.full(0x110000, _OTHER, np.uint8)
    for point in range(0x3100):
        if chr(point).isspace():
            kinds[point] = _SPACE
        elif re.match(f"[{_LETTERS}]", chr(point)):
            kinds[point] = _LETTER
    kinds[0x21:0x7F] = np.where(kinds[0x21:0x7F] == _LETTER, _LETTER, _SIGN)
    kinds[ord("0") : ord("9") + 1] = _DIGIT
    kinds[ord("'")] = _QUOTE
    kinds[9:14] = _BREAK
    kinds[ord(" ")] = _BLANK
    return kinds


_ALWAYS, _AMONG_SPACE = 1, 2


def _between() -> np.ndarray:
    """Whether the splitter always cuts between two kinds, whatever stands around them."""
    cuts = np.zeros((8, 8), np.uint8)
    full = [_LETTER, _DIGIT, _SIGN, _QUOTE, _OTHER]
    cuts[np.ix_(full, [_BLANK, _BREAK])] = _ALWAYS
    cuts[_BREAK, full] = _ALWAYS
    cuts[_LETTER, [_DIGIT, _SIGN, _QUOTE]] = _ALWAYS
    cuts[_DIGIT, [_LETTER, _SIGN, _QUOTE]] = _ALWAYS
    cuts[_SIGN, [_LETTER, _DIGIT]] = _ALWAYS
    cuts[_QUOTE, _DIGIT] = _ALWAYS  # but not before letters: 's is one piece
    cuts[: _BREAK + 1, : _BREAK + 1] = _AMONG_SPACE
    return cuts.ravel()


def _byte_letters() -> np.ndarray:
    """The letter (UTF-16) that a byte-level vocabulary writes for each byte."""
    letters = np.arange(256, dtype="<u2")
    rest = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
    letters[rest] = 256 + np.arange(len(rest))
    return letters


def _kind(library) -> np.dtype:
    return np.dtype("<u2" if library.get_vocab_size() <= 1 << 16 else "<u4")


class Encoder:
    """Ids of texts by the tokenizers library, as little-endian numbers of `kind`.

    A byte-level tokenizer without a normaliser cuts texts by a splitter and codes each piece
    for itself. Texts are cut, some together, where the splitter surely does; every different
    piece is looked up once, and pieces are remembered. Unseen words of letters, one piece for
    the splitter, go to the library's model; others, with what may be cut further, go to the
    library. Texts with special strings go there as they are.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.kind = _kind(self.library)
        self.kinds, self.cuts, self.letters = _kinds(), _between(), _byte_letters()
        # a full table is set aside; what is met again is taken over from there
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def plain(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of words of letters, with or without a blank before them."""
        written = self.letters[np.frombuffer("\n".join(words).encode(), np.uint8)]
        written = written.tobytes().decode("utf-16-le").split(chr(self.letters[ord("\n")]))
        found = [self.model.tokenize(w) for w in written]
        data = np.array([t.id for tokens in found for t in tokens], self.kind).tobytes()
        ends = (np.cumsum([len(tokens) for tokens in found]) * self.kind.itemsize).tolist()
        return [data[b:e] for b, e in zip([0, *ends], ends, strict=False)]

    def learn(self, pieces: list[str]) -> None:
        """Remember the ids of pieces."""
        if len(self.pieces) > REMEMBERED:
            self.pieces, self.older = {}, self.pieces
        known, older = self.pieces, self.older
        unseen = [p for p in pieces if p not in known]
        known.update((p, older[p]) for p in unseen if p in older)
        unseen = [p for p in unseen if p not in older]
        words, others = [], []
        for piece in unseen:
            (words if _WORD.fullmatch(piece) else others).append(piece)
        for run, own in ((self._words, words), (self.plain, others)):
            for begin in range(0, len(own), LEARNT):
                some = own[begin : begin + LEARNT]
                known.update(zip(some, run(some), strict=True))

    def _cut(self, text: str, starts: np.ndarray, data: bytes) -> np.ndarray:
        """Byte offsets of pieces of `text`, cut at the characters `starts` in any case."""
        kinds = self.kinds[np.frombuffer(text.encode("utf-32-le"), "<u4")]
        found = self.cuts[(kinds[:-1] << 3) | kinds[1:]]
        cut = np.zeros(len(kinds) + 1, bool)
        cut[1:-1] = found == _ALWAYS
        # the last of several, before what is no white space, is apart from those before it
        among = 1 + np.flatnonzero(found[:-1] == _AMONG_SPACE)
        cut[among[kinds[among + 1] >= _LETTER]] = True
        cut[starts] = True
        at = np.flatnonzero(cut)
        if len(data) == len(kinds):
            return at
        begins = np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)
        return np.append(begins[at[:-1]], len(data))

    def _coded(self, texts: list[str]) -> list[bytes]:
        """The ids of texts without special strings; their pieces are looked up together."""
        text = _BETWEEN.join(["", *texts, ""])
        data = text.encode()
        ends = np.cumsum([0, *(1 + len(t) for t in texts)])
        offsets = self._cut(text, np.concatenate([ends, ends + 1]), data).astype(np.int32)
        pieces = pa.StringArray.from_buffers(
            len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data)
        ).dictionary_encode()
        different = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn(different)
        ids = pa.array(list(map(self.pieces.__getitem__, different)), pa.binary())
        ids = ids.take(pieces.indices)
        # what stands between texts is a piece of its own, left out here
        marks = np.cumsum([0, *(1 + len(t.encode()) for t in texts)])
        first = np.searchsorted(offsets, marks)
        at = np.frombuffer(ids.buffers()[1], np.int32)[: len(ids) + 1]
        coded = memoryview(ids.buffers()[2])
        begins, stops = at[first[:-1] + 1].tolist(), at[first[1:]].tolist()
        return [bytes(coded[b:e]) for b, e in zip(begins, stops, strict=True)]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; pieces of all of them are looked up together."""
        out: list[bytes] = [b""] * len(texts)
        held: list[tuple[int, str]] = []
        size = 0

        def flush() -> None:
            for (k, _), ids in zip(held, self._coded([s for _, s in held]), strict=True):
                out[k] = out[k] + ids if out[k] else ids

        for k, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[k] = b"".join(self.plain(list(_segments(text))))
                continue
            for segment in _segments(text):
                held.append((k, segment))
                size += len(segment)
                if size >= SEGMENT:
                    flush()
                    held, size = [], 0
        flush()
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text or ""])[0]


def _segments(text: str) -> Iterator[str]:
    begin = 0
    while begin < len(text):
        gap = _GAP.search(text, begin + SEGMENT)
        end = gap.start() if gap else len(text)
        yield text[begin:end]
        begin = end


def loaded(path: str) -> Encoder:
    return resident(f"encode {path}", lambda: Encoder(path))


def ids_of(text: Column, path: Callable[[], str], end: int | None) -> Column:
    """The ids of a text, `end` after them, as binary numbers; `path` is called on a worker."""

    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        encoder = loaded(path())
        tail = b"" if end is None else np.array([end], encoder.kind).tobytes()
        out, held, size = [], [], 0
        for begin in range(0, len(texts), 64):
            for text in texts.slice(begin, 64).to_pylist():
                held.append(text or "")
                size += len(held[-1])
                if size >= SEGMENT:
                    out += [ids + tail for ids in encoder.encode_all(held)]
                    held, size = [], 0
        out += [ids + tail for ids in encoder.encode_all(held)]
        return pa.array(out, pa.binary())

    return run(text)


def width_of(path: Callable[[], str]) -> str:
    """The kind of number that ids are written as, asked of the tokenizer on the driver."""
    from tokenizers import Tokenizer

    return _kind(Tokenizer.from_file(path())).str


# --- writing -------------------------------------------------------------------------


def _counted(kind: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                data = b"".join(batch.column(0).slice(begin, 256).to_pylist())
                own = np.bincount(np.frombuffer(data, kind), minlength=len(counts))
                own[: len(counts)] += counts
                counts = own
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int64)), pa.array(counts[found])], names=["id", "n"]
        )

    return run


BLOCKS = (
    "part int, block int, first long, first_doc long, doc_ids array<long>, sizes array<int>, "
    "continued boolean, checkpoints array<int>, payload binary"
)
_BLOCK_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("first", pa.int64()),
        ("first_doc", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int32())),
        ("continued", pa.bool_()),
        ("checkpoints", pa.list_(pa.int32())),
        ("payload", pa.binary()),
    ]
)


def _pieces(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple]:
    """(number of the document in the part, id, ids, whether it goes on from the block before)."""
    number = 0
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            rows = batch.slice(begin, 256)
            for doc, data in zip(*(rows.column(k).to_pylist() for k in (0, 1)), strict=True):
                ids = np.frombuffer(data, kind)
                for at in range(0, max(len(ids), 1), BLOCK):
                    yield number, doc, ids[at : at + BLOCK], at > 0
                number += 1


def _packed(lengths: np.ndarray, kind: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = Code(lengths), TaskContext.get().partitionId()
        held: list[tuple] = []
        block = first = 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([p[2] for p in held])
            payload, checkpoints = code.pack(ids, STEP)
            row = {
                "part": part, "block": block, "first": first, "first_doc": held[0][0],
                "doc_ids": [p[1] for p in held], "sizes": [len(p[2]) for p in held],
                "continued": held[0][3], "checkpoints": checkpoints.astype(np.int32),
                "payload": payload,
            }
            return pa.RecordBatch.from_pylist([row], _BLOCK_ARROW)

        size = 0
        for piece in _pieces(batches, kind):
            if held and size + len(piece[2]) > BLOCK:
                yield flush()
                block, first, held, size = block + 1, first + size, [], 0
            held.append(piece)
            size += len(piece[2])
        if held:
            yield flush()

    return run


def write(
    docs: DataFrame,
    folder: str,
    path: Callable[[], str],
    doc_id: str = "doc_id",
    text: str = "text",
    end: int | None = END,
) -> None:
    """Write the ids of all texts below `folder`, ids of documents ascending, null ids last.

    Null and empty texts are empty: just `end`. Repeated rows and ids are kept, in any order
    among themselves. An empty table gives tables without rows. Other columns are ignored.
    """
    kind = width_of(path)
    coded = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).cast("long").alias("doc_id"),
        ids_of(F.col(text), path, end).alias("ids"),
    )
    rows = staged(coded, "ids", compression="zstd")
    counted = rows.select("ids").mapInArrow(_counted(kind), "id long, n long")
    # at most one row for each id of the vocabulary
    found = counted.groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = (found.column(c).to_numpy() for c in ("id", "n"))
    counts = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
    counts[ids] = n
    lengths = code_lengths(counts, limit_for(len(ids)))
    used = np.flatnonzero(lengths)
    spark = docs.sparkSession
    table = constant(spark, id=used.tolist(), length=lengths[used].tolist()) if len(used) else (
        spark.createDataFrame([], "id long, length long")
    )
    table.coalesce(1).write.parquet(f"{folder}/codes")
    keys = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("row")]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "ids")
    blocks = ordered.mapInArrow(_packed(lengths, kind), BLOCKS)
    blocks.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


# --- reading -------------------------------------------------------------------------


def _read(spark: SparkSession, folder: str) -> tuple[np.ndarray, DataFrame]:
    codes = spark.read.schema("id long, length long").parquet(f"{folder}/codes").toArrow()
    ids, own = (codes.column(c).to_numpy() for c in ("id", "length"))
    lengths = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
    lengths[ids] = own
    return lengths, spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")


def _unpacked(batches: Iterator[pa.RecordBatch], lengths: np.ndarray) -> Iterator[tuple]:
    """(row of the block without payload, its ids), some blocks decoded together."""
    code = Code(lengths)
    for batch in batches:
        for begin in range(0, batch.num_rows, 32):
            rows = batch.slice(begin, 32).to_pylist()
            payloads = [r.pop("payload") for r in rows]
            marks = [np.array(r.pop("checkpoints"), np.int64) for r in rows]
            lanes = code.unpack(payloads, marks, STEP)
            at = 0
            for row, own in zip(rows, marks, strict=True):
                yield row, lanes[at : at + len(own)].ravel()[: sum(row["sizes"])]
                at += len(own)


def _digested(lengths: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("part", "doc", "doc_id", "first", "n", "crc")
        for row, ids in _unpacked(batches, lengths):
            data, at, out = memoryview(ids.astype("<u4").tobytes()), 0, []
            for k, (doc, size) in enumerate(zip(row["doc_ids"], row["sizes"], strict=True)):
                crc = zlib.crc32(data[4 * at : 4 * (at + size)])
                out.append((row["part"], row["first_doc"] + k, doc, row["first"] + at, size, crc))
                at += size
            columns = zip(*out, strict=True)
            kinds = (pa.int32(), *[pa.int64()] * 5)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=list(names)
            )

    return run


def _zeros_after(crc: int, n: int) -> int:
    while n > 0:
        crc = zlib.crc32(bytes(min(n, BLOCK)), crc)
        n -= BLOCK
    return crc


def _crc_of(pieces: Column) -> Column:
    """The checksum of a document from those of its pieces."""

    @F.arrow_udf("long")
    def run(column: pa.Array) -> pa.Array:
        out = []
        for parts in column.to_pylist():
            crc = parts[0]["crc"]
            for p in parts[1:]:
                size = 4 * p["n"]
                crc = _zeros_after(crc, size) ^ _zeros_after(0, size) ^ p["crc"]
            out.append(crc)
        return pa.array(out, pa.int64())

    return run(pieces)


def _offsets(blocks: DataFrame) -> DataFrame:
    """(part, offset): ids of all parts before; as many rows as there are files."""
    total = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n)
    sizes = blocks.select("part", total.alias("n"))
    found = sorted(map(tuple, sizes.groupBy("part").agg(F.sum("n")).collect()))
    starts = np.cumsum([0, *[n for _, n in found]])[:-1]
    if not found:
        return blocks.sparkSession.createDataFrame([], "part long, offset long")
    return constant(
        blocks.sparkSession, part=[p for p, _ in found], offset=[int(s) for s in starts]
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files."""
    lengths, blocks = _read(spark, folder)
    pieces = blocks.mapInArrow(
        _digested(lengths), "part int, doc long, doc_id long, first long, n long, crc long"
    )
    whole = pieces.groupBy("part", "doc").agg(
        F.max("doc_id").alias("doc_id"),
        F.min("first").alias("first"),
        F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("first", "n", "crc"))).alias("pieces"),
    )
    return whole.join(F.broadcast(_offsets(blocks)), "part").select(
        "doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens",
        _crc_of(F.col("pieces")).alias("ids_crc32"),
    )


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """part, doc, piece, doc_id and ids: the ids of every document, a row for each block of it."""
    lengths, blocks = _read(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids in _unpacked(batches, lengths):
            ends = np.cumsum(row["sizes"])
            n = len(ends)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * n, pa.int32()),
                    pa.array([row["first_doc"] + k for k in range(n)], pa.int64()),
                    pa.array([row["block"]] * n, pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(np.split(ids.astype(np.int64), ends[:-1]), pa.list_(pa.int64())),
                ],
                names=["part", "doc", "piece", "doc_id", "ids"],
            )

    return blocks.mapInArrow(run, "part int, doc long, piece int, doc_id long, ids array<long>")


def report(docs: DataFrame, path: Callable[[], str]) -> DataFrame:
    """Write the token files of `docs` in the shared folder and read the documents back."""
    folder = f"{shared_folder(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write(docs, folder, path)
    return documents(docs.sparkSession, folder)
