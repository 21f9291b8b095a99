"""Tokens of two tokenizers aligned over the bytes they share.

Each tokenization of a text is an incidence matrix, tokens by bytes, in CSR form (`Csr`). The
product A x B^T by Gustavson's rows has an entry for each pair of tokens whose bytes overlap,
its value their number: the overlap links. Offsets where tokens of both end cut the tokens
into groups; groups are incidence matrices too (groups by tokens), and the product of the one,
transposed, with the other has an entry for each pair of tokens of one group: the shared-group
links, of which the row sizes alone are worked out where only their number is wanted.

Documents are aligned inside tasks, some at a time. How often ids are linked in the whole corpus is
a sum over a shuffle of (id pair, count), counted by document before. Those sums go back to
the documents as sorted arrays in every worker as long as there are no more than
`PAIRS_IN_MEMORY` of them, and by a join on the pair beyond that.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkveil.llm.common import resident, staged

#: Id pairs with their counts that are handed to every worker, 24 bytes each.
PAIRS_IN_MEMORY = 4_000_000
#: Bytes of texts that are tokenized at a time, and entries of a product worked out at a time.
BATCH_BYTES = 1 << 19
PRODUCT_ENTRIES = 1 << 20
#: The quick byte-pair library is quadratic in the length of a word; longer ones go to the other.
LONG_WORD = 4096

_ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "n_group_links long, groups_sha256 string, pairs array<long>, times array<long>"
)
_LINKS = "doc_id long, a int, b int, a_id int, b_id int, bytes int"


@dataclass(frozen=True)
class Csr:
    """A sparse matrix by rows: row i has `columns[ends[i]:ends[i + 1]]`, values beside them."""

    ends: np.ndarray
    columns: np.ndarray
    width: int
    values: np.ndarray | None = None

    @property
    def rows(self) -> int:
        return len(self.ends) - 1

    def sizes(self) -> np.ndarray:
        return np.diff(self.ends)

    def transposed(self) -> Csr:
        """For a matrix with ones only."""
        order = np.argsort(self.columns, kind="stable")
        owner = np.repeat(np.arange(self.rows), self.sizes())[order]
        return Csr(_ends(np.bincount(self.columns, minlength=self.width)), owner, self.rows)


def _ends(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def incidence(sizes: np.ndarray) -> Csr:
    """Neighbouring stretches by what they are made of, e.g. tokens by bytes."""
    ends = _ends(sizes)
    return Csr(ends, np.arange(ends[-1]), int(ends[-1]))


def _picked(a: Csr, b: Csr, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of all products of ones for the rows from `begin` to `end` of `a`."""
    inner = a.columns[a.ends[begin] : a.ends[end]]
    owner = np.repeat(np.arange(begin, end), np.diff(a.ends[begin : end + 1]))
    first, sizes = b.ends[inner], b.ends[inner + 1] - b.ends[inner]
    if not len(inner) or sizes.min() == sizes.max() == 1:
        return owner, b.columns[first]
    step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(owner, sizes), b.columns[np.repeat(first, sizes) + step]


def product(a: Csr, b: Csr) -> Csr:
    """The product of two matrices of ones by Gustavson's method: row i of the result adds up
    the rows of `b` that row i of `a` names. Rows are worked out some `PRODUCT_ENTRIES` at a
    time; only what differs from zero is kept."""
    cost = np.concatenate([[0], np.cumsum(np.diff(b.ends)[a.columns], dtype=np.int64)])[a.ends]
    sizes, columns, values, begin = np.zeros(a.rows, np.int64), [], [], 0
    while begin < a.rows:
        end = int(np.searchsorted(cost, cost[begin] + PRODUCT_ENTRIES, "right")) - 1
        end = min(max(end, begin + 1), a.rows)
        rows, cols = _picked(a, b, begin, end)
        key = rows * b.width + cols
        if len(key) and (np.diff(key) < 0).any():
            key = np.sort(key)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        values.append(np.diff(first, append=len(key)))
        columns.append(key[first] % b.width if b.width else key[first])
        if b.width:
            sizes += np.bincount(key[first] // b.width, minlength=a.rows)
        begin = end
    empty = np.zeros(0, np.int64)
    return Csr(
        _ends(sizes),
        np.concatenate(columns or [empty]),
        b.width,
        np.concatenate(values or [empty]),
    )


@dataclass(frozen=True)
class Alignment:
    """Two tokenizations of the same bytes."""

    links: Csr
    #: groups by tokens, on either side
    a_groups: Csr
    b_groups: Csr

    def shared(self) -> Csr:
        """Tokens a by tokens b that lie in one group."""
        return product(self.a_groups.transposed(), self.b_groups)

    def shared_sizes(self) -> np.ndarray:
        """How many tokens b share the group of each token a: the row sizes of `shared`, known
        before the product is worked out, as a token lies in one group only."""
        return self.b_groups.sizes()[self.a_groups.transposed().columns]


def _blocks(a_ends: np.ndarray, b_ends: np.ndarray, both: np.ndarray) -> Iterator[list[int]]:
    """Tokens from and to of either side, for stretches of some `BATCH_BYTES` that end where
    tokens of both do."""
    begin, a_from, b_from = 0, 0, 0
    while begin < both[-1]:
        at = int(np.searchsorted(both, begin + BATCH_BYTES))
        begin = int(both[min(at, len(both) - 1)])
        a_to, b_to = (int(np.searchsorted(e, begin, "right")) for e in (a_ends, b_ends))
        yield [a_from, a_to, b_from, b_to]
        a_from, b_from = a_to, b_to


def _common(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """What two rising sequences have in common, each number once."""
    if not len(a_ends) or not len(b_ends):
        return a_ends[:0]
    near = b_ends[np.minimum(np.searchsorted(b_ends, a_ends), len(b_ends) - 1)]
    return a_ends[(near == a_ends) & (np.diff(a_ends, prepend=-1) > 0)]


def align(a_sizes: np.ndarray, b_sizes: np.ndarray) -> Alignment:
    """Links and groups of tokens of these numbers of bytes; both sum to the same.

    No token reaches over an offset where both end, so the product is worked out along such
    blocks of the diagonal. Tokens without bytes link to nothing and belong to the group of the
    token before them.
    """
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    both = _common(a_ends, b_ends)
    sizes, columns, values = ([np.zeros(0, np.int64)] for _ in range(3))
    for a_from, a_to, b_from, b_to in _blocks(a_ends, b_ends, both) if len(both) else ():
        b = incidence(b_sizes[b_from:b_to]).transposed()
        part = product(incidence(a_sizes[a_from:a_to]), b)
        sizes.append(part.sizes())
        columns.append(part.columns + b_from)
        values.append(part.values)

    def grouped(ends: np.ndarray) -> Csr:
        return incidence(np.bincount(np.searchsorted(both, ends), minlength=len(both)))

    links = Csr(
        _ends(np.concatenate(sizes)), np.concatenate(columns), len(b_sizes), np.concatenate(values)
    )
    return Alignment(links, grouped(a_ends), grouped(b_ends))


class BytePairs:
    """Ids and their bytes of a byte-level tokenizers file; special strings are plain text."""

    prefix = " "

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        # the printable stand-ins of bytes, as the byte level of the library has them
        plain = [c for c in range(256) if 33 <= c < 127 or 161 <= c < 173 or c >= 174]
        others = [c for c in range(256) if c not in set(plain)]
        stands = {chr(c): c for c in plain} | {chr(256 + k): c for k, c in enumerate(others)}
        assert set(stands) == set(pre_tokenizers.ByteLevel.alphabet())
        if self.library.normalizer is not None:
            raise ValueError("a byte-level tokenizer without a normaliser is needed")
        special = self.library.get_added_tokens_decoder()
        self.bytes = [b""] * self.library.get_vocab_size()
        for token, i in self.library.get_vocab().items():
            self.bytes[i] = token.encode() if i in special else bytes(map(stands.get, token))
        ranks = {self.bytes[i]: i for i in range(len(self.bytes)) if i not in special}
        # the same vocabulary in a library that needs a third of the time
        self.quick = tiktoken.Encoding(
            "quick",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={},
        )

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._ids(self.prefix + text) for text in texts]

    def _ids(self, text: str) -> np.ndarray:
        longest = max(map(len, text.split()), default=0)
        if longest > LONG_WORD or any(c * LONG_WORD in text for c in " \n\t"):
            found = self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids
            return np.array(found, np.int64)
        return self.quick.encode_to_numpy(text, disallowed_special=()).astype(np.int64)


class Pieces:
    """Ids and their bytes of a sentencepiece model."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                self.bytes.append(piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode(texts, num_threads=1)
        return [np.fromiter(x, np.int64, len(x)) for x in found]


class Aligner:
    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = BytePairs(a_path), Pieces(b_path)
        self.a_sizes = np.array([len(x) for x in self.a.bytes])
        self.b_sizes = np.array([len(x) for x in self.b.bytes])
        # ids as text, with what stands behind them inside a group and at its end
        self.a_text = np.array([f"{i}{s}" for i in range(len(self.a_sizes)) for s in ",|"], "S")
        self.b_text = np.array([f"{i}{s}" for i in range(len(self.b_sizes)) for s in ",;"], "S")

    def tokens(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids a and b of each text; none if it is null or empty, or does not come back."""
        some = [t or "" for t in texts]
        none = np.zeros(0, np.int64)
        for text, a, b in zip(some, self.a.encode(some), self.b.encode(some), strict=True):
            whole = (BytePairs.prefix + text).encode()
            # byte-level tokens without a normaliser stand for the bytes they were cut from
            same = text and self.a_sizes[a].sum() == len(whole)
            if same and whole == b"".join(map(self.b.bytes.__getitem__, b.tolist())):
                yield a, b
            else:
                yield none, none

    def align(self, a: np.ndarray, b: np.ndarray) -> Alignment:
        return align(self.a_sizes[a], self.b_sizes[b])

    def listed(self, a: np.ndarray, b: np.ndarray, found: Alignment) -> np.ndarray:
        """The groups as text: ids a, ids b; a group behind the other. A cell for each token,
        zero bytes between them."""
        in_a, in_b = found.a_groups, found.b_groups
        width = max(self.a_text.dtype.itemsize, self.b_text.dtype.itemsize)
        out = np.empty(len(a) + len(b), f"S{width}")
        for ids, own, before, text in (
            (a, in_a, in_b.ends[:-1], self.a_text), (b, in_b, in_a.ends[1:], self.b_text),
        ):
            last = np.zeros(len(ids), np.int64)
            last[own.ends[1:] - 1] = 1
            out[np.arange(len(ids)) + np.repeat(before, own.sizes())] = text[2 * ids + last]
        return out

    def rows(self, texts: list[str | None]) -> Iterator[tuple]:
        """For each text: numbers of tokens a and b, groups, links and shared-group links, the
        digest of the groups, the different pairs of linked ids and how many links have them.

        All texts are aligned as one, as no group reaches beyond a text.
        """
        tokens = list(self.tokens(texts))
        a, b = (np.concatenate(side) for side in zip(*tokens, strict=True))
        found = self.align(a, b)
        a_at, b_at = (_ends([len(t[k]) for t in tokens]) for k in (0, 1))
        group_at = np.searchsorted(found.a_groups.ends, a_at)
        link_at = found.links.ends[a_at]
        shared_at = _ends(found.shared_sizes())[a_at]
        pairs = (np.repeat(a, found.links.sizes()) << 32) + b[found.links.columns]
        text = self.listed(a, b, found)
        counts = [np.diff(x).tolist() for x in (a_at, b_at, group_at, link_at, shared_at)]
        for k, numbers in enumerate(zip(*counts, strict=True)):
            digest = ""
            if numbers[0]:
                cells = text[a_at[k] + b_at[k] : a_at[k + 1] + b_at[k + 1]]
                digest = hashlib.sha256(cells.tobytes().translate(None, b"\0")[:-1]).hexdigest()
            own = np.unique(pairs[link_at[k] : link_at[k + 1]], return_counts=True)
            yield (*numbers, digest, *own)


def loaded(a_path: str, b_path: str) -> Aligner:
    return resident(f"align {a_path} {b_path}", lambda: Aligner(a_path, b_path))


def _batches(texts: pa.Array) -> Iterator[list[str | None]]:
    held, size = [], 0
    for begin in range(0, len(texts), 64):
        for text in texts.slice(begin, 64).to_pylist():
            held.append(text)
            size += len(text or "")
            if size >= BATCH_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


Path = Callable[[], str]


def overlap_links(
    docs: DataFrame, a_path: Path, b_path: Path, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row for each overlap link: `doc_id`, places `a` and `b` of the tokens in their
    sequences, their ids, and how many bytes they share.

    Texts that are null or empty, or that do not come back from either tokenizer byte by byte,
    have no links; nor has an empty table. Other columns are ignored, repeated rows stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = loaded(a_path(), b_path())
        for batch in batches:
            ids, at = batch.column(0).to_pylist(), 0
            for some in _batches(batch.column(1)):
                for a, b in aligner.tokens(some):
                    links = aligner.align(a, b).links
                    owner = np.repeat(np.arange(links.rows), links.sizes())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids[at]] * len(owner), pa.int64()),
                            pa.array(owner, pa.int32()),
                            pa.array(links.columns, pa.int32()),
                            pa.array(a[owner], pa.int32()),
                            pa.array(b[links.columns], pa.int32()),
                            pa.array(links.values, pa.int32()),
                        ],
                        ["doc_id", "a", "b", "a_id", "b_id", "bytes"],
                    )
                    at += 1

    chosen = docs.select(F.col(doc_id).cast("long"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, _LINKS)


def aligned(
    docs: DataFrame, a_path: Path, b_path: Path, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row for each document, written once: numbers of tokens, groups and links, the digest of
    the groups, and `pairs` of linked ids (in one number) with how many `times` links have them.

    `row` tells rows apart, whatever their ids. For nulls and empty texts see `overlap_links`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = loaded(a_path(), b_path())
        for batch in batches:
            at = 0
            for some in _batches(batch.column(2)):
                yield _aligned_rows(aligner, batch.slice(at, len(some)), some)
                at += len(some)

    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
    )
    return staged(numbered.mapInArrow(run, _ALIGNED), "aligned", compression="zstd")


def _aligned_rows(aligner: Aligner, batch: pa.RecordBatch, texts: list) -> pa.RecordBatch:
    *numbers, digests, pairs, times = zip(*aligner.rows(texts), strict=True)
    ends = pa.array(_ends([len(p) for p in pairs]), pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            batch.column(1),
            *[pa.array(column, pa.int64()) for column in numbers],
            pa.array(digests, pa.string()),
            *[
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), pa.int64()))
                for x in (pairs, times)
            ],
        ],
        [f.split()[0] for f in _ALIGNED.split(", ")],
    )


def pair_counts(rows: DataFrame) -> DataFrame:
    """`pair, count, best` of all linked id pairs, written once: how many links in all documents
    have them, and whether no other pair of its id b has more."""
    told = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counted = told.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("count"))
    # as many rows as there are pairs of ids that go together
    most = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    return staged(
        counted.withColumn("best", F.col("count") == F.max("count").over(most)), "pair-counts"
    )


def _looked_up(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """`n_best, count_sum` added by sorted arrays of all counts in every worker."""
    told = counts.toArrow()
    pair = told["pair"].to_numpy()
    order = np.argsort(pair)
    shared = rows.sparkSession.sparkContext.broadcast(
        (pair[order], told["count"].to_numpy()[order], told["best"].to_numpy()[order])
    )

    @F.arrow_udf("struct<n_best:long,count_sum:long>")
    def run(pairs: pa.Array, times: pa.Array) -> pa.Array:
        known, count, best = shared.value
        ends = pairs.offsets.to_numpy()
        span = slice(ends[0], ends[-1])
        at = np.searchsorted(known, pairs.values.to_numpy()[span])
        own = times.values.to_numpy()[times.offsets[0].as_py() : times.offsets[-1].as_py()]

        def summed(values: np.ndarray) -> pa.Array:
            total = np.concatenate([[0], np.cumsum(values)])
            return pa.array(np.diff(total[ends - ends[0]]), pa.int64())

        return pa.StructArray.from_arrays(
            [summed(own * best[at]), summed(own * count[at])], ["n_best", "count_sum"]
        )

    return rows.withColumn("s", run("pairs", "times")).select(
        *[c for c in rows.columns if c not in ("pairs", "times")], "s.*"
    )


def _joined(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by a join on the pair."""
    told = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")
    )
    sums = (
        told.join(counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.col("best").cast("int")).alias("n_best"),
            F.sum(F.col("times") * F.col("count")).alias("count_sum"),
        )
    )
    zero = F.lit(0).cast("long")
    return rows.drop("pairs", "times").join(sums, "row", "left").withColumns(
        {c: F.coalesce(c, zero) for c in ("n_best", "count_sum")}
    )


def report(
    docs: DataFrame,
    a_path: Path,
    b_path: Path,
    doc_id: str = "doc_id",
    text: str = "text",
    in_memory: int = PAIRS_IN_MEMORY,
) -> DataFrame:
    """For each row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256; `n_group_links` counts the pairs of tokens in one group.

    Texts without tokens (see `overlap_links`) have zeros and an empty digest. Null and repeated
    ids stay as they are, repeated rows count each time; an empty table gives an empty result.
    """
    rows = aligned(docs, a_path, b_path, doc_id, text)
    counts = pair_counts(rows)
    found = (_looked_up if counts.count() <= in_memory else _joined)(rows, counts)
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
        "n_group_links",
    )
