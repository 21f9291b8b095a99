"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words that occurs in an item. A document's words are
streamed through it; after each word the state and the length of the longest run ending there
are known, and with them every window (WINDOW words of an item, or a shorter item as a whole)
that ends there. Items travel to the workers in blocks of bounded size, one scan for a block.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.llm.common import free_name, raw, resident, staged, word_blocks

WINDOW = 13
#: A document is contaminated if hit words are at least one in so many.
COVERAGE = 20
#: Words of items in one automaton, some 150 MB in a worker; more items take more scans.
BLOCK_WORDS = 200_000

HITS = (
    "struct<n_words: long, n_hit: long, items: array<string>, "
    "spans: array<struct<start: long, end: long>>>"
)
_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)

# lower-cases A-Z; all other ASCII but digits and letters parts words; lengths stay
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
_RUN = re.compile(rb"[^ ]+")


def words_of(text: str | bytes | None) -> list[bytes]:
    data = text.encode() if isinstance(text, str) else text or b""
    return data.translate(_PLAIN).split()


class Automaton:
    """Suffix automaton over the words of (id, words) items."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        items = [(i, words) for i, words in items if words]
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.moves: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [
            (i, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
            for i, words in items
        ]
        for _, codes in coded:
            last = 0
            for code in codes:
                last = self._extend(last, code)
        # by state: its longest window, as (words, ids of the items); windows end in one state
        own: dict[int, dict[int, set[str]]] = {}
        for i, codes in coded:
            size, state = min(window, len(codes)), 0
            for at, code in enumerate(codes):
                state = self.moves[state][code]
                if at + 1 >= size:
                    own.setdefault(self._holder(state, size), {}).setdefault(size, set()).add(i)
        self.windows = {
            state: sorted(by_size.items(), reverse=True) for state, by_size in own.items()
        }
        # the next state on the way over suffix links, itself included, that ends windows
        self.ends = [-1] * len(self.link)
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            above = self.link[state]
            self.ends[state] = (
                state if state in self.windows else self.ends[above] if above >= 0 else -1
            )

    def _holder(self, state: int, size: int) -> int:
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _copy(self, state: int, code: int, target: int) -> int:
        """Part the runs of `target` no longer than those of `state` with `code` added."""
        fresh = len(self.link)
        self.moves.append(dict(self.moves[target]))
        self.link.append(self.link[target])
        self.length.append(self.length[state] + 1)
        self.link[target] = fresh
        while state >= 0 and self.moves[state].get(code) == target:
            self.moves[state][code] = fresh
            state = self.link[state]
        return fresh

    def _extend(self, last: int, code: int) -> int:
        target = self.moves[last].get(code)
        if target is not None:
            exact = self.length[target] == self.length[last] + 1
            return target if exact else self._copy(last, code, target)
        fresh = len(self.link)
        self.moves.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        state = last
        while state >= 0 and code not in self.moves[state]:
            self.moves[state][code] = fresh
            state = self.link[state]
        if state >= 0:
            target = self.moves[state][code]
            exact = self.length[target] == self.length[state] + 1
            self.link[fresh] = target if exact else self._copy(state, code, target)
        return fresh

    def scan(self, text: bytes | None) -> tuple[int, list[list[int]], set[str]]:
        """Number of words, spans of hit words, and items with a window in the text."""
        moves, link, length, ends, windows = (
            self.moves, self.link, self.length, self.ends, self.windows,
        )
        spans: list[list[int]] = []
        items: set[str] = set()
        state, run, at = 0, 0, 0
        for words in word_blocks((text or b"").translate(_PLAIN)):
            for at, code in enumerate(map(self.vocabulary.get, words), at + 1):  # noqa: B020
                if code is None:
                    state = run = 0
                    continue
                while state and code not in moves[state]:
                    state = link[state]
                    run = length[state]
                state = moves[state].get(code, 0)
                run = run + 1 if state else 0
                end = ends[state]
                longest = 0
                while end >= 0:
                    for size, ids in windows[end]:
                        if size <= run:
                            longest = longest or size
                            items |= ids
                    above = link[end]
                    end = ends[above] if above >= 0 else -1
                if longest:
                    begin = at - longest
                    while spans and spans[-1][1] >= begin:
                        begin = min(begin, spans.pop()[0])
                    spans.append([begin, at])
        return at, spans, items


def _union(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    merged: list[list[int]] = []
    for begin, end in sorted([*a, *b]):
        if merged and merged[-1][1] >= begin:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([begin, end])
    return merged


def loaded(key: str, items: Callable[[], list[tuple[str, list[bytes]]]], window: int) -> Automaton:
    return resident(key, lambda: Automaton(items(), window))


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items as (id, words) in blocks of some `most` words; at least one block, maybe empty."""
    block, size, given = [], 0, False
    for i, text in items.toLocalIterator():
        words = words_of(text)
        if block and size + len(words) > most:
            yield block
            block, size, given = [], 0, True
        block.append((i or "", words))
        size += len(words)
    if block or not given:
        yield block


def _scan(block: list[tuple[str, list[bytes]]], df: DataFrame, window: int) -> Callable:
    sent, key = df.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

    @F.arrow_udf(HITS)
    def run(texts: pa.Array, before: pa.Array) -> pa.Array:
        automaton = loaded(key, lambda: sent.value, window)
        out = []
        for text, old in zip(raw(texts), before.to_pylist(), strict=True):
            n_words, spans, items = automaton.scan(text)
            if old:
                spans = _union(spans, [[s["start"], s["end"]] for s in old["spans"]])
                items |= set(old["items"])
            out.append(
                {
                    "n_words": n_words,
                    "n_hit": sum(end - begin for begin, end in spans),
                    "items": sorted(items),
                    "spans": [{"start": begin, "end": end} for begin, end in spans],
                }
            )
        return pa.array(out, _ARROW)

    return run


def with_hits(
    docs: DataFrame,
    items: DataFrame,
    hits: str,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """`docs` with a column `hits`: n_words, n_hit, items (ids as sorted strings), spans (words).

    Null texts have no words. Items without words have no window, equal ids are one item and
    null ids read as "". Repeated rows and all other columns stay. An empty table of either
    kind is fine.
    """
    plain = items.select(F.col(item_id).cast("string"), F.col(item_text))
    docs = docs.withColumn(hits, F.lit(None).cast(HITS))
    for k, block in enumerate(_blocks(plain, block_words)):
        if k:  # lets go of the automaton before
            docs = staged(docs, "scanned")
        docs = docs.withColumn(hits, _scan(block, docs, window)(F.col(text), F.col(hits)))
    return docs


def contaminated(hits: Column, coverage: int = COVERAGE) -> Column:
    return (hits["n_hit"] > 0) & (coverage * hits["n_hit"] >= hits["n_words"])


def cut(text: Column, hits: Column, least: int, coverage: int = COVERAGE) -> Column:
    """The text without hit spans: all of a contaminated text, else those of `least` words.

    Between words, white space and signs stay; texts without such spans stay as they are.
    """

    @F.arrow_udf("string")
    def run(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for data, cuts in zip(raw(texts), spans.to_pylist(), strict=True):
            if data and cuts:
                places = [m.span() for m in _RUN.finditer(data.translate(_PLAIN))]
                parts, begin = [], 0
                for span in cuts:
                    parts.append(data[begin : places[span["start"]][0]])
                    begin = places[span["end"] - 1][1]
                data = b"".join([*parts, data[begin:]])
            out.append(None if data is None else data.decode())
        return pa.array(out, pa.string())

    chosen = F.when(contaminated(hits, coverage), hits["spans"]).otherwise(
        F.filter(hits["spans"], lambda s: s["end"] - s["start"] >= least)
    )
    return run(text, chosen)


def decontaminate(docs: DataFrame, items: DataFrame, least: int = WINDOW, **names) -> DataFrame:
    """`docs` with their texts cut; other columns stay."""
    hits = free_name(docs, "hits")
    text = names.get("text", "text")
    marked = with_hits(docs, items, hits, **names)
    return marked.withColumn(text, cut(F.col(text), F.col(hits), least)).drop(hits)


def clean_documents(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """The rows of `docs` that are not contaminated, as they are."""
    hits = free_name(docs, "hits")
    return with_hits(docs, items, hits, **names).filter(~contaminated(F.col(hits))).select(
        *docs.columns
    )


def report(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for each row."""
    hits = F.col("hits")
    marked = with_hits(docs.select(F.col(doc_id).alias("doc_id"), "text"), items, "hits")
    return marked.select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        hits["n_hit"].alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(hits).alias("contaminated"),
    )
