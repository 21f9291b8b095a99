"""Kept expressions in blocks of text (O37), for lists of any size.

Every occurrence of every expression is kept, nested and overlapping ones too. The number of
characters of the list, which is measured, decides how they are found:

* one regular expression, in the plan;
* beyond `LITERAL_CHARS` in the workers, by hashes of windows (`functions.windows`), where the
  whole list is held. Neither of the two shuffles anything;
* beyond `HELD_CHARS` the workers only hold a filter of bounded size. Of the windows that pass
  it each different text is joined with the expressions once; the few that are none go back to
  the workers, who leave them out. If these are too many to hold, they make a filter of their
  own, the expressions that pass it another, and so on, until what a filter cannot tell is
  little enough (`Told`). Only if that takes more room than there is, every window that passes
  is joined. Of the text only what is likely to be kept is shuffled, and at most once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.functions import spans, windows
from inkveil.session import staged

LITERAL_CHARS = 20_000
HELD_CHARS = 16_000_000
BROADCAST_CHARS = 16_000_000
# bytes of filters in the workers for each of HELD_CHARS
FILTER_BYTES = 8
# different windows that a task remembers to have told
TOLD = 300_000


def chars_of(exprs: DataFrame) -> int:
    return exprs.agg(F.coalesce(F.sum(F.length("expr")), F.lit(0))).first()[0]


def longest_first(exprs: DataFrame) -> list[str]:
    """Expressions, longer ones first: one that starts where a longer one does lies inside it.
    For short lists."""
    literals = sorted({row["expr"] for row in exprs.select("expr").collect()} - {None, ""})
    return sorted(literals, key=len, reverse=True)


def alternatives(exprs: DataFrame) -> str:
    """A short list as one pattern."""
    return "|".join(
        "\\Q" + x.replace("\\E", "\\E\\\\E\\Q") + "\\E" for x in longest_first(exprs)
    )


def by_pattern(text: Column, pattern: str) -> Column:
    if not pattern:
        return spans.empty(spans.SPANS)
    return spans.locate_literals(text, F.lit(pattern))


def held(exprs: DataFrame) -> windows.Literals:
    """All expressions, for the workers. For lists of at most HELD_CHARS characters."""
    return windows.Literals.of([row["expr"] or "" for row in exprs.select("expr").collect()])


Longest = Callable[[windows.Batch], np.ndarray]


def _located(texts: pa.Array, longest: Longest) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Where the spans of each text begin in the arrays of starts and ends of all texts."""
    none = np.zeros(0, np.int64)
    sizes, starts, ends = [np.zeros(1, np.int64)], [none], [none]
    for batch in windows.batches(texts.to_pylist()):
        best = longest(batch)
        at = np.flatnonzero(best)
        row = batch.rows(at)
        start = at - (batch.ends - batch.sizes)[row]
        sizes.append(np.bincount(row, minlength=len(batch.sizes)))
        starts.append(start)
        ends.append(start + best[at])
    offsets = pa.array(np.cumsum(np.concatenate(sizes)), pa.int32())
    return offsets, np.concatenate(starts), np.concatenate(ends)


def by_windows(text: Column, exprs: DataFrame) -> Column:
    """Spans of kept expressions in a text, the longest one at each place; null has none."""
    shared = exprs.sparkSession.sparkContext.broadcast(held(exprs))

    @F.arrow_udf(spans.SPANS)
    def run(texts: pa.Array) -> pa.Array:
        offsets, starts, ends = _located(texts, shared.value.longest)
        some = [pa.array(x, pa.int32()) for x in (starts, ends)]
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(some, ["start", "end"]))

    return run(text)


def window_filter(exprs: DataFrame) -> windows.WindowFilter:
    """The filter of a list of any size: what the driver gets is bounded by MOST_BITS."""
    lengths = exprs.filter("expr <> ''").groupBy(F.length("expr").alias("n")).count().collect()
    size = windows.filter_bits(sum(r["count"] for r in lengths))
    words = _filter_words(exprs, size, lambda some: windows.marks(some, size))
    return windows.WindowFilter(tuple(sorted(r["n"] for r in lengths)), words)


def _level_filter(exprs: DataFrame, level: int) -> windows.WindowFilter:
    """A filter of a further level, for windows that those before it leave open."""
    size = windows.filter_bits(exprs.count())
    words = _filter_words(exprs, size, lambda some: windows.own_marks(some, size, level))
    return windows.WindowFilter((), words)


def _filter_words(
    exprs: DataFrame, size: int, marks: Callable[[list[str]], np.ndarray]
) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = marks([x for x in batch.column(0).to_pylist() if x])
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int64))], ["bit"])

    bits = exprs.select("expr").mapInArrow(run, "bit long")
    # 64 bits a row
    place = F.shiftright("bit", 6)
    mark = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(63).cast("int"))
    found = bits.groupBy(place.alias("at")).agg(F.bit_or(mark).alias("word")).toArrow()
    words = np.zeros(size // 64, np.uint64)
    words[found["at"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return words


@dataclass(frozen=True)
class Told:
    """Which of the windows that pass the filter of a list are expressions of it.

    `filters` hold by turns windows that are none and expressions, each those that all filters
    before it leave open: a window that the first does not have is an expression, one that the
    second does not have is none, and so on. Windows that pass all are told by `held`."""

    filters: tuple[windows.WindowFilter, ...]
    held: windows.Literals
    # are those held expressions, or windows that are none?
    listed: bool

    def __call__(
        self, batch: windows.Batch, at: np.ndarray, hashes: np.ndarray, length: int
    ) -> np.ndarray:
        right, open_ = np.zeros(len(at), bool), np.arange(len(at))
        for k, some in enumerate(self.filters, 1):
            inside = some.has(hashes[open_], windows.tag_of(length, k))
            right[open_[~inside]] = k % 2 == 1
            open_ = open_[inside]
        known = self.held.filter.has(hashes[open_], length)
        some = open_[known]
        known[known] = self.held.holds(batch, at[some], hashes[some], length)
        right[open_] = known == self.listed
        return right


def _told(exprs: DataFrame, wrong: DataFrame) -> Told | None:
    """How to tell the expressions from the windows that are none; None if that takes more room
    than workers have. Both are tables of different texts (`expr`)."""
    room, filters, listed, most = FILTER_BYTES * HELD_CHARS, [], False, chars_of(wrong)
    # what a window can be that the filters leave open; the next filter holds `last`
    last, other = wrong, exprs
    while most > HELD_CHARS:
        level = len(filters) + 1
        filters.append(_level_filter(last, level))
        room -= filters[-1].words.nbytes
        if room < 0:
            return None
        last, other = staged(_passing(other, filters[-1], level), "windows"), last
        listed, most = not listed, chars_of(last)
    return Told(tuple(filters), held(last), listed)


def _passing(exprs: DataFrame, some: windows.WindowFilter, level: int) -> DataFrame:
    shared = exprs.sparkSession.sparkContext.broadcast(some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                known = shared.value.may_hold(batch.column(0).to_pylist(), level)
                yield batch.filter(pa.array(known))

    return exprs.select("expr").mapInArrow(run, "expr string")


def candidates(
    blocks: DataFrame, keys: list[str], exprs: DataFrame, known: Broadcast | None = None
) -> DataFrame:
    """`keys, start, piece`: windows that pass the filter of a list."""
    shared = known or blocks.sparkSession.sparkContext.broadcast(window_filter(exprs))

    @F.arrow_udf("array<struct<start:int,piece:string>>")
    def run(texts: pa.Array) -> pa.Array:
        known, sizes, starts, pieces = shared.value, [np.zeros(1, np.int64)], [], []
        for batch in windows.batches(texts.to_pylist()):
            found = [(at, np.full(len(at), n)) for n, at, _ in known.survivors(batch.codes, batch.room)]
            none = np.zeros(0, np.int64)
            at, length = (np.concatenate([none, *x]) for x in zip((none, none), *found, strict=True))
            order = np.argsort(at, kind="stable")
            at, length = at[order], length[order]
            row = batch.rows(at)
            sizes.append(np.bincount(row, minlength=len(batch.sizes)))
            starts.append(at - (batch.ends - batch.sizes)[row])
            text = batch.text
            pieces += [text[b:e] for b, e in zip(at.tolist(), (at + length).tolist(), strict=True)]
        start = pa.array(np.concatenate([np.zeros(0, np.int64), *starts]), pa.int32())
        return pa.ListArray.from_arrays(
            pa.array(np.cumsum(np.concatenate(sizes)), pa.int32()),
            pa.StructArray.from_arrays([start, pa.array(pieces, pa.string())], ["start", "piece"]),
        )

    return (
        blocks.select(*keys, F.explode_outer(run("text")).alias("w"))
        .filter("w is not null")
        .select(*keys, "w.start", "w.piece")
    )


def false_windows(blocks: DataFrame, listed: DataFrame, known: Broadcast) -> DataFrame:
    """`expr`: the different windows that pass the filter and are none of the list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[str] = set()
        for rows in batches:
            for batch in windows.batches(rows.column(0).to_pylist()):
                text, fresh = batch.text, set()
                for n, at, _ in known.value.survivors(batch.codes, batch.room):
                    fresh.update(text[b : b + n] for b in at.tolist())
                fresh -= told
                # what is told twice is put together by the query
                told = fresh if len(told) > TOLD else told | fresh
                yield pa.RecordBatch.from_arrays([pa.array(list(fresh), pa.string())], ["expr"])

    return (
        blocks.select("text")
        .mapInArrow(run, "expr string")
        .distinct()
        .join(listed.withColumnRenamed("piece", "expr"), "expr", "left_anti")
    )


def _packed(text: Column, longest: Longest) -> Column:
    """Spans as bytes, some two each, which take little room in a shuffle; null for none."""

    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        offsets, starts, ends = _located(texts, longest)
        at = offsets.to_numpy().astype(np.int64)
        data, places = windows.packed(at, starts, ends)
        some = pa.array(places, pa.int32())
        return pa.Array.from_buffers(
            pa.binary(), len(texts),
            [pa.array(np.diff(at) > 0).buffers()[1], some.buffers()[1], pa.py_buffer(data)],
        )

    return run(text)


def _unpacked(some: Column) -> Column:
    """The spans of rows of the same keys as one array, the longest one at each place."""

    @F.arrow_udf(spans.SPANS)
    def run(rows: pa.Array) -> pa.Array:
        sizes, starts, ends = [0], [], []
        for packs in rows.to_pylist():
            first, end = windows.unpacked(packs[0])
            if len(packs) > 1:
                each = [windows.unpacked(x) for x in packs]
                first, end = (np.concatenate(x) for x in zip(*each, strict=True))
                order = np.lexsort((end, first))
                first, end = first[order], end[order]
                best = np.append(first[1:] != first[:-1], True)
                first, end = first[best], end[best]
            sizes.append(len(first))
            starts.append(first)
            ends.append(end)
        none = [np.zeros(0, np.int64)]
        both = [pa.array(np.concatenate(none + x), pa.int32()) for x in (starts, ends)]
        return pa.ListArray.from_arrays(
            pa.array(np.cumsum(sizes), pa.int32()),
            pa.StructArray.from_arrays(both, ["start", "end"]),
        )

    return run(some)


def by_join(
    blocks: DataFrame, keys: list[str], exprs: DataFrame, chars: int | None = None
) -> DataFrame:
    """`keys, kept` for blocks that hold kept expressions. The list is written once, as it is
    read for its lengths, its filter and the join."""
    exprs = staged(exprs.select("expr").filter("expr <> ''").distinct(), "exprs")
    listed = exprs.select(F.col("expr").alias("piece"))
    chars = chars_of(exprs) if chars is None else chars
    if chars <= BROADCAST_CHARS:
        listed = F.broadcast(listed)
    known = blocks.sparkSession.sparkContext.broadcast(window_filter(exprs))
    wrong = staged(false_windows(blocks, listed, known), "windows")
    told = _told(exprs, wrong)
    if told is None:
        return _each_joined(blocks, keys, exprs, listed, known)
    shared = blocks.sparkSession.sparkContext.broadcast(told)

    def longest(batch: windows.Batch) -> np.ndarray:
        best, right = np.zeros(len(batch.codes), np.int32), shared.value
        for length, at, hashes in known.value.survivors(batch.codes, batch.room):
            best[at[right(batch, at, hashes, length)]] = length
        return best

    return (
        blocks.select(*keys, _packed(F.col("text"), longest).alias("kept"))
        .filter("kept IS NOT NULL")
        .groupBy(*keys)
        .agg(F.collect_list("kept").alias("kept"))
        .withColumn("kept", _unpacked(F.col("kept")))
    )


def _each_joined(
    blocks: DataFrame, keys: list[str], exprs: DataFrame, listed: DataFrame, known: Broadcast
) -> DataFrame:
    """The same by a row of the join for each window, with at most one expression; hot ones are
    for adaptive execution to split."""
    hits = candidates(blocks, keys, exprs, known).join(listed, "piece", "left_semi")
    longest = hits.groupBy(*keys, "start").agg(
        (F.col("start") + F.max(F.length("piece"))).alias("end")
    )
    return longest.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).cast(spans.SPANS).alias("kept")
    )


def choose(chars: int) -> str:
    if chars <= LITERAL_CHARS:
        return "pattern"
    return "held" if chars <= HELD_CHARS else "joined"


def with_kept(
    blocks: DataFrame,
    keys: list[str],
    text: Column,
    exprs: DataFrame,
    gate: Column | None = None,
    plan: str | None = None,
) -> DataFrame:
    """`blocks` with `kept`, spans of kept expressions in `text`; none where `gate` fails.
    A `plan` that hands the list to the workers fails for a list that is too long for it."""
    chars = chars_of(exprs)
    plan = plan or choose(chars)
    if plan in ("pattern", "held") and chars > HELD_CHARS:
        raise ValueError(f"{chars} characters are too many for plan {plan!r}; use 'joined'")
    if plan == "pattern":
        found = by_pattern(text, alternatives(exprs))
        if gate is not None:
            found = F.when(gate, found).otherwise(spans.empty(spans.SPANS))
        return blocks.withColumn("kept", found)
    if plan == "held":
        # a worker sees null instead of a text that is not searched
        seen = text if gate is None else F.when(gate, text)
        return blocks.withColumn("kept", by_windows(seen, exprs))
    if plan != "joined":
        raise ValueError(f"unknown plan {plan!r}")
    searched = blocks if gate is None else blocks.filter(gate)
    listed = by_join(searched.withColumn("text", text), keys, exprs, chars)
    return blocks.join(listed, keys, "left").withColumn(
        "kept", F.coalesce("kept", spans.empty(spans.SPANS))
    )
