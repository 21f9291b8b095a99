"""Detection of nominatives in blocks of text.

`detect` adds a column `found` (sorted, disjoint spans with the entry they belong to and
their status) to a table of blocks. Three plans give the same result; the size of the
list, which is measured, decides:

* `direct`  - a few people: their patterns are tried on every block that holds one of
  the surnames. No shuffle.
* `inline`  - up to some ten thousand keys: keys and entries travel with the plan; the
  words of each block are tested against the key set. No shuffle.
* `joined`  - any size: words are joined with the entries on the key. A list that can be
  broadcast is joined and the text searched in the stage that reads it, without a shuffle. Of
  longer ones hot words are salted; entries that share a key with a text are shuffled, and the
  texts that passed the gate, once each.

Where many people are looked for, workers compare names word by word (`functions.matching`):
an expression for each candidate would be compiled anew for nearly every text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache, reduce
from itertools import pairwise
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkveil.functions import grammar, matching, spans
from inkveil.operators import literals
from inkveil.session import staged

DIRECT_ENTRIES = 8
INLINE_KEYS = 20_000
INLINE_CHARS = 16_000_000
BROADCAST_CHARS = 64_000_000
SALTS = 16
# bits of the filter of keys for each key, and 64-bit words of it at most (1 MB in the plan)
KEY_BITS = 16
KEY_WORDS = 1 << 17

_ENTRY = "struct<ord:bigint,keep:boolean,pattern:string,mark:string>"
_FIELDS = ("ord", "keep", "pattern", "mark")
# what workers need of an entry; the pattern of a person is not sent to them
_SLIM = ("ord", "keep", "pattern", "mark", "names", "surname", "full_only")


@dataclass(frozen=True)
class Measure:
    """What is known of a list before the plan is made."""

    entries: int
    keys: int
    chars: int
    widths: tuple[int, ...]
    plain: bool
    # are there entries for the common dictionary pattern?
    marked: bool = False

    @property
    def stretch(self) -> str:
        return grammar.CAPITAL_STRETCH if self.plain else grammar.STRETCH


@dataclass(frozen=True)
class Wish:
    """What to tell of a text, as `detect` has it."""

    rule: str
    report_kept: bool
    shadowed: bool
    # kept expressions of a short list
    literals: tuple[str, ...] = ()

    def kept(self, text: str, kept: list[matching.Span]) -> list[matching.Span]:
        return matching.locate(text, self.literals) if self.literals else kept

    def resolve(self, text: str, entries: list[matching.Entry], start: int, end: int, kept: list):
        """What the entries find in a stretch of a text, in offsets of the text."""
        inside = [(b - start, e - start) for b, e in kept if e > start and b < end]
        found = matching.resolve(
            text[start:end], entries, inside, self.rule, self.report_kept, self.shadowed
        )
        return [(b + start, e + start, ord, status) for b, e, ord, status in found]


def measure(entries: DataFrame) -> Measure:
    row = entries.agg(
        F.count(F.lit(1)).alias("entries"),
        F.coalesce(F.sum(F.size("keys")), F.lit(0)).alias("keys"),
        # each key carries the pattern
        F.coalesce(
            F.sum(F.size("keys") * F.length(F.coalesce("pattern", "mark"))), F.lit(0)
        ).alias("chars"),
        # the number of words of a nominative, a handful of different values
        F.sort_array(F.collect_set("width")).alias("widths"),
        F.coalesce(F.bool_and("plain"), F.lit(False)).alias("plain"),
        F.coalesce(F.bool_or(F.col("mark").isNotNull()), F.lit(False)).alias("marked"),
    ).first()
    return Measure(**{**row.asDict(), "widths": tuple(row["widths"])})


def fits(size: Measure) -> bool:
    """Is the list small enough to be a constant of the plan?"""
    return size.keys <= INLINE_KEYS and size.chars <= INLINE_CHARS


def choose(size: Measure) -> str:
    if size.entries <= DIRECT_ENTRIES and not size.marked:
        return "direct"
    return "inline" if fits(size) else "joined"


def gated_blocks(blocks: DataFrame, block_key: list[str]) -> DataFrame:
    """O22 for blocks stored in several pieces: one name-like piece opens the block."""
    open_blocks = blocks.filter(grammar.is_name_like(F.col("text"))).select(*block_key)
    return open_blocks.distinct()


def detect(
    blocks: DataFrame,
    keys: list[str],
    entries: DataFrame,
    keep_exprs: DataFrame | None = None,
    *,
    gate: Column | None = None,
    rule: str = "overlap",
    plan: str | None = None,
    report_kept: bool = False,
    report_shadowed: bool = False,
) -> DataFrame:
    """Blocks (`keys`, unique, and `text`) with `found`; blocks that fail the gate have
    none. `gate` replaces the test of the text itself, e.g. for pieces of blocks.
    `plan` asks for a way of searching; one that holds the list in the plan fails for a list
    that is too long for it. `report_kept` also tells the spans of kept entries, `report_shadowed` those that an entry
    before took the text from: the candidates of a stretch are looked for a second time on the
    untouched text, in the direct plan the whole list is."""
    searched, passed = detect_open(
        blocks, keys, entries, keep_exprs, gate=gate, rule=rule, plan=plan,
        report_kept=report_kept, report_shadowed=report_shadowed,
    )
    return searched if passed is None else searched.unionByName(passed)


def detect_open(
    blocks: DataFrame,
    keys: list[str],
    entries: DataFrame,
    keep_exprs: DataFrame | None = None,
    *,
    gate: Column | None = None,
    rule: str = "overlap",
    plan: str | None = None,
    report_kept: bool = False,
    report_shadowed: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """The blocks of `detect` in two tables where the plan parts them: those that were searched,
    and those that failed the gate, which who looks for spans only need not read."""
    if rule not in ("overlap", "edge"):
        raise ValueError(f"unknown protection rule {rule!r}")

    text = spans.searchable(F.col("text"))
    # what `searchable` replaces is no part of a nominative, so the text as it is tells as much
    gate = grammar.is_name_like(F.col("text")) if gate is None else gate
    size, wish = measure(entries), Wish(rule, report_kept, report_shadowed)
    plan = plan or choose(size)
    if plan in ("direct", "inline") and size.entries > DIRECT_ENTRIES and not fits(size):
        raise ValueError(f"{size.keys} keys are too many for plan {plan!r}; use 'joined'")
    if size.entries == 0:
        return blocks.withColumn("found", spans.empty(spans.FOUND)), None

    kept = spans.empty(spans.SPANS)
    if keep_exprs is not None:
        chars = literals.chars_of(keep_exprs)
        if literals.choose(chars) != "pattern":
            blocks = literals.with_kept(blocks, keys, text, keep_exprs, gate)
            kept = F.coalesce("kept", kept)
        elif plan == "direct":
            kept = literals.by_pattern(text, literals.alternatives(keep_exprs))
        else:
            wish = replace(wish, literals=tuple(literals.longest_first(keep_exprs)))

    if plan == "joined":
        searched, passed = _joined(blocks, keys, text, entries, size, kept, gate, wish)
        return searched.drop("kept"), passed.drop("kept")
    if plan == "inline":
        found = _inline(F.when(gate, text), kept, entries, size, wish)
        return blocks.withColumn("found", found).drop("kept"), None
    if plan != "direct":
        raise ValueError(f"unknown plan {plan!r}")
    found = _direct(text, entries, kept, wish)
    out = blocks.withColumn(
        "found", F.when(gate, found).otherwise(spans.empty(spans.FOUND))
    ).drop("kept")
    if not report_shadowed:
        return out, None
    listed = entries.filter(~F.col("keep")).withColumn("keep", F.lit(True))
    every = detect(
        out.withColumnRenamed("found", "_found"),
        keys,
        listed,
        gate=gate,
        plan=plan,
        report_kept=True,
    )
    return every.withColumn(
        "found", spans.with_shadowed(F.col("_found"), F.col("found"))
    ).drop("_found"), None


def _literal(rows: list[dict] | list, kind: str) -> Column:
    """Bounded data as one constant of the plan."""
    return F.from_json(F.lit(json.dumps(rows, ensure_ascii=False)), kind)


def _direct(text: Column, entries: DataFrame, kept: Column, wish: Wish) -> Column:
    rows = sorted(
        (r.asDict() for r in entries.select(*_FIELDS, "anchor").collect()),
        key=lambda r: r["ord"],
    )
    anchors = "|".join(r["anchor"] for r in rows if wish.report_kept or not r["keep"])
    if not anchors:
        return spans.empty(spans.FOUND)
    listed = _literal([{k: r[k] for k in _FIELDS} for r in rows], f"array<{_ENTRY}>")
    # a longer list, taken this way on request, is not spelt out
    few = len(rows) <= DIRECT_ENTRIES and not any(r["mark"] for r in rows)
    known = rows if few else None
    return F.when(
        text.rlike(f"{grammar.NOT_AFTER_LETTER}(?:{anchors}){grammar.NOT_BEFORE_LETTER}"),
        spans.bind(
            kept, lambda k: spans.resolve(text, listed, k, wish.rule, wish.report_kept, known)
        ),
    ).otherwise(spans.empty(spans.FOUND))


def _slim(entries: DataFrame) -> Column:
    """An entry as workers get it."""
    pattern = F.when(F.col("surname").isNull(), F.col("pattern")).alias("pattern")
    return F.struct(*[pattern if x == "pattern" else x for x in _SLIM])


def _kept_rows(kept: pa.Array) -> list[list[matching.Span]]:
    at, some = kept.offsets.to_pylist(), kept.values
    every = list(zip(some.field("start").to_pylist(), some.field("end").to_pylist(), strict=True))
    return [every[b:e] for b, e in zip(at, at[1:], strict=False)]


def _found_rows(rows: list[list[matching.Found]]) -> pa.Array:
    offsets = [0]
    for row in rows:
        offsets.append(offsets[-1] + len(row))
    columns = list(zip(*[f for row in rows for f in row], strict=True)) or [[], [], [], []]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.string())
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            ["start", "end", "ord", "status"],
        ),
    )


def _inline(
    text: Column, kept: Column, entries: DataFrame, size: Measure, wish: Wish
) -> Column:
    # a hash table for the workers: key -> places in the list of entries, in their order
    rows = sorted(
        entries.select("keys", _slim(entries).alias("e")).collect(),
        key=lambda r: (r["e"]["ord"], r["e"]["keep"]),
    )
    table: dict[str, list[int]] = {}
    for k, row in enumerate(rows):
        for key in row["keys"]:
            table.setdefault(key, []).append(k)
    listed = [matching.Entry.of(*row["e"]) for row in rows]
    shared = entries.sparkSession.sparkContext.broadcast((table, listed))
    capital, widths = size.plain, size.widths

    @F.arrow_udf(spans.FOUND)
    def run(texts: pa.Array, kept_rows: pa.Array) -> pa.Array:
        table, listed = shared.value
        out = []
        for some, held in zip(texts.to_pylist(), _kept_rows(kept_rows), strict=True):
            found, inside = [], None
            for start, end, words in matching.stretches(some or "", capital):
                places = set()
                for key in matching.keys_of(words, widths):
                    places.update(table.get(key, ()))
                if places:
                    tried = [listed[k] for k in sorted(places)]
                    inside = wish.kept(some, held) if inside is None else inside
                    found += wish.resolve(some, tried, start, end, inside)
            out.append(found)
        return _found_rows(out)

    return run(text, kept)


def _probes(key: Column, bits: int) -> list[Column]:
    """Two places of a filter of `bits` bits for a key."""
    hashed = F.xxhash64(key)
    return [F.pmod(x, F.lit(bits)) for x in (hashed, F.shiftright(hashed, 27))]


def key_filter(entries: DataFrame, keys: int) -> Callable[[Column], Column]:
    """A test whether a key can be one of the list's; it never fails one that is.

    The bits are a constant of the plan. A list with more keys than they can tell apart lets
    more keys through, which the join then finds to be none."""
    words = 1
    while words * 64 < keys * KEY_BITS and words < KEY_WORDS:
        words *= 2
    places = F.explode(F.array(*_probes(F.col("key"), words * 64))).alias("bit")
    set_ = entries.select(F.explode("keys").alias("key")).select(places)
    one = F.lit(1).cast("long")
    mark = F.call_function("shiftleft", one, F.pmod("bit", F.lit(64)).cast("int"))
    rows = (
        set_.groupBy(F.floor(F.col("bit") / 64).cast("int").alias("at"))
        .agg(F.bit_or(mark).alias("word"))
        .collect()
    )
    table = [0] * words
    for row in rows:
        table[row["at"]] = row["word"]
    bits = _literal(table, "array<bigint>")

    def known(key: Column) -> Column:
        def is_set(place: Column) -> Column:
            word = F.get(bits, F.shiftright(place, 6).cast("int"))
            return F.call_function("getbit", word, F.pmod(place, F.lit(64)).cast("int")) == 1

        first, second = _probes(key, words * 64)
        return is_set(first) & is_set(second)

    return known


def _places(text: Column, size: Measure) -> Column:
    """`struct<start, end, key>` for the keys of all stretches of a text."""
    capital, widths = size.plain, size.widths

    @F.arrow_udf("array<struct<start:int,end:int,key:string>>")
    def run(texts: pa.Array) -> pa.Array:
        offsets, starts, ends, keys = [0], [], [], []
        for some in texts.to_pylist():
            for start, end, words in matching.stretches(some or "", capital):
                own = matching.keys_of(words, widths)
                keys += own
                starts += [start] * len(own)
                ends += [end] * len(own)
            offsets.append(len(keys))
        columns = [pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(keys, pa.string())]
        return pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()),
            pa.StructArray.from_arrays(columns, ["start", "end", "key"]),
        )

    return run(text)


def _hit(start: Column, end: Column, entry: Column) -> Column:
    """A place and an entry as one string, which is cheaper to shuffle and to collect."""
    return F.concat_ws(" ", start, end, entry)


@lru_cache(1 << 14)
def _entry(slim: str) -> matching.Entry:
    told = json.loads(slim)
    return matching.Entry.of(*[told.get(x) for x in _SLIM])


def _resolved(
    text: str, held: list[matching.Span], by_place: dict[matching.Span, set[str]], wish: Wish
) -> list[matching.Found]:
    """What entries, as `_slim` has them, find in their stretches of a text."""
    found, inside = [], wish.kept(text, held) if by_place else held
    for (start, end), some in sorted(by_place.items()):
        tried = sorted((_entry(slim) for slim in some), key=lambda e: (e.ord, e.keep))
        found += wish.resolve(text, tried, start, end, inside)
    return found


def _searched(text: Column, kept: Column, hits: Column, wish: Wish) -> Column:
    """What the entries of `hits`, an array of `_hit`, find in a text."""

    @F.arrow_udf(spans.FOUND)
    def run(texts: pa.Array, kept_rows: pa.Array, hit_rows: pa.Array) -> pa.Array:
        out = []
        rows = zip(texts.to_pylist(), _kept_rows(kept_rows), hit_rows.to_pylist(), strict=True)
        for text, held, hits in rows:
            by_place: dict[matching.Span, set[str]] = {}
            # several keys can lead to the same entry
            for hit in hits or ():
                start, end, slim = hit.split(" ", 2)
                by_place.setdefault((int(start), int(end)), set()).add(slim)
            out.append(_resolved(text, held, by_place, wish))
        return _found_rows(out)

    return run(text, kept, hits)


def _beside(
    gated: DataFrame,
    keys: list[str],
    text: Column,
    listed: DataFrame,
    size: Measure,
    kept: Column,
    known: Callable[[Column], Column],
    wish: Wish,
) -> DataFrame:
    """`gated` with `found`, in the stage that reads it: the list (`key, e`) is broadcast, so the
    candidates of a text come one after the other. Its columns go with the first of them."""
    names = gated.columns
    places = F.when(reduce(and_, [F.col(k).isNotNull() for k in keys]), _places(text, size))
    # an outer explode, as a plain one would make Spark evaluate its input twice
    parts = gated.withColumns({"_row": F.monotonically_increasing_id(), "_text": text, "_kept": kept})
    parts = parts.select("*", F.posexplode_outer(places).alias("_at", "_s"))
    first = F.coalesce(F.col("_at") == 0, F.lit(True))
    parts = parts.filter(first | known(F.col("_s.key"))).select(
        "_row",
        F.col("_s.start").alias("_start"),
        F.col("_s.end").alias("_end"),
        F.col("_s.key").alias("_key"),
        *[F.when(first, F.col(c)).alias(c) for c in ("_text", "_kept", *names)],
    )
    # a row for each key, so a text goes to the search once
    by_key = F.broadcast(listed.groupBy("key").agg(F.collect_list("e").alias("e")))
    candidates = by_key.join(parts, F.col("_key") == F.col("key"), "right").select(
        "_row", "_start", "_end", "e", "_text", "_kept", *names
    )

    def found(rows: pa.RecordBatch) -> pa.RecordBatch:
        ids = rows.column(0).to_numpy()
        heads = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        starts, ends, some = (rows.column(k).to_pylist() for k in (1, 2, 3))
        whole = rows.take(pa.array(heads))
        texts, held = whole.column(4).to_pylist(), _kept_rows(whole.column(5))
        out = []
        for k, (begin, stop) in enumerate(pairwise([*heads.tolist(), len(ids)])):
            by_place: dict[matching.Span, set[str]] = {}
            # several keys can lead to the same entry
            for n in range(begin, stop):
                if some[n] is not None:
                    by_place.setdefault((starts[n], ends[n]), set()).update(some[n])
            out.append(_resolved(texts[k], held[k], by_place, wish))
        return pa.RecordBatch.from_arrays(
            [*whole.columns[6:], _found_rows(out)], [*names, "found"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the candidates of the last text, which may go on in the next batch
        open_: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            last = open_[-1].column(0)[-1].as_py() if open_ else ids[0]
            if (np.diff(ids, prepend=last) < 0).any():
                raise RuntimeError("the candidates of a text are not side by side")
            if ids[-1] != last:
                cut = int(np.searchsorted(ids, ids[-1]))
                yield found(pa.concat_batches([*open_, batch.slice(0, cut)]))
                open_ = []
                batch = batch.slice(cut)
            open_.append(batch)
        if open_:
            yield found(pa.concat_batches(open_))

    schema = StructType([*gated.schema.fields, *StructType.fromDDL(f"found {spans.FOUND}")])
    return candidates.mapInArrow(run, schema)


def _joined(
    blocks: DataFrame,
    keys: list[str],
    text: Column,
    entries: DataFrame,
    size: Measure,
    kept: Column,
    gate: Column,
    wish: Wish,
) -> tuple[DataFrame, DataFrame]:
    gate = F.coalesce(gate, F.lit(False))
    gated = blocks.filter(gate)
    passed = blocks.filter(~gate).withColumn("found", spans.empty(spans.FOUND))
    known = key_filter(entries, size.keys)
    listed = entries.select("keys", F.to_json(_slim(entries)).alias("e")).select(
        F.explode("keys").alias("key"), "e"
    )
    if size.chars <= BROADCAST_CHARS:
        return _beside(gated, keys, text, listed, size, kept, known, wish), passed
    # written once: read for its keys and again for the search
    gated = staged(gated, "gated")
    # narrow rows: where a stretch lies and one of its keys, if the list can have it; an outer
    # explode, as a plain one would make Spark evaluate its input twice
    parts = (
        gated.select(*keys, F.explode_outer(_places(text, size)).alias("s"))
        .filter(F.col("s").isNotNull())
        .select(*keys, "s.*")
        .filter(known(F.col("key")))
    )
    salt = F.pmod(F.xxhash64(*keys, "start"), F.lit(SALTS)).cast("int")
    salted = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    candidates = parts.withColumn("salt", salt).join(salted, ["key", "salt"])
    # one group holds the entries that share words with the stretches of one text
    hits = candidates.select(*keys, _hit(F.col("start"), F.col("end"), F.col("e")).alias("hit"))
    hits = hits.groupBy(*keys).agg(F.collect_list("hit").alias("hits"))
    searched = gated.join(hits, keys, "left").withColumn(
        "found", _searched(text, kept, F.col("hits"), wish)
    )
    return searched.drop("hits"), passed
