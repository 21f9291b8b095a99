"""Span arithmetic inside one text, with built-in array functions only.

A span is `struct<start INT, end INT>`, 0-based, half-open, counted in code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkveil.functions import grammar

SPANS = "array<struct<start:int,end:int>>"
FOUND = "array<struct<start:int,end:int,ord:bigint,status:string>>"
# Stands for text that is already replaced; matches no name and is not a letter.
BLANK = "\ufdd2"
# Put around matches; must not occur in a text that is searched.
MARK = "\ufdd3"


def searchable(text: Column) -> Column:
    """The text without characters of special meaning here (none are valid text)."""
    marks = BLANK + MARK + grammar.NAME_MARK
    special = F.contains(text, F.lit(marks[0]))
    for mark in marks[1:]:
        special = special | F.contains(text, F.lit(mark))
    clean = F.translate(text, marks, "\ufffd" * len(marks))
    return F.when(special, clean).otherwise(text)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`."""
    return F.get(F.transform(F.array(value), body), 0)


def empty(kind: str) -> Column:
    return F.array().cast(kind)


def marked(text: Column, pattern: Column) -> Column:
    return F.regexp_replace(text, pattern, F.lit(f"{MARK}$0{MARK}"))


def parts_of(text: Column, pattern: Column) -> Column:
    """The text as gaps and matches by turns, a gap first and last."""
    return F.split(marked(text, pattern), MARK, -1)


# Elements folded at a time: a fold copies what it has built at every step.
FOLDED = 64


def running(values: Column) -> Column:
    """Sums of the numbers before each element, in blocks, so that long arrays cost little
    more per element than short ones."""

    def sums(some: Column, base: Column) -> Column:
        start = F.struct(base.alias("sum"), empty("array<int>").alias("out"))
        return F.aggregate(
            some,
            start,
            lambda acc, n: F.struct(
                (acc["sum"] + n).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out")
            ),
            lambda acc: acc["out"],
        )

    def in_blocks(numbers: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(numbers), F.lit(FOLDED))
        total = F.transform(
            starts,
            lambda s: F.aggregate(F.slice(numbers, s, FOLDED), F.lit(0), lambda a, n: a + n),
        )
        return bind(
            sums(total, F.lit(0)),
            lambda bases: F.flatten(
                F.transform(
                    starts,
                    lambda s, k: sums(F.slice(numbers, s, FOLDED), F.get(bases, k)),
                )
            ),
        )

    return bind(
        values,
        lambda numbers: F.when(F.size(numbers) > FOLDED, in_blocks(numbers)).otherwise(
            sums(numbers, F.lit(0))
        ),
    )


def locate(text: Column, pattern: Column) -> Column:
    """Offsets of all matches, leftmost first and not overlapping."""
    return offsets(parts_of(text, pattern))


def offsets(all_parts: Column) -> Column:
    """Offsets of the matches among `parts_of` a text: the lengths of gaps and matches added
    up."""

    def span(begin: Column, end: Column) -> Column:
        return F.struct(begin.alias("start"), end.alias("end"))

    def every(parts: Column) -> Column:
        # every other part is a match
        return bind(
            running(F.transform(parts, F.length)),
            lambda places: F.transform(
                F.sequence(F.lit(1), F.size(parts) - 1, F.lit(2)),
                lambda i: span(F.get(places, i), F.get(places, i) + F.length(F.get(parts, i))),
            ),
        )

    def lay_out(parts: Column) -> Column:
        gap = F.length(F.get(parts, 0))
        return (
            F.when(F.size(parts) == 1, empty(SPANS))
            .when(F.size(parts) == 3, F.array(span(gap, gap + F.length(F.get(parts, 1)))))
            .otherwise(every(parts))
        )

    return bind(all_parts, lay_out)


def locate_literals(text: Column, alternatives: Column) -> Column:
    """Offsets of literals: at each place the first alternative that starts there, whether
    or not an earlier match reaches beyond it."""
    ahead = F.concat(F.lit("(?=("), alternatives, F.lit("))"))
    # a leading blank keeps `split` from swallowing a match at the very start
    gaps = F.split(F.concat(F.lit(BLANK), text), ahead, -1)
    places = F.zip_with(
        F.regexp_extract_all(text, ahead, F.lit(1)),
        gaps,
        lambda hit, gap: F.struct(
            F.length(gap).alias("step"), F.coalesce(F.length(hit), F.lit(0)).alias("len")
        ),
    )

    def lay_out(some: Column) -> Column:
        return bind(
            running(F.transform(some, lambda p: p["step"])),
            lambda before: F.filter(
                F.transform(some, lambda p, i: _span(F.get(before, i) + p["step"] - 1, p["len"])),
                lambda s: s["end"] > s["start"],
            ),
        )

    return F.when(F.rlike(text, alternatives), bind(places, lay_out)).otherwise(empty(SPANS))


def _span(start: Column, length: Column) -> Column:
    return F.struct(start.alias("start"), (start + length).alias("end"))


# Sorted arrays of more elements are searched by halving.
SHORT = 16


def rank(values: Column, limit: Column) -> Column:
    """How many of the sorted `values` are below `limit`."""
    halving = F.aggregate(
        F.lit([1 << k for k in reversed(range(31))]),
        F.lit(0),
        lambda done, step: F.when(
            # beyond the end there is null
            (step <= F.size(values) - done) & (F.get(values, done + step - 1) < limit), done + step
        ).otherwise(done),
    )
    return F.when(
        F.size(values) <= SHORT, F.size(F.filter(values, lambda v: v < limit))
    ).otherwise(halving)


def touches(span: Column, kept: Column, rule: str = "overlap") -> Column:
    """Is a match protected?

    `overlap` protects any common character. `edge` only tests whether the match starts
    or ends inside a kept span, so a match around a kept span is replaced.
    """
    if rule == "overlap":
        return (kept["start"] < span["end"]) & (span["start"] < kept["end"])
    if rule == "edge":
        starts_in = (span["start"] >= kept["start"]) & (span["start"] < kept["end"])
        ends_in = (span["end"] > kept["start"]) & (span["end"] <= kept["end"])
        return starts_in | ends_in
    raise ValueError(f"unknown protection rule {rule!r}")


def resolve(
    text: Column,
    entries: Column,
    kept: Column,
    rule: str = "overlap",
    report_kept: bool = False,
    known: list[dict] | None = None,
) -> Column:
    """Apply entries in order, each leftmost first, on text not yet replaced.

    `entries` is an array of `struct<ord, keep, pattern, mark>` sorted by `ord`; `mark`
    is a dictionary name for the common pattern, else null. Entries with `keep` only add to the kept spans and must come first. The result holds the spans
    found, sorted by start, with status `replaced` or `protected`; with `report_kept`
    also those of kept entries, as `kept`. `known` lists all entries there can be, if they are
    few: their patterns then are constants of the plan, compiled once.
    """

    def matches(some_text: Column, entry: Column) -> Column:
        if known:
            # only the pattern of the entry in turn is tried
            chosen = F
            for row in known:
                chosen = chosen.when(
                    entry["ord"] == row["ord"], marked(some_text, F.lit(row["pattern"]))
                )
            return offsets(F.split(chosen, MARK, -1))
        by_mark = locate(
            grammar.mark_name(some_text, entry["mark"]), F.lit(grammar.MARKED_NAME)
        )
        by_pattern = locate(some_text, entry["pattern"])
        return F.when(entry["mark"].isNotNull(), by_mark).otherwise(by_pattern)

    def told(some_spans: Column, entry: Column, status: Callable[[Column], Column]) -> Column:
        return F.transform(
            some_spans,
            lambda s: F.struct(
                s["start"].alias("start"),
                s["end"].alias("end"),
                entry["ord"].alias("ord"),
                status(s).alias("status"),
            ),
        )

    def judged(some_spans: Column, entry: Column, kept_now: Column) -> Column:
        def status(s: Column) -> Column:
            protected = F.exists(kept_now, lambda k: touches(s, k, rule))
            return F.when(protected, F.lit("protected")).otherwise(F.lit("replaced"))

        return told(some_spans, entry, status)

    def blank_out(some_text: Column, some_spans: Column) -> Column:
        blanks = F.transform(
            F.filter(some_spans, lambda s: s["status"] == "replaced"),
            lambda s: F.struct(
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.repeat(F.lit(BLANK), s["end"] - s["start"]).alias("replacement"),
            ),
        )
        return bind(blanks, lambda edits: rebuild(some_text, edits))

    def apply(state: Column, entry: Column) -> Column:
        def with_kept(some_spans: Column) -> Column:
            report = told(some_spans, entry, lambda _: F.lit("kept"))
            return F.struct(
                state["text"].alias("text"),
                F.concat(state["kept"], some_spans).alias("kept"),
                (F.concat(state["found"], report) if report_kept else state["found"]).alias(
                    "found"
                ),
            )

        def with_found(some_spans: Column) -> Column:
            return F.struct(
                blank_out(state["text"], some_spans).alias("text"),
                state["kept"].alias("kept"),
                F.concat(state["found"], some_spans).alias("found"),
            )

        return bind(
            matches(state["text"], entry),
            lambda some: F.when(F.size(some) == 0, state)
            .when(entry["keep"], with_kept(some))
            .otherwise(bind(judged(some, entry, state["kept"]), with_found)),
        )

    start = F.struct(text.alias("text"), kept.alias("kept"), empty(FOUND).alias("found"))
    in_turn = F.aggregate(entries, start, apply, lambda state: F.sort_array(state["found"]))
    # mostly there is one candidate, and nothing to keep track of
    first = F.get(entries, 0)
    alone = (F.size(entries) == 1) & ~first["keep"]
    return F.when(alone, judged(matches(text, first), first, kept)).otherwise(in_turn)


def with_shadowed(found: Column, every: Column) -> Column:
    """`found` and those of `every` match on the untouched text that touch text replaced for an
    entry before theirs, as `shadowed`."""
    won = lambda w, m: (w["status"] == "replaced") & (w["ord"] < m["ord"])
    lost = F.filter(every, lambda m: F.exists(found, lambda w: won(w, m) & touches(m, w)))
    told = F.transform(lost, lambda m: m.withField("status", F.lit("shadowed")))
    return F.sort_array(F.concat(found, told))


def shift(spans: Column, by: Column) -> Column:
    return F.transform(
        spans,
        lambda s: s.withField("start", s["start"] + by).withField("end", s["end"] + by),
    )


def cuts(text: Column, some_spans: Column) -> Column:
    """The texts of spans, sorted by start. Code points are counted from the start of a text, so many
    spans are cut from stretches of the text that hold FOLDED of them each."""

    def plain(some_text: Column, some: Column, base: Column) -> Column:
        return F.transform(
            some, lambda s: some_text.substr(s["start"] - base + 1, s["end"] - s["start"])
        )

    def stretch(whole: Column, part: Column) -> Column:
        first, last = F.get(part, 0)["start"], F.array_max(F.transform(part, lambda s: s["end"]))
        return bind(
            first,
            lambda base: bind(
                whole.substr(base + 1, last - base), lambda some: plain(some, part, base)
            ),
        )

    def in_stretches(some: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(some), F.lit(FOLDED))
        return bind(
            text,
            lambda whole: F.flatten(
                F.transform(
                    starts,
                    lambda at: bind(
                        F.slice(some, at, FOLDED), lambda part: stretch(whole, part)
                    ),
                )
            ),
        )

    return bind(
        some_spans,
        lambda some: F.when(F.size(some) > FOLDED, in_stretches(some)).otherwise(
            plain(text, some, F.lit(0))
        ),
    )


def rebuild(text: Column, edits: Column) -> Column:
    """The text with sorted, disjoint `struct<start, end, replacement>` put in."""

    def ahead(some: Column) -> Column:
        """What stands before each edit and behind the last."""
        return F.transform(
            F.sequence(F.lit(0), F.size(some)),
            lambda i: F.struct(
                F.coalesce(F.get(some, i - 1)["end"], F.lit(0)).alias("start"),
                F.coalesce(F.get(some, i)["start"], F.length(text)).alias("end"),
            ),
        )

    def put_in(some: Column) -> Column:
        return F.array_join(
            F.transform(
                cuts(text, ahead(some)),
                lambda gap, i: F.concat(gap, F.coalesce(F.get(some, i)["replacement"], F.lit(""))),
            ),
            "",
        )

    return F.when(F.size(edits) == 0, text).otherwise(bind(edits, put_in))


def moves(edits: Column) -> Column:
    """`struct<start, end, before, gain>` of sorted, disjoint edits: by how much each changes the
    length, and all those before it together."""

    def told(some: Column) -> Column:
        gain = lambda e: F.length(e["replacement"]) - (e["end"] - e["start"])
        return bind(
            running(F.transform(some, gain)),
            lambda before: F.transform(
                some,
                lambda e, i: F.struct(
                    e["start"].alias("start"),
                    e["end"].alias("end"),
                    F.get(before, i).alias("before"),
                    gain(e).alias("gain"),
                ),
            ),
        )

    return bind(edits, told)


def remap(segments: Column, edits: Column) -> Column:
    """New offsets of the segments of a block after the edits.

    The replacement goes whole into the segment where the match starts; segments lose
    the part of a match they held. A bound of a segment moves by the edits that start before
    it, less what the last of them still covers behind it, so each is a search in the edits.
    """

    def moved(x: Column, some: Column, starts: Column) -> Column:
        return bind(
            rank(starts, x),
            lambda n: F.when(n == 0, x).otherwise(
                bind(
                    F.get(some, n - 1),
                    lambda e: x + e["before"] + e["gain"] + F.greatest(e["end"] - x, F.lit(0)),
                )
            ),
        )

    def placed(some: Column, starts: Column) -> Column:
        return F.transform(
            segments,
            lambda s: s.withField("from", moved(s["from"], some, starts)).withField(
                "to", moved(s["to"], some, starts)
            ),
        )

    return bind(
        moves(edits),
        lambda some: bind(
            F.transform(some, lambda e: e["start"]), lambda starts: placed(some, starts)
        ),
    )


def shifted(kept: Column, edits: Column) -> Column:
    """Spans in the offsets of the rewritten text: each moves by the change in length of
    the edits before it."""

    def moved(k: Column, some: Column, starts: Column) -> Column:
        return bind(
            bind(
                rank(starts, k["start"]),
                lambda n: F.when(n == 0, F.lit(0)).otherwise(
                    F.get(some, n - 1)["before"] + F.get(some, n - 1)["gain"]
                ),
            ),
            lambda move: k.withField("start", k["start"] + move).withField("end", k["end"] + move),
        )

    return bind(
        moves(edits),
        lambda some: bind(
            F.transform(some, lambda e: e["start"]),
            lambda starts: F.transform(kept, lambda k: moved(k, some, starts)),
        ),
    )
