"""Quality rules as a short-circuit cascade of native expressions.

Every rule's cost (seconds) and selectivity (share of rows rejected) are measured on a bounded
sample; the rules then run in the order of rejections per cost, and a row that one rule has
rejected is not looked at by the rest. The order never changes which rows are kept.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.llm.common import free_name, staged

#: Rows on which costs and selectivities are measured.
SAMPLE_ROWS = 2000
SHORT = 10
REPEATS = 20
SYMBOLS = r"[#*$%&|<>]"
_BLANKS = "\t\n\x0b\f\r"


@dataclass(frozen=True)
class Rule:
    """Rejects rows for which `rejects` (SQL over measures and the text) is true."""

    name: str
    rejects: str


#: A text is rejected by the two base rules, or by one of the method's own.
BASE = (
    Rule("short", f"n_words < {SHORT}"),
    Rule("repeats", f"100 * n_repeat_words > {REPEATS} * n_words"),
)
OWN = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("repeated_lines", "3 * n_dup_lines > n_lines"),
    Rule("capitals", "2 * length(regexp_replace(text, '[^A-Z]+', '')) > word_chars"),
    Rule("letters", r"2 * length(regexp_replace(text, '[^\\p{L}]+', '')) < word_chars"),
)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _BLANKS, " " * len(_BLANKS)), " "), "")


def _repeat_words(w: Column, hashes: Column) -> Column:
    """Words in 5-word windows that are found twice or more."""
    windows = F.sort_array(
        F.transform(
            F.sequence(F.lit(1), F.size(hashes)),
            lambda i: F.struct(F.array_join(F.slice(w, i, 5), " ").alias("g"), i.alias("i")),
        )
    )

    def repeated(windows: Column) -> Column:
        places = F.transform(
            F.filter(
                windows,
                lambda x, k: (x["g"] == F.get(windows, k + 1)["g"]).eqNullSafe(True)
                | (x["g"] == F.get(windows, k - 1)["g"]).eqNullSafe(True),
            ),
            lambda x: x["i"],
        )
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-5).alias("last"))
        return F.aggregate(
            F.sort_array(places),
            start,
            lambda a, p: F.struct(
                (a["n"] + F.least(F.lit(5), p - a["last"])).alias("n"), p.alias("last")
            ),
            lambda a: a["n"],
        )

    # binds the windows once; equal windows have equal hashes, so others need no sorting
    exact = F.transform(F.array(windows), repeated)[0]
    unlike = F.size(hashes) == F.size(F.array_distinct(hashes))
    return F.when(unlike, F.lit(0).cast("long")).otherwise(exact)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long).

    n_lines counts lines with a word. A null text has no words; all measures are 0 then.
    """
    w, h, lines = (free_name(docs, c) for c in ("words", "hashes", "lines"))
    whole = F.coalesce(F.col(text), F.lit(""))
    parts = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    frame = docs.withColumns({w: words(whole), lines: parts})
    windows = F.when(
        F.size(w) >= 5,
        F.transform(
            F.sequence(F.lit(0), F.size(w) - 5),
            lambda i: F.xxhash64(*[F.get(F.col(w), i + k) for k in range(5)]),
        ),
    ).otherwise(F.array().cast("array<long>"))
    frame = frame.withColumn(h, windows)
    return frame.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.char_length(F.array_join(F.col(w), "")).cast("long"),
            "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"),
            "n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": _repeat_words(F.col(w), F.col(h)),
        }
    ).drop(w, h, lines)


def ranked(rows: DataFrame, rules: tuple[Rule, ...], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per second, measured on some `sample_rows` rows of `rows`."""
    total = rows.count()
    share = min(1.0, 1.2 * sample_rows / total) if total else 1.0
    sample = staged(rows.sample(share, seed=7).limit(sample_rows), "sample")
    sample.agg(F.count(F.lit(1))).first()
    worth = {}
    for rule in rules:
        begin = time.perf_counter()
        rejected = sample.agg(F.count_if(F.expr(rule.rejects))).first()[0]
        worth[rule] = rejected / (time.perf_counter() - begin)
    return sorted(rules, key=worth.__getitem__, reverse=True)


def rejected(rules: list[Rule]) -> Column:
    """True at the first rule that rejects a row; CASE leaves the rest unevaluated."""
    chain = None
    for rule in rules:
        test = F.expr(rule.rejects)
        chain = F.when(test, True) if chain is None else chain.when(test, True)
    return F.lit(False) if chain is None else chain.otherwise(False)


def judged(
    docs: DataFrame, base: tuple[Rule, ...] = BASE, own: tuple[Rule, ...] = OWN, text: str = "text"
) -> DataFrame:
    """A row for each row of `docs`: its measures, base_failed and kept.

    All columns of `docs` stay, those named like a measure are replaced. Null and empty texts
    have no words and fail the base; repeated rows are judged alike; empty tables are fine.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    names = (*names, "base_failed", "kept")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in names])
    if text != "text":
        raise ValueError("rules read the column text")
    order = ranked(measured(docs.select("text")), own)
    frame = measured(docs).withColumn("base_failed", rejected(list(base)))
    return frame.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(~rejected(order)))


def report(docs: DataFrame) -> DataFrame:
    return judged(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )
