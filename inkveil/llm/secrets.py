"""Secret scans with corpus-wide ownership frequency.

Candidates of four kinds are located in every text; their values are hashed and counted over
the corpus by distinct owners and repositories. A value that many owners hold is a copied
example; one that a single owner holds and that looks random is likely live. Long mixed words
(kind `value`) are too common to report by form alone: they count only if live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkveil.llm.common import staged

#: kind: pattern, group of the value, least characters of that group
KINDS = {
    "assign": (
        "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
        "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]{24,}", 0, 24),
    "value": ("[A-Za-z0-9+/_=-]{20,}", 0, 20),
}
ORDER = {kind: k for k, kind in enumerate(KINDS)}
BASE = ("assign", "access", "hex")
#: Owners from which on a value is a widely copied example.
COPIED = 3
#: Least distinct characters of a random-looking value; it also has a digit and a letter.
DISTINCT = 8

_FOUND = "array<struct<kind: int, gap: int, size: int, value: string>>"


def _candidates(text: Column) -> Column:
    """All matches in order: their kind, the characters before since the last one, their size."""

    def matches(kind: str) -> Column:
        pattern, group, _ = KINDS[kind]

        def located(gaps: Column, whole: Column, values: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(0), F.size(whole) - 1),
                lambda i: F.struct(
                    F.lit(ORDER[kind]).alias("kind"),
                    F.char_length(F.get(gaps, i)).alias("gap"),
                    F.char_length(F.get(whole, i)).alias("size"),
                    F.get(values, i).alias("value"),
                ),
            )

        parts = F.struct(
            F.split(text, pattern, -1).alias("gaps"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"),
        )
        # a one-element array binds the parts, so they are made once
        bound = F.transform(F.array(parts), lambda p: located(p["gaps"], p["whole"], p["values"]))
        return F.when(text.rlike(pattern), bound[0]).otherwise(F.array().cast(_FOUND))

    return F.concat(*[matches(kind) for kind in KINDS]).cast(_FOUND)


def _located(rows: DataFrame) -> DataFrame:
    """(row, owner, repository, kind, start, end, value): matches of sufficient length."""
    found = rows.select("row", "owner", "repository", F.posexplode("found").alias("k", "m"))
    before = Window.partitionBy("row", "m.kind").orderBy("k")
    placed = found.withColumn("end", F.sum(F.col("m.gap") + F.col("m.size")).over(before)).select(
        "row", "owner", "repository", "m.kind", (F.col("end") - F.col("m.size")).alias("start"),
        "end", "m.value",
    )
    long_enough = F.lit(False)
    for kind, (_, _, least) in KINDS.items():
        long_enough = long_enough | (
            (F.col("kind") == ORDER[kind]) & (F.char_length("value") >= least)
        )
    return placed.filter(long_enough)


def random_looking(value: Column) -> Column:
    return (
        value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & (F.size(F.array_distinct(F.split(value, ""))) >= DISTINCT)
    )


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories): who holds each value, counted over the whole corpus.

    Rows of one value are summed before each shuffle; none is gathered anywhere.
    """
    return (
        found.select("hash", "owner", "repository")
        .distinct()
        .groupBy("hash", "owner")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))
    )


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The rows of `docs` as (row, doc_id), and their spans.

    Spans have row, kind, start, end (code points), value, hash, n_owners, n_repositories,
    status (`live`, `example` or `unclear`) and `reported`: matches of the base kinds always
    are, a `value` only if it is live and overlaps no match of a base kind. Null and empty
    texts have no spans; null owners are one owner. Repeated rows are scanned each for itself.
    """
    rows = staged(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(doc_id).alias("doc_id"),
            F.col(owner).alias("owner"),
            F.col(repository).alias("repository"),
            _candidates(F.coalesce(F.col(text), F.lit(""))).alias("found"),
        ),
        "candidates",
    )
    hashed = F.unhex(F.sha2(F.col("value").cast("binary"), 256))
    found = staged(_located(rows).withColumn("hash", hashed), "matches")
    before = Window.partitionBy("row").orderBy("start", "kind")
    base = F.col("kind") < len(BASE)
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    later = before.rowsBetween(1, Window.unboundedFollowing)
    last_end = F.max(F.when(base, F.col("end"))).over(earlier)
    next_start = F.min(F.when(base, F.col("start"))).over(later)
    apart = (F.coalesce(last_end, F.lit(0)) <= F.col("start")) & (
        F.coalesce(next_start, F.col("end")) >= F.col("end")
    )
    known = found.withColumn("apart", apart).join(ownership(found), "hash")
    status = (
        F.when(F.col("n_owners") >= COPIED, "example")
        .when((F.col("n_owners") == 1) & random_looking(F.col("value")), "live")
        .otherwise("unclear")
    )
    spans = known.withColumn("status", status).withColumn(
        "reported", base | (F.col("apart") & (F.col("status") == "live"))
    )
    return rows.select("row", "doc_id"), spans.drop("apart", "owner", "repository")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


def report(docs: DataFrame, **names) -> DataFrame:
    """A row for each row of `docs`: counts and spans; n_live and n_example by status."""
    rows, spans = scan(docs, **names)
    counted = {
        f"n_{kind}": F.count_if(F.col("kind") == ORDER[kind]).alias(f"n_{kind}") for kind in BASE
    }
    by_row = (
        spans.filter("reported")
        .groupBy("row")
        .agg(
            F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"),
            *counted.values(),
            F.count_if(F.col("status") == "live").alias("n_live"),
            F.count_if(F.col("status") == "example").alias("n_example"),
        )
    )
    joined = rows.join(by_row, "row", "left")
    none = F.array().cast("array<struct<start: bigint, kind: int, end: bigint>>")
    every = F.coalesce(F.col("spans"), none)
    plain = F.filter(every, lambda s: s["kind"] < len(BASE))
    return joined.select(
        "doc_id",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counted],
        F.sha2(_joined(plain).cast("binary"), 256).alias("base_sha256"),
        _joined(every).alias("spans"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_live", "n_example")],
    )
