"""Document fingerprints from spots: common words and the content words that follow them.

Every common word of a text (an anchor) opens a chain of the content words after it, other
common words skipped; so does the text's beginning. The set of chains is the document's
fingerprint: running text is full of anchors, lists and navigation are not. Fingerprints are
compared by the Jaccard similarity of their sets. Two sets that reach a similarity cannot
differ in length by more than its inverse: partitions of lengths are that wide, only equal or
neighbouring ones are compared, and of these only pairs whose lengths allow the similarity.

All of it is column functions and joins. The document after each one in order of ids is found
without a sort of all rows in one task: ids are cut into chunks at quantiles, and each chunk
gets a copy of the first row of the next.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkveil.functions.spans import bind

# common words that open a chain: English, German, French, Spanish
ANCHORS = (
    "the of and to a in is that for it was on with be as by this are at from or an not have has "
    "der die und in den von zu das sich mit auf des für ist nicht im dem ein eine als auch "
    "de la le et les des en un du une que pour est qui dans par pas au sur avec ne "
    "el y los se del las por no con su para al lo es más"
)
CHAIN = 2
DISTANCE = 1
#: Letters and digits, and all that is not ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Similarities below this are told as 0 without a look at the sets.
LEAST = 0.02
#: Rows to a chunk of ids; with more than MOST_CHUNKS chunks they become larger.
CHUNK_ROWS = 4096
MOST_CHUNKS = 1 << 16


def signatures(
    text: Column, anchors: str = ANCHORS, chain: int = CHAIN, distance: int = DISTANCE
) -> Column:
    """The sorted set of a text's chains, each as a hash (array<long>).

    A chain has `chain` content words, every `distance`-th after its anchor, or as many as the
    text still has. Anchors behind the last content word open none. A text of common words only
    has one signature of all of them, a text without words none. Words are told apart in lower
    case.
    """
    common = sorted(set(anchors.split()))
    none = F.array().cast("array<long>")

    def chains(words: Column, at: Column) -> Column:
        """`at` are the places of content words."""

        def opened(place: Column, k: Column) -> Column:
            before = F.when(k == 0, F.lit(-1)).otherwise(F.get(at, k - 1))
            follow = [F.get(words, F.get(at, k + i * distance)) for i in range(chain)]
            own = F.transform(
                F.slice(words, before + 2, place - before - 1), lambda a: F.xxhash64(a, *follow)
            )
            beginning = F.array(F.xxhash64(F.lit(""), *follow))
            return F.when(k == 0, F.concat(beginning, own)).otherwise(
                F.when(place - before > 1, own).otherwise(none)
            )

        return F.sort_array(F.array_distinct(F.flatten(F.transform(at, opened))))

    def places(words: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(0), F.size(words) - 1), lambda i: ~F.get(words, i).isin(*common)
        )

    def of_words(words: Column) -> Column:
        return F.when(
            F.size(words) > 0,
            bind(
                places(words),
                lambda at: F.when(F.size(at) > 0, chains(words, at)).otherwise(
                    F.array(F.xxhash64(F.array_join(words, " ")))
                ),
            ),
        ).otherwise(none)

    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))
    return bind(found, of_words)


def fingerprint(spots: Column) -> Column:
    """A name for a set of signatures: equal sets have equal names."""
    return F.sha2(F.array_join(spots.cast("array<string>"), ",").cast("binary"), 256)


def partition(size: Column, least: float) -> Column:
    """The partition of a set's length: sets alike by `least` are in the same one or neighbours."""
    return F.floor(F.log(F.greatest(size, F.lit(1))) / F.lit(-math.log(least)) + 1e-9)


def likeness(a: Column, b: Column, least: float = LEAST) -> Column:
    """The Jaccard similarity of two sets, 0 where it is below `least`; of two empty sets 1."""
    m, n = F.size(a), F.size(b)
    near = F.abs(partition(m, least) - partition(n, least)) <= 1
    # no more can be common than the smaller one has
    possible = near & (F.least(m, n) >= F.lit(least) * F.greatest(m, n))
    exact = bind(F.size(F.array_intersect(a, b)), lambda both: both / (m + n - both))
    return (
        F.when((m == 0) & (n == 0), 1.0)
        .when((m == 0) | (n == 0) | ~possible, 0.0)
        .otherwise(bind(exact, lambda x: F.when(x >= least, x).otherwise(0.0)))
    )


def _counted(bounds: Column, steps: int, fits) -> Column:
    """How many of the sorted `bounds` fit, the first ones, by halving."""
    return F.aggregate(
        F.lit([1 << s for s in reversed(range(steps))]),
        F.lit(0),
        lambda done, step: F.when(fits(F.get(bounds, done + step - 1)), done + step).otherwise(done),
    )


def _chunk(rows: DataFrame, size: int) -> Column:
    """The number of a row's chunk, which never falls in order of (id, hash), nulls last.

    An id that many rows have is a bound several times over; its rows are dealt to all those
    chunks by their hashes.
    """
    chunks = min(max(rows.count() // size, 1), MOST_CHUNKS)
    if chunks == 1:
        return F.lit(0)
    key = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    shares = F.lit([k / chunks for k in range(1, chunks)])
    found = rows.agg(F.percentile_approx(key, shares, max(10_000, 4 * chunks)).alias("b")).first()[0]
    bounds = F.from_json(F.lit(json.dumps(sorted(found))), "array<long>")
    steps = len(found).bit_length()
    low = _counted(bounds, steps, lambda b: b < key)
    high = _counted(bounds, steps, lambda b: b <= key)
    part = F.call_function("shiftrightunsigned", F.col("h"), F.lit(11)) / F.lit(float(1 << 53))
    return bind(
        low, lambda lo: bind(high, lambda hi: (lo + F.floor(part * (hi - lo + 1))).cast("int"))
    )


def next_rows(docs: DataFrame, doc_id: str, text: str, size: int = CHUNK_ROWS) -> tuple:
    """Rows `doc_id, text` in chunks with `copy` (true for a row that only stands behind the
    chunk before its own), and the window in which the row behind each one is its successor.

    Rows of equal ids are in order of the hash of their texts, null ids come last; behind the
    last row stands the first.
    """
    plain = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")
    ).withColumn("h", F.xxhash64("text"))
    placed = plain.withColumn("chunk", _chunk(plain.select("doc_id", "h"), size))
    # the first row of each chunk, and the chunk before it; no more rows than chunks
    around = Window.orderBy("chunk")
    first = (
        placed.groupBy("chunk")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "h")).alias("first"))
        .select(
            F.col("chunk").alias("c"),
            "first",
            F.coalesce(
                F.lag("chunk").over(around), F.max("chunk").over(around.rowsBetween(
                    Window.unboundedPreceding, Window.unboundedFollowing))
            ).alias("before"),
        )
    )
    same = (
        (F.col("chunk") == F.col("c"))
        & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
        & (F.col("h") == F.col("first.h"))
    )
    own = F.struct(F.col("chunk").alias("chunk"), F.lit(False).alias("copy"))
    other = F.struct(F.col("before").alias("chunk"), F.lit(True).alias("copy"))
    twice = placed.join(F.broadcast(first), same, "left").select(
        "doc_id",
        "text",
        "h",
        F.explode(F.when(F.col("c").isNull(), F.array(own)).otherwise(F.array(own, other))).alias("at"),
    )
    order = Window.partitionBy("chunk").orderBy("copy", F.col("doc_id").asc_nulls_last(), "h")
    return twice.select("doc_id", "text", "h", "at.*"), order


def report(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least: float = LEAST,
    size: int = CHUNK_ROWS,
) -> DataFrame:
    """For each row of `docs`: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_signatures.

    The edited text has its last quarter of characters replaced by as many from the beginning
    of the next document, or all it has. A null text counts as empty. Texts without words have
    the empty set for a fingerprint; two of them are alike by 1, one and any other text by 0.
    Repeated rows each count, null ids stay; for their order see `next_rows`. A single row is
    its own successor. Other columns are ignored; an empty table gives an empty result.
    """
    rows, order = next_rows(docs, doc_id, text, size)
    chars = F.length("text")
    cut = F.floor(chars / 4).cast("int")
    edited = F.concat(
        F.col("text").substr(F.lit(1), chars - cut), F.col("next").substr(F.lit(1), cut)
    )
    made = rows.withColumn("next", F.lead("text").over(order)).select(
        "doc_id", "h", "chunk", "copy",
        chars.cast("long").alias("n_chars"),
        F.col("text"),
        F.when(~F.col("copy"), edited).alias("edited"),
    )
    spotted = made.select(
        "doc_id", "h", "chunk", "copy", "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        signatures(F.col("text")).alias("spots"),
        signatures(F.col("edited")).alias("edited_spots"),
    )
    return (
        spotted.withColumn("next_spots", F.lead("spots").over(order))
        .filter(~F.col("copy"))
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            fingerprint(F.col("spots")).alias("fingerprint"),
            fingerprint(F.col("edited_spots")).alias("edited_fingerprint"),
            likeness(F.col("spots"), F.col("edited_spots"), least).alias("near_edited"),
            likeness(F.col("spots"), F.col("next_spots"), least).alias("near_next"),
            F.size("spots").alias("n_signatures"),
        )
    )
