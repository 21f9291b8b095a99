"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is cut into segments; the bit counts of the segments are a point of a
small integer grid. Flipping a bit moves the point by one step, so the Manhattan distance of
two points never exceeds the Hamming distance of the fingerprints. Two points at most two
steps apart share a grid cell at most one step from both: each fingerprint is put into its
own cell and those one step away, cells are joined, and pairs are verified exactly.

Copies are collapsed to one row per fingerprint before anything is joined. A crowded cell is
not paired up: its members meet at the (up to 65) values one flipped bit away, which two
fingerprints share just if they differ by at most two bits, so links stay linear in members.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.llm.common import free_name, merged, raw, resident, staged, word_blocks
from inkveil.llm.components import HIGH, LOW, components

SHINGLE = 3
SEED = 42
SEGMENT_BITS = 4
#: Cells with more members are linked through shared one-bit neighbours instead of pairs.
CROWDED = 64


def fingerprint(text: bytes | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """The 64 majority bits of the hashes of a text's shingles, as an unsigned number.

    A text of fewer words is one shingle; without words (or null) the result is 0.
    """
    set_bits, total, carried = np.zeros(64, np.int64), 0, []
    for words in word_blocks((text or b"").lower()):
        words = carried + words
        carried = words[-(width - 1) :] if width > 1 else []
        if len(words) < width:
            continue
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(s, seed) for s in shingles), np.uint64, len(words) - width + 1
        )
        set_bits += np.unpackbits(
            hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        ).sum(axis=0, dtype=np.int64)
        total += len(hashes)
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(carried), seed) if carried else 0
    bits = (2 * set_bits > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, width: int = SHINGLE, seed: int = SEED) -> Column:
    """`fingerprint` of a text column as a (signed) long."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        resident("fingerprints", lambda: None)
        values = (fingerprint(t, width, seed) for t in raw(texts))
        return pa.array(np.fromiter(values, np.uint64, len(texts)).view(np.int64))

    return run(text)


def _cells(value: Column) -> Column:
    """The packed bit counts of the segments, and the cells one step away inside the grid."""
    segments = F.sequence(F.lit(0), F.lit(64 // SEGMENT_BITS - 1))
    mask = (1 << SEGMENT_BITS) - 1

    def count(i: Column) -> Column:
        part = F.call_function("shiftrightunsigned", value, i * SEGMENT_BITS)
        return F.bit_count(part.bitwiseAND(F.lit(mask).cast("long"))).cast("long")

    def step(i: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), i * SEGMENT_BITS)

    own = F.aggregate(segments, F.lit(0).cast("long"), lambda sum_, i: sum_ + count(i) * step(i))
    up = F.transform(F.filter(segments, lambda i: count(i) < SEGMENT_BITS), step)
    down = F.transform(F.filter(segments, lambda i: count(i) > 0), lambda i: -step(i))
    steps = F.concat(F.array(F.lit(0).cast("long")), up, down)
    return F.transform(F.array(own), lambda cell: F.transform(steps, lambda s: cell + s))[0]


def near_links(values: DataFrame, value: str, crowded: int = CROWDED) -> DataFrame:
    """Links (low, high) that connect any two of the distinct `values` at most two bits apart.

    Between values of crowded cells a link may lead over a value that no row has.
    """
    placed = values.select(F.col(value).alias("v"), F.explode(_cells(F.col(value))).alias("cell"))
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = staged(merged(placed, sizes, "cell"), "cells")
    near = lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= 2
    pairs = (
        shared.filter(F.col("n") <= crowded)
        .groupBy("cell")
        .agg(F.sort_array(F.collect_list("v")).alias("vs"))
        .select("vs", F.explode("vs").alias(LOW))
        .select(
            LOW,
            F.explode(
                F.filter("vs", lambda v: (v > F.col(LOW)) & near(v, F.col(LOW)))
            ).alias(HIGH),
        )
    )
    flips = F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda i: F.col("v").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)),
    )
    met = (
        shared.filter(F.col("n") > crowded)
        .select("v")
        .distinct()
        .select("v", F.explode(F.concat(F.array("v"), flips)).alias("at"))
    )
    hubs = met.groupBy("at").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("at")
    stars = merged(met, hubs, "at").select(
        F.least("v", "at").alias(LOW), F.greatest("v", "at").alias(HIGH)
    )
    return pairs.unionAll(stars.filter(f"{LOW} < {HIGH}")).distinct()


def classes(marked: DataFrame, fp: str, doc_id: str, crowded: int = CROWDED) -> DataFrame:
    """(fp, component_id) for each distinct fingerprint of `marked`.

    component_id is the smallest non-null id of all rows whose fingerprints can be reached by
    links of two bits or fewer; null if all of them are null.
    """
    values = staged(
        marked.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("least_id")), "values"
    )
    roots = staged(components(near_links(values, "fp", crowded)), "roots")
    linked = merged(values, roots, F.col("fp") == F.col("node"), how="left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    least = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return linked.join(least, "root").select("fp", "component_id")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", crowded: int = CROWDED
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, a row for each row of `docs`.

    Null and empty texts, or those of white space only, have fingerprint zero and are linked
    like any other. Repeated rows and repeated ids stay as they are; null ids join components
    but never name one, unless all ids are null. Other columns are ignored. An empty table
    gives an empty result.
    """
    marked = staged(
        docs.select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text)).alias("fp")), "marked"
    )
    named = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(classes(marked, "fp", "doc_id", crowded), "fp").select(
        "doc_id", named.alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each component: the smallest id, any one row of equal ids.

    All columns stay, whatever their names. Null ids come last.
    """
    fp, row = free_name(docs, "fp"), free_name(docs, "row")
    marked = staged(
        docs.withColumns({row: F.monotonically_increasing_id(), fp: fingerprints(F.col(text))}),
        "documents",
    )
    narrow = marked.select(
        F.col(row).alias("row"), F.col(doc_id).alias("id"), F.col(fp).alias("fp")
    )
    first = F.min(F.struct(F.col("id").isNull(), "id", "row"))["row"]
    # the class of fingerprints is named by its root, as ids may be null or repeated
    kept = (
        narrow.join(class_roots(narrow, "fp"), "fp")
        .groupBy("root")
        .agg(first.alias(row))
        .select(row)
    )
    return marked.join(kept, row, "left_semi").select(*docs.columns)


def class_roots(marked: DataFrame, fp: str, crowded: int = CROWDED) -> DataFrame:
    """(fp, root): a fingerprint that names the class, for each distinct one of `marked`."""
    values = staged(marked.select(F.col(fp).alias("fp")).distinct(), "values")
    roots = staged(components(near_links(values, "fp", crowded)), "roots")
    return merged(values, roots, F.col("fp") == F.col("node"), how="left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )
