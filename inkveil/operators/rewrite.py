"""Replacement of spans in blocks and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkveil.functions import pseudonyms, spans
from inkveil.operators.assembly import PIECES_PER_CHUNK
from inkveil.operators.pseudonyms import with_pseudonyms

EDITS = "array<struct<start:int,end:int,ord:bigint,matched:string,name_key:string,replacement:string>>"


def matched(text: Column, span: Column) -> Column:
    return text.substr(span["start"] + 1, span["end"] - span["start"])


def edits(text: Column, found: Column, scheme: str, salt: str | int | None) -> Column:
    """Spans to replace, with name key and ID (O45 `listed`, O46 `hash`)."""
    if scheme == "hash" and salt is None:
        raise ValueError("hash pseudonyms need a salt")
    if scheme not in ("listed", "hash", "lettered"):
        raise ValueError(f"unknown ID scheme {scheme!r}")

    def edit(span: Column, piece: Column) -> Column:
        return spans.bind(
            pseudonyms.name_key(piece),
            lambda key: F.struct(
                span["start"].alias("start"),
                span["end"].alias("end"),
                span["ord"].alias("ord"),
                piece.alias("matched"),
                key.alias("name_key"),
                (
                    pseudonyms.hash_id(key, salt)
                    if scheme == "hash"
                    else pseudonyms.listed_id(span["ord"])
                    if scheme == "listed"
                    else F.lit(None).cast("string")
                ).alias("replacement"),
            ),
        )

    return spans.bind(
        F.filter(found, lambda s: s["status"] == "replaced"),
        lambda some: F.zip_with(some, spans.cuts(text, some), edit),
    )


def with_edits(
    blocks: DataFrame, scheme: str = "listed", salt: str | int | None = None
) -> DataFrame:
    """Add `edits` to blocks with `found`."""
    return blocks.withColumn("edits", edits(F.col("text"), F.col("found"), scheme, salt))


def with_edits_from(blocks: DataFrame, keys: list[str], rows: DataFrame) -> DataFrame:
    """Add `edits` to blocks from a table of edits."""
    edit = F.struct("start", "end", F.col("entry_id").alias("ord"), "matched", "name_key", "replacement")
    grouped = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(edit)).alias("edits"))
    return blocks.join(grouped, keys, "left").withColumn(
        "edits", F.coalesce("edits", spans.empty(EDITS))
    )


def lettered_rows(rows: DataFrame, keys: list[str], ids: DataFrame) -> DataFrame:
    """Edits with the IDs of `lettered_ids`."""
    return with_pseudonyms(rows.drop("replacement"), ids, [*keys, "start"]).withColumnRenamed(
        "pseudonym", "replacement"
    )


def redacted(blocks: DataFrame) -> DataFrame:
    """Replace `text` of blocks with `edits`."""
    return blocks.withColumn("text", spans.rebuild(F.col("text"), F.col("edits")))


def unfold(blocks: DataFrame, keys: list[str], spans_column: str) -> DataFrame:
    """`keys, s` for every element of a span column.

    An outer explode followed by a filter: for a plain explode Spark adds a size test
    below it, which would evaluate the search behind the column a second time.
    """
    return blocks.select(*keys, F.explode_outer(spans_column).alias("s")).filter(
        F.col("s").isNotNull()
    )


def audit(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Every span found, with its text and status."""
    told = spans.bind(
        F.col("found"),
        lambda some: F.zip_with(
            some,
            spans.cuts(F.col("text"), some),
            lambda s, part: F.struct(
                s["start"].alias("start"),
                s["end"].alias("end"),
                part.alias("matched"),
                s["ord"].alias("entry_id"),
                s["status"].alias("status"),
            ),
        ),
    )
    return unfold(blocks.select(*keys, told.alias("told")), keys, "told").select(*keys, "s.*")


def full_audit(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Every span found, with one of four statuses and what became of it.

    `replaced` and `protected` are as in `audit`. A replaced span of a block with `segments`
    that starts in none of them is an `orphan`: it has no place to be written back to. Blocks
    searched with `report_shadowed` also tell the `shadowed` ones, and `beaten_by` names the
    entry whose replacement each of them touches, the first in the list if there are several.
    """
    won = lambda some: F.filter(some, lambda s: s["status"] == "replaced")
    with_segments = "segments" in blocks.columns

    def homeless(s: Column) -> Column:
        if not with_segments:
            return F.lit(False)
        return ~F.exists(
            F.col("segments"), lambda g: (s["start"] >= g["from"]) & (s["start"] < g["to"])
        )

    def told(some: Column, winners: Column) -> Column:
        def row(s: Column, part: Column) -> Column:
            rivals = F.filter(winners, lambda w: spans.touches(s, w))
            beaten = F.array_min(F.transform(rivals, lambda w: w["ord"]))
            orphan = (s["status"] == "replaced") & homeless(s)
            return F.struct(
                s["start"].alias("start"),
                s["end"].alias("end"),
                part.alias("matched"),
                s["ord"].alias("entry_id"),
                F.when(orphan, F.lit("orphan")).otherwise(s["status"]).alias("status"),
                F.when(s["status"] == "shadowed", beaten).alias("beaten_by"),
            )

        return F.zip_with(some, spans.cuts(F.col("text"), some), row)

    rows = spans.bind(
        F.col("found"), lambda some: spans.bind(won(some), lambda w: told(some, w))
    )
    return unfold(blocks.select(*keys, rows.alias("told")), keys, "told").select(*keys, "s.*")


def edit_rows(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """One row per replaced span."""
    return (
        unfold(blocks, keys, "edits").select(*keys, "s.*").withColumnRenamed("ord", "entry_id")
    )


def orphans(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Replaced spans that start in no segment of their block."""
    lost = F.filter(
        "edits",
        lambda e: ~F.exists(
            F.col("segments"), lambda s: (e["start"] >= s["from"]) & (e["start"] < s["to"])
        ),
    )
    return blocks.select(*keys, F.explode(lost).alias("e")).select(*keys, "e.*")


def segment_edits(blocks: DataFrame) -> DataFrame:
    """Add `new_segments` (new offsets) and `new_text` to blocks with
    `segments` and `edits`, both in offsets of the stored text."""
    changed = F.size("edits") > 0
    return blocks.withColumn(
        "new_segments",
        F.when(changed, spans.remap(F.col("segments"), F.col("edits"))).otherwise(
            F.col("segments")
        ),
    ).withColumn("new_text", spans.rebuild(F.col("text"), F.col("edits")))


def segment_rows(blocks: DataFrame, keys: list[str], *node: str) -> DataFrame:
    """One row per segment with old and new offsets and its new text, in keyed
    (never positional) order. `node` names further fields of the segments; offsets are
    those of the block if there are a `base` and `new_base`, else of the stored text."""
    old, new = F.col("z.segments"), F.col("z.new_segments")
    base = F.col("base") if "base" in blocks.columns else F.lit(0)
    new_base = F.col("new_base") if "new_base" in blocks.columns else F.lit(0)
    places = F.transform(
        "new_segments", lambda s: F.struct(s["from"].alias("start"), s["to"].alias("end"))
    )
    return blocks.withColumn("_parts", spans.cuts(F.col("new_text"), places)).select(
        *keys,
        base.alias("base"),
        new_base.alias("new_base"),
        F.explode(F.arrays_zip("segments", "new_segments", "_parts")).alias("z"),
    ).select(
        *keys,
        old["seg_idx"].alias("seg_idx"),
        (F.col("base") + old["from"]).alias("from"),
        (F.col("base") + old["to"]).alias("to"),
        (F.col("new_base") + new["from"]).alias("new_from"),
        (F.col("new_base") + new["to"]).alias("new_to"),
        F.col("z._parts").alias("text"),
        *[old[c].alias(c) for c in node],
    )


def piece_offsets(pieces: DataFrame, block_key: list[str], piece: str, length: Column) -> DataFrame:
    """Add `new_base`, the start of each piece in its rewritten block."""
    chunked = pieces.withColumn("_len", length).withColumn(
        "_chunk", F.floor(F.col(piece) / PIECES_PER_CHUNK)
    )
    inside = (
        Window.partitionBy(*block_key, "_chunk")
        .orderBy(piece)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = (
        Window.partitionBy(*block_key)
        .orderBy("_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = (
        chunked.groupBy(*block_key, "_chunk")
        .agg(F.sum("_len").alias("_sum"))
        .withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .drop("_sum")
    )
    return (
        chunked.withColumn("_in", F.coalesce(F.sum("_len").over(inside), F.lit(0)))
        .join(bases, [*block_key, "_chunk"])
        .withColumn("new_base", F.col("_base") + F.col("_in"))
        .drop("_chunk", "_len", "_in", "_base")
    )
