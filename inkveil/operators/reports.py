"""Counts over the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkveil.functions.grammar import is_name_like


def frequencies(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Replaced spans per plain name; people with the same first name merge.

    Rows are counted per entry before the names are joined, so what meets the entry
    table is at most one row per entry and task.
    """
    counted = rows.groupBy("entry_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.join(
            entries.select(F.col("ord").alias("entry_id"), "plain_name"), "entry_id"
        )
        .groupBy("plain_name")
        .agg(F.sum("n").alias("cnt"))
    )


def by_count(frequency: DataFrame) -> DataFrame:
    """O51."""
    return frequency.orderBy(F.desc("cnt"), "plain_name")


def by_key(associations: DataFrame) -> DataFrame:
    """O51."""
    return associations.orderBy("name_key")


def gate_statistics(blocks: DataFrame, *group: str) -> DataFrame:
    """O52."""
    return blocks.groupBy(*group).agg(
        F.count(F.lit(1)).alias("blocks"),
        F.count_if(is_name_like(F.col("text"))).alias("gated"),
    )


def segment_statistics(segments: DataFrame, block_key: list[str]) -> DataFrame:
    """Number and extent of the segments of each block."""
    return segments.groupBy(*block_key).agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.min("from").alias("first_from"),
        F.max("to").alias("last_to"),
    )
