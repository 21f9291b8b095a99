"""Connected components of links, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkveil.llm.common import merged, staged

LOW, HIGH = "low", "high"


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias(LOW), F.greatest(a, b).alias(HIGH)]


def _summary(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64(LOW, HIGH)), F.bit_xor(F.xxhash64(HIGH, LOW))
        ).first()
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least of its neighbourhood."""
    both = links.select(F.col(LOW).alias("u"), F.col(HIGH).alias("v")).unionAll(
        links.select(F.col(HIGH).alias("u"), F.col(LOW).alias("v"))
    )
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return merged(both.filter("v > u"), least, "u").select(*_ordered("v", "m")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them."""
    least = links.groupBy(F.col(HIGH).alias("u")).agg(F.min(LOW).alias("m"))
    towards = merged(links.select(F.col(HIGH).alias("u"), F.col(LOW).alias("v")), least, "u")
    return (
        towards.filter("v > m")
        .select(*_ordered("v", "m"))
        .unionAll(least.select(F.col("m").alias(LOW), F.col("u").alias(HIGH)))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) for all nodes of `links` (low, high): the root is the least node reachable.

    Rounds of narrow joins, each written to the shared folder; their number grows with the
    logarithm of the longest chain. Minima are summed before the shuffle, so a node with a
    third of the links is no more than a row per task; no task or driver holds a component.
    Links of a node to itself, repeated links and an empty table are fine.
    """
    links = staged(links.select(*_ordered(LOW, HIGH)).filter(f"{LOW} < {HIGH}"), "links")
    before = None
    while (now := _summary(links)) != before and now[0]:
        before = now
        links = staged(_small_star(_large_star(links)), "links")
    return links.select(F.col(HIGH).alias("node"), F.col(LOW).alias("root")).unionAll(
        links.select(F.col(LOW).alias("node"), F.col(LOW).alias("root")).distinct()
    )
