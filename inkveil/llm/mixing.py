"""Mixing sources by temperature, realised as budgeted block permutations.

A source's weight is its share of all tokens to a power between 0 (all sources alike) and 1
(as they are); the power is found by bisection so that the weights have a target entropy, or
that no source is repeated more often than a limit. Every source then gets its part of the
token budget: whole epochs, each a permutation of its blocks and of the rows inside them, and
one epoch cut short. Where that cut falls is a bound on hash values, one for each source, so
rows are chosen in the scan, without a shuffle of texts. The scan leaves rows where they are;
hashes of block and row, anew for each epoch, say where a row stands in an epoch's permutation.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkveil.llm.common import free_name, staged
from inkveil.llm.quality import words

#: Most epochs of a source, relative to the one repeated least.
MOST_EPOCHS = 1.5
#: Sources whose numbers fit the driver easily; a row of a few numbers each.
MOST_SOURCES = 1_000_000
_STEPS = 200
_PLAN = (
    "source string, full long, rest long, blocks long, cut_block_hash long, cut_block long, "
    "cut_hash long"
)


def weights(tokens: list[int], power: float) -> list[float]:
    """Shares to a power, normalised; sources without tokens weigh nothing."""
    top = max(tokens, default=0)
    raised = [(t / top) ** power if t else 0.0 for t in tokens]
    total = sum(raised)
    return [r / total if total else 0.0 for r in raised]


def entropy(values: list[float]) -> float:
    """In bits."""
    return -sum(v * math.log2(v) for v in values if v)


def least_budget(tokens: list[int], mix: list[float]) -> float:
    """The fewest tokens in which every source is seen once in whole."""
    return max((t / w for t, w in zip(tokens, mix, strict=True) if w), default=0.0)


def most_epochs(tokens: list[int], mix: list[float], budget: float | None) -> float:
    budget = least_budget(tokens, mix) if budget is None else budget
    return max((w * budget / t for t, w in zip(tokens, mix, strict=True) if t), default=0.0)


def power_for(
    tokens: list[int],
    limit: float | None = MOST_EPOCHS,
    target: float | None = None,
    budget: float | None = None,
) -> float:
    """The power that meets the target entropy, or the least that keeps the repetition limit.

    A target beyond what powers from 0 to 1 can reach gives the nearer end; so does a limit
    that even the sources as they are exceed.
    """

    def low_enough(power: float) -> bool:
        mix = weights(tokens, power)
        if target is not None:
            return entropy(mix) <= target
        return most_epochs(tokens, mix, budget) <= limit * (1 + 1e-12)

    low, high = 0.0, 1.0
    if low_enough(low):
        return low
    for _ in range(_STEPS):
        middle = (low + high) / 2
        low, high = (low, middle) if low_enough(middle) else (middle, high)
    return high


@dataclass(frozen=True)
class Keys:
    """The hashes that order a table's rows."""

    row: Column
    seed: int

    def block(self, blocks: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(self.seed), self.row), blocks)

    def block_order(self, source: Column, block: Column, epoch: Column) -> Column:
        return F.xxhash64(F.lit(self.seed + 1), source, block, epoch)

    def order(self, epoch: Column) -> Column:
        return F.xxhash64(F.lit(self.seed + 2), self.row, epoch)


def _source_key(source: str) -> Column:
    """A name that is never null: null is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def _row_hash(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.col(text))


def token_count(text: Column) -> Column:
    """Words between white space; null has none."""
    return F.size(words(F.coalesce(text, F.lit("")))).cast("long")


def plan(
    docs: DataFrame,
    doc_id: str,
    text: str,
    source: str,
    limit: float | None,
    target: float | None,
    budget: int | None,
    seed: int,
) -> DataFrame:
    """A row for each source: its whole epochs and where its last one ends.

    A source of n rows has some sqrt(n) blocks of some sqrt(n) rows: the cut is found by a
    running sum over blocks, then one over the rows of a single block.
    """
    spark = docs.sparkSession
    rows = staged(
        docs.select(
            _source_key(source).alias("source"),
            _row_hash(doc_id, text).alias("hash"),
            token_count(F.col(text)).alias("n"),
        ),
        "tokens",
    )
    sizes = rows.groupBy("source").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    found = sorted(map(tuple, sizes.limit(MOST_SOURCES + 1).collect()))
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    tokens = [r[1] for r in found]
    mix = weights(tokens, power_for(tokens, limit, target, budget))
    whole = least_budget(tokens, mix) if budget is None else budget
    table = []
    for (name, n, count), weight in zip(found, mix, strict=True):
        # sources without tokens cost nothing and are kept once
        full, rest = divmod(round(weight * whole), n) if n else (1, 0)
        table.append((name, full, rest, math.isqrt(max(count - 1, 0)) + 1))
    shares = spark.createDataFrame(table, "source string, full long, rest long, blocks long")
    keys = Keys(F.col("hash"), seed)
    placed = rows.join(F.broadcast(shares.filter("rest > 0")), "source").select(
        "source", "hash", "n", "full", "rest", keys.block(F.col("blocks")).alias("block")
    )
    blocks = placed.groupBy("source", "full", "rest", "block").agg(F.sum("n").alias("n"))
    at = keys.block_order(F.col("source"), F.col("block"), F.col("full"))
    by_block = Window.partitionBy("source").orderBy("at", "block")
    cuts = staged(
        blocks.withColumn("at", at)
        .withColumn("upto", F.sum("n").over(by_block))
        .filter("upto > rest AND upto - n <= rest")
        .groupBy("source")  # blocks without tokens may share the place
        .agg(F.min(F.struct("upto", "at", "block", "n")).alias("cut"))
        .selectExpr("source", "cut.at", "cut.block", "cut.upto - cut.n AS before"),
        "cuts",
    )
    inside = placed.join(F.broadcast(cuts), ["source", "block"]).select(
        "source",
        "n",
        (F.col("rest") - F.col("before")).alias("left"),
        keys.order(F.col("full")).alias("key"),
    )
    by_row = Window.partitionBy("source").orderBy("key").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    last = (
        inside.withColumn("upto", F.sum("n").over(by_row))
        .filter("upto <= left")
        .groupBy("source")
        .agg(F.max("key").alias("cut_hash"))
    )
    joined = shares.join(cuts, "source", "left").join(last, "source", "left")
    # a row for each source
    rows = joined.select("source", "full", "rest", "blocks", "at", "block", "cut_hash").collect()
    return spark.createDataFrame(rows, _PLAN)


def mixed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    epoch: str | None = None,
    block: str | None = None,
    block_order: str | None = None,
    row_order: str | None = None,
    limit: float | None = MOST_EPOCHS,
    target: float | None = None,
    budget: int | None = None,
    seed: int = 17,
) -> DataFrame:
    """The rows of `docs`, each as often as its source's epochs take it; all columns stay.

    `limit` bounds the epochs of a source, or `target` sets the entropy of the weights (bits).
    Without a `budget` (tokens) the least one is taken in which no row is left out. `epoch` and
    `block` name columns to add: which epoch a row belongs to, from 0, and its block; so do
    `block_order` and `row_order` for the place of its block among those of its source in that
    epoch, and its own in the block: a source's epoch is its rows sorted by block_order, block
    and row_order.

    Tokens are words. A null source is a source of its own. Null and empty texts cost nothing;
    they come with the whole epochs, and in a cut one as their place says. Rows equal in id
    and text are taken or left together in a cut epoch. An empty table gives an empty result.
    """
    shares = plan(docs, doc_id, text, source, limit, target, budget, seed)
    names = {c: free_name(docs, f"mix_{c}") for c in shares.columns}
    shares = shares.select(*[F.col(c).alias(n) for c, n in names.items()])
    p = {c: F.col(n) for c, n in names.items()}
    keys = Keys(_row_hash(doc_id, text), seed)
    own = keys.block(p["blocks"])
    at = keys.block_order(p["source"], own, p["full"])
    before = (at < p["cut_block_hash"]) | ((at == p["cut_block_hash"]) & (own < p["cut_block"]))
    inside = (own == p["cut_block"]) & (keys.order(p["full"]) <= p["cut_hash"])
    taken = p["full"] + F.when((p["rest"] > 0) & (before | inside), 1).otherwise(0)
    # at most MOST_SOURCES rows of seven numbers
    joined = docs.join(F.broadcast(shares), _source_key(source) == p["source"])
    turn, place = free_name(joined, "mix_epoch"), free_name(joined, "mix_block")
    hashed = free_name(joined, "mix_hash")
    named = {
        epoch: F.col(turn),
        block: F.col(place),
        block_order: keys.block_order(p["source"], F.col(place), F.col(turn)),
        row_order: Keys(F.col(hashed), seed).order(F.col(turn)),
    }
    kept = [c for c in docs.columns if c not in named]
    epochs = F.sequence(F.lit(0).cast("long"), p["full"] - 1)
    return (
        joined.withColumn(names["full"], taken)
        .withColumn(place, own)
        .filter(p["full"] > 0)
        .select(
            *kept,
            place,
            names["source"],
            *([keys.row.alias(hashed)] if row_order else []),
            F.explode(epochs).alias(turn),
        )
        .select(*kept, *[c.alias(name) for name, c in named.items() if name])
    )


def report(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, source, n_tokens, epoch, block and place: a row for each time one is taken.

    block_order, block and row_order sort a source's epoch.
    """
    orders = {c: c for c in ("epoch", "block", "block_order", "row_order")}
    found = mixed(docs.select("doc_id", "text", "source"), **orders, **settings)
    return found.select("doc_id", "source", token_count(F.col("text")).alias("n_tokens"), *orders)
