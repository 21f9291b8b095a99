"""IDs that need the whole corpus (O35) and tables of names."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkveil.functions.pseudonyms import ID_LETTERS, lettered_id

HOT_ROWS = 1_000_000
# nominatives sent to all executors at most: a row of two short strings each
HOT_KEYS = 10_000


def lettered_ids(
    rows: DataFrame, order: list[str], known: DataFrame | None = None
) -> DataFrame:
    """`name_key, dict_id, rank, pseudonym, n` from rows with `entry_id, name_key` and the
    columns `order` that fix where a nominative comes first; `n` counts its rows.

    A nominative has one ID, that of the dictionary name it was first found with. Only
    ranks that have a letter of their own are computed; a filter on the row number lets
    Spark drop the others before the shuffle, so a first name shared by very many
    nominatives fills no single task.

    `known` are IDs of earlier batches (`name_key, dict_id, rank`). Their nominatives keep
    dictionary name and rank; new ones take the ranks after the last of their dictionary name.
    """
    first = rows.groupBy("name_key").agg(
        F.min(F.struct(*order, "entry_id")).alias("first"), F.count(F.lit(1)).alias("n")
    ).withColumn("dict_id", F.col("first.entry_id"))
    last = len(ID_LETTERS)
    place = F.row_number().over(Window.partitionBy("dict_id").orderBy("first", "name_key"))
    if known is None:
        fresh = first
    else:
        old = known.select("name_key", F.col("dict_id").alias("_dict"), F.col("rank").alias("_old"))
        first = first.join(old, "name_key", "left").withColumn(
            "dict_id", F.coalesce("_dict", "dict_id")
        )
        fresh = first.filter(F.col("_old").isNull())
    own_letter = (
        fresh.select("dict_id", "first", "name_key")
        .withColumn("rank", place)
        .filter(F.col("rank") < last)
        .select("name_key", "rank", "dict_id")
    )
    if known is None:
        ranked = first.join(own_letter.drop("dict_id"), "name_key", "left").withColumn(
            "rank", F.coalesce("rank", F.lit(last))
        )
    else:
        # a row for each dictionary name, whose ranks go on after it
        taken = known.groupBy("dict_id").agg(F.max("rank").alias("_taken"))
        own_letter = own_letter.join(taken, "dict_id", "left").select(
            "name_key", (F.col("rank") + F.coalesce("_taken", F.lit(0))).alias("rank")
        )
        ranked = first.join(own_letter, "name_key", "left").withColumn(
            "rank", F.coalesce("_old", F.least("rank", F.lit(last)), F.lit(last))
        )
    return ranked.select(
        "name_key",
        "dict_id",
        "rank",
        lettered_id(F.col("rank"), F.col("dict_id")).alias("pseudonym"),
        "n",
    )


@dataclass(frozen=True)
class Registry:
    """Lettered IDs that outlive a job: a folder of Spark's with a Parquet folder for each batch.

    A batch that ran is read by its name, whichever session wrote it. Writing one again puts
    it in place of itself, if no batch was added after it; the IDs of others never change.
    """

    spark: SparkSession
    folder: str

    def batches(self) -> list[str]:
        """Names of batches that are whole, sorted."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/batch=*/_SUCCESS")
        found = path.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(path)
        names = [s.getPath().getParent().getName() for s in found or []]
        return sorted(n.removeprefix("batch=") for n in names)

    def ids(self, batches: list[str] | None = None) -> DataFrame:
        """`name_key, dict_id, rank, pseudonym` of these batches, by default of all."""
        names = self.batches() if batches is None else batches
        reader = self.spark.read.schema(
            "name_key string, dict_id long, rank int, pseudonym string"
        )
        if not names:
            return self.spark.createDataFrame(pa.table({"name_key": pa.array([], pa.string())})).select(
                "name_key",
                F.lit(0).cast("long").alias("dict_id"),
                F.lit(0).alias("rank"),
                F.lit("").alias("pseudonym"),
            )
        return reader.parquet(*[f"{self.folder}/batch={n}" for n in names])

    def add(self, batch: str, rows: DataFrame, order: list[str]) -> DataFrame:
        """IDs for `rows` (as in `lettered_ids`); the new ones are stored as `batch`, whose name
        sorts after all others."""
        names = self.batches()
        if any(n > batch for n in names):
            raise ValueError(f"batches after {batch!r} rest on it")
        known = self.ids([n for n in names if n != batch])
        given = lettered_ids(rows, order, known)
        new = given.join(known.select("name_key"), "name_key", "left_anti")
        new.select(
            "name_key", F.col("dict_id").cast("long").alias("dict_id"), "rank", "pseudonym"
        ).write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")
        count = given.select("name_key", "n")
        return self.ids([*[n for n in names if n != batch], batch]).join(count, "name_key")


def with_pseudonyms(rows: DataFrame, ids: DataFrame, spread_by: list[str]) -> DataFrame:
    """Join rows with their `pseudonym` on `name_key`.

    The HOT_KEYS nominatives with most rows, of those with very many, are broadcast; their
    rows then take a scattered key through the join with all others. Any other nominative
    has less than one in HOT_KEYS of all rows, or less than HOT_ROWS.
    """
    hot = (
        ids.filter(F.col("n") >= HOT_ROWS)
        .orderBy(F.desc("n"), "name_key")
        .limit(HOT_KEYS)
        .select("name_key", F.col("pseudonym").alias("_hot"))
    )
    rest = ids.join(F.broadcast(hot), "name_key", "left_anti").select(
        F.col("name_key").alias("_key"), F.col("pseudonym").alias("_rest")
    )
    scattered = F.concat(F.lit("#"), F.xxhash64(*spread_by).cast("string"))
    return (
        rows.join(F.broadcast(hot), "name_key", "left")
        .withColumn("_key", F.when(F.col("_hot").isNull(), F.col("name_key")).otherwise(scattered))
        .join(rest, "_key", "left")
        .withColumn("pseudonym", F.coalesce("_hot", "_rest"))
        .drop("_hot", "_rest", "_key")
    )


def associations(rows: DataFrame) -> DataFrame:
    """One pseudonym per name key."""
    return rows.groupBy("name_key").agg(F.min("replacement").alias("pseudonym"))
