"""Session settings, and tables written once in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def build(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def constant(spark: SparkSession, **columns: list) -> DataFrame:
    """A few rows known when the plan is made, as a local relation."""
    return spark.createDataFrame(pa.table(columns))


def shared_folder(spark: SparkSession) -> str:
    """A folder for this job's tables below `spark.checkpoint.dir`; Hadoop removes it when the
    job ends. A local master without that setting, as in tests, gets a folder of its own."""
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="inkveil-")
        spark.conf.set("spark.checkpoint.dir", root)
    folder = f"{root}/inkveil-{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read from there: later readers
    read the columns they need, and nothing is worked out again for a lost executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rebalance an input of fewer splits than cores; large inputs are left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
