"""Reports as text (O9, O10): a header line, then one line per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.session import constant

# --- fixed values -------------------------------------------------------------------
FREQUENCY_HEADER = "FREQUENCIES:"
ASSOCIATION_HEADER = "ASSOCIATIONS:"
LINE_FORMAT = "Key: %s\tValue: %s"
# ------------------------------------------------------------------------------------


def _lines(rows: DataFrame, key: str, value: str, order: list[Column], header: str) -> DataFrame:
    """Report lines in order; sorted by range, so part files follow one another."""
    body = rows.select(
        F.lit(1).alias("_body"),
        F.format_string(LINE_FORMAT, F.col(key), F.col(value).cast("string")).alias("value"),
        F.col(key).alias("_key"),
        F.col(value).alias("_value"),
    )
    top = constant(rows.sparkSession, _body=[0], value=[header]).withColumn(
        "_body", F.col("_body").cast("int")
    )
    return (
        body.unionByName(top, allowMissingColumns=True)
        .orderBy("_body", *order)
        .select("value")
    )


def frequency_lines(frequencies: DataFrame) -> DataFrame:
    """Counts, highest first."""
    order = [F.desc("_value"), F.asc("_key")]
    return _lines(frequencies, "plain_name", "cnt", order, FREQUENCY_HEADER)


def association_lines(associations: DataFrame) -> DataFrame:
    """By name key."""
    return _lines(associations, "name_key", "pseudonym", [F.asc("_key")], ASSOCIATION_HEADER)


def write_report(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)
