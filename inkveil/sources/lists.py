"""Lists of people, kept expressions and first-name dictionaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkveil.functions.grammar import DEFAULT_KEEP_EXPRESSIONS, LIST_LINE, WORD
from inkveil.session import constant

LINES_PER_CHUNK = 65536
# malformed lines that an error names
NAMED_LINES = 1000


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines of text files, numbered from 1 in file and line order: `line_no, line`."""
    files = []
    for rank, path in enumerate(paths):
        files.append(
            spark.read.text(path).select(
                F.lit(rank).alias("file_rank"),
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
                F.col("value").alias("line"),
            )
        )
    lines = reduce(DataFrame.unionByName, files)
    chunk = ["file_rank", "file", "block"]
    return number_rows(lines, chunk, "row", "line_no").select("line_no", "line")


def number_rows(
    df: DataFrame, chunk: list[str], order: str, name: str, group: tuple[str, ...] = ()
) -> DataFrame:
    """Dense numbers from 1 by (`chunk`, `order`) in each group, without one task seeing
    all rows: rows are numbered inside their chunk and moved by the sizes of earlier
    chunks."""
    inside = Window.partitionBy(*group, *chunk).orderBy(order)
    before = (
        Window.partitionBy(*group)
        .orderBy(*chunk)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = (
        df.groupBy(*group, *chunk)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_base", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .drop("_size")
    )
    return (
        df.withColumn("_inside", F.row_number().over(inside))
        .join(bases, [*group, *chunk])
        .withColumn(name, F.col("_base") + F.col("_inside"))
        .drop("_base", "_inside")
    )


def check_lines(lines: DataFrame) -> DataFrame:
    """`line_no, line, is_valid`. Every term must hold a letter."""
    terms = F.split(F.regexp_replace("line", "^!", ""), "[:;]", -1)
    return lines.withColumn(
        "is_valid",
        F.col("line").rlike(LIST_LINE) & F.forall(terms, lambda t: t.rlike(WORD)),
    )


def parse_people(lines: DataFrame, keep: bool | None = False) -> DataFrame:
    """Lines as people, numbered in list order.

    With `keep=None` a leading "!" marks people to be kept; the two kinds are numbered
    on their own. A malformed line (one of more than ten names too) fails the query that
    meets it: a job must not run with half a list. See `well_formed`.
    """
    marked = F.col("line").startswith("!")
    parts = F.split(F.regexp_replace("line", "^!", ""), ";", 2)
    wrong = F.concat(F.lit("list line {"), "line", F.lit("} is not well-formed"))
    checked = F.when(F.col("is_valid"), True).otherwise(F.raise_error(wrong).cast("boolean"))
    people = check_lines(lines).filter(checked).select(
        "line_no",
        F.split(parts[0], ":", -1).alias("names"),
        parts[1].alias("surname"),
        (marked if keep is None else F.lit(keep)).alias("keep"),
    )
    people = people.withColumn("_chunk", F.floor(F.col("line_no") / LINES_PER_CHUNK))
    return number_rows(people, ["_chunk"], "line_no", "person_id", ("keep",)).select(
        "person_id", "names", "surname", "keep"
    )


def well_formed(lines: DataFrame) -> DataFrame:
    """Only the lines that name a person; what `check_lines` marks otherwise is left out."""
    return check_lines(lines).filter("is_valid").drop("is_valid")


def require_well_formed(lines: DataFrame, report: str | None = None) -> DataFrame:
    """Fail if there are malformed lines.

    The error names the first `NAMED_LINES` of them and says if there are more. With `report`,
    a path, all are written there as a table (`line_no, line`), and the error says where and
    how many they are.
    """
    bad = check_lines(lines).filter(~F.col("is_valid")).select("line_no", "line")
    if bad.isEmpty():
        return lines
    if report is not None:
        bad.write.mode("overwrite").parquet(report)
        count = lines.sparkSession.read.parquet(report).count()
        raise ValueError(f"{count} list lines are not well-formed; see {report}")
    first = bad.orderBy("line_no").limit(NAMED_LINES + 1).collect()
    named = ", ".join(row["line"] for row in first[:NAMED_LINES])
    more = f" and {bad.count() - NAMED_LINES} more" if len(first) > NAMED_LINES else ""
    raise ValueError(f"list lines {{{named}}}{more} are not well-formed")


def read_people(
    spark: SparkSession, path: str, keep: bool | None = False, report: str | None = None
) -> DataFrame:
    return parse_people(require_well_formed(read_lines(spark, path), report), keep)


def keep_expressions(lines: DataFrame | None, spark: SparkSession) -> DataFrame:
    """Defaults and user lines, each as written and in upper case: `expr`."""
    defaults = constant(spark, line=list(DEFAULT_KEEP_EXPRESSIONS))
    both = defaults if lines is None else defaults.unionByName(lines.select("line"))
    trimmed = both.select(F.trim("line").alias("expr")).filter("expr <> ''")
    return trimmed.unionByName(trimmed.select(F.upper("expr").alias("expr"))).distinct()


def parse_dictionary(lines: DataFrame) -> DataFrame:
    """`dict_id, name` from numbered lines; a blank line keeps its number but names
    nobody."""
    return lines.select(
        F.col("line_no").alias("dict_id"), F.trim("line").alias("name")
    ).filter("name <> ''")


def read_dictionary(spark: SparkSession, *paths: str) -> DataFrame:
    return parse_dictionary(read_lines(spark, *paths))
