"""Corpora as blocks or nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkveil.operators.assembly import SEPARATOR
from inkveil.session import spread

# --- fixed values: what a tag of a web page does to the text around it ----------------
PAGE_ACTIONS = {
    "separator": ("br",),
    "ignore": ("a", "b", "i", "em", "strong", "span"),
}
# ------------------------------------------------------------------------------------

# a tag, a comment, a script or style with its content, or text; an unclosed "<" is text
PAGE_TOKEN = (
    "(?is)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>|</?[a-z!][^<>]*>|[^<]+|<"
)
_SKIPPED = "(?is)^(?:<!--|<script\\b|<style\\b)"
_TAG = "^</?([A-Za-z][A-Za-z0-9]*)[^<>]*>$"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lines(documents: DataFrame, *extra: str) -> DataFrame:
    """`doc_id, block_idx, text`: every line of a plain text is a block."""
    return spread(documents.select("doc_id", "text", *extra), "doc_id").select(
        "doc_id", *extra, F.posexplode(F.split("text", "\n", -1)).alias("block_idx", "text")
    )


def turn_nodes(conversations: DataFrame) -> DataFrame:
    """Nodes of conversations: `conv_id, turn, pos, action, text, role`.

    Lines are texts, line ends are separators; the end of a turn is a separator, and a
    user turn or another role starts anew, which `role` as family and a break say.
    """

    def node(action: str, text: Column) -> Column:
        return F.struct(F.lit(action).alias("action"), text.alias("text"))

    parts = F.flatten(
        F.transform(
            F.split("text", "\n", -1),
            lambda line: F.array(node("text", line), node("separator", F.lit(SEPARATOR))),
        )
    )
    opening = F.when(
        F.col("role") == "user", F.array(node("break", F.lit(None).cast("string")))
    ).otherwise(F.array().cast("array<struct<action:string,text:string>>"))
    return conversations.select(
        "conv_id", "turn", "role", F.posexplode(F.concat(opening, parts)).alias("pos", "n")
    ).select("conv_id", "turn", "pos", "role", "n.action", "n.text")


def page_tokens(html: Column) -> Column:
    """Nodes of a page in one array: `struct<tag, action, text>`.

    Pages are not well-formed, so tags are read as a stream: emphasis and links are
    transparent, scripts, styles and comments are left out, any other tag is a break.
    """

    def classify(token: Column) -> Column:
        tag = F.lower(F.regexp_extract(token, _TAG, 1))
        skipped = token.rlike(_SKIPPED)
        is_text = ~(token.startswith("<") & token.endswith(">"))
        action = F.when(skipped, "ignore").when(is_text, "text")
        for name, tags in PAGE_ACTIONS.items():
            action = action.when(tag.isin(*tags), name)
        return F.struct(
            F.when(skipped | is_text, "").otherwise(tag).alias("tag"),
            action.otherwise("break").alias("action"),
            F.when(is_text & ~skipped, token).alias("text"),
        )

    return F.transform(F.regexp_extract_all(html, F.lit(PAGE_TOKEN), F.lit(0)), classify)


def notes(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Delivery notes `note_id, text` for name-dense runs: one per line item, in which
    the two words of the part's name play a nominative in several spellings."""
    first = F.initcap(F.split("p_name", " ")[0])
    last = F.initcap(F.split("p_name", " ")[1])
    kind = F.initcap(F.lower("p_type"))
    number = F.col("l_linenumber").cast("int")
    said = (
        F.when(number % 7 == 0, F.concat_ws(" ", first, last))
        .when(number % 7 == 1, F.concat_ws(" ", last, first))
        .when(number % 7 == 2, F.concat_ws(" ", first, F.upper(last)))
        .when(number % 7 == 3, F.concat_ws(" ", first, kind, last))
        .when(number % 7 == 4, F.concat_ws(" ", F.lower(first), last))
        .when(number % 7 == 5, F.concat(F.lit("Al Sindaco "), first, F.lit("  "), last))
        .otherwise(F.concat(first, F.lit(" De "), last))
    )
    rows = spread(
        lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    )
    return rows.join(
        part.select("p_partkey", "p_name", "p_type"), F.col("l_partkey") == F.col("p_partkey")
    ).select(
        F.concat_ws(
            "-",
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.col("l_quantity").cast("int"),
        ).alias("note_id"),
        F.concat(
            F.lit("Order "), F.col("l_orderkey"), F.lit(": "), said, F.lit(" took "),
            F.col("l_quantity").cast("int"), F.lit(", "), said, F.lit("."),
        ).alias("text"),
    )
