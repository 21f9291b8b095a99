"""Blocks and segments from streams of nodes.

A node is one piece of a document in reading order with an `action`: `text`,
`separator` (a tab in the text), `ignore` or `break`. Text after a break, or of another
family than the text before it, starts a new block.

Two forms give the same blocks:
* `blocks_in_row` - all nodes of a document sit in one array: no shuffle;
* `segments_of` / `blocks_of` - one row per node. A document may be any share of the
  table, so running sums are taken inside chunks of its nodes and the (few) chunks are
  then chained; no task sees a whole document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkveil.functions import spans
from inkveil.functions.grammar import OPEN_END

NODES_PER_CHUNK = 16_384
PIECES_PER_CHUNK = 16_384
SEPARATOR = "\t"
# characters that never occur in text
_BREAK_MARK = "\ufdd0"
_NODE_MARK = "\ufdd1"

# --- fixed values: what to do with a node, by tag -----------------------------------
# children of a run
RUN_CHILD_ACTIONS = {
    "text": ("t", "delText"),
    "separator": ("br", "cr", "tab"),
    "ignore": (
        "annotationRef", "ptab", "footnoteRef", "commentReference",
        "continuationSeparator", "footnoteReference", "endnoteReference",
        "lastRenderedPageBreak", "softHyphen", "endnoteRef",
    ),
    "break": (
        "dayLong", "dayShort", "monthLong", "monthShort", "yearLong", "yearShort",
        "sym", "fldChar", "ruby", "object", "separator", "drawing", "pict", "pgNum",
        "noBreakHyphen",
    ),
}
# siblings of a run
SIBLING_ACTIONS = {
    "ignore": (
        "bookmarkStart", "bookmarkEnd", "commentRangeStart", "commentRangeEnd",
        "customXml", "permStart", "permEnd", "proofErr", "sdt", "smartTag",
    ),
    "break": (
        "customXmlDelRangeStart", "customXmlInsRangeStart",
        "customXmlMoveFromRangeStart", "customXmlMoveToRangeStart",
        "customXmlDelRangeEnd", "customXmlInsRangeEnd",
        "customXmlMoveFromRangeEnd", "customXmlMoveToRangeEnd",
        "moveFromRangeStart", "moveToRangeStart", "moveFromRangeEnd",
        "moveToRangeEnd", "moveFrom", "moveTo", "subDoc", "hyperlink", "del",
        "fldSimple", "ins",
    ),
}
# settings of an element, not content
PROPERTIES = (
    "rPr", "pPr", "sdtPr", "sdtEndPr", "smartTagPr", "customXmlPr", "fldData",
)
# parents that are looked through
WRAPPERS = ("sdt", "sdtContent", "customXml", "smartTag")
# parents whose children are one family
CONTAINERS = (
    "p", "ins", "del", "moveFrom", "moveTo", "hyperlink", "fldSimple", "rt", "rubyBase",
)
# containers that join the family of their table row
ROW_CONTAINERS = ("p", "ins", "del", "moveFrom", "moveTo")
# --------------------------------------------------------------------------------------


def action_of(tag: Column, actions: dict[str, tuple[str, ...]]) -> Column:
    """The action of a tag; an unknown tag breaks the block."""
    chosen = None
    for action, tags in actions.items():
        test = tag.isin(*tags)
        chosen = F.when(test, action) if chosen is None else chosen.when(test, action)
    return chosen.otherwise("break")


def unwrapped(ancestors: Column) -> Column:
    """Ancestors (outermost first, `struct<node_id, tag>`) without wrappers."""
    return F.filter(ancestors, lambda a: ~a["tag"].isin(*WRAPPERS))


def with_families(nodes: DataFrame) -> DataFrame:
    """O11-O15 for nodes of packages: `doc_id, part_rank, part, node_id, pos, family,
    action, text`, of the nodes that matter.

    `nodes` has one row per start (`edge` 0) of an element and one per end (`edge` 1) of
    a cell or paragraph. The family is the container of a run or, if the container is in
    a table cell, the row (O12). Cell edges and ends of paragraphs in cells are
    separators (O13). Each element is one row, so no run can be met twice (O15).
    """
    chain = unwrapped(F.col("ancestors"))
    parent = F.try_element_at("ancestors", F.lit(-1))["tag"]

    def up(levels: int) -> Column:
        return F.get("chain", F.size("chain") - levels)

    in_run = parent == "r"
    # the chain of a run's child ends in the run itself
    container = F.when(in_run, up(2)).otherwise(up(1))
    outer = F.when(in_run, up(3)).otherwise(up(2))
    row = F.try_element_at(
        F.filter("chain", lambda a: a["tag"] == "tr"), F.lit(-1)
    )["node_id"]
    marked = (
        nodes.withColumn("chain", chain)
        .withColumn("container", container)
        .withColumn("outer", outer)
        .withColumn("row_id", row)
    )
    tag = F.col("tag")
    in_row = (F.col("outer.tag") == "tc") & F.col("container.tag").isin(*ROW_CONTAINERS)
    ends_in_cell = (tag == "p") & (F.col("container.tag") == "tc") & (F.col("edge") == 1)
    kind = (
        F.when((tag == "tc") | ends_in_cell, "edge")
        .when((F.col("edge") == 1) | tag.isin(*PROPERTIES), None)
        .when(in_run, "child")
        .when(
            F.col("container.tag").isin(*CONTAINERS) & ~tag.isin("r", *WRAPPERS), "sibling"
        )
    )
    return (
        marked.withColumn("kind", kind)
        .filter("kind is not null")
        .withColumn(
            "family",
            F.when((F.col("kind") == "edge") | in_row, F.col("row_id"))
            .otherwise(F.col("container.node_id")),
        )
        .withColumn(
            "action",
            F.when(F.col("kind") == "edge", "separator")
            .when(F.col("kind") == "child", action_of(tag, RUN_CHILD_ACTIONS))
            .otherwise(action_of(tag, SIBLING_ACTIONS)),
        )
        .withColumn(
            "text",
            F.when(F.col("action") == "separator", SEPARATOR).when(
                F.col("action") == "text", F.coalesce("text", F.lit(""))
            ),
        )
        .select("doc_id", "part_rank", "part", "node_id", "pos", "family", "action", "text")
    )


def segments_of(
    nodes: DataFrame,
    doc_key: list[str],
    order: list[str],
    chunk: Column,
    family: list[str],
    joiners: str = "",
) -> DataFrame:
    """Text nodes with `block_idx`, `piece`, `from`, `to`.

    `order` sorts the nodes of a document and `chunk` is a non-decreasing number along
    it. Blocks are numbered from 0 in each document. A block is stored in pieces that end
    where no match can cross: after a text whose last character is neither part of names
    nor one of `joiners`, the characters of kept expressions. `piece` grows along the
    document.
    """
    lit0 = F.lit(0).cast("bigint")
    rows = nodes.filter(F.col("action") != "ignore").withColumn("_chunk", chunk)
    inside = Window.partitionBy(*doc_key, "_chunk").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    is_break = (F.col("action") == "break").cast("bigint")
    fam = F.struct(*[F.col(c) for c in family])
    open_end = OPEN_END if not joiners else OPEN_END.replace("]$", _in_class(joiners) + "]$")

    # inside each chunk; the first text of a chunk does not know what came before it
    texts = (
        rows.withColumn("_b", F.sum(is_break).over(upto))
        .filter(F.col("action") != "break")
        .withColumn("_len", F.length("text").cast("bigint"))
        .withColumn("_cut", ((F.col("_len") > 0) & ~F.col("text").rlike(open_end)).cast("bigint"))
        .withColumn("_fam", fam)
        .withColumn("_prev_b", F.lag("_b").over(inside))
        .withColumn("_prev_fam", F.lag("_fam").over(inside))
        .withColumn("_head", F.col("_prev_b").isNull())
        .withColumn(
            "_starts",
            F.when(F.col("_head"), lit0).otherwise(
                (
                    (F.col("_prev_b") != F.col("_b"))
                    | (F.col("_prev_fam") != F.col("_fam"))
                ).cast("bigint")
            ),
        )
        .withColumn("_n", F.sum("_starts").over(upto))
        .withColumn("_g", F.sum("_len").over(upto) - F.col("_len"))
        .withColumn("_c", F.sum("_cut").over(upto) - F.col("_cut"))
        .withColumn("_g0", F.max(F.when(F.col("_starts") == 1, F.col("_g"))).over(upto))
    )
    # one row per chunk
    edge = F.struct(F.struct(*order).alias("o"), F.col("_b").alias("b"), F.col("_fam").alias("f"))
    text_facts = texts.groupBy(*doc_key, "_chunk").agg(
        F.min(edge).alias("_first"),
        F.max(edge).alias("_last"),
        F.sum("_starts").alias("_starts_in"),
        F.sum("_len").alias("_len_in"),
        F.sum("_cut").alias("_cuts_in"),
        F.max("_g0").alias("_g0_in"),
    )
    facts = rows.groupBy(*doc_key, "_chunk").agg(F.sum(is_break).alias("_breaks_in")).join(
        text_facts, [*doc_key, "_chunk"], "left"
    )
    along = Window.partitionBy(*doc_key).orderBy("_chunk")
    before = along.rowsBetween(Window.unboundedPreceding, -1)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name).over(before), lit0)

    chained = (
        facts.withColumn("_b_base", total("_breaks_in"))
        .withColumn("_g_base", total("_len_in"))
        .withColumn("_c_base", total("_cuts_in"))
        .withColumn(
            "_end",
            F.when(
                F.col("_last").isNotNull(),
                F.struct(
                    (F.col("_b_base") + F.col("_last.b")).alias("b"),
                    F.col("_last.f").alias("f"),
                ),
            ),
        )
        .withColumn("_prev_end", F.last("_end", ignorenulls=True).over(before))
        .withColumn(
            "_head_starts",
            F.when(F.col("_first").isNull(), lit0).otherwise(
                (
                    F.col("_prev_end").isNull()
                    | (F.col("_prev_end.b") != F.col("_b_base") + F.col("_first.b"))
                    | (F.col("_prev_end.f") != F.col("_first.f"))
                ).cast("bigint")
            ),
        )
        .withColumn("_all_starts", F.coalesce("_starts_in", lit0) + F.col("_head_starts"))
        .withColumn("_n_base", total("_all_starts"))
        .withColumn(
            "_g0_end",
            F.when(F.col("_g0_in").isNotNull(), F.col("_g_base") + F.col("_g0_in")).when(
                F.col("_head_starts") == 1, F.col("_g_base")
            ),
        )
        .withColumn("_g0_carried", F.last("_g0_end", ignorenulls=True).over(before))
        .select(
            *doc_key, "_chunk", "_g_base", "_c_base", "_n_base", "_head_starts", "_g0_carried"
        )
    )
    placed = texts.join(chained, [*doc_key, "_chunk"])
    block = F.col("_n_base") + F.col("_head_starts") + F.col("_n") - 1
    begins = (
        F.when(F.col("_g0").isNotNull(), F.col("_g_base") + F.col("_g0"))
        .when(F.col("_head_starts") == 1, F.col("_g_base"))
        .otherwise(F.col("_g0_carried"))
    )
    offset = F.col("_g_base") + F.col("_g") - begins
    hidden = [
        c for c in (*texts.columns, *chained.columns) if c.startswith("_")
    ]
    return (
        placed.withColumn("block_idx", block.cast("int"))
        .withColumn("piece", F.col("_c_base") + F.col("_c") + F.col("block_idx"))
        .withColumn("from", offset)
        .withColumn("to", offset + F.col("_len"))
        .drop(*set(hidden))
    )


def _in_class(chars: str) -> str:
    """Characters for use inside a character class."""
    return "".join("\\" + c if c in "\\]^-[&" else c for c in sorted(set(chars)))


def blocks_of(
    segments: DataFrame, doc_key: list[str], order: list[str], node: list[str]
) -> DataFrame:
    """Pieces of blocks `doc_key, block_idx, piece, base, text, segments`.

    `base` is the offset of the piece in its block, `segments` are in offsets of the
    piece, `seg_idx` counts the segments of the piece and `node` columns say where the
    text belongs.
    """
    ordered = F.sort_array(
        F.collect_list(
            F.struct(
                F.struct(*order).alias("o"),
                F.col("text").alias("text"),
                F.col("from").alias("from"),
                F.col("to").alias("to"),
                *[F.col(c).alias(c) for c in node],
            )
        )
    )
    base = F.get("_all", 0)["from"]
    return (
        segments.groupBy(*doc_key, "block_idx", "piece")
        .agg(ordered.alias("_all"))
        .withColumn("base", base)
        .select(
            *doc_key,
            "block_idx",
            "piece",
            "base",
            F.array_join(F.transform("_all", lambda s: s["text"]), "").alias("text"),
            F.transform(
                "_all",
                lambda s, i: F.struct(
                    i.alias("seg_idx"),
                    (s["from"] - F.col("base")).cast("int").alias("from"),
                    (s["to"] - F.col("base")).cast("int").alias("to"),
                    *[s[c].alias(c) for c in node],
                ),
            ).alias("segments"),
        )
    )


def blocks_in_row(docs: DataFrame, doc_key: list[str], nodes: Column) -> DataFrame:
    """O16-O18 for documents with an array of `struct<action, text>`:
    `doc_key, block_idx, text, segments`."""
    def clean(text: Column) -> Column:
        return F.translate(text, _BREAK_MARK + _NODE_MARK, "\ufffd\ufffd")

    marked = F.transform(
        nodes,
        lambda n: F.when(n["action"] == "text", F.concat(F.lit(_NODE_MARK), clean(n["text"])))
        .when(n["action"] == "separator", F.lit(_NODE_MARK + SEPARATOR))
        .when(n["action"] == "break", F.lit(_BREAK_MARK))
        .otherwise(F.lit("")),
    )
    blocks = F.filter(
        F.split(F.array_join(marked, ""), _BREAK_MARK + "+", -1), lambda b: b != ""
    )
    exploded = docs.select(*doc_key, F.posexplode(blocks).alias("block_idx", "_marked"))
    parts = F.slice(F.split("_marked", _NODE_MARK, -1), 2, 1 << 30)

    def segments(some: Column) -> Column:
        return spans.bind(
            spans.running(F.transform(some, F.length)),
            lambda before: F.transform(
                some,
                lambda part, i: F.struct(
                    i.alias("seg_idx"),
                    F.get(before, i).alias("from"),
                    (F.get(before, i) + F.length(part)).alias("to"),
                ),
            ),
        )

    return exploded.select(
        *doc_key,
        "block_idx",
        F.regexp_replace("_marked", _NODE_MARK, "").alias("text"),
        spans.bind(parts, segments).alias("segments"),
    )
