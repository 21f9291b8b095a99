"""The job for blocks stored in pieces with segments: conversations, packages."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkveil.functions.grammar import DEFAULT_KEEP_EXPRESSIONS
from inkveil.operators import assembly, rewrite
from inkveil.operators.detect import gated_blocks
from inkveil.plans.redaction import Redaction, redact
from inkveil.session import staged
from inkveil.sinks import packages as package_sink
from inkveil.sources import packages as package_source


@dataclass
class PieceRedaction:
    """A redaction whose `found` blocks are pieces."""

    redaction: Redaction
    doc_key: list[str]

    @property
    def block_key(self) -> list[str]:
        return [*self.doc_key, "block_idx"]

    @cached_property
    def edited(self) -> DataFrame:
        """Pieces with `new_segments` and `new_text`. Written once: the new offsets of a
        piece depend on all pieces before it, so the table is read twice."""
        return staged(rewrite.segment_edits(self.redaction.blocks), "edited")

    def segments(self, *node: str) -> DataFrame:
        """Segments with old and new offsets in their block and new text."""
        placed = rewrite.piece_offsets(
            self.edited, self.block_key, "piece", F.length("new_text")
        )
        return rewrite.segment_rows(placed, [*self.block_key, "piece"], *node)

    def changed_segments(self, *node: str) -> DataFrame:
        """New texts of the segments of pieces with at least one edit."""
        changed = self.edited.filter(F.size("edits") > 0)
        return rewrite.segment_rows(changed, [*self.block_key, "piece"], *node)


def redact_pieces(pieces: DataFrame, doc_key: list[str], **options) -> PieceRedaction:
    """`redact` for the output of `assembly.blocks_of`. A block is open to the search if
    any of its pieces is name-like."""
    pieces = staged(pieces, "pieces")
    block_key = [*doc_key, "block_idx"]
    opened = gated_blocks(pieces, block_key).withColumn("gated", F.lit(True))
    redaction = redact(
        pieces.join(opened, block_key, "left"),
        [*block_key, "piece"],
        gate=F.coalesce("gated", F.lit(False)),
        **options,
    )
    return PieceRedaction(redaction, doc_key)


def joiners(keep_exprs: DataFrame | None) -> str:
    """Characters of kept expressions: a piece must not end after one of them."""
    common = "".join(DEFAULT_KEEP_EXPRESSIONS)
    if keep_exprs is None:
        return common
    # distinct characters, of which there are few
    chars = keep_exprs.select(F.explode(F.split("expr", "")).alias("c")).distinct().collect()
    return common + "".join(row["c"] for row in chars)


def package_pieces(packages: DataFrame, joined: str = "") -> DataFrame:
    """Packages as pieces of blocks.

    Packages are parsed once: the nodes that matter are written, and read by each step of the
    numbering of blocks.
    """
    nodes = staged(assembly.with_families(package_source.nodes(packages)), "nodes")
    segments = assembly.segments_of(
        nodes,
        ["doc_id"],
        ["pos"],
        F.floor(F.col("pos") / assembly.NODES_PER_CHUNK),
        ["part", "family"],
        joined,
    )
    return assembly.blocks_of(segments, ["doc_id"], ["pos"], ["part", "node_id", "action"])


def redact_packages(
    packages: DataFrame, keep_exprs: DataFrame | None = None, **options
) -> tuple[DataFrame, PieceRedaction]:
    """Redacted packages (O8) and the redaction behind them, for the reports. `packages` is read
    twice, to search it and to rewrite it."""
    job = redact_pieces(
        package_pieces(packages, joiners(keep_exprs)), ["doc_id"], keep_exprs=keep_exprs, **options
    )
    texts = job.changed_segments("part", "node_id", "action").filter("action = 'text'")
    return package_sink.rewritten(packages, texts), job
