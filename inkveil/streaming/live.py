"""Redaction of a stream of blocks.

Detection keeps no state and, for lists that fit into the plan, needs no shuffle, so the
same columns work on `readStream`. Listed and hashed IDs depend on the block alone;
lettered IDs need the whole corpus and are left to batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from inkveil.operators import detect as detection
from inkveil.operators import literals, rewrite


def redact_stream(
    blocks: DataFrame,
    keys: list[str],
    entries: DataFrame,
    keep_exprs: DataFrame | None = None,
    *,
    scheme: str = "listed",
    salt: str | int | None = None,
) -> DataFrame:
    """A streaming table of blocks with redacted `text`."""
    if scheme == "lettered":
        raise ValueError("lettered IDs need the whole corpus")
    if detection.choose(detection.measure(entries)) == "joined":
        raise ValueError("the list is too long for a stream; redact it in batches")
    if keep_exprs is not None and literals.choose(literals.chars_of(keep_exprs)) == "joined":
        raise ValueError("the keep list is too long for a stream; redact it in batches")
    found = detection.detect(blocks, keys, entries, keep_exprs)
    return rewrite.redacted(rewrite.with_edits(found, scheme, salt)).drop("found", "edits")
