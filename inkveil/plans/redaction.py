"""The whole job: blocks and lists in, redacted texts and reports out."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.functions.pseudonyms import hash_id
from inkveil.operators import detect as detection
from inkveil.operators import pseudonyms, reports, rewrite
from inkveil.operators import people as persons
from inkveil.session import staged

SCHEMES = ("listed", "lettered", "hash")


@dataclass
class Redaction:
    """What was found, and everything that follows from it."""

    found: DataFrame
    keys: list[str]
    entries: DataFrame
    scheme: str
    salt: str | int | None
    order: list[str]
    # the blocks that can hold a span, if not all
    searched: DataFrame | None = None

    @property
    def _open(self) -> DataFrame:
        return self.found if self.searched is None else self.searched

    def stored(self, folder: str) -> Redaction:
        """The same redaction with the search done: its spans are written to `folder`, a
        path of Spark's, and texts, audit and reports are derived from there. The folder is
        the caller's to remove when they are done."""
        self.found.write.parquet(folder)
        rows = self.found.sparkSession.read.schema(self.found.schema).parquet(folder)
        return replace(self, found=rows, searched=None)

    @cached_property
    def _rows(self) -> DataFrame:
        """Replaced spans without their IDs. Ranking reads them several times, so they are
        written once."""
        return staged(
            rewrite.edit_rows(rewrite.with_edits(self._open, "lettered"), self.keys), "edits"
        )

    @cached_property
    def _lettered(self) -> DataFrame:
        """Edits with lettered IDs."""
        return rewrite.lettered_rows(self._rows, self.keys, self._ids(self._rows))

    def _ids(self, rows: DataFrame) -> DataFrame:
        if "_given" in self.__dict__:
            return self.__dict__["_given"]
        return pseudonyms.lettered_ids(rows, [*self.order, "start"])

    @property
    def blocks(self) -> DataFrame:
        """Blocks with `edits`."""
        if self.scheme == "lettered":
            return rewrite.with_edits_from(self.found.drop("found"), self.keys, self._lettered)
        return rewrite.with_edits(self.found, self.scheme, self.salt).drop("found")

    def texts(self) -> DataFrame:
        return rewrite.redacted(self.blocks).drop("edits")

    def spans(self) -> DataFrame:
        """One row per replaced span."""
        if self.scheme == "lettered":
            return self._lettered
        edited = rewrite.with_edits(self._open, self.scheme, self.salt)
        return rewrite.edit_rows(edited, self.keys)

    def audit(self) -> DataFrame:
        """One row per span found, protected ones included."""
        return rewrite.audit(self._open, self.keys)

    def full_audit(self) -> DataFrame:
        """One row per span found; lost and homeless ones are told apart, too."""
        return rewrite.full_audit(self._open, self.keys)

    def segments(self) -> DataFrame:
        """For blocks with `segments`."""
        return rewrite.segment_rows(rewrite.segment_edits(self.blocks), self.keys)

    def ids(self) -> DataFrame:
        """Lettered IDs by nominative."""
        return self._ids(self._rows).drop("n", "rank")

    def registered(self, registry: pseudonyms.Registry, batch: str) -> Redaction:
        """The same redaction as a batch of many: nominatives of earlier batches keep their
        lettered IDs, new ones are stored."""
        if self.scheme != "lettered":
            raise ValueError("only lettered IDs depend on other batches")
        given = registry.add(batch, self._rows, [*self.order, "start"])
        job = replace(self)
        job.__dict__["_rows"] = self._rows
        job.__dict__["_lettered"] = rewrite.lettered_rows(self._rows, self.keys, given)
        job.__dict__["_given"] = given
        return job

    def close(self) -> None:
        """Let go of the list that is kept in memory for the search."""
        self.entries.unpersist()

    def frequencies(self) -> DataFrame:
        replaced = self.audit().filter(F.col("status") == "replaced")
        return reports.frequencies(replaced, self.entries)

    def associations(self) -> DataFrame:
        if self.scheme == "hash":
            # an ID depends on the name key alone, so it is worked out once for each
            rows = rewrite.edit_rows(rewrite.with_edits(self._open, "lettered"), self.keys)
            return rows.select("name_key").distinct().withColumn(
                "pseudonym", hash_id(F.col("name_key"), self.salt)
            )
        return pseudonyms.associations(self.spans())


def search_entries(
    people: DataFrame | None, dictionary: DataFrame | None, keep_people: DataFrame | None
) -> tuple[DataFrame, bool]:
    """Entries to look for, and whether they come from the dictionary: without people to
    replace, the dictionary is used."""
    listed = people
    if people is not None and dictionary is not None and people.filter(~F.col("keep")).isEmpty():
        listed = None
    kept = keep_people
    if people is not None:
        own = people.filter("keep")
        kept = own if kept is None else kept.unionByName(own)
    if listed is not None:
        everyone = listed.filter(~F.col("keep"))
        if kept is not None:
            everyone = everyone.unionByName(kept.filter("keep"))
        return persons.entries(everyone), False
    if dictionary is None:
        raise ValueError("give people to replace or a dictionary of first names")
    found = persons.dictionary_entries(dictionary)
    if kept is not None:
        found = found.unionByName(persons.entries(kept))
    return found, True


def redact(
    blocks: DataFrame,
    keys: list[str],
    *,
    people: DataFrame | None = None,
    dictionary: DataFrame | None = None,
    keep_people: DataFrame | None = None,
    keep_exprs: DataFrame | None = None,
    scheme: str | None = None,
    salt: str | int | None = None,
    order: list[str] | None = None,
    gate: Column | None = None,
    rule: str = "overlap",
    plan: str | None = None,
    report_shadowed: bool = False,
) -> Redaction:
    """Find and replace nominatives.

    `scheme` is `listed` (ID and place in the list, the default for people), `lettered`
    (ID, letter and dictionary number, the default for the dictionary) or `hash` (needs
    `salt`). `order` sorts blocks where letters are given by first occurrence. With
    `report_shadowed` the audits also have matches that lost their text to another one.
    """
    entries, automatic = search_entries(people, dictionary, keep_people)
    # used to measure the list, to search and to report
    entries = entries.persist()
    scheme = scheme or ("lettered" if automatic else "listed")
    if scheme not in SCHEMES:
        raise ValueError(f"unknown ID scheme {scheme!r}")
    searched, passed = detection.detect_open(
        blocks,
        keys,
        entries,
        keep_exprs,
        gate=gate,
        rule=rule,
        plan=plan,
        report_shadowed=report_shadowed,
    )
    found = searched if passed is None else searched.unionByName(passed)
    return Redaction(found, keys, entries, scheme, salt, order or keys, searched)
