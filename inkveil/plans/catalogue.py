"""Queries over the test tables, one per operator or job."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkveil.functions import grammar, spans
from inkveil.functions import pseudonyms as ids
from inkveil.operators import assembly, literals, protect, reports, rewrite
from inkveil.operators import people as persons
from inkveil.operators.pseudonyms import Registry
from inkveil.plans.pieces import (
    PieceRedaction,
    package_pieces,
    redact_packages,
    redact_pieces,
)
from inkveil.plans.redaction import Redaction, redact, search_entries
from inkveil.session import constant, shared_folder, staged
from inkveil.sinks import packages as package_sink
from inkveil.sinks import reports as report_text
from inkveil.sources import corpora, lists, packages
from inkveil.sources.corpora import table
from inkveil.streaming.live import redact_stream

Query = Callable[[SparkSession, str], DataFrame]

# People who occur in the running text of `documents`.
DOCUMENT_PEOPLE = (
    "Stteen;Erachtz",
    "General;Public",
    "Apache;License",
    "Und;Und",
    "Orre;Orre",
)
DOCUMENT_KEEP = ("Apache License", "Of Of")
NOTE_KEEP = ("Al Sindaco", "De Anvil")
SALT = 20260
BATCH_FROM = "4"

# --- lists drawn from the tables -----------------------------------------------------


def _constant_lines(spark: SparkSession, lines: tuple[str, ...]) -> DataFrame:
    return constant(spark, line_no=list(range(1, len(lines) + 1)), line=list(lines))


def list_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a people list, good and bad, made of part names and regions."""
    first = F.initcap(F.split("p_name", " ")[0])
    last = F.initcap(F.split("p_name", " ")[1])
    kind = F.initcap(F.lower("p_type"))
    line = (
        F.when(
            (F.col("p_type") == "ECONOMY") & (F.col("p_size") > 25),
            F.concat(first, F.lit(":"), kind, F.lit(":Senior;"), last),
        )
        .when(
            F.col("p_type").isin("ECONOMY", "PROMO"),
            F.concat(first, F.lit(":"), kind, F.lit(";"), last),
        )
        .when(F.col("p_type") == "STANDARD", F.concat(first, F.lit(";"), last))
        .when(
            (F.col("p_type") == "MEDIUM") & F.col("p_name").startswith("blue"),
            F.concat(F.lit("!"), first, F.lit(";"), last),
        )
        .when(F.col("p_type") == "SMALL", F.concat_ws(" ", first, last))
        .otherwise(F.concat(first, F.lit(";de "), last))
    )
    parts = table(spark, d, "part").select(line.alias("line"))
    region = F.initcap(F.lower("r_name"))
    turned = F.initcap(F.reverse(F.lower("r_name")))
    regions = table(spark, d, "region").select(
        F.concat(region, F.lit(":"), F.reverse(turned), F.lit(";"), turned).alias("line")
    )
    rows = parts.unionByName(regions).distinct().withColumn("_head", F.substring("line", 1, 2))
    return lists.number_rows(rows, ["_head"], "line", "line_no").select("line_no", "line")


def listed_people(spark: SparkSession, d: str) -> DataFrame:
    """The lines that name people; `validate_people` tells of the others."""
    return lists.parse_people(lists.well_formed(list_lines(spark, d)), keep=None)


def note_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """First names from two sources, some in both."""
    first = F.initcap(F.split("p_name", " ")[0])
    kind = F.initcap(F.lower("p_type"))
    part = table(spark, d, "part")
    one = part.select(F.lit(0).alias("source"), first.alias("line")).distinct()
    two = part.select(F.lit(1).alias("source"), kind.alias("line")).distinct()
    return lists.parse_dictionary(
        lists.number_rows(one.unionByName(two), ["source"], "line", "line_no")
    )


def notes(spark: SparkSession, d: str) -> DataFrame:
    return corpora.notes(table(spark, d, "lineitem"), table(spark, d, "part"))


def _keep(spark: SparkSession, exprs: tuple[str, ...]) -> DataFrame:
    return lists.keep_expressions(_constant_lines(spark, exprs), spark)


def document_lines(spark: SparkSession, d: str) -> DataFrame:
    return corpora.lines(table(spark, d, "documents"))


# --- jobs ----------------------------------------------------------------------------


def document_job(spark: SparkSession, d: str) -> Redaction:
    people = lists.parse_people(
        lists.require_well_formed(_constant_lines(spark, DOCUMENT_PEOPLE))
    )
    return redact(
        document_lines(spark, d),
        ["doc_id", "block_idx"],
        people=people,
        keep_exprs=_keep(spark, DOCUMENT_KEEP),
    )


def note_job(spark: SparkSession, d: str, plan: str | None = None) -> Redaction:
    return redact(
        notes(spark, d),
        ["note_id"],
        people=listed_people(spark, d),
        keep_exprs=_keep(spark, NOTE_KEEP),
        scheme="hash",
        salt=SALT,
        plan=plan,
    )


def dictionary_job(spark: SparkSession, d: str, plan: str | None = None) -> Redaction:
    return redact(
        notes(spark, d), ["note_id"], dictionary=note_dictionary(spark, d), plan=plan
    )


def transcript_job(spark: SparkSession, d: str, plan: str | None = None) -> PieceRedaction:
    return redact_pieces(
        transcript_blocks(spark, d),
        ["conv_id"],
        people=listed_people(spark, d),
        keep_exprs=_keep(spark, NOTE_KEEP),
        plan=plan,
    )


# --- assembled conversations, pages and tables ------------------------------------------

TURNS_PER_CHUNK = 1024
KEEP_JOINERS = "".join(sorted(set("".join(NOTE_KEEP + grammar.DEFAULT_KEEP_EXPRESSIONS))))


def turn_segments(nodes: DataFrame) -> DataFrame:
    return assembly.segments_of(
        nodes,
        ["conv_id"],
        ["turn", "pos"],
        F.floor(F.col("turn") / TURNS_PER_CHUNK),
        ["role"],
        KEEP_JOINERS,
    )


def signed_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Turns, each signed with a name that is cut into two text nodes."""
    turns = table(spark, d, "conversations")
    said = corpora.turn_nodes(turns)
    name = F.initcap(F.coalesce("p_name", F.lit("nobody known")))
    cut = (F.col("turn") % 7 + 2).cast("int")
    signature = F.array(
        F.struct(F.lit("text").alias("action"), F.concat(F.lit("By "), name.substr(F.lit(1), cut)).alias("text")),
        F.struct(F.lit("ignore").alias("action"), F.lit(None).cast("string").alias("text")),
        F.struct(F.lit("text").alias("action"), name.substr(cut + 1, F.length(name)).alias("text")),
        F.struct(F.lit("text").alias("action"), F.lit(".").alias("text")),
    )
    signed = (
        turns.withColumn("p_partkey", F.col("conv_id") * 10 + F.col("turn"))
        .join(table(spark, d, "part").select("p_partkey", "p_name"), "p_partkey", "left")
        .select("conv_id", "turn", "role", F.posexplode(signature).alias("pos", "n"))
        # after all lines of the turn
        .select(
            "conv_id", "turn", (F.col("pos") + (1 << 30)).alias("pos"), "role", "n.action", "n.text"
        )
    )
    return said.unionByName(signed)


def transcript_blocks(spark: SparkSession, d: str) -> DataFrame:
    return assembly.blocks_of(
        turn_segments(signed_nodes(spark, d)), ["conv_id"], ["turn", "pos"], ["turn"]
    )


# --- packages written from conversations -----------------------------------------------

_W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
_PACKAGE = "doc_id string, path string, content binary"


def _run(text: str) -> str:
    return f'<w:r><w:rPr><w:b/></w:rPr><w:t xml:space="preserve">{escape(text)}</w:t></w:r>'


def _package(role: str, text: str, name: str, cut: int) -> bytes:
    """A package with a paragraph per line, a table row with the role and the cut name,
    and a header with the name."""
    lines = "".join(f"<w:p>{_run(line)}</w:p>" for line in text.split("\n"))
    cells = [_run(role), _run(name[:cut]) + "<w:proofErr/>" + _run(name[cut:])]
    row = "".join(f"<w:tc><w:tcPr/><w:p>{cell}</w:p></w:tc>" for cell in cells)
    parts = {
        "word/document.xml": f"<w:body>{lines}<w:tbl><w:tr>{row}</w:tr></w:tbl></w:body>",
        "word/header1.xml": f"<w:p>{_run('Signed ')}<w:sdt><w:sdtContent>{_run(name)}"
        "</w:sdtContent></w:sdt></w:p>",
    }
    return _zipped({k: f'<w:part xmlns:w="{_W}">{body}</w:part>' for k, body in parts.items()})


def _zipped(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as package:
        for path, body in parts.items():
            package.writestr(path, body)
    return out.getvalue()


_RELATIONS = "http://schemas.openxmlformats.org/package/2006/relationships"
_TYPES = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _relations(*targets: tuple[str, str]) -> str:
    rows = "".join(
        f'<Relationship Id="r{k}" Type="{_TYPES}/{kind}" Target="{target}"/>'
        for k, (kind, target) in enumerate(targets)
    )
    # not a part of the package
    outside = f'<Relationship Id="x" Type="{_TYPES}/footer" Target="word/x.xml" TargetMode="External"/>'
    return f'<Relationships xmlns="{_RELATIONS}">{rows}{outside}</Relationships>'


def _story_package(role: str, text: str, name: str, cut: int) -> bytes:
    """A package of all kinds of parts: the document and most others have names of their own
    and are found by relationship, one footer by its usual name."""
    stories = {
        "word/main.xml": "<w:body>%s</w:body>" % "".join(
            f"<w:p>{_run(line)}</w:p>" for line in text.split("\n")
        ),
        "word/notes/below.xml": f'<w:footnote><w:p>{_run(f"Note by {name}")}</w:p></w:footnote>',
        "word/ends.xml": f"<w:endnote><w:p>{_run('Ends ' + name[:cut])}{_run(name[cut:])}"
        f"{_run('.')}</w:p></w:endnote>",
        "word/said.xml": f'<w:comment><w:p>{_run(f"Said of {name}")}</w:p></w:comment>',
        "word/footer2.xml": f"<w:p>{_run(f'Signed {name}')}</w:p>",
        "foot/f.xml": f"<w:p>{_run(f'Page of {name}')}</w:p>",
        "word/heads.xml": f"<w:p>{_run(role)}</w:p>",
    }
    return _zipped({
        "_rels/.rels": _relations(("officeDocument", "word/main.xml")),
        "word/_rels/main.xml.rels": _relations(
            ("header", "heads.xml"), ("footer", "../foot/f.xml"), ("endnotes", "ends.xml"),
            ("footnotes", "/word/notes/below.xml"), ("comments", "said.xml"), ("styles", "s.xml"),
        ),
        **{k: f'<w:part xmlns:w="{_W}">{body}</w:part>' for k, body in stories.items()},
    })


def turn_packages(
    spark: SparkSession, d: str, make: Callable[[str, str, str, int], bytes] = _package
) -> DataFrame:
    """Every turn of a conversation as a package."""

    def packages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            content = [make(*row[1:]) for row in batch.itertuples(index=False)]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "path": batch["doc_id"], "content": content}
            )

    turns = corpora.spread(table(spark, d, "conversations"), "conv_id")
    name = F.initcap(F.coalesce("p_name", F.lit("nobody known")))
    return (
        turns.withColumn("p_partkey", F.col("conv_id") * 10 + F.col("turn"))
        .join(table(spark, d, "part").select("p_partkey", "p_name"), "p_partkey", "left")
        .select(
            F.concat_ws("-", "conv_id", "turn").alias("doc_id"),
            "role",
            "text",
            name.alias("name"),
            (F.col("turn") % 7 + 2).cast("int").alias("cut"),
        )
        .mapInPandas(packages, _PACKAGE)
    )


# --- queries -----------------------------------------------------------------------------


def line_blocks(spark: SparkSession, d: str) -> DataFrame:
    return document_lines(spark, d).withColumn("n_chars", F.length("text"))


def gate_stats(spark: SparkSession, d: str) -> DataFrame:
    blocks = corpora.lines(table(spark, d, "documents"), "lang", "source")
    return reports.gate_statistics(blocks, "lang", "source")


def list_spans(spark: SparkSession, d: str) -> DataFrame:
    return document_job(spark, d).audit()


def list_redact(spark: SparkSession, d: str) -> DataFrame:
    return document_job(spark, d).texts()


def document_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return reports.by_count(document_job(spark, d).frequencies())


def validate_people(spark: SparkSession, d: str) -> DataFrame:
    return lists.check_lines(list_lines(spark, d))


def validate_name_counts(spark: SparkSession, d: str) -> DataFrame:
    """List lines of one to twelve names, one for each part: eleven are too many."""
    first = F.initcap(F.split("p_name", " ")[0])
    last = F.initcap(F.split("p_name", " ")[1])
    count = (F.col("p_partkey") % 12 + 1).cast("int")
    line = F.concat_ws(";", F.array_join(F.array_repeat(first, count), ":"), last)
    lines = table(spark, d, "part").select(F.col("p_partkey").alias("line_no"), line.alias("line"))
    return lists.check_lines(lines)


def _people_columns(people: DataFrame) -> list[Column]:
    return [
        F.col("person_id"),
        F.array_join("names", ":").alias("names"),
        F.col("surname"),
        F.col("keep"),
    ]


def people_list(spark: SparkSession, d: str) -> DataFrame:
    people = listed_people(spark, d)
    return people.select(
        *_people_columns(people),
        F.when(~F.col("keep"), ids.listed_id(F.col("person_id"))).alias("pseudonym"),
        F.get("names", 0).alias("plain_name"),
    )


def people_homonyms(spark: SparkSession, d: str) -> DataFrame:
    people = persons.with_homonyms(listed_people(spark, d))
    return people.select(*_people_columns(people), "has_homonym")


def _variants(people: DataFrame) -> DataFrame:
    return persons.variants(people).select(
        "person_id", "variant_rank", F.array_join("terms", " ").alias("terms")
    )


def people_variants(spark: SparkSession, d: str) -> DataFrame:
    people = listed_people(spark, d).filter(~F.col("keep"))
    return _variants(people.withColumn("has_homonym", F.lit(False)))


def people_variants_homonym(spark: SparkSession, d: str) -> DataFrame:
    return _variants(persons.with_homonyms(listed_people(spark, d)).filter(~F.col("keep")))


def person_forms(spark: SparkSession, d: str) -> DataFrame:
    """Which spellings of all orders of a person's names its pattern accepts."""
    people = persons.patterns(persons.with_homonyms(listed_people(spark, d))).filter(
        ~F.col("keep")
    )
    spelt = persons.variants(
        people.withColumn("has_homonym", F.lit(False)), "surname", "pattern"
    )
    names = F.array_join("terms", " ")
    forms = {
        "names first": F.concat_ws(" ", names, F.col("surname")),
        "surname first": F.concat_ws("\t \n", F.col("surname"), F.array_join("terms", "\n")),
        "upper surname": F.concat_ws(" ", names, F.upper("surname")),
        "lower": F.lower(F.concat_ws(" ", names, F.col("surname"))),
        "glued": F.concat(names, F.lit(" "), F.col("surname"), F.lit("è")),
        "quoted": F.concat(F.lit("l'"), names, F.lit(" "), F.col("surname"), F.lit("'")),
    }
    listed = F.array(
        *[F.struct(F.lit(n).alias("form"), text.alias("text")) for n, text in forms.items()]
    )
    return (
        spelt.select("person_id", "pattern", "variant_rank", F.explode(listed).alias("f"))
        .select(
            "person_id",
            "variant_rank",
            "f.form",
            "f.text",
            F.rlike("f.text", F.col("pattern")).alias("accepted"),
        )
    )


def keep_expressions(spark: SparkSession, d: str) -> DataFrame:
    """Defaults and the titles of the regions, literal and in upper case."""
    lines = table(spark, d, "nation").select(
        F.col("n_nationkey").alias("line_no"),
        F.concat(F.lit("  Il "), F.initcap(F.lower("n_name")), F.lit(" ")).alias("line"),
    )
    return lists.keep_expressions(lines, spark)


def name_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return note_dictionary(spark, d)


def _protected(spark: SparkSession, d: str) -> DataFrame:
    entries = persons.entries(listed_people(spark, d))
    return protect.protected_spans(notes(spark, d), ["note_id"], entries, _keep(spark, NOTE_KEEP))


def protected_spans(spark: SparkSession, d: str) -> DataFrame:
    return _protected(spark, d)


def spans_after_keep(spark: SparkSession, d: str) -> DataFrame:
    """Spans found regardless of protection, less the protected ones."""
    found = redact(
        notes(spark, d), ["note_id"], people=listed_people(spark, d).filter(~F.col("keep"))
    )
    return protect.unprotected(found.spans(), _protected(spark, d), ["note_id"]).select(
        "note_id", "start", "end", "matched"
    )


EDGE_KEEP = ("Economy", "De Anvil")


def spans_after_keep_edge(spark: SparkSession, d: str) -> DataFrame:
    """The same for spans that only start or end in a protected one: those around one stay."""
    people = listed_people(spark, d)
    found = redact(notes(spark, d), ["note_id"], people=people.filter(~F.col("keep")))
    kept = protect.protected_spans(
        notes(spark, d), ["note_id"], persons.entries(people), _keep(spark, EDGE_KEEP)
    )
    return protect.unprotected(found.spans(), kept, ["note_id"], rule="edge").select(
        "note_id", "start", "end", "matched"
    )


def match_audit(spark: SparkSession, d: str) -> DataFrame:
    return note_job(spark, d).audit()


def match_audit_joined(spark: SparkSession, d: str) -> DataFrame:
    return note_job(spark, d, plan="joined").audit()


STATUS_KEEP = "Economy Anvil"


def status_people(spark: SparkSession, d: str) -> DataFrame:
    """People named after parts: some with the kind of the part for a second name, and others
    who have that kind for their only name."""
    first = F.initcap(F.split("p_name", " ")[0])
    last = F.initcap(F.split("p_name", " ")[1])
    kind = F.initcap(F.lower("p_type"))
    part = table(spark, d, "part")
    both = part.select(F.concat(first, F.lit(":"), kind, F.lit(";"), last).alias("line"))
    short = part.select(F.concat(kind, F.lit(";"), last).alias("line"))
    rows = both.unionByName(short).distinct().withColumn("_head", F.substring("line", 1, 2))
    return lists.parse_people(
        lists.number_rows(rows, ["_head"], "line", "line_no").select("line_no", "line")
    )


def _statuses(spark: SparkSession, d: str, plan: str) -> DataFrame:
    """Notes of which only the beginning, up to the number of pieces, can be written back."""
    told = F.regexp_extract("text", "^.* took ", 0)
    segment = F.struct(F.lit(0).alias("seg_idx"), F.lit(0).alias("from"), F.length(told).alias("to"))
    job = redact(
        notes(spark, d).withColumn("segments", F.array(segment)),
        ["note_id"],
        people=status_people(spark, d),
        keep_exprs=_keep(spark, (STATUS_KEEP,)),
        plan=plan,
        report_shadowed=True,
    )
    return job.full_audit().fillna(0, ["beaten_by"])


def match_statuses(spark: SparkSession, d: str) -> DataFrame:
    return _statuses(spark, d, "inline")


def match_statuses_joined(spark: SparkSession, d: str) -> DataFrame:
    return _statuses(spark, d, "joined")


def match_status_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many matches were replaced, protected, shadowed and orphaned."""
    return match_statuses(spark, d).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("entry_id").alias("people")
    )


def notes_redacted(spark: SparkSession, d: str) -> DataFrame:
    return note_job(spark, d).texts()


def name_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return reports.by_count(note_job(spark, d).frequencies())


def associations(spark: SparkSession, d: str) -> DataFrame:
    return reports.by_key(note_job(spark, d).associations())


def notes_streamed(spark: SparkSession, d: str) -> DataFrame:
    """The same texts, from a stream of the notes that is read to its end."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    source = notes(spark, d)
    source.write.parquet(f"{folder}/in")
    entries, _ = search_entries(listed_people(spark, d), None, None)
    stream = redact_stream(
        spark.readStream.schema(source.schema).parquet(f"{folder}/in"),
        ["note_id"],
        entries,
        _keep(spark, NOTE_KEEP),
        scheme="hash",
        salt=SALT,
    )
    stream.writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/state"
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(source.schema).parquet(f"{folder}/out")


def protected_shift(spark: SparkSession, d: str) -> DataFrame:
    """Kept spans in the offsets of the redacted text."""
    blocks = note_job(spark, d).blocks
    kept = literals.by_pattern(
        F.col("text"), literals.alternatives(_keep(spark, NOTE_KEEP))
    )
    return (
        blocks.withColumn("kept", kept)
        .withColumn("moved", spans.shifted(F.col("kept"), F.col("edits")))
        .select("note_id", F.explode_outer(F.arrays_zip("kept", "moved")).alias("z"))
        .filter("z is not null")
        .select(
            "note_id",
            "z.kept.start",
            "z.kept.end",
            F.col("z.moved.start").alias("shifted_start"),
            F.col("z.moved.end").alias("shifted_end"),
        )
    )


def dictionary_spans(spark: SparkSession, d: str) -> DataFrame:
    return dictionary_job(spark, d).audit().drop("status")


def dictionary_spans_joined(spark: SparkSession, d: str) -> DataFrame:
    return dictionary_job(spark, d, plan="joined").audit().drop("status")


def word_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """A dictionary that grows with the data: the first and last words of part names, then all
    other plain words of documents."""
    parts = table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("w"))
    texts = table(spark, d, "documents").select(F.explode(F.split("text", "[ \t\n\r]+")).alias("w"))
    plain = F.concat(F.upper(F.substring("w", 1, 1)), F.lower(F.substring("w", 2, 1 << 30)))
    both = parts.select("w", F.lit(0).alias("source")).unionByName(
        texts.select("w", F.lit(1).alias("source"))
    )
    first = (
        both.filter(F.col("w").rlike("^[A-Za-z]{2,}$"))
        .groupBy(plain.alias("line"))
        .agg(F.min("source").alias("source"))
        .withColumn("_head", F.substring("line", 1, 2))
    )
    return lists.parse_dictionary(
        lists.number_rows(first, ["source", "_head"], "line", "line_no").select("line_no", "line")
    )


def word_dictionary_spans(spark: SparkSession, d: str) -> DataFrame:
    """Notes searched with the dictionary that grows; its size chooses the plan."""
    job = redact(notes(spark, d), ["note_id"], dictionary=word_dictionary(spark, d))
    return job.audit().drop("status")


def word_dictionary_size(spark: SparkSession, d: str) -> DataFrame:
    """How many names of each first letter that dictionary has, and the sum of their numbers."""
    return (
        word_dictionary(spark, d)
        .groupBy(F.substring("name", 1, 1).alias("letter"))
        .agg(F.count(F.lit(1)).alias("names"), F.sum("dict_id").alias("numbers"))
    )


def lettered_ids(spark: SparkSession, d: str) -> DataFrame:
    return dictionary_job(spark, d).ids()


def _batches(spark: SparkSession, d: str) -> tuple[Registry, list[Redaction]]:
    """All notes in two batches, those of greater names first."""
    registry = Registry(spark, f"{shared_folder(spark)}/registry-{uuid.uuid4().hex}")
    dictionary, late = note_dictionary(spark, d), F.col("note_id") >= BATCH_FROM
    jobs = [
        redact(notes(spark, d).filter(part), ["note_id"], dictionary=dictionary)
        for part in (late, ~late)
    ]
    return registry, [job.registered(registry, str(k)) for k, job in enumerate(jobs)]


def lettered_batches(spark: SparkSession, d: str) -> DataFrame:
    """Lettered IDs given in two batches; those of the first are kept in the second."""
    registry, _ = _batches(spark, d)
    return registry.ids().drop("rank")


def batches_redacted(spark: SparkSession, d: str) -> DataFrame:
    """The texts of both batches with these IDs."""
    _, (one, two) = _batches(spark, d)
    return one.texts().unionByName(two.texts())


def dictionary_redacted(spark: SparkSession, d: str) -> DataFrame:
    return dictionary_job(spark, d).texts()


def name_keys(spark: SparkSession, d: str) -> DataFrame:
    told = dictionary_job(spark, d).audit().select("matched").distinct()
    return told.select("matched", ids.name_key(F.col("matched")).alias("name_key"))


def hash_ids(spark: SparkSession, d: str) -> DataFrame:
    """The pseudonym of every part name as a nominative."""
    name = F.initcap("p_name")
    return table(spark, d, "part").select(
        "p_partkey",
        ids.name_key(name).alias("name_key"),
        ids.hash_id(F.concat_ws(" ", ids.name_key(name), F.col("p_partkey")), SALT).alias("hash"),
    )


def segment_table(spark: SparkSession, d: str) -> DataFrame:
    """Lines of conversations as segments of blocks."""
    return turn_segments(corpora.turn_nodes(table(spark, d, "conversations"))).select(
        "conv_id", "turn", "pos", "block_idx", "from", "to", "text"
    )


def segment_stats(spark: SparkSession, d: str) -> DataFrame:
    segments = turn_segments(corpora.turn_nodes(table(spark, d, "conversations")))
    return reports.segment_statistics(segments, ["conv_id", "block_idx"])


def turn_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Pieces of the blocks of signed conversations."""
    return transcript_blocks(spark, d).select("conv_id", "block_idx", "base", "text")


def segment_remap(spark: SparkSession, d: str) -> DataFrame:
    return transcript_job(spark, d).segments().select(
        "conv_id", "block_idx", "from", "to", "new_from", "new_to"
    )


def segment_text(spark: SparkSession, d: str) -> DataFrame:
    return transcript_job(spark, d).segments().select(
        "conv_id", "block_idx", "new_from", "new_to", "text"
    )


def segment_text_joined(spark: SparkSession, d: str) -> DataFrame:
    """The same with the list joined to the pieces."""
    return transcript_job(spark, d, "joined").segments().select(
        "conv_id", "block_idx", "new_from", "new_to", "text"
    )


def page_nodes(spark: SparkSession, d: str) -> DataFrame:
    pages = corpora.spread(table(spark, d, "pages").select("page_id", "html"), "page_id")
    return pages.select(
        "page_id", F.posexplode(corpora.page_tokens(F.col("html"))).alias("pos", "n")
    ).select("page_id", "pos", "n.tag", "n.action", "n.text")


def page_blocks(spark: SparkSession, d: str) -> DataFrame:
    pages = corpora.spread(table(spark, d, "pages").select("page_id", "html"), "page_id")
    return assembly.blocks_in_row(pages, ["page_id"], corpora.page_tokens(F.col("html"))).select(
        "page_id", "block_idx", "text", F.size("segments").alias("n_segments")
    )


MANY_NAMES = range(4, grammar.MAX_NAMES + 1)


def many_named(spark: SparkSession, d: str) -> DataFrame:
    """`c, names, surname`: for each number of names a person, made of the words of parts."""
    words = (
        table(spark, d, "part")
        .select(F.explode(F.split("p_name", " ")).alias("w"))
        .agg(F.sort_array(F.collect_set(F.initcap("w"))).alias("ws"))
    )
    own = F.substring(F.lit("abcdefghijklmno"), F.col("c") + 1, F.lit(1))
    return words.select(
        "ws", F.explode(F.lit(list(MANY_NAMES))).alias("c")
    ).select(
        "c",
        F.transform(F.slice("ws", 1, F.col("c")), lambda w: F.concat(w, own)).alias("names"),
        F.concat(F.initcap(F.reverse(F.get("ws", 0))), own).alias("surname"),
    )


def _many_names(spark: SparkSession, d: str, plan: str) -> DataFrame:
    """Orders signed with three names of a person, some of them said twice."""
    people = many_named(spark, d)
    key, c = F.col("o_orderkey"), F.col("c")
    said = F.transform(
        F.array(key % c, F.floor(key / 7) % c, F.floor(key / 49) % c),
        lambda i: F.get("names", i.cast("int")),
    )
    named = F.array_join(said, " ")
    # a row for each number of names
    texts = (
        table(spark, d, "orders")
        .select("o_orderkey", (key % len(MANY_NAMES) + MANY_NAMES[0]).cast("int").alias("c"))
        .join(F.broadcast(people), "c")
        .select(
            "o_orderkey",
            F.when(key % 2 == 0, F.concat_ws(" ", F.lit("paid by"), "surname", named))
            .otherwise(F.concat_ws(" ", F.lit("paid by"), named, "surname"))
            .alias("text"),
        )
    )
    lines = people.select(
        c.alias("line_no"), F.concat_ws(";", F.array_join("names", ":"), "surname").alias("line")
    )
    return redact(texts, ["o_orderkey"], people=lists.parse_people(lines), plan=plan).audit()


def many_names(spark: SparkSession, d: str) -> DataFrame:
    return _many_names(spark, d, "direct")


def many_names_inline(spark: SparkSession, d: str) -> DataFrame:
    return _many_names(spark, d, "inline")


def many_names_joined(spark: SparkSession, d: str) -> DataFrame:
    return _many_names(spark, d, "joined")


def homonyms_many_names(spark: SparkSession, d: str) -> DataFrame:
    """Orders signed with the names of people of four to ten names. For each set of names there
    are two people, so all of them are asked for; every third order lacks one."""
    people = many_named(spark, d)
    key, c = F.col("o_orderkey"), F.col("c")
    twins = people.select(
        "c", "names", F.explode(F.array("surname", F.concat("surname", F.lit("i")))).alias("surname")
    )
    turn = (F.floor(key / 6) % c).cast("int")
    turned = F.concat(F.slice("names", turn + 1, c), F.slice("names", 1, turn))
    said = F.array_join(turned, " ")
    last = F.when(F.floor(key / 3) % 2 == 0, F.col("surname")).otherwise(
        F.concat("surname", F.lit("i"))
    )
    texts = (
        table(spark, d, "orders")
        .select("o_orderkey", (key % len(MANY_NAMES) + MANY_NAMES[0]).cast("int").alias("c"))
        .join(F.broadcast(people), "c")
        .select(
            "o_orderkey",
            F.when(key % 3 == 0, F.concat_ws(" ", F.lit("paid by"), said, last))
            .when(key % 3 == 1, F.concat_ws(" ", F.lit("paid by"), last, said))
            .otherwise(
                F.concat_ws(" ", F.lit("paid by"), F.array_join(F.slice(turned, 2, c), " "), last)
            )
            .alias("text"),
        )
    )
    number = 2 * c + F.col("surname").endswith("i").cast("int")
    lines = twins.select(
        number.alias("line_no"), F.concat_ws(";", F.array_join("names", ":"), "surname").alias("line")
    )
    return redact(texts, ["o_orderkey"], people=lists.parse_people(lines)).audit()


def apostrophes(spark: SparkSession, d: str) -> DataFrame:
    """Parts signed with the name of their type and a surname with an apostrophe, which is
    spelt in four ways."""
    parts = table(spark, d, "part")
    name = F.initcap(F.lower("p_type"))
    tail = F.initcap(F.reverse(F.lower("p_type")))
    lines = parts.select(F.concat(name, F.lit(";D'"), tail).alias("line")).distinct()
    people = lists.parse_people(
        lists.number_rows(lines.withColumn("_head", F.lit(0)), ["_head"], "line", "line_no")
    )
    turn = F.col("p_partkey") % 4
    text = (
        F.when(turn == 0, F.concat(F.lit("by "), name, F.lit(" D'"), tail, F.lit(", paid")))
        .when(turn == 1, F.concat(F.lit("by D’"), tail, F.lit(" "), name))
        .when(turn == 2, F.concat(F.lit("by "), name, F.lit(" D` "), tail))
        .otherwise(F.concat(F.lit("by D´"), F.upper(tail), F.lit("\t"), name, F.lit(".")))
    )
    texts = parts.select("p_partkey", text.alias("text"))
    return redact(texts, ["p_partkey"], people=people).audit()


# expressions that begin, overlap and hold one another
NESTED_KEEP = ("The", "The of", "of the", "the", "e", "General Public License", "Public")


def _nested(spark: SparkSession, d: str, plan: str) -> DataFrame:
    exprs = constant(spark, expr=list(NESTED_KEEP))
    return protect.expression_spans(document_lines(spark, d), ["doc_id", "block_idx"], exprs, plan)


def nested_keep_expressions(spark: SparkSession, d: str) -> DataFrame:
    return _nested(spark, d, "pattern")


def nested_keep_expressions_held(spark: SparkSession, d: str) -> DataFrame:
    return _nested(spark, d, "held")


def nested_keep_expressions_joined(spark: SparkSession, d: str) -> DataFrame:
    return _nested(spark, d, "joined")


LEAST_WORD = 4


def word_expressions(spark: SparkSession, d: str) -> DataFrame:
    """A list that grows with the data: all words of documents, signs and all."""
    words = table(spark, d, "documents").select(F.explode(F.split("text", "[ \t\n\r]+")).alias("expr"))
    return words.filter(F.length("expr") >= LEAST_WORD).distinct()


def _word_keep(spark: SparkSession, d: str, plan: str | None) -> DataFrame:
    """Kept words in the lines of documents, counted by line: how many, where the first and
    last start, and the sum of their ends."""
    found = protect.expression_spans(
        document_lines(spark, d), ["doc_id", "block_idx"], word_expressions(spark, d), plan
    )
    return found.groupBy("doc_id", "block_idx").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("start").alias("first"),
        F.max("start").alias("last"),
        F.sum(F.col("end").cast("long") * (F.col("start") % 97 + 1)).alias("checksum"),
    )


def word_keep_expressions(spark: SparkSession, d: str) -> DataFrame:
    return _word_keep(spark, d, None)


def word_keep_expressions_joined(spark: SparkSession, d: str) -> DataFrame:
    return _word_keep(spark, d, "joined")


def frequency_report(spark: SparkSession, d: str) -> DataFrame:
    return report_text.frequency_lines(note_job(spark, d).frequencies())


def association_report(spark: SparkSession, d: str) -> DataFrame:
    return report_text.association_lines(note_job(spark, d).associations())


def package_tags(spark: SparkSession, d: str) -> DataFrame:
    tags = packages.nodes(turn_packages(spark, d)).filter("edge = 0")
    return tags.groupBy("doc_id", "part", "tag").agg(F.count(F.lit(1)).alias("n"))


def package_blocks(spark: SparkSession, d: str) -> DataFrame:
    pieces = package_pieces(turn_packages(spark, d))
    return pieces.select("doc_id", "block_idx", "base", "text")


def package_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of the redacted packages, read back."""
    return package_pieces(_redacted_packages(spark, d)).select("doc_id", "block_idx", "base", "text")


def package_stories(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of redacted packages of all kinds of parts, read back, with the part of each."""
    pieces = package_pieces(_redacted_packages(spark, d, _story_package))
    part = F.get("segments", 0)["part"]
    return pieces.select("doc_id", "block_idx", "base", part.alias("part"), "text")


def _redacted_packages(
    spark: SparkSession, d: str, make: Callable[[str, str, str, int], bytes] = _package
) -> DataFrame:
    made = staged(turn_packages(spark, d, make), "packages")
    redacted, _ = redact_packages(
        made, _keep(spark, NOTE_KEEP), people=listed_people(spark, d)
    )
    return redacted


def package_files(spark: SparkSession, d: str) -> DataFrame:
    """The redacted packages as files, in a folder for each role of a turn, read back: their
    names, and how many characters the texts of each have."""
    folder = f"{shared_folder(spark)}/results-{uuid.uuid4().hex}"
    role = table(spark, d, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("doc_id"), "role"
    )
    named = _redacted_packages(spark, d).join(role, "doc_id")
    package_sink.write_packages(
        named.withColumn("path", F.concat(F.lit("/in/"), "role", F.lit("/"), "doc_id", F.lit(".docx"))),
        folder,
    )
    files = packages.read_packages(spark, folder)
    below = F.regexp_extract("doc_id", "([^/]+/[^/]+)$", 1)
    return (
        package_pieces(files)
        .groupBy(below.alias("result"))
        .agg(F.sum(F.length("text").cast("long")).alias("n_chars"))
    )


def queries() -> dict[str, Query]:
    listed = (
        line_blocks, gate_stats, list_spans, list_redact, document_frequencies,
        validate_people, validate_name_counts, people_list, people_homonyms, people_variants,
        people_variants_homonym, person_forms, keep_expressions, name_dictionary,
        protected_spans, spans_after_keep, spans_after_keep_edge, match_audit, match_audit_joined,
        match_statuses, match_statuses_joined, match_status_counts,
        notes_redacted, notes_streamed, name_frequencies, associations, protected_shift,
        dictionary_spans, dictionary_spans_joined, word_dictionary_size, word_dictionary_spans,
        lettered_ids, lettered_batches, batches_redacted, dictionary_redacted,
        name_keys, hash_ids, segment_stats, turn_blocks, segment_remap, segment_text,
        segment_text_joined, homonyms_many_names, apostrophes, many_names, many_names_inline, many_names_joined, nested_keep_expressions,
        nested_keep_expressions_held, nested_keep_expressions_joined, word_keep_expressions,
        word_keep_expressions_joined, frequency_report, association_report,
        page_nodes, page_blocks, package_tags, package_blocks, package_redacted, package_files,
        package_stories,
    )
    named = {query.__name__: query for query in listed}
    named["turn_segments"] = segment_table
    return named
