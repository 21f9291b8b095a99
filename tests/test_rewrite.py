"""New offsets, cuts and audits against step-by-step models."""

import random
import time
from collections import Counter

import model
import pytest
from inkveil.functions import spans
from inkveil.operators import detect, protect, rewrite
from inkveil.operators import people as persons
from inkveil.operators.pseudonyms import Registry
from inkveil.plans.redaction import redact
from inkveil.sources import lists
from pyspark.sql import functions as F

SCHEMA = (
    "id int, text string, segments array<struct<seg_idx:int,from:int,to:int>>, "
    "edits array<struct<start:int,end:int,replacement:string>>, kept array<struct<start:int,end:int>>"
)


def case(rng, number, size, n_segments, n_edits):
    text = "".join(rng.choices("abcdefgh ", k=size))
    bounds = [0, *sorted(rng.choices(range(size + 1), k=n_segments - 1)), size]
    segments = [(i, a, b) for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]
    places = sorted(rng.sample(range(size), min(2 * n_edits, size // 2 * 2)))
    edits = [(a, b, "X" * rng.randrange(7)) for a, b in zip(places[::2], places[1::2], strict=True)]
    kept = sorted((p, p + 1) for p in rng.sample(range(size), 5) if not any(a <= p < b for a, b, _ in edits))
    return (number, text, segments, edits, kept)


def written(text, segments, edits):
    """Segments as texts: a replacement goes into the one where its match starts."""
    owner = {p: i for i, a, b in segments for p in range(a, b)}
    out, covered = [""] * len(segments), {p for a, b, _ in edits for p in range(a, b)}
    put = {a: r for a, _, r in edits}
    for p, c in enumerate(text):
        out[owner[p]] += put.get(p, "") + ("" if p in covered else c)
    return out


@pytest.mark.parametrize("short", [0, 16])
def test_remap_equals_model(spark, monkeypatch, short):
    monkeypatch.setattr(spans, "SHORT", short)
    rng = random.Random(9)
    rows = [case(rng, k, rng.randrange(10, 300), rng.randrange(1, 90), rng.randrange(0, 60)) for k in range(80)]
    df = rewrite.segment_edits(spark.createDataFrame(rows, SCHEMA))
    got = {}
    for r in rewrite.segment_rows(df, ["id"]).collect():
        got.setdefault(r.id, []).append(r)
    moved = {r.id: r.m for r in df.select("id", spans.shifted(F.col("kept"), F.col("edits")).alias("m")).collect()}
    for number, text, segments, edits, kept in rows:
        own = sorted(got[number], key=lambda r: r.seg_idx)
        want = written(text, segments, edits)
        assert [r.text for r in own] == want
        ends = [sum(map(len, want[: k + 1])) for k in range(len(want))]
        assert [(r.new_from, r.new_to) for r in own] == list(zip([0, *ends[:-1]], ends, strict=True))
        new = "".join(want)
        assert [new[k.start : k.end] for k in moved[number]] == [text[a:b] for a, b in kept]


def test_many_edits_in_one_block(spark):
    def seconds(n):
        rng = random.Random(n)
        row = case(rng, 1, 8 * n, n, n)
        df = spark.createDataFrame([row], SCHEMA)
        begin = time.perf_counter()
        rewrite.segment_rows(rewrite.segment_edits(df), ["id"]).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds(1000)
    assert seconds(16_000) < 6 * max(seconds(4000), 0.5)


def test_overlapping_spans_are_cut_whole(spark):
    text = "x" * 10 + "y" * 300
    some = sorted([(0, 300), *[(k, k + 3) for k in range(1, 290, 2)]])
    df = spark.createDataFrame([(text, some)], "t string, s " + spans.SPANS)
    assert df.select(spans.cuts(df.t, df.s).alias("c")).first().c == [text[a:b] for a, b in some]


PEOPLE = ["Mario:Luca;Rossi", "Luca;Rossi", "Anna;Verdi", "Verdi;Anna", "Rossi;Mario"]


@pytest.mark.parametrize("plan", ["direct", "inline", "joined"])
def test_shadowed_equals_model(spark, lines, blocks, plan):
    rng = random.Random(31)
    words = ["Mario", "Luca", "Rossi", "Anna", "Verdi", "e"]
    some = [" ".join(rng.choices(words, k=rng.randint(3, 9))) for _ in range(200)]
    listed = [(p.split(";")[0].split(":"), p.split(";")[1]) for p in PEOPLE]
    patterns = [
        (i, model.person_pattern(*p, tight))
        for i, (p, tight) in enumerate(zip(listed, model.homonyms(listed), strict=True), 1)
    ]
    entries = persons.entries(lists.parse_people(lines(*PEOPLE)))
    ords = {r.ord for r in entries.collect()}
    got = detect.detect(blocks(*some), ["doc_id"], entries, plan=plan, report_shadowed=True)
    total = 0
    for row in got.collect():
        found = model.search(row.text, [p for p in patterns if p[0] in ords])
        own = [p for p in patterns if p[0] in ords]
        lost = [
            (a, b, n, "shadowed")
            for n, pattern in own
            for a, b, *_ in model.search(row.text, [(n, pattern)])
            if any(x < b and a < y and m < n for x, y, m, _ in found)
        ]
        total += len(lost)
        assert [(s.start, s.end, s.ord, s.status) for s in row.found] == sorted(found + lost), row.text
    assert total > 20


def test_four_statuses(spark, lines):
    text = "Mario Luca Rossi e Anna Verdi, Anna Verdi"
    df = spark.createDataFrame(
        [(1, text, [(0, 0, 25)])], "doc_id int, text string, segments array<struct<seg_idx:int,from:int,to:int>>"
    )
    people = lists.parse_people(lines(*PEOPLE))
    exprs = spark.createDataFrame([("Anna Verdi,",)], "expr string")
    job = redact(df, ["doc_id"], people=people, keep_exprs=exprs, report_shadowed=True)
    told = {(r.matched, r.start, r.entry_id): (r.status, r.beaten_by) for r in job.full_audit().collect()}
    assert told[("Mario Luca Rossi", 0, 1)] == ("replaced", None)
    assert told[("Luca Rossi", 6, 2)] == ("shadowed", 1)
    assert told[("Anna Verdi", 19, 3)] == ("protected", None)
    assert told[("Anna Verdi", 31, 3)] == ("orphan", None)
    assert {s for s, _ in told.values()} == {"replaced", "shadowed", "protected", "orphan"}


@pytest.mark.parametrize("rule", ["overlap", "edge"])
def test_unprotected_equals_pairs(spark, rule):
    rng = random.Random(5)

    def some(n):
        starts = [rng.randrange(400) for _ in range(n)]
        return [(rng.choice([1, 2, None]), s, s + rng.choice([1, 3, 30, 200])) for s in starts]

    found, kept = some(60) + [(1, 7, 7)] * 2, some(12) + [(2, 9, 9), (2, 63, 65)]
    schema = "b int, start int, end int"
    frames = [spark.createDataFrame(x, schema) for x in (found, kept)]
    named = frames[0].withColumn("_k_b", F.lit("x"))
    got = protect.unprotected(named, frames[1], ["b"], rule)
    assert got.columns == named.columns

    def touched(s, k):
        if s[0] is None or s[0] != k[0] or s[1] == s[2] or k[1] == k[2]:
            return False
        if rule == "overlap":
            return k[1] < s[2] and s[1] < k[2]
        return k[1] <= s[1] < k[2] or k[1] < s[2] <= k[2]

    rest = [s for s in found if not any(touched(s, k) for k in kept)]
    assert Counter(tuple(r)[:3] for r in got.collect()) == Counter(rest)
    assert protect.unprotected(frames[0], frames[1].limit(0), ["b"], rule).count() == len(found)


def test_unprotected_hot_block(spark):
    """Spans and protected spans of one block, 100,000 each: no row meets more than a few."""
    n = 100_000
    found = spark.range(n).select(F.lit(1).alias("b"), (F.col("id") * 8).alias("start"), (F.col("id") * 8 + 5).alias("end"))
    kept = spark.range(n).select(F.lit(1).alias("b"), (F.col("id") * 16 + 4).alias("start"), (F.col("id") * 16 + 6).alias("end"))
    assert protect.unprotected(found, kept, ["b"]).count() == n // 2


def test_registry_keeps_letters(spark, tmp_path):
    def rows(*names):
        data = [(k, 0, 7, name) for k, name in enumerate(names)]
        return spark.createDataFrame(data, "doc int, start int, entry_id long, name_key string")

    def ids(frame):
        return {r.name_key: r.pseudonym for r in frame.collect()}

    folder = str(tmp_path / "registry")
    registry = Registry(spark, folder)
    order = ["doc", "start"]
    assert ids(registry.add("0", rows(), order)) == {}
    assert ids(registry.add("1", rows("b", "a", "b"), order)) == {"b": "IDA7", "a": "IDB7"}
    # run again, as after a failure
    assert ids(registry.add("1", rows("b", "a", "b"), order)) == {"b": "IDA7", "a": "IDB7"}
    later = Registry(spark, folder)
    assert ids(later.add("2", rows("c", "a"), order)) == {"a": "IDB7", "c": "IDC7"}
    many = [f"n{k:03}" for k in range(80)]
    full = ids(later.add("3", rows(*many), order))
    assert (full["n000"], full["n048"], full["n079"]) == ("IDD7", "IDz7", "IDz7")
    assert ids(later.ids())["b"] == "IDA7"
    assert later.ids().count() == later.ids().select("name_key").distinct().count() == 83
    with pytest.raises(ValueError):
        registry.add("2", rows("x"), order)


def test_shadowed_matches_share_the_joined_search(lines, blocks):
    entries = persons.entries(lists.parse_people(lines("Mario:Luca;Rossi", "Luca;Rossi")))

    def steps(shadowed):
        found = detect.detect(
            blocks("Mario Luca Rossi", "Luca Rossi"), ["doc_id"], entries, plan="joined",
            report_shadowed=shadowed,
        )
        shown = found._jdf.queryExecution().optimizedPlan().toString()
        return [shown.count(x) for x in ("Generate ", "Join ")]

    assert steps(True) == steps(False)


def test_a_stretch_is_searched_once(lines, blocks):
    people = lists.parse_people(lines("Mario:Luca;Rossi", "Luca;Rossi", "Anna;Neri"))
    for plan in ("inline", "joined"):
        found = detect.detect(
            blocks("Mario Luca Rossi, Luca Rossi", "Anna Neri", None), ["doc_id"],
            persons.entries(people), plan=plan, report_shadowed=True,
        )
        shown = found._jdf.queryExecution().optimizedPlan().toString()
        # shadowed matches come from the same candidates, and entries of a text are grouped once
        assert "aggregate(" not in shown
        assert shown.count("ArrowEvalPython") <= (1 if plan == "inline" else 2)
        assert shown.count("Aggregate ") == (0 if plan == "inline" else 1)
        told = {r.doc_id: [(s.start, s.end, s.ord, s.status) for s in r.found] for r in found.collect()}
        assert told == {
            0: [(0, 16, 1, "replaced"), (6, 16, 2, "shadowed"), (18, 28, 2, "replaced")],
            1: [(0, 9, 3, "replaced")],
            2: [],
        }


@pytest.mark.parametrize("plan", ["inline", "joined"])
def test_expressions_of_candidates_are_not_compiled(lines, blocks, plan):
    # a person's names are compared, whatever the pattern says
    entries = persons.entries(lists.parse_people(lines("Mario:Luca;Rossi"))).withColumn(
        "pattern", F.lit("(")
    )
    found = detect.detect(blocks("see Rossi LUCA"), ["doc_id"], entries, plan=plan).first().found
    assert [(s.start, s.end) for s in found] == [(4, 14)]


def test_joined_search_reads_the_blocks_once(spark, lines, blocks):
    people = lists.parse_people(lines("Mario;Rossi"))
    some = blocks("see Mario Rossi", "nothing", None).repartition(2)
    job = redact(some, ["doc_id"], people=people, plan="joined")
    for told in (job.audit(), job.spans()):
        shown = told._jdf.queryExecution().optimizedPlan().toString()
        # the blocks were written when they passed the gate; the others are not read
        assert "Repartition" not in shown and "Union" not in shown
    assert [tuple(r) for r in job.audit().collect()] == [(0, 4, 15, "Mario Rossi", 1, "replaced")]
    assert sorted(r.doc_id for r in job.texts().collect()) == [0, 1, 2]
