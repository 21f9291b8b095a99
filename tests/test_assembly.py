import random

import model
import pytest
from pyspark.sql import functions as F

from inkveil.operators import assembly, detect, rewrite
from inkveil.operators import people as persons
from inkveil.plans.redaction import redact
from inkveil.sources import corpora, lists

ACTIONS = ["text"] * 6 + ["separator"] * 2 + ["ignore", "break"]
TEXTS = ["Le", "andro ", "Con", "tini", ".", "", "Mario Rossi. ", "Anna", " ", "x, "]


def stream(n, seed, families=4):
    rng = random.Random(seed)
    out, family = [], 0
    for _ in range(n):
        if rng.random() < 0.15:
            family = (family + 1) % families
        action = rng.choice(ACTIONS)
        text = {"text": rng.choice(TEXTS), "separator": "\t"}.get(action)
        out.append((family, action, text))
    return out


@pytest.fixture
def nodes(spark):
    def make(docs):
        rows = [(d, i, *node) for d, some in docs.items() for i, node in enumerate(some)]
        return spark.createDataFrame(
            rows, "doc_id int, pos int, family int, action string, text string"
        )

    return make


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_segments_equal_model_for_any_chunk(nodes, size):
    docs = {d: stream(120, d) for d in range(6)}
    docs[6] = [(0, "break", None)] * 9 + [(0, "text", "a")] + [(0, "break", None)] * 8
    docs[7] = [(0, "ignore", None)] * 3
    got = assembly.segments_of(
        nodes(docs), ["doc_id"], ["pos"], F.floor(F.col("pos") / size), ["family"]
    ).collect()
    for d, some in docs.items():
        rows = sorted((r.pos, r.block_idx, r["from"], r.to, r.text) for r in got if r.doc_id == d)
        expected = [
            (idx, a, b) for idx, (_, offsets) in enumerate(model.assemble(some)) for a, b in offsets
        ]
        assert [r[1:4] for r in rows] == expected


def test_pieces_make_up_blocks_and_cut_no_name(spark, nodes, lines):
    docs = {d: stream(150, 50 + d, families=2) for d in range(5)}
    segments = assembly.segments_of(
        nodes(docs), ["doc_id"], ["pos"], F.floor(F.col("pos") / 10), ["family"]
    )
    pieces = assembly.blocks_of(segments, ["doc_id"], ["pos"], ["pos"])
    people = lists.parse_people(lines("Leandro;Contini", "Mario;Rossi", "Anna;Le"))
    opened = detect.gated_blocks(pieces, ["doc_id", "block_idx"]).withColumn("open", F.lit(True))
    job = redact(
        pieces.join(opened, ["doc_id", "block_idx"], "left"),
        ["doc_id", "block_idx", "piece"],
        people=people,
        gate=F.coalesce("open", F.lit(False)),
    )
    got, base = {}, {}
    for r in job.texts().collect():
        got.setdefault((r.doc_id, r.block_idx), []).append((r.piece, r.text))
    for r in pieces.collect():
        base.setdefault((r.doc_id, r.block_idx), []).append((r.piece, r.base, r.text))
    assert max(len(v) for v in base.values()) > 1
    whole = [
        (d, i, text) for d, some in docs.items() for i, (text, _) in enumerate(model.assemble(some))
    ]
    expected = {
        (r.doc_id, r.block_idx): r.text
        for r in redact(
            spark.createDataFrame(whole, "doc_id int, block_idx int, text string"),
            ["doc_id", "block_idx"],
            people=people,
        ).texts().collect()
    }
    for key, text in expected.items():
        parts = sorted(base[key])
        assert [b for _, b, _ in parts] == [
            sum(len(t) for _, _, t in parts[:i]) for i in range(len(parts))
        ]
        assert "".join(t for _, t in sorted(got[key])) == text


def test_array_form_equals_row_form(spark):
    docs = {d: [(0, a, t) for _, a, t in stream(60, 80 + d)] for d in range(6)}
    rows = [(d, [(a, t) for _, a, t in some]) for d, some in docs.items()]
    df = spark.createDataFrame(rows, "doc_id int, nodes array<struct<action:string,text:string>>")
    got = assembly.blocks_in_row(df, ["doc_id"], F.col("nodes")).orderBy("doc_id", "block_idx")
    for d, some in docs.items():
        # an empty block cannot hold a name; the array form has none
        expected = [(t, o) for t, o in model.assemble(some)]
        mine = [
            (r.text, [(s["from"], s["to"]) for s in r.segments])
            for r in got.filter(F.col("doc_id") == d).collect()
        ]
        assert mine == expected


def segment_job(spark, parts, people):
    offsets, pos = [], 0
    for i, part in enumerate(parts):
        offsets.append((i, pos, pos + len(part)))
        pos += len(part)
    df = spark.createDataFrame(
        [(1, "".join(parts), offsets)],
        "doc_id int, text string, segments array<struct<seg_idx:int,from:int,to:int>>",
    )
    job = redact(df, ["doc_id"], people=people)
    return [r.text for r in job.segments().orderBy("seg_idx").collect()]


def test_name_split_over_segments(spark, lines):
    people = lists.parse_people(lines("Leandro:Mario;Contini"))
    assert segment_job(spark, ["Leand", "ro Con", "tini."], people) == ["ID1", "", "."]
    assert segment_job(spark, ["Contini", "\t", "Leandro", "!"], people) == ["ID1", "", "", "!"]
    assert segment_job(spark, ["Il Sig. ", "", "Mario", " ", "Contini e Leandro Contini"], people) == [
        "Il Sig. ", "", "ID1", "", " e ID1",
    ]


def test_segments_always_add_up(spark, lines):
    rng = random.Random(9)
    people = lists.parse_people(lines("Leandro;Contini", "Mario;Rossi"))
    rows = []
    for d in range(150):
        parts = [rng.choice(TEXTS) for _ in range(rng.randint(1, 12))]
        offsets, pos = [], 0
        for i, part in enumerate(parts):
            offsets.append((i, pos, pos + len(part)))
            pos += len(part)
        rows.append((d, "".join(parts), offsets))
    df = spark.createDataFrame(
        rows, "doc_id int, text string, segments array<struct<seg_idx:int,from:int,to:int>>"
    )
    job = redact(df, ["doc_id"], people=people)
    texts = {r.doc_id: r.text for r in job.texts().collect()}
    joined = {}
    for r in sorted(job.segments().collect(), key=lambda r: (r.doc_id, r.seg_idx)):
        assert r.new_to - r.new_from == len(r.text)
        joined[r.doc_id] = joined.get(r.doc_id, "") + r.text
    assert joined == texts
    assert rewrite.orphans(job.blocks, ["doc_id"]).isEmpty()


def test_page_tokens(spark):
    html = (
        '<!DOCTYPE html><p>a <b>Ma</b>rio<br>x</p><!-- <p> --><script>if (1<2) "</p>"</script>'
        "<li>1 < 2<a href='/'>y"
    )
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    got = assembly.blocks_in_row(df, ["page_id"], corpora.page_tokens(F.col("html")))
    assert [r.text for r in got.orderBy("block_idx").collect()] == ["a Mario\tx", "1 < 2y"]


def test_entries_of_lists_are_small(spark, lines):
    size = detect.measure(persons.entries(lists.parse_people(lines("Leandro:Mario;Contini"))))
    assert (size.entries, size.keys, size.widths, size.plain) == (1, 2, (2,), True)
