"""Spot fingerprints against plain Python."""

import hashlib
import random
import re

import pytest
from llm.conftest import TEXTS, plain, sentence

from inkveil.llm import spots

ANCHORS = set(spots.ANCHORS.split())


def model(text, chain=2, distance=1):
    words = re.findall(spots.WORD, (text or "").lower())
    content = [k for k, w in enumerate(words) if w not in ANCHORS]
    if not content:
        return {" ".join(words)} if words else set()
    out = set()
    for k, w in [(-1, ""), *enumerate(words)]:
        after = [words[p] for p in content if p > k][:: distance][:chain]
        if after and (k < 0 or w in ANCHORS):
            out.add((w, *after))
    return out


def like(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        text, after = text or "", after or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        a, b, c = model(text), model(edited), model(after)
        out.append(
            (i, len(text), hashlib.sha256(edited.encode()).hexdigest(), like(a, b), like(a, c), len(a))
        )
    return out


def told(row):
    return (row.doc_id, row.n_chars, row.edited_sha256, row.near_edited, row.near_next, row.n_signatures)


SHORT = [t for t in TEXTS if len(t or "") < 10**5] + [
    "the", "of the", "The Cat", "cat the", "a b c d", "sat the cat the dog of it", "...", "der Hund und die Katze",
    "the the cat sat sat of", "日本 の 語", "l'eau de vie", *[sentence(k) + " the end of it" for k in range(40)],
]


def rough(rows):
    return plain((*r[:3], round(r[3], 9), round(r[4], 9), r[5]) for r in rows)


@pytest.mark.parametrize("size", [2, 5, 4096])
def test_report_equals_model(spark, size):
    rows = list(enumerate(SHORT))
    random.Random(2).shuffle(rows)
    docs = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in rows], "doc_id long, text string, next string, chunk int"
    ).repartition(4)
    got = spots.report(docs, least=1e-6, size=size).collect()
    assert rough(map(told, got)) == rough(expected(rows))
    by_set = {}
    for r in got:
        text = dict(rows)[r.doc_id]
        by_set.setdefault(frozenset(model(text)), set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_set.values()) and len(set.union(*by_set.values())) == len(by_set)


@pytest.mark.parametrize("size", [1, 3, 4096])
def test_ties_nulls_and_copies(spark, edge, size):
    rows = [(5, sentence(1))] * 20 + [(5, sentence(2)), (None, "null id"), (None, "other"), (1, "first one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = spots.report(docs, size=size).collect()
    assert len(got) == len(rows)
    # the text of each row is followed by another row's: every text is followed as often as it stands
    assert sum(r.near_next == 1 for r in got if r.doc_id == 5) in (18, 19)
    assert spots.report(edge, size=size).count() == edge.count()


def test_chains(spark):
    text = "the big cat and dog of house"
    df = spark.createDataFrame([(text,)], "t string")
    for chain, distance in ((1, 1), (2, 2), (3, 1)):
        found = df.select(spots.signatures(df.t, chain=chain, distance=distance).alias("s")).first().s
        assert len(found) == len(model(text, chain, distance))


def test_pruning(spark):
    rows = [(list(range(n)), list(range(m))) for n in range(0, 40, 3) for m in range(0, 40, 3)]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    for least in (0.02, 0.5, 0.8):
        for r in df.select("a", "b", spots.likeness(df.a, df.b, least).alias("x")).collect():
            exact = like(set(r.a), set(r.b))
            assert r.x == pytest.approx(exact if exact >= least else 0)


def test_few_rows(spark, nothing):
    assert spots.report(nothing).collect() == []
    one = spark.createDataFrame([(3, "the cat sat")], "doc_id long, text string")
    assert [r.near_next for r in spots.report(one).collect()] == [1.0]
