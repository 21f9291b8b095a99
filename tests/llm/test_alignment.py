"""Alignment of two tokenizers, against pairs of byte ranges compared one by one."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm.conftest import TEXTS, plain, sentence
from tokenizers import Tokenizer, decoders

from inkveil.llm import alignment, queries
from inkveil.llm.alignment import Csr, align, incidence, product

ODD = [
    "x", " ", "  two  blanks ", "tab\tand\r\nline\n\n", "▁ piece sign", "<s> </s> <|endoftext|> <0x41>",
    "日本語のテキスト 😀😀", "naïve café ﬁ ①", "word " * 50, "a" * 5000, " " * 5000, "'s I'll 'RE 12345",
]


def dense(m):
    out = np.zeros((m.rows, m.width), int)
    for i in range(m.rows):
        at = slice(m.ends[i], m.ends[i + 1])
        out[i, m.columns[at]] = 1 if m.values is None else m.values[at]
    return out


@pytest.mark.parametrize("entries", [1, 7, 1 << 20])
def test_product_equals_dense(monkeypatch, entries):
    monkeypatch.setattr(alignment, "PRODUCT_ENTRIES", entries)
    rng = np.random.default_rng(4)
    for n, k, m in [(0, 3, 2), (3, 0, 2), (5, 4, 0), (6, 9, 5), (20, 15, 30)]:
        pair = []
        for rows, cols in ((n, k), (k, m)):
            some = rng.random((rows, cols)) < 0.3
            ends = np.concatenate([[0], np.cumsum(some.sum(axis=1))]).astype(int)
            pair.append(Csr(ends, np.nonzero(some)[1], cols))
        a, b = pair
        assert (dense(product(a, b)) == dense(a) @ dense(b)).all()
        assert (dense(b.transposed()) == dense(b).T).all()


@pytest.mark.parametrize("size", [1, 5, 1 << 19])
def test_links_equal_overlaps(monkeypatch, size):
    monkeypatch.setattr(alignment, "BATCH_BYTES", size)
    rng = random.Random(8)
    for _ in range(60):
        total = rng.randrange(1, 60)
        a, b = (np.diff([0, *sorted(rng.choices(range(total + 1), k=rng.randrange(9))), total]) for _ in "ab")
        found = align(a, b)
        a_span, b_span = (list(zip(np.cumsum(x) - x, np.cumsum(x), strict=True)) for x in (a, b))
        lap = [[max(min(q, z) - max(p, y), 0) for y, z in b_span] for p, q in a_span]
        assert (dense(found.links) == np.array(lap)).all()
        ends = sorted({q for _, q in a_span} & {z for _, z in b_span})
        group = lambda end: sum(e < end for e in ends)
        same = [[group(q) == group(z) for _, z in b_span] for _, q in a_span]
        assert (dense(found.shared()) == np.array(same)).all()
        assert (found.shared_sizes() == np.array(same).sum(axis=1)).all()
    assert align(np.zeros(0, int), np.zeros(0, int)).links.rows == 0
    assert incidence(np.zeros(0, int)).rows == 0


def brute(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest, n_group_links) for each text."""
    byte_bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    byte_bpe.encode_special_tokens = True
    level = {c: b for b, c in zip(range(256), map(lambda b: stand(b), range(256)), strict=True)}
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found, corpus = [], Counter()
    for text in texts:
        if not text:
            found.append(None)
            continue
        a = [(i, bytes(level[c] for c in byte_bpe.id_to_token(i))) for i in byte_bpe.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in pieces.encode(text):
            p = pieces.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()))
        if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
            found.append(None)
            continue
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i, x in side:
                own.append((i, at, at + len(x)))
                at += len(x)
            spans.append(own)
        ends = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, links, begin = [], [], 0
        for end in ends:
            groups.append([[t for t in own if begin < t[2] <= end] for own in spans])
            begin = end
            links += [(x[0], y[0]) for x in groups[-1][0] for y in groups[-1][1] if x[1] < y[2] and y[1] < x[2]]
        corpus.update(links)
        found.append((len(a), len(b), groups, links))
    best = {}
    for (_, b), n in corpus.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for row in found:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, "", 0))
            continue
        n_a, n_b, groups, links = row
        listed = ";".join("|".join(",".join(str(t[0]) for t in side) for side in g) for g in groups)
        out.append(
            (
                n_a, n_b, len(groups), len(links),
                sum(corpus[x] == best[x[1]] for x in links), sum(corpus[x] for x in links),
                hashlib.sha256(listed.encode()).hexdigest(), sum(len(g[0]) * len(g[1]) for g in groups),
            )
        )
    return out


def stand(byte):
    """The sign that stands for a byte: the library's own decoder is asked."""
    return STANDS[byte]


STANDS = {}
for sign in map(chr, range(33, 400)):
    if len(back := decoders.ByteLevel().decode([sign]).encode("utf-8", "surrogatepass")) == 1:
        STANDS[back[0]] = sign
plain_signs = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
STANDS |= {b: chr(b) for b in plain_signs if b > 127}
STANDS |= {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in plain_signs)}


@pytest.mark.parametrize("in_memory", [0, 1 << 20])
def test_report_equals_brute_force(spark, edge, in_memory):
    texts = ODD + [t for t in TEXTS if len(t or "") < 10**5] + [sentence(k) for k in range(20)] + [sentence(3)]
    rows = [(k, t, "x", k) for k, t in enumerate(texts)] + [(None, "null id", None, None), (3, ODD[3], "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pairs string, row int").repartition(3)
    got = alignment.report(docs, queries.byte_bpe, queries.piece_bpe, in_memory=in_memory).collect()
    want = [(i, *w) for (i, *_), w in zip(rows, brute([r[1] for r in rows]), strict=True)]
    assert plain(map(tuple, got)) == plain((r[0], *r[1:7], r[7], r[8]) for r in want)
    assert sum(r.n_links > 0 for r in got) > 20
    assert sum(r.n_links == 0 for r in got) == 3


def test_long_and_empty_tables(edge, nothing):
    got = alignment.report(edge, queries.byte_bpe, queries.piece_bpe).collect()
    assert len(got) == edge.count()
    assert alignment.report(nothing, queries.byte_bpe, queries.piece_bpe).collect() == []


def test_links_as_rows(spark):
    docs = spark.createDataFrame([(1, "unbelievable stuff"), (2, None)], "doc_id long, text string")
    links = alignment.overlap_links(docs, queries.byte_bpe, queries.piece_bpe).collect()
    report = alignment.report(docs, queries.byte_bpe, queries.piece_bpe).collect()
    assert len(links) == sum(r.n_links for r in report) > 0
    assert sum(x.bytes for x in links) == len(" unbelievable stuff")
