"""Operators over a whole corpus, the pipeline, and the package without them."""

import heapq
import math
import random
import shutil
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from llm.conftest import plain

import corpus_pipeline
from inkveil.llm import decontaminate, mixing, queries, tokenfiles
from inkveil.llm.huffman import Code, code_lengths, limit_for
from inkveil.sources.corpora import table

SMALL = "/root/testdata/sf0.001"

# --- mixing --------------------------------------------------------------------------


def test_power_meets_its_target():
    tokens = [1000, 300, 50, 0, 7]
    power = mixing.power_for(tokens, target=1.5)
    assert math.isclose(mixing.entropy(mixing.weights(tokens, power)), 1.5, abs_tol=1e-9)
    power = mixing.power_for(tokens, limit=2.0)
    mix = mixing.weights(tokens, power)
    epochs = [w * mixing.least_budget(tokens, mix) / t for w, t in zip(mix, tokens, strict=True) if t]
    assert math.isclose(max(epochs), 2.0, abs_tol=1e-9) and math.isclose(min(epochs), 1.0)
    assert mixing.weights(tokens, 0)[3] == 0
    assert mixing.power_for([], limit=2.0) == 0.0
    assert mixing.power_for([5, 5], limit=1.0) == 0.0


@pytest.fixture(scope="module")
def sources(spark):
    rng = random.Random(9)
    rows = []
    for k in range(900):
        source = rng.choices(["a", "b", None, "d"], [60, 25, 10, 5])[0]
        rows.append((k, " ".join(["w"] * rng.randint(0, 20)) or None, source))
    rows += [(10_000 + k, None, "empty") for k in range(3)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("settings", [{}, {"limit": 3.0}, {"budget": 4000}, {"target": 1.9, "budget": 30_000}])
def test_mix_keeps_to_its_budget(sources, settings):
    rows = sources.collect()
    size = {r.doc_id: len((r.text or "").split()) for r in rows}
    of = {r.doc_id: r.source for r in rows}
    taken = mixing.report(sources, **settings).collect()
    tokens = Counter()
    for r in rows:
        tokens[r.source] += size[r.doc_id]
    names = sorted(tokens, key=str)
    total = [tokens[n] for n in names]
    power = mixing.power_for(total, settings.get("limit", 1.5), settings.get("target"), settings.get("budget"))
    mix = mixing.weights(total, power)
    budget = settings.get("budget") or mixing.least_budget(total, mix)
    for name, n, weight in zip(names, total, mix, strict=True):
        own = [r for r in taken if r.source == name]
        assert all(of[r.doc_id] == name and r.n_tokens == size[r.doc_id] for r in own)
        part = round(weight * budget)
        full = part // n if n else 1
        everyone = {i for i in of if of[i] == name}
        for epoch in range(full):
            once = [r.doc_id for r in own if r.epoch == epoch]
            assert len(once) == len(set(once)) and set(once) == everyone
        last = [r for r in own if r.epoch >= full]
        assert len(last) == len({r.doc_id for r in last}) and {r.epoch for r in last} <= {full}
        # the epoch cut short takes as many tokens as fit: no row of the cut block is left
        # that would still have fitted before the first that did not
        spent = sum(r.n_tokens for r in own)
        assert spent <= part if n else spent == 0
        assert part - spent < 20
        # all but one of its blocks are whole
        blocks = {r.doc_id: r.block for r in own}
        if full:
            by_block = Counter(blocks[i] for i in everyone)
            cut = Counter(r.block for r in last)
            assert sum(cut[b] < by_block[b] for b in cut) <= 1


def test_mix_of_odd_rows(edge, nothing):
    got = mixing.mixed(edge)
    assert got.columns == edge.columns
    assert {r.doc_id for r in got.select("doc_id").collect()} == {r.doc_id for r in edge.select("doc_id").collect()}
    assert mixing.mixed(nothing).count() == 0
    whole = mixing.mixed(edge, limit=1.0)
    assert plain(whole.select("doc_id").collect()) == plain(edge.select("doc_id").collect())


# --- token files -----------------------------------------------------------------------


def test_lengths_are_optimal_and_bounded():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 400):
        counts = rng.geometric(0.01, n) * rng.integers(0, 2, n)
        counts[0] = 5
        heap = [int(c) for c in counts if c]
        used = len(heap)
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            cost += both
            heapq.heappush(heap, both)
        lengths = code_lengths(counts, 30)
        assert (lengths * counts).sum() == (cost if used > 1 else counts[0])
        short = code_lengths(counts, max((used - 1).bit_length(), 1))
        assert short.max() <= max((used - 1).bit_length(), 1)
        assert sum(2.0**-k for k in short[short > 0]) <= 1
    skewed = np.array([2**k for k in range(40)])
    assert code_lengths(skewed, 16).max() == 16
    assert limit_for(50_000) == 17


def test_pack_and_unpack():
    rng = np.random.default_rng(2)
    counts = np.bincount(rng.zipf(1.3, 20_000) % 3000, minlength=3000)
    code = Code(code_lengths(counts, 16))
    used = np.flatnonzero(counts)
    texts = [rng.choice(used, n, p=counts[used] / counts.sum()) for n in (0, 1, 5, 255, 256, 257, 3000)]
    packed = [code.pack(ids, 256) for ids in texts]
    lanes = code.unpack([p for p, _ in packed], [m for _, m in packed], 256)
    at = 0
    for ids, (_, marks) in zip(texts, packed, strict=True):
        assert lanes[at : at + len(marks)].ravel()[: len(ids)].tolist() == ids.tolist()
        at += len(marks)


def test_encoder_equals_the_library():
    encoder = tokenfiles.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    letters = "abcdefgäöüßéABC019'!?.,.,\n\n-_   \t日😀ñ\xa0"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(1500)]
    texts += ["".join(rng.choice("ab.,\n é") for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    texts += ["", " ", "a ", " a", "<|endoftext|> b a<|endoftext|>", "don't we'll", "a.\nB c.\n"]
    for text in texts:
        expected = encoder.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == expected, text


def test_encoder_learns_each_word_once():
    encoder = tokenfiles.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    words = [a + b for a in ("the", "er", "ñe", "ou", "ble") for b in ("in", "st", "é", "ly", "on")]
    texts = [" ".join(f"{a}{sign}{b}" for b in words) for a in words for sign in (",", ".\n", "-")]
    expected = [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]
    found = encoder.encode_all(texts)
    assert [np.frombuffer(ids, encoder.kind).tolist() for ids in found] == expected
    # words with and without a blank before them, signs, line breaks; not their combinations
    assert len(encoder.pieces) <= 2 * len(words) + 10


def test_encoder_keeps_texts_apart(monkeypatch):
    encoder = tokenfiles.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    pieces = ["a", "'", "s", " ", "\n", "\t", "\x1c", "\x85", "\u3000", "7", "²", "×", "ж", "日", "e\u0301", ".,"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(4000)]
    texts[7] = texts[2000] = "b <|endoftext|>\n a"
    expected = [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]
    for segment, remembered in ((tokenfiles.SEGMENT, tokenfiles.REMEMBERED), (5, 20)):
        monkeypatch.setattr(tokenfiles, "SEGMENT", segment)
        monkeypatch.setattr(tokenfiles, "REMEMBERED", remembered)
        found = encoder.encode_all(texts)
        assert [np.frombuffer(ids, encoder.kind).tolist() for ids in found] == expected
    assert encoder.encode_all([]) == [] and encoder.encode(None) == b""


def token_rows(rows):
    """(doc_id, ids) by the library, ids of documents ascending, null last."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    return [(i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in ordered]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_hold_all_ids(spark, edge, nothing, tmp_path):
    rows = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    expected = token_rows(rows)
    folder = str(tmp_path / "files")
    tokenfiles.write(edge, folder, queries.byte_bpe)
    found = tokenfiles.documents(spark, folder).orderBy("start").collect()
    assert plain((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == plain(
        (i, len(ids), crc(ids)) for i, ids in expected
    )
    # rows of one id may stand in any order
    assert [r.doc_id for r in found] == [i for i, _ in expected]
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1]]
    pieces = tokenfiles.read_ids(spark, folder).orderBy("part", "doc", "piece").collect()
    whole = {}
    for p in pieces:
        whole.setdefault((p.part, p.doc), []).extend(p.ids)
    assert plain(map(crc, whole.values())) == plain(crc(ids) for _, ids in expected)
    assert max(len(ids) for _, ids in expected) > tokenfiles.BLOCK
    assert tokenfiles.report(nothing, queries.byte_bpe).count() == 0


# --- pipeline --------------------------------------------------------------------------


def test_pipeline_equals_brute_force(spark):
    from llm.test_documents import fingerprint, least_reachable

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_dedup", "decontaminate", "mix", "token_files",
    ]
    extra = spark.createDataFrame(
        [(9001, "123 456", None, "x", 7), (9002, None, None, None, None)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs = table(spark, SMALL, "documents").unionByName(extra)
    kept = [r for r in docs.collect() if any(c.isalpha() for c in r.text or "")]
    marks = [fingerprint(r.text) for r in kept]
    least = least_reachable([(m, r.doc_id) for m, r in zip(marks, kept, strict=True)])
    kept = [r for m, r in zip(marks, kept, strict=True) if least[m] == r.doc_id]
    items = [(str(r.item_id), decontaminate.words_of(r.text)) for r in table(spark, SMALL, "benchmark").collect()]
    grams = {tuple(w[k : k + 13]) for _, w in items for k in range(len(w) - 12)}
    assert all(len(w) >= 13 for _, w in items)
    clean = []
    for r in kept:
        own = decontaminate.words_of(r.text)
        hit = {k + j for k in range(len(own) - 12) if tuple(own[k : k + 13]) in grams for j in range(13)}
        if not (hit and 20 * len(hit) >= len(own)):
            clean.append(r)
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        if name != "token_files":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert len(out[0]) > len(out[1]) > len(out[2])
    assert out[2] == out[3] == out[4] == {r.doc_id for r in clean}
    taken = Counter(r.doc_id for r in docs.collect())
    by_id = {r.doc_id: r for r in clean}
    assert set(taken.values()) <= {1, 2}
    starts = docs.orderBy("start").collect()
    assert [r.doc_id for r in starts] == sorted(taken.elements())
    expected = dict(token_rows([(i, r.text) for i, r in by_id.items()]))
    assert all((r.n_tokens, r.ids_crc32) == (len(expected[r.doc_id]), crc(expected[r.doc_id])) for r in starts)


def test_pipeline_of_nothing(spark, edge, tmp_path):
    table(spark, SMALL, "benchmark").limit(0).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0
    odd = edge
    for _, stage in corpus_pipeline.STAGES[:-1]:
        odd = stage(spark, odd, SMALL)
        assert odd.columns == edge.columns and odd.count() > 0


def test_entry_without_these_operators(tmp_path):
    root = Path(corpus_pipeline.__file__).parent
    shutil.copytree(root / "inkveil", tmp_path / "inkveil", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout.split()[1:] == ["False", "True"]


def test_nothing_else_imports_them():
    root = Path(corpus_pipeline.__file__).parent
    for file in root.glob("inkveil/**/*.py"):
        if "llm" not in file.parts:
            assert "llm" not in file.read_text(), file
