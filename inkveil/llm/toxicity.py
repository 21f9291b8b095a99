"""Toxicity by multiple-instance learning.

Labels say whether a document is toxic, not where. A sentence's probability is logistic in its
word features; a document is toxic if any sentence is (noisy-or), and the weights are fitted
to the document labels through that. The fitted sentence scores then locate the sentences.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkveil.llm.common import bucket, raw, resident

FOLDS, HELD_OUT = 5, 0
#: Labelled rows that the weights are fitted on: some SAMPLE_ROWS of each class, drawn by a
#: hash of the id, none longer than SAMPLE_CHARS code points.
SAMPLE_ROWS = 8_000
SAMPLE_CHARS = 40_000
#: Features are hashed; a feature needs LEAST_DOCS toxic rows and a log-odds of LEAST_Z
#: standard errors to get a weight.
HASHES = 1 << 22
LEAST_DOCS = 4
LEAST_Z = 3.5
PREFIXES = (4, 5, 6)
STEPS, RATE, PENALTY = 600, 0.1, 0.01
#: Words whose weights a worker remembers.
REMEMBERED = 400_000

# lower-cases A-Z; sentences end at . ! ? and line breaks; other signs part words
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90
    else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122
    else 10 if c in b".!?\n" else 32
    for c in range(256)
)


def features(word: bytes) -> list[int]:
    """Hashes of the word and of its beginnings."""
    own = [word + b"$", *[word[:k] for k in PREFIXES if len(word) > k]]
    return [zlib.crc32(f) % HASHES for f in own]


def sentences(data: bytes) -> Iterator[tuple[int, int, list[bytes]]]:
    """Start, end (bytes) and words of each sentence that has words."""
    begin = 0
    for part in data.translate(_PLAIN).split(b"\n"):
        if words := part.split():
            yield begin, begin + len(part), words
        begin += len(part) + 1


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, feature) for the distinct features of each row."""
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), raw(batch.column(1)), strict=True):
            words = {w for _, _, s in sentences(text) for w in s}
            found = sorted({f for w in words for f in features(w)})
            yield pa.RecordBatch.from_arrays(
                [pa.array([toxic] * len(found), pa.int32()), pa.array(found, pa.int32())],
                names=["toxic", "feature"],
            )


_BAGS = "id string, toxic int, plain long, sizes array<int>, features array<int>"


def _bags(chosen: frozenset[int]):
    """A function of rows to (id, toxic, plain, sizes, features): how many sentences have no
    chosen feature, how many the others have each, and which they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain, sizes, found = [], [], []
            for text in raw(batch.column(1)):
                own = [
                    [f for w in words for f in features(w) if f in chosen]
                    for _, _, words in sentences(text)
                ]
                sizes.append([len(bag) for bag in own if bag])
                found.append([f for bag in own for f in bag])
                plain.append(len(own) - len(sizes[-1]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(2).cast(pa.string()),
                    batch.column(0).cast(pa.int32()),
                    pa.array(plain, pa.int64()),
                    pa.array(sizes, pa.list_(pa.int32())),
                    pa.array(found, pa.list_(pa.int32())),
                ],
                names=["id", "toxic", "plain", "sizes", "features"],
            )

    return run


def fit(rows: pa.Table) -> tuple[float, dict[int, float]]:
    """Bias and weights that make the noisy-or over sentences fit the labels best."""
    rows = rows.sort_by([("id", "ascending"), ("plain", "ascending")]).combine_chunks()

    def flat(name: str) -> np.ndarray:
        return pa.concat_arrays(
            [c.flatten() for c in rows.column(name).chunks] or [pa.array([], pa.int32())]
        ).to_numpy()

    toxic, plain = (rows.column(c).to_numpy().astype(float) for c in ("toxic", "plain"))
    bags = np.array([len(x) for x in rows.column("sizes")], np.int64)
    sizes = flat("sizes")
    names, weight_of = np.unique(flat("features"), return_inverse=True)
    owner = np.repeat(np.arange(len(bags)), bags)
    bag_of = np.repeat(np.arange(len(sizes)), sizes)
    values = np.zeros(len(names) + 1)
    values[-1] = -7.0
    first, second = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, STEPS + 1):
        bias = values[-1]
        z = bias + np.bincount(bag_of, values[weight_of], len(sizes))
        clean = -np.bincount(owner, np.logaddexp(0, z), len(bags)) - plain * np.logaddexp(0, bias)
        # derivative of the loss by the log-probability of "no sentence is toxic"
        slope = np.where(toxic > 0, 1 / np.maximum(np.expm1(-clean), 1e-9), -1.0)
        by_z = -slope[owner] / (1 + np.exp(-z))
        grad = np.zeros_like(values)
        grad[:-1] = np.bincount(weight_of, by_z[bag_of], len(names)) + PENALTY * values[:-1]
        grad[-1] = by_z.sum() - (slope * plain).sum() / (1 + np.exp(-bias))
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        values -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return float(values[-1]), dict(zip(names.tolist(), values[:-1].tolist(), strict=True))


class Scorer:
    """Sentence logits from word weights; remembers a bounded number of words."""

    def __init__(self, bias: float, weights: dict[int, float]) -> None:
        self.bias, self.weights = bias, weights
        self.plain = float(np.logaddexp(0.0, bias))
        self.words: dict[bytes, float] = {}

    def word(self, word: bytes) -> float:
        if len(self.words) >= REMEMBERED:
            self.words.clear()
        found = self.words[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return found

    def score(self, data: bytes | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Probability that some sentence is toxic, and the sentences (bytes) that likely are."""
        known, clean, found = self.words, 0.0, []
        for begin, end, words in sentences(data or b""):
            total = 0.0
            for w in words:
                value = known.get(w)
                total += self.word(w) if value is None else value
            z = min(self.bias + total, 30.0)
            clean -= np.logaddexp(0.0, z) if total else self.plain
            if z >= 0:
                found.append((begin, end, 1 / (1 + np.exp(-z))))
        return -float(np.expm1(clean)), found


def trained(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str):
    """Bias and weights from a bounded sample of the labelled rows outside the held-out fold."""
    known = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("toxic"))
        .filter("id IS NOT NULL AND toxic IN (0, 1)")
        .filter(bucket("id", FOLDS) != HELD_OUT)
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    sizes = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        share = 0.5 if not sizes else float(next(iter(sizes)))
        return (30.0 if share == 1 else 0.0 if share else -30.0), {}
    spread = 1 << 40
    draw = F.pmod(F.xxhash64("id"), F.lit(spread))
    chosen = F.lit(False)
    for toxic, size in sizes.items():
        most = max(1, min(spread, spread * SAMPLE_ROWS // size))
        chosen = chosen | ((F.col("toxic") == toxic) & (draw < most))
    # at most some 2 * SAMPLE_ROWS rows of two numbers
    sample = F.broadcast(known.filter(chosen))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    rows = texts.join(sample, "id").select("toxic", "text", "id")
    rows = rows.filter(F.char_length("text").between(1, SAMPLE_CHARS))
    counts = rows.mapInArrow(_featured, "toxic int, feature int").groupBy("feature").agg(
        F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n")
    )
    n = sum(min(s, SAMPLE_ROWS) for s in sizes.values())
    n_toxic = min(sizes[1], SAMPLE_ROWS)
    a, b = F.col("a") + 0.5, F.col("n") - F.col("a") + 0.5
    c, d = F.lit(n_toxic) - F.col("a") + 0.5, F.lit(n - n_toxic) - (F.col("n") - F.col("a")) + 0.5
    z = (F.log(a / c) - F.log(b / d)) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    picked = counts.filter((F.col("a") >= LEAST_DOCS) & (c > 0) & (d > 0) & (z >= LEAST_Z))
    names = frozenset(r[0] for r in picked.select("feature").collect())
    return fit(rows.mapInArrow(_bags(names), _BAGS).toArrow())


def loaded(key: str, bias: float, weights: dict[int, float]) -> Scorer:
    return resident(key, lambda: Scorer(bias, weights))


def _points(data: bytes, places: list[int]) -> list[int]:
    """Byte offsets as code points, in one pass over the text."""
    out, at, points = [], 0, 0
    for place in places:
        points += len(data[at:place].decode())
        at = place
        out.append(points)
    return out


def scored(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> DataFrame:
    """doc_id, held_out, score, predicted and offending, a row for each row of `docs`.

    `offending` lists the sentences more likely toxic than not, as start:end in code points.
    Texts without words (null too) have the score 0: no sentence can be toxic. Equal texts
    have equal scores. Null labels and ids are not learnt from; labels that contradict each
    other count as toxic; with labels of one class only, all scores follow it, and without any
    a sentence counts as undecided. Empty tables are fine; other columns are ignored.
    """
    bias, weights = trained(docs, labels, doc_id, text, label)
    sent = docs.sparkSession.sparkContext.broadcast((bias, weights))
    key = uuid.uuid4().hex

    @F.arrow_udf("struct<score: double, offending: string>")
    def run(texts: pa.Array) -> pa.Array:
        scorer = loaded(key, *sent.value)
        scores, spans = [], []
        for data in raw(texts):
            score, found = scorer.score(data)
            places = [p for begin, end, _ in found for p in (begin, end)]
            ends = _points(data, places) if found else []
            scores.append(score)
            spans.append(",".join(f"{s}:{e}" for s, e in zip(ends[::2], ends[1::2], strict=True)))
        return pa.StructArray.from_arrays(
            [pa.array(scores, pa.float64()), pa.array(spans, pa.string())],
            names=["score", "offending"],
        )

    held = F.coalesce(bucket(doc_id, FOLDS) == HELD_OUT, F.lit(False))
    found = docs.select(
        F.col(doc_id).alias("doc_id"), held.alias("held_out"), run(F.col(text)).alias("found")
    )
    return found.select(
        "doc_id",
        "held_out",
        "found.score",
        (F.col("found.score") >= 0.5).cast("int").alias("predicted"),
        "found.offending",
    )
