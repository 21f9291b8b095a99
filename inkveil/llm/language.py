"""Language identification by prediction by partial matching over bytes.

For each language a tree of byte contexts up to ORDER bytes is counted on a bounded sample of
labelled rows. The code length of a byte is read off the longest context that the language
knows: c / (T + q) if the byte was seen there (c times, T in all, q different ones), else the
escape q / (T + q) and the next shorter context, down to a uniform byte. The statistics are
frozen: a text has the same code length whatever was scored before. The trees of all
languages are compiled into one table of contexts, so a batch of texts is scored by a few
array look-ups per byte, and the language with the shortest code wins.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkveil.llm.common import bucket, free_name, raw, resident

ORDER = 3
FOLDS, HELD_OUT = 4, 2
#: The labelled rows that a language's tree is counted on: some SAMPLE_ROWS of SAMPLE_CHARS code
#: points at most, and where there are fewer, stretches of that length from longer ones. So a
#: tree has at most SAMPLE_ROWS x SAMPLE_CHARS x ORDER contexts.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 20_000
UNKNOWN = "und"
#: Rows are drawn by hashes below a share of this.
SPREAD = 1 << 40
#: Bytes scored at a time.
BLOCK = 1 << 18


def _counted(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, context, byte, n): context is a byte string, the latest byte last."""
    counts: Counter[tuple[str, bytes, int]] = Counter()
    for batch in texts:
        for lang, text in zip(batch.column(0).to_pylist(), raw(batch.column(1)), strict=True):
            # a text begins as if after a line break
            data = b"\n" * ORDER + text
            for order in range(ORDER + 1):
                counts.update(
                    (lang, data[i - order : i], data[i]) for i in range(ORDER, len(data))
                )
    keys = list(counts)
    if keys:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.binary()),
                pa.array([k[2] for k in keys], pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names=["lang", "context", "byte", "n"],
        )


def statistics(docs: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    """Context counts of the sampled training rows: non-null labels outside the held-out fold."""
    rows = docs.select(
        F.col(lang).alias("lang"),
        F.col(text).alias("text"),
        F.char_length(text).alias("chars"),
        bucket(doc_id, FOLDS).alias("fold"),
        # by id too: a group of copies must not be drawn as a whole
        F.pmod(F.xxhash64(doc_id, text), F.lit(SPREAD)).alias("draw"),
    ).filter((F.col("fold") != HELD_OUT) & F.col("lang").isNotNull() & (F.col("chars") >= 1))
    long = F.col("chars") > SAMPLE_CHARS
    counted = rows.groupBy("lang").agg(F.count_if(~long), F.count_if(long))
    chosen = F.lit(False)
    for name, short, longer in sorted(map(tuple, counted.collect())):
        for kind, size, wanted in ((~long, short, SAMPLE_ROWS), (long, longer, SAMPLE_ROWS - short)):
            if size and wanted > 0:
                most = max(1, min(SPREAD, SPREAD * wanted // size))
                chosen = chosen | ((F.col("lang") == name) & kind & (F.col("draw") < most))
    begin = F.pmod(F.xxhash64("draw"), F.col("chars") - SAMPLE_CHARS + 1).cast("int") + 1
    stretch = F.when(long, F.substring("text", begin, SAMPLE_CHARS)).otherwise(F.col("text"))
    return (
        rows.filter(chosen)
        .select("lang", stretch.alias("text"))
        .mapInArrow(_counted, "lang string, context binary, byte int, n long")
        .groupBy("lang", "context", "byte")
        .agg(F.sum("n").alias("n"))
    )


class Model:
    """Frozen trees of all languages: `grow` leads from context to longer context, `cost` codes.

    A state is a context that some language knows. `grow[order][state, symbol]` is the context
    with the byte before it added, or the state itself if nobody knows that one. Bytes that
    never occur share one symbol.
    """

    def __init__(self, rows: list[tuple[str, bytes, int, int]], order: int = ORDER) -> None:
        self.order = order
        self.langs = sorted({r[0] for r in rows})
        column = {lang: k for k, lang in enumerate(self.langs)}
        seen = sorted({r[2] for r in rows} | {b for r in rows for b in r[1]})
        self.symbol = np.full(256, len(seen), np.int64)
        self.symbol[seen] = np.arange(len(seen))
        self.symbols = len(seen) + 1
        contexts = sorted({r[1] for r in rows} | {b""}, key=lambda c: (len(c), c))
        state = {c: k for k, c in enumerate(contexts)}
        n_langs = len(self.langs)
        counts = np.zeros((len(contexts), self.symbols, n_langs), np.float32)
        for lang, context, byte, n in rows:
            counts[state[context], self.symbol[byte], column[lang]] += n
        total = counts.sum(axis=1, keepdims=True)
        kinds = (counts > 0).sum(axis=1, keepdims=True, dtype=np.float32)
        known = total > 0
        escape = np.where(known, kinds / np.maximum(total + kinds, 1), 1).astype(np.float32)
        shorter = np.array([state[c[1:]] if c else 0 for c in contexts])
        chance = np.where(counts > 0, counts / np.maximum(total + kinds, 1), 0)
        del counts
        for k in range(len(contexts)):  # shorter contexts come first
            below = chance[shorter[k]] if k else np.float32(1 / 256)
            chance[k] = np.where(chance[k] > 0, chance[k], escape[k] * below)
        self.cost = -np.log2(chance).astype(np.float32).reshape(-1, max(n_langs, 1))
        self.grow = np.repeat(np.arange(len(contexts))[:, None], self.symbols, axis=1)
        for context, k in state.items():
            if context:
                self.grow[state[context[1:]], self.symbol[context[0]]] = k
        self.grow = self.grow.astype(np.int32).ravel()

    def code_lengths(self, data: bytes) -> np.ndarray:
        """Bits of a text under each language."""
        bits = np.zeros(len(self.langs))
        for begin in range(0, len(data), BLOCK):
            head = data[max(0, begin - self.order) : begin]
            head = b"\n" * (self.order - len(head)) + head
            part = head + data[begin : begin + BLOCK]
            s = self.symbol[np.frombuffer(part, np.uint8)]
            n = len(part) - self.order
            state = np.zeros(n, np.int64)
            deeper = np.ones(n, bool)
            for back in range(1, self.order + 1):
                grown = self.grow[state * self.symbols + s[self.order - back : len(s) - back]]
                deeper &= grown != state
                state = np.where(deeper, grown, state)
            bits += self.cost[state * self.symbols + s[self.order :]].sum(axis=0, dtype=np.float64)
        return bits

    def predict(self, data: bytes | None) -> tuple[str, float]:
        """The language of the shortest code, and its share of the probability per byte."""
        if not data or not self.langs or not _has_letter(data):
            return UNKNOWN, 0.0
        bits = self.code_lengths(data) / len(data)
        best = int(bits.argmin())
        return self.langs[best], float(1 / np.exp2(bits[best] - bits).sum())


def _has_letter(data: bytes) -> bool:
    # ASCII letters are found in bytes; other letters need the text
    if len(data) != len(data.translate(None, _LETTERS)):
        return True
    return not data.isascii() and any(c.isalpha() for c in data.decode())


_LETTERS = bytes([*range(65, 91), *range(97, 123)])


def trained(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"):
    """A function of a text column: struct<lang_pred: string, score: double>."""
    rows = [tuple(r) for r in statistics(docs, doc_id, text, lang).collect()]
    rows = sorted((lang, bytes(context), byte, n) for lang, context, byte, n in rows)
    sent, key = docs.sparkSession.sparkContext.broadcast(rows), uuid.uuid4().hex

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def run(texts: pa.Array) -> pa.Array:
        model = loaded(key, sent)
        found = [model.predict(t) for t in raw(texts)]
        return pa.StructArray.from_arrays(
            [
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ],
            names=["lang_pred", "score"],
        )

    return run


def loaded(key: str, sent) -> Model:
    return resident(key, lambda: Model(sent.value))


def identified(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """doc_id, held_out, lang_pred and score, a row for each row of `docs`.

    Null texts, texts without a letter, and all texts if there is no labelled row, are `und`
    with score 0. Rows without an id are never learnt from and not held out. Repeated rows and
    empty tables are fine; other columns are ignored. Equally short codes: the first name wins.
    """
    predict = trained(docs, doc_id, text, lang)
    held = F.coalesce(bucket(doc_id, FOLDS) == HELD_OUT, F.lit(False))
    found = docs.select(
        F.col(doc_id).alias("doc_id"), held.alias("held_out"), predict(F.col(text)).alias("found")
    )
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def known_language(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The rows of `docs` whose language is known: `und` goes, all columns stay as they are."""
    found = free_name(docs, "found")
    predict = trained(docs, doc_id, text, lang)
    marked = docs.withColumn(found, predict(F.col(text)))
    return marked.filter(F.col(found)["lang_pred"] != UNKNOWN).select(*docs.columns)
