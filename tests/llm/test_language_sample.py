"""Languages whose labelled rows are all longer than what is learnt of one."""

import random

from inkveil.llm import language

ALPHABETS = {"aa": "abcdefg", "zz": "tuvwxyz"}


def text(lang, chars, seed):
    rng = random.Random(seed)
    return "".join(rng.choices(ALPHABETS[lang] + " ", k=chars))


def test_labels_of_long_rows_are_learnt(spark):
    most = language.SAMPLE_CHARS
    rows = [(k, text("aa", 300, k), "aa") for k in range(8)]
    rows += [(100 + k, text("zz", most + 1 + 700 * k, k), "zz") for k in range(8)]
    rows += [(900, text("aa", 200, 900), None), (901, text("zz", 200, 901), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identified(docs).collect()}
    assert got == {k: "zz" if 100 <= k < 900 or k == 901 else "aa" for k, _, _ in rows}


def test_books_alone_are_no_unknown_texts(spark):
    rows = [(k, text("zz", language.SAMPLE_CHARS + 1, k), "zz") for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.known_language(docs).count() == len(rows)
    lengths = language.statistics(docs, "doc_id", "text", "lang")
    taken = lengths.filter("length(context) = 0").agg({"n": "sum"}).first()[0]
    assert taken % language.SAMPLE_CHARS == 0  # bounded stretches of one byte a character
