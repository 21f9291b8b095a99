import hashlib
import random
import re

import model
import pytest
from pyspark.sql import functions as F

from inkveil.functions import grammar, pseudonyms, spans

PIECES = [
    "Mario", "Rossi", "MARIO", "mario", "De", "de", "dell", "Luca", "A", "È", "Èva",
    "Zoë", "x", " ", "  ", "\t", "'", "’", ".", ", ", "1", "-", "ß", "D", "la", "Ẁ",
]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(1, 12))) for _ in range(n)]


def test_gate_equals_full_grammar(spark, blocks):
    some = texts(3000, 1)
    got = blocks(*some).select("text", grammar.is_name_like(F.col("text")).alias("g")).collect()
    for row in got:
        assert row.g == bool(re.search(model.GATE, row.text, model.FLAGS)), row.text


def test_letter_class_is_the_letter_list(spark):
    chars = [chr(c) for c in range(1, 0x2100)]
    df = spark.createDataFrame([(c,) for c in chars], "c string")
    got = {r.c for r in df.filter(F.col("c").rlike(f"^[{grammar.LETTER}]")).collect()}
    assert got == {c for c in chars if re.match(f"[{grammar.LETTERS}]", c)}


@pytest.mark.parametrize("all_names", [False, True])
@pytest.mark.parametrize(
    ("names", "surname"),
    [
        (["Mario"], "Rossi"),
        (["Mario", "Luca"], "Rossi"),
        (["Mario", "Luca", "Zoë", "Rossi"], "Rossi"),
        (["Mario", "Mario"], "de Luca"),
        (["Luca"], "D'A"),
        (["Luca", "A"], "De’Rossi"),
    ],
)
def test_person_pattern_equals_all_orders(spark, blocks, names, surname, all_names):
    some = texts(1500, len(names)) + [
        "Mario Luca Rossi", "Rossi Mario Luca Mario", "Mario Mario de Luca", "Luca D' a",
        "Rossi Rossi Mario Zoë Luca", "Mario Luca Mario Rossi", "A Luca De`rossi",
    ]
    pattern = grammar.person_pattern(
        F.array(*[F.lit(n) for n in names]), F.lit(surname), F.lit(all_names)
    )
    df = blocks(*some).withColumn("found", spans.locate(F.col("text"), pattern))
    expected = re.compile(model.person_pattern(names, surname, all_names), model.FLAGS)
    for row in df.collect():
        assert [tuple(s) for s in row.found] == [
            m.span() for m in expected.finditer(row.text)
        ], row.text


def test_ten_names_in_any_order(spark, blocks):
    names = [f"N{c}" for c in "abcdefghij"]
    rng = random.Random(3)
    some = []
    for _ in range(50):
        chosen = rng.sample(names, rng.randint(1, 10))
        some.append(rng.choice([chosen + ["Rossi"], ["Rossi"] + chosen]))
    pattern = grammar.person_pattern(
        F.array(*[F.lit(n) for n in names]), F.lit("Rossi"), F.lit(False)
    )
    df = blocks(*[" ".join(s) for s in some]).withColumn(
        "found", spans.locate(F.col("text"), pattern)
    )
    for row in df.collect():
        assert [tuple(s) for s in row.found] == [(0, len(row.text))]


@pytest.mark.parametrize("name", ["Mario", "A", "De", "Luca"])
def test_marked_dictionary_search(spark, blocks, name):
    some = texts(2500, 5)
    text = F.col("text")
    df = blocks(*some).select(
        "text",
        spans.locate(text, grammar.dictionary_pattern(F.lit(name))).alias("plain"),
        spans.locate(
            grammar.mark_name(text, F.lit(name)), F.lit(grammar.MARKED_NAME)
        ).alias("marked"),
    )
    expected = re.compile(model.dictionary_pattern(name), model.FLAGS)
    hits = 0
    for row in df.collect():
        want = [m.span() for m in expected.finditer(row.text)]
        hits += len(want)
        assert [tuple(s) for s in row.plain] == want, row.text
        assert [tuple(s) for s in row.marked] == want, row.text
    assert hits


def test_literals_at_every_place(spark, blocks):
    some = ["ababab aba", "aXaXa", "xaba", "aba", "", "Al SindacoAl Sindaco", "abaX"]
    exprs = ["Al Sindaco", "abaX", "aba", "aXa"]
    alternatives = "|".join(exprs)
    df = blocks(*some).withColumn(
        "found", spans.locate_literals(F.col("text"), F.lit(alternatives))
    )
    for row in df.collect():
        assert [tuple(s) for s in row.found] == model.literals(row.text, exprs), row.text


def test_hash_is_base36_md5(spark):
    def expected(key):
        number, out = int(hashlib.md5(f"7{key}".encode()).hexdigest(), 16), ""
        while number:
            number, digit = divmod(number, 36)
            out = "0123456789abcdefghijklmnopqrstuvwxyz"[digit] + out
        return out[:12]

    df = spark.range(500).select(F.concat(F.lit("KEY È "), F.col("id")).alias("k"))
    for row in df.select("k", pseudonyms.hash_id(F.col("k"), 7).alias("h")).collect():
        assert row.h == expected(row.k)


def test_name_key_ignores_order_and_case(spark, blocks):
    some = ["Leandro Contini", "Contini\t LEANDRO", "Dell'Uva Niccolò"]
    keys = [
        r.k
        for r in blocks(*some)
        .select("doc_id", pseudonyms.name_key(F.col("text")).alias("k"))
        .orderBy("doc_id")
        .collect()
    ]
    assert keys == ["CONTINI LEANDRO", "CONTINI LEANDRO", "DELLUVA NICCOLÒ"]


def test_letters_saturate(spark):
    df = spark.range(1, 60).select(
        "id", pseudonyms.lettered_id(F.col("id").cast("int"), F.lit(9)).alias("p")
    )
    got = {r.id: r.p for r in df.collect()}
    assert (got[1], got[26], got[27], got[52], got[59]) == ("IDA9", "IDZ9", "IDa9", "IDz9", "IDz9")


def test_many_matches_in_one_text(spark, blocks):
    """More matches than are folded at a time, with letters of several bytes."""
    some = ["é" + "".join(f"x{k} Ünö, " if k % 3 else f"😀{k} " for k in range(n)) for n in (3, 96, 97, 200, 500)]
    edit = "named_struct('start', s.start, 'end', s.end, 'replacement', concat('<', s.start, '>'))"
    rows = (
        blocks(*some)
        .withColumn("found", spans.locate(F.col("text"), F.lit("x[0-9]+|😀")))
        .withColumn("cut", spans.cuts(F.col("text"), F.col("found")))
        .withColumn("edits", F.expr(f"transform(found, s -> {edit})"))
        .withColumn("new", spans.rebuild(F.col("text"), F.col("edits")))
    )
    for row in rows.collect():
        matches = list(re.finditer("x[0-9]+|😀", row.text))
        assert [tuple(s) for s in row.found] == [m.span() for m in matches]
        assert row.cut == [m[0] for m in matches]
        assert row.new == re.sub("x[0-9]+|😀", lambda m: f"<{m.start()}>", row.text)


def test_first_digits_of_short_and_long_numbers(spark):
    df = spark.range(3000).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    told = df.select(
        pseudonyms.base36_md5(F.col("k")).alias("all"), pseudonyms.first_digits(F.col("k")).alias("h")
    ).collect()
    assert all(r.h == r["all"][:12] for r in told)
    assert {len(r["all"]) for r in told} >= {23, 24, 25}


def test_name_key_of_plain_and_other_letters(blocks):
    some = ["Bolt  Hot", "Bolt1 Ho-t", "Ñandú Øre", "Жук Bolt", "", "A B C", "Ĳs’ Al"]
    old = F.upper(
        F.regexp_replace(
            F.array_join(F.sort_array(F.split("text", "\\s+", -1)), " "), f"[^{grammar.LETTERS} ]", ""
        )
    )
    for row in blocks(*some).select(old.alias("a"), pseudonyms.name_key(F.col("text")).alias("b")).collect():
        assert row.a == row.b
