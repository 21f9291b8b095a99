import random

import model
import numpy as np
import pytest
from inkveil.functions import windows
from inkveil.operators import detect, literals, protect, rewrite
from inkveil.operators import people as persons
from inkveil.plans.redaction import redact
from inkveil.sources import lists
from pyspark.sql import functions as F

PLANS = ["direct", "inline", "joined"]
VOCABULARY = [
    "Mario", "Luca", "Rossi", "Anna", "De", "de", "ROSSI", "luca", "Verdi", "l", "La",
    "Sindaco", "Al", "il", "Èva", "D", "Uva", "uva",
]
JOINTS = [" ", " ", " ", "  ", "\t", "'", "’ ", ", ", ". ", "-"]
PEOPLE = [
    "Mario:Luca;Rossi", "Anna;Luca", "Luca;Verdi", "Èva;De Rossi", "Verdi;de Luca", "Anna;D'Uva",
    "Sindaco;La", "Rossi;Èva", "Mario;Mario", "Nico';Uva",
]
NESTED = ["Rossi, Mario", "il", "Al Sindaco", "a. ", "Mar", "Mario", "Mario Rossi", "Rossi Luca"]
KEEP = ["Al Sindaco", "Verdi", "Rossi, Mario"]


def texts(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = rng.choices(VOCABULARY, k=rng.randint(2, 14))
        out.append("".join(w + rng.choice(JOINTS) for w in words))
    return out


def keep_spans(text, exprs):
    return model.literals(text, {x for e in exprs for x in (e, e.upper())})


def as_tuples(found):
    return [(s.start, s.end, s.ord, s.status) for s in found]


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("rule", ["overlap", "edge"])
def test_list_search_equals_model(spark, lines, blocks, plan, rule):
    some = texts(800, 11)
    people = lists.parse_people(lists.require_well_formed(lines(*PEOPLE)))
    exprs = spark.createDataFrame(
        [(x,) for e in KEEP for x in {e, e.upper()}], "expr string"
    )
    got = detect.detect(
        blocks(*some), ["doc_id"], persons.entries(people), exprs, plan=plan, rule=rule
    )
    listed = [(p.split(";")[0].split(":"), p.split(";")[1]) for p in PEOPLE]
    patterns = [
        (i, model.person_pattern(names, surname, tight))
        for i, ((names, surname), tight) in enumerate(
            zip(listed, model.homonyms(listed), strict=True), 1
        )
    ]
    total = 0
    for row in got.collect():
        expected = model.search(row.text, patterns, keep_spans(row.text, KEEP), rule)
        total += len(expected)
        assert as_tuples(row.found) == expected, row.text
    assert total > 50


@pytest.mark.parametrize("plan", PLANS)
def test_dictionary_search_equals_model(spark, lines, blocks, plan):
    some = texts(800, 12)
    names = ["Mario", "Anna", "LUCA", "De", "Rossi", "Luca"]
    got = detect.detect(
        blocks(*some),
        ["doc_id"],
        persons.dictionary_entries(lists.parse_dictionary(lines(*names))),
        plan=plan,
    )
    patterns = [(i, model.dictionary_pattern(n)) for i, n in enumerate(names, 1)]
    for row in got.collect():
        assert as_tuples(row.found) == model.search(row.text, patterns), row.text


@pytest.mark.parametrize("plan", PLANS)
def test_unusual_dictionary_names(spark, lines, blocks, plan):
    some = [*texts(400, 13), "Gian Luca Rossi", "Verdi gian  luca", "Verdi Gian Luca", "Rossi èva", "D'Uva Mario"]
    names = ["Gian Luca", "D'Uva", "luca", "Èva"]
    got = detect.detect(
        blocks(*some),
        ["doc_id"],
        persons.dictionary_entries(lists.parse_dictionary(lines(*names))),
        plan=plan,
    )
    patterns = [(i, model.dictionary_pattern(n)) for i, n in enumerate(names, 1)]
    for row in got.collect():
        assert as_tuples(row.found) == model.search(row.text, patterns), row.text


@pytest.mark.parametrize("plan", PLANS)
def test_kept_people(spark, lines, blocks, plan):
    some = ["Francesco Antonio e Antonio Franco", "Antonio Francesco Paolo", "Francesco Antonio Franco"]
    people = lists.parse_people(
        lines("Francesco;Paolo", "Antonio;Franco", "!Francesco;Antonio"), keep=None
    )
    got = detect.detect(blocks(*some), ["doc_id"], persons.entries(people), plan=plan)
    found = {r.doc_id: as_tuples(r.found) for r in got.collect()}
    assert found[0] == [(20, 34, 2, "replaced")]
    assert found[1] == [(8, 23, 1, "protected")]
    assert found[2] == [(10, 24, 2, "protected")]


def test_protected_tables(spark, lines, blocks):
    some = blocks(*texts(300, 14))
    people = lists.parse_people(lines("!Mario;Rossi", "!Rossi;Luca", "Anna;Luca"), keep=None)
    exprs = spark.createDataFrame([(e,) for e in KEEP], "expr string")
    entries = persons.entries(people)
    kept = protect.protected_spans(some, ["doc_id"], entries, exprs)
    got = {}
    for r in kept.collect():
        got.setdefault(r.doc_id, set()).add((r.start, r.end))
    patterns = [model.person_pattern(["Mario"], "Rossi", False), model.person_pattern(["Rossi"], "Luca", False)]
    for row in some.collect():
        expected = set(model.literals(row.text, KEEP))
        for p in patterns:
            expected |= {s[:2] for s in model.search(row.text, [(0, p)])}
        assert got.get(row.doc_id, set()) == expected, row.text
    # joining tables gives what the search itself leaves out
    plain = redact(some, ["doc_id"], people=people.filter("NOT keep"))
    rest = protect.unprotected(plain.spans(), kept, ["doc_id"])
    job = redact(some, ["doc_id"], people=people, keep_exprs=exprs)
    key = ("doc_id", "start", "end")
    assert {tuple(r) for r in rest.select(*key).collect()} == {
        tuple(r) for r in job.spans().select(*key).collect()
    }


NESTED = ["Rossi, Mario", "il", "Al Sindaco", "a. ", "Mar", "Mario", "Mario Rossi", "Rossi Luca"]


KEEP_PLANS = ["pattern", "held", "joined"]


@pytest.fixture
def limits(monkeypatch):
    def set_to(plan):
        monkeypatch.setattr(literals, "LITERAL_CHARS", 20_000 if plan == "pattern" else 1)
        monkeypatch.setattr(literals, "HELD_CHARS", 1 if plan == "joined" else 20_000)
        assert literals.choose(1000) == plan

    return set_to


@pytest.mark.parametrize("plan", [None, *KEEP_PLANS])
def test_keep_rule_is_the_same_for_all_sizes(spark, blocks, plan):
    odd = ["see Mario Rossi Luca here", "il", "", None, "\U0001f600 il \U0001f600\U0001f600il", "Rossi Luca" * 500]
    some = blocks(*texts(300, 15), *odd)
    table = spark.createDataFrame([(e,) for e in [*NESTED, "\U0001f600i", ""]], "expr string")
    kept = protect.expression_spans(some, ["doc_id"], table.filter("expr <> ''"), plan)
    got = {}
    for r in kept.collect():
        got.setdefault(r.doc_id, set()).add((r.start, r.end))
    for row in some.collect():
        want = set(model.literals(row.text or "", [*NESTED, "\U0001f600i"]))
        assert got.get(row.doc_id, set()) == want, row.text


@pytest.mark.parametrize("keep_plan", KEEP_PLANS)
@pytest.mark.parametrize("plan", PLANS)
def test_longer_expression_protects(spark, lines, blocks, limits, plan, keep_plan):
    limits(keep_plan)
    exprs = spark.createDataFrame([("Mario",), ("Mario Rossi Bianchi",)], "expr string")
    entries = persons.entries(lists.parse_people(lines("Rossi;Bianchi")))
    some = blocks("see Mario Rossi Bianchi here", "see Rossi Bianchi here")
    found = detect.detect(some, ["doc_id"], entries, exprs, plan=plan).orderBy("doc_id").collect()
    assert as_tuples(found[0].found) == [(10, 23, 1, "protected")]
    assert as_tuples(found[1].found) == [(4, 17, 1, "replaced")]


def test_hundred_thousand_expressions(spark, blocks):
    rng = random.Random(21)
    letters = "abcdefghijklmnopqrstuvwxyz "
    exprs = {"".join(rng.choices(letters, k=rng.randint(5, 40))) for _ in range(100_000)}
    known = rng.sample(sorted(exprs), 3000)
    some = blocks(
        *["".join(rng.choices(letters, k=80)) + rng.choice(known) + "zz" + rng.choice(known)[:-1] for _ in range(2000)]
    )
    table = spark.createDataFrame([(e,) for e in exprs], "expr string").repartition(4)
    by_plan = {
        plan: sorted(map(tuple, protect.expression_spans(some, ["doc_id"], table, plan).collect()))
        for plan in ("held", "joined")
    }
    sizes = {len(e) for e in exprs}
    want = set()
    for row in some.collect():
        for i in range(len(row.text)):
            fit = [n for n in sizes if row.text[i : i + n] in exprs and i + n <= len(row.text)]
            if fit:
                want.add((row.doc_id, i, i + max(fit)))
    assert by_plan["held"] == by_plan["joined"] == sorted(want)
    assert len(want) >= 2000
    assert literals.candidates(some, ["doc_id"], table).count() < 2 * len(want)


def test_joined_windows_are_shuffled_once(spark, blocks, monkeypatch):
    # every window of a text is an expression or passes a filter that has all its bits set
    monkeypatch.setattr(
        literals, "window_filter",
        lambda exprs: windows.WindowFilter((2, 3), np.full(64, (1 << 64) - 1, np.uint64)),
    )
    table = spark.createDataFrame([("aba",), ("ab",), ("ba",), ("ab",), ("",), (None,)], "expr string")
    some = blocks("ababab xb", "xxx", None, "", "ab").unionByName(
        spark.createDataFrame([(0, "xxaba"), (None, "ab"), (None, "aba")], "doc_id long, text string")
    )
    want = [
        (None, [(0, 3), (1, 3)]),
        (0, [(0, 3), (1, 3), (2, 5), (3, 5), (4, 6)]),
        (4, [(0, 2)]),
    ]

    def found():
        rows = literals.by_join(some, ["doc_id"], table).collect()
        told = [(r.doc_id, [(s.start, s.end) for s in r.kept]) for r in rows]
        return sorted(told, key=lambda r: (r[0] is not None, r[0] or 0))

    kept = literals.by_join(some, ["doc_id"], table)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 1
    assert found() == want
    # too many wrong windows to hold: each window is joined
    monkeypatch.setattr(literals, "HELD_CHARS", 1)
    plan = literals.by_join(some, ["doc_id"], table)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan
    assert found() == want


def test_packed_spans():
    rng = random.Random(5)
    rows = [[], [(0, 1)], [(127, 255), (128, 129), (20_000, 40_000), (3_000_000, 2_000_000_000)], []]
    for _ in range(50):
        starts = sorted(rng.sample(range(100_000), rng.randint(0, 40)))
        rows.append([(s, s + rng.choice([1, 5, 127, 128, 9000])) for s in starts])
    offsets = np.cumsum([0, *map(len, rows)])
    flat = np.array([s for row in rows for s in row], np.int64)
    data, places = windows.packed(offsets, flat[:, 0], flat[:, 1])
    for k, row in enumerate(rows):
        starts, ends = windows.unpacked(data[places[k] : places[k + 1]].tobytes())
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == row
    # some two bytes a span, where a number for each took eight
    near = np.arange(0, 40_000, 20)
    assert len(windows.packed(np.array([0, len(near)]), near, near + 9)[0]) == 2 * len(near)


@pytest.mark.parametrize("least", [0, 1, 2])
def test_filters_tell_what_cannot_be_held(spark, blocks, monkeypatch, least):
    # a filter that lets every window of a length through leaves more wrong ones than can be held
    rng = random.Random(33)
    words = sorted({"".join(rng.choices("abcdef", k=rng.randint(4, 6))) for _ in range(1500)})
    some = blocks(*["".join(rng.choices("abcdef", k=60)) + rng.choice(words) for _ in range(400)], None)
    table = spark.createDataFrame([(e,) for e in words], "expr string")
    monkeypatch.setattr(
        literals, "window_filter",
        lambda exprs: windows.WindowFilter((4, 5, 6), np.full(64, (1 << 64) - 1, np.uint64)),
    )
    levels, tell = [], literals._told
    monkeypatch.setattr(literals, "_told", lambda *x: levels.append(tell(*x)) or levels[-1])
    monkeypatch.setattr(literals, "FILTER_BYTES", 1 << 12)
    monkeypatch.setattr(literals, "HELD_CHARS", (1 << 24, 3000, 300)[least])
    # small filters let many of the others through
    monkeypatch.setattr(windows, "BITS_EACH", 3)
    kept = literals.by_join(some, ["doc_id"], table)
    assert "Join" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert levels and len(levels[0].filters) >= least
    got = {r.doc_id: {(s.start, s.end) for s in r.kept} for r in kept.collect()}
    known = set(words)
    for row in some.collect():
        text, want = row.text or "", set()
        for i in range(len(text)):
            fit = [n for n in (4, 5, 6) if i + n <= len(text) and text[i : i + n] in known]
            want |= {(i, i + n) for n in fit[-1:]}
        assert got.get(row.doc_id, set()) == want


def test_held_list_does_not_shuffle(spark, blocks):
    table = spark.createDataFrame([(e,) for e in NESTED], "expr string")
    kept = literals.with_kept(blocks("a"), ["doc_id"], F.col("text"), table, plan="held")
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()


def test_equal_hashes_are_told_apart(monkeypatch):
    # windows of one length all have one hash: only the characters tell
    monkeypatch.setattr(
        windows.Sums, "windows", lambda self, at, length: np.zeros(len(at), np.uint64) + np.uint64(1)
    )
    some = windows.Literals.of(["abcd", "abce", "bc", "wxyz", "x"])
    batch = windows.Batch(["abcdwxyz", "abc", None, "abce"])
    assert some.longest(batch).tolist() == [4, 2, 0, 0, 4, 1, 0, 0, 0, 2, 0, 4, 2, 0, 0]


@pytest.mark.parametrize("plan", PLANS)
def test_names_are_used_once(spark, lines, blocks, plan):
    names = ["Aa", "Bb", "Cc", "Dd", "Ee", "Ff", "Gg", "Hh", "Ii", "Jj"]
    rng = random.Random(5)
    for count in range(1, 11):
        own = names[:count]
        some = []
        for _ in range(60):
            said = " ".join(rng.choices(own, k=rng.randint(1, 5)))
            some.append(f"Zz {said} Rossi" if rng.random() < 0.5 else f"Rossi {said} Zz")
        people = [":".join(own) + ";Rossi"] + (["Zz;Rossi"] if count % 2 else [])
        entries = persons.entries(lists.parse_people(lines(*people)))
        found = detect.detect(blocks(*some), ["doc_id"], entries, plan=plan).collect()
        for row in found:
            got = [(s.start, s.end) for s in row.found if s.ord == 1]
            assert got == nominative(row.text, own, "Rossi", bool(count % 2)), row.text


def nominative(text, names, surname, all_names):
    """The leftmost run of different names before, or else after, the surname."""
    words = text.split(" ")
    at = words.index(surname)
    places = [len(" ".join(words[:k])) + bool(k) for k in range(len(words) + 1)]
    sizes = [len(names)] if all_names else range(len(names), 0, -1)
    for size in sizes:
        run = words[max(0, at - size) : at]
        if len(run) == size == len(set(run)) and set(run) <= set(names):
            return [(places[at - size], places[at] + len(surname))]
    for size in sizes:
        run = words[at + 1 : at + 1 + size]
        if len(run) == size == len(set(run)) and set(run) <= set(names):
            return [(places[at], places[at + size + 1] - (at + size + 1 < len(words)))]
    return []


def test_search_once_for_all_outputs(spark, lines, blocks, tmp_path):
    some = blocks(*texts(100, 18))
    job = redact(some, ["doc_id"], people=lists.parse_people(lines(*PEOPLE)))
    once = job.stored(str(tmp_path / "job"))
    outputs = ("texts", "audit", "frequencies", "associations")
    for name in outputs:
        plain, stored = getattr(job, name)(), getattr(once, name)()
        assert sorted(map(str, plain.collect())) == sorted(map(str, stored.collect()))
    read = {f for name in ("texts", "audit") for f in getattr(once, name)().inputFiles()}
    assert read and all("/job/" in f for f in read)


def test_broadcast_list_is_searched_in_one_stage(spark, lines, blocks):
    people = persons.entries(lists.parse_people(lines(*PEOPLE))).persist()
    exprs = spark.createDataFrame([(e,) for e in KEEP], "expr string")
    # the first text has the candidates of several batches
    long = " ".join(texts(60, 31))
    some = blocks(long, None, "", "nobody at all", *texts(200, 32), long).withColumn(
        "more", F.struct(F.col("doc_id").alias("id"), F.array("text").alias("ts"))
    )
    some = some.withColumn("doc_id", F.when(F.col("doc_id") != 7, F.col("doc_id")))
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        searched, _ = detect.detect_open(some, ["doc_id"], people, exprs, plan="joined")
        plan = searched._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
        got = {r.doc_id: r for r in detect.detect(some, ["doc_id"], people, exprs, plan="joined").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    want = detect.detect(some, ["doc_id"], people, exprs, plan="inline").collect()
    assert len(got) == len(want) and max(len(r.found) for r in want) > 5
    for row in want:
        # a text without a key is not searched by joins
        expected = [] if row.doc_id is None else as_tuples(row.found)
        assert as_tuples(got[row.doc_id].found) == expected, row.text
        assert got[row.doc_id][:3] == row[:3]


def test_salted_join(spark, lines, blocks, monkeypatch):
    monkeypatch.setattr(detect, "BROADCAST_CHARS", 0)
    people = lists.parse_people(lines(*PEOPLE))
    some = blocks(*texts(200, 16))
    salted = detect.detect(some, ["doc_id"], persons.entries(people), plan="joined")
    plain = detect.detect(some, ["doc_id"], persons.entries(people), plan="inline")
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_plan_follows_the_size(spark, lines):
    def size(n):
        return detect.Measure(n, n * 2, n * 500, (2,), True)

    assert [detect.choose(size(n)) for n in (3, 5000, 500_000)] == PLANS


def test_many_people_with_one_surname(spark, blocks):
    letters = "abcdefghijklmnopqrst"
    names = [f"X{a}{b}{c}" for a in letters for b in letters for c in letters]
    people = spark.createDataFrame(
        [(i + 1, ["Mario", n], "Rossi", False) for i, n in enumerate(names)],
        "person_id bigint, names array<string>, surname string, keep boolean",
    )
    some = blocks("Mario Xabc Rossi, Rossi Xttt Mario e Mario Rossi", "Xaaa Rossi Mario")
    got = detect.detect(some, ["doc_id"], persons.entries(people), plan="joined")
    found = {r.doc_id: as_tuples(r.found) for r in got.collect()}
    assert [s[:2] for s in found[0]] == [(0, 16), (18, 34)]
    assert [names[s[2] - 1] for s in found[0]] == ["Xabc", "Xttt"]
    assert found[1] == []


def test_block_without_two_capitals_is_left_alone(spark, lines, blocks):
    people = lists.parse_people(lines("maria;rossi"))
    job = redact(blocks("qui maria rossi", "qui Anna e maria rossi", "Il Po maria rossi"), ["doc_id"], people=people)
    assert [r.text for r in job.texts().orderBy("doc_id").collect()] == [
        "qui maria rossi", "qui Anna e maria rossi", "Il Po ID1",
    ]


def test_gate_reads_the_text_once(spark, lines, blocks, monkeypatch):
    # a filter works its input out for each time it is named
    gates, joined = [], detect._joined
    monkeypatch.setattr(detect, "_joined", lambda *x: gates.append(str(x[6])) or joined(*x))
    entries = persons.entries(lists.parse_people(lines(*PEOPLE)))
    some = blocks("see Anna Luca", "Anna\ufdd2Luca here", "Anna\ufdd3 Luca", "by \ufdd4Anna Luca")
    found = detect.detect(some, ["doc_id"], entries, plan="joined").collect()
    assert {r.doc_id: len(r.found) for r in found} == {0: 1, 1: 0, 2: 0, 3: 1}
    assert len(gates) == 1 and gates[0].count("text") == 1


def test_marks_in_the_text_do_no_harm(spark, lines, blocks):
    people = lists.parse_people(lines("Mario;Rossi"))
    text = "﷒﷓ Mario Rossi ﷔x"
    job = redact(blocks(text), ["doc_id"], people=people)
    assert job.texts().first().text == "﷒﷓ ID1 ﷔x"


def test_empty_people_list_means_dictionary(spark, lines, blocks):
    people = lists.parse_people(lines("!Mario;Rossi"), keep=None)
    dictionary = lists.parse_dictionary(lines("Anna", "Mario"))
    job = redact(
        blocks("Anna Verdi, Mario Rossi", "Verdi Anna e Anna Neri"),
        ["doc_id"], people=people, dictionary=dictionary,
    )
    assert job.scheme == "lettered"
    assert [r.text for r in job.texts().orderBy("doc_id").collect()] == [
        "IDA1, Mario Rossi", "IDA1 e IDB1",
    ]
    with pytest.raises(ValueError, match="dictionary"):
        redact(blocks("x"), ["doc_id"])


def test_letters_by_first_occurrence(spark, lines, blocks):
    names = [f"C{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    some = blocks(*[f"Anna {n} e {n} Anna" for n in names])
    job = redact(some, ["doc_id"], dictionary=lists.parse_dictionary(lines("Anna")))
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    expected = [
        f"ID{alphabet[min(i, 51)]}1 e ID{alphabet[min(i, 51)]}1" for i in range(len(names))
    ]
    assert [r.text for r in job.texts().orderBy("doc_id").collect()] == expected


def test_result_does_not_depend_on_partitions(spark, lines, blocks):
    people = lists.parse_people(lines(*PEOPLE))
    some = blocks(*texts(200, 17))
    results = set()
    for n in (1, 7):
        job = redact(some.repartition(n), ["doc_id"], people=people, scheme="hash", salt=1)
        results.add(tuple(sorted(map(str, job.texts().collect()))))
    assert len(results) == 1


def test_reports(spark, lines, blocks):
    people = lists.parse_people(lines("Mario;Rossi", "Mario;Verdi", "Anna;Neri"))
    some = blocks("Mario Rossi e Verdi Mario", "Rossi Mario, Anna Neri", "Rossi MARIO")
    job = redact(some, ["doc_id"], people=people, scheme="hash", salt=3)
    assert {tuple(r) for r in job.frequencies().collect()} == {("Mario", 4), ("Anna", 1)}
    told = job.associations().collect()
    assert {r.name_key for r in told} == {"MARIO ROSSI", "MARIO VERDI", "ANNA NERI"}
    assert len({r.pseudonym for r in told}) == 3
    with pytest.raises(ValueError, match="salt"):
        redact(some, ["doc_id"], people=people, scheme="hash").texts()


def test_orphans(spark):
    rows = [(1, [(0, 4)], [(2, 6, "x"), (5, 8, "y")])]
    df = spark.createDataFrame(
        rows,
        "doc_id int, segments array<struct<from:int,to:int>>, "
        "edits array<struct<start:int,end:int,replacement:string>>",
    )
    assert [r.replacement for r in rewrite.orphans(df, ["doc_id"]).collect()] == ["y"]


def test_search_plans_do_not_shuffle(spark, lines, blocks):
    people = lists.parse_people(lines(*PEOPLE))
    for plan in ("direct", "inline"):
        got = detect.detect(blocks("a"), ["doc_id"], persons.entries(people), plan=plan)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_lists_too_long_for_a_plan_fail(lines, blocks, monkeypatch):
    people = persons.entries(lists.parse_people(lines(*PEOPLE)))
    monkeypatch.setattr(detect, "INLINE_KEYS", 5)
    for plan in ("direct", "inline"):
        with pytest.raises(ValueError, match="too many"):
            detect.detect(blocks("Anna Luca"), ["doc_id"], people, plan=plan)
    found = detect.detect(blocks("Anna Luca"), ["doc_id"], people).collect()
    assert [len(r.found) for r in found] == [1]
    monkeypatch.setattr(literals, "HELD_CHARS", 5)
    exprs = lines("Al Sindaco").withColumnRenamed("line", "expr")
    for plan in ("pattern", "held"):
        with pytest.raises(ValueError, match="too many"):
            protect.expression_spans(blocks("a"), ["doc_id"], exprs, plan)
    assert protect.expression_spans(blocks("Al Sindaco"), ["doc_id"], exprs, "joined").count() == 1


def test_hashed_associations_hash_each_key_once(spark, lines, blocks):
    df = blocks("Mario Rossi", "Rossi Mario", "Luca Verdi", "nobody")
    people = lists.parse_people(lines("Mario;Rossi", "Luca;Verdi"))
    job = redact(df, ["doc_id"], people=people, scheme="hash", salt=7)
    told = job.associations()
    assert sorted(map(tuple, told.collect())) == sorted(
        {(r.name_key, r.replacement) for r in job.spans().collect()}
    )
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    grouped, *below = plan[plan.index("Aggregate"):].split("\n")
    assert "md5" in grouped + plan[:plan.index("Aggregate")] and "md5" not in "".join(below)
