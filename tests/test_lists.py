import itertools

import pytest
from pyspark.sql import functions as F

from inkveil.operators import people as persons
from inkveil.sources import lists

DEMO = (
    "Giancarlo;Sibari", "Filiberto;De Luca", "Francesco;Paolo", "Antonio;Franco",
    "Antonio:Andrea;Luca", "Leandro:Mario;Contini", "Carmine;de Rosa", "Niccolò;Dell’Uva",
)


def test_lines_are_numbered_over_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n".join(f"Aa{i}" for i in range(700)))
    (tmp_path / "b.txt").write_text("Zoe\n\nAda\n")
    files = [str(tmp_path / "b.txt"), str(tmp_path / "a.txt")]
    got = lists.read_lines(spark, *files).orderBy("line_no").collect()
    expected = ["Zoe", "", "Ada", *[f"Aa{i}" for i in range(700)]]
    assert [(r.line_no, r.line) for r in got] == list(enumerate(expected, 1))
    names = lists.read_dictionary(spark, *files).orderBy("dict_id").limit(3).collect()
    assert [(r.dict_id, r.name) for r in names] == [(1, "Zoe"), (3, "Ada"), (4, "Aa0")]


def test_people_file(spark, tmp_path):
    path = tmp_path / "m"
    path.write_text("\n".join(DEMO))
    got = lists.read_people(spark, str(path)).orderBy("person_id").collect()
    assert [r.person_id for r in got] == list(range(1, len(DEMO) + 1))
    assert (got[4].names, got[4].surname, got[4].keep) == (["Antonio", "Andrea"], "Luca", False)


@pytest.mark.parametrize("bad", ["Filiberto De Luca", "Filiberto,De Luca", "", "a;b;c", "';x"])
def test_bad_lines_fail_and_are_named(spark, lines, bad):
    with pytest.raises(ValueError, match="not well-formed") as error:
        lists.require_well_formed(lines("Carlo;Pluto", bad))
    assert bad in str(error.value) and "Pluto" not in str(error.value)


def test_all_bad_lines_are_named(spark, lines, tmp_path):
    some = lines("Carlo;Pluto", *[f"bad {k}" for k in range(60)])
    with pytest.raises(ValueError) as error:
        lists.require_well_formed(some)
    assert all(f"bad {k}" in str(error.value) for k in range(60))
    path = str(tmp_path / "bad")
    with pytest.raises(ValueError, match="60 list lines") as error:
        lists.require_well_formed(some, path)
    assert path in str(error.value) and spark.read.parquet(path).count() == 60


def test_an_error_names_so_many_lines(lines, monkeypatch):
    monkeypatch.setattr(lists, "NAMED_LINES", 3)
    for count, told in ((3, "bad 2} are"), (5, "bad 2} and 2 more are")):
        with pytest.raises(ValueError) as error:
            lists.require_well_formed(lines("Carlo;Pluto", *[f"bad {k}" for k in range(count)]))
        assert told in str(error.value) and "bad 3" not in str(error.value)


def test_people_are_never_dropped_silently(lines):
    some = lines("Carlo;Pluto", "bad", ":".join(["Ab"] * 11) + ";X")
    with pytest.raises(Exception, match="not well-formed"):
        lists.parse_people(some).count()
    assert lists.parse_people(lists.well_formed(some)).count() == 1


def test_eleven_names_are_malformed(spark, lines):
    got = lists.check_lines(lines(":".join(["Ab"] * 10) + ";X", ":".join(["Ab"] * 11) + ";X"))
    assert [r.is_valid for r in got.orderBy("line_no").collect()] == [True, False]


def test_exclamation_mark_keeps(spark, lines):
    people = lists.parse_people(lines("Carlo;Pluto", "!Ada;Neri", "Ugo;Rosa"), keep=None)
    got = {(r.names[0], r.person_id, r.keep) for r in people.collect()}
    assert got == {("Carlo", 1, False), ("Ada", 1, True), ("Ugo", 2, False)}


def test_keep_expressions(spark, lines):
    got = {r.expr for r in lists.keep_expressions(lines("  Al Giovane ", "", "Il Sindaco"), spark).collect()}
    assert {"Al Giovane", "AL GIOVANE", "IL SINDACO", "Alla Sottoscritta"} <= got
    assert "" not in got and len(got) == 14


def test_homonyms(spark, lines):
    people = persons.with_homonyms(
        lists.parse_people(lines(*DEMO, "!Leandro;Neri", "Mario:Mario;Bo"), keep=None)
    )
    marked = {(r.names[0], r.surname) for r in people.filter("has_homonym").collect()}
    assert marked == {
        ("Antonio", "Franco"), ("Antonio", "Luca"), ("Leandro", "Contini"), ("Mario", "Bo"),
    }


def test_variants_in_order(spark, lines):
    people = lists.parse_people(lines("Aa:Bb:Cc:Dd;Xx", "Ee;Yy")).withColumn(
        "has_homonym", F.col("surname") == "Yy"
    )
    got = persons.variants(people).orderBy("person_id", "variant_rank").collect()
    names = ["Aa", "Bb", "Cc", "Dd"]
    expected = [list(p) for n in (4, 3, 2, 1) for p in itertools.permutations(names, n)]
    assert [r.terms for r in got if r.person_id == 1] == expected
    assert [r.variant_rank for r in got if r.person_id == 1] == list(range(1, 65))
    assert [r.terms for r in got if r.person_id == 2] == [["Ee"]]


def test_seven_names_unfold(spark, lines):
    people = lists.parse_people(lines(":".join(f"N{c}" for c in "abcdefg").replace("N", "X") + ";Zz"))
    got = persons.variants(people.withColumn("has_homonym", F.lit(False)))
    stats = got.agg(
        F.count("*").alias("n"), F.countDistinct("variant_rank").alias("d"), F.max("variant_rank").alias("m")
    ).first()
    assert stats.n == stats.d == stats.m == 13699


def test_same_person_twice_is_one_entry(spark, lines):
    people = lists.parse_people(lines("Aa:Bb;Xx", "Cc;Yy", "Bb:Aa;Xx"))
    got = persons.entries(people).orderBy("ord").collect()
    assert [r.ord for r in got] == [1, 2]
    assert got[0].width == 3 and got[0]["keys"] == ["aa bb xx"]
