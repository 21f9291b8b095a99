"""Every registered query against its SQL twin on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = Path(entry.SMALL)
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def twin():
    con = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def rows(frame):
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    return columns, sorted(map(repr, plain.itertuples(index=False, name=None)))


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, twin, name):
    got = entry.queries()[name](spark, str(FOLDER)).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got)
        return
    expected = twin.execute(sql).fetchdf()
    assert rows(got) == rows(expected)
    assert [str(got[c].dtype) for c in sorted(got)] == [
        str(expected[c].dtype) for c in sorted(expected)
    ]


def test_constants_of_the_oracles():
    from inkveil.functions import grammar
    from inkveil.plans import catalogue, oracles

    for name in ("LETTERS", "APOSTROPHES", "PARTICLES", "DEFAULT_KEEP_EXPRESSIONS"):
        assert getattr(oracles, name) == getattr(grammar, name)
    for name in ("DOCUMENT_PEOPLE", "DOCUMENT_KEEP", "SALT", "NESTED_KEEP"):
        assert getattr(oracles, name) == getattr(catalogue, name)


def test_entry(spark):
    redacted = entry.entry(spark)
    assert redacted.columns == ["doc_id", "block_idx", "text"]
    assert redacted.count() > 0
