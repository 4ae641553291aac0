"""Every registered query with SQL, against DuckDB on the smallest tables."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

from harborlens.plans import problems, reference

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = reference.QUERIES | problems.QUERIES, reference.ORACLE | problems.ORACLE
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def plain(value):
    if isinstance(value, float):
        return round(value, 6) if not math.isnan(value) else None
    return value.replace(tzinfo=None) if isinstance(value, datetime.datetime) else value


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLE:
        return
    result = db.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)


def test_entry_holds_all(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
