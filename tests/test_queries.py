"""Registered queries against their SQL twins on the smallest tables."""

import datetime
import decimal
from pathlib import Path

import pytest

from tillwarden.plans import catalog

DATA = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


QUERIES = catalog.load()


def test_entry_file_lists_every_query():
    import __spark_entry__ as entry

    assert set(entry.queries()) - set(entry.CORPUS) == set(QUERIES)
    assert set(QUERIES) == set(entry.oracle_sql()) - set(entry.CORPUS)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    q = QUERIES[name]
    df = q.run(spark, str(DATA))
    got = df.collect()
    if q.sql is None:
        assert got
        return
    cursor = duck.execute(q.sql)
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(got, df.columns) == rows(cursor.fetchall(), columns)
