import duckdb
import pytest

import __spark_entry__ as entry
from marlstone.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(round(float(r[i]), 6) if isinstance(r[i], float) else str(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_its_oracle(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    found = rows(got.columns, got.collect())
    if name in catalog.ORACLES:
        want = duck.sql(catalog.ORACLES[name])
        assert sorted(got.columns) == sorted(want.columns)
        assert repr(found) == repr(rows(want.columns, want.fetchall()))
    else:
        assert found
        again = catalog.QUERIES[name](spark, SF)
        assert rows(again.columns, again.collect()) == found


def test_entry_and_registry(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
