import duckdb
import pytest

import __spark_entry__ as entry
from marlstone.llm import registry
from tests.test_catalog import SF, TABLES, rows


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_its_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = registry.QUERIES[name](spark, SF)
    want = con.sql(registry.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
