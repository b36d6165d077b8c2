"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from faultline.plans.registered import ORACLE_SQL, QUERIES
from faultline.sources.tables import TABLES
from tools.parity import rows_of, type_mismatches

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["p_type", "n_name", "r_name", "frequency"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    got = sdf.toPandas()
    want = con.execute(E.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert type_mismatches(sdf, con.sql(E.oracle_sql()[key])) == []
    assert len(got) == len(want)
    assert rows_of(got) == rows_of(want)


def test_oracles_use_only_the_registered_views():
    for key, sql in ORACLE_SQL.items():
        assert "/root" not in sql and "read_parquet" not in sql and ".parquet" not in sql, key
