"""Every registered query against its SQL oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from nestrel.plans import catalog
from nestrel.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import digest, duck_types, spark_types

QUERIES, ORACLE = catalog.QUERIES, catalog.ORACLE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.sql(ORACLE[key])
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert spark_types(df) == duck_types(res)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(res.columns, drows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["id", "name", "height", "weight", "hp", "attack", "defense", "s_attack",
                          "s_defense", "speed", "type", "evo_set", "info"]
