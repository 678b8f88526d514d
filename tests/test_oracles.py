"""Spark queries vs their DuckDB oracles (literal SQL) on the smallest scale,
plus the driver entry point."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracles import TABLES, norm, rows_key

SF = "/root/testdata/sf0.001"
LLM = set(E._llm.QUERIES) if E._llm else set()  # these are tested in tests/llm
KEYS = sorted(set(E.oracle_sql()) - LLM)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(E.queries()) - LLM == set(KEYS)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() == 2114
    assert "avr_score" in df.columns and "band" in df.columns


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = [tuple(norm(r[c]) for c in cols) for r in sdf.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    drows = [tuple(norm(r[i]) for i in idx) for r in rel.fetchall()]
    assert rows_key(srows) == rows_key(drows)
