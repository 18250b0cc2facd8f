"""Every registered query against its DuckDB oracle (sf0.001), and the entry."""

import pytest

import __spark_entry__ as E
from chunkwise.plans.queries import QUERIES
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
SLOW = {"run_compare"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "context", "prompt"]
    assert df.count() == 40


def test_every_query_has_an_oracle_or_is_documented():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert missing == {"ann_join", "knn_coded", "run_compare"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, E.queries()[name], E.oracle_sql().get(name), con)
    assert r["status"] in ("ok", "rows-only"), r
    assert r["spark_rows"] > 0


def test_run_compare_rows(spark):
    df = E.queries()["run_compare"](spark, SF)
    rows = df.collect()
    assert len(rows) == 9
    assert {(r["phase"], r["llm"]) for r in rows} == {("ingest", "stub"), ("query", "stub"), ("query", "upper")}
    assert all(r["bytes"] > 0 and r["avg_seconds"] > 0 for r in rows)
    assert {r["store"] for r in rows} == {"upsert", "insert_if_absent", "append"}
