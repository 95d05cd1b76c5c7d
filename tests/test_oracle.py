"""Every registered query against its DuckDB oracle (sf0.001; the driver checks sf0.01)."""
import pytest

from oracle_compare import compare, duck_connect
from rosterflow.plans.registry import all_oracle_sql, all_queries

SF = "/root/testdata/sf0.001"
QUERIES = all_queries()
SQL = all_oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], SQL.get(name), SF, con)
    assert r["status"] in ("ok", "rows-only"), r.get("problems")
    cols = QUERIES[name](spark, SF).columns
    assert len(cols) == len({c.lower() for c in cols}), f"{name}: duplicate column names {cols}"
    # plan shape: no nested-loop or Cartesian joins, no row-at-a-time Python in any registered query
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in r["plan"], f"{name}: {bad}"


def test_every_query_has_sql_or_is_declared_rows_only():
    rows_only = set(QUERIES) - set(SQL)
    assert not rows_only, rows_only


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns[:3] == ["c_custkey", "c_name", "c_nationkey"]
    assert df.count() >= 0
    assert set(QUERIES) <= set(e.queries())
