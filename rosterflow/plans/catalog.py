"""Registry of the operator queries bound to the driver's test tables.

Each entry pairs a Spark plan ``fn(spark, sf_dir) -> DataFrame`` with an
independent DuckDB SQL text over the same tables (or ``None`` when the query is
checked rows-only). Column names and types are aligned on both sides: counts and
ids are BIGINT, money is summed as DECIMAL and rounded, doubles are rounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.periods import calendar_from_bounds, period_for_month
from ..session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None):
    """Register ``fn`` under ``name`` with its oracle ``sql`` (``None`` = rows-only)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


class Tables:
    """Lazy access to the driver's parquet tables: ``t.orders`` etc."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.memo: dict = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name == "memo":
            raise AttributeError(name)
        return table(self.spark, self.sf_dir, name)

    def once(self, key: str, build):
        """Build a derived frame / scalar once per binding, so one query plans it once."""
        if key not in self.memo:
            self.memo[key] = build()
        return self.memo[key]


# --- the binding calendar: months from the first order to the last shipment -------

def calendar(t: Tables) -> DataFrame:
    """Reporting calendar covering every order and shipment month of the data."""
    return t.once("calendar", lambda: _calendar(t))


def scalar_value(df: DataFrame) -> Column:
    """A one-value aggregate evaluated once (one small job) and inlined as a literal.

    Lazy scalar subqueries are re-planned per adaptive stage; a global bound used
    in many places is cheaper computed once.
    """
    return F.lit(df.first()[0])


def _calendar(t: Tables) -> DataFrame:
    first = first_month(t)
    last = t.once("last_ship", lambda: scalar_value(t.lineitem.select(F.max("l_shipdate").cast("date"))))
    bounds = t.spark.range(1).select(first.alias("start"), F.add_months(F.trunc(last, "month"), 1).alias("end"))
    return calendar_from_bounds(bounds)


def first_month(t: Tables) -> Column:
    """The calendar's first month (the first order's month)."""
    return t.once("first_month", lambda: scalar_value(
        t.orders.select(F.trunc(F.min("o_orderdate").cast("date"), "month"))))


def period_id(col: str | Column, t: Tables) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return period_for_month(F.to_date(c), first_month(t))


CAL_SQL = """
cal_bounds AS (
  SELECT (SELECT date_trunc('month', min(o_orderdate)) FROM orders)::DATE AS s,
         (SELECT date_trunc('month', max(l_shipdate)) FROM lineitem)::DATE AS e),
cal_months AS (
  SELECT s, unnest(generate_series(s::TIMESTAMP, e::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS period FROM cal_bounds),
cal_next AS (SELECT s, period, (period + INTERVAL 1 MONTH)::DATE AS nxt FROM cal_months),
cal AS (
  SELECT CAST(date_diff('month', s, period) + 1 AS INTEGER) AS id,
         'CDC' AS funding_source,
         period,
         period + CAST(2 - (dayofweek(period) + 1) % 7 AS INTEGER) AS period_start,
         nxt + CAST(2 - (dayofweek(nxt) + 1) % 7 AS INTEGER) - 1 AS period_end,
         nxt + CAST(20 - (dayofweek(nxt) + 1) % 7 AS INTEGER) AS due_at
  FROM cal_next),
calendar AS (
  SELECT *, strftime(period_start, '%B %-d, %Y') || ' - ' || strftime(period_end - 2, '%B %d, %Y') AS label FROM cal)
"""

# period id of a timestamp column in SQL, relative to the first order month
def sql_period(expr: str) -> str:
    return (f"CAST(date_diff('month', (SELECT date_trunc('month', min(o_orderdate)) FROM orders), "
            f"date_trunc('month', {expr})) + 1 AS INTEGER)")
