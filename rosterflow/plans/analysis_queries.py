"""D12-D17 analysis queries bound to the test tables.

Rows: one per line item joined to its order — enrollment = order, student =
customer, facility = supplier, created = order date, modified = ship date (about
half of the ship dates precede the order date, so lags are often negative).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import stored
from . import analysis as an
from .catalog import Tables, query

# --- fixed parameters of the binding -------------------------------------------------
LAG_USES = [("students", 3600), ("students", 30 * 86400), ("enrollments", 3600)]   # 1 hour, 30 days, 1 hour
EXCLUDED_YEAR = "1994-1995"
REFERENCE_YEARS = ["1998-1999", "1999-2000"]
CURRENT_YEAR = "2000-2001"
FACILITY_BIN = 10
LINE_ORDER = ["o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
# ------------------------------------------------------------------------------------


def _rows(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return an.with_edit_lag(li.join(o, F.col("l_orderkey") == F.col("o_orderkey")), "o_orderdate", "l_shipdate")


def _kinds(t: Tables):
    rows = _rows(t)
    # (order, line number) is not unique in the data: the order is made total
    students = an.dedupe_first(rows, "o_custkey", LINE_ORDER)
    return {"enrollments": rows, "students": students}


_ROWS_SQL = """
b AS (SELECT o_orderkey, o_custkey, l_linenumber, l_partkey, l_suppkey, o_orderdate, l_shipdate,
             date_diff('second', o_orderdate, l_shipdate) AS lag_seconds
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
s AS (SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS rn FROM b)
      WHERE rn = 1),
u AS (SELECT 'enrollments' AS kind, * FROM b UNION ALL SELECT 'students' AS kind, * FROM s)"""


@query("analysis_base", """
WITH r AS (SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY l_returnflag) AS races
           FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS enrollment_id, o_custkey AS student_id, o_orderdate AS enrollment_created,
       CAST(year(o_orderdate) - CAST(month(o_orderdate) < 7 AS INTEGER) AS VARCHAR) || '-' ||
       CAST(year(o_orderdate) - CAST(month(o_orderdate) < 7 AS INTEGER) + 1 AS VARCHAR) AS school_year,
       r.races, n_name AS agency_name
FROM orders LEFT JOIN r ON r.l_orderkey = o_orderkey
LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""")
def analysis_base(spark, sf):
    """One row per enrollment with sorted category text and agency."""
    from ..functions.dates import school_year
    t = Tables(spark, sf)
    enr = t.orders.select(F.col("o_orderkey").alias("enrollment_id"), F.col("o_custkey").alias("student_id"),
                          F.col("o_orderdate").alias("enrollment_created"))
    cust = t.customer.select("c_custkey", "c_nationkey")
    nat = t.nation.select("n_nationkey", F.col("n_name").alias("agency_name"))
    base = an.analysis_base(enr, t.lineitem, "enrollment_id", "l_orderkey", "l_returnflag",
                            [(cust, "student_id", "c_custkey"), (nat, "c_nationkey", "n_nationkey")])
    return base.select("enrollment_id", "student_id", "enrollment_created",
                       school_year("enrollment_created").alias("school_year"), "races", "agency_name")


@query("edit_lag_stats", f"""
WITH {_ROWS_SQL}
SELECT kind, count(lag_seconds) AS count, round(avg(lag_seconds / 86400.0), 4) AS mean,
       round(stddev_samp(lag_seconds / 86400.0), 4) AS std, round(min(lag_seconds / 86400.0), 4) AS min,
       round(quantile_cont(lag_seconds / 86400.0, 0.25), 4) AS q_25,
       round(quantile_cont(lag_seconds / 86400.0, 0.5), 4) AS q_50,
       round(quantile_cont(lag_seconds / 86400.0, 0.75), 4) AS q_75,
       round(max(lag_seconds / 86400.0), 4) AS max,
       CAST(sum(CASE WHEN l_shipdate IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null_modified
FROM u GROUP BY kind""")
def edit_lag_stats(spark, sf):
    """Lag statistics in days (exact quantiles) for both row kinds."""
    s = an.edit_lag_stats_of(an.lag_counts(_rows(Tables(spark, sf)), "o_custkey", LINE_ORDER, "lag_seconds", "l_shipdate"))
    return s.select("kind", "count", *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "q_25", "q_50",
                                                                        "q_75", "max")], "n_null_modified")


@query("edit_lag_share", f"""
WITH {_ROWS_SQL}
{' UNION ALL '.join(f'''SELECT '{k}' AS kind, CAST({th} AS BIGINT) AS threshold_seconds,
       count(*) FILTER (WHERE lag_seconds > {th}) AS n_over, count(*) AS n_total,
       round(count(*) FILTER (WHERE lag_seconds > {th}) * 100.0 / count(*), 2) AS pct_over
FROM u WHERE kind = '{k}' ''' for k, th in LAG_USES)}""")
def edit_lag_share(spark, sf):
    """Share of rows modified later than each threshold."""
    kinds = _kinds(Tables(spark, sf))
    parts = [an.edit_lag_share(kinds[k], "lag_seconds", th).select(
        F.lit(k).alias("kind"), "threshold_seconds", "n_over", "n_total", "pct_over") for k, th in LAG_USES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("edit_lag_hist", f"""
WITH {_ROWS_SQL}
{' UNION ALL '.join(f'''SELECT '{k}' AS kind, CAST({th} AS BIGINT) AS threshold_seconds,
       CAST(floor(floor(lag_seconds / 86400) / 30) AS BIGINT) AS bin, count(*) AS n
FROM u WHERE kind = '{k}' AND lag_seconds > {th} GROUP BY 3''' for k, th in LAG_USES)}""")
def edit_lag_hist(spark, sf):
    """Histogram of the lag in 30-day bins above each threshold."""
    kinds = _kinds(Tables(spark, sf))
    parts = [an.edit_lag_hist(kinds[k], "lag_seconds", th).select(
        F.lit(k).alias("kind"), "threshold_seconds", "bin", "n") for k, th in LAG_USES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_SY = ("CAST(year({d}) - CAST(month({d}) < 7 AS INTEGER) AS VARCHAR) || '-' || "
       "CAST(year({d}) - CAST(month({d}) < 7 AS INTEGER) + 1 AS VARCHAR)")
_MONTHLY_USES = [("customers_by_order_month", "orders", "o_orderdate", "o_custkey", None),
                 ("orders_by_ship_month", "lineitem", "l_shipdate", "l_orderkey", None),
                 ("suppliers_by_ship_month", "lineitem", "l_shipdate", "l_suppkey", None),
                 ("customers_by_order_month_excl_first_year", "orders", "o_orderdate", "o_custkey", EXCLUDED_YEAR)]


def _monthly_sql(use, tbl, d, i, excl):
    where = f"{d} IS NOT NULL" + (f" AND ({_SY.format(d=d)}) <> '{excl}'" if excl else "")
    return f"""SELECT '{use}' AS use, month, adjusted_month, school_year, n_distinct,
       count(*) OVER () AS n_years_rows, count(DISTINCT school_year) OVER () AS n_years FROM (
  SELECT date_trunc('month', {d})::DATE AS month,
         make_date(CASE WHEN month({d}) < 7 THEN 2020 ELSE 2019 END, month({d}), 1) AS adjusted_month,
         {_SY.format(d=f"date_trunc('month', {d})")} AS school_year, count(DISTINCT {i}) AS n_distinct
  FROM {tbl} WHERE {where} GROUP BY 1, 2, 3)"""


@query("monthly_by_school_year", "SELECT * EXCLUDE (n_years_rows) FROM (" + " UNION ALL ".join(
    f"SELECT * FROM ({_monthly_sql(*u)})" for u in _MONTHLY_USES) + ")")
def monthly_by_school_year(spark, sf):
    """Distinct counts per month on a folded school-year axis."""
    from ..functions.dates import school_year
    t = Tables(spark, sf)
    parts = []
    for use, tbl, d, i, excl in _MONTHLY_USES:
        df = getattr(t, tbl)
        if excl:
            df = df.where(~(school_year(d) == excl) | school_year(d).isNull())
        parts.append(an.monthly_distinct(df, d, i).select(F.lit(use).alias("use"), "month", "adjusted_month",
                                                          "school_year", "n_distinct", "n_years"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _totals_sql(where: str) -> str:
    return f"""SELECT coalesce(s.school_year, e.school_year) AS school_year, s.students, e.enrollments FROM
  (SELECT {_SY.format(d='o_orderdate')} AS school_year, count(DISTINCT o_custkey) AS students
   FROM b WHERE o_orderdate IS NOT NULL {where} GROUP BY 1) s
  FULL JOIN
  (SELECT {_SY.format(d='l_shipdate')} AS school_year, count(DISTINCT o_orderkey) AS enrollments
   FROM b WHERE l_shipdate IS NOT NULL {where} GROUP BY 1) e ON s.school_year = e.school_year"""


_FEB = ("AND make_date(CASE WHEN month(o_orderdate) < 7 THEN 2020 ELSE 2019 END, month(o_orderdate), 1)"
        " < DATE '2020-03-01'")


def _year_counts(spark, sf):
    """Distinct students and enrollments per school year, whole and through February, from monthly bitmaps."""
    bitmaps = an.monthly_bitmaps(_rows(Tables(spark, sf)), {"students": ("o_orderdate", "o_custkey"), "enrollments": ("l_shipdate", "o_orderkey")},
                                 an.is_through_february("o_orderdate"))
    return an.school_year_counts(stored(bitmaps))


@query("school_year_totals", f"""
WITH b AS (SELECT o_orderkey, o_custkey, o_orderdate, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT 'full' AS variant, * FROM ({_totals_sql('')})
UNION ALL SELECT 'partial' AS variant, * FROM ({_totals_sql(_FEB)})""")
def school_year_totals(spark, sf):
    """Students and enrollments per school year, full and through February."""
    counts = _year_counts(spark, sf)
    variants = F.array(
        F.struct(F.lit("full").alias("variant"), F.lit(True).alias("there"), "students", "enrollments"),
        F.struct(F.lit("partial").alias("variant"), (F.col("partial_students").isNotNull() | F.col("partial_enrollments").isNotNull()).alias("there"),
                 F.col("partial_students").alias("students"), F.col("partial_enrollments").alias("enrollments")))
    each = counts.select("school_year", F.explode(variants).alias("v")).where("v.there")
    return each.select("v.variant", "school_year", "v.students", "v.enrollments")


@query("ytd_forecast", f"""
WITH b AS (SELECT o_orderkey, o_custkey, o_orderdate, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
f AS (SELECT school_year, students AS full_students, enrollments AS full_enrollments FROM ({_totals_sql('')})
      WHERE school_year <> '{EXCLUDED_YEAR}'),
p AS (SELECT school_year, students AS partial_students, enrollments AS partial_enrollments FROM ({_totals_sql(_FEB)})),
c AS (SELECT coalesce(f.school_year, p.school_year) AS school_year, full_students, full_enrollments,
             partial_students, partial_enrollments FROM f FULL JOIN p ON f.school_year = p.school_year),
ref AS (SELECT avg(full_students) AS m_fs, avg(full_enrollments) AS m_fe, avg(partial_students) AS m_ps,
               avg(partial_enrollments) AS m_pe FROM c
        WHERE school_year IN ({', '.join(repr(y) for y in REFERENCE_YEARS)})),
cur AS (SELECT * FROM c WHERE school_year = '{CURRENT_YEAR}')
SELECT round(m_fs, 4) AS mean_full_students, round(m_fe, 4) AS mean_full_enrollments,
       round(m_ps, 4) AS mean_partial_students, round(m_pe, 4) AS mean_partial_enrollments,
       round(m_ps / m_fs, 4) AS student_rate, round(m_pe / m_fe, 4) AS enrollment_rate,
       round(cur.full_students / (m_ps / m_fs), 4) AS expected_students,
       round(cur.full_enrollments / (m_pe / m_fe), 4) AS expected_enrollments,
       round(cur.full_students / m_fs, 4) AS ratio_full_students,
       round(cur.full_enrollments / m_fe, 4) AS ratio_full_enrollments,
       round(cur.partial_students / m_ps, 4) AS ratio_partial_students,
       round(cur.partial_enrollments / m_pe, 4) AS ratio_partial_enrollments
FROM ref LEFT JOIN cur ON true""")
def ytd_forecast(spark, sf):
    """Year-to-date forecast from the mean of two reference years."""
    return an.forecast_of_counts(_year_counts(spark, sf), REFERENCE_YEARS, CURRENT_YEAR, [EXCLUDED_YEAR])


@query("facility_sizes", f"""
SELECT CAST(floor(n / {FACILITY_BIN}) AS BIGINT) AS bin, count(*) AS n_facilities
FROM (SELECT l_suppkey, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY l_suppkey) GROUP BY 1""")
def facility_sizes(spark, sf):
    """Facilities binned by their number of distinct enrollments."""
    return an.facility_sizes(Tables(spark, sf).lineitem, "l_suppkey", "l_orderkey", FACILITY_BIN)
