"""Functions of the migration and the load, bound to the test tables as they are shipped.

Each query calls the function that the entry points call (``plans/reconcile.py``,
``sinks/target.py``, ``operators/``); only its input is put together here.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import recode as rc
from ..functions.nulls import apply_all, not_in_list
from ..operators import keys, periods, reshape
from ..session import ensure_checkpoint_dir
from ..sinks.target import attach_target_periods, load_periods, restrict_to_organizations, text_dates
from . import reconcile
from .catalog import CAL_SQL, Tables, calendar, period_id, query, sql_period
from .load_queries import target_tables

EVENT_TYPES = ("click", "error", "view")
SINCE = "1996-01-01"
#: Orders as spells: every 7th is open, the others end up to 90 days after the order date.
_SPELLS = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 <> 0
       THEN CAST(o_orderdate AS DATE) + CAST(o_custkey % 90 AS INTEGER) END AS ended FROM orders"""


def _spells(t: Tables):
    end = F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % 90).cast("int"))
    return t.orders.select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 7 != 0, end).alias("ended"))


@query("psr_revenue", f"""
WITH {CAL_SQL},
l AS (SELECT n_name, {sql_period('l_shipdate')} AS period, CAST(l_extendedprice AS DECIMAL(18,2)) AS fees,
             CASE WHEN l_returnflag = 'R' THEN CAST(l_tax * 100 AS DECIMAL(18,2)) END AS subsidy
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
SELECT n_name AS organization, period, CAST(sum(fees) AS DOUBLE) AS family_fees, CAST(coalesce(sum(subsidy), 0) AS DOUBLE) AS c4k_revenue
FROM l GROUP BY ALL""")
def psr_revenue(spark, sf):
    """The shipped revenue step; a roster is a nation's deliveries of one month, with its printed label."""
    t = Tables(spark, sf)
    li = (t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
          .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
          .withColumn("id", period_id("l_shipdate", t)).withColumn("source", F.concat_ws("-", "n_nationkey", "id")))
    totals = li.select("source", F.col("l_extendedprice").cast("decimal(18,2)").alias("family_fees"),
                       F.when(F.col("l_returnflag") == "R", (F.col("l_tax") * 100).cast("decimal(18,2)")).alias("c4k_revenue"))
    rosters = li.select("source", "id", "n_name").distinct()
    cal = calendar(t)
    header = rosters.join(cal.select("id", F.regexp_replace("label", " - ", " to ").alias("psr_format")), "id").select("source", "psr_format")
    return reconcile.psr_revenue(totals, header, rosters.select("source", F.col("n_name").alias("org_name")), cal).select(
        "organization", "period", F.col("family_fees").cast("double").alias("family_fees"), F.col("c4k_revenue").cast("double").alias("c4k_revenue"))


@query("organizations_and_sites", """
WITH orgs AS (SELECT n_name, row_number() OVER (ORDER BY n_name) AS organization_id FROM (SELECT DISTINCT n_name FROM nation WHERE n_nationkey % 4 <> 3)),
s AS (SELECT s_name AS name, organization_id, s_suppkey, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
      JOIN orgs USING (n_name) LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 2) ON r_regionkey = n_regionkey)
SELECT CAST(row_number() OVER (ORDER BY organization_id, name) AS BIGINT) AS site_id, name, CAST(organization_id AS BIGINT) AS organization_id,
       'F' || s_suppkey AS facility_code, r_name AS region, name = 'Supplier#000000003' AS title_i FROM s""")
def organizations_and_sites(spark, sf):
    """The shipped organization and site step."""
    t = Tables(spark, sf)
    revenue = t.nation.where("n_nationkey % 4 <> 3").select(F.col("n_name").alias("organization"))
    none = F.lit(None).cast("string")
    programs = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_name").alias("name"), F.col("n_name").alias("org_name"), F.col("n_regionkey").cast("string").alias("town"),
        none.alias("license_no"), none.alias("naeyc_id"), none.alias("registry_id"), F.concat(F.lit("F"), F.col("s_suppkey")).alias("facility_code"))
    towns = t.region.where("r_regionkey <> 2").select(F.col("r_regionkey").cast("string").alias("town"), F.col("r_name").alias("region"))
    _, sites = reconcile.organizations_and_sites(revenue, programs, towns, ["Supplier#000000003"])
    return sites.select("site_id", "name", "organization_id", "facility_code", "region", "title_i")


@query("open_reports", f"""
SELECT CAST(row_number() OVER (ORDER BY c_nationkey) AS BIGINT) AS report_id, c_nationkey AS organization_id,
       (SELECT max({sql_period('o_orderdate')}) FROM orders) + 1 AS period_id FROM (SELECT DISTINCT c_nationkey FROM customer)""")
def open_reports(spark, sf):
    """The shipped report step."""
    t = Tables(spark, sf)
    orgs = t.customer.select(F.col("c_nationkey").alias("organization_id"), F.lit("any").alias("name")).distinct()
    out = reconcile.current_reports(orgs, t.orders.select(period_id("o_orderdate", t).alias("period")))
    return out.select("report_id", "organization_id", F.col("ReportingPeriodId").alias("period_id"))


@query("gender_codes", """
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 4 WHEN 1 THEN 0 WHEN 2 THEN 1 END AS gender FROM customer""")
def gender_codes(spark, sf):
    """The shipped code, on fixed-width texts with and without the trailing blank, and NULL."""
    text = rc.recode(F.col("c_custkey") % 4, {1: "M ", 2: "F ", 3: "M"})
    return Tables(spark, sf).customer.select("c_custkey", rc.gender_code(text).alias("gender"))


@query("event_counts", "SELECT user_id, " + ", ".join(
    f"CAST(count(*) FILTER (WHERE event_type = '{v}') AS BIGINT) AS n_{v}" for v in EVENT_TYPES) + " FROM events GROUP BY user_id")
def event_counts(spark, sf):
    """Counts per key, one column for each value."""
    return reshape.wide_counts(Tables(spark, sf).events, ["user_id"], "event_type", EVENT_TYPES, "n_")


@query("resolve_by_name", """
SELECT s_suppkey, n_nationkey AS organization_id FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND s_suppkey % 5 <> 0""")
def resolve_by_name(spark, sf):
    """K9: the parent's id by its name; unknown names give NULL."""
    t = Tables(spark, sf)
    named = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.when(F.col("s_suppkey") % 5 != 0, F.col("n_name")).otherwise(F.lit("nowhere")).alias("written"))
    return keys.resolve_by_name(named, t.nation, "written", "n_name", "n_nationkey", "organization_id").select("s_suppkey", "organization_id")


@query("restrict_organizations", """
WITH o AS (SELECT n_nationkey FROM nation WHERE n_regionkey = 1), c AS (SELECT c_custkey FROM customer JOIN o ON n_nationkey = c_nationkey),
e AS (SELECT o_orderkey FROM orders JOIN c ON c_custkey = o_custkey JOIN supplier ON s_suppkey = o_orderkey % 10 + 1 JOIN o ON n_nationkey = s_nationkey)
SELECT 'Organization' AS table_name, count(*) AS n FROM o
UNION ALL SELECT 'Site', count(*) FROM supplier JOIN o ON n_nationkey = s_nationkey
UNION ALL SELECT 'Family', count(*) FROM c UNION ALL SELECT 'FamilyDetermination', count(*) FROM c
UNION ALL SELECT 'Child', count(*) FROM c UNION ALL SELECT 'Enrollment', count(*) FROM e
UNION ALL SELECT 'Report', count(*) FROM (SELECT DISTINCT s_nationkey, year(l_shipdate) FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN o ON n_nationkey = s_nationkey)
UNION ALL SELECT 'Funding', count(*) FROM lineitem JOIN e ON o_orderkey = l_orderkey""")
def restrict_organizations(spark, sf):
    """K2: the rows under some organizations, down the key chain."""
    t = Tables(spark, sf)
    kept = restrict_to_organizations(target_tables(t, first=False), t.nation.where("n_regionkey = 1").select("n_nationkey"))
    out = None
    for name in kept:
        part = kept[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("open_or_recent", f"SELECT o_orderkey FROM ({_SPELLS}) WHERE ended IS NULL OR ended >= DATE '{SINCE}'")
def open_or_recent(spark, sf):
    """Spells that are open or ended since a date."""
    return periods.open_or_recent(_spells(Tables(spark, sf)), "ended", F.lit(SINCE).cast("date")).select("o_orderkey")


@query("active_since", f"""
WITH s AS ({_SPELLS}) SELECT o_orderkey, o_custkey FROM s
WHERE o_custkey IN (SELECT o_custkey FROM s WHERE ended IS NULL OR ended >= DATE '{SINCE}')""")
def active_since(spark, sf):
    """All spells of the keys with an open or recent one."""
    return periods.active_since(_spells(Tables(spark, sf)), "o_custkey", ["ended"], F.lit(SINCE).cast("date")).select("o_orderkey", "o_custkey")


@query("text_dates", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS at FROM orders""")
def text_dates_q(spark, sf):
    """K5: dates and timestamps as texts."""
    rows = Tables(spark, sf).orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_orderdate").alias("at"))
    return text_dates(rows, ["day"], ["at"])


@query("excluded_brands", "SELECT p_partkey FROM part WHERE p_brand IS NULL OR p_brand NOT IN ('Brand#11', 'Brand#22')")
def excluded_brands(spark, sf):
    """Rows outside a literal list; NULL is outside."""
    return Tables(spark, sf).part.where(not_in_list("p_brand", ["Brand#11", "Brand#22"])).select("p_partkey")


@query("upper_all", "SELECT upper(p_name) AS p_name, upper(p_brand) AS p_brand, p_partkey FROM part")
def upper_all(spark, sf):
    """One function on several columns."""
    return apply_all(Tables(spark, sf).part.select("p_name", "p_brand", "p_partkey"), F.upper, ["p_name", "p_brand"])


@query("target_periods", f"""
WITH {CAL_SQL}, f AS (SELECT *, id % 3 <> 1 AS f FROM calendar)
SELECT id, period, CAST(CASE WHEN f THEN row_number() OVER (PARTITION BY f ORDER BY period)
       ELSE (SELECT count(*) FROM f WHERE f) + row_number() OVER (PARTITION BY f ORDER BY period) END AS BIGINT) AS id_remote FROM f""")
def target_periods(spark, sf):
    """The period dimension, loaded in two steps, and the target's id of each local period."""
    t = Tables(spark, sf)
    cal = calendar(t)
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/periods-{uuid.uuid4().hex}"
    load_periods(cal.where("id % 3 <> 1"), out)
    load_periods(cal, out)
    linked, _ = attach_target_periods(cal, spark.read.parquet(f"{out}/ReportingPeriod"))
    return linked.select("id", "period", "id_remote")
