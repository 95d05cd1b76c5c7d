"""Operator queries for the entity, enrollment and funding steps, bound to the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import recode as rc
from ..operators import dedupe, joins, keys, reshape
from ..operators.periods import active_in_period, interval_overlap_join, open_ended_last
from ..operators.quality import one_value_per_group
from ..sources.lookups import RATES_CSV, rates
from .catalog import CAL_SQL, Tables, calendar, first_month, period_id, query, sql_period

# --- fixed parameters of the bindings ----------------------------------------------
SPELL_MAX_DAYS = 90          # order spell = [order date, order date + custkey % 90 days]
OPEN_EVERY = 7               # every 7th order key has an open (NULL) end
REMAP_SITE = {2: 1}          # P14: nation 2 is folded into nation 1
# ------------------------------------------------------------------------------------

_P_ORDER = sql_period("o_orderdate")


@query("observed_span", f"""
WITH o AS (SELECT o_custkey,
                  CASE WHEN NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P') THEN {_P_ORDER} END AS p
           FROM orders)
SELECT o_custkey,
       CASE WHEN max(CASE WHEN p IS NULL THEN 1 ELSE 0 END) = 1 THEN NULL ELSE min(p) END AS first_period,
       CASE WHEN max(CASE WHEN p IS NULL THEN 1 ELSE 0 END) = 1 THEN NULL ELSE max(p) END AS last_period
FROM o GROUP BY o_custkey""")
def observed_span(spark, sf):
    """A5 (strict min/max): first/last period per customer, NULL if any period is unknown."""
    t = Tables(spark, sf)
    known = ~((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"))
    o = t.orders.select("o_custkey", F.when(known, period_id("o_orderdate", t)).alias("p"))
    return dedupe.observed_span(o, ["o_custkey"], "p")


@query("group_bounds", f"""
SELECT o_orderkey, o_custkey, {_P_ORDER} AS p,
       min({_P_ORDER}) OVER (PARTITION BY o_custkey) AS first_period,
       max({_P_ORDER}) OVER (PARTITION BY o_custkey) AS last_period
FROM orders""")
def group_bounds(spark, sf):
    """Group min/max attached to every row (grouped ``mutate``)."""
    t = Tables(spark, sf)
    o = t.orders.select("o_orderkey", "o_custkey", period_id("o_orderdate", t).alias("p"))
    return dedupe.with_group_bounds(o, ["o_custkey"], "p", "first_period", "last_period")


@query("drop_closed_when_one_open", """
WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS exit_date
           FROM lineitem),
g AS (SELECT l_orderkey, count(*) AS n, sum(CASE WHEN exit_date IS NULL THEN 1 ELSE 0 END) AS n_open
      FROM l GROUP BY l_orderkey)
SELECT l.* FROM l JOIN g USING (l_orderkey) WHERE n = 1 OR n_open <> 1 OR exit_date IS NULL""")
def drop_closed_when_one_open(spark, sf):
    """Drop closed spells of a group that has exactly one open spell."""
    li = Tables(spark, sf).lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linestatus") == "F", F.to_date("l_shipdate")).alias("exit_date"))
    return dedupe.drop_closed_when_one_open(li, ["l_orderkey"], "exit_date")


@query("close_on_move", f"""
WITH {CAL_SQL},
g AS (SELECT o_custkey, o_orderstatus AS grp, min({_P_ORDER}) AS first_period, max({_P_ORDER}) AS last_period,
             CAST(min(o_orderdate) AS DATE) AS entry_date,
             CASE WHEN o_orderstatus = 'F' THEN CAST(max(o_orderdate) AS DATE) END AS exit_date,
             CASE WHEN o_orderstatus = 'F' THEN 'Other' END AS reason
      FROM orders GROUP BY o_custkey, o_orderstatus),
j AS (SELECT g.*, c1.period_start AS first_start, c2.period_end AS last_end
      FROM g JOIN calendar c1 ON c1.id = g.first_period JOIN calendar c2 ON c2.id = g.last_period),
m AS (SELECT j.*, (min(grp) OVER w <> max(grp) OVER w) AS moved, grp = max(grp) OVER w AS moved_to
      FROM j WINDOW w AS (PARTITION BY o_custkey))
SELECT o_custkey, grp,
       CASE WHEN moved AND moved_to THEN first_start ELSE entry_date END AS entry_date,
       CASE WHEN moved AND NOT moved_to THEN last_end ELSE exit_date END AS exit_date,
       CASE WHEN moved AND NOT moved_to THEN 'Aged Out' ELSE reason END AS reason
FROM m""")
def close_on_move(spark, sf):
    """Customers in several status groups move to the greatest one."""
    t = Tables(spark, sf)
    cal = F.broadcast(calendar(t).select("id", "period_start", "period_end"))
    p = period_id("o_orderdate", t)
    g = (t.orders.groupBy("o_custkey", F.col("o_orderstatus").alias("grp"))
         .agg(F.min(p).alias("first_period"), F.max(p).alias("last_period"),
              F.to_date(F.min("o_orderdate")).alias("entry_date"), F.max("o_orderdate").alias("__last"))
         .withColumn("exit_date", F.when(F.col("grp") == "F", F.to_date("__last")))
         .withColumn("reason", F.when(F.col("grp") == "F", F.lit("Other")))
         .drop("__last"))
    j = (g.join(cal.select(F.col("id").alias("first_period"), F.col("period_start").alias("first_start")),
                "first_period")
          .join(cal.select(F.col("id").alias("last_period"), F.col("period_end").alias("last_end")), "last_period"))
    out = dedupe.close_on_move(j, "o_custkey", "grp", "entry_date", "exit_date", "reason", "first_start", "last_end")
    return out.select("o_custkey", "grp", "entry_date", "exit_date", "reason")


_DUP_SQL = "SELECT o_custkey, o_orderdate FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1"


@query("duplicates_gate", f"""
SELECT o_orderkey, o_custkey, o_orderdate FROM orders JOIN ({_DUP_SQL}) USING (o_custkey, o_orderdate)""")
def duplicates_gate(spark, sf):
    """Orders whose (customer, date) key is not unique."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return dedupe.duplicates(o, ["o_custkey", "o_orderdate"])


@query("merge_spells", f"""
WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS entry_date,
                  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS exit_date FROM orders),
k AS (SELECT DISTINCT o_custkey FROM ({_DUP_SQL})),
listed AS (SELECT o_orderkey, o_custkey, min(entry_date) OVER (PARTITION BY o_custkey) AS entry_date, exit_date,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY exit_date DESC NULLS FIRST, o_orderkey DESC) AS rn
           FROM o WHERE o_custkey IN (SELECT o_custkey FROM k))
SELECT o_orderkey, o_custkey, entry_date, exit_date FROM o WHERE o_custkey NOT IN (SELECT o_custkey FROM k)
UNION ALL
SELECT o_orderkey, o_custkey, entry_date, exit_date FROM listed WHERE rn = 1""")
def merge_spells(spark, sf):
    """D8 fix-up: customers failing the uniqueness gate get one merged spell."""
    o = Tables(spark, sf).orders
    base = o.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("entry_date"),
                    F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate")).alias("exit_date"))
    dup_keys = dedupe.duplicates(o.select("o_custkey", "o_orderdate"), ["o_custkey", "o_orderdate"]).select(
        "o_custkey")
    return dedupe.merge_spells(base, "o_custkey", dup_keys, ["entry_date"], "exit_date", ["o_orderkey"])


@query("one_org_per_file", """
SELECT l_orderkey, count(DISTINCT s_nationkey) AS n_values
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey HAVING count(DISTINCT s_nationkey) > 1""")
def one_org_per_file(spark, sf):
    """V1: "files" (orders) whose rows resolve to more than one organization (nation)."""
    t = Tables(spark, sf)
    li = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return one_value_per_group(li, ["l_orderkey"], "s_nationkey")


@query("open_ended_period", f"""
WITH p AS (SELECT o_custkey, min({_P_ORDER}) AS first_period, max({_P_ORDER}) AS last_period FROM orders GROUP BY 1)
SELECT o_custkey, first_period,
       CASE WHEN last_period < (SELECT max({_P_ORDER}) FROM orders) THEN last_period END AS last_period
FROM p""")
def open_ended_period(spark, sf):
    """The last period stays open unless it precedes the global last one."""
    t = Tables(spark, sf)
    p = period_id("o_orderdate", t)
    spans = t.orders.groupBy("o_custkey").agg(F.min(p).alias("first_period"), F.max(p).alias("last_period"))
    global_max = t.orders.select(F.max(p)).scalar()
    return spans.withColumn("last_period", open_ended_last("last_period", global_max))


_FUND_SQL = f"""
WITH {CAL_SQL},
o AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, {_P_ORDER} AS p FROM orders),
gmax AS (SELECT max(p) AS m FROM o),
cdc AS (
  SELECT o_orderkey AS enrollment_id, 0 AS funding_source, CAST(NULL AS DOUBLE) AS family_id,
         CAST(NULL AS DATE) AS certificate_start, CAST(NULL AS DATE) AS certificate_end,
         p AS first_period, CASE WHEN o_orderstatus = 'F' THEN p END AS last_period,
         CASE WHEN coalesce(o_orderpriority IN ('1-URGENT'), false) THEN 0
              WHEN (CASE WHEN o_orderpriority LIKE '%URGENT%' THEN 'IT' WHEN o_orderpriority LIKE '%HIGH%' THEN 'PS'
                         WHEN o_orderpriority LIKE '%MEDIUM%' THEN 'SA' END) = 'SA' THEN 1
              WHEN (CASE WHEN o_orderpriority LIKE '%URGENT%' THEN 'IT' WHEN o_orderpriority LIKE '%HIGH%' THEN 'PS'
                         WHEN o_orderpriority LIKE '%MEDIUM%' THEN 'SA' END) <> 'SA' THEN 0 END AS funding_time
  FROM o),
c4k AS (
  SELECT o_orderkey AS enrollment_id, 1 AS funding_source,
         CAST(TRY_CAST(regexp_replace(o_orderpriority, '[^0-9]', '', 'g') AS INTEGER) AS DOUBLE) AS family_id,
         CAST(NULL AS DATE) AS certificate_start,
         CASE WHEN p < (SELECT m FROM gmax) THEN c.period_end END AS certificate_end,
         CAST(NULL AS INTEGER) AS first_period, CAST(NULL AS INTEGER) AS last_period,
         CAST(NULL AS INTEGER) AS funding_time
  FROM o JOIN calendar c ON c.id = o.p WHERE o_orderstatus = 'F')
SELECT CAST(row_number() OVER (ORDER BY funding_source, enrollment_id) AS BIGINT) AS funding_id, *
FROM (SELECT * FROM cdc UNION ALL SELECT * FROM c4k)"""


@query("fundings_union", _FUND_SQL)
def fundings_union(spark, sf):
    """Two typed-NULL projections bound by name, numbered by ``assign_ids``."""
    t = Tables(spark, sf)
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", period_id("o_orderdate", t).alias("p"))
    gmax = o.select(F.max("p")).scalar()
    age = rc.age_group_from_text("o_orderpriority", [("URGENT", "IT"), ("HIGH", "PS"), ("MEDIUM", "SA")])
    cdc = o.select(
        F.col("o_orderkey").alias("enrollment_id"), F.lit(0).alias("funding_source"),
        F.lit(None).cast("double").alias("family_id"), F.lit(None).cast("date").alias("certificate_start"),
        F.lit(None).cast("date").alias("certificate_end"), F.col("p").alias("first_period"),
        F.when(F.col("o_orderstatus") == "F", F.col("p")).alias("last_period"),
        rc.funding_time("o_orderpriority", age, ["1-URGENT"]).alias("funding_time"))
    cal = F.broadcast(calendar(t).select(F.col("id").alias("p"), "period_end"))
    c4k = o.where(F.col("o_orderstatus") == "F").join(cal, "p").select(
        F.col("o_orderkey").alias("enrollment_id"), F.lit(1).alias("funding_source"),
        rc.digits_to_int("o_orderpriority").cast("double").alias("family_id"),
        F.lit(None).cast("date").alias("certificate_start"),
        F.when(F.col("p") < gmax, F.col("period_end")).alias("certificate_end"),
        F.lit(None).cast("int").alias("first_period"), F.lit(None).cast("int").alias("last_period"),
        F.lit(None).cast("int").alias("funding_time"))
    both = joins.union_by_name(cdc, c4k)
    return keys.assign_ids(both, ["funding_source", "enrollment_id"], id_col="funding_id")


@query("assign_ids", """
SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_nationkey, c_name, c_custkey) AS BIGINT) AS id FROM customer""")
def assign_ids(spark, sf):
    """Ids 1..n in a total order without a single-partition window."""
    c = Tables(spark, sf).customer.select("c_custkey", "c_nationkey", "c_name")
    return keys.assign_ids(c, ["c_nationkey", "c_name", "c_custkey"]).select("c_custkey", "id")


@query("remap_keys", """
WITH m AS (SELECT n_nationkey AS local_id, CAST(row_number() OVER (ORDER BY n_name DESC) AS BIGINT) + 1000 AS target_id
           FROM nation)
SELECT s_suppkey, target_id AS s_nationkey, n.n_name AS nation_name
FROM supplier JOIN m ON s_nationkey = m.local_id JOIN nation n ON n.n_nationkey = supplier.s_nationkey""")
def remap_keys(spark, sf):
    """K3, K9: local keys replaced by target ids (ids assigned before writing); name lookup."""
    t = Tables(spark, sf)
    key_map = keys.assign_ids(t.nation.select("n_nationkey", "n_name"), [F.col("n_name").desc()],
                              id_col="target_id", start=1001).select(
        F.col("n_nationkey").alias("local_id"), "target_id")
    named = keys.resolve_by_name(t.supplier.select("s_suppkey", "s_nationkey"),
                                 t.nation.select("n_nationkey", "n_name"), "s_nationkey", "n_nationkey", "n_name",
                                 "nation_name")
    return keys.remap_keys(named, key_map, "s_nationkey").select("s_suppkey", "s_nationkey", "nation_name")


@query("remap_site", f"""
SELECT s_suppkey, CASE WHEN s_nationkey = {list(REMAP_SITE)[0]} THEN {list(REMAP_SITE.values())[0]}
                       ELSE s_nationkey END AS s_nationkey, n_name
FROM supplier JOIN nation ON n_nationkey = (CASE WHEN s_nationkey = {list(REMAP_SITE)[0]}
                                                THEN {list(REMAP_SITE.values())[0]} ELSE s_nationkey END)
WHERE n_nationkey <> {list(REMAP_SITE)[0]}""")
def remap_site(spark, sf):
    """Drop one dimension member and redirect its facts to another."""
    t = Tables(spark, sf)
    facts, dim = keys.remap_dimension(t.supplier.select("s_suppkey", "s_nationkey"), t.nation, "s_nationkey",
                                      "n_nationkey", REMAP_SITE)
    return facts.join(dim.select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "s_nationkey", "n_name")


@query("null_safe_join", """
WITH d AS (SELECT doc_id, lang, CASE WHEN n_chars > 5000 THEN 'long' END AS k2 FROM documents),
r AS (SELECT lang, k2, round(avg(quality), 4) AS avg_quality, count(*) AS n_labelled
      FROM d JOIN labels USING (doc_id) GROUP BY lang, k2)
SELECT d.doc_id, d.lang, d.k2, r.avg_quality, r.n_labelled
FROM d LEFT JOIN r ON d.lang = r.lang AND d.k2 IS NOT DISTINCT FROM r.k2""")
def null_safe_join(spark, sf):
    """Left join on a nullable multi-key where NULL matches NULL."""
    t = Tables(spark, sf)
    d = t.documents.select("doc_id", "lang", F.when(F.col("n_chars") > 5000, F.lit("long")).alias("k2"))
    r = (d.join(t.labels, "doc_id").groupBy("lang", "k2")
         .agg(F.round(F.avg("quality"), 4).alias("avg_quality"), F.count(F.lit(1)).alias("n_labelled")))
    return joins.null_safe_join(d, r, ["lang", "k2"], "left", nullable=["k2"]).select(
        "doc_id", "lang", "k2", "avg_quality", "n_labelled")


@query("current_reports", f"""
SELECT CAST(row_number() OVER (ORDER BY c_nationkey) AS BIGINT) AS report_id, 0 AS funding_source,
       (SELECT max({_P_ORDER}) FROM orders) + 1 AS reporting_period_id, CAST(NULL AS TIMESTAMP) AS submitted_at,
       c_nationkey AS organization_id, true AS accredited, CAST(NULL AS DOUBLE) AS c4k_revenue,
       false AS retroactive_c4k_revenue, CAST(NULL AS DOUBLE) AS family_fees_revenue
FROM (SELECT DISTINCT c_nationkey FROM customer)""")
def current_reports(spark, sf):
    """D9 reports: one open report per organization for the period after the last observed one."""
    t = Tables(spark, sf)
    next_period = t.orders.select(F.max(period_id("o_orderdate", t)) + 1).scalar()
    orgs = t.customer.select(F.col("c_nationkey").alias("organization_id")).distinct()
    reports = orgs.select(
        F.lit(0).alias("funding_source"), next_period.alias("reporting_period_id"),
        F.lit(None).cast("timestamp_ntz").alias("submitted_at"), "organization_id", F.lit(True).alias("accredited"),
        F.lit(None).cast("double").alias("c4k_revenue"), F.lit(False).alias("retroactive_c4k_revenue"),
        F.lit(None).cast("double").alias("family_fees_revenue"))
    return keys.assign_ids(reports, ["organization_id"], id_col="report_id")


@query("completeness", """
WITH d AS (SELECT lang, quality, toxic, source FROM documents LEFT JOIN labels USING (doc_id)),
m AS (SELECT lang, 'quality' AS attribute, CAST(sum(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing,
             count(*) AS total FROM d GROUP BY lang
      UNION ALL
      SELECT lang, 'toxic', CAST(sum(CASE WHEN toxic IS NULL THEN 1 ELSE 0 END) AS BIGINT), count(*) FROM d
      GROUP BY lang
      UNION ALL
      SELECT lang, 'source', CAST(sum(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS BIGINT), count(*) FROM d
      GROUP BY lang)
SELECT lang, attribute, missing, total, round(missing * 100.0 / total, 2) AS missing_pct FROM m""")
def completeness(spark, sf):
    """Missing count, total and percent per language and attribute (one pass)."""
    t = Tables(spark, sf)
    d = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    return reshape.completeness(d, ["lang"], {"quality": F.col("quality").isNull(),
                                              "toxic": F.col("toxic").isNull(),
                                              "source": F.col("source").isNull()})


# --- spells and reports for the period joins (J11, J12) ---------------------------

def order_spells(t: Tables, extra=()):
    """Orders as funding spells: [order date, order date + custkey % 90 days], every 7th open.

    ``extra`` order columns are carried along (no self-join to fetch them later).
    """
    o = t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    end = F.when(F.col("o_orderkey") % OPEN_EVERY != 0,
                 F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % SPELL_MAX_DAYS).cast("int")))
    return o.select("o_orderkey", "o_custkey", F.col("c_nationkey").alias("organization"),
                    F.to_date("o_orderdate").alias("spell_start"), end.alias("spell_end"), *extra)


def report_keys(t: Tables):
    """Past reports: every (organization, month) with shipments (the D2 revenue rows)."""
    from .roster_queries import _revenue
    rev = _revenue(t)
    return rev.select("organization", period_id("period", t).alias("period_id"), "family_fees", "c4k_revenue")


_SPELL_SQL = f"""
spells AS (
  SELECT o_orderkey, o_custkey, c_nationkey AS organization, CAST(o_orderdate AS DATE) AS spell_start,
         CASE WHEN o_orderkey % {OPEN_EVERY} <> 0
              THEN CAST(o_orderdate AS DATE) + CAST(o_custkey % {SPELL_MAX_DAYS} AS INTEGER) END AS spell_end
  FROM orders JOIN customer ON o_custkey = c_custkey),
reps AS (
  SELECT DISTINCT s_nationkey AS organization, {sql_period('l_shipdate')} AS period_id
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""


@query("active_in_period", f"""
WITH {CAL_SQL}, {_SPELL_SQL},
f AS (SELECT o_orderkey, organization, {sql_period('spell_start')} AS first_period,
             CASE WHEN spell_end IS NOT NULL THEN {sql_period('spell_end')} END AS last_period FROM spells)
SELECT r.organization, r.period_id, f.o_orderkey
FROM reps r JOIN f ON f.organization = r.organization
 AND f.first_period <= r.period_id AND (f.last_period IS NULL OR f.last_period >= r.period_id)""")
def active_in_period_q(spark, sf):
    """Spells active in each report's period (same organization), as an equi-join."""
    t = Tables(spark, sf)
    spells = order_spells(t)
    first = first_month(t)
    from ..operators.periods import period_for_month
    facts = spells.select("o_orderkey", "organization",
                          period_for_month(F.col("spell_start"), first).alias("first_period"),
                          period_for_month(F.col("spell_end"), first).alias("last_period"))
    reps = report_keys(t).select("organization", "period_id")
    out = active_in_period(facts, reps, "organization", "first_period", "last_period", "period_id")
    return out.select("organization", "period_id", "o_orderkey")


@query("interval_overlap", f"""
WITH {CAL_SQL}, {_SPELL_SQL}
SELECT r.organization, r.period_id, s.o_orderkey
FROM reps r JOIN calendar c ON c.id = r.period_id
JOIN spells s ON s.organization = r.organization
 AND s.spell_start <= c.period_end AND (s.spell_end IS NULL OR s.spell_end >= c.period_start)""")
def interval_overlap(spark, sf):
    """Spells overlapping each report's period dates (same organization), as an equi-join."""
    t = Tables(spark, sf)
    cal = F.broadcast(calendar(t).select(F.col("id").alias("period_id"), "period_start", "period_end"))
    reps = report_keys(t).select("organization", "period_id").join(cal, "period_id")
    out = interval_overlap_join(order_spells(t), reps, "organization", "spell_start", "spell_end",
                                "period_start", "period_end")
    return out.select("organization", "period_id", "o_orderkey")


@query("latest_determination", """
SELECT c_custkey, o_orderkey, o_totalprice, o_orderdate FROM customer LEFT JOIN (
  SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate,
                        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST,
                                           o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
) ON c_custkey = o_custkey""")
def latest_determination(spark, sf):
    """Newest determination (order) per family (customer), families without one kept."""
    t = Tables(spark, sf)
    latest = dedupe.latest_per_key(t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"),
                                   ["o_custkey"], ["o_orderdate"], ["o_orderkey"])
    return (t.customer.select("c_custkey").join(latest, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select("c_custkey", "o_orderkey", "o_totalprice", "o_orderdate"))


def rates_values_sql() -> str:
    rows = []
    for line in RATES_CSV.strip().splitlines()[1:]:
        a, ti, reg, age, tm, rate = line.split(",")
        rows.append(f"({a}, {ti}, '{reg}', '{age}', '{tm}', CAST({float(rate)} AS DOUBLE))")
    return ("(VALUES " + ", ".join(rows) + ") AS rates(Accredited, TitleI, Region, AgeGroup, Time, Rate)")


@query("rate_lookup", f"""
WITH p AS (
  SELECT p_partkey, CAST(p_size > 25 AS INTEGER) AS Accredited, CAST(p_retailprice > 1500 AS INTEGER) AS TitleI,
         CASE p_size % 5 WHEN 0 THEN 'East' WHEN 1 THEN 'NorthCentral' WHEN 2 THEN 'NorthWest'
              WHEN 3 THEN 'SouthCentral' WHEN 4 THEN 'SouthWest' END AS Region,
         CASE p_size % 3 WHEN 0 THEN 'Infant/Toddler' WHEN 1 THEN 'Preschool' WHEN 2 THEN 'School-age' END
           AS AgeGroup,
         CASE CAST(p_type IN ('SMALL', 'ECONOMY') AS INTEGER) WHEN 0 THEN 'FT' WHEN 1 THEN 'PT' END AS Time
  FROM part)
SELECT p.p_partkey, p.Accredited, p.TitleI, p.Region, p.AgeGroup, p.Time, r.Rate
FROM p LEFT JOIN {rates_values_sql()}
  ON p.Accredited = r.Accredited AND p.TitleI = r.TitleI AND p.Region = r.Region AND p.AgeGroup = r.AgeGroup
 AND p.Time = r.Time""".replace(") AS rates(", ") AS r("))
def rate_lookup(spark, sf):
    """Decoded labels joined to the fixed rate grid on five keys (broadcast)."""
    p = Tables(spark, sf).part.select(
        "p_partkey", (F.col("p_size") > 25).cast("int").alias("Accredited"),
        (F.col("p_retailprice") > 1500).cast("int").alias("TitleI"),
        rc.recode(F.col("p_size") % 5, rc.REGION_LABELS).alias("Region"),
        rc.recode(F.col("p_size") % 3, rc.AGE_GROUP_LABELS).alias("AgeGroup"),
        rc.recode(F.col("p_type").isin("SMALL", "ECONOMY").cast("int"), rc.TIME_LABELS).alias("Time"))
    return p.join(F.broadcast(rates(spark)), ["Accredited", "TitleI", "Region", "AgeGroup", "Time"], "left").select(
        "p_partkey", "Accredited", "TitleI", "Region", "AgeGroup", "Time", "Rate")
