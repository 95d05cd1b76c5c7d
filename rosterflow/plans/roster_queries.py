"""Operator queries from the roster-reconciliation script, bound to the test tables.

Analogues (SURVEY §7): student -> customer, enrollment -> order, funding spell ->
order spell, roster/provider -> customer/supplier, race rows -> event types,
partially known attribute -> labels on documents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import recode as rc
from ..functions.nulls import in_list, null_if_in
from ..operators import dedupe, fuzzy, joins, keys, reshape
from ..operators.periods import lookup_label
from .catalog import CAL_SQL, Tables, calendar, query

# --- fixed parameters of the bindings ----------------------------------------------
PRIORITY_FLAGS = {"1-URGENT": "is_urgent", "2-HIGH": "is_high", "3-MEDIUM": "is_medium",
                  "4-NOT SPECIFIED": "is_unspecified", "5-LOW": "is_low"}
SELECTED_REGIONS = ["AMERICA", "EUROPE"]
MULTI_FLAG_LABEL = "Multiple Return Flags"
EVENT_FLAGS = {"click": "has_click", "error": "has_error", "purchase": "has_purchase",
               "signup": "has_signup", "view": "has_view"}
EVENT_VALUES = {"click": "click_value", "view": "view_value", "purchase": "purchase_value"}
LICENCE_SENTINELS = ["PROMO"]
TITLE_I_SITES = ["Supplier#000000003"]
# V4 message text (fixed format of the source script's warning).
WARNING_TEMPLATE = ("Fuzzy matched a child from file '{source}' to {org_name}; "
                    "license number as written: {written}, matched to: {matched}")
# ------------------------------------------------------------------------------------


@query("reporting_calendar", f"WITH {CAL_SQL} SELECT * FROM calendar")
def reporting_calendar(spark, sf):
    """The reporting calendar over the data's months."""
    return calendar(Tables(spark, sf))


@query("label_lookup", f"""
WITH {CAL_SQL},
written AS (
  SELECT regexp_replace(replace(c.label, ' - ', ' to '), '\\s+', ' ', 'g') AS header
  FROM orders o JOIN calendar c ON c.period = date_trunc('month', o.o_orderdate)::DATE)
SELECT c.id AS period, c.label, count(*) AS n_orders
FROM written w LEFT JOIN calendar c ON c.label = replace(w.header, ' to ', ' - ')
GROUP BY c.id, c.label""")
def label_lookup(spark, sf):
    """Roster header text ('... to ...') -> period id; orders per period."""
    t = Tables(spark, sf)
    cal = calendar(t)
    written = (t.orders.join(F.broadcast(cal.select("period", "label")),
                             F.trunc(F.to_date("o_orderdate"), "month") == F.col("period"))
               .select(rc.squish(F.regexp_replace("label", " - ", " to ")).alias("header")))
    looked = lookup_label(written, "header", cal, out_col="period")
    return (looked.join(F.broadcast(cal.select(F.col("id").alias("period"), "label")), "period", "left")
            .groupBy("period", "label").agg(F.count(F.lit(1)).alias("n_orders")))


@query("clean_programs", f"""
SELECT p_partkey, p_name AS name,
       CASE WHEN coalesce(p_type IN ({', '.join(repr(s) for s in LICENCE_SENTINELS)}), false) THEN NULL
            ELSE p_type END AS license_no,
       trim(list_last(string_split(regexp_replace(regexp_replace(p_name, ' ', ', ', 'g'), ',$', ''), ',')))
         AS org_name
FROM part WHERE p_name IS NOT NULL""")
def clean_programs(spark, sf):
    """Program list cleanup (sentinel licences, contractor's last piece)."""
    p = Tables(spark, sf).part
    contractor = F.regexp_replace("p_name", " ", ", ")
    return p.where(F.col("p_name").isNotNull()).select(
        "p_partkey", F.col("p_name").alias("name"), null_if_in("p_type", LICENCE_SENTINELS).alias("license_no"),
        rc.last_piece(contractor, ",").alias("org_name"))


_FUZZY_SQL = """
SELECT c_custkey, s_suppkey, substr(c_name, 10) AS c_code, substr(s_name, 10) AS s_code,
       c_name, s_name, CAST(levenshtein(substr(c_name, 10), substr(s_name, 10)) AS INTEGER) AS fuzzy
FROM customer, supplier
WHERE levenshtein(substr(c_name, 10), substr(s_name, 10)) <= 1"""


def _fuzzy_pairs(spark, sf):
    t = Tables(spark, sf)
    c = t.customer.select("c_custkey", "c_name", F.substring("c_name", 10, 1 << 20).alias("c_code"))
    s = t.supplier.select("s_suppkey", "s_name", F.substring("s_name", 10, 1 << 20).alias("s_code"))
    return fuzzy.fuzzy_join(c, s, "c_code", "s_code", max_dist=1, dist_col="fuzzy")


@query("fuzzy_pairs", f"SELECT c_custkey, s_suppkey, c_code, s_code, fuzzy FROM ({_FUZZY_SQL})")
def fuzzy_pairs(spark, sf):
    """All customer x supplier code pairs within Levenshtein distance 1."""
    return _fuzzy_pairs(spark, sf).select("c_custkey", "s_suppkey", "c_code", "s_code", "fuzzy")


_BEST_SQL = f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY fuzzy, s_suppkey) AS rn FROM ({_FUZZY_SQL}))
WHERE rn = 1"""


@query("fuzzy_best", f"SELECT c_custkey, s_suppkey, fuzzy FROM ({_BEST_SQL})")
def fuzzy_best(spark, sf):
    """Best match per customer (smallest distance, then smallest supplier key)."""
    return fuzzy.best_match(_fuzzy_pairs(spark, sf), ["c_custkey"], "fuzzy", ["s_suppkey"]).select(
        "c_custkey", "s_suppkey", "fuzzy")


@query("fuzzy_warnings", f"""
SELECT c_custkey,
       'Fuzzy matched a child from file ''' || c_name || ''' to ' || s_name ||
       '; license number as written: ' || c_code || ', matched to: ' || s_code AS message
FROM ({_BEST_SQL}) WHERE fuzzy > 0""")
def fuzzy_warnings(spark, sf):
    """One message per inexact best match."""
    best = fuzzy.best_match(_fuzzy_pairs(spark, sf), ["c_custkey"], "fuzzy", ["s_suppkey"])
    head, rest = WARNING_TEMPLATE.split("{source}")
    mid1, rest = rest.split("{org_name}")
    mid2, rest = rest.split("{written}")
    mid3, tail = rest.split("{matched}")
    parts = [head, F.col("c_name"), mid1, F.col("s_name"), mid2, F.col("c_code"), mid3, F.col("s_code"), tail]
    return fuzzy.fuzzy_warnings(best, parts).select("c_custkey", "message")


@query("revenue_by_org_period", """
SELECT s_nationkey AS organization, date_trunc('month', l_shipdate)::DATE AS period,
       CAST(round(coalesce(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0), 2)
            AS DOUBLE) AS family_fees,
       CAST(round(coalesce(sum(CASE WHEN s_nationkey <> 0
                                    THEN CAST(l_extendedprice * l_discount AS DECIMAL(18,4)) END), 0), 2)
            AS DOUBLE) AS c4k_revenue
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
GROUP BY 1, 2""")
def revenue_by_org_period(spark, sf):
    """Fees and subsidy revenue per organization and month; missing sums are 0."""
    return _revenue(Tables(spark, sf))


def _revenue(t: Tables):
    li = t.lineitem.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    fees = F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice").cast("decimal(18,2)"))
    subsidy = F.when(F.col("s_nationkey") != 0, (F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(18,4)"))
    return li.groupBy(F.col("s_nationkey").alias("organization"),
                      F.trunc(F.to_date("l_shipdate"), "month").alias("period")).agg(
        F.round(F.coalesce(F.sum(fees), F.lit(0)), 2).cast("double").alias("family_fees"),
        F.round(F.coalesce(F.sum(subsidy), F.lit(0)), 2).cast("double").alias("c4k_revenue"))


@query("sites_dim", f"""
WITH sn AS (SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey),
orgs AS (SELECT n_name, CAST(row_number() OVER (ORDER BY n_name) AS BIGINT) AS organization_id
         FROM (SELECT DISTINCT n_name FROM sn))
SELECT CAST(row_number() OVER (ORDER BY s_suppkey) AS BIGINT) AS site_id, s_name AS name, organization_id,
       r_name AS region, coalesce(s_name IN ({', '.join(repr(s) for s in TITLE_I_SITES)}), false) AS title_i
FROM sn JOIN orgs USING (n_name) LEFT JOIN region ON n_regionkey = r_regionkey""")
def sites_dim(spark, sf):
    """Organizations by name, sites with region lookup and Title I flag."""
    t = Tables(spark, sf)
    sn = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    orgs = keys.assign_ids(sn.select("n_name").distinct(), ["n_name"], id_col="organization_id")
    sites = (sn.join(orgs, "n_name")
               .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
               .select(F.col("s_suppkey"), F.col("s_name").alias("name"), "organization_id",
                       F.col("r_name").alias("region"), in_list("s_name", TITLE_I_SITES).alias("title_i")))
    return keys.assign_ids(sites, ["s_suppkey"], id_col="site_id").drop("s_suppkey")


@query("flat_latest", f"""
WITH sel AS (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
             WHERE r_name IN ({', '.join(repr(r) for r in SELECTED_REGIONS)})),
latest AS (SELECT * FROM (SELECT o.*, row_number() OVER (PARTITION BY o_custkey
                                    ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn FROM orders o)
           WHERE rn = 1),
flags AS (SELECT o_custkey,
  {', '.join(f"max(CASE WHEN o_orderpriority = '{k}' THEN 1 ELSE 0 END) AS {v}" for k, v in PRIORITY_FLAGS.items())}
  FROM orders GROUP BY o_custkey),
coll AS (SELECT l_orderkey, CASE WHEN count(*) > 1 THEN '{MULTI_FLAG_LABEL}' ELSE min(l_returnflag) END AS returnflag
         FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem) GROUP BY l_orderkey)
SELECT c_custkey, c_name, c_nationkey, l.o_orderkey, l.o_orderdate, l.o_totalprice,
  {', '.join(f"CAST(coalesce(f.{v}, 0) AS INTEGER) AS {v}" for v in PRIORITY_FLAGS.values())},
  coll.returnflag
FROM customer c
LEFT JOIN latest l ON c.c_custkey = l.o_custkey
LEFT JOIN flags f ON c.c_custkey = f.o_custkey
LEFT JOIN coll ON coll.l_orderkey = l.o_orderkey
WHERE c.c_nationkey IN (SELECT n_nationkey FROM sel)""")
def flat_latest(spark, sf):
    """Flagship (D4 in small): W1, W2, A2, A3, J2, P8.

    Customers of the selected regions (semi-join on a computed nation list) with
    their newest order (deduplicated *before* the left join), one 0/1 flag per
    order priority (single-pass pivot) and the collapsed return flag of that
    order.
    """
    t = Tables(spark, sf)
    sel = t.nation.join(t.region.where(F.col("r_name").isin(SELECTED_REGIONS)),
                        F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    cust = joins.semi_in(t.customer.select("c_custkey", "c_name", "c_nationkey"), sel, "c_nationkey", "n_nationkey")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    latest = dedupe.latest_per_key(orders, ["o_custkey"], ["o_orderdate"], ["o_orderkey"])
    flags = reshape.flag_pivot(orders, "o_custkey", "o_orderpriority", PRIORITY_FLAGS)
    coll = reshape.collapse_multi(t.lineitem, ["l_orderkey"], "l_returnflag", MULTI_FLAG_LABEL, "returnflag")
    out = (cust.join(latest.drop("o_orderpriority"), F.col("c_custkey") == F.col("o_custkey"), "left")
               .drop("o_custkey")
               .join(flags, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")
               .join(coll, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
               .fillna(0, subset=list(PRIORITY_FLAGS.values())))
    return out.select("c_custkey", "c_name", "c_nationkey", "o_orderkey", "o_orderdate", "o_totalprice",
                      *PRIORITY_FLAGS.values(), "returnflag")


@query("latest_per_key", """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def latest_per_key(spark, sf):
    """Newest event per (user, type); ties to the larger event id."""
    e = Tables(spark, sf).events.select("user_id", "event_type", "event_id", "ts", "value")
    return dedupe.latest_per_key(e, ["user_id", "event_type"], ["ts"], ["event_id"])


@query("last_per_key_nulls", """
SELECT source, doc_id, quality FROM (
  SELECT d.source, d.doc_id, l.quality,
         row_number() OVER (PARTITION BY d.source ORDER BY l.quality DESC NULLS FIRST, d.doc_id DESC) AS rn
  FROM documents d LEFT JOIN labels l USING (doc_id)) WHERE rn = 1""")
def last_per_key_nulls(spark, sf):
    """Last row per source after sorting by a nullable key — a NULL key wins."""
    t = Tables(spark, sf)
    d = t.documents.select("doc_id", "source").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return dedupe.last_per_key(d, ["source"], ["quality"], ["doc_id"]).select("source", "doc_id", "quality")


@query("flag_pivot", f"""
SELECT user_id,
  {', '.join(f"max(CASE WHEN event_type = '{k}' THEN 1 ELSE 0 END) AS {v}" for k, v in EVENT_FLAGS.items())}
FROM events GROUP BY user_id""")
def flag_pivot(spark, sf):
    """A3: one 0/1 column per event type, one aggregation pass."""
    return reshape.flag_pivot(Tables(spark, sf).events, "user_id", "event_type", EVENT_FLAGS)


@query("eav_pivot", f"""
SELECT user_id,
  {', '.join(f"max(CASE WHEN event_type = '{k}' THEN value END) AS {v}" for k, v in EVENT_VALUES.items())}
FROM events GROUP BY user_id""")
def eav_pivot(spark, sf):
    """Attribute rows to columns (duplicates keep the max value)."""
    return reshape.eav_pivot(Tables(spark, sf).events, "user_id", "event_type", "value", EVENT_VALUES)


@query("collapse_multi", f"""
SELECT l_orderkey, CASE WHEN count(*) > 1 THEN '{MULTI_FLAG_LABEL}' ELSE min(l_returnflag) END AS returnflag
FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem) GROUP BY l_orderkey""")
def collapse_multi(spark, sf):
    """A2: several distinct return flags per order -> one label, else the flag."""
    return reshape.collapse_multi(Tables(spark, sf).lineitem, ["l_orderkey"], "l_returnflag", MULTI_FLAG_LABEL,
                                  "returnflag")


@query("string_agg_sorted", """
SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY l_returnflag) AS returnflags
FROM lineitem GROUP BY l_orderkey""")
def string_agg_sorted(spark, sf):
    """A10: sorted comma-joined return flags per order."""
    return reshape.sorted_string_agg(Tables(spark, sf).lineitem, ["l_orderkey"], "l_returnflag", ",", "returnflags")


@query("semi_in", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders
                    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 300000)""")
def semi_in(spark, sf):
    """Customers in a computed id list (left-semi join, no IN-list)."""
    t = Tables(spark, sf)
    ids = t.orders.where(in_list("o_orderpriority", ["1-URGENT", "2-HIGH"]) & (F.col("o_totalprice") > 300000))
    return joins.semi_in(t.customer.select("c_custkey", "c_name"), ids, "c_custkey", "o_custkey")


@query("anti_missing", """
SELECT doc_id, source, lang FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def anti_missing(spark, sf):
    """Documents without a label (left-anti join)."""
    t = Tables(spark, sf)
    return joins.anti_missing(t.documents.select("doc_id", "source", "lang"), t.labels, "doc_id")


@query("union_by_name", """
SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def union_by_name(spark, sf):
    """O3: row-bind two selections with different column orders by name."""
    c = Tables(spark, sf).customer
    a = c.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name", "c_nationkey")
    b = c.where(F.col("c_mktsegment") == "MACHINERY").select("c_nationkey", "c_name", "c_custkey")
    return joins.union_by_name(a, b)


@query("fill_key", """
SELECT c_custkey,
       coalesce(CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey AS VARCHAR) END,
                'TEMP-' || coalesce(c_mktsegment, 'NA') || '-' || coalesce(c_name, 'NA')) AS sasid,
       CASE WHEN c_acctbal >= 0 THEN true ELSE false END AS has_key
FROM customer""")
def fill_key(spark, sf):
    """Placeholder keys for rows without an id; ``has_key`` is J10's filter."""
    c = Tables(spark, sf).customer
    raw = F.when(F.col("c_acctbal") >= 0, F.col("c_custkey").cast("string"))
    return c.select("c_custkey", rc.fill_key(raw, "c_mktsegment", "c_name").alias("sasid"),
                    raw.isNotNull().alias("has_key"))


@query("late_keys", """
WITH e AS (SELECT event_id, user_id, event_type, CASE WHEN value >= 2.0 THEN user_id END AS sasid FROM events),
g AS (SELECT user_id, event_type FROM e GROUP BY user_id, event_type
      HAVING max(CASE WHEN sasid IS NULL THEN 1 ELSE 0 END) = 1
         AND count(DISTINCT sasid) + max(CASE WHEN sasid IS NULL THEN 1 ELSE 0 END) = 2)
SELECT e.* FROM e JOIN g USING (user_id, event_type)""")
def late_keys(spark, sf):
    """Groups seen both without and with a key (exactly one real key)."""
    e = Tables(spark, sf).events.select("event_id", "user_id", "event_type",
                                        F.when(F.col("value") >= 2.0, F.col("user_id")).alias("sasid"))
    return dedupe.late_key_groups(e, ["user_id", "event_type"], "sasid")


_AGE_FRAGMENTS = [("URGENT", "IT"), ("HIGH", "PS"), ("MEDIUM", "SA")]
_EXIT_CATEGORY = {"1-URGENT": "Moved to Another Town", "2-HIGH": "Parent Withdrew Child", "3-MEDIUM": "Aged Out"}


@query("recode_codes", """
WITH o AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority,
         CASE WHEN o_orderpriority LIKE '%URGENT%' THEN 'IT' WHEN o_orderpriority LIKE '%HIGH%' THEN 'PS'
              WHEN o_orderpriority LIKE '%MEDIUM%' THEN 'SA' END AS age_group,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Moved to Another Town' WHEN '2-HIGH' THEN 'Parent Withdrew Child'
              WHEN '3-MEDIUM' THEN 'Aged Out' END AS exit_category,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS exit_date
  FROM orders)
SELECT o_orderkey,
       CASE WHEN o_orderstatus IS NULL THEN 4 WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderstatus = 'O' THEN 1 END
         AS status_code,
       age_group,
       CASE age_group WHEN 'IT' THEN 0 WHEN 'PS' THEN 1 WHEN 'SA' THEN 2 END AS age_code,
       CASE age_group WHEN 'IT' THEN 'Infant/Toddler' WHEN 'PS' THEN 'Preschool' WHEN 'SA' THEN 'School-age' END
         AS age_label,
       CASE WHEN exit_category = 'Moved to Another Town' THEN 'Moved within Connecticut'
            WHEN exit_category = 'Other' THEN 'Other'
            WHEN exit_category = 'Parent Withdrew Child' THEN 'Other'
            WHEN exit_category = 'Aged Out' THEN 'Aged out'
            WHEN exit_category = 'Child Stopped Attending' THEN 'Stopped attending'
            WHEN exit_category = 'Chose to Attend A Different Program' THEN 'Chose to attend a different program'
            WHEN exit_date IS NOT NULL THEN 'Unknown' END AS exit_reason,
       CASE WHEN exit_date IS NULL THEN 'N' ELSE 'Y' END AS c4k
FROM o""")
def recode_codes(spark, sf):
    """Code tables applied to order status/priority."""
    o = Tables(spark, sf).orders
    status = F.col("o_orderstatus")
    age_group = rc.age_group_from_text("o_orderpriority", _AGE_FRAGMENTS)
    age_code = rc.recode(age_group, rc.AGE_GROUP_CODES)
    exit_date = F.when(status == "F", F.to_date("o_orderdate"))
    category = rc.recode("o_orderpriority", _EXIT_CATEGORY)
    return o.select(
        "o_orderkey",
        F.when(status.isNull(), F.lit(rc.GENDER_MISSING)).otherwise(rc.recode(status, {"F": 0, "O": 1}))
        .alias("status_code"),
        age_group.alias("age_group"), age_code.alias("age_code"),
        rc.recode(age_code, rc.AGE_GROUP_LABELS).alias("age_label"),
        rc.exit_reason(category, exit_date).alias("exit_reason"),
        rc.presence_flag(exit_date).alias("c4k"))


_SEGMENT_REGION = {"AUTOMOBILE": "e", "BUILDING": "nc", "FURNITURE": "nw", "HOUSEHOLD": "sc", "MACHINERY": "sw"}


@query("recode_segments", """
WITH c AS (
  SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'e' WHEN 'BUILDING' THEN 'nc' WHEN 'FURNITURE' THEN 'nw'
              WHEN 'HOUSEHOLD' THEN 'sc' WHEN 'MACHINERY' THEN 'sw' END AS region_short,
         CASE WHEN c_acctbal < 2000 THEN 'SA' WHEN c_acctbal >= 2000 THEN 'PS' END AS age_group,
         c_acctbal > 8000 AS f1,
         CASE WHEN c_acctbal > 0 THEN c_mktsegment = 'BUILDING' END AS f2,
         CASE WHEN c_acctbal > 1000 THEN c_nationkey < 5 END AS f3
  FROM customer)
SELECT c_custkey,
       CASE region_short WHEN 'e' THEN 0 WHEN 'nc' THEN 1 WHEN 'nw' THEN 2 WHEN 'sc' THEN 3 WHEN 'sw' THEN 4 END
         AS region_code,
       CASE WHEN CAST(c_acctbal > 5000 AS INTEGER) = 1 THEN 'Acc.'
            WHEN CAST(c_acctbal > 5000 AS INTEGER) <> 1 THEN 'Una' END AS accredited,
       CASE WHEN coalesce(c_nationkey IN (1, 2), false) THEN 0 WHEN age_group = 'SA' THEN 1
            WHEN age_group <> 'SA' THEN 0 END AS funding_time,
       CASE WHEN f1 OR f2 OR f3 THEN c_nationkey < 12 WHEN NOT (f1 OR f2 OR f3) THEN NULL END AS ethnicity,
       coalesce(f2, false) AS f2_filled, coalesce(f3, false) AS f3_filled
FROM c""")
def recode_segments(spark, sf):
    """Region codes, flag labels, funding time, conditional null-out, fill."""
    c = Tables(spark, sf).customer
    bal = F.col("c_acctbal")
    region_short = rc.recode("c_mktsegment", _SEGMENT_REGION)
    age_group = F.when(bal < 2000, "SA").when(bal >= 2000, "PS")
    f1 = bal > 8000
    f2 = F.when(bal > 0, F.col("c_mktsegment") == "BUILDING")
    f3 = F.when(bal > 1000, F.col("c_nationkey") < 5)
    out = c.select(
        "c_custkey",
        rc.recode(region_short, rc.REGION_CODES).alias("region_code"),
        rc.label_when((bal > 5000).cast("int"), *rc.ACCREDITED_LABELS).alias("accredited"),
        rc.funding_time("c_nationkey", age_group, [1, 2]).alias("funding_time"),
        rc.keep_if_any([f1, f2, f3], F.col("c_nationkey") < 12).alias("ethnicity"),
        f2.alias("f2_filled"), f3.alias("f3_filled"))
    return out.fillna(False, subset=["f2_filled", "f3_filled"])


@query("null_concat", """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN CAST(c_custkey AS VARCHAR) END || ' ' || n_name AS address_line1
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def null_concat(spark, sf):
    """street number + address line; NULL when either part is NULL."""
    t = Tables(spark, sf)
    cn = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    street = F.when(F.col("c_acctbal") > 0, F.col("c_custkey").cast("string"))
    return cn.select("c_custkey", rc.concat_or_null(street, F.lit(" "), F.col("n_name")).alias("address_line1"))


@query("coalesce_from", """
SELECT d.doc_id, coalesce(CASE WHEN d.n_chars < 200 THEN 0 END, l.quality) AS quality
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def coalesce_from(spark, sf):
    """Fill a missing attribute from a supplementary table."""
    t = Tables(spark, sf)
    d = t.documents.select("doc_id", F.when(F.col("n_chars") < 200, F.lit(0)).alias("quality"))
    return joins.coalesce_from(d, t.labels, "doc_id", ["quality"])


@query("tolerant_match", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_tax = l_discount AND abs(l_extendedprice - floor(l_extendedprice / 10) * 10) < 1
            THEN CAST(l_shipdate AS DATE) END AS determination_date
FROM lineitem""")
def tolerant_match(spark, sf):
    """a date only when the sizes match and the amounts are within 1."""
    li = Tables(spark, sf).lineitem
    rounded = F.floor(F.col("l_extendedprice") / 10) * 10
    return li.select("l_orderkey", "l_linenumber",
                     rc.tolerant_date("l_tax", "l_discount", "l_extendedprice", rounded, "l_shipdate")
                     .alias("determination_date"))


@query("digits_to_int", """
SELECT o_orderkey,
       TRY_CAST(regexp_replace(o_orderpriority, '[^0-9]', '', 'g') AS INTEGER) AS priority_num,
       TRY_CAST(regexp_replace(o_orderstatus, '[^0-9]', '', 'g') AS INTEGER) AS status_num
FROM orders""")
def digits_to_int(spark, sf):
    """digits-only text to integer; no digits -> NULL."""
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", rc.digits_to_int("o_orderpriority").alias("priority_num"),
                    rc.digits_to_int("o_orderstatus").alias("status_num"))
