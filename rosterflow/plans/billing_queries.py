"""D11 billing-report sections bound to the test tables.

Target model built from the data (SURVEY §7 "customers per nation as report"):
organization = nation; reporting period = the data calendar; report = every
(supplier nation, shipment month) with its D2 revenue; child = order (last name
= customer name, family = customer); enrollment and funding = the order spell
(see ``entity_queries.order_spells``) at the customer nation's site; funding
space = (nation, age, time) with the number of such orders as capacity;
determination = an order of the family (newest wins); certificate = a returned
line item ``[ship date, ship date + 30]``, open while the line is open.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import recode as rc
from ..operators.periods import period_for_month
from ..sources.lookups import INCOME_LIMITS
from .billing import billing_report
from .catalog import CAL_SQL, Tables, calendar, first_month, period_id, query, sql_period
from .entity_queries import OPEN_EVERY, SPELL_MAX_DAYS, order_spells, rates_values_sql
from .roster_queries import _revenue

# --- fixed parameters of the binding -------------------------------------------------
FAMILY_SIZE_SPREAD = 13      # NumberOfPeople = 1 + orderkey % 13 (13 has no income limit)
INCOME_DIVISOR = 5           # Income = order total / 5
CERT_DAYS = 30               # certificate length
TITLE_I_BELOW = 5            # sites of nations 0..4 are Title I
REPORT_KEY_BASE = 100000     # report Id = organization * 100000 + period id
# ------------------------------------------------------------------------------------


def _age_code(prio):
    return ((rc.digits_to_int(prio) - 1) % 3)


def target_model(spark, sf) -> dict:
    """The report generator's input tables, derived from the test tables."""
    t = Tables(spark, sf)
    first = first_month(t)
    cal = calendar(t)
    rev = _revenue(t).withColumn("period_id", period_id("period", t))
    # report key: a deterministic function of (organization, period) — unique, no numbering pass needed
    report = rev.select(
        (F.col("organization").cast("bigint") * REPORT_KEY_BASE + F.col("period_id")).alias("Id"),
        F.lit(0).alias("Type"), F.lit(None).cast("timestamp_ntz").alias("SubmittedAt"),
        F.col("organization").alias("OrganizationId"), F.col("period_id").alias("ReportingPeriodId"),
        (F.col("organization") % 2 == 0).cast("int").alias("Accredited"),
        F.col("c4k_revenue").alias("C4KRevenue"), F.col("family_fees").alias("FamilyFeesRevenue"))
    organization = t.nation.select(F.col("n_nationkey").alias("Id"), F.col("n_name").alias("Name"))
    reporting_period = cal.select(F.col("id").alias("Id"), F.col("period").alias("Period"),
                                  F.col("period_start").alias("PeriodStart"), F.col("period_end").alias("PeriodEnd"))
    spells = order_spells(t, ["o_orderpriority", "o_orderstatus"])
    time_code = (F.col("o_orderstatus") == "P").cast("int")
    age = _age_code("o_orderpriority")
    space_id = F.col("organization") * 10 + age * 2 + time_code
    enrollment = spells.select(F.col("o_orderkey").alias("Id"), F.col("o_orderkey").alias("ChildId"),
                               F.col("organization").alias("SiteId"), age.alias("AgeGroup"),
                               F.col("spell_start").alias("Entry"), F.col("spell_end").alias("Exit"))
    funding = spells.select(F.col("o_orderkey").alias("Id"), F.lit(0).alias("Source"),
                            F.col("o_orderkey").alias("EnrollmentId"), space_id.alias("FundingSpaceId"),
                            period_for_month(F.col("spell_start"), first).alias("FirstReportingPeriodId"),
                            period_for_month(F.col("spell_end"), first).alias("LastReportingPeriodId"))
    funding_space = (spells.groupBy(F.col("organization").alias("OrganizationId"), age.alias("AgeGroup"),
                                    time_code.alias("Time"))
                     .agg(F.count(F.lit(1)).alias("Capacity"))
                     .select((F.col("OrganizationId") * 10 + F.col("AgeGroup") * 2 + F.col("Time")).alias("Id"),
                             "OrganizationId", F.lit(0).alias("Source"), "Time", "AgeGroup", "Capacity"))
    site = t.nation.select(F.col("n_nationkey").alias("Id"), F.col("n_nationkey").alias("OrganizationId"),
                           F.col("n_name").alias("LicenseNumber"), F.col("n_regionkey").alias("Region"),
                           (F.col("n_nationkey") < TITLE_I_BELOW).cast("int").alias("TitleI"))
    child = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("Id"), F.col("o_orderkey").cast("string").alias("Sasid"),
        F.col("o_orderpriority").alias("FirstName"), F.col("c_name").alias("LastName"),
        (F.col("c_mktsegment") == "HOUSEHOLD").cast("int").alias("Foster"), F.col("o_custkey").alias("FamilyId"),
        rc.digits_to_int("c_name").alias("C4KFamilyCaseNumber"))
    family_determination = t.orders.select(
        F.col("o_orderkey").alias("Id"), F.col("o_custkey").alias("FamilyId"),
        (F.col("o_orderkey") % FAMILY_SIZE_SPREAD + 1).cast("int").alias("NumberOfPeople"),
        F.round(F.col("o_totalprice") / INCOME_DIVISOR, 2).alias("Income"),
        F.col("o_orderdate").alias("DeterminationDate"))
    c4k_certificate = t.lineitem.where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("ChildId"), F.to_date("l_shipdate").alias("StartDate"),
        F.when(F.col("l_linestatus") != "O", F.date_add(F.to_date("l_shipdate"), CERT_DAYS)).alias("EndDate"))
    return {"report": report, "organization": organization, "reporting_period": reporting_period,
            "funding": funding, "funding_space": funding_space, "enrollment": enrollment, "site": site,
            "child": child, "family_determination": family_determination, "c4k_certificate": c4k_certificate}


_LIMITS_SQL = ("(VALUES " + ", ".join(f"({n}, {a}, {b})" for n, a, b in INCOME_LIMITS)
               + ") AS lim(NumberOfPeople, x75SMI, x200FPL)")

_BASE_SQL = f"""
WITH {CAL_SQL},
rev AS (
  SELECT s_nationkey AS organization, {sql_period('l_shipdate')} AS period_id,
         CAST(round(coalesce(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0), 2)
              AS DOUBLE) AS family_fees,
         CAST(round(coalesce(sum(CASE WHEN s_nationkey <> 0
                                      THEN CAST(l_extendedprice * l_discount AS DECIMAL(18,4)) END), 0), 2)
              AS DOUBLE) AS c4k_revenue
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
rep AS (
  SELECT CAST(organization AS BIGINT) * {REPORT_KEY_BASE} + period_id AS report_id, 0 AS report_type,
         CAST(NULL AS TIMESTAMP) AS submitted_at, organization AS organization_id, period_id,
         CAST(organization % 2 = 0 AS INTEGER) AS accredited, c4k_revenue, family_fees, n.n_name AS name,
         c.period, c.period_start, c.period_end
  FROM rev JOIN nation n ON n.n_nationkey = rev.organization JOIN calendar c ON c.id = rev.period_id),
sp AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, c_nationkey AS organization_id, c_name,
         c_mktsegment, CAST(o_orderdate AS DATE) AS spell_start,
         CASE WHEN o_orderkey % {OPEN_EVERY} <> 0
              THEN CAST(o_orderdate AS DATE) + CAST(o_custkey % {SPELL_MAX_DAYS} AS INTEGER) END AS spell_end,
         (TRY_CAST(regexp_replace(o_orderpriority, '[^0-9]', '', 'g') AS INTEGER) - 1) % 3 AS age_code,
         CAST(o_orderstatus = 'P' AS INTEGER) AS time_code
  FROM orders JOIN customer ON o_custkey = c_custkey),
fund AS (
  SELECT sp.*, {sql_period('spell_start')} AS first_period,
         CASE WHEN spell_end IS NOT NULL THEN {sql_period('spell_end')} END AS last_period FROM sp),
det AS (
  SELECT FamilyId, NumberOfPeople, Income FROM (
    SELECT o_custkey AS FamilyId, CAST(o_orderkey % {FAMILY_SIZE_SPREAD} + 1 AS INTEGER) AS NumberOfPeople,
           round(o_totalprice / {INCOME_DIVISOR}, 2) AS Income,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1),
act0 AS (
  SELECT rep.report_id, rep.organization_id, rep.accredited AS Accredited, f.o_orderkey AS funding_id,
         f.o_orderkey AS child_id, CAST(f.o_orderkey AS VARCHAR) AS sasid, f.c_name AS last_name,
         f.o_orderpriority AS first_name, n.n_name AS license,
         CAST(n.n_nationkey < {TITLE_I_BELOW} AS INTEGER) AS TitleI,
         f.spell_start AS entry, f.spell_end AS exit_date,
         CASE f.age_code WHEN 0 THEN 'Infant/Toddler' WHEN 1 THEN 'Preschool' WHEN 2 THEN 'School-age' END AS AgeGroup,
         CASE f.time_code WHEN 0 THEN 'FT' WHEN 1 THEN 'PT' END AS Time,
         CASE n.n_regionkey WHEN 0 THEN 'East' WHEN 1 THEN 'NorthCentral' WHEN 2 THEN 'NorthWest'
              WHEN 3 THEN 'SouthCentral' WHEN 4 THEN 'SouthWest' END AS Region,
         CAST(f.c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS foster, d.NumberOfPeople AS npeople, d.Income AS income
  FROM fund f JOIN rep ON rep.organization_id = f.organization_id
   AND f.first_period <= rep.period_id AND (f.last_period IS NULL OR f.last_period >= rep.period_id)
  JOIN nation n ON n.n_nationkey = f.organization_id
  LEFT JOIN det d ON d.FamilyId = f.o_custkey),
act AS (
  SELECT a.* EXCLUDE (npeople, income, foster),
         CASE WHEN foster = 0 THEN npeople WHEN foster <> 0 THEN 1 END AS NumberOfPeople,
         CASE WHEN foster = 0 THEN income WHEN foster <> 0 THEN 0.0 END AS Income,
         r.Rate
  FROM act0 a LEFT JOIN {rates_values_sql().replace(') AS rates(', ') AS r(')}
    ON a.Accredited = r.Accredited AND a.TitleI = r.TitleI AND a.Region = r.Region AND a.AgeGroup = r.AgeGroup
   AND a.Time = r.Time),
certs AS (
  SELECT l_orderkey AS child_id, CAST(l_shipdate AS DATE) AS start_date,
         CASE WHEN l_linestatus <> 'O' THEN CAST(l_shipdate AS DATE) + {CERT_DAYS} END AS end_date
  FROM lineitem WHERE l_returnflag = 'R'),
fund_at_org AS (SELECT organization_id, o_orderkey AS child_id, count(*) AS n_fund FROM sp GROUP BY 1, 2),
subs AS (
  SELECT rep.report_id, c.child_id, count(*) * max(fo.n_fund) AS n_subsidy,
         max(TRY_CAST(regexp_replace(sp.c_name, '[^0-9]', '', 'g') AS INTEGER)) AS case_no
  FROM certs c JOIN fund_at_org fo ON fo.child_id = c.child_id
  JOIN rep ON rep.organization_id = fo.organization_id
   AND c.start_date <= rep.period_end AND (c.end_date IS NULL OR c.end_date >= rep.period_start)
  JOIN sp ON sp.o_orderkey = c.child_id
  GROUP BY rep.report_id, c.child_id)"""


def _section(spark, sf, name):
    return billing_report(target_model(spark, sf), sections=(name,))[name]


@query("billing_roster", _BASE_SQL + f""",
rows AS (
  SELECT a.*, s.n_subsidy, CASE WHEN s.n_subsidy > 0 THEN s.case_no END AS c4k_family_id, lim.x75SMI AS max_income,
         unnest(generate_series(1, greatest(coalesce(s.n_subsidy, 0), 1))) AS rep_no
  FROM act a LEFT JOIN subs s ON s.report_id = a.report_id AND s.child_id = a.child_id
  LEFT JOIN {_LIMITS_SQL} ON lim.NumberOfPeople = a.NumberOfPeople)
SELECT report_id,
       CAST(row_number() OVER (PARTITION BY report_id ORDER BY AgeGroup ASC NULLS LAST, last_name ASC NULLS LAST,
                               first_name ASC NULLS LAST, funding_id, rep_no) AS BIGINT) AS line_no,
       sasid, last_name, first_name, c4k_family_id, CASE WHEN c4k_family_id IS NULL THEN 'N' ELSE 'Y' END AS c4k,
       license AS center_license, coalesce(Time, 'NA') || ' ' || coalesce(AgeGroup, 'NA') AS service,
       Rate AS weekly_rate, strftime(entry, '%m/%d/%Y') AS enrollment_date,
       strftime(exit_date, '%m/%d/%Y') AS termination_date, NumberOfPeople AS n_in_family, Income AS annual_income,
       CASE WHEN Income <= max_income THEN 'Y' WHEN Income > max_income THEN 'N*' END AS eligible
FROM rows""")
def billing_roster(spark, sf):
    """D11 roster: active fundings per report, rate, eligibility, numbered per report (O1)."""
    return _section(spark, sf, "roster")


@query("income_groups", _BASE_SQL + f""",
under AS (
  SELECT a.report_id, a.NumberOfPeople AS family_size, count(*) AS n FROM act a
  JOIN {_LIMITS_SQL} ON lim.NumberOfPeople = a.NumberOfPeople WHERE a.Income <= lim.x200FPL GROUP BY 1, 2)
SELECT rep.report_id, lim.NumberOfPeople AS family_size, lim.x200FPL AS less_than_or_equal_to,
       coalesce(u.n, 0) AS n_families
FROM rep CROSS JOIN {_LIMITS_SQL}
LEFT JOIN under u ON u.report_id = rep.report_id AND u.family_size = lim.NumberOfPeople""")
def income_groups(spark, sf):
    """D11 family-income grouping: families at or under 200% FPL per size, zero-filled."""
    return _section(spark, sf, "income_groups")


@query("space_use", _BASE_SQL + f""",
cap AS (
  SELECT organization_id, CASE age_code WHEN 0 THEN 'Infant/Toddler' WHEN 1 THEN 'Preschool'
                                        WHEN 2 THEN 'School-age' END AS AgeGroup,
         CASE time_code WHEN 0 THEN 'FT' WHEN 1 THEN 'PT' END AS Time, count(*) AS capacity
  FROM sp GROUP BY 1, 2, 3),
used AS (
  SELECT report_id, organization_id, AgeGroup, Time, Accredited, TitleI, Rate, count(*) AS utilization
  FROM act GROUP BY ALL)
SELECT u.report_id, u.AgeGroup AS age_group, u.Time AS time,
       CASE WHEN Accredited = 1 THEN 'Acc.' WHEN Accredited <> 1 THEN 'Una' END AS accredited,
       CASE WHEN TitleI = 1 THEN 'Title I' WHEN TitleI <> 1 THEN 'Standard' END AS title_i,
       u.Rate AS rate, c.capacity, u.utilization
FROM used u JOIN cap c ON c.organization_id = u.organization_id AND c.AgeGroup IS NOT DISTINCT FROM u.AgeGroup
 AND c.Time IS NOT DISTINCT FROM u.Time""")
def space_use(spark, sf):
    """D11 spaces: used rows by (age, time, accredited, title, rate) against capacity."""
    return _section(spark, sf, "spaces")


@query("billing_header", _BASE_SQL + """
SELECT rep.report_id, name AS contractor,
       strftime(period_start, '%B %d, %Y') || ' - ' || strftime(period_end, '%B %d, %Y') AS reporting_period,
       (date_diff('day', period_start, period_end) + 1) / 7.0 AS number_of_weeks,
       family_fees, CAST(coalesce(s.n, 0) AS BIGINT) AS n_subsidies, c4k_revenue AS subsidies,
       strftime(submitted_at, '%m/%d/%Y') AS date,
       name || ' ' || strftime(period, '%B %Y') || ' CDC PSR' AS file_stem
FROM rep LEFT JOIN (SELECT report_id, sum(n_subsidy) AS n FROM subs GROUP BY 1) s ON s.report_id = rep.report_id""")
def billing_header(spark, sf):
    """D11 header: contractor, period text, weeks, fees, number of subsidies (A18), file stem (K7)."""
    return _section(spark, sf, "header")
