"""The migration's steps (D1, D3-D9, S10, O4, E9), chained as the entry point chains them, over the test tables.

Rosters: an order is a child (customer) seen in the file of its nation and month, with a licence that may be
mistyped; programs: two sites a nation, in towns of the shipped table; the enrollment database: customers as students,
orders as enrollments, fundings, addresses, races and incomes, line items as additional funding sources. Every
step is the function of ``plans/reconcile.py`` that ``run_migration`` calls.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, stored
from ..sinks.target import ParquetStore, load_periods, to_target_periods
from ..sources.lookups import TOWNS_BY_REGION, towns
from . import reconcile
from .catalog import CAL_SQL, Tables, calendar, period_id, query, sql_period

# --- fixed parameters of the binding -------------------------------------------------
TOWNS = sorted((town, region) for region, names in TOWNS_BY_REGION.items() for town in set(names))
TITLE_I = ["site 3-1"]
FULL_TIME = ["F0-0", "F5-1"]
FIRST_START = dt.date(1995, 3, 6)
LOAD_TIME = dt.datetime(2024, 5, 6, 7, 8, 9)
AGES = ["IT", "PS", "Preschool F/T", "SA"]
SPACES = ["Infant/Toddler Full Time", "Preschool Full Time", "School Age Part Time", "Other"]
EXITS = ["Aged Out", "Parent Withdrew Child", "Somewhere else"]
# ------------------------------------------------------------------------------------


def _pick(number, values: list[str]):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def _pick_sql(number: str, values: list[str]) -> str:
    return f"list_extract([{', '.join(repr(v) for v in values)}], CAST({number} % {len(values)} AS INTEGER) + 1)"


def programs(t: Tables):
    n, k = F.col("n_nationkey"), F.col("k")
    none = F.lit(None).cast("string")
    both = t.nation.select("n_nationkey", "n_name", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    # every 7th program is in no known town
    town = F.when((n * 2 + k) % 7 != 6, _pick(n * 6 + k * 3, [town for town, _ in TOWNS])).otherwise(F.lit("Nowhere"))
    return both.select((F.lit(1000) + n * 40 + k * 17).cast("string").alias("code"), F.concat_ws("-", F.concat(F.lit("site "), n), k).alias("name"),
                       F.col("n_name").alias("org_name"), town.alias("town"), none.alias("address"), none.alias("zip"), none.alias("naeyc_id"),
                       none.alias("registry_id"), F.concat_ws("-", F.concat(F.lit("F"), n), k).alias("facility_code")).withColumn(
        "license_no", F.concat(F.lit("D"), "code")).drop("code")


def rosters(t: Tables):
    """(roster, header) in the schemas of the workbook reader."""
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    key, child, n = F.col("o_orderkey"), F.col("c_custkey"), F.col("c_nationkey")
    day = F.to_date("o_orderdate")
    license_no = F.concat(F.lit("D"), (F.lit(1000) + n * 40 + child % 2 * 17).cast("string"))
    o = o.withColumn("id", period_id("o_orderdate", t))
    roster = o.select(
        F.concat_ws("-", F.concat(F.lit("N"), n), "id").alias("source"), key.alias("row_no"),
        F.when(child % 6 != 0, F.concat(F.lit("S"), child)).alias("sasid"), F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"),
        F.when(key % 3 == 0, F.concat(F.lit("C"), child)).alias("c4k_case_no"), F.when(key % 3 == 0, F.lit("Y")).alias("c4k"),
        F.when(key % 11 == 0, F.lit(None)).when(child % 5 == 0, F.concat(license_no, F.lit("x"))).otherwise(license_no).alias("license_no"),
        _pick(key, AGES).alias("age_group"), F.col("o_totalprice").alias("reimbursement_rate"), F.date_sub(day, 30).alias("enrollment_date"),
        F.when(key % 4 == 0, F.date_add(day, 40)).alias("termination_date"), (child % 5 + 1).cast("double").alias("no_in_family"), F.col("c_acctbal").alias("annual_income"))
    label = calendar(t).select("id", F.regexp_replace("label", " - ", " to ").alias("psr_format"))
    header = o.select(F.concat_ws("-", F.concat(F.lit("N"), n), "id").alias("source"), "id").distinct().join(F.broadcast(label), "id").select("source", "psr_format")
    return roster, header


_PROGRAMS_SQL = f"""
towns(i, town, region) AS (VALUES {', '.join(f"({i}, '{town}', '{region}')" for i, (town, region) in enumerate(TOWNS))}),
prog AS (SELECT 'D' || (1000 + n_nationkey * 40 + k * 17) AS license, 'site ' || n_nationkey || '-' || k AS name, n_name AS org_name,
                CASE WHEN (n_nationkey * 2 + k) % 7 <> 6 THEN (SELECT town FROM towns WHERE i = (n_nationkey * 6 + k * 3) % {len(TOWNS)}) ELSE 'Nowhere' END AS town,
                'F' || n_nationkey || '-' || k AS facility_code FROM nation, (VALUES (0), (1)) AS ks(k)),
orgs AS (SELECT n_name AS org_name, row_number() OVER (ORDER BY n_name) AS organization_id FROM (SELECT DISTINCT n_name FROM nation)),
sites AS (SELECT row_number() OVER (ORDER BY organization_id, prog.name) AS site_id, prog.name, organization_id, facility_code, region, prog.name IN ('{TITLE_I[0]}') AS title_i
          FROM prog JOIN orgs USING (org_name) LEFT JOIN towns USING (town))"""

_ENR_SQL = f"""
WITH {CAL_SQL}, {_PROGRAMS_SQL},
roster AS (SELECT 'N' || c_nationkey || '-' || {sql_period('o_orderdate')} AS source, {sql_period('o_orderdate')} AS period, o_orderkey AS row_no,
                  CASE WHEN c_custkey % 6 <> 0 THEN 'S' || c_custkey END AS sasid, c_name AS first_name, c_mktsegment AS last_name,
                  CASE WHEN o_orderkey % 3 = 0 THEN 'C' || c_custkey END AS c4k_case_no, CASE WHEN o_orderkey % 3 = 0 THEN 'Y' END AS c4k,
                  CASE WHEN o_orderkey % 11 <> 0 THEN 'D' || (1000 + c_nationkey * 40 + c_custkey % 2 * 17) || CASE WHEN c_custkey % 5 = 0 THEN 'x' ELSE '' END END AS license_no,
                  {_pick_sql('o_orderkey', AGES)} AS age_group, CAST(o_orderdate AS DATE) - 30 AS enrollment_date,
                  CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderdate AS DATE) + 40 END AS termination_date,
                  CAST(c_custkey % 5 + 1 AS DOUBLE) AS no_in_family, c_acctbal AS annual_income
           FROM orders JOIN customer ON o_custkey = c_custkey),
codes AS (SELECT DISTINCT license_no FROM roster WHERE license_no IS NOT NULL),
near AS (SELECT license_no, license, levenshtein(license_no, license) AS fuzzy FROM codes JOIN prog ON levenshtein(license_no, license) <= 1),
enr AS (SELECT roster.*, fuzzy, license AS program_license_no, name, org_name, facility_code FROM roster JOIN near USING (license_no) JOIN prog USING (license)
        QUALIFY row_number() OVER (PARTITION BY source, sasid, first_name, last_name ORDER BY fuzzy, license, name, facility_code, org_name, row_no) = 1)"""


def _roster_matches(t: Tables):
    roster, header = rosters(t)
    return t.once("enr", lambda: stored(reconcile.psr_enrollment(roster, header, programs(t), calendar(t))))


@query("roster_match", _ENR_SQL + """
SELECT source, sasid, first_name, row_no, period, license_no, program_license_no, CAST(fuzzy AS INTEGER) AS fuzzy, name, org_name, facility_code FROM enr""")
def roster_match(spark, sf):
    """Each roster row with its best program and its period."""
    return _roster_matches(Tables(spark, sf)).select("source", "sasid", "first_name", "row_no", "period", "license_no", "program_license_no",
                                                     "fuzzy", "name", "org_name", "facility_code")


def _sites(t: Tables):
    """The organizations and sites of all nations, with the shipped town table."""
    revenue = t.nation.select(F.col("n_name").alias("organization"))
    return t.once("sites", lambda: tuple(map(stored, reconcile.organizations_and_sites(revenue, programs(t), towns(t.spark), TITLE_I))))


@query("sites_by_town", f"""WITH {_PROGRAMS_SQL} SELECT site_id, name, organization_id, facility_code, region, title_i FROM sites""")
def sites_by_town(spark, sf):
    """Sites with the region of their town, by the shipped table."""
    return _sites(Tables(spark, sf))[1].select("site_id", "name", "organization_id", "facility_code", "region", "title_i")


# ---------------------------------------------------------------- the enrollment database

def database(t: Tables) -> dict:
    o, key, child = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")), F.col("o_orderkey"), F.col("o_custkey")
    student, day = F.col("c_custkey"), F.to_date("o_orderdate")
    return {
        "Student": t.customer.where("c_custkey % 7 <> 0").select(student.alias("Id"), F.concat(F.lit("S"), student).alias("SASID"),
                                                                  F.concat(F.lit("F"), F.col("c_nationkey"), F.lit("-0")).alias("RegisteringSiteId")),
        "StudentDetails": t.customer.select(student.alias("StudentId"), F.col("c_name").alias("FirstName"), F.lit(None).cast("string").alias("MiddleName"),
                                            F.col("c_mktsegment").alias("LastName"), F.date_add(F.lit("2015-01-01").cast("date"), (student % 1000).cast("int")).alias("Dob"),
                                            F.when(student % 3 == 0, "M ").when(student % 3 == 1, "F ").alias("Gender")),
        "Address": o.select(key.alias("Id"), child.alias("StudentId"), F.when(key % 4 == 0, "foster parent ").otherwise("Home").alias("AddressType"),
                            F.when(key % 5 != 0, (key % 100).cast("string")).alias("StreetNumber"), F.col("o_orderpriority").alias("Address1"),
                            F.lit(None).cast("string").alias("Address2"), F.col("o_orderstatus").alias("Town"), F.lit("CT").alias("State"),
                            (key % 90000).cast("string").alias("Zip"), F.col("o_orderpriority").alias("ModifiedBy")),
        "Race": o.select(child.alias("StudentId"), F.when(F.col("o_orderstatus") == "F", "White").when(F.col("o_orderstatus") == "O", "asian ").otherwise("Hispanic").alias("RaceCode")),
        "EditableFieldValues": t.customer.select(student.alias("StudentId"), F.explode(F.array(
            F.struct(F.lit(3).alias("f"), F.concat(F.lit("B"), student).alias("v")),
            F.struct(F.when(student % 2 == 0, 4).otherwise(9).alias("f"), F.lit("CT").alias("v")))).alias("e")).select(
                "StudentId", F.col("e.f").alias("EditableFieldId"), F.col("e.v").alias("Value")),
        "Enrollment": o.select(key.alias("Id"), child.alias("StudentId"), F.concat(F.lit("F"), F.col("c_nationkey"), F.lit("-"), F.when(child % 10 == 0, 2).otherwise(key % 3)).alias("FacilityCode"),
                               day.alias("EnrollmentDate"), F.when(key % 2 == 0, F.date_add(day, 20)).alias("FacilityExitDate"),
                               F.when(key % 2 == 0, _pick(key, EXITS)).alias("ExitCategory"), F.lit(None).cast("string").alias("ExitReason")),
        "EnrollmentFunding": o.select(key.alias("Id"), key.alias("EnrollmentId"), F.lit("CDC").alias("FundingType"), _pick(key, SPACES).alias("SpaceType"),
                                      F.trunc(day, "month").alias("StartDate"), F.lit(None).cast("date").alias("EndDate"), F.col("o_orderdate").alias("DateCreated"),
                                      F.when(key % 9 != 0, F.col("o_orderdate")).alias("ModifiedDate")),
        "AdditionalFundingSources": t.lineitem.select(F.col("l_orderkey").alias("EnrollmentId"), F.col("l_returnflag").alias("AdditionalFundingType")),
        "AdditionalStudentInfo": o.select(key.alias("ID"), child.alias("StudentId"), (child % 5 + 1).cast("int").alias("NumberOfPeopleInHousehold"),
                                          (F.col("c_acctbal") + key % 3 * 0.6).alias("AnnualFamilyIncome"), F.col("o_orderdate").alias("DateFamilyIncomeDocumented"),
                                          F.when(key % 5 == 0, "true").otherwise("FALSE").alias("FamilyIncomeNotDisclosed")),
    }


_FLAT_SQL = f"""
oc AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey),
addr AS (SELECT * FROM oc QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC NULLS LAST, o_orderkey DESC) = 1),
inc AS (SELECT * FROM oc QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1),
race AS (SELECT o_custkey, max(CAST(o_orderstatus = 'O' AS INTEGER)) AS asian, max(CAST(o_orderstatus = 'F' AS INTEGER)) AS white,
                max(CAST(o_orderstatus NOT IN ('F', 'O') AS INTEGER)) AS hispanic FROM oc GROUP BY 1),
stu AS (SELECT c.c_custkey AS student, 'S' || c.c_custkey AS sasid_db, 'F' || c.c_nationkey || '-0' AS registering, c.c_name AS first_db, c.c_mktsegment AS last_db,
               DATE '2015-01-01' + CAST(c.c_custkey % 1000 AS INTEGER) AS dob, CASE c.c_custkey % 3 WHEN 0 THEN 'M ' WHEN 1 THEN 'F ' END AS gender,
               coalesce(CAST(addr.o_orderkey % 4 = 0 AS INTEGER), 0) AS foster, CASE WHEN addr.o_orderkey % 5 <> 0 THEN CAST(addr.o_orderkey % 100 AS VARCHAR) END AS street,
               addr.o_orderpriority AS address1, addr.o_orderstatus AS town_db, CAST(addr.o_orderkey % 90000 AS VARCHAR) AS zip,
               coalesce(asian, 0) AS asian, coalesce(white, 0) AS white, coalesce(hispanic, 0) AS hispanic,
               CASE WHEN inc.o_orderkey IS NOT NULL THEN c.c_custkey % 5 + 1 END AS household, c.c_acctbal + inc.o_orderkey % 3 * 0.6 AS income_db, inc.o_orderdate AS documented,
               coalesce(CAST(inc.o_orderkey % 5 = 0 AS INTEGER), 0) AS not_disclosed, 'B' || c.c_custkey AS certificate, CASE WHEN c.c_custkey % 2 = 0 THEN 'CT' END AS birth_state
        FROM customer c LEFT JOIN addr ON addr.o_custkey = c.c_custkey LEFT JOIN inc ON inc.o_custkey = c.c_custkey LEFT JOIN race ON race.o_custkey = c.c_custkey
        WHERE c.c_custkey % 7 <> 0),
fund0 AS (SELECT o_orderkey AS enrollment, o_custkey AS student, 'F' || c_nationkey || '-' || CASE WHEN o_custkey % 10 = 0 THEN 2 ELSE o_orderkey % 3 END AS facility, CAST(o_orderdate AS DATE) AS enrolled,
                 CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) + 20 END AS exited,
                 CASE WHEN o_orderkey % 2 = 0 THEN {_pick_sql('o_orderkey', EXITS)} END AS category, {_pick_sql('o_orderkey', SPACES)} AS space,
                 CAST(date_trunc('month', o_orderdate) AS DATE) AS started, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate END AS modified FROM oc
          QUALIFY row_number() OVER (PARTITION BY started, space, o_custkey ORDER BY modified DESC NULLS LAST, o_orderkey DESC) = 1),
extra AS (SELECT l_orderkey, CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'Multiple Additional Funding Sources' ELSE min(l_returnflag) END AS additional FROM lineitem GROUP BY 1),
flat AS (SELECT fund0.*, additional, stu.* EXCLUDE (student) FROM fund0 LEFT JOIN extra ON l_orderkey = enrollment LEFT JOIN stu USING (student)
         WHERE facility IN (SELECT facility_code FROM sites))"""


def _flat(t: Tables):
    return t.once("flat", lambda: stored(reconcile.enrollment_flat(database(t), _sites(t)[1])))


@query("enrollment_flat", f"""WITH {_PROGRAMS_SQL}, {_FLAT_SQL}
SELECT enrollment AS enrollment_id, student AS student_id, sasid_db AS sasid, facility, enrolled, exited, category, space, started, modified, additional, gender,
       foster, street, address1, zip, asian, white, hispanic, CAST(household AS INTEGER) AS household, round(income_db, 2) AS income, documented, not_disclosed, certificate, birth_state FROM flat""")
def enrollment_flat(spark, sf):
    """Students with deduplicated fundings at the sites, and their attributes."""
    return _flat(Tables(spark, sf)).select(
        F.col("EnrollmentId").alias("enrollment_id"), F.col("StudentId").alias("student_id"), F.col("SASID").alias("sasid"), F.col("FacilityCode").alias("facility"),
        F.col("EnrollmentDate").alias("enrolled"), F.col("FacilityExitDate").alias("exited"), F.col("ExitCategory").alias("category"), F.col("SpaceType").alias("space"),
        F.col("FundingStartDate").alias("started"), F.col("ModifiedDate").alias("modified"), F.col("AdditionalFundingSource").alias("additional"), F.col("Gender").alias("gender"),
        F.col("Foster").alias("foster"), F.col("StreetNumber").alias("street"), F.col("Address1").alias("address1"), F.col("Zip").alias("zip"),
        F.col("Asian").alias("asian"), F.col("White").alias("white"), F.col("HispanicOrLatinxEthnicity").alias("hispanic"),
        F.col("NumberOfPeopleInHousehold").alias("household"), F.round("AnnualFamilyIncome", 2).alias("income"), F.col("DateFamilyIncomeDocumented").alias("documented"),
        F.col("FamilyIncomeNotDisclosed").alias("not_disclosed"), F.col("BirthCertificateId").alias("certificate"), F.col("StateOfBirth").alias("birth_state"))


_STUDENTS_SQL = f"""
with_ids AS (SELECT * FROM enr WHERE sasid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sasid ORDER BY period DESC NULLS FIRST, source DESC, row_no DESC) = 1),
without AS (SELECT * FROM enr WHERE sasid IS NULL QUALIFY row_number() OVER (PARTITION BY first_name, last_name ORDER BY period DESC NULLS FIRST, source DESC, row_no DESC) = 1),
psr AS (SELECT coalesce(sasid, 'TEMP-' || first_name || '-' || last_name) AS sasid, first_name, last_name, organization_id, no_in_family, annual_income
        FROM (SELECT * FROM with_ids UNION ALL SELECT * FROM without) LEFT JOIN orgs USING (org_name)
        WHERE termination_date IS NULL OR termination_date >= DATE '{FIRST_START}'),
enrolled AS (SELECT * FROM flat QUALIFY row_number() OVER (PARTITION BY sasid_db ORDER BY modified DESC NULLS FIRST, enrollment DESC) = 1),
registered AS (SELECT * FROM stu WHERE sasid_db IN (SELECT sasid FROM psr) AND sasid_db NOT IN (SELECT sasid_db FROM flat WHERE sasid_db IS NOT NULL)),
dbs AS (SELECT sasid_db, facility, first_db, last_db, dob, gender, foster, street, address1, town_db, zip, asian, white, hispanic, household, income_db, documented, not_disclosed, certificate, birth_state FROM enrolled
        UNION ALL SELECT sasid_db, registering, first_db, last_db, dob, gender, foster, street, address1, town_db, zip, asian, white, hispanic, household, income_db, documented, not_disclosed, certificate, birth_state FROM registered),
students AS (SELECT psr.*, dbs.*, row_number() OVER (ORDER BY sasid NULLS FIRST, psr.first_name NULLS FIRST, psr.last_name NULLS FIRST) AS student_id FROM psr LEFT JOIN dbs ON sasid = sasid_db)"""


def _students(t: Tables):
    def build():
        psr, _ = reconcile.psr_students(_roster_matches(t), _sites(t)[0], FIRST_START)
        flat = _flat(t)
        registered = reconcile.registered_flat(database(t), reconcile.missing_from_database(psr, flat))
        return stored(reconcile.students_joined(psr, reconcile.database_students(flat, registered)))
    return t.once("students", build)


@query("registered_students", f"""{_ENR_SQL}, {_FLAT_SQL}, {_STUDENTS_SQL}
SELECT sasid_db AS sasid, registering AS facility, gender, foster, asian, certificate FROM registered""")
def registered_students(spark, sf):
    """Attributes of students on a roster without an enrollment in the database."""
    t = Tables(spark, sf)
    psr, _ = reconcile.psr_students(_roster_matches(t), _sites(t)[0], FIRST_START)
    out = reconcile.registered_flat(database(t), reconcile.missing_from_database(psr, _flat(t)))
    return out.select(F.col("SASID").alias("sasid"), F.col("FacilityCode").alias("facility"), F.col("Gender").alias("gender"), F.col("Foster").alias("foster"),
                      F.col("Asian").alias("asian"), F.col("BirthCertificateId").alias("certificate"))


@query("students", f"""{_ENR_SQL}, {_FLAT_SQL}, {_STUDENTS_SQL}
SELECT student_id, sasid, first_name, last_name, organization_id, no_in_family, facility, gender, documented FROM students""")
def students(spark, sf):
    """Roster people with their attributes of the database, numbered."""
    return _students(Tables(spark, sf)).select("student_id", "sasid", "first_name", "last_name", "organization_id", "no_in_family", F.col("FacilityCode").alias("facility"),
                                               F.col("Gender").alias("gender"), F.col("DateFamilyIncomeDocumented").alias("documented"))


_CHILDREN_SQL = """
kids AS (SELECT student_id AS child_id, sasid, first_name, dob AS birthdate, certificate, coalesce(asian = 1, false) AS asian, coalesce(white = 1, false) AS white,
                CASE WHEN asian = 1 OR white = 1 THEN hispanic = 1 END AS hispanic,
                CASE WHEN gender IS NULL THEN 4 WHEN gender = 'M ' THEN 0 WHEN gender = 'F ' THEN 1 END AS gender, coalesce(foster = 1, false) AS foster, organization_id FROM students)"""


@query("children", f"""{_ENR_SQL}, {_FLAT_SQL}, {_STUDENTS_SQL}, {_CHILDREN_SQL}
SELECT child_id, sasid, first_name, coalesce(birthdate, CASE WHEN sasid LIKE 'S%' AND CAST(substr(sasid, 2) AS BIGINT) % 2 = 0 THEN DATE '2014-05-05' END) AS birthdate,
       certificate, asian, white, hispanic, CAST(gender AS INTEGER) AS gender, foster, organization_id FROM kids""")
def children(spark, sf):
    """Children with codes, flags and supplementary birth dates."""
    t = Tables(spark, sf)
    dates = t.customer.where("c_custkey % 2 = 0").select(F.concat(F.lit("S"), "c_custkey").alias("SASID"), F.lit("2014-05-05").cast("date").alias("Birthdate"))
    kids = reconcile.children(_students(t), dates)
    return kids.select("child_id", F.col("Sasid").alias("sasid"), F.col("FirstName").alias("first_name"), F.col("Birthdate").alias("birthdate"), F.col("BirthCertificateId").alias("certificate"),
                       F.col("Asian").alias("asian"), F.col("White").alias("white"), F.col("HispanicOrLatinxEthnicity").alias("hispanic"), F.col("Gender").alias("gender"),
                       F.col("Foster").alias("foster"), "organization_id")


@query("families_and_incomes", f"""{_ENR_SQL}, {_FLAT_SQL}, {_STUDENTS_SQL}
SELECT student_id AS family_id, sasid AS person, street || ' ' || address1 AS address, zip, organization_id, no_in_family AS people, annual_income AS income,
       CASE WHEN no_in_family = household AND abs(annual_income - income_db) < 1 THEN CAST(documented AS DATE) END AS determined FROM students""")
def families_and_incomes(spark, sf):
    """One family and one determination per child."""
    s = _students(Tables(spark, sf))
    fam, det = reconcile.families(s), reconcile.family_determinations(s)
    return fam.join(det, "family_id").select("family_id", F.col("nk_person").alias("person"), F.col("AddressLine1").alias("address"), F.col("Zip").alias("zip"), "organization_id",
                                             F.col("NumberOfPeople").alias("people"), F.col("Income").alias("income"), F.col("DeterminationDate").alias("determined"))


_UNIQUE_SQL = f"""
e AS (SELECT * REPLACE (coalesce(sasid, 'TEMP-' || first_name || '-' || last_name) AS sasid) FROM enr),
c4k AS (SELECT sasid, max(period) AS last_c4k FROM e WHERE c4k = 'Y' GROUP BY 1),
u0 AS (SELECT * REPLACE (CASE WHEN age_group = 'Preschool F/T' THEN 'PS' ELSE age_group END AS age_group) FROM e
       WHERE termination_date IS NULL OR termination_date >= DATE '{FIRST_START}'),
u1 AS (SELECT *, min(period) OVER g AS first_psr, max(period) OVER g AS last_psr FROM u0 WINDOW g AS (PARTITION BY sasid, age_group, facility_code)),
u2 AS (SELECT * FROM u1 QUALIFY row_number() OVER (PARTITION BY sasid, age_group, facility_code ORDER BY period DESC NULLS FIRST, source DESC, row_no DESC) = 1),
dbk AS (SELECT sasid_db AS sasid, CASE WHEN space LIKE '%Infant/Toddler%' THEN 'IT' WHEN space LIKE '%Preschool%' THEN 'PS' WHEN space LIKE '%School Age%' THEN 'SA' END AS age_group,
               facility AS facility_code, enrolled, exited, category, started FROM flat),
u3 AS (SELECT u2.*, last_c4k, child_id, site_id, enrolled, exited, category, started
       FROM u2 LEFT JOIN c4k USING (sasid) LEFT JOIN kids USING (sasid) LEFT JOIN sites ON sites.facility_code = u2.facility_code
       LEFT JOIN dbk ON dbk.sasid = u2.sasid AND dbk.age_group IS NOT DISTINCT FROM u2.age_group AND dbk.facility_code IS NOT DISTINCT FROM u2.facility_code),
u4 AS (SELECT * FROM u3 WINDOW g AS (PARTITION BY sasid, age_group, facility_code)
       QUALIFY count(*) OVER g = 1 OR count(*) FILTER (WHERE exited IS NULL) OVER g <> 1 OR exited IS NULL),
u5 AS (SELECT *, row_number() OVER (ORDER BY sasid NULLS FIRST, age_group NULLS FIRST, facility_code NULLS FIRST, enrolled NULLS FIRST, exited NULLS FIRST, started NULLS FIRST, category NULLS FIRST) AS enrollment_id,
              min(age_group) OVER k <> max(age_group) OVER k AS moved, max(age_group) OVER k AS top FROM u4 WINDOW k AS (PARTITION BY sasid)),
uniq AS (SELECT u5.* REPLACE (CASE WHEN moved AND age_group = top THEN f.period_start ELSE enrollment_date END AS enrollment_date,
                              CASE WHEN moved AND age_group <> top THEN l.period_end ELSE termination_date END AS termination_date,
                              CASE WHEN moved AND age_group <> top THEN 'Aged Out' ELSE category END AS category)
         FROM u5 JOIN calendar f ON f.id = first_psr JOIN calendar l ON l.id = last_psr)"""


def _enrollments(t: Tables):
    return reconcile.enrollments(_roster_matches(t), _flat(t), reconcile.children(_students(t)), _sites(t)[1], calendar(t), FIRST_START)


@query("enrollments", f"""{_ENR_SQL}, {_FLAT_SQL}, {_STUDENTS_SQL}, {_CHILDREN_SQL}, {_UNIQUE_SQL}
SELECT enrollment_id, child_id, site_id, facility_code, CAST(CASE age_group WHEN 'IT' THEN 0 WHEN 'PS' THEN 1 WHEN 'SA' THEN 2 END AS INTEGER) AS age_group,
       coalesce(enrollment_date, enrolled) AS entry, coalesce(termination_date, exited) AS exit_date,
       CASE WHEN category IN ('Other', 'Parent Withdrew Child') THEN 'Other' WHEN category = 'Aged Out' THEN 'Aged out'
            WHEN coalesce(termination_date, exited) IS NOT NULL THEN 'Unknown' END AS exit_reason FROM uniq""")
def enrollments(spark, sf):
    """Unique enrollments per person, age group and facility."""
    out, _, _ = _enrollments(Tables(spark, sf))
    return out.select("enrollment_id", "child_id", "site_id", "facility_code", F.col("AgeGroup").alias("age_group"), F.col("Entry").alias("entry"),
                      F.col("Exit").alias("exit_date"), F.col("ExitReason").alias("exit_reason"))


@query("enrollment_fundings", f"""{_ENR_SQL}, {_FLAT_SQL}, {_STUDENTS_SQL}, {_CHILDREN_SQL}, {_UNIQUE_SQL},
both_ AS (SELECT enrollment_id, 0 AS source, CAST(NULL AS DOUBLE) AS family, CAST(NULL AS DATE) AS certificate_end, first_psr AS first_period,
                CASE WHEN last_psr < (SELECT max(period) FROM enr) OR termination_date IS NOT NULL OR exited IS NOT NULL THEN last_psr END AS last_period,
                CASE WHEN facility_code IN ('{FULL_TIME[0]}', '{FULL_TIME[1]}') THEN 0 WHEN age_group = 'SA' THEN 1 WHEN age_group <> 'SA' THEN 0 END AS time_code FROM uniq
         UNION ALL
         SELECT enrollment_id, 1, CAST(TRY_CAST(regexp_replace(c4k_case_no, '[^0-9]', '', 'g') AS INTEGER) AS DOUBLE),
                CASE WHEN last_c4k < (SELECT max(period) FROM enr) THEN period_end END, NULL, NULL, NULL FROM uniq JOIN calendar ON calendar.id = last_c4k)
SELECT CAST(row_number() OVER (ORDER BY source, enrollment_id) AS BIGINT) AS funding_id, enrollment_id, CAST(source AS INTEGER) AS source, family, certificate_end,
       CAST(first_period AS INTEGER) AS first_period, CAST(last_period AS INTEGER) AS last_period, CAST(time_code AS INTEGER) AS time_code FROM both_""")
def enrollment_fundings(spark, sf):
    """State and subsidy fundings of the enrollments."""
    t = Tables(spark, sf)
    _, uniq, _ = _enrollments(t)
    out = reconcile.fundings(uniq, _roster_matches(t), calendar(t), FULL_TIME)
    return out.select("funding_id", "enrollment_id", F.col("FundingSource").alias("source"), F.col("FamilyId").alias("family"), F.col("CertificateEndDate").alias("certificate_end"),
                      F.col("FirstReportingPeriodId").alias("first_period"), F.col("LastReportingPeriodId").alias("last_period"), F.col("FundingTime").alias("time_code"))


@query("past_reports", f"""
WITH p AS (SELECT {sql_period('o_orderdate')} AS period, c_nationkey AS org, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS fees
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
r AS (SELECT period, org, TIMESTAMP '{LOAD_TIME}' AS submitted, fees FROM p
      UNION ALL SELECT (SELECT max(period) + 1 FROM p), org, NULL, NULL FROM (SELECT DISTINCT org FROM p))
SELECT CAST(row_number() OVER (ORDER BY period, org) AS BIGINT) AS report_id, CAST(period AS INTEGER) AS period, org AS organization_id,
       strftime(submitted, '%Y-%m-%dT%H:%M:%S') AS submitted, fees FROM r""")
def past_reports(spark, sf):
    """The open report of each organization and its past ones, stamped with the time of the load."""
    t = Tables(spark, sf)
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumn("period", period_id("o_orderdate", t))
    revenue = o.groupBy(F.col("c_nationkey").cast("string").alias("organization"), "period").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("family_fees"), F.lit(0.0).alias("c4k_revenue"))
    orgs = o.select(F.col("c_nationkey").alias("organization_id"), F.col("c_nationkey").cast("string").alias("name")).distinct()
    out = reconcile.current_reports(orgs, o.select("period"), revenue, include_past=True, submitted_at=LOAD_TIME)
    return out.select("report_id", F.col("ReportingPeriodId").alias("period"), "organization_id", F.date_format("SubmittedAt", "yyyy-MM-dd'T'HH:mm:ss").alias("submitted"),
                      F.col("FamilyFeesRevenue").alias("fees"))


@query("period_codes", f"""
WITH {CAL_SQL}, loaded AS (SELECT *, row_number() OVER (ORDER BY period) AS target FROM calendar WHERE id % 5 <> 4)
SELECT o_orderkey, CAST(target AS BIGINT) AS period_id, CAST(0 AS INTEGER) AS source_code, strftime(due_at, '%Y-%m-%d') AS due
FROM orders JOIN loaded ON id = {sql_period('o_orderdate')}""")
def period_codes(spark, sf):
    """Rows of loaded periods with the target's period id, the coded source and the due date as text."""
    t = Tables(spark, sf)
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/periods-{uuid.uuid4().hex}"
    load_periods(calendar(t).where("id % 5 <> 4"), out)
    rows = to_target_periods(t.orders.select("o_orderkey", period_id("o_orderdate", t).alias("period_id")), ["period_id"], calendar(t), out, required=["period_id"])
    loaded = ParquetStore(out).read(spark, "ReportingPeriod").select(F.col("Id").alias("period_id"), F.col("Type").alias("source_code"), F.date_format("DueAt", "yyyy-MM-dd").alias("due"))
    return rows.join(F.broadcast(loaded), "period_id").select("o_orderkey", "period_id", "source_code", "due")


