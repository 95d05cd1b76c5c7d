"""Reconcile rosters and the enrollment database into the target model.

Set-based over *all* roster files at once: the per-file loop becomes the
``source`` key of every grouping (fuzzy best match, one-organization gate,
revenue). Inputs use the source schemas of FIXTURES.md; every step returns a
DataFrame and the gates return violation frames (see ``quality.check``).

Documented deviations: surrogate ids follow a total order of natural keys (the
source numbers in first-appearance order); duplicate attribute rows (A4) keep
one value instead of fanning out; ``nan-nan`` school years are NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import recode as rc
from ..functions.nulls import glue_text, in_list, strict_max
from ..operators import dedupe, fuzzy, joins, keys, reshape
from ..operators.periods import lookup_label
from ..operators.quality import RowRule, check, late_key_violations, one_value_per_group, stored_and_checked, unique_key_violations
from ..session import stored
from ..sources.lookups import region_code_map

# --- fixed values of the migration ------------------------------------------------------
RACE_FLAGS = {
    "Hispanic": "HispanicOrLatinxEthnicity",
    "American Indian or Alaska Native": "AmericanIndianOrAlaskaNative",
    "Asian": "Asian",
    "Black or African American": "BlackOrAfricanAmerican",
    "Native Hawaiian or Other Pacific Islander": "NativeHawaiianOrPacificIslander",
    "White": "White",
    "Other": "OtherRace",
}
EDITABLE_FIELDS = {3: "BirthCertificateId", 4: "StateOfBirth", 5: "TownOfBirth"}
MULTIPLE_FUNDING_LABEL = "Multiple Additional Funding Sources"
FOSTER_ADDRESS_TYPE = "Foster Parent"
TITLE_I_NAMES = ["Richard Battles Day Care"]
PRESCHOOL_FULL_TIME = "Preschool F/T"
FIVE_RACES = ["AmericanIndianOrAlaskaNative", "Asian", "BlackOrAfricanAmerican", "NativeHawaiianOrPacificIslander",
              "White"]
# -----------------------------------------------------------------------------------------


def _ci_eq(col: str, text: str):
    """SQL Server default collation: case- and trailing-blank-insensitive equality."""
    return F.lower(F.rtrim(F.col(col))) == text.lower().rstrip()


# ---------------------------------------------------------------- D1, D2, D3, V1, V4

def psr_enrollment(roster: DataFrame, header: DataFrame, programs: DataFrame, calendar: DataFrame) -> DataFrame:
    """Period-tagged roster rows with their best program match.

    ``roster``: source + roster columns; ``header``: source, psr_format;
    ``programs``: read_programs output. The program's licence is ``program_license_no``.
    """
    period = lookup_label(header, "psr_format", calendar, out_col="period").select("source", "period")
    r = roster.where(F.col("license_no").isNotNull()).join(period, "source", "left")
    progs = programs.where(F.col("license_no").isNotNull() & F.col("org_name").isNotNull()).select(
        F.col("license_no").alias("program_license_no"), "name", "org_name", "address", "town", "zip",
        "naeyc_id", "registry_id", "facility_code")
    # the best program of a licence as written is the same in all its rows: matched once per licence, and stored, so that
    # Spark knows how small it is and does not gather the rows of a licence in one task to join them
    order = ["program_license_no", "name", "facility_code", "org_name", "naeyc_id", "registry_id", "address", "town", "zip"]
    pairs = fuzzy.fuzzy_join(roster.select("license_no").distinct(), progs, "license_no", "program_license_no", max_dist=1, dist_col="fuzzy")
    best = stored(fuzzy.best_match(pairs, ["license_no"], "fuzzy", order))
    matched = r.join(best, "license_no").select(*r.columns, *[c for c in best.columns if c != "license_no"])
    # few persons have two rows in a file, so a pick before the shuffle saves little and sorts the wide rows of whole
    # input tasks; a person's rows are of one file, so none is large
    person = ["source", "sasid", "first_name", "last_name"]
    return fuzzy.best_match(matched.repartition(*person), person, "fuzzy", [*order, "row_no"])


def one_org_per_file(enrollment: DataFrame) -> DataFrame:
    """V1: files whose roster resolves to more than one organization (stop)."""
    return one_value_per_group(enrollment, ["source"], "org_name")


def fuzzy_match_warnings(enrollment: DataFrame) -> DataFrame:
    """V4: one message per inexact licence match."""
    parts = ["Fuzzy matched a child from file '", F.col("source"), "' to ", F.col("org_name"),
             "; license number as written: ", F.col("license_no"), ", matched to: ", F.col("program_license_no")]
    return enrollment.where(F.col("fuzzy") > 0).select("source", glue_text(*parts).alias("message"))


def psr_revenue(totals: DataFrame, header: DataFrame, enrollment: DataFrame, calendar: DataFrame) -> DataFrame:
    """Fees and subsidy revenue per organization and period (missing sums = 0)."""
    period = lookup_label(header, "psr_format", calendar, out_col="period").select("source", "period")
    org = enrollment.select("source", F.col("org_name").alias("organization")).distinct()
    t = totals.join(org, "source", "left").join(period, "source", "left")
    return t.groupBy("organization", "period").agg(
        F.coalesce(F.sum("family_fees"), F.lit(0.0)).alias("family_fees"),
        F.coalesce(F.sum("c4k_revenue"), F.lit(0.0)).alias("c4k_revenue"))


def organizations_and_sites(revenue: DataFrame, programs: DataFrame, towns: DataFrame,
                            title_i_names: Sequence[str] = TITLE_I_NAMES) -> tuple[DataFrame, DataFrame]:
    """D3: organizations from the revenue rows, sites = programs of those organizations."""
    orgs = keys.assign_ids(revenue.select(F.col("organization").alias("name")).distinct(), ["name"],
                           id_col="organization_id")
    # dplyr joins match NA to NA (an organization row from a file without matches has no name)
    sites = (programs.join(orgs, programs["org_name"].eqNullSafe(orgs["name"]), "inner").drop(orgs["name"])
             .join(F.broadcast(towns), "town", "left")
             .select("name", "organization_id", "license_no", "naeyc_id", "registry_id", "facility_code", "region"))
    sites = keys.assign_ids(sites, ["organization_id", "name", "license_no", "facility_code", "naeyc_id",
                                    "registry_id", "region"], id_col="site_id")
    return orgs, sites.withColumn("title_i", in_list("name", title_i_names))


# ---------------------------------------------------------------- D4, D5

def _student_attributes(db: dict[str, DataFrame]) -> DataFrame:
    """Per student: race flags (A3), newest address (W2), newest income (W2), fields 3-5 (A4)."""
    students = db["Student"].select(F.col("Id").alias("StudentId"), "SASID", "RegisteringSiteId")
    details = db["StudentDetails"].select("StudentId", "FirstName", "MiddleName", "LastName", "Dob", "Gender")
    address = dedupe.latest_per_key(db["Address"], ["StudentId"], ["ModifiedBy"], ["Id"]).select(
        "StudentId", F.when(_ci_eq("AddressType", FOSTER_ADDRESS_TYPE), 1).otherwise(0).alias("Foster"),
        "StreetNumber", "Address1", "Address2", "Town", "State", "Zip")
    races = db["Race"].withColumn("RaceCode", F.lower(F.rtrim("RaceCode")))
    flags = reshape.flag_pivot(races, "StudentId", "RaceCode", {k.lower(): v for k, v in RACE_FLAGS.items()})
    income = dedupe.latest_per_key(db["AdditionalStudentInfo"], ["StudentId"], ["DateFamilyIncomeDocumented"],
                                   ["ID"]).select(
        "StudentId", "NumberOfPeopleInHousehold", "AnnualFamilyIncome", "DateFamilyIncomeDocumented",
        F.when(_ci_eq("FamilyIncomeNotDisclosed", "TRUE"), 1).otherwise(0).alias("FamilyIncomeNotDisclosed"))
    fields = reshape.eav_pivot(db["EditableFieldValues"], "StudentId", "EditableFieldId", "Value", EDITABLE_FIELDS)
    out = (students.join(details, "StudentId", "left").join(address, "StudentId", "left")
           .join(flags, "StudentId", "left").join(income, "StudentId", "left").join(fields, "StudentId", "left"))
    return out.fillna(0, subset=list(RACE_FLAGS.values()) + ["Foster", "FamilyIncomeNotDisclosed"])


def enrollment_flat(db: dict[str, DataFrame], sites: DataFrame) -> DataFrame:
    """One row per student x deduplicated funding, restricted to the sites' facilities."""
    ef = db["EnrollmentFunding"]
    se = db["Enrollment"].select(F.col("Id").alias("EnrollmentId"), "StudentId", "FacilityCode", "EnrollmentDate",
                                 "FacilityExitDate", "ExitCategory", "ExitReason")
    f = ef.join(se, "EnrollmentId", "left")
    f = dedupe.latest_per_key(f, ["StartDate", "EndDate", "FundingType", "SpaceType", "StudentId"],
                              ["ModifiedDate"], ["Id"])
    extra = reshape.collapse_multi(db["AdditionalFundingSources"], ["EnrollmentId"], "AdditionalFundingType",
                                   MULTIPLE_FUNDING_LABEL, "AdditionalFundingSource")
    f = (f.select("EnrollmentId", "StudentId", "FacilityCode", "EnrollmentDate", "FacilityExitDate", "ExitCategory",
                  "ExitReason", "FundingType", "SpaceType", F.col("StartDate").alias("FundingStartDate"),
                  F.col("EndDate").alias("FundingEndDate"), "DateCreated", "ModifiedDate")
         .join(extra, "EnrollmentId", "left"))
    f = joins.semi_in(f, sites.where(F.col("facility_code").isNotNull()), "FacilityCode", "facility_code")
    return f.join(_student_attributes(db), "StudentId", "left")


def registered_flat(db: dict[str, DataFrame], sasids: DataFrame) -> DataFrame:
    """The same attributes for students without enrollment, restricted to ``sasids``."""
    a = _student_attributes(db)
    a = joins.semi_in(a, sasids, "SASID", sasids.columns[0])
    return a.withColumnRenamed("RegisteringSiteId", "FacilityCode")


# ---------------------------------------------------------------- D6, V2

# --- fixed values: columns taken over from the roster and from the database ---
STUDENT_COLUMNS = ["sasid", "first_name", "last_name", "organization_id", "c4k_case_no", "c4k", "age_group",
                   "reimbursement_rate", "enrollment_date", "termination_date", "no_in_family", "annual_income"]
DATABASE_COLUMNS = ["SASID", "FacilityCode", "FirstName", "MiddleName", "LastName", "Dob", "Gender",
                *RACE_FLAGS.values(), "Foster", "StreetNumber", "Address1", "Address2", "Town", "State", "Zip",
                "NumberOfPeopleInHousehold", "AnnualFamilyIncome", "DateFamilyIncomeDocumented",
                "FamilyIncomeNotDisclosed", *EDITABLE_FIELDS.values()]


def psr_students(enrollment: DataFrame, orgs: DataFrame, first_period_start) -> tuple[DataFrame, DataFrame]:
    """D6 roster side: latest row per person (W4), placeholder keys (F3), open/recent only.

    Returns (students, late-key violations for the V2 gate).
    """
    org = orgs.select(F.col("name").alias("org_name"), "organization_id")
    with_ids = dedupe.last_per_key(enrollment.where(F.col("sasid").isNotNull()), ["sasid"], ["period"],
                                   ["source", "row_no"]).join(org, "org_name", "left").select(*STUDENT_COLUMNS)
    without = (dedupe.last_per_key(enrollment.where(F.col("sasid").isNull()), ["first_name", "last_name"],
                                   ["period"], ["source", "row_no"])
               .join(org, "org_name", "left").select(*STUDENT_COLUMNS).distinct())
    both = with_ids.unionByName(without)
    late = late_key_violations(both, ["first_name", "last_name", "organization_id", "enrollment_date"], "sasid")
    open_or_recent = F.col("termination_date").isNull() | (F.to_date("termination_date") >= first_period_start)
    students = both.where(open_or_recent).withColumn("sasid", rc.fill_key("sasid", "first_name", "last_name"))
    return students, late


def missing_from_database(psr: DataFrame, flat: DataFrame) -> DataFrame:
    """Roster keys with no enrolled row in the database (to fetch as registered-only)."""
    return joins.anti_missing(psr.select("sasid"), flat.select("SASID"), "sasid", "SASID").distinct()


def database_students(flat: DataFrame, registered: DataFrame) -> DataFrame:
    """D6 database side: latest enrolled row per SASID (W4) ∪ registered-only students."""
    # duplicate detail rows can tie on the enrollment: the name columns complete the order
    enrolled = dedupe.last_per_key(flat, ["SASID"], ["ModifiedDate"],
                                   ["EnrollmentId", "LastName", "FirstName", "MiddleName", "Dob", "Gender"]
                                   ).select(*DATABASE_COLUMNS)
    return enrolled.unionByName(registered.select(*DATABASE_COLUMNS))


def students_joined(psr: DataFrame, db: DataFrame) -> DataFrame:
    """Roster people ⟕ database attributes; ``student_id`` assigned by key order."""
    # names resolve case-insensitively: the database key is renamed before the join
    e = db.withColumnRenamed("SASID", "__rf_db_sasid")
    s = psr.join(e, F.col("sasid") == F.col("__rf_db_sasid"), "left").drop("__rf_db_sasid")
    return keys.assign_ids(s, ["sasid", "first_name", "last_name", "FacilityCode", "FirstName", "MiddleName",
                               "LastName", "Dob", "Gender"], id_col="student_id")


# ---------------------------------------------------------------- D7

def children(students: DataFrame, birthdates: DataFrame | None = None) -> DataFrame:
    """Children with gender code (E1), race flags, conditional ethnicity (F13), fills."""
    c = students.select(
        F.col("student_id").alias("child_id"), F.col("sasid").alias("Sasid"),
        F.col("first_name").alias("FirstName"), "MiddleName", F.col("last_name").alias("LastName"),
        F.lit(None).cast("string").alias("Suffix"), F.to_date("Dob").alias("Birthdate"),
        F.col("TownOfBirth").alias("BirthTown"), F.col("StateOfBirth").alias("BirthState"), "BirthCertificateId",
        *[F.col(r).cast("boolean").alias(r) for r in FIVE_RACES],
        F.col("HispanicOrLatinxEthnicity").cast("boolean").alias("HispanicOrLatinxEthnicity"),
        rc.gender_code("Gender").alias("Gender"), F.col("Foster").cast("boolean").alias("Foster"),
        F.col("student_id").alias("family_id"), "organization_id")
    c = c.withColumn("HispanicOrLatinxEthnicity", rc.keep_if_any(FIVE_RACES, "HispanicOrLatinxEthnicity"))
    c = c.fillna(False, subset=FIVE_RACES + ["Foster"])
    if birthdates is not None:
        c = joins.coalesce_from(c, birthdates.withColumnRenamed("Birthdate", "Birthdate"), "Sasid", ["Birthdate"],
                                other_key="SASID")
    return c


def families(students: DataFrame) -> DataFrame:
    """One family per child; address line only when both parts are present."""
    return students.select(
        F.col("student_id").alias("family_id"),
        F.col("sasid").alias("nk_person"), rc.concat_or_null(F.col("StreetNumber"), F.lit(" "), F.col("Address1")).alias("AddressLine1"),
        F.col("Address2").alias("AddressLine2"), "Town", "State", "Zip", F.lit(False).alias("Homelessness"),
        "organization_id")


def family_determinations(students: DataFrame) -> DataFrame:
    """Determination date only when size and income agree within 1."""
    return students.select(
        F.col("student_id").alias("family_determination_id"), F.col("student_id").alias("family_id"),
        F.lit(False).alias("NotDisclosed"), F.col("no_in_family").alias("NumberOfPeople"),
        F.col("annual_income").alias("Income"),
        rc.tolerant_date("no_in_family", "NumberOfPeopleInHousehold", "annual_income", "AnnualFamilyIncome",
                         "DateFamilyIncomeDocumented").alias("DeterminationDate"))


# ---------------------------------------------------------------- D8, V3

def enrollments(enrollment: DataFrame, flat: DataFrame, children_df: DataFrame, sites: DataFrame,
                calendar: DataFrame, first_period_start, keys_to_merge: DataFrame | None = None
                ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Unique enrollments per person x age group x facility.

    Returns (enrollments, psr_enrollment_uniqued, V3 violations).
    """
    db = flat.withColumn("age_group", rc.age_group_from_text("SpaceType"))
    if keys_to_merge is not None:
        db = dedupe.merge_spells(db, "SASID", keys_to_merge, ["EnrollmentDate", "FundingStartDate"],
                                 "FacilityExitDate", ["EnrollmentId", "FundingStartDate", "FundingType", "SpaceType"])
    e = enrollment.withColumn("sasid", rc.fill_key("sasid", "first_name", "last_name"))
    c4k = (dedupe.observed_span(e.where(F.col("c4k") == "Y"), ["sasid"], "period", "first_observed_c4k_period",
                                "last_observed_c4k_period"))
    u = (e.where(F.col("termination_date").isNull() | (F.to_date("termination_date") >= first_period_start))
         .withColumn("age_group", F.when(F.col("age_group") == PRESCHOOL_FULL_TIME, F.lit("PS"))
                     .otherwise(F.col("age_group"))))
    u = dedupe.with_group_bounds(u, ["sasid", "age_group", "facility_code"], "period",
                                 "first_observed_psr_period", "last_observed_psr_period")
    u = dedupe.last_per_key(u, ["sasid", "age_group", "facility_code"], ["period"], ["source", "row_no"])
    u = (u.join(c4k, "sasid", "left")
         .join(children_df.select(F.col("Sasid").alias("sasid"), "child_id"), "sasid", "left"))
    u = joins.null_safe_join(u, sites.select("facility_code", "site_id"), ["facility_code"], "left",
                             nullable=["facility_code"])
    db_keys = db.select(F.col("SASID").alias("sasid"), "age_group", F.col("FacilityCode").alias("facility_code"),
                         "EnrollmentDate", "FacilityExitDate", "ExitCategory", "FundingStartDate")
    u = joins.null_safe_join(u, db_keys, ["sasid", "age_group", "facility_code"], "left",
                             nullable=["age_group", "facility_code"])
    u = dedupe.drop_closed_when_one_open(u, ["sasid", "age_group", "facility_code"], "FacilityExitDate")
    u = keys.assign_ids(u, ["sasid", "age_group", "facility_code", "EnrollmentDate", "FacilityExitDate",
                            "FundingStartDate", "ExitCategory"], id_col="enrollment_id")
    cal = F.broadcast(calendar)
    u = (u.join(cal.select(F.col("id").alias("first_observed_psr_period"),
                           F.col("period_start").alias("start_of_first_observed_psr")), "first_observed_psr_period")
         .join(cal.select(F.col("id").alias("last_observed_psr_period"),
                          F.col("period_end").alias("end_of_last_observed_psr")), "last_observed_psr_period"))
    u = dedupe.close_on_move(u, "sasid", "age_group", "enrollment_date", "termination_date", "ExitCategory",
                             "start_of_first_observed_psr", "end_of_last_observed_psr")
    violations = unique_key_violations(u, ["sasid", "age_group"])
    entry = F.coalesce(F.to_date("enrollment_date"), F.to_date("EnrollmentDate"))
    exit_ = F.coalesce(F.to_date("termination_date"), F.to_date("FacilityExitDate"))
    out = u.select("enrollment_id", "child_id", "site_id", "facility_code",
                   rc.recode("age_group", rc.AGE_GROUP_CODES).alias("AgeGroup"),
                   entry.alias("Entry"), exit_.alias("Exit"),
                   rc.exit_reason("ExitCategory", exit_).alias("ExitReason"))
    return out, u, violations


# ---------------------------------------------------------------- D9

def fundings(uniqued: DataFrame, enrollment: DataFrame, calendar: DataFrame,
             full_time_sites: Sequence[str] = ()) -> DataFrame:
    """CDC and C4K fundings, bound by name (O3) and numbered.

    ``full_time_sites``: facility codes of the sites whose spaces are all full time (E8).
    """
    # R's max() without na.rm: one roster whose header matched no period makes the bound NA
    last_seen = enrollment.select(strict_max("period")).scalar()
    # both kinds of fundings are made of the same rows: planned and joined once
    needed = ["enrollment_id", "facility_code", "age_group", "c4k_case_no", "termination_date", "FacilityExitDate",
              "first_observed_psr_period", "last_observed_psr_period", "last_observed_c4k_period"]
    uniqued = stored(uniqued.select(*[c for c in uniqued.columns if c in needed]))
    open_end = (F.col("last_observed_psr_period") < last_seen) | F.col("termination_date").isNotNull() | \
        F.col("FacilityExitDate").isNotNull()
    cdc = uniqued.select(
        "enrollment_id", F.lit(0).alias("FundingSource"), F.lit(None).cast("double").alias("FamilyId"),
        F.lit(None).cast("date").alias("CertificateStartDate"), F.lit(None).cast("date").alias("CertificateEndDate"),
        F.col("first_observed_psr_period").alias("FirstReportingPeriodId"),
        F.when(open_end, F.col("last_observed_psr_period")).when(~open_end, F.lit(None).cast("int"))
        .alias("LastReportingPeriodId"),
        rc.funding_time("facility_code", "age_group", full_time_sites).alias("FundingTime"))
    cal = F.broadcast(calendar.select(F.col("id").alias("last_observed_c4k_period"), "period_end"))
    c4k_end = F.col("last_observed_c4k_period") < last_seen
    c4k = uniqued.join(cal, "last_observed_c4k_period").select(
        "enrollment_id", F.lit(1).alias("FundingSource"), rc.digits_to_int("c4k_case_no").cast("double")
        .alias("FamilyId"), F.lit(None).cast("date").alias("CertificateStartDate"),
        F.when(c4k_end, F.col("period_end")).when(~c4k_end, F.lit(None).cast("date")).alias("CertificateEndDate"),
        F.lit(None).cast("int").alias("FirstReportingPeriodId"), F.lit(None).cast("int").alias("LastReportingPeriodId"),
        F.lit(None).cast("int").alias("FundingTime"))
    both = joins.union_by_name(cdc, c4k)
    return keys.assign_ids(both, ["FundingSource", "enrollment_id"], id_col="funding_id")


def current_reports(orgs: DataFrame, enrollment: DataFrame, revenue: DataFrame | None = None,
                    include_past: bool = False, submitted_at=None) -> DataFrame:
    """One open report per organization for the period after the last one seen.

    ``include_past`` (O4) adds the submitted past reports built from the roster
    revenue, stamped ``submitted_at`` (F23: pass the load time; default the
    current timestamp).
    """
    nxt = enrollment.select(strict_max("period") + 1).scalar()
    r = orgs.select(F.lit(0).alias("FundingSource"), nxt.alias("ReportingPeriodId"),
                    F.lit(None).cast("timestamp").alias("SubmittedAt"), "organization_id",
                    F.lit(True).alias("Accredited"), F.lit(None).cast("double").alias("C4KRevenue"),
                    F.lit(False).alias("RetroactiveC4KRevenue"), F.lit(None).cast("double").alias("FamilyFeesRevenue"))
    if include_past and revenue is not None:
        stamp = F.current_timestamp() if submitted_at is None else F.lit(submitted_at).cast("timestamp")
        past = (revenue.join(orgs, revenue["organization"] == orgs["name"], "left")
                .select(F.lit(0).alias("FundingSource"), F.col("period").alias("ReportingPeriodId"),
                        stamp.alias("SubmittedAt"), "organization_id", F.lit(True).alias("Accredited"),
                        F.col("c4k_revenue").cast("double").alias("C4KRevenue"),
                        F.lit(False).alias("RetroactiveC4KRevenue"),
                        F.col("family_fees").cast("double").alias("FamilyFeesRevenue")))
        r = past.unionByName(r)
    return keys.assign_ids(r, ["ReportingPeriodId", "organization_id"], id_col="report_id")


def single_site_fix(enrollments_df: DataFrame, sites: DataFrame, mapping: dict | None = None
                    ) -> tuple[DataFrame, DataFrame]:
    """Drop the listed sites and move their enrollments; without a mapping nothing changes.

    ``mapping``: ``{facility code: facility code}``, a short literal; the sites it
    names are looked up, so a mapping holds whatever ids a run assigns.
    """
    if not mapping:
        return enrollments_df, sites
    codes = [*mapping.keys(), *mapping.values()]
    ids = {r["facility_code"]: r["site_id"] for r in
           sites.where(F.col("facility_code").isin(codes)).groupBy("facility_code").agg(F.min("site_id").alias("site_id")).collect()}
    known = {ids[a]: ids[b] for a, b in mapping.items() if a in ids and b in ids and a != b}
    return keys.remap_dimension(enrollments_df, sites, "site_id", "site_id", known)


def child_guid(sasid: str, organization: str):
    """A repeatable identifier in GUID form: a hash of the child's natural key, so a retried task makes the same one."""
    h = F.sha2(F.to_json(F.array(F.col(organization).cast("string"), F.col(sasid).cast("string"))), 256)
    return F.concat_ws("-", *[F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def to_target_tables(orgs: DataFrame, sites: DataFrame, families_df: DataFrame, determinations: DataFrame,
                     children_df: DataFrame, enrollments_df: DataFrame, fundings_df: DataFrame,
                     reports: DataFrame) -> dict[str, DataFrame]:
    """The reconcile outputs in the target model's column names, keyed by local ids (K1 input)."""
    return {
        "Organization": orgs.select("organization_id", F.col("name").alias("Name")),
        "Site": sites.select("site_id", F.col("name").alias("Name"), F.col("title_i").alias("TitleI"),
                             region_code_map()[F.col("region")].alias("Region"), F.col("facility_code").alias("nk_facility"),
                             F.col("organization_id").alias("OrganizationId")),
        "Family": families_df.select("family_id", "AddressLine1", "AddressLine2", "Town", "State", "Zip",
                                     "Homelessness", F.col("organization_id").alias("OrganizationId"), "nk_person"),
        "FamilyDetermination": determinations.select("family_determination_id", "NotDisclosed", "NumberOfPeople",
                                                     "Income", "DeterminationDate",
                                                     F.col("family_id").alias("FamilyId")),
        "Child": children_df.select("child_id", child_guid("Sasid", "organization_id").alias("Guid"), *[c for c in children_df.columns
                                                  if c not in ("child_id", "family_id", "organization_id")],
                                    F.col("family_id").alias("FamilyId"),
                                    F.col("organization_id").alias("OrganizationId")),
        "Enrollment": enrollments_df.select("enrollment_id", "AgeGroup", "Entry", "Exit", "ExitReason",
                                            F.col("child_id").alias("ChildId"), F.col("site_id").alias("SiteId"),
                                            F.col("facility_code").alias("nk_facility")),
        "Funding": fundings_df.select("funding_id", F.col("FundingSource").alias("Source"), "FamilyId",
                                      "CertificateStartDate", "CertificateEndDate", "FirstReportingPeriodId",
                                      "LastReportingPeriodId", F.col("FundingTime").alias("Time"),
                                      F.col("enrollment_id").alias("EnrollmentId")),
        "Report": reports.select("report_id", F.col("FundingSource").alias("Type"), "ReportingPeriodId",
                                 "SubmittedAt", F.col("organization_id").alias("OrganizationId"), "Accredited",
                                 "C4KRevenue", "RetroactiveC4KRevenue", "FamilyFeesRevenue"),
    }


def gates(enrollment: DataFrame, late: DataFrame | None = None, nonunique: DataFrame | None = None
          ) -> list[tuple[str, DataFrame, str]]:
    """V1-V4 rules for ``quality.check``; V2 and V3 if their violations are given."""
    rules = [("one organization per file", one_org_per_file(enrollment), "stop")]
    if late is not None:
        rules.append(("key given after appearing without one", late, "stop"))
    if nonunique is not None:
        rules.append(("person x age group unique", nonunique, "stop"))
    return [*rules, ("inexact licence match", fuzzy_match_warnings(enrollment), "warn")]


def checked_roster(enrollment: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The matched roster, stored, and the results of V4 (observed while it is written) and V1 (from two stored columns)."""
    inexact = RowRule("inexact licence match", "warn", F.col("fuzzy") > 0, F.col("source"))
    roster, results = stored_and_checked(enrollment, [inexact])
    return roster, results.unionByName(check(enrollment.sparkSession, gates(roster)[:1]))


def run_migration(spark, roster_folder: str, programs_path: str, db: dict[str, DataFrame], out_dir: str,
                  calendar_start, calendar_end, birthdates: DataFrame | None = None,
                  keys_to_merge: DataFrame | None = None, org_ids: DataFrame | None = None,
                  site_mapping: dict | None = None,
                  full_time_sites: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Entry 1 (the migration script) end to end: sources -> D1-D9 -> gates -> load.

    The workbooks are read once: the extracted cells are a reliable checkpoint, the
    matched roster a stored table. V4 is observed while that is written; V1 is
    enforced there, the other stop-gates before anything is loaded (``QualityGateError``);
    warnings are returned with the gate results. Returns the key maps of the
    loaded tables plus ``gates``.
    """
    from ..operators.periods import reporting_calendar
    from ..operators.quality import enforce, lookup_key_violations
    from ..session import cut_lineage
    from ..sinks.target import load_periods, load_target, to_target_periods
    from ..sources.files import read_programs
    from ..sources.lookups import towns
    from ..sources.workbooks import extract_workbooks, list_workbooks, roster_frames

    cal = reporting_calendar(spark, calendar_start, calendar_end)
    first_start = cal.select(F.min("period_start")).first()[0]
    frames = roster_frames(cut_lineage(extract_workbooks(list_workbooks(spark, roster_folder))))
    programs = read_programs(spark, programs_path)
    enr, roster_results = checked_roster(psr_enrollment(frames["roster"], frames["header"], programs, cal))
    enforce(roster_results)
    rev = psr_revenue(frames["totals"], frames["header"], enr, cal)
    orgs, sites = organizations_and_sites(rev, programs, towns(spark))
    flat = enrollment_flat(db, sites)
    psr, late = psr_students(enr, orgs, first_start)
    students = students_joined(psr, database_students(flat, registered_flat(db, missing_from_database(psr, flat))))
    kids = children(students, birthdates)
    enrl, uniq, nonunique = enrollments(enr, flat, kids, sites, cal, first_start, keys_to_merge)
    lookups = {"towns": (towns(spark), ["town"])}
    if birthdates is not None:
        lookups["birthdates"] = (birthdates, ["SASID"])
    rules = [g for g in gates(enr, late, nonunique) if g[0] not in (r["rule"] for r in roster_results.collect())]
    results = enforce(roster_results.unionByName(check(spark, rules + lookup_key_violations(lookups))))
    funds = fundings(uniq, enr, cal, full_time_sites)
    reports = current_reports(orgs, enr)
    enrl, sites = single_site_fix(enrl, sites, site_mapping)
    tables = to_target_tables(orgs, sites, families(students), family_determinations(students), kids, enrl,
                              funds, reports)
    load_periods(cal, out_dir)
    tables["Funding"] = to_target_periods(tables["Funding"], ["FirstReportingPeriodId", "LastReportingPeriodId"], cal, out_dir)
    tables["Report"] = to_target_periods(tables["Report"], ["ReportingPeriodId"], cal, out_dir, required=["ReportingPeriodId"])
    out = load_target(tables, out_dir, org_ids)
    out["gates"] = results
    return out
