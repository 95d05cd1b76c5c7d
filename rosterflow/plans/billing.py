"""Monthly billing reports for *all* reports in one plan.

The source script builds one report per call with four database round trips;
here every report is a row of ``report`` and each section is one DataFrame keyed
by ``report_id``. Inputs follow the target model as the report generator reads
it (schema version 2 in FIXTURES.md):

* ``report``: Id, Type, SubmittedAt, OrganizationId, ReportingPeriodId, Accredited, C4KRevenue, FamilyFeesRevenue
* ``organization``: Id, Name — ``reporting_period``: Id, Period, PeriodStart, PeriodEnd
* ``funding``: Id, Source, EnrollmentId, FundingSpaceId, FirstReportingPeriodId, LastReportingPeriodId
* ``funding_space``: Id, OrganizationId, Source, Time, AgeGroup, Capacity
* ``enrollment``: Id, ChildId, SiteId, AgeGroup, Entry, Exit
* ``site``: Id, OrganizationId, LicenseNumber, Region, TitleI
* ``child``: Id, Sasid, FirstName, LastName, Foster, FamilyId, C4KFamilyCaseNumber
* ``family_determination``: Id, FamilyId, NumberOfPeople, Income, DeterminationDate
* ``c4k_certificate``: ChildId, StartDate, EndDate

Quirks kept from the source: ``# of Families`` counts funding rows; a roster row
repeats once per subsidy row of its child (subsidy rows = the child's fundings
at the organization x its certificates overlapping the period). The repetition
is produced from per-child *counts*; the number of subsidies per report comes
from prefix sums over certificate start/end events (no certificate x report pairs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import recode as rc
from ..functions.dates import long_date, month_year, us_date, weeks_inclusive
from ..operators.dedupe import latest_per_key
from ..operators.keys import number_rows, running_total
from ..operators.periods import active_in_period
from ..operators.stats import zero_filled_count
from ..session import stored
from ..sources.lookups import family_sizes, income_limits, rates

# --- fixed values: report column headers and file name suffix ---------------------
ROSTER_HEADERS = {
    "line_no": "#", "sasid": "SASID #", "last_name": "Last Name", "first_name": "First Name",
    "c4k_family_id": "C4K Family ID", "c4k": "C4K (Y/N)", "center_license": "Center (License Number)",
    "service": "Service (Space Type)", "weekly_rate": "Weekly Reimbursement Rate",
    "enrollment_date": "Enrollment Date", "termination_date": "Termination Date", "n_in_family": "# in Family",
    "annual_income": "Annual Income", "eligible": "Eligible for State Funds (Y Or N*)",
}
INCOME_HEADERS = {"family_size": "Family Size", "less_than_or_equal_to": "Less than or Equal to",
                  "n_families": "# of Families"}
HEADER_HEADERS = {"contractor": "Contractor", "reporting_period": "Reporting Period",
                  "number_of_weeks": "Number of Weeks", "family_fees": "Family Fees", "n_subsidies": "# Subsidies",
                  "subsidies": "Subsidies", "date": "Date"}
SPACES_HEADERS = {"age_group": "Age Group", "time": "Time", "accredited": "Accredited", "title_i": "Title I", "rate": "Rate",
                  "capacity": "Capacity", "utilization": "Utilization"}
REPORT_SUFFIX = "CDC PSR"
# ------------------------------------------------------------------------------------


def report_frame(report: DataFrame, organization: DataFrame, reporting_period: DataFrame) -> DataFrame:
    """Report header attributes: one row per report (inner joins, as the source SQL)."""
    return (report.select(F.col("Id").alias("report_id"), F.col("Type").alias("report_type"), "SubmittedAt",
                          F.col("OrganizationId").alias("organization_id"),
                          F.col("ReportingPeriodId").alias("period_id"),
                          "Accredited", "C4KRevenue", "FamilyFeesRevenue")
            .join(organization.select(F.col("Id").alias("organization_id"), F.col("Name").alias("name")),
                  "organization_id")
            .join(reporting_period.select(F.col("Id").alias("period_id"), F.col("Period").alias("period"),
                                          F.col("PeriodStart").alias("period_start"),
                                          F.col("PeriodEnd").alias("period_end")), "period_id"))


def funding_rows(t: dict) -> DataFrame:
    """Funding rows with their space, enrollment, site, child and latest determination, of any period."""
    det = latest_per_key(t["family_determination"], ["FamilyId"], ["DeterminationDate"], ["Id"]).select(
        F.col("FamilyId").alias("__fam"), "NumberOfPeople", "Income")
    return (t["funding"].where(F.col("Source").isin(0, 1))
            .join(t["funding_space"].select(F.col("Id").alias("FundingSpaceId"), F.col("Time").alias("time_code")),
                  "FundingSpaceId")
            .join(t["enrollment"].select(F.col("Id").alias("EnrollmentId"), "ChildId", "SiteId",
                                         F.col("AgeGroup").alias("age_code"), "Entry", "Exit"), "EnrollmentId")
            .join(t["site"].select(F.col("Id").alias("SiteId"), F.col("OrganizationId").alias("organization_id"),
                                   "LicenseNumber", "Region", "TitleI"), "SiteId")
            .join(t["child"].select(F.col("Id").alias("ChildId"), "LastName", "FirstName", "Foster", "Sasid",
                                    "FamilyId"), "ChildId")
            .join(det, F.col("FamilyId") == F.col("__fam"), "left").drop("__fam"))


def _decoded() -> list:
    """The labels (E3) and the foster override (F25) of a funding row."""
    return [rc.recode("age_code", rc.AGE_GROUP_LABELS).alias("AgeGroup"), rc.recode("time_code", rc.TIME_LABELS).alias("Time"),
            rc.recode("Region", rc.REGION_LABELS).alias("Region"),
            rc.foster_override("Foster", F.col("NumberOfPeople"), 1).alias("NumberOfPeople"),
            rc.foster_override("Foster", F.col("Income"), 0.0).alias("Income")]


def _with_rate(df: DataFrame) -> DataFrame:
    """The rate on five keys (J13, broadcast fixed grid)."""
    return df.join(F.broadcast(rates(df.sparkSession)), ["Accredited", "TitleI", "Region", "AgeGroup", "Time"], "left")


def active_fundings(rep: DataFrame, t: dict) -> DataFrame:
    """Funding rows active in each report's period, with child, site and latest determination.

    J11 as an equi-join on (organization, period); labels decoded (E3); foster
    override (F25); rate lookup on five keys (J13, broadcast fixed grid).
    """
    f = funding_rows(t)
    reports = rep.select("report_id", "organization_id", "period_id", "Accredited")
    act = active_in_period(f, reports, "organization_id", "FirstReportingPeriodId", "LastReportingPeriodId",
                           "period_id")
    act = act.select(
        "report_id", "organization_id", F.col("Id").alias("funding_id"), "ChildId", "Sasid", "LastName", "FirstName",
        "LicenseNumber", "TitleI", "Accredited", "Entry", "Exit", *_decoded())
    return _with_rate(act)


def _funding_at_org(t: dict) -> DataFrame:
    """(organization_id, ChildId, n_fund): the child's fundings at the organization's sites, any period."""
    return (t["funding"].join(t["enrollment"].select(F.col("Id").alias("EnrollmentId"), "ChildId", "SiteId"),
                              "EnrollmentId")
            .join(t["site"].select(F.col("Id").alias("SiteId"), F.col("OrganizationId").alias("organization_id")),
                  "SiteId")
            .groupBy("organization_id", "ChildId").agg(F.count(F.lit(1)).alias("n_fund")))


def _overlaps(start="StartDate", end="EndDate", p_start="period_start", p_end="period_end"):
    """``StartDate <= PeriodEnd and (EndDate is null or EndDate >= PeriodStart)``."""
    return (F.col(start) <= F.col(p_end)) & (F.col(end).isNull() | (F.col(end) >= F.col(p_start)))


def child_subsidies(pairs: DataFrame, rep: DataFrame, t: dict) -> DataFrame:
    """(report_id, ChildId, n_subsidy, case_no) for the given (report, organization, child) pairs.

    Subsidy rows = the child's fundings at the organization's sites (any period) x
    its certificates overlapping the report period; both factors are counted and
    multiplied. Only the pairs asked for (the roster's) are evaluated: an
    equi-join on the child, bounded by the child's certificates.
    """
    certs = t["c4k_certificate"].where(F.col("StartDate").isNotNull()).select("ChildId", "StartDate", "EndDate")
    n_cert = (pairs.select("report_id", "organization_id", "ChildId").distinct()
              .join(rep.select("report_id", "period_start", "period_end"), "report_id")
              .join(certs, "ChildId").where(_overlaps())
              .groupBy("report_id", "organization_id", "ChildId").agg(F.count(F.lit(1)).alias("n_cert")))
    case_no = t["child"].select(F.col("Id").alias("ChildId"), F.col("C4KFamilyCaseNumber").alias("case_no"))
    return (n_cert.join(_funding_at_org(t), ["organization_id", "ChildId"])
            .select("report_id", "ChildId", (F.col("n_cert") * F.col("n_fund")).alias("n_subsidy"))
            .join(case_no, "ChildId", "left"))


def subsidies_per_report(rep: DataFrame, t: dict) -> DataFrame:
    """(report_id, n_subsidies) = sum over certificates of n_fund x [overlaps the period].

    For a valid certificate (no end, or end >= start) the overlap test splits into
    ``[start <= period_end] - [end < period_start]``, so per organization the
    count is two prefix sums over dates: certificate starts/ends are events, the
    report period bounds are probes, and one ordered running total (range
    partitioned, grouped by organization) answers every report — work is
    O(certificates + reports), never certificate x report pairs. The rare
    invalid certificates (end < start) are matched exactly by month buckets.
    """
    certs = (t["c4k_certificate"].where(F.col("StartDate").isNotNull())
             .join(_funding_at_org(t), "ChildId")
             .select("organization_id", "StartDate", "EndDate", F.col("n_fund").alias("w")))
    valid = certs.where(F.col("EndDate").isNull() | (F.col("EndDate") >= F.col("StartDate")))
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")

    def stream(df, d, kind, ws, we, rid):
        return df.select("organization_id", F.col(d).cast("date").alias("d"), F.lit(kind).alias("kind"),
                         ws.alias("ws"), we.alias("we"), rid.alias("report_id"))
    events = (stream(valid, "StartDate", 0, F.col("w"), zero, none)
              .unionByName(stream(valid.where(F.col("EndDate").isNotNull()), "EndDate", 0, zero, F.col("w"), none))
              .unionByName(stream(rep, "period_end", 1, zero, zero, F.col("report_id")))      # after same-day events
              .unionByName(stream(rep, "period_start", -1, zero, zero, F.col("report_id"))))  # before them
    cum = running_total(events, ["d", "kind"], ["ws", "we"], "cum", group_cols=["organization_id"])
    started = cum.where(F.col("kind") == 1).select("report_id", F.col("cum_ws").alias("started"))
    ended = cum.where(F.col("kind") == -1).select("report_id", F.col("cum_we").alias("ended"))
    valid_n = started.join(ended, "report_id").select("report_id", (F.col("started") - F.col("ended")).alias("n"))

    invalid = certs.where(F.col("EndDate") < F.col("StartDate"))
    one_month = F.expr("interval 1 month")
    inv_m = invalid.withColumn("__m", F.explode(F.sequence(F.trunc("EndDate", "month"), F.trunc("StartDate", "month"),
                                                            one_month)))
    rep_m = rep.select("report_id", "organization_id", "period_start", "period_end").withColumn(
        "__m", F.explode(F.sequence(F.trunc("period_start", "month"), F.trunc("period_end", "month"), one_month)))
    first_common = F.trunc(F.greatest(F.col("StartDate"), F.col("period_start")), "month")
    invalid_n = (inv_m.join(rep_m, ["organization_id", "__m"]).where(_overlaps() & (F.col("__m") == first_common))
                 .groupBy("report_id").agg(F.sum("w").alias("n_inv")))
    return (rep.select("report_id").join(valid_n, "report_id", "left").join(invalid_n, "report_id", "left")
            .select("report_id", (F.coalesce("n", F.lit(0)) + F.coalesce("n_inv", F.lit(0))).cast("bigint")
                    .alias("n_subsidies")))


SECTIONS = ("roster", "income_groups", "spaces", "header")


def billing_report(t: dict, sections=SECTIONS, report_ids: DataFrame | None = None) -> dict[str, DataFrame]:
    """Report sections for every report: roster, income groups, spaces, header.

    Only the requested ``sections`` are planned (the roster numbering
    materialises data, so it is not built when only the header is wanted).
    ``report_ids`` (one column of ids, P16) restricts the reports; default all.
    """
    spark = t["report"].sparkSession
    report = t["report"]
    if report_ids is not None:
        report = report.join(report_ids.select(F.col(report_ids.columns[0]).alias("Id")), "Id", "left_semi")
    rep = report_frame(report, t["organization"], t["reporting_period"])
    using = {"income_groups", "spaces"} & set(sections)
    act = active_fundings(rep, t) if using else None
    if len(using) > 1:      # read more than once: planned and joined once
        act = stored(act)
    limits = F.broadcast(income_limits(spark))
    out = {}
    if "roster" in sections:
        out["roster"] = _roster(rep, t, limits)
    if "income_groups" in sections:
        out["income_groups"] = _income_groups(rep, act, limits)
    if "spaces" in sections:
        out["spaces"] = _spaces(rep, act, t["funding_space"])
    if "header" in sections:
        out["header"] = _header(rep, subsidies_per_report(rep, t))
    return out


#: The columns that order a section's rows in a workbook.
SECTION_ORDER = {"roster": ["line_no"], "income_groups": ["family_size"], "spaces": ["age_group", "time", "accredited", "title_i"]}


def generate_reports(t: dict, out_dir: str, report_ids: DataFrame | None = None, fmt: str = "parquet") -> None:
    """Entry 3 (the report generator) for all (or the given) reports: D11 sections written per report (K7).

    ``fmt="xlsx"`` writes one workbook per report with its four sections; other formats a folder per section.
    """
    from ..sinks.report_workbooks import write_report_workbooks
    from ..sinks.target import write_report_sections
    headers = {"roster": ROSTER_HEADERS, "income_groups": INCOME_HEADERS, "header": HEADER_HEADERS, "spaces": SPACES_HEADERS}
    sections = billing_report(t, report_ids=report_ids)
    if fmt == "xlsx":
        write_report_workbooks(sections, out_dir, headers, SECTION_ORDER)
    else:
        write_report_sections(sections, out_dir, fmt, headers if fmt == "csv" else None)


#: Places among all fundings that make a range; a report's lines of one range are numbered in one task.
RANGE_PLACES = 250_000
#: Rows of a table (a report and a range, or a report) up to which it is broadcast.
BROADCAST_ROWS = 500_000


def _roster(rep: DataFrame, t: dict, limits: DataFrame) -> DataFrame:
    """One line per active funding, repeated per subsidy row of the child; numbered per report (O1).

    An open funding is in the reports of many periods: the funding rows are stored once, the lines are matched and
    numbered as keys alone, and take the texts of their funding at the end.
    """
    rep = stored(rep)
    f = stored(funding_rows(t).select("organization_id", F.col("Id").alias("funding_id"), "ChildId", "Sasid", "LastName", "FirstName", "LicenseNumber", "TitleI",
                                      "Entry", "Exit", "FirstReportingPeriodId", "LastReportingPeriodId", *_decoded())
               .withColumn("__row", F.monotonically_increasing_id()))
    # the place of a funding among all: labels (NULLs last), then its id; rows of one id share it
    labels = ["AgeGroup", "LastName", "FirstName"]
    spell = ["__row", "organization_id", "ChildId", "FirstReportingPeriodId", "LastReportingPeriodId"]
    keyed = f.select(*spell, "funding_id", *[x for c in labels for x in (F.col(c).isNull().alias(f"__no_{c}"), c)])
    placed = stored(number_rows(keyed, [*[x for c in labels for x in (f"__no_{c}", c)], "funding_id"], id_col="__place"))
    twins = Window.partitionBy("funding_id", *labels)
    spells = placed.select(*spell, F.min("__place").over(twins).alias("__place"))
    n_reports = rep.count()
    if rep.select("report_id").distinct().count() == n_reports:
        lines = _numbered_lines(spells, rep, t, n_reports)
    else:
        lines = _lines_of_repeated_reports(spells, rep, t)
    r = lines.join(f.drop("organization_id", "ChildId", "funding_id", "FirstReportingPeriodId", "LastReportingPeriodId"), "__row")
    r = _with_rate(r).join(limits.select("NumberOfPeople", F.col("x75SMI").alias("MaxIncome")), "NumberOfPeople", "left")
    return r.select(
        "report_id", "line_no", F.col("Sasid").alias("sasid"), F.col("LastName").alias("last_name"),
        F.col("FirstName").alias("first_name"), "c4k_family_id", rc.presence_flag("c4k_family_id").alias("c4k"),
        F.col("LicenseNumber").alias("center_license"), rc.space_label("Time", "AgeGroup").alias("service"),
        F.col("Rate").alias("weekly_rate"), us_date("Entry").alias("enrollment_date"),
        us_date("Exit").alias("termination_date"), F.col("NumberOfPeople").alias("n_in_family"),
        F.col("Income").alias("annual_income"), rc.eligibility_flag("Income", "MaxIncome").alias("eligible"))


def _numbered_lines(spells: DataFrame, rep: DataFrame, t: dict, n_reports: int) -> DataFrame:
    """(report_id, Accredited, __row, c4k_family_id, line_no) of the spells' lines, for reports that are one row each.

    The lines are never shuffled: the spells, which bring along what their child's subsidies depend on, are dealt over
    tasks by organization and range of places. There they meet their reports, and a report's lines of a range are
    numbered from its number of lines in the ranges before, which a first pass over the spells counts.
    """
    certs = t["c4k_certificate"].where(F.col("StartDate").isNotNull()).groupBy("ChildId", "StartDate", "EndDate").agg(F.count(F.lit(1)).alias("n"))
    certs = certs.groupBy("ChildId").agg(F.collect_list(F.struct("StartDate", "EndDate", "n")).alias("__certs"))
    cases = t["child"].groupBy(F.col("Id").alias("ChildId")).agg(F.collect_list(F.struct(F.col("C4KFamilyCaseNumber").alias("case_no"))).alias("__cases"))
    spells = (spells.join(_funding_at_org(t), ["organization_id", "ChildId"], "left").join(certs, "ChildId", "left").join(cases, "ChildId", "left")
              .withColumn("__range", F.floor(F.col("__place") / RANGE_PLACES).cast("int")))
    spells = stored(spells.select("__row", "__place", "__range", "organization_id", "FirstReportingPeriodId", "LastReportingPeriodId", "n_fund", "__certs", "__cases"))
    reports = rep.where("report_id is not null").select("report_id", "organization_id", "period_id", "Accredited", "period_start", "period_end")
    reports = F.broadcast(reports) if n_reports <= BROADCAST_ROWS // 20 else reports        # a report has 17 rows to meet spells

    def in_reports(df: DataFrame) -> DataFrame:
        """With __subs: the subsidy rows of the spell's child in the report, NULL if there are none."""
        act = active_in_period(df, reports, "organization_id", "FirstReportingPeriodId", "LastReportingPeriodId", "period_id")
        n_cert = F.reduce(F.filter("__certs", lambda c: (c["StartDate"] <= F.col("period_end")) & (c["EndDate"].isNull() | (c["EndDate"] >= F.col("period_start")))),
                          F.lit(0).cast("bigint"), lambda n, c: n + c["n"])
        return act.withColumn("__subs", F.nullif(n_cert, F.lit(0).cast("bigint")) * F.col("n_fund"))

    part = ["organization_id", "__range"]
    n_lines = F.when(F.col("__subs").isNull(), 1).otherwise(F.greatest(F.col("__subs"), F.lit(1)) * F.greatest(F.coalesce(F.size("__cases"), F.lit(0)), F.lit(1)))
    counts = in_reports(spells).groupBy(*part, "report_id").agg(F.sum(n_lines).alias("n"))
    before = F.sum("n").over(Window.partitionBy("report_id").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    begins = stored(counts.select(*part, "report_id", F.coalesce(before, F.lit(0)).alias("before")))
    few = begins.count() <= BROADCAST_ROWS
    begins = begins.groupBy(*part).agg(F.map_from_entries(F.collect_list(F.struct("report_id", "before"))).alias("__begins"))
    # either way the spells are dealt by organization and range
    dealt = spells.repartition(*part).join(F.broadcast(begins), part) if few else spells.join(begins.hint("merge"), part)
    none = F.array(F.struct(F.lit(None).cast(t["child"].schema["C4KFamilyCaseNumber"].dataType).alias("case_no")))
    lines = (in_reports(dealt).select(*part, "report_id", "Accredited", "__row", "__place", "__subs", F.col("__begins")[F.col("report_id")].alias("__before"),
                                      F.explode(F.when(F.col("__subs").isNull() | F.col("__cases").isNull(), none).otherwise(F.col("__cases"))).alias("__case"))
             .withColumn("__rep", F.explode(F.sequence(F.lit(1), F.greatest(F.coalesce("__subs", F.lit(0)), F.lit(1))))))
    number = F.row_number().over(Window.partitionBy(*part, "report_id").orderBy("__place", "__rep"))
    return lines.select("report_id", "Accredited", "__row", F.when(F.col("__subs") > 0, F.col("__case.case_no")).alias("c4k_family_id"),
                        (F.col("__before") + number).cast("bigint").alias("line_no"))


def _lines_of_repeated_reports(spells: DataFrame, rep: DataFrame, t: dict) -> DataFrame:
    """As ``_numbered_lines``, where a report is several rows (of several organizations, maybe): lines are joined and numbered one by one."""
    act = active_in_period(spells, rep.select("report_id", "organization_id", "period_id"), "organization_id", "FirstReportingPeriodId",
                           "LastReportingPeriodId", "period_id")
    act = stored(act.select("report_id", "organization_id", "ChildId", "__row", "__place"))
    lines = act.join(child_subsidies(act, rep, t), ["report_id", "ChildId"], "left").select(
        "report_id", "__row", "__place", F.when(F.col("n_subsidy") > 0, F.col("case_no")).alias("c4k_family_id"),
        F.explode(F.sequence(F.lit(1), F.greatest(F.coalesce("n_subsidy", F.lit(0)), F.lit(1)))).alias("__rep"))
    # numbered in order of report, funding and repetition; a report's lines start at its least number
    lines = stored(number_rows(stored(lines), ["report_id", "__place", "__rep"], id_col="__no").drop("__place", "__rep"))
    first = stored(lines.groupBy("report_id").agg(F.min("__no").alias("__first")).join(rep.select("report_id", "Accredited"), "report_id"))
    return lines.join(first, "report_id").withColumn("line_no", F.col("__no") - F.col("__first") + 1)


def _income_groups(rep: DataFrame, act: DataFrame, limits: DataFrame) -> DataFrame:
    """Funding rows at or under 200% FPL per family size, zero-filled over sizes 1-12."""
    under = (act.join(limits, "NumberOfPeople").where(F.col("Income") <= F.col("x200FPL"))
             .select("report_id", F.col("NumberOfPeople").alias("family_size")))
    domain = (rep.select("report_id", F.explode(F.array(*[F.lit(n) for n in family_sizes()])).alias("family_size"))
              .join(limits.select(F.col("NumberOfPeople").alias("family_size"),
                                  F.col("x200FPL").alias("less_than_or_equal_to")), "family_size"))
    return zero_filled_count(under, domain, ["report_id", "family_size"], "n_families").select(
        "report_id", "family_size", "less_than_or_equal_to", "n_families")


def _spaces(rep: DataFrame, act: DataFrame, funding_space: DataFrame) -> DataFrame:
    """Used rows by (age, time, accredited, title, rate) against capacity."""
    used = act.groupBy("report_id", "organization_id", "AgeGroup", "Time", "Accredited", "TitleI", "Rate").agg(
        F.count(F.lit(1)).alias("utilization"))
    cap = funding_space.select(F.col("OrganizationId").alias("organization_id"),
                               F.col("Source").alias("report_type"),
                               rc.recode("AgeGroup", rc.AGE_GROUP_LABELS).alias("AgeGroup"),
                               rc.recode("Time", rc.TIME_LABELS).alias("Time"), F.col("Capacity").alias("capacity"))
    used = used.join(rep.select("report_id", "report_type"), "report_id")
    # organization and source match by SQL equality; age group and time by dplyr's join (NA matches NA)
    c = cap.select(*[F.col(x).alias(f"__c_{x}") for x in cap.columns])
    cond = ((F.col("organization_id") == F.col("__c_organization_id"))
            & (F.col("report_type") == F.col("__c_report_type"))
            & F.col("AgeGroup").eqNullSafe(F.col("__c_AgeGroup")) & F.col("Time").eqNullSafe(F.col("__c_Time")))
    return (used.join(c, cond)
            .select("report_id", F.col("AgeGroup").alias("age_group"), F.col("Time").alias("time"),
                    rc.label_when("Accredited", *rc.ACCREDITED_LABELS).alias("accredited"),
                    rc.label_when("TitleI", *rc.TITLE_I_LABELS).alias("title_i"),
                    F.col("Rate").alias("rate"), F.col("__c_capacity").alias("capacity"), "utilization"))


def _header(rep: DataFrame, n_sub: DataFrame) -> DataFrame:
    """Contractor, period text, weeks, fees, number of subsidies (A18), date, file stem (K7)."""
    return rep.join(n_sub, "report_id", "left").select(
        "report_id", F.col("name").alias("contractor"),
        F.concat(long_date("period_start", pad_day=True), F.lit(" - "), long_date("period_end", pad_day=True))
        .alias("reporting_period"),
        weeks_inclusive("period_start", "period_end").alias("number_of_weeks"),
        F.col("FamilyFeesRevenue").alias("family_fees"),
        F.coalesce(F.col("n_subsidies"), F.lit(0)).cast("bigint").alias("n_subsidies"),
        F.col("C4KRevenue").alias("subsidies"), us_date("SubmittedAt").alias("date"),
        F.concat_ws(" ", F.col("name"), month_year("period"), F.lit(REPORT_SUFFIX)).alias("file_stem"))


__all__ = ["billing_report", "report_frame", "active_fundings", "child_subsidies", "subsidies_per_report"]
