"""D11 on a hand-made target model: the report generator's quirks, row by row."""
import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from rosterflow.plans.billing import billing_report

D = dt.date


def _model(spark):
    t = {
        "report": spark.createDataFrame([(1, 0, None, 1, 2, 1, 500.0, 100.0)],
                                        "Id long, Type int, SubmittedAt timestamp, OrganizationId int, "
                                        "ReportingPeriodId int, Accredited int, C4KRevenue double, "
                                        "FamilyFeesRevenue double"),
        "organization": spark.createDataFrame([(1, "Org A")], "Id int, Name string"),
        "reporting_period": spark.createDataFrame(
            [(1, D(2019, 7, 1), D(2019, 7, 1), D(2019, 7, 28)), (2, D(2019, 8, 1), D(2019, 7, 29), D(2019, 9, 1))],
            "Id int, Period date, PeriodStart date, PeriodEnd date"),
        "site": spark.createDataFrame([(10, 1, "LIC1", 1, 0)],
                                      "Id int, OrganizationId int, LicenseNumber string, Region int, TitleI int"),
        "funding_space": spark.createDataFrame([(100, 1, 0, 0, 1, 20), (101, 1, 0, 0, 0, 5), (102, 1, 0, 0, 9, 7)],
                                               "Id int, OrganizationId int, Source int, Time int, AgeGroup int, "
                                               "Capacity int"),
        # children: a (two certificates), b (foster), c (family of 13), d (income at the limit), e (not active)
        "child": spark.createDataFrame([
            (1, "S1", "Ann", "Lee", 0, 11, 901), (2, "S2", "Bo", "Roe", 1, 12, None), (3, "S3", "Cy", "Fox", 0, 13, None),
            (4, "S4", "Di", "Kim", 0, 14, None), (5, "S5", "Ed", "Orr", 0, 15, 905), (6, "S6", "Fa", "Ng", 0, 16, None)],
            "Id int, Sasid string, FirstName string, LastName string, Foster int, FamilyId int, "
            "C4KFamilyCaseNumber int"),
        "enrollment": spark.createDataFrame([
            (21, 1, 10, 1, D(2019, 6, 1), None), (22, 2, 10, 1, D(2019, 6, 1), None), (23, 3, 10, 0, D(2019, 6, 1), None),
            (24, 4, 10, 1, D(2019, 6, 1), D(2019, 8, 20)), (25, 5, 10, 1, D(2019, 6, 1), D(2019, 7, 10)),
            (26, 6, 10, 9, D(2019, 6, 1), None)],                                  # age code 9: no label
            "Id int, ChildId int, SiteId int, AgeGroup int, Entry date, Exit date"),
        "funding": spark.createDataFrame([
            (31, 0, 21, 100, 1, None), (32, 0, 22, 100, 2, None), (33, 1, 23, 101, 1, 2), (34, 0, 24, 100, 2, 2),
            (35, 0, 25, 100, 1, 1), (36, 0, 26, 102, 2, None)],
            "Id int, Source int, EnrollmentId int, FundingSpaceId int, FirstReportingPeriodId int, "
            "LastReportingPeriodId int"),
        "family_determination": spark.createDataFrame([
            (41, 11, 3, 40000.0, D(2019, 1, 1)), (42, 11, 4, 99999.0, None),       # undated one loses (desc nulls last)
            (43, 12, 5, 80000.0, D(2019, 1, 1)), (44, 13, 13, 1000.0, D(2019, 1, 1)),
            (45, 14, 2, 57400.0, D(2019, 1, 1))],
            "Id int, FamilyId int, NumberOfPeople int, Income double, DeterminationDate date"),
        "c4k_certificate": spark.createDataFrame([
            (1, D(2019, 7, 15), D(2019, 7, 31)),      # overlaps period 2 (starts Jul 29)
            (1, D(2019, 9, 1), None),                 # touches period 2 on its last day, open
            (5, D(2019, 1, 1), D(2019, 7, 28)),       # ends the day before period 2: no overlap
            (5, D(2019, 9, 2), None),                 # starts after period 2
            (4, D(2019, 8, 20), D(2019, 8, 10)),      # inverted, yet start <= period end and end >= period start
            (4, D(2019, 9, 10), D(2019, 8, 5))],      # inverted, starts after the period: no overlap
            "ChildId int, StartDate date, EndDate date"),
    }
    return t


def test_billing_sections(spark):
    out = billing_report(_model(spark))
    roster = rows(out["roster"], "line_no", "sasid", "c4k", "c4k_family_id", "service", "weekly_rate", "n_in_family",
                  "annual_income", "eligible")
    # Ann appears twice (two overlapping certificates x one funding); sorted by age label, last, first name
    assert roster == [
        (1, "S3", "N", None, "FT Infant/Toddler", 169.95, 13, 1000.0, None),     # family of 13: no limit row
        (2, "S4", "N", None, "FT Preschool", 165.32, 2, 57400.0, "Y"),           # exactly at the 75% SMI limit
        (3, "S1", "Y", 901, "FT Preschool", 165.32, 3, 40000.0, "Y"),
        (4, "S1", "Y", 901, "FT Preschool", 165.32, 3, 40000.0, "Y"),
        (5, "S2", "N", None, "FT Preschool", 165.32, 1, 0.0, "Y"),               # foster: family of 1, income 0
        (6, "S6", "N", None, "FT NA", None, None, None, None),                   # NA age label sorts last
    ]
    inc = {r.family_size: (r.less_than_or_equal_to, r.n_families) for r in out["income_groups"].collect()}
    assert len(inc) == 12 and inc[3] == (41560, 1) and inc[1] == (24280, 1) and inc[2] == (32920, 0)
    spaces = rows(out["spaces"], "age_group", "time", "accredited", "title_i", "capacity", "utilization")
    assert spaces == [(None, "FT", "Acc.", "Standard", 7, 1),                 # NA matches NA (dplyr join)
                      ("Infant/Toddler", "FT", "Acc.", "Standard", 5, 1), ("Preschool", "FT", "Acc.", "Standard", 20, 3)]
    hdr = out["header"].collect()[0]
    assert (hdr.contractor, hdr.reporting_period, hdr.n_subsidies, hdr.subsidies, hdr.family_fees, hdr.date) == (
        "Org A", "July 29, 2019 - September 01, 2019", 3, 500.0, 100.0, None)
    assert abs(hdr.number_of_weeks - 5.0) < 1e-9 and hdr.file_stem == "Org A August 2019 CDC PSR"


def test_roster_lines_are_matched_and_numbered_without_their_texts(spark, monkeypatch):
    """A funding is in many reports: what is stored for each line are keys; texts are stored once a funding."""
    from rosterflow.plans import billing
    kept = []

    def watched(df, real=billing.stored):
        kept.append(real(df))
        return kept[-1]
    monkeypatch.setattr(billing, "stored", watched)
    t = _model(spark)
    one = t["report"]
    t["report"] = one.unionByName(one.withColumn("Id", F.lit(2).cast("long")).withColumn("ReportingPeriodId", F.lit(1)))
    out = billing_report(t, ("roster",))["roster"]
    assert rows(out, "report_id", "line_no", "sasid") == [(1, i + 1, s) for i, s in enumerate(["S3", "S4", "S1", "S1", "S2", "S6"])] + [
        (2, i + 1, s) for i, s in enumerate(["S3", "S1", "S5"])]
    assert kept and all({"report_id", "LastName"} - set(df.columns) for df in kept)


def _many_lines(spark, repeat_reports=False):
    """Two organizations of many fundings that tie, three periods, certificates that repeat, a child that is two rows."""
    t = _model(spark)
    n, org = 40, lambda c: 1 + c % 2
    t["organization"] = spark.createDataFrame([(1, "Org A"), (2, "Org B")], t["organization"].schema)
    one = t["report"].first().asDict()
    t["report"] = spark.createDataFrame([tuple((one | {"Id": 10 * o + p, "OrganizationId": o, "ReportingPeriodId": p})[c] for c in t["report"].columns)
                                         for o in (1, 2) for p in (1, 2) for _ in range(1 + repeat_reports)], t["report"].schema)
    space = t["funding_space"].first()["Id"]
    t["funding"] = spark.createDataFrame([tuple({"Id": 1000 + c // 2, "Source": 0, "EnrollmentId": c, "FundingSpaceId": space, "FirstReportingPeriodId": 1 + c % 3 // 2,
                                                "LastReportingPeriodId": None}[k] for k in t["funding"].columns) for c in range(n)], t["funding"].schema)
    enrolled, site, child = t["enrollment"].first().asDict(), t["site"].first().asDict(), t["child"].first().asDict()
    t["enrollment"] = spark.createDataFrame([tuple((enrolled | {"Id": c, "ChildId": c, "SiteId": 50 + org(c)})[k] for k in t["enrollment"].columns) for c in range(n)], t["enrollment"].schema)
    t["site"] = spark.createDataFrame([tuple((site | {"Id": 50 + o, "OrganizationId": o})[k] for k in t["site"].columns) for o in (1, 2)], t["site"].schema)
    t["child"] = spark.createDataFrame([tuple((child | {"Id": c, "Sasid": f"S{c}", "LastName": "ab"[c % 4 // 2], "FirstName": None, "C4KFamilyCaseNumber": c + 7})[k]
                                              for k in t["child"].columns) for c in [*range(n), 5]], t["child"].schema)
    days = {1: (D(2019, 1, 1), None), 2: (D(2030, 1, 1), None), 3: (None, None)}
    t["c4k_certificate"] = spark.createDataFrame([(c, *days[k]) for c in range(0, n, 5) for k in (1, 1, 2, 3)], t["c4k_certificate"].schema)
    return t


def test_roster_lines_are_numbered_in_ranges_without_being_shuffled(spark, monkeypatch):
    """Lines numbered by organization and range of fundings are those that are joined and numbered one by one."""
    from rosterflow.plans import billing
    monkeypatch.setattr(billing, "RANGE_PLACES", 7)
    t = _many_lines(spark)
    got = billing_report(t, ("roster",))["roster"]
    columns = [c for c in got.columns if c != "line_no"]
    report_lines = [(r.report_id, r.line_no) for r in got.collect()]
    for report in {r for r, _ in report_lines}:
        own = sorted(n for r, n in report_lines if r == report)
        assert own == list(range(1, len(own) + 1)) and len(own) > 10
    in_order = [(r.report_id, r.last_name) for r in got.orderBy("report_id", "line_no").collect()]
    assert in_order == sorted(in_order)
    # a child of two certificates in the period has two lines, that of two rows eight (four each)
    sizes = {r["sasid"]: r["count"] for r in got.where("report_id = 22").groupBy("sasid").count().collect()}
    assert sizes["S15"] == 2 and sizes["S5"] == 8 and sizes["S1"] == 1
    monkeypatch.setattr(billing, "BROADCAST_ROWS", 0)
    assert rows(billing_report(t, ("roster",))["roster"], *columns) == rows(got, *columns)
    monkeypatch.setattr(billing, "_numbered_lines", lambda spells, rep, t, n: billing._lines_of_repeated_reports(spells, rep, t))
    assert rows(billing_report(t, ("roster",))["roster"], *columns) == rows(got, *columns)
    monkeypatch.undo()
    plans = []
    monkeypatch.setattr(billing, "_with_rate", lambda df, real=billing._with_rate: plans.append(df) or real(df))
    billing_report(t, ("roster",))["roster"]
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.split("hashpartitioning(")[1:] if "report_id" in x.split("REPARTITION")[0].split("ENSURE")[0]]
    assert "row_number" in plan and not dealt      # the spells are dealt by organization and range, and no line moves to be numbered


def test_reports_of_several_rows_keep_all_their_lines(spark):
    once, twice = (billing_report(_many_lines(spark, r), ("roster",))["roster"].count() for r in (False, True))
    assert twice > 2 * once


def test_subsidies_per_report_matches_brute_force(spark):
    import random
    from rosterflow.plans.billing import child_subsidies, subsidies_per_report
    random.seed(11)
    base = D(2019, 7, 1)
    day = lambda n: base + dt.timedelta(days=n)
    certs = []
    for _ in range(300):
        s = day(random.randint(0, 200))
        e = random.choice([None, day(random.randint(0, 200))])           # open, valid or inverted
        certs.append((random.randint(1, 20), s if random.random() > 0.05 else None, e))
    reps = []
    for rid in range(1, 41):
        a = random.randint(0, 190)
        reps.append((rid, random.randint(1, 3), day(a), day(a + random.randint(0, 40))))
    fund = [(100 + c, c, 10 + (c % 3)) for c in range(1, 21)] + [(200 + c, c, 10 + (c % 3)) for c in range(1, 21, 4)]
    t = {"c4k_certificate": spark.createDataFrame(certs, "ChildId int, StartDate date, EndDate date"),
         "funding": spark.createDataFrame([(i, e) for i, e, _ in fund], "Id int, EnrollmentId int").withColumn(
             "EnrollmentId", F.col("EnrollmentId")),
         "enrollment": spark.createDataFrame([(c, c, s) for _, c, s in {(0, c, s) for _, c, s in fund}],
                                             "Id int, ChildId int, SiteId int"),
         "site": spark.createDataFrame([(10, 1), (11, 2), (12, 3)], "Id int, OrganizationId int"),
         "child": spark.createDataFrame([(c, c * 7) for c in range(1, 21)], "Id int, C4KFamilyCaseNumber int")}
    rep = spark.createDataFrame(reps, "report_id long, organization_id int, period_start date, period_end date")
    n_fund = {}
    for _, c, site in fund:
        n_fund[(site - 9, c)] = n_fund.get((site - 9, c), 0) + 1

    def overlaps(s, e, ps, pe):
        return s is not None and s <= pe and (e is None or e >= ps)
    want = {rid: sum(n_fund.get((org, c), 0) for c, s, e in certs if overlaps(s, e, ps, pe))
            for rid, org, ps, pe in reps}
    got = {r.report_id: r.n_subsidies for r in subsidies_per_report(rep, t).collect()}
    assert got == want
    pairs = spark.createDataFrame([(rid, org, c) for rid, org, _, _ in reps for c in range(1, 21)],
                                  "report_id long, organization_id int, ChildId int")
    per_child = {(r.report_id, r.ChildId): r.n_subsidy for r in child_subsidies(pairs, rep, t).collect()}
    for rid, org, ps, pe in reps:
        for c in range(1, 21):
            n = n_fund.get((org, c), 0) * sum(1 for cc, s, e in certs if cc == c and overlaps(s, e, ps, pe))
            assert per_child.get((rid, c), 0) == n


def test_generate_reports_writes_sections(spark):
    import tempfile
    from rosterflow.plans.billing import generate_reports
    out = tempfile.mkdtemp(prefix="rf-reports-")
    generate_reports(_model(spark), out)
    assert spark.read.parquet(out + "/roster").count() == 6
    assert spark.read.parquet(out + "/income_groups").count() == 12
    assert rows(spark.read.parquet(out + "/header"), "report_id", "n_subsidies") == [(1, 3)]
