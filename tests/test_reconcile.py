"""End-to-end fixture: workbooks + program list + database tables -> target model -> load (twice)."""
import datetime as dt
import tempfile
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rosterflow.operators import quality
from rosterflow.operators.periods import reporting_calendar
from rosterflow.plans import reconcile as rc
from rosterflow.sinks.target import load_target
from rosterflow.sources import lookups
from rosterflow.sources.files import PROGRAM_WIDTH, read_programs
from rosterflow.sources.workbooks import read_roster_folder

EPOCH = dt.date(1899, 12, 30)


def _col(i):
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _sheet(cells):
    """cells: {(row0, col0): value} -> worksheet xml (inline strings, numbers)."""
    by_row = {}
    for (r, c), v in cells.items():
        by_row.setdefault(r, []).append((c, v))
    out = ['<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>']
    for r in sorted(by_row):
        out.append(f'<row r="{r + 1}">')
        for c, v in sorted(by_row[r]):
            ref = f"{_col(c)}{r + 1}"
            if isinstance(v, (int, float)):
                out.append(f'<c r="{ref}"><v>{v}</v></c>')
            else:
                out.append(f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>')
        out.append("</row>")
    out.append("</sheetData></worksheet>")
    return "".join(out)


def write_workbook(path, label, roster_rows, totals):
    summary = {(3, 6): label}
    for i, (fees, count, rev) in enumerate(totals):
        for c, v in ((7, fees), (9, count), (11, rev)):
            if v is not None:
                summary[(31 + i, c)] = v
    roster = {}
    for i, row in enumerate(roster_rows):
        for c, v in enumerate(row, start=1):
            if v is None:
                continue
            roster[(5 + i, c)] = (v - EPOCH).days if isinstance(v, dt.date) else v
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml",
                   '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
                   'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>'
                   '<sheet name="Summary" sheetId="1" r:id="rId1"/><sheet name="Enrollee Roster" sheetId="2" r:id="rId2"/>'
                   '</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
                   '<Relationship Id="rId2" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", _sheet(summary))
        z.writestr("xl/worksheets/sheet2.xml", _sheet(roster))


def write_programs(path, programs):
    lines = [",".join(f"h{i}" for i in range(PROGRAM_WIDTH))]
    for contractor, name, town, lic, fac in programs:
        cells = [""] * PROGRAM_WIDTH
        cells[6], cells[32], cells[34], cells[36], cells[40] = f'"{contractor}"', name, town, lic, fac
        lines.append(",".join(cells))
    Path(path).write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def inputs(spark):
    d = Path(tempfile.mkdtemp(prefix="rf-rosters-"))
    (d / "rosters").mkdir()
    (d / "rosters" / ".keep").write_text("")
    e1, t1 = dt.date(2019, 6, 3), None
    # sasid, last, first, case, c4k, licence, age, rate, entry, exit, n, income, (skip)
    write_workbook(d / "rosters" / "a-aug.xlsx", "July 29, 2019 to August 30, 2019", [
        ("S1", "Lee", "Ann", "C4K-7", "Y", "DCCC1234", "PS", 150.0, e1, t1, 3, 40000),
        ("S1", "Lee", "Ann", "C4K-7", "Y", "DCCC1234", "PS", 150.0, e1, t1, 3, 40000),   # twice in one file
        (None, "Roe", "Bo", None, None, "DCCC1235", "IT", 160.0, e1, None, 2, 30000),
        ("S3", "Fox", "Cy", None, None, None, "SA", 100.0, e1, None, 4, 50000),  # no licence: dropped
    ], [(100.5, 1, 20.25), (None, None, 10.0)])
    write_workbook(d / "rosters" / "a-sep.xlsx", "September 2, 2019 to September 27, 2019", [
        ("S1", "Lee", "Ann", "C4K-7", "Y", "DCCC1234", "Preschool F/T", 150.0, e1, None, 3, 40000),
    ], [(50.0, None, None)])
    write_workbook(d / "rosters" / "b-aug.xlsx", "July 29, 2019 to August 30, 2019", [
        ("S9", "Kim", "Di", None, None, "XYZ99", "PS", 120.0, e1, dt.date(2019, 8, 20), 2, 20000),
    ], [(None, None, None)])
    (d / "rosters" / "~lock.xlsx").write_bytes(b"not a zip")
    write_programs(d / "programs.csv", [
        ("Big Org, Inc, Alpha Care", "Alpha Center", "Hartford", "DCCC1234", "F1"),
        ("Beta", "Beta Center", "Haddam", "XYZ99", "F2"),
        ("Gamma", "Gamma Center", "Nowhere", "Exempt", "F3"),
    ])
    return d


def test_workbooks_and_programs(spark, inputs):
    frames = read_roster_folder(spark, str(inputs / "rosters"))
    assert rows(frames["header"], "source") == [("a-aug.xlsx",), ("a-sep.xlsx",), ("b-aug.xlsx",)]
    r = frames["roster"]
    assert r.count() == 6
    assert rows(r.where("sasid = 'S1' and source = 'a-aug.xlsx'"), "enrollment_date", "no_in_family") == [
        (dt.date(2019, 6, 3), 3.0), (dt.date(2019, 6, 3), 3.0)]
    tot = frames["totals"].where("source = 'a-aug.xlsx'")
    assert tot.count() == 6                                            # H32:L37 is six rows
    assert rows(tot.where("family_fees is not null or c4k_revenue is not null"), "family_fees", "c4k_revenue") == [
        (None, 10.0), (100.5, 20.25)]
    progs = read_programs(spark, str(inputs / "programs.csv"))
    assert rows(progs, "name", "license_no", "org_name") == [
        ("Alpha Center", "DCCC1234", "Alpha Care"), ("Beta Center", "XYZ99", "Beta"), ("Gamma Center", None, "Gamma")]


def test_reconcile_end_to_end(spark, inputs):
    frames = read_roster_folder(spark, str(inputs / "rosters"))
    programs = read_programs(spark, str(inputs / "programs.csv"))
    cal = reporting_calendar(spark, dt.date(2019, 7, 1), dt.date(2029, 7, 1))
    enr = rc.psr_enrollment(frames["roster"], frames["header"], programs, cal)
    got = rows(enr, "source", "first_name", "program_license_no", "fuzzy", "period")
    assert got == [("a-aug.xlsx", "Ann", "DCCC1234", 0, 2), ("a-aug.xlsx", "Bo", "DCCC1234", 1, 2),
                   ("a-sep.xlsx", "Ann", "DCCC1234", 0, 3), ("b-aug.xlsx", "Di", "XYZ99", 0, 2)]
    assert rc.one_org_per_file(enr).count() == 0
    assert [r.message for r in rc.fuzzy_match_warnings(enr).collect()] == [
        "Fuzzy matched a child from file 'a-aug.xlsx' to Alpha Care; license number as written: DCCC1235, "
        "matched to: DCCC1234"]
    rev = rc.psr_revenue(frames["totals"], frames["header"], enr, cal)
    assert rows(rev) == [("Alpha Care", 2, 100.5, 30.25), ("Alpha Care", 3, 50.0, 0.0), ("Beta", 2, 0.0, 0.0)]
    orgs, sites = rc.organizations_and_sites(rev, programs, lookups.towns(spark))
    assert rows(sites, "name", "organization_id", "region", "title_i") == [
        ("Alpha Center", 1, "nc", False), ("Beta Center", 2, "sc", False)]

    db = _database(spark)
    flat = rc.enrollment_flat(db, sites)
    assert rows(flat, "SASID", "FundingType", "Asian", "White", "Foster", "AdditionalFundingSource",
                "BirthCertificateId") == [("S1", "CDC", 1, 1, 1, "Multiple Additional Funding Sources", "BC1")]
    first_start = cal.select(F.min("period_start")).first()[0]
    psr, late = rc.psr_students(enr, orgs, first_start)
    assert late.count() == 0
    assert rows(psr, "sasid") == [("S1",), ("S9",), ("TEMP-Bo-Roe",)]
    missing = rc.missing_from_database(psr, flat)
    assert rows(missing) == [("S9",), ("TEMP-Bo-Roe",)]
    db = rc.database_students(flat, rc.registered_flat(db, missing))
    students = rc.students_joined(psr, db)
    kids = rc.children(students)
    assert rows(kids, "Sasid", "Gender", "Asian", "HispanicOrLatinxEthnicity") == [
        ("S1", 1, True, True), ("S9", 0, False, None), ("TEMP-Bo-Roe", 4, False, None)]
    fams = rc.families(students)
    assert rows(fams, "AddressLine1") == [(None,), (None,), ("12 Main St",)]
    dets = rc.family_determinations(students)
    assert rows(dets, "NumberOfPeople", "DeterminationDate")[0] == (2.0, None)

    enrl, uniq, nonunique = rc.enrollments(enr, flat, kids, sites, cal, first_start)
    assert nonunique.count() == 0
    assert rows(enrl, "enrollment_id", "AgeGroup", "Exit", "ExitReason") == [
        (1, 1, None, None), (2, 1, dt.date(2019, 8, 20), "Unknown"), (3, 0, None, None)]
    assert rows(rc.fundings(uniq, enr, cal), "enrollment_id", "FundingSource", "FamilyId", "FirstReportingPeriodId",
                "LastReportingPeriodId", "FundingTime") == [
        (1, 0, None, 2, None, 0), (1, 1, 47.0, None, None, None), (2, 0, None, 2, 2, 0), (3, 0, None, 2, 2, 0)]
    funds = rc.fundings(uniq, enr, cal)
    assert funds.where("FundingSource = 1").count() == 1
    reports = rc.current_reports(orgs, enr)
    assert rows(reports, "organization_id", "ReportingPeriodId") == [(1, 4), (2, 4)]
    stamp = dt.datetime(2020, 1, 1, 9, 0)
    with_past = rc.current_reports(orgs, enr, rev, include_past=True, submitted_at=stamp)   # O4, F23
    assert rows(with_past, "report_id", "organization_id", "ReportingPeriodId", "C4KRevenue") == [
        (1, 1, 2, 30.25), (2, 2, 2, 0.0), (3, 1, 3, 0.0), (4, 1, 4, None), (5, 2, 4, None)]
    res = quality.check(spark, rc.gates(enr, late, nonunique))
    quality.enforce(res)   # no stop rule fires

    codes = [r["facility_code"] for r in sites.orderBy("site_id").collect()]
    for nothing in (None, {}):
        same_enrl, same_sites = rc.single_site_fix(enrl, sites, nothing)
        assert rows(same_sites, "site_id") == [(1,), (2,)] and rows(same_enrl) == rows(enrl)
    enrl_fixed, sites_fixed = rc.single_site_fix(enrl, sites, {codes[1]: codes[0]})
    assert rows(sites_fixed, "site_id") == [(1,)] and rows(enrl_fixed, "site_id") == [(1,), (1,), (1,)]
    out = tempfile.mkdtemp(prefix="rf-target-")
    tables = rc.to_target_tables(orgs, sites, fams, dets, kids, enrl, funds, reports)
    load_target(tables, out)
    load_target(tables, out)   # idempotent: second run adds nothing
    child = spark.read.parquet(out + "/Child")
    assert child.count() == 3
    assert rows(child, "Sasid") == [(None,), ("S1",), ("S9",)]          # K6: placeholder keys blanked
    counts = {name: spark.read.parquet(f"{out}/{name}").count() for name in tables}
    assert counts == {"Organization": 2, "Site": 2, "Family": 3, "FamilyDetermination": 3, "Child": 3,
                      "Enrollment": 3, "Funding": 4, "Report": 2}
    fund = spark.read.parquet(out + "/Funding").join(spark.read.parquet(out + "/Enrollment")
                                                     .select(F.col("Id").alias("EnrollmentId"), "ChildId"),
                                                     "EnrollmentId")
    assert fund.count() == 4                                             # K3: every funding points at a loaded row
    assert rows(spark.read.parquet(out + "/Site"), "Region") == [(1,), (3,)]


def _database(spark):
    ts = dt.datetime
    db = {
        "Student": spark.createDataFrame([(1, "S1", "F1"), (2, "S9", "F2")], "Id long, SASID string, RegisteringSiteId string"),
        "StudentDetails": spark.createDataFrame([(1, "Ann", None, "Lee", dt.date(2016, 1, 1), "F "),
                                                 (2, "Di", None, "Kim", None, "M ")],
                                                "StudentId long, FirstName string, MiddleName string, LastName string, "
                                                "Dob date, Gender string"),
        "Address": spark.createDataFrame([(1, 1, "foster parent ", "12", "Main St", None, "Hartford", "CT", "06100", "b"),
                                          (2, 1, "Home", "9", "Old Rd", None, "Hartford", "CT", "06100", "a")],
                                         "Id long, StudentId long, AddressType string, StreetNumber string, "
                                         "Address1 string, Address2 string, Town string, State string, Zip string, "
                                         "ModifiedBy string"),
        "Race": spark.createDataFrame([(1, "Asian"), (1, "White"), (1, "Hispanic"), (1, "White")],
                                      "StudentId long, RaceCode string"),
        "EditableFieldValues": spark.createDataFrame([(1, 3, "BC1"), (1, 4, "CT")],
                                                     "StudentId long, EditableFieldId int, Value string"),
        "Enrollment": spark.createDataFrame([(10, 1, "F1", dt.date(2019, 6, 3), None, None, None),
                                             (11, 2, "F9", dt.date(2019, 6, 3), None, None, None)],
                                            "Id long, StudentId long, FacilityCode string, EnrollmentDate date, "
                                            "FacilityExitDate date, ExitCategory string, ExitReason string"),
        "EnrollmentFunding": spark.createDataFrame([
            (100, 10, "CDC", "Preschool Full Time", dt.date(2019, 7, 1), None, ts(2019, 7, 1), ts(2019, 7, 2)),
            (101, 10, "CDC", "Preschool Full Time", dt.date(2019, 7, 1), None, ts(2019, 7, 1), ts(2019, 7, 1))],
            "Id long, EnrollmentId long, FundingType string, SpaceType string, StartDate date, EndDate date, "
            "DateCreated timestamp, ModifiedDate timestamp"),
        "AdditionalFundingSources": spark.createDataFrame([(10, "A"), (10, "B")],
                                                          "EnrollmentId long, AdditionalFundingType string"),
        "AdditionalStudentInfo": spark.createDataFrame(
            [(1, 1, 3, 40000.5, ts(2019, 1, 1), "true"), (2, 1, 3, 1.0, None, "FALSE")],
            "ID long, StudentId long, NumberOfPeopleInHousehold int, AnnualFamilyIncome double, "
            "DateFamilyIncomeDocumented timestamp, FamilyIncomeNotDisclosed string"),
    }
    return db


def test_run_migration_entry_point(spark, inputs):
    out = tempfile.mkdtemp(prefix="rf-migration-")
    maps = rc.run_migration(spark, str(inputs / "rosters"), str(inputs / "programs.csv"), _database(spark), out,
                            dt.date(2019, 7, 1), dt.date(2029, 7, 1))
    assert rows(maps["gates"], "rule", "n") == [("inexact licence match", 1), ("key given after appearing without one", 0),
                                                ("one organization per file", 0), ("person x age group unique", 0),
                                                ("towns key unique", 0)]
    assert spark.read.parquet(out + "/Child").count() == 3
    assert spark.read.parquet(out + "/Site").count() == 2          # no site is dropped without a mapping
    reports = spark.read.parquet(out + "/Report").join(spark.read.parquet(out + "/ReportingPeriod").select(F.col("Id").alias("ReportingPeriodId"), "Period"), "ReportingPeriodId")
    assert rows(reports, "Period") == [(dt.date(2019, 10, 1),), (dt.date(2019, 10, 1),)]      # K4: target period ids
    assert spark.read.parquet(out + "/Child").where("Guid is null").count() == 0
    assert maps["Funding"].count() == 4
    dup_dates = spark.createDataFrame([("S1", dt.date(2016, 1, 1)), ("S1", dt.date(2016, 2, 2))],
                                      "SASID string, Birthdate date")
    with pytest.raises(quality.QualityGateError):          # V6: a duplicated fill key would fan rows out
        rc.run_migration(spark, str(inputs / "rosters"), str(inputs / "programs.csv"), _database(spark),
                         tempfile.mkdtemp(prefix="rf-migration-"), dt.date(2019, 7, 1), dt.date(2029, 7, 1),
                         birthdates=dup_dates)


def test_rows_of_both_kinds_of_fundings_are_made_once(spark):
    looked = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            looked.add(len(b))
            yield b
    data = [(i, "F1", "PS", "C7" if i % 2 else None, None, None, 1, 1, 1 if i % 2 else None) for i in range(1, 9)]
    uniq = spark.createDataFrame(data, "enrollment_id long, facility_code string, age_group string, c4k_case_no string, termination_date date, FacilityExitDate date, "
                                 "first_observed_psr_period int, last_observed_psr_period int, last_observed_c4k_period int")
    seen = spark.createDataFrame([(1,), (2,)], "period int")
    out = rc.fundings(uniq.mapInPandas(counted, uniq.schema), seen, reporting_calendar(spark, dt.date(2019, 7, 1), dt.date(2019, 9, 1)))
    assert rows(out, "funding_id", "enrollment_id", "FundingSource", "LastReportingPeriodId") == [
        *[(i, i, 0, 1) for i in range(1, 9)], *[(8 + k, i, 1, None) for k, i in enumerate((1, 3, 5, 7), 1)]]
    assert looked.value == len(data)


def test_roster_rows_of_a_licence_are_not_gathered_to_match_it(spark):
    """The best program is found once per licence as written; the rows join it where they are."""
    none = None
    programs = spark.createDataFrame([("L100", "b", "Org B"), ("L200", "a", "Org A"), ("L201", "c", "Org C")], "license_no string, name string, org_name string").select(
        "name", "org_name", *[F.lit(none).cast("string").alias(c) for c in ("address", "town", "zip", "naeyc_id", "registry_id", "facility_code")], "license_no")
    data = [("f", i, f"S{i}", "Ann", "Lee", licence) for i, licence in enumerate(["L100", "L10", "L202", "L20", "Z9", None])]
    data.append(("f", 9, "S1", "Ann", "Lee", "L201"))              # the same person under another licence, exactly
    roster = spark.createDataFrame(data, "source string, row_no long, sasid string, first_name string, last_name string, license_no string")
    header = spark.createDataFrame([("f", "none")], "source string, psr_format string")
    cal = reporting_calendar(spark, dt.date(2019, 7, 1), dt.date(2019, 9, 1))
    enr = rc.psr_enrollment(roster, header, programs, cal)
    assert rows(enr, "sasid", "row_no", "license_no", "program_license_no", "fuzzy", "org_name") == [
        ("S0", 0, "L100", "L100", 0, "Org B"), ("S1", 9, "L201", "L201", 0, "Org C"), ("S2", 2, "L202", "L200", 1, "Org A"), ("S3", 3, "L20", "L200", 1, "Org A")]
    plan = enr._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(license_no" not in plan and "levenshtein" not in plan


def test_unknown_period_makes_the_global_bound_null(spark):
    enr = spark.createDataFrame([("S1", 2, None, None, 3, "IT", 1, "7"), ("S2", None, None, None, 2, "PS", 1, None)],
                                "sasid string, period int, termination_date date, FacilityExitDate date, "
                                "last_observed_psr_period int, age_group string, site_id int, c4k_case_no string")
    uniq = enr.select("sasid", F.monotonically_increasing_id().alias("enrollment_id"),
                      F.lit(1).alias("first_observed_psr_period"), "last_observed_psr_period", "termination_date",
                      "FacilityExitDate", "age_group", "site_id", "c4k_case_no",
                      F.lit(None).cast("int").alias("last_observed_c4k_period"))
    cal = reporting_calendar(spark, dt.date(2019, 7, 1), dt.date(2020, 7, 1))
    funds = rc.fundings(uniq, enr, cal)
    # max(period) is NA -> "last < max" is NA -> no exit either -> LastReportingPeriodId stays NA
    assert rows(funds, "LastReportingPeriodId") == [(None,), (None,)]
    orgs = spark.createDataFrame([(1, "A")], "organization_id long, name string")
    assert rows(rc.current_reports(orgs, enr), "ReportingPeriodId") == [(None,)]


def test_same_name_without_key_in_two_files(spark):
    cols = ("source string, row_no int, sasid string, first_name string, last_name string, org_name string, "
            "period int, c4k_case_no string, c4k string, age_group string, reimbursement_rate double, "
            "enrollment_date date, termination_date date, no_in_family double, annual_income double")
    e1 = dt.date(2019, 6, 3)
    enr = spark.createDataFrame([
        ("f1", 0, None, "Bo", "Roe", "Alpha", 2, None, None, "IT", 1.0, e1, None, 2.0, 10.0),
        ("f2", 0, None, "Bo", "Roe", "Beta", 3, None, None, "PS", 1.0, e1, None, 2.0, 10.0),
        ("f2", 1, None, "Cy", "Fox", "Beta", None, None, None, "PS", 1.0, e1, None, 2.0, 10.0),   # unknown period
        ("f1", 1, None, "Cy", "Fox", "Alpha", 2, None, None, "PS", 1.0, e1, None, 2.0, 10.0)], cols)
    orgs = spark.createDataFrame([(1, "Alpha"), (2, "Beta")], "organization_id long, name string")
    psr, late = rc.psr_students(enr, orgs, dt.date(2019, 7, 1))
    # last row per name by period: NA sorts last in R, so Cy's unknown-period row wins
    assert rows(psr, "sasid", "organization_id", "age_group") == [("TEMP-Bo-Roe", 2, "PS"), ("TEMP-Cy-Fox", 2, "PS")]
    assert late.count() == 0


def test_second_load_with_a_row_in_between(spark):
    """K1: ids follow natural keys, so a row that sorts in between is added and nothing is loaded twice."""
    out = tempfile.mkdtemp(prefix="rf-natural-")

    def tables(names):
        orgs = spark.createDataFrame([(i + 1, n) for i, n in enumerate(sorted(names))], "organization_id long, Name string")
        fams = spark.createDataFrame([(i + 1, i + 1, f"kid of {n}") for i, n in enumerate(sorted(names))],
                                     "family_id long, OrganizationId long, nk_person string")
        return {"Organization": orgs, "Family": fams}

    load_target(tables(["Alpha", "Gamma"]), out)
    maps = load_target(tables(["Alpha", "Beta", "Gamma"]), out)
    assert rows(spark.read.parquet(out + "/Organization"), "Name", "Id") == [("Alpha", 1), ("Beta", 3), ("Gamma", 2)]
    assert rows(spark.read.parquet(out + "/Family"), "Id", "OrganizationId") == [(1, 1), (2, 2), (3, 3)]
    assert "nk_person" not in spark.read.parquet(out + "/Family").columns
    assert rows(maps["Organization"], "LocalId", "Id") == [("1", 1), ("2", 3), ("3", 2)]


def test_read_errors_are_not_taken_for_a_first_load(spark, tmp_path):
    from rosterflow.sinks.target import ParquetStore
    store = ParquetStore(str(tmp_path))
    assert store.read(spark, "Organization") is None
    (tmp_path / "Organization").mkdir()
    (tmp_path / "Organization" / "part-0.parquet").write_bytes(b"not a parquet file")
    with pytest.raises(Exception):
        store.read(spark, "Organization").count()


def test_workbooks_are_parsed_once(spark, inputs, monkeypatch):
    from rosterflow.sources import workbooks
    calls = []
    original = workbooks.extract_workbooks
    monkeypatch.setattr(workbooks, "extract_workbooks", lambda *a, **k: calls.append(1) or original(*a, **k))
    frames = []
    seen = workbooks.roster_frames
    monkeypatch.setattr(workbooks, "roster_frames", lambda cells: frames.append(cells) or seen(cells))
    rc.run_migration(spark, str(inputs / "rosters"), str(inputs / "programs.csv"), _database(spark),
                     tempfile.mkdtemp(prefix="rf-migration-"), dt.date(2019, 7, 1), dt.date(2029, 7, 1))
    assert len(calls) == 1 and len(frames) == 1
    plan = frames[0]._jdf.queryExecution().toString()
    assert "binaryFile" not in plan and "MapInPandas" not in plan       # later steps read the stored cells
