"""Readers and writers: birth dates CSV (S8), org restriction (K2), text dates (K5), report sections (K7),
report filter (P16), past reports (O4)."""
import datetime as dt
import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from conftest import rows
from rosterflow.sinks.target import restrict_to_organizations, text_dates, write_report_sections
from rosterflow.sources.files import read_birthdates


def test_read_birthdates(spark):
    p = Path(tempfile.mkdtemp(prefix="rf-bd-")) / "sasid-fill.csv"
    p.write_text("SASID,Birthdate\n123,07/04/2016\n123,07/04/2016\n456,13/45/2016\n")
    assert rows(read_birthdates(spark, str(p))) == [("123", dt.date(2016, 7, 4)), ("456", None)]


def test_restrict_to_organizations(spark):
    tables = {
        "Organization": spark.createDataFrame([(1, "A"), (2, "B")], "organization_id int, Name string"),
        "Site": spark.createDataFrame([(10, 1), (20, 2)], "site_id int, OrganizationId int"),
        "Family": spark.createDataFrame([(100, 1), (200, 2)], "family_id int, OrganizationId int"),
        "Child": spark.createDataFrame([(7, 100, 1), (8, 200, 2)], "child_id int, FamilyId int, OrganizationId int"),
    }
    out = restrict_to_organizations(tables, spark.createDataFrame([(2,)], "id int"))
    assert rows(out["Organization"], "Name") == [("B",)]
    assert rows(out["Child"], "child_id") == [(8,)] and rows(out["Site"], "site_id") == [(20,)]


def test_text_dates_and_sections(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3, 4, 5))], "report_id int, d date, t timestamp")
    assert rows(text_dates(df, ["d"], ["t"]), "d", "t") == [("2020-01-02", "2020-01-02T03:04:05")]
    out = tempfile.mkdtemp(prefix="rf-sections-")
    write_report_sections({"header": df}, out)
    assert spark.read.parquet(out + "/header").count() == 1
    assert (Path(out) / "header" / "report_id=1").exists()
    write_report_sections({"header": df.withColumn("report_id", F.lit(2))}, out)      # report 1 stays
    write_report_sections({"header": df.withColumn("d", F.lit(None).cast("date"))}, out)
    assert rows(spark.read.parquet(out + "/header"), "report_id", "d") == [(1, None), (2, dt.date(2020, 1, 2))]
    text = tempfile.mkdtemp(prefix="rf-sections-")
    write_report_sections({"header": df}, text, "csv", {"header": {"d": "Date"}})
    assert spark.read.option("header", True).csv(text + "/header").columns == ["Date", "t", "report_id"]


def test_birth_dates_with_one_digit(spark, tmp_path):
    from rosterflow.sources.files import read_birthdates
    (tmp_path / "b.csv").write_text("SASID,Birthdate\nS1,1/5/2015\nS2,12/25/2016\nS3,02/03/2014\n")
    assert rows(read_birthdates(spark, str(tmp_path / "b.csv")), "SASID", "Birthdate") == [
        ("S1", dt.date(2015, 1, 5)), ("S2", dt.date(2016, 12, 25)), ("S3", dt.date(2014, 2, 3))]


def test_workbook_names(spark):
    from rosterflow.sources.workbooks import is_workbook
    names = ["a.xlsx", "B.XLSX", "c.xlsm", "~$a.xlsx", ".keep", "report"]
    df = spark.createDataFrame([(f"file:/x/{n}",) for n in names], "path string")
    assert rows(df.where(is_workbook())) == sorted((f"file:/x/{n}",) for n in ("a.xlsx", "B.XLSX", "c.xlsm", "report"))


def test_report_filter_and_past_reports(spark):
    from rosterflow.plans import billing, billing_queries
    tm = billing_queries.target_model(spark, "/root/testdata/sf0.001")
    ids = tm["report"].select("Id").orderBy("Id").limit(3)
    hdr = billing.billing_report(tm, ("header",), report_ids=ids)["header"]
    assert rows(hdr, "report_id") == rows(ids)


def test_read_rates_and_typed(spark):
    from rosterflow.sources.files import read_rates, typed
    from rosterflow.sources.lookups import RATES_CSV, rates
    p = Path(tempfile.mkdtemp(prefix="rf-rates-")) / "rates.csv"
    p.write_text(RATES_CSV)
    df = read_rates(spark, str(p))
    assert df.schema == rates(spark).schema and rows(df) == rows(rates(spark))
    raw = spark.createDataFrame([("1", "2019-07-01", "x"), ("y", "bad", "z")], "a string, d string, s string")
    assert rows(typed(raw, {"a": "int", "d": "date"})) == [(None, None, "z"), (1, dt.date(2019, 7, 1), "x")]


def test_excel_date_cells(spark):
    from rosterflow.sources.workbooks import excel_date
    df = spark.createDataFrame([("43647",), ("1e15",), ("2019-07-01",), ("x",), (None,)], "c string")
    assert [r.d for r in df.select(excel_date("c").alias("d")).collect()] == [
        dt.date(2019, 7, 1), None, dt.date(2019, 7, 1), None, None]       # serial, overflow, ISO, text, empty


def test_workbook_with_shared_strings(spark):
    import zipfile
    from rosterflow.sources.workbooks import Section, extract_workbooks, list_workbooks
    d = Path(tempfile.mkdtemp(prefix="rf-xlsx-"))
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(d / "book.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/'
                                      '2006/relationships"><sheets><sheet name="Main" sheetId="1" r:id="rId7"/>'
                                      '</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId7" Target="/xl/worksheets/main.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst {ns}><si><t>July 1, 2019 to July 26, 2019</t></si>'
                                           '<si><r><t>Rich </t></r><r><t>text</t></r></si></sst>')
        z.writestr("xl/worksheets/main.xml", f'<worksheet {ns}><sheetData><row r="4"><c r="G4" t="s"><v>0</v></c>'
                                             '</row><row r="6"><c r="B6" t="s"><v>1</v></c><c r="C6"><v>42.5</v>'
                                             '</c><c r="D6" t="str"><v>formula text</v></c></row></sheetData>'
                                             '</worksheet>')
    secs = (Section("header", "cell", "G4"), Section("rows", "rows", skip=5, width=4))
    got = rows(extract_workbooks(list_workbooks(spark, str(d)), secs), "section", "row_no", "cells")
    assert got == [("header", 0, ["July 1, 2019 to July 26, 2019"]),
                   ("rows", 0, [None, "Rich text", "42.5", "formula text"])]


def test_excel_date_1904_system(spark):
    from rosterflow.sources.workbooks import excel_date
    df = spark.createDataFrame([("0", True), ("0", False), ("42185", True), (None, True)], "c string, f boolean")
    assert [r.d for r in df.select(excel_date("c", "f").alias("d")).collect()] == [
        dt.date(1904, 1, 1), dt.date(1899, 12, 30), dt.date(2019, 7, 1), None]
