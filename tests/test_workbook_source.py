"""The roster workbooks as a data source (S2-S5) and the report workbooks as a data source writer (K7)."""
import datetime as dt
import io
import tracemalloc
import zipfile

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, StringContains
from test_billing import _model
from test_reconcile import write_workbook

from rosterflow.plans import billing
from rosterflow.sinks import report_workbooks as rw
from rosterflow.sources import workbook_source as ws
from rosterflow.sources.workbooks import ROSTER_SECTIONS, Section, Workbook, extract_workbooks, list_workbooks, read_roster_folder, roster_frames, section_rows


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("books")
    for i in range(6):
        write_workbook(d / f"org{i}.xlsx", f"month {i}", [(f"S{i}{k}", "Lee", "Ann", None, None, "L1", "PS", 1.5 * k, dt.date(2019, 7, 1), None, 3, 100 * k) for k in range(4 + i)],
                       [(100.0 + i, 1, 20.25), (None, None, 10.0)] if i % 2 else [])
    (d / "~org.xlsx").write_bytes(b"a lock")
    (d / ".keep").write_text("")
    return str(d)


def test_same_rows_as_the_binary_reader(spark, folder):
    ws.register(spark)
    got = spark.read.format("roster_workbooks").load(folder)
    want = extract_workbooks(list_workbooks(spark, folder))
    assert rows(got) == rows(want) and got.count() > 50
    frames, old = read_roster_folder(spark, folder), roster_frames(want)
    assert all(rows(frames[n]) == rows(old[n]) for n in old)


def test_only_asked_sections_are_parsed(spark, folder, monkeypatch):
    opened = []
    monkeypatch.setattr(Workbook, "rows", lambda self, sheet, f=Workbook.rows: opened.append(sheet) or f(self, sheet))
    def read(options, filters=(), names=("source", "section", "row_no", "cells", "date1904")):
        opened.clear()
        reader = ws.WorkbookReader({"path": folder} | options, ws.EXTRACT_SCHEMA.__class__([f for f in ws.EXTRACT_SCHEMA if f.name in names]))
        left = list(reader.pushFilters(list(filters)))
        found = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
        return found, left
    all_rows, _ = read({})
    assert opened == [None, "Enrollee Roster"] * 6
    found, left = read({"sections": "roster"})
    assert set(opened) == {"Enrollee Roster"} and found == [r for r in all_rows if r["section"] == "roster"]
    other = StringContains(("source",), "1")
    found, left = read({}, [EqualTo(("section",), "totals"), In(("source",), ("org1.xlsx", "org3.xlsx")), other])
    assert opened == [None, None] and left == [other] and {r["source"] for r in found} == {"org1.xlsx", "org3.xlsx"} and len(found) == 12
    assert read({}, [EqualTo(("section",), "nothing")])[0] == [] and not opened
    assert read({"sections": "header"}, names=("source", "cells"))[0][0] == {"source": "org5.xlsx", "cells": ["month 5"]} or opened
    with pytest.raises(ValueError, match="no such section"):
        read({"sections": "rooster"})


def test_filters_of_a_query_reach_the_source(spark, folder):
    ws.register(spark)
    df = spark.read.format("roster_workbooks").load(folder).where("section = 'header' and source in ('org0.xlsx', 'org2.xlsx')")
    assert rows(df, "source", "cells") == [("org0.xlsx", ["month 0"]), ("org2.xlsx", ["month 2"])]
    custom = ws.layout_option([Section("corner", "range", "A1:B2", sheet="Enrollee Roster"), Section("label", "cell", "G4")])
    df = spark.read.format("roster_workbooks").option("layout", custom).load(folder)
    assert df.where("section = 'corner'").count() == 12 and df.where("cells[0] is null and section = 'corner'").count() == 12


def test_files_are_packed_by_size(folder):
    assert ws.packed([("a", 50), ("b", 200), ("c", 50), ("d", 40)], ws.OPEN_COST * 2 + 120) == [["b"], ["a", "c"], ["d"]]
    small = ws.WorkbookReader({"path": folder, "maxPartitionBytes": "1"}, ws.EXTRACT_SCHEMA)
    assert [len(p.paths) for p in small.partitions()] == [1] * 6
    assert [len(p.paths) for p in ws.WorkbookReader({"path": folder}, ws.EXTRACT_SCHEMA).partitions()] == [6]


def test_a_large_sheet_is_read_row_by_row():
    data, n = io.BytesIO(), 30_000
    book = rw.BookWriter(data, [("Summary", [("a", False)]), ("Enrollee Roster", [(f"c{i}", i > 0) for i in range(13)])])
    for i in range(n):
        book.add(1, [f"text {i}", *map(str, range(12))])
    book.close()
    tracemalloc.start()
    found = sum(1 for _ in section_rows(Workbook(data), ROSTER_SECTIONS[1:2]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    with zipfile.ZipFile(data) as z:
        size = z.getinfo("xl/worksheets/sheet2.xml").file_size
    assert found == n + 1 - 5 and peak < size / 3


def sheets_of(path):
    book = Workbook(str(path))
    return [name for name, _ in book.sheets], [[cells for _, cells in book.rows(name)] for name, _ in book.sheets]


def test_one_workbook_per_report(spark, tmp_path):
    t = _model(spark)
    billing.generate_reports(t, str(tmp_path), fmt="xlsx")
    sections = billing.billing_report(t)
    stems = {r["report_id"]: r["file_stem"] for r in sections["header"].collect()}
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith("_")) == sorted(f"{s}.xlsx" for s in stems.values())
    for report, stem in stems.items():
        names, sheets = sheets_of(tmp_path / f"{stem}.xlsx")
        assert names == list(rw.SHEETS)
        roster = sections["roster"].where(F.col("report_id") == report).orderBy("line_no").collect()
        assert list(sheets[1][0].values()) == list(billing.ROSTER_HEADERS.values())
        assert [row[0] for row in sheets[1][1:]] == [str(r["line_no"]) for r in roster] and [row.get(2) for row in sheets[1][1:]] == [r["last_name"] for r in roster]
        assert [row[0] for row in sheets[2][1:]] == [str(n) for n in range(1, 13)]
        assert sheets[0][1][0] == sections["header"].where(F.col("report_id") == report).first()["contractor"]


def report_rows(spark, files, bad=None):
    data = [(f, s, 0, [None if s else "<a & \x01b>", str(i)]) for f in files for s in range(2) for i in range(3)]
    df = spark.createDataFrame(data, rw.ROWS)
    if bad:
        df = df.withColumn("cells", F.when(F.col("file") == bad, F.array(F.lit("one cell too few"))).otherwise(F.col("cells")))
    return df


def write(df, out):
    df.sparkSession.dataSource.register(rw.ReportWorkbooks)
    sheets = '[["one", [["t", false], ["n", true]]], ["two", [["t", false], ["n", true]]]]'
    df.repartition(3, "file").sortWithinPartitions("file", "sheet").write.format("report_workbooks").option("sheets", sheets).mode("append").save(str(out))


def test_written_again_others_stay_and_failures_leave_nothing(spark, tmp_path):
    write(report_rows(spark, [f"r{i}.xlsx" for i in range(20)]), tmp_path)
    before = {p.name: p.stat().st_mtime_ns for p in tmp_path.glob("*.xlsx")}
    assert len(before) == 20
    assert sheets_of(tmp_path / "r3.xlsx") == (["one", "two"], [[{0: "t", 1: "n"}, *[{0: "<a & b>", 1: str(i)} for i in range(3)]], [{0: "t", 1: "n"}, *[{1: str(i)} for i in range(3)]]])
    write(report_rows(spark, ["r3.xlsx", "new.xlsx"]), tmp_path)
    after = {p.name: p.stat().st_mtime_ns for p in tmp_path.glob("*.xlsx")}
    assert {n for n in after if before.get(n) != after[n]} == {"r3.xlsx", "new.xlsx"}
    with pytest.raises(Exception):
        write(report_rows(spark, [f"r{i}.xlsx" for i in range(20)] + ["bad.xlsx"], "bad.xlsx"), tmp_path)
    assert {p.name: p.stat().st_mtime_ns for p in tmp_path.glob("*.xlsx")} == after
    assert not [p for p in (tmp_path / "_staging").rglob("*") if p.is_file()]
