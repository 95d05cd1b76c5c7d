"""Monthly roster workbooks as one distributed read.

All workbooks of a folder are read with the ``binaryFile`` source (lock files
``~...`` and non-workbooks skipped, S2); one task per file parses the OOXML parts
with the standard library inside ``mapInPandas`` and emits long rows
``(source, section, row_no, cells)``. Typing, tagging (S4) and column selection
(S5) then happen in Spark. No per-file driver loop.

Memory per task is bounded by ``spark.sql.files.maxPartitionBytes`` (the
binary source packs whole files into partitions up to that size), and each
file is parsed on its own.
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
      "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}

EXTRACT_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("section", T.StringType()),
    T.StructField("row_no", T.IntegerType()), T.StructField("cells", T.ArrayType(T.StringType())),
    T.StructField("date1904", T.BooleanType()),
])


@dataclass(frozen=True)
class Section:
    """What to pull from each workbook.

    ``kind`` is ``cell`` (``ref`` like ``G4``), ``range`` (``ref`` like ``H32:L37``)
    or ``rows`` (all rows of the sheet after ``skip`` rows, ``width`` columns).
    ``sheet`` is a sheet name, or ``None`` for the first sheet.
    """
    name: str
    kind: str
    ref: str = ""
    sheet: str | None = None
    skip: int = 0
    width: int = 0


# --- fixed values: the roster workbook layout --------------------------------------
ROSTER_SECTIONS = (
    Section("header", "cell", "G4"),
    Section("roster", "rows", sheet="Enrollee Roster", skip=5, width=13),
    Section("totals", "range", "H32:L37"),
)
ROSTER_COLUMNS = ["sasid", "last_name", "first_name", "c4k_case_no", "c4k", "license_no", "age_group",
                  "reimbursement_rate", "enrollment_date", "termination_date", "no_in_family", "annual_income"]
ROSTER_TYPES = {"reimbursement_rate": "double", "no_in_family": "double", "annual_income": "double"}
ROSTER_DATES = ["enrollment_date", "termination_date"]
TOTALS_COLUMNS = ["family_fees", "c4k_count", "c4k_revenue"]
EXCEL_EPOCH = "1899-12-30"
EXCEL_EPOCH_1904 = "1904-01-01"
# ------------------------------------------------------------------------------------


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _split_ref(ref: str) -> tuple[int, int]:
    m = re.fullmatch(r"([A-Z]+)(\d+)", ref)
    return int(m.group(2)) - 1, _col_index(m.group(1))


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


class Workbook:
    """Cell values of an .xlsx (OOXML) package, read sheet by sheet and row by row; ``file`` is seekable and binary."""

    def __init__(self, file):
        self.zf = zipfile.ZipFile(file)
        self._shared: list[str] | None = None
        wb = ET.fromstring(self.zf.read("xl/workbook.xml"))
        pr = wb.find("m:workbookPr", NS)
        self.date1904 = pr is not None and pr.get("date1904") in ("1", "true")
        rels = ET.fromstring(self.zf.read("xl/_rels/workbook.xml.rels"))
        targets = {r.get("Id"): r.get("Target") for r in rels.findall("pr:Relationship", NS)}
        self.sheets: list[tuple[str, str]] = []
        for s in wb.find("m:sheets", NS).findall("m:sheet", NS):
            target = targets[s.get(f"{{{NS['r']}}}id")].lstrip("/")
            self.sheets.append((s.get("name"), target if target.startswith("xl/") else "xl/" + target))

    def shared(self, i: int) -> str:
        """A shared string; their table is read when the first one is met."""
        if self._shared is None:
            self._shared = []
            if "xl/sharedStrings.xml" in self.zf.namelist():
                with self.zf.open("xl/sharedStrings.xml") as f:
                    for _, e in ET.iterparse(f):
                        if _local(e.tag) == "si":
                            self._shared.append("".join(t.text or "" for t in e.iter() if _local(t.tag) == "t"))
                            e.clear()
        return self._shared[i]

    def rows(self, sheet: str | None) -> Iterator[tuple[int, dict[int, str]]]:
        """(row, {column: text}) of the rows with a value, from 0; one row is held at a time. ``None`` is the first sheet."""
        path = self.sheets[0][1] if sheet is None else dict(self.sheets)[sheet]
        with self.zf.open(path) as f:
            for _, e in ET.iterparse(f):
                if _local(e.tag) != "row":
                    continue
                number, cells = None, {}
                for c in e:
                    t, value = c.get("t"), None
                    if t == "inlineStr":
                        value = "".join(x.text or "" for x in c.iter() if _local(x.tag) == "t")
                    else:
                        v = next((x for x in c if _local(x.tag) == "v"), None)
                        if v is not None and v.text is not None:
                            value = self.shared(int(v.text)) if t == "s" else v.text
                    if value is not None:
                        number, column = _split_ref(c.get("r"))
                        cells[column] = value
                e.clear()
                if cells:
                    yield number, cells


def section_rows(book: Workbook, sections) -> Iterator[tuple[str, int, list]]:
    """(section, row_no, cells) of the asked sections; a sheet that none of them needs is not opened."""
    for sheet in dict.fromkeys(sec.sheet for sec in sections):
        own = [sec for sec in sections if sec.sheet == sheet]
        single, at, counted, done = {}, {}, dict.fromkeys((s.name for s in own), 0), {}
        for sec in own:
            if sec.kind == "cell":
                single[sec.name], done[sec.name] = _split_ref(sec.ref), [None]
            elif sec.kind == "range":
                at[sec.name] = [_split_ref(x) for x in sec.ref.split(":")]
        # rows below the last one that is asked for need not be read
        last = None if any(s.kind == "rows" for s in own) else max([r for r, _ in single.values()] + [b[0] for _, b in at.values()])
        for row, cells in book.rows(sheet):
            if last is not None and row > last:
                break
            for sec in own:
                if sec.kind == "cell" and row == single[sec.name][0]:
                    done[sec.name] = [cells.get(single[sec.name][1])]
                elif sec.kind == "range":
                    (r0, c0), (r1, c1) = at[sec.name]
                    if r0 <= row <= r1:
                        for gap in range(counted[sec.name], row - r0):
                            yield sec.name, gap, [None] * (c1 - c0 + 1)
                        yield sec.name, row - r0, [cells.get(c) for c in range(c0, c1 + 1)]
                        counted[sec.name] = row - r0 + 1
                elif sec.kind == "rows" and row >= sec.skip:
                    yield sec.name, counted[sec.name], [cells.get(c) for c in range(sec.width)]
                    counted[sec.name] += 1
        for name, cells in done.items():
            yield name, 0, cells
        for name, ((r0, c0), (r1, c1)) in at.items():
            for gap in range(counted[name], r1 - r0 + 1):
                yield name, gap, [None] * (c1 - c0 + 1)


def _extract_one(source: str, data: bytes, sections) -> list[tuple]:
    book = Workbook(io.BytesIO(data))
    return [(source, name, row_no, cells, book.date1904) for name, row_no, cells in section_rows(book, sections)]


def extract_workbooks(files: DataFrame, sections=ROSTER_SECTIONS) -> DataFrame:
    """S3: ``binaryFile`` rows -> long cell rows, one task per file batch (Arrow)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                rows.extend(_extract_one(path.rsplit("/", 1)[-1], bytes(content), sections))
            yield pd.DataFrame(rows, columns=["source", "section", "row_no", "cells", "date1904"])
    return files.select("path", "content").mapInPandas(run, EXTRACT_SCHEMA)


def is_workbook(path="path"):
    """Every file but ``.keep`` and lock files (``~...``), whatever its suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    return ~name.startswith("~") & (name != ".keep")


def list_workbooks(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """The workbooks of a folder; ``pattern`` is an optional glob. A file that is no workbook fails the read."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder).where(is_workbook())


def excel_date(col, date1904=None) -> "F.Column":
    """Excel serial day (1900, or 1904 when ``date1904`` is true) or ISO text -> DATE; else NULL."""
    c = F.col(col) if isinstance(col, str) else col
    serial = c.try_cast("double")
    epoch = F.to_date(F.lit(EXCEL_EPOCH))
    if date1904 is not None:
        flag = F.col(date1904) if isinstance(date1904, str) else date1904
        epoch = F.when(F.coalesce(flag, F.lit(False)), F.to_date(F.lit(EXCEL_EPOCH_1904))).otherwise(epoch)
    return F.coalesce(F.date_add(epoch, F.floor(serial).try_cast("int")),
                      F.try_to_date(c))  # type: ignore[attr-defined]


def roster_frames(cells: DataFrame) -> dict[str, DataFrame]:
    """Typed header, roster and totals frames from extracted cells.

    Roster: the first column is skipped, 7 text columns, rate, 2 dates, 2 numbers
    (the 13th column skipped). Totals: columns H, J, L of the range (S5).
    Every row carries its ``source`` file (S4).
    """
    header = cells.where(F.col("section") == "header").select("source", F.col("cells")[0].alias("psr_format"))
    r = cells.where(F.col("section") == "roster")
    roster = r.select("source", "row_no", "date1904",
                      *[F.col("cells")[i + 1].alias(n) for i, n in enumerate(ROSTER_COLUMNS)])
    for c, t in ROSTER_TYPES.items():
        roster = roster.withColumn(c, F.col(c).try_cast(t))
    for c in ROSTER_DATES:
        roster = roster.withColumn(c, excel_date(c, "date1904"))
    roster = roster.drop("date1904")
    totals = cells.where(F.col("section") == "totals").select(
        "source", *[F.col("cells")[i].try_cast("double").alias(n) for i, n in zip((0, 2, 4), TOTALS_COLUMNS)])
    return {"header": header, "roster": roster, "totals": totals}


def read_roster_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """S2-S5 in one call through the ``roster_workbooks`` source: each frame opens the sheets of its section only."""
    from .workbook_source import register
    register(spark)

    def cells(section: str) -> DataFrame:
        return spark.read.format("roster_workbooks").option("sections", section).load(folder)

    return {name: roster_frames(cells(name))[name] for name in ("header", "roster", "totals")}
