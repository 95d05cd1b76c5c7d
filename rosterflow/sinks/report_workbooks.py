"""K7: billing reports as workbooks, one file per report with its four sections, through a Spark data source writer.

A task writes many reports, row by row, into its own folder under ``_staging``; the commit moves the files of the tasks that
ended into place, an abort deletes them. So a failed or repeated task leaves nothing, and reports that are not
written again stay as they are. Folders are any that ``pyarrow.fs`` opens by path or URI.
"""

from __future__ import annotations

import json
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.sax.saxutils import escape

import pyarrow.fs
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import NumericType, StructType

from ..sources.workbook_source import file_system

SHEETS = ("header", "roster", "income_groups", "spaces")
ROWS = "file string, sheet int, row_no bigint, cells array<string>"
_TYPES = ('<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
          '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
          '<Default Extension="xml" ContentType="application/xml"/>'
          '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{}</Types>')
_SHEET_TYPE = '<Override PartName="/xl/worksheets/sheet{}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE_RELS = "http://schemas.openxmlformats.org/package/2006/relationships"
#: What XML cannot hold.
_FORBIDDEN = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\uFFFE\uFFFF]")


def column_letters(i: int) -> str:
    out = ""
    while i >= 0:
        i, out = i // 26 - 1, chr(65 + i % 26) + out
    return out


class BookWriter:
    """An .xlsx package with one sheet for each of ``sheets`` (name, [(title, numeric)]), rows in order of the sheets."""

    def __init__(self, out, sheets: list[tuple[str, list[tuple[str, bool]]]]):
        self.zf, self.sheets, self.open, self.number, self.row = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED), sheets, None, -1, 0
        count = range(1, len(sheets) + 1)
        self.zf.writestr("[Content_Types].xml", _TYPES.format("".join(_SHEET_TYPE.format(i) for i in count)))
        self.zf.writestr("_rels/.rels", f'<Relationships xmlns="{_PACKAGE_RELS}"><Relationship Id="rId1" Type="{_RELS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        self.zf.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_RELS}"><sheets>' + "".join(
            f'<sheet name="{escape(name, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, (name, _) in zip(count, sheets, strict=True)) + "</sheets></workbook>")
        self.zf.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE_RELS}">' + "".join(
            f'<Relationship Id="rId{i}" Type="{_RELS}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in count) + "</Relationships>")

    def _to(self, sheet: int) -> None:
        while self.number < sheet:
            if self.open is not None:
                self.open.write(b"</sheetData></worksheet>")
                self.open.close()
            self.number, self.row = self.number + 1, 0
            self.open = self.zf.open(f"xl/worksheets/sheet{self.number + 1}.xml", "w")
            self.open.write(f'<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
            self._row([title for title, _ in self.sheets[self.number][1]], numeric=False)

    def _row(self, cells: list, numeric: bool = True) -> None:
        self.row += 1
        out = [f'<row r="{self.row}">']
        for i, (value, (_, number)) in enumerate(zip(cells, self.sheets[self.number][1], strict=True)):
            if value is None:
                continue
            ref = f"{column_letters(i)}{self.row}"
            if numeric and number:
                out.append(f'<c r="{ref}"><v>{value}</v></c>')
            else:
                out.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(_FORBIDDEN.sub("", value))}</t></is></c>')
        self.open.write("".join([*out, "</row>"]).encode())

    def add(self, sheet: int, cells: list) -> None:
        self._to(sheet)
        self._row(cells)

    def close(self) -> None:
        self._to(len(self.sheets) - 1)
        self.open.write(b"</sheetData></worksheet>")
        self.open.close()
        self.zf.close()


@dataclass
class Written(WriterCommitMessage):
    folder: str
    files: list[str] = field(default_factory=list)


class ReportWorkbooks(DataSource):
    """Options: ``path``; ``sheets`` (JSON: [name, [[title, numeric], ...]] for each sheet). Rows as in ``ROWS``, a file's
    rows in one task in order of sheet and row."""

    @classmethod
    def name(cls) -> str:
        return "report_workbooks"

    def schema(self) -> str:
        return ROWS

    def writer(self, schema: StructType, overwrite: bool) -> "ReportWriter":
        return ReportWriter(self.options["path"], json.loads(self.options["sheets"]))


class ReportWriter(DataSourceWriter):
    def __init__(self, path: str, sheets: list):
        self.path, self.sheets, self.load = path.rstrip("/"), sheets, uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> Written:
        fs, root = file_system(self.path)
        done = Written(f"{root}/_staging/{self.load}/{uuid.uuid4().hex}")
        fs.create_dir(done.folder)
        book = out = None
        try:
            for row in iterator:
                if not done.files or row["file"] != done.files[-1]:
                    if book:
                        book.close()
                        out.close()
                    done.files.append(row["file"])
                    out = fs.open_output_stream(f"{done.folder}/{row['file']}")
                    book = BookWriter(out, self.sheets)
                book.add(row["sheet"], row["cells"])
            if book:
                book.close()
                out.close()
        except BaseException:
            fs.delete_dir(done.folder)
            raise
        return done

    def commit(self, messages: list) -> None:
        fs, root = file_system(self.path)
        for message in filter(None, messages):
            for name in message.files:
                fs.move(f"{message.folder}/{name}", f"{root}/{name}")
        self._clear(fs, root)

    def abort(self, messages: list) -> None:
        self._clear(*file_system(self.path))

    def _clear(self, fs: pyarrow.fs.FileSystem, root: str) -> None:
        """Delete this load's staging folder, with what failed tasks have left there."""
        staging = f"{root}/_staging/{self.load}"
        if fs.get_file_info(staging).type == pyarrow.fs.FileType.Directory:
            fs.delete_dir(staging)


def write_report_workbooks(sections: dict[str, DataFrame], out_dir: str, headers: dict[str, dict], order: dict[str, list[str]], stem: str = "file_stem") -> None:
    """One workbook per report: the sections of ``SHEETS`` with the printed column names of ``headers``.

    ``order`` names the columns that order a section's rows. The header section gives each report its file name
    (its ``stem``, with the report's id where several have the same one). Only the reports in ``sections`` are
    replaced. A report's rows meet in one task, sorted and streamed; many reports share a task.
    """
    spark: SparkSession = sections["header"].sparkSession
    spark.dataSource.register(ReportWorkbooks)
    safe = F.regexp_replace(F.coalesce(F.col(stem), F.lit("report")), r'[\\/:*?"<>|\x00-\x1f]', "_")
    named = sections["header"].select("report_id", safe.alias("stem"))
    shared = named.groupBy("stem").agg(F.count(F.lit(1)).alias("n"))
    files = named.join(shared, "stem").select("report_id", F.concat(
        "stem", F.when(F.col("n") > 1, F.concat(F.lit(" ("), F.col("report_id").cast("string"), F.lit(")"))).otherwise(""), F.lit(".xlsx")).alias("file"))
    sheets, rows = [], None
    for i, name in enumerate(SHEETS):
        df = sections[name]
        columns = [c for c in df.columns if c in headers[name]]
        sheets.append((name, [(headers[name][c], isinstance(df.schema[c].dataType, NumericType)) for c in columns]))
        keys = [F.col(c) for c in order.get(name, [])]
        part = df.select("report_id", F.lit(i).alias("sheet"), F.struct(*[k.cast("string").alias(f"k{j}") for j, k in enumerate(keys)] or [F.lit("").alias("k0")]).alias("texts"),
                         F.coalesce(*[k.try_cast("double") for k in keys[:1]], F.lit(0.0)).alias("number"), F.array(*[F.col(c).cast("string") for c in columns]).alias("cells"))
        part = part.select("report_id", "sheet", "number", F.to_json("texts").alias("texts"), "cells")
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.join(files, "report_id")
    rows = rows.repartition("file").sortWithinPartitions("file", "sheet", "number", "texts", "cells")
    (rows.select("file", "sheet", F.lit(0).cast("bigint").alias("row_no"), "cells").write.format("report_workbooks")
         .option("sheets", json.dumps(sheets)).mode("append").save(out_dir))
