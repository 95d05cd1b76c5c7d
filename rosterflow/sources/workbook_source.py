"""Roster workbooks as a Spark data source: ``spark.read.format("roster_workbooks").load(folder)``.

Files are packed into partitions by size; a task opens one file at a time and parses it row by row, so it holds
neither a whole file nor a whole sheet. Sections that are not asked for (option ``sections``, or filters on
``section``) are not parsed, filters on ``source`` skip files, and with a schema without ``cells`` no cell is copied.
Folders are any that ``pyarrow.fs`` opens by path or URI (local, HDFS, object stores).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from .workbooks import EXTRACT_SCHEMA, ROSTER_SECTIONS, Section, Workbook, section_rows

#: Bytes of workbooks in a partition, unless the option ``maxPartitionBytes`` says otherwise; a larger file is one of its own.
PARTITION_BYTES = 128 << 20
#: What opening a file costs, as bytes, when files are packed.
OPEN_COST = 1 << 20
#: Rows that a task passes on at once.
BATCH_ROWS = 2_000


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)


def is_workbook_name(name: str) -> bool:
    """Every file but ``.keep`` and lock files (``~...``)."""
    return not name.startswith("~") and name != ".keep"


def packed(files: list[tuple[str, int]], limit: int) -> list[list[str]]:
    """Files (path, size) in groups of about ``limit`` bytes, the largest first."""
    groups: list[list] = []
    for path, size in sorted(files, key=lambda f: (-f[1], f[0])):
        size += OPEN_COST
        if groups and groups[-1][0] + size <= limit:
            groups[-1][0] += size
            groups[-1][1].append(path)
        else:
            groups.append([size, [path]])
    return [paths for _, paths in groups]


@dataclass
class Files(InputPartition):
    paths: list[str]


class RosterWorkbooks(DataSource):
    """Options: ``path``, ``sections`` (names of the roster's sections, comma-separated), ``layout`` (JSON list of
    :class:`Section` fields, for other workbooks), ``maxPartitionBytes``."""

    @classmethod
    def name(cls) -> str:
        return "roster_workbooks"

    def schema(self) -> StructType:
        return EXTRACT_SCHEMA

    def reader(self, schema: StructType) -> "WorkbookReader":
        return WorkbookReader(dict(self.options), schema)


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        unknown = [f.name for f in schema.fields if f.name not in EXTRACT_SCHEMA.names]
        if unknown:
            raise ValueError(f"no such column: {unknown[0]}")
        self.names = schema.names
        self.folder = options["path"]
        layout = options.get("layout")
        self.sections = [Section(**s) for s in json.loads(layout)] if layout else list(ROSTER_SECTIONS)
        if options.get("sections"):
            asked = {s.strip() for s in options["sections"].split(",")}
            if missing := asked - {s.name for s in self.sections}:
                raise ValueError(f"no such section: {sorted(missing)[0]}")
            self.sections = [s for s in self.sections if s.name in asked]
        self.limit = int(options.get("maxpartitionbytes", options.get("maxPartitionBytes", PARTITION_BYTES)))
        self.sources: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Equality and IN on ``section`` and ``source`` are answered here, the others are left to Spark."""
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is not None and f.attribute == ("section",):
                self.sections = [s for s in self.sections if s.name in values]
            elif values is not None and f.attribute == ("source",):
                self.sources = values if self.sources is None else self.sources & values
            else:
                yield f

    def partitions(self) -> list[Files]:
        fs, folder = file_system(self.folder)
        found = fs.get_file_info(pyarrow.fs.FileSelector(folder))
        files = [(f.path, f.size) for f in found if f.type == pyarrow.fs.FileType.File and is_workbook_name(f.base_name)
                 and (self.sources is None or f.base_name in self.sources)]
        return [Files(paths) for paths in packed(files, self.limit)] if self.sections else []

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        types = {"source": pa.string(), "section": pa.string(), "row_no": pa.int32(), "cells": pa.list_(pa.string()), "date1904": pa.bool_()}
        schema = pa.schema([(n, types[n]) for n in self.names])

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = dict(zip(types, zip(*rows, strict=True), strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[n], types[n]) for n in self.names], schema=schema)

        fs, _ = file_system(self.folder)
        rows: list[tuple] = []
        for path in partition.paths if partition else []:
            with fs.open_input_file(path) as file:
                book, source = Workbook(file), path.rsplit("/", 1)[-1]
                for section, row_no, cells in section_rows(book, self.sections):
                    rows.append((source, section, row_no, cells if "cells" in self.names else None, book.date1904))
                    if len(rows) >= BATCH_ROWS:
                        yield batch(rows)
                        rows = []
        if rows:
            yield batch(rows)


def register(spark: SparkSession) -> None:
    """Make ``roster_workbooks`` known to the session, and let its filters reach the source."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RosterWorkbooks)


def layout_option(sections: Iterable[Section]) -> str:
    """The value of the option ``layout`` for other sections than the roster's."""
    return json.dumps([asdict(s) for s in sections])
