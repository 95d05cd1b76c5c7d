"""The roster folder as a file stream: each workbook is ingested exactly once."""
import datetime as dt
import tempfile
from pathlib import Path

from conftest import rows
from rosterflow.streaming.roster_ingest import ingest_rosters, read_ingested
from test_reconcile import write_workbook


def test_incremental_ingest_exactly_once(spark):
    base = Path(tempfile.mkdtemp(prefix="rf-stream-"))
    src = base / "in"
    src.mkdir()
    e = dt.date(2019, 6, 3)
    write_workbook(src / "a.xlsx", "July 29, 2019 to August 30, 2019",
                   [("S1", "Lee", "Ann", None, None, "L1", "PS", 1.0, e, None, 2, 1000)], [(1.0, None, 2.0)])
    out, ck = str(base / "out"), str(base / "ck")
    ingest_rosters(spark, str(src), out, ck)
    write_workbook(src / "b.xlsx", "September 2, 2019 to September 27, 2019",
                   [("S2", "Kim", "Di", None, None, "L2", "IT", 1.0, e, None, 3, 2000)], [(3.0, None, 4.0)])
    (src / "~b.xlsx").write_bytes(b"lock file")
    ingest_rosters(spark, str(src), out, ck)
    ingest_rosters(spark, str(src), out, ck)          # nothing new: no duplicates
    got = read_ingested(spark, out)
    assert rows(got["roster"], "source", "sasid") == [("a.xlsx", "S1"), ("b.xlsx", "S2")]
    assert rows(got["header"], "source", "psr_format") == [
        ("a.xlsx", "July 29, 2019 to August 30, 2019"), ("b.xlsx", "September 2, 2019 to September 27, 2019")]


def test_one_file_per_micro_batch(spark):
    base = Path(tempfile.mkdtemp(prefix="rf-stream2-"))
    src = base / "in"
    src.mkdir()
    e = dt.date(2019, 6, 3)
    for i, name in enumerate(["a.xlsx", "b.xlsx", "c.xlsx"]):
        write_workbook(src / name, "July 29, 2019 to August 30, 2019",
                       [(f"S{i}", "Lee", "Ann", None, None, "L1", "PS", 1.0, e, None, 2, 1000)], [(1.0, None, 2.0)])
    out = str(base / "out")
    ingest_rosters(spark, str(src), out, str(base / "ck"), max_files_per_trigger=1)
    got = read_ingested(spark, out)["roster"]
    assert rows(got, "sasid") == [("S0",), ("S1",), ("S2",)]
    assert got.select("batch_id").distinct().count() == 3          # one micro-batch per file
