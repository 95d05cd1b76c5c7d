"""K1: the load as a versioned upsert - new, changed, equal and twin rows, and loads that end half way."""
import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rosterflow.operators.keys import number_rows
from rosterflow.session import drop_stored, ensure_checkpoint_dir
from rosterflow.sinks import target
from rosterflow.sinks.target import LoadConflict, ParquetStore, TableSpec, load_target, match_rows

SPEC = {"Organization": "organization_id long, Name string", "Family": "family_id long, OrganizationId long, nk_person string, Town string",
        "Child": "child_id long, Sasid string, FirstName string, FamilyId long, OrganizationId long",
        "Enrollment": "enrollment_id long, AgeGroup int, Entry string, Exit string, nk_facility string, ChildId long, SiteId long",
        "Site": "site_id long, Name string, nk_facility string, OrganizationId long",
        "Funding": "funding_id long, Source int, FirstReportingPeriodId int, LastReportingPeriodId int, EnrollmentId long"}


def tables(spark, fundings, town="Hartford", names=("Alpha",)):
    n = range(1, len(names) + 1)
    data = {"Organization": [(i, names[i - 1]) for i in n], "Family": [(i, i, "kid", town) for i in n],
            "Child": [(i, "S1", "Ann", i, i) for i in n], "Site": [(i, "site", "F1", i) for i in n],
            "Enrollment": [(i, 1, "2019-07-01", None, "F1", i, i) for i in n],
            "Funding": [(100 + k, 0, first, last, 1) for k, (first, last) in enumerate(fundings)]}
    return {name: spark.createDataFrame(data[name], SPEC[name]) for name in SPEC}


def fundings(spark, out):
    return rows(ParquetStore(out).read(spark, "Funding"), "Id", "FirstReportingPeriodId", "LastReportingPeriodId")


def test_twins_of_one_enrollment_are_matched_by_what_they_say(spark, tmp_path):
    out = str(tmp_path)
    load_target(tables(spark, [(5, 6), (9, None)]), out)
    assert fundings(spark, out) == [(1, 5, 6), (2, 9, None)]
    load_target(tables(spark, [(2, 3), (5, 6), (9, 12)]), out)          # one sorts before, one is closed
    assert fundings(spark, out) == [(1, 5, 6), (2, 9, 12), (3, 2, 3)]
    load_target(tables(spark, [(9, 12), (5, 6), (2, 3)]), out)          # equal in another order: nothing is written
    assert fundings(spark, out) == [(1, 5, 6), (2, 9, 12), (3, 2, 3)]
    assert spark.read.parquet(f"{out}/Funding").where("LoadVersion = 3").count() == 0


def test_twins_of_equal_keys_pair_up_one_for_one(spark, tmp_path):
    out = str(tmp_path)
    load_target(tables(spark, [(5, 6), (5, 6), (5, 8)]), out)
    load_target(tables(spark, [(5, 6), (5, 6), (5, 6), (5, 9), (5, 10)]), out)
    # two equal ones stay, a third copy or a changed end takes the place of (5, 8), the others are new
    got = fundings(spark, out)
    assert got[:2] == [(1, 5, 6), (2, 5, 6)] and len(got) == 5
    assert sorted(r[1:] for r in got) == [(5, 6), (5, 6), (5, 6), (5, 9), (5, 10)]


def test_changed_rows_keep_their_ids_and_links(spark, tmp_path):
    out = str(tmp_path)
    load_target(tables(spark, [(5, 6)], "Hartford", ("Alpha", "Gamma")), out)
    maps = load_target(tables(spark, [(5, 6)], "Bristol", ("Alpha", "Beta", "Gamma")), out)
    store = ParquetStore(out)
    assert rows(store.read(spark, "Family"), "Id", "OrganizationId", "Town") == [(1, 1, "Bristol"), (2, 2, "Bristol"), (3, 3, "Bristol")]
    assert rows(store.read(spark, "Child"), "Id", "FamilyId") == [(1, 1), (2, 2), (3, 3)]
    assert rows(maps["Organization"], "LocalId", "Id") == [("1", 1), ("2", 3), ("3", 2)]
    # the folder keeps the history
    assert spark.read.parquet(f"{out}/Family").where("Id = 1").count() == 2
    assert store.commits(spark) == {1: ["Organization", "Site", "Family", "Child", "Enrollment", "Funding"]} | {2: store.commits(spark)[1]}


@pytest.mark.parametrize("dies_at", ["Family", "Funding", "commit"])
def test_a_killed_load_shows_nothing_and_runs_again(spark, tmp_path, monkeypatch, dies_at):
    out = str(tmp_path)
    load_target(tables(spark, [(5, 6), (9, None)]), out)
    before = {name: rows(ParquetStore(out).read(spark, name)) for name in SPEC}
    write, commit = ParquetStore.write, ParquetStore.commit

    def dying_write(self, df, name, partition, version):
        if name == dies_at:
            raise RuntimeError("killed")
        write(self, df, name, partition, version)

    def dying_commit(self, *args):
        raise RuntimeError("killed")

    second = tables(spark, [(2, 3), (5, 6), (9, 12)], "Bristol", ("Alpha", "Beta"))
    with monkeypatch.context() as m:
        m.setattr(ParquetStore, "commit", dying_commit) if dies_at == "commit" else m.setattr(ParquetStore, "write", dying_write)
        with pytest.raises(RuntimeError, match="killed"):
            load_target(second, out)
    assert {name: rows(ParquetStore(out).read(spark, name)) for name in SPEC} == before      # all or none
    load_target(second, out)
    assert fundings(spark, out) == [(1, 5, 6), (2, 9, 12), (3, 2, 3)]
    assert rows(ParquetStore(out).read(spark, "Organization"), "Id", "Name") == [(1, "Alpha"), (2, "Beta")]
    assert ParquetStore(out).read(spark, "Family").count() == 2 and commit is ParquetStore.commit


def test_two_loads_cannot_commit_the_same_version(spark, tmp_path):
    store = ParquetStore(str(tmp_path))
    store.commit(spark, 1, ["Organization"])
    with pytest.raises(LoadConflict):
        store.commit(spark, 1, ["Organization"])


def test_a_folder_that_no_load_made_is_not_taken_for_a_first_load(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/Organization")
    with pytest.raises(RuntimeError, match="no load has committed"):
        ParquetStore(str(tmp_path)).read(spark, "Organization")


@pytest.mark.parametrize("window_rows", [1_000_000, 0])
def test_matching_against_brute_force(spark, monkeypatch, window_rows):
    """Multisets of (key, digest) on both sides, through windows and through global numbers."""
    monkeypatch.setattr(target, "WINDOW_ROWS", window_rows)
    rng = random.Random(8)
    key = lambda: rng.choice("aaaaabcdefghij") + str(rng.randrange(4))
    new = [(key(), rng.choice("xyz"), i) for i in range(300)]
    old = [(key(), rng.choice("xyz"), 1_000 + i) for i in range(250)]
    got = match_rows(spark.createDataFrame(new, "SourceKey string, Digest string, row long"), spark.createDataFrame(old, "SourceKey string, Digest string, Id long"), ["row"])
    want = []
    for k in sorted({k for k, _, _ in new}):
        mine, theirs = [r for r in new if r[0] == k], [r for r in old if r[0] == k]
        for d in "xyz":
            for r in [r for r in mine if r[1] == d]:
                like = next((o for o in theirs if o[1] == d), None)
                if like:
                    theirs.remove(like)
                    mine.remove(r)
                    want.append((r[2], like[2], False))
        for i, r in enumerate(mine):
            want.append((r[2], theirs[i][2], True) if i < len(theirs) else (r[2], None, None))
    assert rows(got, "row", "Id", "Changed") == sorted(want)


def test_a_key_that_a_third_of_all_rows_share(spark, tmp_path):
    spec = TableSpec("Organization", "organization_id", ("Name",))
    first = spark.range(900).select(F.col("id").alias("organization_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("Name"),
                                    F.col("id").alias("Size"))
    second = first.withColumn("Size", F.when(F.col("organization_id") % 30 == 0, -1).otherwise(F.col("Size"))).unionByName(
        spark.range(900, 910).select(F.col("id").alias("organization_id"), F.lit("hot").alias("Name"), F.col("id").alias("Size")))
    store = ParquetStore(str(tmp_path))
    target._load([spec], {"Organization": first}, store)
    target._load([spec], {"Organization": second}, store)
    got = store.read(spark, "Organization")
    assert got.count() == 910 and got.select("Id").distinct().count() == 910
    assert sorted(r["Size"] for r in got.collect()) == sorted(r["Size"] for r in second.collect())


@pytest.mark.parametrize("per_range", [7, 50, 10_000])
def test_numbering_without_a_checkpoint(spark, per_range):
    rng = random.Random(per_range)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b", "ab"]), i) for i in range(400)]
    df = spark.createDataFrame(data, "a int, b string, c long").repartition(5)
    got = number_rows(df, ["a", "b", "c"], id_col="no", start=11, rows_per_range=per_range)
    order = sorted(data, key=lambda r: [(x is not None, x) for x in r])
    assert [tuple(r) for r in got.orderBy("no").collect()] == [(*r, 11 + i) for i, r in enumerate(order)]


def test_numbering_in_several_ranges_keeps_the_working_columns_of_the_load(spark):
    data = [(f"a-{i}", i, i % 7) for i in range(200)]
    df = spark.createDataFrame(data, "__rf_local string, __rf_pid int, k int")
    got = number_rows(df, ["k", "__rf_local"], id_col="no", rows_per_range=20)
    order = sorted(data, key=lambda r: (r[2], r[0]))
    assert [tuple(r) for r in got.orderBy("no").collect()] == [(*r, 1 + i) for i, r in enumerate(order)]


def test_gates_are_observed_while_the_roster_is_written(spark):
    """V1, V4: the same results as the rules' own aggregates, without a second look at the rows."""
    from rosterflow.operators import quality
    from rosterflow.plans import reconcile as rc
    data = [(f"f{i % 5}", i, "Alpha" if i % 5 != 3 or i % 2 else "Beta", i % 4 == 0, f"L{i}", "L0") for i in range(60)]
    enr = spark.createDataFrame(data, "source string, row_no int, org_name string, inexact boolean, license_no string, program_license_no string")
    enr = enr.withColumn("fuzzy", F.col("inexact").cast("int")).drop("inexact")
    looked = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            looked.add(len(b))
            yield b
    watched = enr.mapInPandas(counted, enr.schema)
    kept, results = rc.checked_roster(watched)
    want = quality.check(spark, rc.gates(enr))
    assert rows(results) == rows(want) and [r["n"] for r in results.orderBy("rule").collect()] == [15, 1]
    assert rows(kept) == rows(enr) and looked.value == len(data)
    with pytest.raises(quality.QualityGateError, match="f3"):
        quality.enforce(results)


def test_load_leaves_no_intermediate_tables(spark, tmp_path, monkeypatch):
    """What a load stores on its way is dropped, also where windows do not rank the twins; the key maps are the caller's."""
    monkeypatch.setattr(target, "WINDOW_ROWS", 0)
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file://"))
    before = set(folder.iterdir())
    maps = load_target(tables(spark, [(5, 6), (9, None)]), str(tmp_path))
    assert len(set(folder.iterdir()) - before) == len(maps)
    drop_stored(*maps.values())
    maps = load_target(tables(spark, [(2, 3), (5, 6), (9, 12)]), str(tmp_path))
    assert len(set(folder.iterdir()) - before) == len(maps)
    assert maps["Funding"].count() == 3
    drop_stored(*maps.values())
    assert set(folder.iterdir()) == before
    assert fundings(spark, str(tmp_path)) == [(1, 5, 6), (2, 9, 12), (3, 2, 3)]
