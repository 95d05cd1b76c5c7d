"""Dyadic nodes (J11, J12), mergeable distinct counts (A9, A21), statistics from one read."""
import datetime as dt
import random
import re

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from rosterflow.operators import bitmaps, dyadic, periods, stats
from rosterflow.plans import analysis as an


def test_cover_and_path_meet_once(spark):
    rng = random.Random(1)
    spans = [(rng.randint(-40, 1200), rng.randint(-40, 1200)) for _ in range(300)]
    spans += [(0, 0), (5, 4), (-32768, 32767), (-99999, 99999), (7, 32767), (None, 3), (3, None)]
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(spans)], "i int, lo int, hi int").select("i", dyadic.cover("lo", "hi").alias("nodes"))
    covers = {r["i"]: r["nodes"] for r in df.collect()}
    points = [*range(-45, 1210, 7), -32768, 32767]
    paths = {r["p"]: set(r["nodes"]) for r in spark.createDataFrame([(p,) for p in points], "p int").select("p", dyadic.path("p").alias("nodes")).collect()}
    for i, (lo, hi) in enumerate(spans):
        if lo is None or hi is None:
            assert covers[i] is None
            continue
        assert len(covers[i]) <= 2 * dyadic.LEVELS
        for p in points:
            assert len(paths[p] & set(covers[i])) == (lo <= p <= hi)


def test_long_spells_cost_few_rows(spark):
    """1,000 periods: at most 2 log n rows a spell instead of one for each period."""
    facts = spark.range(200).select(F.col("id").alias("f"), (F.col("id") % 3).alias("org"), (F.col("id") % 50).cast("int").alias("first"),
                                    F.when(F.col("id") % 4 > 0, (1000 + F.col("id") % 30).cast("int")).alias("last"))
    reps = spark.range(0, 1100).select(F.col("id").cast("int").alias("p"), (F.col("id") % 3).alias("org"))
    emitted = facts.select(F.size(dyadic.cover("first", "coalesce(last, 32767)")).alias("n")).agg(F.max("n"), F.sum("n")).first()
    assert emitted[0] <= 2 * dyadic.LEVELS and emitted[1] < 200 * 20
    got = periods.active_in_period(facts, reps, "org", "first", "last", "p")
    want = sum(1 for f in range(200) for p in range(1100) if p % 3 == f % 3 and f % 50 <= p and (f % 4 == 0 or p <= 1000 + f % 30))
    assert got.count() == want
    assert not re.search("BroadcastNestedLoop|Cartesian|Subquery", got._jdf.queryExecution().executedPlan().toString())


def test_distinct_counts_merge(spark):
    rng = random.Random(3)
    data = [(dt.date(2018 + rng.randrange(3), rng.randint(1, 12), rng.randint(1, 28)) if rng.random() < 0.9 else None,
             rng.choice([None, *range(400)]), rng.choice(["x", "yy", None, "z"]), dt.date(2019, rng.randint(1, 12), 3)) for _ in range(3_000)]
    df = spark.createDataFrame(data, "d date, i int, s string, e date")
    months = an.monthly_bitmaps(df, {"ids": ("d", "i"), "texts": ("d", "s"), "e": ("e", "i")})
    for kind, d, i in (("ids", "d", "i"), ("texts", "d", "s"), ("e", "e", "i")):
        want = rows(an.monthly_distinct(df, d, i))
        assert rows(an.monthly_counts(months).where(F.col("kind") == kind).drop("kind")) == want and want
    totals = an.school_year_counts(an.monthly_bitmaps(df, {"students": ("d", "i"), "enrollments": ("e", "s")}, an.is_through_february("d")))
    want = an.school_year_totals(df, "d", "i", "e", "s")
    assert rows(totals, "school_year", "students", "enrollments") == rows(want, "school_year", "students", "enrollments")
    part = an.school_year_totals(an.through_february(df, "d"), "d", "i", "e", "s")
    assert rows(an.partial_totals(totals)) == rows(part, "school_year", "students", "enrollments")
    years = ["2018-2019", "2017-2018"]
    assert rows(an.forecast_of_counts(totals, years, "2019-2020", ["2017-2018"])) == rows(an.ytd_forecast(want, part, years, "2019-2020", ["2017-2018"]))


def test_a_new_month_only_adds_its_bitmaps(spark):
    df = spark.range(5_000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 1_000).alias("i"))
    old, new = bitmaps.id_bitmaps(df.where("k < 2"), ["k"], "i"), bitmaps.id_bitmaps(df.where("k = 2"), ["k"], "i")
    merged = bitmaps.merge_bitmaps(old.unionByName(new), [F.lit(0).alias("all")])
    assert rows(bitmaps.count_bitmaps(merged, ["all"])) == [(0, df.select("i").distinct().count())]
    dense = bitmaps.dense_ids(spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "s string"), "s")
    assert rows(dense) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("window", [1_000_000, 10])
def test_describe_reads_once(spark, monkeypatch, window):
    monkeypatch.setattr(stats, "WINDOW_VALUES", window)
    rng = np.random.default_rng(4)
    values = [None if v < -2 else float(1e9 + round(v, 2)) for v in rng.normal(size=700)]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "g long, v double")
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(len(b))
            yield b
    got = stats.describe(df.mapInPandas(counted, df.schema), "v", group=["g"], sums={"nulls": F.col("v").isNull().cast("long")}).collect()
    assert reads.value == len(values) and len(got) == 3
    for r in got:
        own = np.array([v for i, v in enumerate(values) if i % 3 == r["g"] and v is not None])
        assert r["count"] == len(own) and r["nulls"] == sum(v is None for i, v in enumerate(values) if i % 3 == r["g"])
        assert np.allclose([r["mean"], r["std"], r["min"], r["q_25"], r["q_50"], r["q_75"], r["max"]],
                           [own.mean(), own.std(ddof=1), own.min(), *np.quantile(own, [0.25, 0.5, 0.75]), own.max()], rtol=1e-12, atol=1e-6)


def test_sketches_of_months_merge_within_their_rank_bound(spark):
    rng = np.random.default_rng(5)
    values = rng.integers(-10_000, 90_000, 40_000)
    df = spark.createDataFrame([(int(i % 12), int(v)) for i, v in enumerate(values)], "month int, v long")
    merged = stats.sketch_quantiles(stats.quantile_sketches(df, "v", ["month"]), [0.05, 0.25, 0.5, 0.75, 0.95]).first()
    assert merged["n"] == len(values)
    for q in (0.05, 0.25, 0.5, 0.75, 0.95):
        rank = (values <= merged[f"q_{round(q * 100)}"]).mean()
        assert abs(rank - q) <= 0.01
