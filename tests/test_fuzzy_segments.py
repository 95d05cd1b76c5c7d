"""J6 for larger distances: the segment index against every pair, and its number of keys."""
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rosterflow.operators import fuzzy


@pytest.mark.parametrize("k", [2, 3, 4])
def test_segments_find_every_pair(spark, k):
    rng = random.Random(k)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(0, 14))) for _ in range(120)]

    def edited(s):
        s = list(s)
        for _ in range(rng.randint(0, k + 1)):
            at = rng.randint(0, len(s))
            s[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "x"])
        return "".join(s)
    left = spark.createDataFrame([(s,) for s in base] + [(None,)], "l string")
    right = spark.createDataFrame([(edited(s),) for s in base for _ in range(2)] + [(None,)], "r string")
    got = rows(fuzzy.fuzzy_key_pairs(left, right, k), "lkey", "rkey", "dist")
    every = left.distinct().crossJoin(right.distinct()).withColumn("d", F.levenshtein("l", "r")).where(F.col("d") <= k)
    assert got == rows(every, "l", "r", "d") and len(got) > 150


def test_keys_depend_on_the_distance_alone(spark):
    lengths = [10, 40, 160, 640]
    df = spark.createDataFrame([("".join(chr(97 + i * i % 23) for i in range(n)),) for n in lengths], "s string")
    for k in (2, 3):
        counts = [r["n"] for r in df.select(F.size(fuzzy._windows("s", k)).alias("n")).collect()]
        assert max(counts) <= (2 * k + 1) * (k + 1) * (k + 1) and counts[-1] <= counts[1] + 5
        assert {r["n"] for r in df.select(F.size(fuzzy._segments("s", k)).alias("n")).collect()} == {k + 1}


def test_candidates_stay_near_the_matches(spark):
    """1,000 codes of 12 digits a side: few pairs are compared that are not within the distance."""
    rng = random.Random(9)
    codes = ["".join(rng.choice("0123456789") for _ in range(12)) for _ in range(1_000)]
    near = [c[:3] + "x" + c[4:-1] for c in codes]
    left = spark.createDataFrame([(c,) for c in codes], "lkey string").select("lkey", F.explode(fuzzy._segments("lkey", 2)).alias("v"))
    right = spark.createDataFrame([(c,) for c in near], "rkey string").select("rkey", F.explode(fuzzy._windows("rkey", 2)).alias("v"))
    assert left.join(right, "v").select("lkey", "rkey").distinct().count() < 5_000
    assert fuzzy.fuzzy_key_pairs(left.select("lkey"), right.select("rkey"), 2).count() >= 1_000
