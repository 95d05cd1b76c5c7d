"""Fixture tests for the NULL rules and the recodes / scalar functions (§2.8)."""
import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from rosterflow.functions import dates as d
from rosterflow.functions import nulls as n
from rosterflow.functions import recode as rc
from rosterflow.operators import dedupe, joins


def test_if_else_is_three_valued(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    out = df.select("x", n.if_else(F.col("x") > 2, "big", "small").alias("y"))
    assert rows(out) == [(None, None), (1, "small"), (3, "big")]


def test_in_list_never_null_and_negation_keeps_nulls(spark):
    df = spark.createDataFrame([("a",), (None,), ("c",)], "x string")
    assert rows(df.where(n.in_list("x", ["a"]))) == [("a",)]
    assert rows(df.where(n.not_in_list("x", ["a"]))) == [(None,), ("c",)]


def test_null_if_in_sentinels(spark):
    df = spark.createDataFrame([("Exempt",), ("?",), ("12345",), (None,)], "x string")
    assert rows(df.select(n.null_if_in("x", ["Exempt", "?"]).alias("x"))) == [(None,), (None,), (None,), ("12345",)]


def test_strict_min_max_and_sum_or_zero(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2), ("b", 5), ("c", None)], "k string, v int")
    out = df.groupBy("k").agg(n.strict_min("v").alias("lo"), n.strict_max("v").alias("hi"),
                              n.sum_or_zero("v").alias("s"))
    assert rows(out) == [("a", None, None, 1), ("b", 2, 5, 7), ("c", None, None, 0)]


def test_last_per_key_null_sort_key_wins(spark):
    df = spark.createDataFrame([("k", 1, 10), ("k", None, 11), ("k", 3, 12), ("j", 2, 1), ("j", 2, 2)],
                               "k string, p int, id int")
    out = dedupe.last_per_key(df, ["k"], ["p"], ["id"])
    assert rows(out) == [("j", 2, 2), ("k", None, 11)]


def test_null_safe_join_matches_null_keys(spark):
    left = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, None, None)], "id int, k1 string, k2 string")
    right = spark.createDataFrame([("a", None, 100), ("a", "x", 200), (None, None, 300)],
                                  "k1 string, k2 string, v int")
    out = joins.null_safe_join(left, right, ["k1", "k2"], "left", nullable=["k1", "k2"])
    assert rows(out, "id", "v") == [(1, 100), (2, 200), (3, 300)]


def test_fill_key_prints_na(spark):
    df = spark.createDataFrame([("123", "Ann", "Lee"), (None, "Bo", None)], "s string, f string, l string")
    assert rows(df.select(rc.fill_key("s", "f", "l").alias("k"))) == [("123",), ("TEMP-Bo-NA",)]


def test_gender_codes_need_the_trailing_blank(spark):
    df = spark.createDataFrame([("M ",), ("M",), (None,), ("X ",), ("F ",)], "g string")
    assert rows(df.select("g", rc.gender_code("g").alias("c"))) == [
        (None, 4), ("F ", 1), ("M", None), ("M ", 0), ("X ", None)]


def test_keep_if_any_ethnicity_rule(spark):
    df = spark.createDataFrame([(None, None, True), (False, False, True), (True, None, True), (None, False, True)],
                               "a boolean, b boolean, e boolean")
    out = df.select(rc.keep_if_any(["a", "b"], "e").alias("e"))
    assert [r.e for r in out.collect()] == [None, None, True, None]


def test_concat_or_null_street(spark):
    df = spark.createDataFrame([("12", "Main St"), (None, "Main St"), ("12", None)], "n string, a string")
    assert [r.x for r in df.select(rc.concat_or_null("n", F.lit(" "), "a").alias("x")).collect()] == [
        "12 Main St", None, None]


def test_tolerant_date(spark):
    df = spark.createDataFrame([(3, 3, 100.0, 100.99), (3, 3, 100.0, 101.0), (3, 4, 1.0, 1.0), (None, 3, 1.0, 1.0)],
                               "a int, b int, x double, y double").withColumn("t", F.lit(dt.datetime(2020, 1, 2)))
    out = [r.d for r in df.select(rc.tolerant_date("a", "b", "x", "y", "t").alias("d")).collect()]
    assert out == [dt.date(2020, 1, 2), None, None, None]


def test_digits_to_int(spark):
    df = spark.createDataFrame([("C4K-12",), ("",), ("123456789012",), (None,)], "x string")
    assert [r.v for r in df.select(rc.digits_to_int("x").alias("v")).collect()] == [412, None, None, None]   # "C4K-12" keeps the 4


def test_last_piece_contractor(spark):
    df = spark.createDataFrame([("A, B , C",), ("Solo",), ("A, B,",), (None,)], "x string")
    assert [r.v for r in df.select(rc.last_piece("x").alias("v")).collect()] == ["C", "Solo", "B", None]


def test_eligibility_and_foster(spark):
    df = spark.createDataFrame([(1000.0, 1000.0, 0), (1001.0, 1000.0, 0), (5.0, None, 0), (500.0, 100.0, 1)],
                               "inc double, lim double, foster int")
    out = df.select(rc.eligibility_flag("inc", "lim").alias("e"),
                    rc.foster_override("foster", F.col("inc"), 0.0).alias("i"))
    assert [(r.e, r.i) for r in out.collect()] == [("Y", 1000.0), ("N*", 1001.0), (None, 5.0), ("N*", 0.0)]


def test_school_year_boundaries_and_fold(spark):
    df = spark.createDataFrame([(dt.date(2019, 6, 30),), (dt.date(2019, 7, 1),), (None,)], "x date")
    out = df.select(d.school_year("x").alias("y"), d.fold_month("x").alias("m")).collect()
    assert [(r.y, r.m) for r in out] == [("2018-2019", dt.date(2020, 6, 1)), ("2019-2020", dt.date(2019, 7, 1)),
                                         (None, None)]


def test_encode_decode_inverse():
    assert {v: k for k, v in rc.AGE_GROUP_CODES.items()} == {0: "IT", 1: "PS", 2: "SA"}
    assert sorted(rc.REGION_CODES.values()) == sorted(rc.REGION_LABELS)
    assert sorted(rc.TIME_LABELS) == [0, 1]


def test_exit_reason_chain(spark):
    df = spark.createDataFrame([("Aged Out", None), ("Other", dt.date(2020, 1, 1)), ("Weird", dt.date(2020, 1, 1)),
                                (None, None)], "c string, e date")
    assert [r.r for r in df.select(rc.exit_reason("c", "e").alias("r")).collect()] == [
        "Aged out", "Other", "Unknown", None]


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(-20, 20))), min_size=1,
                max_size=40))
def test_strict_aggregates_follow_r(spark, data):
    df = spark.createDataFrame(data, "k string, v int")
    got = {r.k: (r.lo, r.hi, r.s) for r in df.groupBy("k").agg(
        n.strict_min("v").alias("lo"), n.strict_max("v").alias("hi"), n.sum_or_zero("v").alias("s")).collect()}
    for k in {x for x, _ in data}:
        vals = [v for x, v in data if x == k]
        has_na = any(v is None for v in vals)
        present = [v for v in vals if v is not None]
        assert got[k] == (None if has_na else min(vals), None if has_na else max(vals), sum(present))


def test_small_recodes_with_nulls(spark):
    df = spark.createDataFrame([(1, "SA", 1, "FT", "TEMP-a-b", "a  b\tc"), (3, "PS", 0, None, "123", None),
                                (None, None, None, "PT", None, "x")],
                               "site int, age string, flag int, time string, sasid string, txt string")
    out = df.select(rc.funding_time("site", "age", [1, 2]).alias("ft"), rc.label_when("flag", "Acc.", "Una").alias("acc"),
                    rc.space_label("time", "age").alias("svc"), rc.presence_flag("sasid").alias("yn"),
                    rc.blank_placeholder("sasid").alias("sasid2"), rc.squish("txt").alias("sq")).collect()
    assert [tuple(r) for r in out] == [
        (0, "Acc.", "FT SA", "Y", None, "a b c"),          # listed site -> full time; TEMP key blanked on load
        (0, "Una", "NA PS", "Y", "123", None),             # not SA -> 0; NA printed in the label
        (None, None, "PT NA", "N", None, "x")]             # unknown age and site -> NULL time; NULL flag stays NULL


def test_date_labels(spark):
    df = spark.createDataFrame([(dt.date(2019, 7, 1), dt.date(2019, 7, 28))], "s date, e date")
    r = df.select(d.long_date("s").alias("a"), d.long_date("s", pad_day=True).alias("b"), d.us_date("e").alias("c"),
                  d.month_year("s").alias("m"), d.weeks_inclusive("s", "e").alias("w"),
                  d.nearest_monday("s").alias("mon"), d.third_friday("s").alias("fri")).first()
    assert (r.a, r.b, r.c, r.m, r.w) == ("July 1, 2019", "July 01, 2019", "07/28/2019", "July 2019", 4.0)
    assert (r.mon, r.fri) == (dt.date(2019, 7, 1), dt.date(2019, 7, 19))
