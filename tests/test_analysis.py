"""Entry 4 over the bound test data: every notebook table builds and agrees with the registered queries."""
from pyspark.sql import functions as F

from conftest import rows
from rosterflow.plans import analysis as an
from rosterflow.plans.analysis_queries import CURRENT_YEAR, EXCLUDED_YEAR, REFERENCE_YEARS
from rosterflow.plans.registry import all_queries

SF = "/root/testdata/sf0.001"


def test_usage_analysis(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    o = spark.read.parquet(f"{SF}/orders.parquet")
    base = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderkey", "o_custkey", "l_suppkey", "o_orderdate", "l_shipdate")
    cols = {"student_id": "o_custkey", "enrollment_id": "o_orderkey", "facility_id": "l_suppkey",
            "student_created": "o_orderdate", "student_modified": "l_shipdate",
            "enrollment_created": "o_orderdate", "enrollment_modified": "l_shipdate"}
    out = an.usage_analysis(base, cols, REFERENCE_YEARS, CURRENT_YEAR, [EXCLUDED_YEAR])
    assert len(out) == 18 and all(df.count() >= 0 for df in out.values())
    assert out["enrollment_lag_stats"].first()["count"] == li.count()
    ref = all_queries()["facility_sizes"](spark, SF)
    assert rows(out["facility_sizes"]) == rows(ref)
    assert out["ytd_forecast"].count() == 1


def test_facility_sizes_drop_null_facility(spark):
    df = spark.createDataFrame([(1, 10), (1, 11), (None, 12), (None, 13), (2, 10)], "f int, e int")
    assert rows(an.facility_sizes(df, "f", "e", 2)) == [(0, 1), (1, 1)]


def test_ytd_forecast_zero_divisor_is_null(spark):
    full = spark.createDataFrame([("2017-2018", 10, 20), ("2018-2019", 30, 40), ("2019-2020", 5, 6)],
                                 "school_year string, students long, enrollments long")
    partial = spark.createDataFrame([("2017-2018", 0, 5), ("2018-2019", 0, 7), ("2019-2020", 1, 2)],
                                    "school_year string, students long, enrollments long")
    r = an.ytd_forecast(full, partial, ["2017-2018", "2018-2019"], "2019-2020").first()
    assert r.student_rate == 0.0 and r.expected_students is None and r.ratio_partial_students is None
    assert r.enrollment_rate == 0.2 and r.expected_enrollments == 30.0


def test_approximate_distinct_counts(spark):
    df = spark.range(20000).selectExpr("date_add(date'2019-07-01', cast(id % 60 as int)) as d", "id % 5000 as i")
    exact = {r.month: r.n_distinct for r in an.monthly_distinct(df, "d", "i").collect()}
    approx = {r.month: r.n_distinct for r in an.monthly_distinct(df, "d", "i", exact=False).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[m] - exact[m]) <= 0.05 * exact[m] for m in exact)
