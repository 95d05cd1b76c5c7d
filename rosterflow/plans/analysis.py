"""Usage analysis — edit lag, seasonality, school-year totals, forecast, facility sizes.

Each notebook step becomes a function over a DataFrame and column names; row
loops (``.apply`` of date helpers) are column expressions, plots are their
tables (bins are explicit).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import fold_month, month_start, school_year, seconds_between, whole_days
from ..operators.bitmaps import count_bitmaps, dense_ids, id_bitmaps, merge_bitmaps
from ..operators.dedupe import first_per_key
from ..operators.reshape import sorted_string_agg
from ..operators.stats import describe, describe_counts, histogram, share_over
from ..session import stored

DAY = 86400
THIRTY_DAYS = 30


def analysis_base(enrollments: DataFrame, races: DataFrame, enrollment_key: str, race_key: str, race_col: str,
                  attributes: Sequence[tuple[DataFrame, str, str]] = ()) -> DataFrame:
    """One row per enrollment with its categories as sorted text (A10) and attributes.

    The category text is aggregated per enrollment key *before* the attribute
    joins (the source groups by 24 columns instead).
    """
    text = sorted_string_agg(races, [race_key], race_col, ",", "races")
    out = enrollments.join(text, enrollments[enrollment_key] == text[race_key], "left").drop(text[race_key])
    for dim, left_key, right_key in attributes:
        out = out.join(dim, out[left_key] == dim[right_key], "left").drop(dim[right_key])
    return out


def with_edit_lag(df: DataFrame, created: str, modified: str, out_col: str = "lag_seconds") -> DataFrame:
    """modified - created in seconds."""
    return df.withColumn(out_col, seconds_between(created, modified))


def edit_lag_stats(df: DataFrame, lag_col: str, modified_col: str, group: Sequence[str] = ()) -> DataFrame:
    """describe() of the lag in days plus the number of NULL modification dates (per group)."""
    days = df.select(*group, (F.col(lag_col) / F.lit(float(DAY))).alias("lag_days"),
                     F.col(modified_col).isNull().cast("bigint").alias("__rf_null"))
    return describe(days, "lag_days", group=group, sums={"n_null_modified": F.col("__rf_null")})


def lag_counts(df: DataFrame, student_id: str, order: Sequence[str], lag_col: str, modified_col: str) -> DataFrame:
    """(kind, lag_seconds, n, n_null_modified) of enrollments (all rows) and students (each one's first row in ``order``).

    One read: rows are counted per (student, lag), with the first of them in order; that stored table gives both
    kinds. No window over a student: one with very many rows is spread by lag.
    """
    null = F.col(modified_col).isNull().cast("int").alias("no_modified")
    per = stored(df.groupBy(student_id, F.col(lag_col).alias("lag_seconds"), null).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("first")))
    first = per.groupBy(student_id).agg(F.min(F.struct("first", "lag_seconds", "no_modified")).alias("f"))
    both = per.select(F.lit("enrollments").alias("kind"), "lag_seconds", "no_modified", "n").unionByName(
        first.select(F.lit("students").alias("kind"), "f.lag_seconds", "f.no_modified", F.lit(1).cast("bigint").alias("n")))
    return stored(both.groupBy("kind", "lag_seconds").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("no_modified")).alias("n_null_modified")))


def edit_lag_stats_of(counts: DataFrame) -> DataFrame:
    """A11/A12 per kind, in days, from :func:`lag_counts`."""
    days = counts.select("kind", (F.col("lag_seconds") / F.lit(float(DAY))).alias("__rf_v"), F.col("n").alias("__rf_n"), "n_null_modified")
    return describe_counts(days, group=["kind"], sums=["n_null_modified"])


def edit_lag_share(df: DataFrame, lag_col: str, threshold_seconds: int) -> DataFrame:
    """Rows edited more than ``threshold`` after creation, of all rows, in percent."""
    return share_over(df, lag_col, threshold_seconds).withColumn("threshold_seconds",
                                                                 F.lit(threshold_seconds).cast("bigint"))


def edit_lag_hist(df: DataFrame, lag_col: str, threshold_seconds: int, width_days: int = THIRTY_DAYS) -> DataFrame:
    """Histogram of the lag (pandas ``.dt.days``) in ``width_days`` bins, above the threshold."""
    over = df.where(F.col(lag_col) > threshold_seconds).select(whole_days(lag_col).alias("__days"))
    return histogram(over, "__days", width_days).withColumn("threshold_seconds",
                                                            F.lit(threshold_seconds).cast("bigint"))


def _distinct(col: str, exact: bool, rsd: float):
    """Exact distinct count, or an HLL++ sketch (no distinct shuffle) when ``exact`` is False."""
    return F.count_distinct(col) if exact else F.approx_count_distinct(col, rsd)


def monthly_distinct(df: DataFrame, date_col: str, id_col: str, exact: bool = True, rsd: float = 0.01) -> DataFrame:
    """Distinct ids per month, with folded month (F20) and school year.

    Rows with no date are dropped (pandas drops NaN group keys); NULL ids are not
    counted. ``n_years`` (A21) is the number of school years in the result.
    ``exact=False`` uses ``approx_count_distinct`` (relative error ``rsd``).
    """
    m = df.where(F.col(date_col).isNotNull()).select(month_start(date_col).alias("month"), F.col(id_col).alias("__id"))
    counts = m.groupBy("month").agg(_distinct("__id", exact, rsd).alias("n_distinct"))
    out = counts.select("month", fold_month("month").alias("adjusted_month"),
                        school_year("month").alias("school_year"), "n_distinct")
    # the monthly table is bounded (one row per month): a window over it avoids re-reading the input
    years = F.size(F.collect_set("school_year").over(Window.partitionBy())).cast("bigint")
    return out.withColumn("n_years", years)


def school_year_totals(df: DataFrame, student_date: str, student_id: str, enrollment_date: str,
                       enrollment_id: str) -> DataFrame:
    """Distinct students by school year ⟗ distinct enrollments by school year."""
    st = (df.where(F.col(student_date).isNotNull())
          .groupBy(school_year(student_date).alias("school_year"))
          .agg(F.count_distinct(student_id).alias("students")))
    en = (df.where(F.col(enrollment_date).isNotNull())
          .groupBy(school_year(enrollment_date).alias("school_year"))
          .agg(F.count_distinct(enrollment_id).alias("enrollments")))
    return st.join(en, "school_year", "full")


MONTHLY_FLAG = "partial"


def monthly_bitmaps(df: DataFrame, kinds: dict[str, tuple[str, str]], partial: Column | None = None) -> DataFrame:
    """(kind, month, partial, bucket, bitmap): for each kind (date column, id column) the distinct ids of every month.

    One read of ``df`` for all kinds. ``partial`` is a condition on the rows (the part of a year that a forecast
    compares); ids other than integers are numbered first. The frame can be stored and extended month by month.
    """
    for col in {i for _, i in kinds.values()}:
        if dict(df.dtypes)[col] not in ("bigint", "int", "smallint", "tinyint"):
            ids = dense_ids(df, col).withColumnRenamed(col, "__rf_raw")
            df = df.join(ids, F.col(col) == F.col("__rf_raw"), "left").drop("__rf_raw", col).withColumnRenamed("dense", col)
    flag = F.coalesce(partial, F.lit(False)) if partial is not None else F.lit(False)
    each = df.select(flag.alias(MONTHLY_FLAG), F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), month_start(d).alias("month"), F.col(i).cast("bigint").alias("id"))
        for k, (d, i) in kinds.items()])).alias("e")).select(MONTHLY_FLAG, "e.*")
    return id_bitmaps(each.where(F.col("month").isNotNull()), ["kind", "month", MONTHLY_FLAG], "id")


def monthly_counts(bitmaps: DataFrame) -> DataFrame:
    """D14/A9 for every kind of :func:`monthly_bitmaps`: (kind, month, adjusted_month, school_year, n_distinct, n_years)."""
    counts = count_bitmaps(merge_bitmaps(bitmaps, ["kind", "month"]), ["kind", "month"])
    out = counts.select("kind", "month", fold_month("month").alias("adjusted_month"), school_year("month").alias("school_year"), "n_distinct")
    years = F.size(F.collect_set("school_year").over(Window.partitionBy("kind"))).cast("bigint")     # one row per month
    return out.withColumn("n_years", years)


def school_year_counts(bitmaps: DataFrame) -> DataFrame:
    """D15 from the monthly bitmaps of the kinds ``students`` and ``enrollments``: one row per school year.

    Columns: school_year, students, enrollments, partial_students, partial_enrollments; NULL where a year has no
    row of the kind (in the partial year).
    """
    years = merge_bitmaps(bitmaps.withColumn("school_year", school_year("month")), ["kind", "school_year"],
                          part=F.col(MONTHLY_FLAG)).join(
        bitmaps.groupBy("kind", school_year("month").alias("school_year")).agg(F.max(MONTHLY_FLAG).alias("has_part")), ["kind", "school_year"])
    columns = []
    for kind in ("students", "enrollments"):
        own = F.col("kind") == kind
        columns += [F.sum(F.when(own, F.bitmap_count("bitmap"))).alias(kind),
                    F.sum(F.when(own & F.col("has_part"), F.bitmap_count("part"))).alias(f"partial_{kind}")]
    return years.groupBy("school_year").agg(*columns)


def is_through_february(date_col: str, fold_cutoff: str = "2020-03-01") -> Column:
    """Whether the folded month lies before March (the partial school year)."""
    return fold_month(date_col) < F.to_date(F.lit(fold_cutoff))


def through_february(df: DataFrame, date_col: str, fold_cutoff: str = "2020-03-01") -> DataFrame:
    """Rows whose folded month lies before March (the partial school year)."""
    return df.where(is_through_february(date_col, fold_cutoff))


def partial_totals(counts: DataFrame) -> DataFrame:
    """The partial years of :func:`school_year_counts` as (school_year, students, enrollments)."""
    part = counts.where("partial_students is not null or partial_enrollments is not null")
    return part.select("school_year", F.col("partial_students").alias("students"), F.col("partial_enrollments").alias("enrollments"))


def ytd_forecast(full: DataFrame, partial: DataFrame, reference_years: Sequence[str], current_year: str,
                 excluded_years: Sequence[str] = ()) -> DataFrame:
    """Mean of reference years -> partial/full rates -> expected current totals.

    ``full``/``partial`` are :func:`school_year_totals` results. One row.
    """
    f = full.where(~F.col("school_year").isin(list(excluded_years))) if excluded_years else full
    comb = (f.select("school_year", F.col("students").alias("full_students"),
                     F.col("enrollments").alias("full_enrollments"))
            .join(partial.select("school_year", F.col("students").alias("partial_students"),
                                 F.col("enrollments").alias("partial_enrollments")), "school_year", "full"))
    return _forecast(comb, reference_years, current_year)


def forecast_of_counts(counts: DataFrame, reference_years: Sequence[str], current_year: str, excluded_years: Sequence[str] = ()) -> DataFrame:
    """D16/A15 from :func:`school_year_counts`, without another read of the rows."""
    kept = ~F.col("school_year").isin(list(excluded_years)) if excluded_years else F.lit(True)
    return _forecast(counts.select("school_year", *[F.when(kept, F.col(c)).alias(f"full_{c}") for c in ("students", "enrollments")],
                                   "partial_students", "partial_enrollments"), reference_years, current_year)


def _forecast(comb: DataFrame, reference_years: Sequence[str], current_year: str) -> DataFrame:
    cols = ["full_students", "full_enrollments", "partial_students", "partial_enrollments"]
    is_ref = F.col("school_year").isin(list(reference_years))
    is_cur = F.col("school_year") == current_year
    # one aggregate over the (few) school-year rows: reference means and current values side by side
    j = comb.agg(*[F.avg(F.when(is_ref, F.col(c))).alias(f"mean_{c}") for c in cols],
                 *[F.max(F.when(is_cur, F.col(c))).alias(f"cur_{c}") for c in cols])
    # a zero divisor gives NULL (ANSI mode would otherwise fail the job)
    div = F.try_divide
    student_rate = div(F.col("mean_partial_students"), F.col("mean_full_students"))
    enrollment_rate = div(F.col("mean_partial_enrollments"), F.col("mean_full_enrollments"))
    return j.select(
        *[F.round(f"mean_{c}", 4).alias(f"mean_{c}") for c in cols],
        F.round(student_rate, 4).alias("student_rate"), F.round(enrollment_rate, 4).alias("enrollment_rate"),
        F.round(div(F.col("cur_full_students"), student_rate), 4).alias("expected_students"),
        F.round(div(F.col("cur_full_enrollments"), enrollment_rate), 4).alias("expected_enrollments"),
        *[F.round(div(F.col(f"cur_{c}"), F.col(f"mean_{c}")), 4).alias(f"ratio_{c}") for c in cols])


def facility_sizes(df: DataFrame, facility_col: str, enrollment_col: str, width: int, exact: bool = True,
                   rsd: float = 0.01) -> DataFrame:
    """Distinct enrollments per facility, binned (``floor(n / width)``); NULL facilities form no
    group (pandas ``groupby`` drops NaN keys)."""
    per = (df.where(F.col(facility_col).isNotNull()).groupBy(facility_col)
           .agg(_distinct(enrollment_col, exact, rsd).alias("n")))
    return histogram(per, "n", width, count_col="n_facilities")


def dedupe_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``drop_duplicates(key)`` keeping the first row in an explicit order."""
    return first_per_key(df, [key], list(order))


def usage_analysis(base: DataFrame, cols: dict, reference_years: Sequence[str], current_year: str,
                   excluded_years: Sequence[str] = (), lag_thresholds: Sequence[int] = (3600, 30 * DAY),
                   facility_bin: int = 10) -> dict[str, DataFrame]:
    """Entry 4 (the analysis notebook) over one base frame; every table the notebook plots or prints.

    ``cols`` names the base columns: ``student_id``, ``enrollment_id``, ``facility_id``,
    ``student_created``, ``student_modified``, ``enrollment_created``, ``enrollment_modified``.
    """
    c = cols
    enr = with_edit_lag(base, c["enrollment_created"], c["enrollment_modified"], "enrollment_lag")
    stu = with_edit_lag(dedupe_first(base, c["student_id"], [c["student_id"], c["enrollment_id"]]),
                        c["student_created"], c["student_modified"], "student_lag")
    out = {
        "enrollment_lag_stats": edit_lag_stats(enr, "enrollment_lag", c["enrollment_modified"]),
        "student_lag_stats": edit_lag_stats(stu, "student_lag", c["student_modified"]),
    }
    for th in lag_thresholds:
        out[f"student_lag_share_{th}"] = edit_lag_share(stu, "student_lag", th)
        out[f"student_lag_hist_{th}"] = edit_lag_hist(stu, "student_lag", th)
    out["enrollment_lag_share"] = edit_lag_share(enr, "enrollment_lag", lag_thresholds[0])
    out["enrollment_lag_hist"] = edit_lag_hist(enr, "enrollment_lag", lag_thresholds[0])
    # every distinct count over months and years comes from one read of the base
    kinds = {f"monthly_{i}_by_{d}": (c[d], c[i]) for d, i in [
        ("student_modified", "facility_id"), ("student_created", "facility_id"), ("student_created", "student_id"),
        ("enrollment_created", "enrollment_id"), ("student_modified", "student_id"), ("enrollment_modified", "enrollment_id")]}
    totals = {"students": (c["student_created"], c["student_id"]), "enrollments": (c["enrollment_created"], c["enrollment_id"])}
    bitmaps = stored(monthly_bitmaps(base, kinds | totals, is_through_february(c["student_created"])))
    by_month = monthly_counts(bitmaps.where(F.col("kind").isin(list(kinds))))
    for kind in kinds:
        out[kind] = by_month.where(F.col("kind") == kind).drop("kind")
    years = school_year_counts(bitmaps.where(F.col("kind").isin(list(totals))))
    out["school_year_totals_full"] = years.select("school_year", "students", "enrollments")
    out["school_year_totals_partial"] = partial_totals(years)
    out["ytd_forecast"] = forecast_of_counts(years, reference_years, current_year, excluded_years)
    out["facility_sizes"] = facility_sizes(base, c["facility_id"], c["enrollment_id"], facility_bin)
    return out
