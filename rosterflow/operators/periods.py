"""Reporting calendar and period joins.

The calendar is pure date arithmetic on each month: the next period's start
(``lead``) is computed from ``add_months(period, 1)``, so no window is needed and
every row is independent. Period ids are month offsets from the first month.

Range joins (J11 "active in period", J12 "interval overlaps period") run as
equi-joins: each spell becomes the O(log n) nodes of a dyadic tree that make up its
periods, each period the path of nodes above it (:mod:`.dyadic`); they join on (key,
node) and are verified with the exact predicate. No nested-loop join, no cross
product, no row per month of a spell, and no bounds that have to be found first.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import long_date, nearest_monday, third_friday
from ..functions.nulls import _c
from .dyadic import HIGHEST, cover, path

CALENDAR_COLUMNS = ["id", "funding_source", "period", "period_start", "period_end", "due_at", "label"]


def calendar_from_bounds(bounds: DataFrame, start_col: str = "start", end_col: str = "end",
                         funding_source: str = "CDC") -> DataFrame:
    """One row per month from ``start`` to the month before ``end``.

    ``bounds`` is a one-row frame (literal dates or an aggregate of a fact table).
    The last month of the sequence only serves as the ``lead`` of the one before,
    so it is not emitted (O2). Columns: id, funding_source, period, period_start,
    period_end, due_at, label.
    """
    start = F.trunc(F.col(start_col).cast("date"), "month")
    end = F.trunc(F.col(end_col).cast("date"), "month")
    months = bounds.select(start.alias("__rf_first"),
                           F.explode(F.sequence(start, F.add_months(end, -1), F.expr("interval 1 month")))
                           .alias("period"))
    nxt = F.add_months(F.col("period"), 1)
    cal = months.select(
        (F.months_between("period", "__rf_first").cast("int") + 1).alias("id"),
        F.lit(funding_source).alias("funding_source"),
        F.col("period"),
        nearest_monday("period").alias("period_start"),
        F.date_sub(nearest_monday(nxt), 1).alias("period_end"),
        third_friday(nxt).alias("due_at"),
    )
    label = F.concat(long_date("period_start"), F.lit(" - "), long_date(F.date_sub("period_end", 2), pad_day=True))
    return cal.withColumn("label", label).select(*CALENDAR_COLUMNS)


def reporting_calendar(spark: SparkSession, start: _dt.date, end: _dt.date,
                       funding_source: str = "CDC") -> DataFrame:
    """C1-C5 for literal bounds (``end`` exclusive, as ``head(-1)``)."""
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return calendar_from_bounds(bounds, funding_source=funding_source)


def period_for_month(month: Column, first_month: Column) -> Column:
    """Period id of a month in a calendar starting at ``first_month``."""
    return F.months_between(F.trunc(month, "month"), F.trunc(first_month, "month")).cast("int") + 1


def lookup_label(df: DataFrame, label_col: str, calendar: DataFrame, out_col: str = "period",
                 written_sep: str = " to ") -> DataFrame:
    """Period id for a printed label as written on a roster (``" to "`` form).

    The calendar is bounded (one row per month), so it is broadcast; the lookup is
    a left join (unmatched label -> NULL period).
    """
    norm = F.regexp_replace(F.col(label_col), written_sep, " - ")
    cal = F.broadcast(calendar.select(F.col("label").alias("__rf_label"), F.col("id").alias(out_col)))
    return df.join(cal, norm == F.col("__rf_label"), "left").drop("__rf_label")


def active_in_period(facts: DataFrame, reports: DataFrame, on: str, first_col: str, last_col: str,
                     report_period_col: str, max_period: Column | int | None = None) -> DataFrame:
    """Fact rows active in a report's period: ``first <= p and (last is null or last >= p)``.

    The periods ``first .. last`` of a fact become dyadic nodes (an open spell runs on, or to ``max_period``), a
    report's period its path of nodes; a pair meets in exactly one node of the equi-join ``(on, node)``.
    """
    p = F.col(report_period_col)
    most = F.lit(HIGHEST) if max_period is None else max_period if isinstance(max_period, Column) else F.lit(max_period)
    spells = facts.where(F.col(first_col).isNotNull()).withColumn("__rf_hi", F.least(F.coalesce(F.col(last_col), most), most))
    spells = spells.withColumn("__rf_node", F.explode(cover(f"`{first_col}`", "__rf_hi"))).drop("__rf_hi")
    r = reports.withColumn("__rf_node", F.explode(path(p)))
    cond = (F.col(first_col) <= p) & (F.col(last_col).isNull() | (F.col(last_col) >= p))
    return spells.join(r, [on, "__rf_node"]).where(cond).drop("__rf_node")


def _month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def interval_overlap_join(facts: DataFrame, periods: DataFrame, on: str, start_col: str, end_col: str,
                          period_start_col: str, period_end_col: str) -> DataFrame:
    """``start <= period_end and (end is null or end >= period_start)`` per key.

    The months that a fact covers become dyadic nodes (an open interval runs on), each month of a period its path
    of nodes, whatever the periods' length or ids; they join on (key, node) and are verified. A pair counts in its
    first common month only.
    """
    s, end = F.to_date(F.col(start_col)), F.to_date(F.col(end_col))
    p_start, p_end = F.to_date(F.col(period_start_col)), F.to_date(F.col(period_end_col))
    spells = facts.where(s.isNotNull()).withColumn("__rf_lo", _month_number(F.least(s, F.coalesce(end, s)))).withColumn(
        "__rf_hi", F.when(end.isNull(), F.lit(HIGHEST)).otherwise(_month_number(F.greatest(s, end))))
    spells = spells.withColumn("__rf_node", F.explode(cover("__rf_lo", "__rf_hi")))
    p = periods.where(p_start.isNotNull() & p_end.isNotNull()).withColumn("__rf_plo", _month_number(F.least(p_start, p_end)))
    p = p.withColumn("__rf_m", F.explode(F.sequence("__rf_plo", _month_number(F.greatest(p_start, p_end)))))
    p = p.withColumn("__rf_node", F.explode(path("__rf_m")))
    joined = spells.join(p, [on, "__rf_node"]).where(F.col("__rf_m") == F.greatest("__rf_lo", "__rf_plo"))
    cond = (s <= F.col(period_end_col)) & (F.col(end_col).isNull() | (end >= F.col(period_start_col)))
    return joined.where(cond).drop("__rf_m", "__rf_lo", "__rf_hi", "__rf_plo", "__rf_node")


def open_ended_last(last_col: str, global_max: Column, *closed_if_present) -> Column:
    """The last period stays open (NULL) unless it precedes the global last
    period or any of ``closed_if_present`` (exit dates) is set."""
    cond = F.col(last_col) < global_max
    for c in closed_if_present:
        cond = cond | _c(c).isNotNull()
    return F.when(cond, F.col(last_col)).when(~cond, F.lit(None).cast("int"))


def open_or_recent(df: DataFrame, end_col: str, since) -> DataFrame:
    """Rows still open (NULL end) or ended on/after ``since``."""
    e = F.to_date(F.col(end_col))
    return df.where(F.col(end_col).isNull() | (e >= F.lit(since)))


def active_since(df: DataFrame, key: str, end_cols, since) -> DataFrame:
    """Rows of keys that have a row with every end open, or any end on/after ``since``.

    The qualifying keys are found in one pass and semi-joined back (the source's
    ``select(key) %>% unique() %>% left_join(self)``).
    """
    all_open = None
    recent = None
    for c in end_cols:
        o = F.col(c).isNull()
        r = F.coalesce(F.to_date(F.col(c)) >= F.lit(since), F.lit(False))
        all_open = o if all_open is None else all_open & o
        recent = r if recent is None else recent | r
    keys = df.where(all_open | recent).select(F.col(key).alias("__rf_k")).distinct()
    return df.join(keys, F.col(key) == F.col("__rf_k"), "left_semi")
