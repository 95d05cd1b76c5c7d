"""Counts, shares, histograms and exact descriptive statistics.

Everything is a partial aggregation. Exact quantiles (pandas ``describe``
interpolates) avoid collecting a column into one task: values are
pre-aggregated to (value, count), ranked with a distributed running total, and
only the few rows straddling each requested position are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.nulls import _c
from ..session import stored
from .keys import running_total

#: Distinct values up to which a running total of their counts is one window.
WINDOW_VALUES = 1_000_000


def zero_filled_count(facts: DataFrame, domain: DataFrame, keys: Sequence[str],
                      count_col: str = "n") -> DataFrame:
    """``count %>% right_join(domain) %>% replace_na(0)`` as domain ⟕ counts."""
    counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    return domain.join(counts, list(keys), "left").fillna(0, subset=[count_col])


def share_over(df: DataFrame, value: str | Column, threshold, group: Sequence[str] = ()) -> DataFrame:
    """Rows over a threshold, all rows (NULLs included), percent rounded to 2."""
    v = _c(value)
    agg = df.groupBy(*group).agg(F.count_if(v > F.lit(threshold)).cast("bigint").alias("n_over"),
                                 F.count(F.lit(1)).alias("n_total"))
    return agg.withColumn("pct_over", F.round(F.try_divide(F.col("n_over") * 100.0, F.col("n_total")), 2))


def histogram(df: DataFrame, value: str | Column, width: float, group: Sequence[str] = (),
              bin_col: str = "bin", count_col: str = "n") -> DataFrame:
    """Fixed-width bins ``floor(x / width)`` and their counts (NULLs skipped)."""
    v = _c(value)
    return (df.where(v.isNotNull()).groupBy(*group, F.floor(v / F.lit(width)).cast("bigint").alias(bin_col))
              .agg(F.count(F.lit(1)).alias(count_col)))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of NULLs per column, one pass."""
    return df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(f"{c}_nulls") for c in cols])


def _join_on_groups(a: DataFrame, b: DataFrame, group: Sequence[str]) -> DataFrame:
    """Attach ``b``'s columns to ``a`` by group; without groups both are one row: scalar subqueries."""
    if not group:
        return a.select("*", *[b.select(c).scalar().alias(c) for c in b.columns])
    b2 = b.select(*[F.col(g).alias(f"__rf_g_{g}") for g in group], *[c for c in b.columns if c not in group])
    cond = None
    for g in group:
        part = F.col(g).eqNullSafe(F.col(f"__rf_g_{g}"))
        cond = part if cond is None else cond & part
    return a.join(b2, cond, "left").drop(*[f"__rf_g_{g}" for g in group])


def value_counts(df: DataFrame, value: str, group: Sequence[str] = (), sums: dict | None = None) -> DataFrame:
    """(group, ``__rf_v``, ``__rf_n``, sums): the rows of each value, NULL included, and sums of columns over them; stored.

    One read of ``df``, partially aggregated; every statistic of the column follows from this table.
    """
    counts = df.groupBy(*group, F.col(value).alias("__rf_v")).agg(
        F.count(F.lit(1)).alias("__rf_n"), *[F.sum(c).alias(n) for n, c in (sums or {}).items()])
    return stored(counts)


def quantiles_of_counts(counts: DataFrame, qs: Sequence[float], group: Sequence[str] = ()) -> DataFrame:
    """Exact linearly interpolated quantiles from (group, ``__rf_v``, ``__rf_n``), a stored table.

    A running total gives each value its position range ``[cum - n, cum)``; only the rows holding a requested
    position are kept. Many values are ranked by a distributed running total, few ones by a window.
    """
    counts = counts.where(F.col("__rf_v").isNotNull()).select(*group, "__rf_v", "__rf_n")
    if counts.count() <= WINDOW_VALUES:
        upto = Window.partitionBy(*(group or [F.lit(0)])).orderBy("__rf_v").rowsBetween(Window.unboundedPreceding, 0)
        ranked = counts.withColumn("__rf_cum", F.sum("__rf_n").over(upto))
    else:
        ranked = running_total(counts, ["__rf_v"], "__rf_n", out_col="__rf_cum", group_cols=group)
    totals = counts.groupBy(*group).agg(F.sum("__rf_n").alias("__rf_total"))
    ranked = _join_on_groups(ranked, totals, group)
    start, end = F.col("__rf_cum") - F.col("__rf_n"), F.col("__rf_cum")
    aggs, wanted = [], None
    for q in qs:
        pos = F.lit(float(q)) * (F.col("__rf_total") - 1)
        lo_pos, hi_pos = F.floor(pos), F.ceil(pos)
        in_lo = (start <= lo_pos) & (lo_pos < end)
        in_hi = (start <= hi_pos) & (hi_pos < end)
        lo_v = F.max(F.when(in_lo, F.col("__rf_v").cast("double")))
        hi_v = F.max(F.when(in_hi, F.col("__rf_v").cast("double")))
        frac = F.max(pos - lo_pos)
        aggs.append((lo_v + (hi_v - lo_v) * frac).alias(f"q_{int(round(q * 100))}"))
        wanted = (in_lo | in_hi) if wanted is None else (wanted | in_lo | in_hi)
    return ranked.where(wanted).groupBy(*group).agg(*aggs)


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], group: Sequence[str] = ()) -> DataFrame:
    """Exact linearly interpolated quantiles (``quantile_cont`` / pandas), per group; one read of ``df``.

    Columns: the group columns and ``q_<int(q*100)>``. NULLs are ignored.
    """
    return quantiles_of_counts(value_counts(df, value, group), qs, group)


def describe_counts(counts: DataFrame, qs: Sequence[float] = (0.25, 0.5, 0.75), group: Sequence[str] = (), sums: Sequence[str] = ()) -> DataFrame:
    """A11 from (group, ``__rf_v``, ``__rf_n``, sums): count, mean, std (sample), min, quantiles, max, and the sums."""
    v, n = F.col("__rf_v").cast("double"), F.col("__rf_n")
    known = F.when(v.isNotNull(), n)
    basic = counts.groupBy(*group).agg(F.coalesce(F.sum(known), F.lit(0)).alias("count"), (F.sum(v * n) / F.sum(known)).alias("mean"),
                                       F.min(v).alias("min"), F.max(v).alias("max"), *[F.sum(c).alias(c) for c in sums])
    # squares about the mean, so that large values lose no digits
    means = basic.select(*group, F.col("mean").alias("__rf_mean"))
    spread = _join_on_groups(counts, means, group).groupBy(*group).agg(
        F.sqrt(F.sum(n * (v - F.col("__rf_mean")) * (v - F.col("__rf_mean"))) / F.nullif(F.sum(known) - 1, F.lit(0))).alias("std"))
    out = _join_on_groups(_join_on_groups(basic, spread, group), quantiles_of_counts(counts, qs, group), group)
    return out.select(*group, "count", "mean", "std", "min", "max", *sums, *[c for c in out.columns if c.startswith("q_")])


def describe(df: DataFrame, value: str, qs: Sequence[float] = (0.25, 0.5, 0.75),
             group: Sequence[str] = (), sums: dict | None = None) -> DataFrame:
    """Count, mean, std (sample), min, quantiles, max of a numeric column (per group); one read of ``df``.

    ``sums`` adds sums of columns ``{name: Column}`` to the same pass (e.g. NULL counts, A12).
    """
    return describe_counts(value_counts(df, value, group, sums), qs, group, list(sums or {}))


def quantile_sketches(df: DataFrame, value: str, group: Sequence[str], k: int = 400) -> DataFrame:
    """(group, sketch): a KLL sketch of an integer column for each group (a month, say), to be stored and merged later.

    With ``k`` = 400 a quantile's rank is within about 0.7 % of the rows asked for (99 % confidence).
    """
    return df.where(F.col(value).isNotNull()).groupBy(*group).agg(F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(k)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, qs: Sequence[float], group: Sequence[str] = ()) -> DataFrame:
    """Approximate quantiles of coarser groups from stored sketches, without the rows: (group, n, ``q_<int(q*100)>``)."""
    merged = sketches.groupBy(*group).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))
    return merged.select(*group, F.kll_sketch_get_n_bigint("sketch").alias("n"),
                         *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(q))).alias(f"q_{int(round(q * 100))}") for q in qs])
