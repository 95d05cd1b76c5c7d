"""Per-key row picking and group-level filters.

All pickers use ``row_number`` over a key partition with a *total* order, so the
result never depends on input order; Spark plans them with a
``WindowGroupLimit`` that keeps one row per key before the shuffle. Group-level
predicates use a partially aggregated ``groupBy`` joined back on the key,
never a whole-partition window or a collected group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.nulls import _c, first_after_arrange, last_after_arrange, strict_max, strict_min


def with_group_aggs(df: DataFrame, keys: Sequence[str], aggs: dict) -> DataFrame:
    """Grouped ``mutate``: attach per-group aggregates to every row.

    A ``groupBy`` (partially aggregated map-side, so a hot key costs one row per
    map task) joined back on the keys (NULL keys form a group, as in R). The
    aggregate side has one row per key: AQE broadcasts it when small, and splits
    a skewed key's partition on the row side otherwise.
    """
    g = df.groupBy(*[F.col(k).alias(f"__rf_g_{k}") for k in keys]).agg(
        *[expr.alias(name) for name, expr in aggs.items()])
    cond = None
    for k in keys:
        part = F.col(k).eqNullSafe(F.col(f"__rf_g_{k}"))
        cond = part if cond is None else cond & part
    return df.join(g, cond, "inner").drop(*[f"__rf_g_{k}" for k in keys])


def _pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rf_rn", F.row_number().over(w)).filter(F.col("__rf_rn") == 1).drop("__rf_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest row per key — SQL ``order by x desc`` (NULLs last)."""
    ordering = [_c(o).desc_nulls_last() for o in order] + [_c(t).desc_nulls_last() for t in tiebreak]
    return _pick_one(df, keys, ordering)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """``group_by(keys) %>% arrange(order) %>% slice(n())``.

    NA sorts last in R, so a NULL sort key *wins*; ties go to the greatest
    ``tiebreak`` (the reference's "last in input order").
    """
    return _pick_one(df, keys, last_after_arrange([*order, *tiebreak]))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    """``arrange(order) %>% slice(1)`` per key (NULLs last, smallest tiebreak)."""
    return _pick_one(df, keys, first_after_arrange([*order, *tiebreak]))


def with_group_bounds(df: DataFrame, keys: Sequence[str], col: str, min_col: str, max_col: str,
                      strict: bool = True) -> DataFrame:
    """Grouped ``mutate(min(x), max(x))``; ``strict`` = R without ``na.rm``."""
    lo = strict_min(col) if strict else F.min(col)
    hi = strict_max(col) if strict else F.max(col)
    return with_group_aggs(df, keys, {min_col: lo, max_col: hi})


def observed_span(df: DataFrame, keys: Sequence[str], period_col: str,
                  first_col: str = "first_period", last_col: str = "last_period",
                  strict: bool = True) -> DataFrame:
    """A5: first/last period per key as one aggregate (partial aggregation)."""
    lo = strict_min(period_col) if strict else F.min(period_col)
    hi = strict_max(period_col) if strict else F.max(period_col)
    return df.groupBy(*keys).agg(lo.alias(first_col), hi.alias(last_col))


def drop_closed_when_one_open(df: DataFrame, keys: Sequence[str], end_col: str) -> DataFrame:
    """Keep a row if its group has one row, or not exactly one open row, or it is open."""
    flagged = with_group_aggs(df, keys, {"__rf_n": F.count(F.lit(1)),
                                         "__rf_open": F.sum(F.col(end_col).isNull().cast("int"))})
    keep = (F.col("__rf_n") == 1) | (F.col("__rf_open") != 1) | F.col(end_col).isNull()
    return flagged.filter(keep).drop("__rf_n", "__rf_open")


def late_key_groups(df: DataFrame, group_keys: Sequence[str], id_col: str) -> DataFrame:
    """Rows of groups with a NULL id and exactly two distinct ids (NULL included).

    Per group: any NULL, and min == max over the non-NULL ids (one real id).
    """
    flagged = with_group_aggs(df, group_keys, {"__rf_null": F.max(F.col(id_col).isNull().cast("int")),
                                               "__rf_lo": F.min(id_col), "__rf_hi": F.max(id_col)})
    keep = (F.col("__rf_null") == 1) & F.col("__rf_lo").isNotNull() & (F.col("__rf_lo") == F.col("__rf_hi"))
    return flagged.filter(keep).drop("__rf_null", "__rf_lo", "__rf_hi")


def duplicates(df: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Rows whose key occurs more than once.

    Counted with a (partially aggregated) ``groupBy`` and semi-joined back, so a
    hot key costs one counter, not a window partition.
    """
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).drop("count")
    if not null_safe:
        return df.join(dup, list(keys), "left_semi")
    cond = None
    for k in keys:
        part = df[k].eqNullSafe(dup[k])
        cond = part if cond is None else cond & part
    return df.join(dup, cond, "left_semi")


def close_on_move(df: DataFrame, key: str, group_col: str, entry_col: str, exit_col: str,
                  reason_col: str, first_start_col: str, last_end_col: str,
                  moved_reason: str = "Aged Out") -> DataFrame:
    """A key seen in several groups moves to the greatest group.

    The greatest group's entry becomes the start of its first observed period; the
    other groups end at their last observed period with ``moved_reason``. The
    grouping column is compared in text order; NULLs follow R (``max`` is NA).
    """
    g = F.col(group_col)
    b = with_group_aggs(df, [key], {"__rf_gnull": F.max(g.isNull().cast("int")),
                                    "__rf_glo": F.min(g), "__rf_ghi": F.max(g)})
    has_null = F.col("__rf_gnull") == 1
    lo, hi = F.col("__rf_glo"), F.col("__rf_ghi")
    moved = (lo != hi) | (has_null & lo.isNotNull())
    top = F.when(has_null, F.lit(None)).otherwise(hi)
    moved_to = g == top
    move_in = moved & moved_to
    move_out = moved & ~moved_to
    return (b
            .withColumn(entry_col, F.when(move_in, F.col(first_start_col)).when(~move_in, F.to_date(entry_col)))
            .withColumn(exit_col, F.when(move_out, F.col(last_end_col)).when(~move_out, F.to_date(exit_col)))
            .withColumn(reason_col, F.when(move_out, F.lit(moved_reason)).when(~move_out, F.col(reason_col)))
            .drop("__rf_gnull", "__rf_glo", "__rf_ghi"))


def merge_spells(df: DataFrame, key: str, keys_to_merge: DataFrame, min_cols: Sequence[str],
                 exit_col: str, tiebreak: Sequence[str]) -> DataFrame:
    """D8 fix-up: for listed keys take the group minimum of ``min_cols`` and keep
    only the last-exiting row (NULL exit wins); other keys pass through.

    ``keys_to_merge`` is a one-column frame of keys (computed, e.g. from a
    uniqueness gate), semi/anti-joined — no literal id list in the plan.
    """
    k = keys_to_merge.select(F.col(keys_to_merge.columns[0]).alias(key)).distinct()
    listed = df.join(k, key, "left_semi").select(*df.columns)
    rest = df.join(k, key, "left_anti").select(*df.columns)
    mins = with_group_aggs(listed, [key], {f"__rf_min_{c}": strict_min(c) for c in min_cols})
    for c in min_cols:
        mins = mins.withColumn(c, F.col(f"__rf_min_{c}")).drop(f"__rf_min_{c}")
    listed = mins.select(*df.columns)
    listed = last_per_key(listed, [key], [exit_col], tiebreak)
    return rest.unionByName(listed)
