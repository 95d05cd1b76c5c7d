"""Pivots, collapses and completeness tables.

Each reshape is one aggregation pass with partial (map-side) aggregation: the
reference's seven ``distinct`` sub-selects plus left joins (A3), three filtered
joins (A4) and ``distinct`` + ``count`` (A2) all collapse to a single
``groupBy``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def flag_pivot(df: DataFrame, key: str, col: str, mapping: Mapping[str, str],
               base: DataFrame | None = None) -> DataFrame:
    """A3: one 0/1 column per category ``{value: out_name}``.

    Without ``base`` the keys of ``df`` are returned; with ``base`` every base row
    is kept (left join) and missing flags become 0.
    """
    aggs = [F.max(F.coalesce(F.col(col) == F.lit(v), F.lit(False)).cast("int")).alias(name) for v, name in mapping.items()]
    flags = df.groupBy(key).agg(*aggs)
    if base is None:
        return flags
    out = base.join(flags, key, "left")
    return out.fillna(0, subset=list(mapping.values()))


def eav_pivot(df: DataFrame, key: str, attr: str, value: str, mapping: Mapping,
              agg: str = "max") -> DataFrame:
    """A4: entity-attribute-value rows to columns ``{attr_value: out_name}``.

    Duplicate (key, attr) rows keep one value (``agg``) instead of fanning out.
    """
    fn = getattr(F, agg)
    aggs = [fn(F.when(F.col(attr) == F.lit(a), F.col(value))).alias(name) for a, name in mapping.items()]
    return df.groupBy(key).agg(*aggs)


def collapse_multi(df: DataFrame, keys: Sequence[str], col: str, label: str,
                   out_col: str | None = None) -> DataFrame:
    """A2: several distinct values -> ``label``, else the single value.

    ``count(*)`` over distinct rows counts NULL as a value; computed in one pass
    from min, max and NULL presence (no ``distinct`` shuffle).
    """
    out_col = out_col or col
    c = F.col(col)
    lo, hi = F.min(c), F.max(c)
    has_null = F.max(c.isNull().cast("int")) == 1
    several = (lo != hi) | (has_null & lo.isNotNull())
    return df.groupBy(*keys).agg(F.when(several, F.lit(label)).otherwise(lo).alias(out_col))


def sorted_string_agg(df: DataFrame, keys: Sequence[str], col: str, sep: str = ",",
                      out_col: str | None = None) -> DataFrame:
    """A10: ``string_agg(x, sep)`` with a defined (sorted) order; NULLs skipped.

    Pre-aggregated to (key, value, count) first, so a key's work is bounded by
    its number of *distinct* values (race codes: 7), however many rows the key
    has; each value is repeated ``count`` times when the text is built.
    """
    out_col = out_col or col
    counted = df.groupBy(*keys, col).agg(F.count(F.lit(1)).alias("__rf_n"))
    pieces = counted.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(col).alias("v"), F.col("__rf_n").alias("n")))).alias("__rf_vs"))
    # NULL values are skipped, but a key whose values are all NULL keeps its row (SQL: NULL text)
    present = F.filter("__rf_vs", lambda s: s["v"].isNotNull())
    text = F.array_join(F.flatten(F.transform(present, lambda s: F.array_repeat(s["v"].cast("string"),
                                                                                s["n"].cast("int")))), sep)
    return pieces.select(*keys, F.when(F.size(present) > 0, text).alias(out_col))


def completeness(df: DataFrame, group: Sequence[str], checks: Mapping[str, Column]) -> DataFrame:
    """Missing count, total and percent per group and attribute.

    ``checks`` maps an attribute name to a boolean "is missing" expression. One
    aggregation for all attributes, then ``unpivot`` to long form. A group with no
    missing rows yields 0 / 0.0 (the reference yields NA there).
    """
    aggs = [F.sum(F.coalesce(expr, F.lit(False)).cast("bigint")).alias(f"__rf_m_{i}")
            for i, expr in enumerate(checks.values())]
    wide = df.groupBy(*group).agg(F.count(F.lit(1)).alias("total"), *aggs)
    names = list(checks.keys())
    stack = F.explode(F.array(*[F.struct(F.lit(n).alias("attribute"), F.col(f"__rf_m_{i}").alias("missing"))
                                for i, n in enumerate(names)]))
    long = wide.select(*group, "total", stack.alias("__rf_s")).select(
        *group, "__rf_s.attribute", "__rf_s.missing", "total")
    return long.withColumn("missing_pct", F.round(F.try_divide(F.col("missing") * 100.0, F.col("total")), 2))


def wide_counts(df: DataFrame, keys: Sequence[str], col: str, values: Sequence, prefix: str = "") -> DataFrame:
    """``count %>% pivot_wider`` as conditional counts (0 where absent)."""
    aggs = [F.sum(F.coalesce(F.col(col) == F.lit(v), F.lit(False)).cast("bigint")).alias(f"{prefix}{v}") for v in values]
    return df.groupBy(*keys).agg(*aggs)
