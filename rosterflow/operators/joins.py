"""Join helpers with the source scripts' key semantics.

Join strategy is left to Catalyst/AQE: equi-joins plan as sort-merge or
shuffled-hash joins and are switched to broadcast at runtime when a side turns
out small (``spark.sql.adaptive.autoBroadcastJoinThreshold``). Explicit
``broadcast`` hints are used only for sides whose size is bounded by
construction (calendar, fixed lookup tables, per-partition offsets).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.nulls import eq_null_safe_cond


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                   nullable: Sequence[str] = ()) -> DataFrame:
    """Equi-join where NULL matches NULL on the ``nullable`` keys (R dplyr).

    Output keeps one copy of each key column (the left one).
    """
    r = right.select(*[F.col(c).alias(f"__rf_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = eq_null_safe_cond([left[k] for k in keys], [r[f"__rf_r_{k}"] for k in keys],
                             [k in set(nullable) for k in keys])
    out = left.join(r, cond, how)
    if how in ("right", "full", "full_outer", "outer", "right_outer"):
        for k in keys:
            out = out.withColumn(k, F.coalesce(left[k], F.col(f"__rf_r_{k}")))
    return out.drop(*[f"__rf_r_{k}" for k in keys])


def coalesce_from(df: DataFrame, other: DataFrame, key: str, cols: Sequence[str],
                  other_key: str | None = None) -> DataFrame:
    """Fill NULLs in ``cols`` from a supplementary table by key.

    ``other`` must be unique on its key (checked by the V6 gate); a duplicate
    would fan rows out exactly as the reference's join does.
    """
    other_key = other_key or key
    o = other.select(F.col(other_key).alias("__rf_k"), *[F.col(c).alias(f"__rf_o_{c}") for c in cols])
    out = df.join(o, F.col(key) == F.col("__rf_k"), "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"__rf_o_{c}")))
    return out.drop("__rf_k", *[f"__rf_o_{c}" for c in cols])


def semi_in(df: DataFrame, ids: DataFrame, key: str, ids_key: str | None = None) -> DataFrame:
    """Membership in a computed id list as a ``left_semi`` join (no IN-list)."""
    ids_key = ids_key or key
    return df.join(ids.select(F.col(ids_key).alias("__rf_k")), F.col(key) == F.col("__rf_k"), "left_semi")


def anti_missing(df: DataFrame, ids: DataFrame, key: str, ids_key: str | None = None) -> DataFrame:
    """Rows whose key is absent from another table (``left_anti``)."""
    ids_key = ids_key or key
    return df.join(ids.select(F.col(ids_key).alias("__rf_k")), F.col(key) == F.col("__rf_k"), "left_anti")


def union_by_name(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    """O3: row-bind by column *name* (never by position)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out
