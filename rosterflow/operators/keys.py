"""Surrogate keys and key remapping.

``assign_ids`` numbers rows 1..n in a total order without a single-partition
window: the frame is range-partitioned on the order, each partition's local
position comes from ``monotonically_increasing_id`` (row index inside the sorted
partition), and per-partition (and per-group) counts — one row per partition and
group, a bounded table — give the offsets. One range shuffle, reused by both
passes (the tagged frame is checkpointed once, see ``_sorted_by_range``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.nulls import _c, eq_null_safe_cond
from ..session import cut_lineage

#: Columns of the numbering itself; frames that are numbered may have working columns of their own (``__rf_local`` of the load).
_PID = "__rf_numbering_pid"
_LOCAL = "__rf_numbering_local"


def _sorted_by_range(df: DataFrame, order: Sequence[Column], num_partitions: int | None) -> DataFrame:
    """Range-partition and sort on ``order``, tag partition id and in-partition position.

    The result is a reliable checkpoint (shared ``spark.checkpoint.dir``): the
    counting pass and the numbering pass must see the *same* partitions, and two
    independently planned range exchanges may sample different bounds. The
    checkpoint also survives executor loss, unlike a cached frame.
    """
    # Without an explicit count AQE may coalesce *adjacent* range partitions
    # (each merged partition is still a contiguous key range), so small inputs
    # do not leave thousands of near-empty partitions.
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    tagged = (ranged.sortWithinPartitions(*order)
                .withColumn(_PID, F.spark_partition_id())
                .withColumn(_LOCAL, F.monotonically_increasing_id()
                            - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)))
    return cut_lineage(tagged)


def assign_ids(df: DataFrame, order_cols: Sequence[str | Column], id_col: str = "id",
               group_cols: Sequence[str] = (), start: int = 1,
               num_partitions: int | None = None) -> DataFrame:
    """``row_number()`` as a distributed two-pass numbering.

    ``order_cols`` must give a total order (within ``group_cols``) for the ids to
    be repeatable. With ``group_cols`` the numbering restarts per group (report
    line numbers, O1). Returns ``df``'s columns plus ``id_col`` (BIGINT).
    """
    group = [F.col(g) for g in group_cols]
    order = [*(g.asc_nulls_first() for g in group), *(_c(o) for o in order_cols)]
    ranged = _sorted_by_range(df, order, num_partitions)

    # one row per (partition, group): how many rows, and where the group starts
    counts = ranged.groupBy(_PID, *group_cols).agg(
        F.count(F.lit(1)).alias("__rf_n"), F.min(_LOCAL).alias("__rf_first"))
    w = Window.partitionBy(*group_cols).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        _PID, *group_cols, "__rf_first",
        F.coalesce(F.sum("__rf_n").over(w), F.lit(0)).alias("__rf_offset"))
    if not group_cols:
        # bounded by the number of partitions: safe to broadcast
        offsets = F.broadcast(offsets)

    o = offsets.alias("__rf_o")
    r = ranged.alias("__rf_r")
    cond = F.col(f"__rf_r.{_PID}") == F.col(f"__rf_o.{_PID}")
    if group_cols:
        cond = cond & eq_null_safe_cond([F.col(f"__rf_r.{g}") for g in group_cols],
                                        [F.col(f"__rf_o.{g}") for g in group_cols],
                                        [True] * len(group_cols))
    out = r.join(o, cond, "inner").select(
        *[F.col(f"__rf_r.`{c}`") for c in df.columns],
        (F.col("__rf_o.__rf_offset") + F.col(f"__rf_r.{_LOCAL}") - F.col("__rf_o.__rf_first")
         + F.lit(start)).cast("bigint").alias(id_col))
    return out


def number_rows(df: DataFrame, order_cols: Sequence[str], id_col: str = "id", start: int = 1,
                rows_per_range: int = 1_000_000, most_ranges: int = 4_096, at_most: int | None = None) -> DataFrame:
    """``row_number()`` in ascending order (NULLs first) of ``order_cols``, a total order, without a checkpoint.

    The ranges are deterministic: their splitters are quantiles of a sample that a hash of the key picks, so the
    counting pass and the numbering pass, which both read ``df``, agree (``df`` should be a stored table or cheap
    to read twice). A row finds its range by binary search in the splitters, a lazy scalar subquery of about 64
    keys a range at most. Few enough rows are one range; ``at_most`` is a known bound, which saves the count.
    """
    n = df.count() if at_most is None or at_most > rows_per_range else at_most
    ranges = min(most_ranges, -(-n // rows_per_range))
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    if ranges <= 1:
        position = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
        return df.withColumn(id_col, (position + F.lit(start - 1)).cast("bigint"))
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order_cols)])
    share = int(min(1.0, 64 * ranges / n) * (1 << 30))
    sample = df.where(F.shiftrightunsigned(F.xxhash64(*order_cols), 34) < share).select(key.alias("k"))
    picked = sample.agg(F.sort_array(F.collect_list("k")).alias("k")).select(F.transform(
        F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get("k", F.floor(i * F.size("k") / ranges).cast("int"))).alias("k"))
    splitters, depth = picked.scalar(), (ranges - 1).bit_length()
    # the number of splitters up to the key, one bit of it after the other; the splitters rise
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(depth))])
    found = F.reduce(steps, F.lit(0), lambda at, step: F.when(
        F.coalesce(F.get("__rf_numbering_splitters", at + step - 1) <= F.col("__rf_numbering_key"), F.lit(False)), at + step).otherwise(at))
    tagged = df.withColumns({"__rf_numbering_splitters": splitters, "__rf_numbering_key": key}).withColumn(_PID, found).drop("__rf_numbering_splitters", "__rf_numbering_key")
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__rf_numbering_n"))
    before = Window.partitionBy(F.lit(0)).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum("__rf_numbering_n").over(before), F.lit(0)).alias("__rf_numbering_offset"))   # a row per range
    position = F.row_number().over(Window.partitionBy(_PID).orderBy(*order))
    return (tagged.withColumn(_LOCAL, position).join(F.broadcast(offsets), _PID)
                  .withColumn(id_col, (F.col("__rf_numbering_offset") + F.col(_LOCAL) + F.lit(start - 1)).cast("bigint"))
                  .select(*df.columns, id_col))


def running_total(df: DataFrame, order_cols: Sequence[str | Column], weight: str | Sequence[str],
                  out_col: str = "cum", group_cols: Sequence[str] = (),
                  num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``weight`` in order (per group), without a global window.

    Range partition on (group, order); a running sum inside each partition;
    per-(partition, group) totals — a bounded table — give the offsets that are
    joined back. A hot group is spread over many range partitions. With several
    weight columns the outputs are ``<out_col>_<weight>``.
    """
    weights = [weight] if isinstance(weight, str) else list(weight)
    outs = [out_col] if isinstance(weight, str) else [f"{out_col}_{w}" for w in weights]
    group = [F.col(g) for g in group_cols]
    order = [*(g.asc_nulls_first() for g in group), *(_c(o) for o in order_cols)]
    ranged = _sorted_by_range(df, order, num_partitions)
    local = Window.partitionBy(_PID, *group_cols).orderBy(_LOCAL).rowsBetween(Window.unboundedPreceding, 0)
    with_local = ranged.select("*", *[F.sum(w).over(local).alias(f"__rf_l{i}") for i, w in enumerate(weights)])
    totals = ranged.groupBy(_PID, *group_cols).agg(*[F.sum(w).alias(f"__rf_t{i}") for i, w in enumerate(weights)])
    wt = Window.partitionBy(*group_cols).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"__rf_o_{c}") for c in (_PID, *group_cols)],
                            *[F.coalesce(F.sum(f"__rf_t{i}").over(wt), F.lit(0)).alias(f"__rf_off{i}")
                              for i in range(len(weights))])
    if not group_cols:
        offsets = F.broadcast(offsets)       # one row per partition
    cond = eq_null_safe_cond([F.col(c) for c in (_PID, *group_cols)],
                             [F.col(f"__rf_o_{c}") for c in (_PID, *group_cols)],
                             [False] + [True] * len(group_cols))
    out = with_local.join(offsets, cond)
    for i, o in enumerate(outs):
        out = out.withColumn(o, F.col(f"__rf_off{i}") + F.col(f"__rf_l{i}"))
    return out.drop(_PID, _LOCAL, *[f"__rf_l{i}" for i in range(len(weights))],
                    *[f"__rf_off{i}" for i in range(len(weights))], *[f"__rf_o_{c}" for c in (_PID, *group_cols)])


def remap_keys(df: DataFrame, key_map: DataFrame, col: str, local_col: str = "local_id",
               target_col: str = "target_id", keep_unmapped: bool = False) -> DataFrame:
    """K3: replace local ids in ``col`` by target ids via an equi-join on a key map.

    Inner by default (the loader's inner joins drop rows whose parent was not
    loaded); ``keep_unmapped`` keeps them with a NULL target.
    """
    m = key_map.select(F.col(local_col).alias("__rf_local_key"), F.col(target_col).alias("__rf_target"))
    how = "left" if keep_unmapped else "inner"
    return (df.join(m, F.col(col) == F.col("__rf_local_key"), how)
              .withColumn(col, F.col("__rf_target"))
              .drop("__rf_local_key", "__rf_target"))


def remap_dimension(facts: DataFrame, dim: DataFrame, fact_col: str, dim_col: str,
                    mapping: dict) -> tuple[DataFrame, DataFrame]:
    """Drop dimension members and redirect facts (``{from: to}``).

    The mapping is a literal, so its size is bounded by the caller: it becomes a
    ``create_map`` expression (no join at all).
    """
    if not mapping:
        return facts, dim
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    new_facts = facts.withColumn(fact_col, F.coalesce(F.element_at(m, F.col(fact_col)), F.col(fact_col)))
    new_dim = dim.filter(~F.coalesce(F.col(dim_col).isin(list(mapping.keys())), F.lit(False)))
    return new_facts, new_dim


def resolve_by_name(df: DataFrame, dim: DataFrame, name_col: str, dim_name_col: str,
                    dim_id_col: str, out_col: str) -> DataFrame:
    """K9: look a parent id up by its name for any number of rows (left join)."""
    d = dim.select(F.col(dim_name_col).alias("__rf_name"), F.col(dim_id_col).alias(out_col))
    return df.join(d, F.col(name_col) == F.col("__rf_name"), "left").drop("__rf_name")
