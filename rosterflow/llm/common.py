"""Helpers shared by the training-data operators: stored intermediates, text batches, connected groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.session import drop_stored, stored

#: Characters of text that a Python task handles at once; a longer single text is handled alone.
SLICE_CHARS = 2_000_000


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of ``texts`` holding about ``limit`` characters each."""
    return _ranges([len(text) for text in texts], limit)


def _ranges(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def arrow_slices(column: pa.Array, limit: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Consecutive parts of an Arrow column of texts, of about ``limit`` bytes each: their first rows and texts; null counts as empty.

    Only one part's texts are Python strings at a time. After the last one the memory that is free goes back to the
    system: a worker outlives its task, and what it holds counts beside the next task's.
    """
    for start, end in _ranges(pc.fill_null(pc.binary_length(column), 0).to_pylist(), limit):
        yield start, ["" if text is None else text for text in column.slice(start, end - start).to_pylist()]
    pa.default_memory_pool().release_unused()


def texts_of(column: pd.Series) -> list[str]:
    """The texts of an Arrow column; null counts as empty."""
    return ["" if text is None else text for text in column.tolist()]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word, the same in every process."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    column = np.empty(len(words), dtype=object)
    column[:] = words
    return pd.util.hash_array(column, categorize=False)


def gather(flat: np.ndarray, start: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices flat[start[i]:start[i + 1]] for all i of ``index`` in a row, and their lengths."""
    lengths = start[index + 1] - start[index]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start[index] - (ends - lengths), lengths) + np.arange(total)], lengths


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(33)
    return x


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns (id, root) for every id in ``edges`` (a, b): root is the smallest id that it reaches.

    Alternating large-star and small-star steps on the edge table. Both need only a minimum per vertex
    (partially aggregated) and a join back, so a vertex with very many edges never meets in one task. Each
    round is stored, and the one before dropped; the loop ends when the edges are a star around each root. Null
    ends and loops are ignored; an empty table gives an empty result. The result is stored.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while not _is_star(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        # the other neighbours hang on the least one; the vertex itself comes from the aggregate
        small_ = large.join(root, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last, edges = edges, stored(small_.unionByName(root.select("a", F.col("m").alias("b"))).groupBy("a", "b").agg(F.lit(1).alias("n")).select("a", "b"))
        drop_stored(last)
    roots = stored(edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("id"), "root").unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()))
    drop_stored(edges)
    return roots


def _is_star(edges: DataFrame) -> bool:
    """Whether every id has one parent (or is one), so that all edges lead to roots."""
    ends = edges.select(F.col("a").alias("id"), F.col("b").alias("up"), F.lit(0).alias("above")).unionByName(
        edges.select(F.col("b").alias("id"), F.lit(None).cast("long").alias("up"), F.lit(1).alias("above")))
    each = ends.groupBy("id").agg(F.max("above").alias("above"), F.min("up").alias("lo"), F.max("up").alias("hi"))
    return each.where("lo <> hi or above = 1 and lo is not null").limit(1).count() == 0


def candidates(facts: DataFrame) -> DataFrame:
    """(bucket, slot, id) of the buckets ``keys`` of ``facts`` (id, keys, ...) that several ids share; stored."""
    members = facts.select("id", F.posexplode("keys").alias("slot", "bucket"))
    shared = members.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("bucket")
    return stored(members.join(shared, "bucket").select("bucket", "slot", "id"))


#: Rows on each side of a cell, whose pairs are compared in one task.
CELL = 256


def _in_cells(rows: DataFrame, side: str, other: str, sizes: dict[str, Column]) -> DataFrame:
    """``rows`` with the cells (cell_a, cell_b) of their bucket that they are in: one by their id on their own side, all on the other."""
    own = F.pmod(F.xxhash64("id"), F.greatest(sizes[side], F.lit(1))).cast("int")
    across = F.sequence(F.lit(0), F.greatest(sizes[other], F.lit(1)).cast("int") - 1)
    return rows.withColumn(f"cell_{side}", own).withColumn(f"cell_{other}", F.explode(across))


def linked_groups(members: DataFrame, facts: DataFrame, verify: Callable[[DataFrame], DataFrame], may_link: Callable[[str, str], Column] | None = None,
                  star_rounds: int = 2, share: float = 4, slotted: bool = True, values: DataFrame | None = None,
                  linked: Callable[[str, str], Column] | None = None) -> DataFrame:
    """Components (id, root) of all verified links between ids that share a bucket.

    ``members`` are the ``candidates`` of ``facts`` (id, keys, ...; each id has equally many keys, each found at
    its own place in keys, unless not ``slotted``); ``verify`` takes pairs (a, b) and returns those that are truly linked. A bucket's
    pairs are never emitted at once: in each round a bucket's smallest id is compared with the others and leaves
    the bucket; ids that are already in the same component need no comparison, and a bucket whose ids are all in
    one component is finished. Large groups of copies end after a round or two. When the open pairs, between
    different components of one bucket, are no more than ``share`` for each row (or after ``star_rounds``), each
    is compared once, in its first common bucket, unless ``may_link`` on the columns of ``facts`` (suffixed _a
    and _b) rules it out. So no link between different components is ever skipped, and no bucket size is capped.
    The rounds' tables are dropped as soon as the next ones are stored; the groups are stored.

    The open pairs of a bucket grow with the square of its size, so nothing is shuffled for each of them if ``linked``,
    a condition on the columns of ``facts`` and ``values`` (id, ...; both suffixed) that says what ``verify`` says, is
    given: a bucket's rows are then dealt over cells of CELL by CELL rows, and a cell's pairs are compared where its
    rows meet.
    """
    n_keys = facts.agg(F.coalesce(F.max(F.size("keys")), F.lit(0)).alias("n")).first()["n"] if slotted else 0
    members = members.withColumn("label", F.col("id"))
    groups, round_ = None, []
    for step in range(star_rounds + 1):
        if step:
            members = stored(members)
            drop_stored(*round_)
            round_ = [members]
        per_label = members.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.min("id").alias("id"))
        spread = per_label.groupBy("bucket").agg(F.count("*").alias("labels"), F.min(F.struct("id", "label")).alias("first"), F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("n"),
                                                 F.sum(F.col("n") * F.col("n")).alias("squares")).where("labels > 1")
        spread = stored(spread.select("bucket", F.col("first.id").alias("leader"), F.col("first.label").alias("la"), F.col("most.label").alias("main"), F.col("most.n").alias("bucket_main"), F.col("n").alias("bucket_n"), ((F.col("n") * F.col("n") - F.col("squares")) / 2).alias("pairs")))
        round_.append(spread)
        size = spread.agg(F.sum("bucket_n").alias("rows"), F.sum("pairs").alias("pairs")).first()
        if not size["rows"]:
            break
        last = step == star_rounds or size["pairs"] <= share * size["rows"]
        open_ = members.join(spread.select("bucket", "leader", "la", "main", "bucket_n", "bucket_main"), "bucket")
        if last:
            rows = open_.select("bucket", "slot", "id", "label", (F.col("label") == F.col("main")).alias("in_main"), "bucket_n", "bucket_main").join(facts, "id")
            meet, in_cells = ["bucket"], linked is not None and values is not None
            if in_cells:
                rows, meet = rows.join(values, "id"), ["bucket", "cell_a", "cell_b"]
            # a bucket's largest component stands on one side only: its own pairs are never enumerated
            sizes = {"a": F.ceil((F.col("bucket_n") - F.col("bucket_main")) / CELL), "b": F.ceil(F.col("bucket_n") / CELL)}
            left, right = (_in_cells(rows, side, other, sizes) if in_cells else rows for side, other in ("ab", "ba"))
            left, right = (df.select(*meet, *[F.col(c).alias(f"{c}_{side}") for c in df.columns if c not in (*meet, "bucket_n", "bucket_main")]) for df, side in ((left, "a"), (right, "b")))
            left = left.where("not in_main_a")
            new = (F.col("in_main_b") | (F.col("id_a") < F.col("id_b"))) & (F.col("label_a") != F.col("label_b"))
            for i in range(n_keys - 1):
                new &= (F.col("slot_a") <= i) | (F.get("keys_a", F.lit(i)) != F.get("keys_b", F.lit(i)))
            new = new if may_link is None else new & may_link("_a", "_b")
            if not slotted:
                new &= F.col("bucket") == F.array_min(F.array_intersect("keys_a", "keys_b"))
            if in_cells:
                new = F.when(new, linked("_a", "_b")).otherwise(F.lit(False))
            pairs = left.join(right, meet).where(new)
            pairs = pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
            found = pairs if in_cells else verify(pairs.distinct())
        else:
            found = verify(open_.where("label <> la").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct())
        if groups is not None:
            found = found.unionByName(groups.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
        before, groups = groups, connected_components(found)
        if before is not None:
            drop_stored(before)
        if last:
            break
        members = open_.where("id <> leader").select("bucket", "slot", "id").join(groups, "id", "left").select("bucket", "slot", "id", F.coalesce("root", "id").alias("label"))
    groups = stored(members.select("id", F.col("id").alias("root")).limit(0)) if groups is None else groups
    drop_stored(*round_)
    return groups


#: Values (8 bytes each, about) up to which a measured join side is broadcast: some 30 MB.
BROADCAST_VALUES = 500_000


def small(df: DataFrame, weight: Column | None = None, values: int = BROADCAST_VALUES) -> DataFrame:
    """``df`` (stored), marked for broadcast if it is found to hold few values; else joins shuffle both sides.

    ``weight`` counts the values of a row with arrays; without it a row is one value.
    """
    if weight is None:
        few = df.limit(values + 1).count() <= values
    else:
        few = (df.agg(F.sum(weight + 1).alias("n")).first()["n"] or 0) <= values
    return F.broadcast(df) if few else df
