"""Sharding by longest-processing-time scheduling: equal texts stay together, shards get near-equal bytes."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.llm.common import stored

SHARDS = 24
#: Bytes that a row costs besides its text.
ROW_BYTES = 8
#: Items per shard on each level of ``item_of``, and the number of levels; together they bound the schedule.
PER_SHARD, LEVELS = 16, 6
#: A group is scheduled by itself from this share of a mean shard on.
LARGE = 1 / 256
#: Rows that get their slots in one task, about.
SLOT_ROWS = 200_000


def schedule(sizes: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Longest processing time first: items by falling size (ties: by name) go to the least-loaded shard.

    The heap holds (load, shard); of equal loads the smaller shard comes first.
    """
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, item in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heap[0]
        placed[item] = shard
        heapq.heapreplace(heap, (load + size, shard))
    return placed


def item_of(digest: Column, shards: int) -> Column:
    """The schedule's item of a group that is not large.

    A hash sends nine tenths of the groups to the first level, nine tenths of the rest to the second, and so
    on; each level has the same number of items. The schedule places the big items of the first levels first
    and evens the loads out with the ever smaller ones, as it would with single groups, but its length does
    not grow with the data.
    """
    u = F.pmod(F.xxhash64(digest), F.lit(10 ** LEVELS))
    level = F.lit(0)
    for k in range(1, LEVELS):
        level = F.when(u < 10 ** (LEVELS - k), F.lit(k)).otherwise(level)
    return F.concat(F.lit("h"), level.cast("string"), F.lit("-"), F.pmod(F.xxhash64(F.lit("item"), digest), F.lit(shards * PER_SHARD)).cast("string"))


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of ``docs`` under the law `bytes`.

    Size: bytes of the text in UTF-8 plus 8. Rows of equal texts form a group and share a shard; null
    and empty texts are one group. The sizes of groups are summed in Spark; those of at least a 256th of a mean
    shard (at most 256 for each shard) are scheduled one by one, the others as hash items. Only this bounded
    schedule passes the driver and is broadcast. No row moves but the narrow (doc_id, size, ...) ones, once.

    Slots are gapless from 0 in each shard, in the order of a hash of the row; within a group of copies the
    rows differ by doc_id and so spread. Repeated rows get slots of their own; a null doc_id is a value like
    any other. Other columns are ignored; an empty table gives an empty result.
    """
    text = F.col("text").cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES
    digest = F.sha2(F.coalesce(text, F.lit("")), 256)
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(text).alias("text_crc32"), digest.alias("digest")))

    groups = stored(rows.groupBy("digest").agg(F.sum("size").alias("size"), F.count("*").alias("n")))
    total = groups.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    large = F.col("size") >= max(1.0, float(total["size"]) / shards * LARGE)
    named = groups.withColumn("item", F.when(large, F.concat(F.lit("g"), "digest")).otherwise(item_of(F.col("digest"), shards)))
    sizes = [(int(r["size"]), r["item"]) for r in named.groupBy("item").agg(F.sum("size").alias("size")).collect()]
    placed = schedule(sizes, shards)
    spark = docs.sparkSession
    plan = spark.createDataFrame(sorted(placed.items()), "item string, shard int")
    single = F.broadcast(plan.where("item like 'g%'").select(F.expr("substring(item, 2)").alias("digest"), F.col("shard").alias("own")))
    shared = F.broadcast(plan.where("item like 'h%'").select("item", F.col("shard").alias("common")))
    out = rows.withColumn("item", item_of(F.col("digest"), shards)).join(single, "digest", "left").join(shared, "item", "left")
    # a null text has the checksum of no bytes
    out = out.select("doc_id", "size", F.coalesce("text_crc32", F.lit(0)).cast("long").alias("text_crc32"), F.coalesce("own", "common").alias("shard"))
    return _with_slots(out, shards, int(total["n"])).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _with_slots(rows: DataFrame, shards: int, n: int) -> DataFrame:
    """Number the rows of each shard in parts of bounded size, each from where the parts before it end."""
    parts = max(1, -(-n // (shards * SLOT_ROWS))) * 8
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(parts)))
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = stored(counts.withColumn("begin", before).select("shard", "part", "begin"))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size"))
    return rows.withColumn("within", within).join(begins, ["shard", "part"]).withColumn("slot", (F.col("begin") + F.col("within") - 1).cast("long"))
