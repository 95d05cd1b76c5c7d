"""Exact distinct counts that merge: ids as bitmaps per key.

A key's distinct ids are bits in bitmaps of 32,768 consecutive ids each (``bucket``). Bitmaps of finer keys (months)
merge by OR into those of coarser ones (school years, parts of a year) without the rows, so every count over months
comes from one read of them, and a table of monthly bitmaps only needs the new month. Ids should be dense
(``dense_ids``): a bitmap takes 4 KB however few bits are set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stored
from .keys import number_rows


def dense_ids(df: DataFrame, col: str) -> DataFrame:
    """(``col``, dense): the distinct non-NULL values of a column numbered from 1 in their order; stored."""
    values = stored(df.where(F.col(col).isNotNull()).select(col).distinct())
    return stored(number_rows(values, [col], id_col="dense"))


def id_bitmaps(rows: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """(keys, bucket, bitmap) of the distinct ids (integers) of each key; a key with NULL ids only keeps an empty bitmap.

    Ids are made distinct first (map-side combined, so a hot id is no burden), then dealt by bucket: a bitmap is
    built once and never shuffled half filled.
    """
    i = F.col(id_col).cast("bigint")
    each = rows.select(*keys, i.alias("__rf_id")).distinct()
    each = each.select(*keys, F.bitmap_bucket_number("__rf_id").alias("bucket"), F.bitmap_bit_position("__rf_id").alias("__rf_at"))
    return each.repartition("bucket").groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("__rf_at").alias("bitmap"))


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str | Column], **conditions: Column) -> DataFrame:
    """The bitmaps of coarser ``keys``: (keys, bucket, bitmap) and a bitmap for each of ``conditions``, over the rows that meet it."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"),
                                                *[F.bitmap_or_agg(F.when(c, F.col("bitmap"))).alias(n) for n, c in conditions.items()])


def count_bitmaps(bitmaps: DataFrame, keys: Sequence[str], count_col: str = "n_distinct") -> DataFrame:
    """(keys, count): how many distinct ids each key has (its bitmaps must be merged)."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias(count_col))
