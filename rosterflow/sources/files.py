"""Typed readers for delimited exports and relational tables.

Schemas are declared, never inferred; text that must become numbers or dates is
cast with ``try_cast``-style functions so bad cells become NULL (ANSI mode would
otherwise fail the job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.nulls import null_if_in
from ..functions.recode import last_piece
from .lookups import RATES_SCHEMA

# --- fixed values: program list layout -------------------------------------------
# 0-based positions of the kept columns in the 83-column contact list, and names.
PROGRAM_COLUMNS = [(6, "contractor"), (32, "name"), (33, "address"), (34, "town"), (35, "zip"),
                   (36, "license_no"), (37, "naeyc_id"), (39, "registry_id"), (40, "facility_code")]
PROGRAM_WIDTH = 83
LICENCE_SENTINELS = ["Exempt", "?"]
# ----------------------------------------------------------------------------------


def read_programs(spark: SparkSession, path: str, skip_header: bool = True,
                  sentinels=LICENCE_SENTINELS) -> DataFrame:
    """The program list (CSV export), 9 of 83 columns as text.

    Rows without a name are dropped, sentinel licences become NULL and the
    organization name is the contractor's last comma-separated piece.
    """
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(PROGRAM_WIDTH)])
    raw = spark.read.schema(schema).option("header", skip_header).option("mode", "PERMISSIVE").csv(path)
    df = raw.select(*[F.col(f"_c{i}").alias(name) for i, name in PROGRAM_COLUMNS])
    return (df.where(F.col("name").isNotNull())
              .withColumn("license_no", null_if_in("license_no", sentinels))
              .withColumn("org_name", last_piece("contractor", ",")))


def read_birthdates(spark: SparkSession, path: str) -> DataFrame:
    """Supplementary birth dates, text key + date with one- or two-digit month and day, distinct rows."""
    return (spark.read.schema("SASID string, Birthdate date").option("header", True)
            .option("dateFormat", "M/d/yyyy").csv(path).distinct())


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    """A rate grid CSV with declared types."""
    return spark.read.schema(RATES_SCHEMA).option("header", True).csv(path)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A relational table read in parallel ranges of ``partition_column``.

    One query per partition instead of one result set through one connection;
    filters and column pruning are pushed into the generated SQL by Spark.
    """
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast text columns to declared types; unparsable values become NULL."""
    out = df
    for c, t in types.items():
        out = out.withColumn(c, F.col(c).try_cast(t))
    return out
