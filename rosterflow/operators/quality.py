"""Data-quality gates.

A rule is a frame of violating rows. ``check`` turns rules into one result frame
``(rule, severity, n, sample)`` — one aggregate per rule, the sample being the least
and the greatest key for the message — and ``enforce`` raises when a
``stop`` rule has rows, like the reference's ``stop()`` calls.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..session import stored
from .dedupe import duplicates, late_key_groups

RESULTS = "rule string, severity string, n bigint, sample array<string>"


class QualityGateError(RuntimeError):
    """A stop-severity rule found violating rows."""


def one_value_per_group(df: DataFrame, group: Sequence[str], col: str, out_col: str = "n_values") -> DataFrame:
    """V1: groups (files) whose rows resolve to more than one value (organization)."""
    return (df.groupBy(*group).agg(F.count_distinct(col).alias(out_col))
              .where(F.col(out_col) > 1))


def late_key_violations(df: DataFrame, group_keys: Sequence[str], id_col: str) -> DataFrame:
    """V2: people seen both without and with a key."""
    return late_key_groups(df, group_keys, id_col)


def unique_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """V3/V6: rows whose key is not unique."""
    return duplicates(df, keys)


def lookup_key_violations(lookups: dict) -> list[tuple[str, DataFrame, str]]:
    """V6: every lookup table (``{name: (frame, key columns)}``) must be unique on its key."""
    return [(f"{name} key unique", duplicates(df, list(k)), "stop") for name, (df, k) in lookups.items()]


def inexact_matches(df: DataFrame, dist_col: str = "fuzzy") -> DataFrame:
    """V4: inexact fuzzy matches (warnings)."""
    return df.where(F.col(dist_col) > 0)


def check(spark, rules: Sequence[tuple[str, DataFrame, str]], sample_col: str | None = None) -> DataFrame:
    """Evaluate ``(name, violations, severity)`` rules into one result frame."""
    parts = []
    for name, violations, severity in rules:
        key = sample_col if sample_col and sample_col in violations.columns else violations.columns[0]
        # one pass: the count, and the least and greatest key as the sample
        k = F.col(key).cast("string")
        sample = F.array_distinct(F.array_compact(F.array(F.min(k), F.max(k))))
        parts.append(violations.agg(F.count(F.lit(1)).alias("n"), sample.alias("sample"))
                     .select(F.lit(name).alias("rule"), F.lit(severity).alias("severity"), "n", "sample"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass
class RowRule:
    """A rule on single rows: ``broken`` says whether a row breaks it, ``key`` names the row in the message."""
    name: str
    severity: str
    broken: Column
    key: Column


def stored_and_checked(df: DataFrame, rules: Sequence[RowRule]) -> tuple[DataFrame, DataFrame]:
    """``df`` stored, and the result frame of the rules, as ``check`` gives it.

    The rules are metrics of the write itself: the rows are neither read again nor computed twice.
    """
    seen = Observation()
    metrics = []
    for i, r in enumerate(rules):
        broken, key = F.coalesce(r.broken, F.lit(False)), r.key.cast("string")
        metrics += [F.count_if(broken).alias(f"n{i}"), F.min(F.when(broken, key)).alias(f"lo{i}"), F.max(F.when(broken, key)).alias(f"hi{i}")]
    kept = stored(df.observe(seen, *metrics))
    found = seen.get
    return kept, result_frame(df.sparkSession, [
        (r.name, r.severity, found[f"n{i}"], sorted({x for x in (found[f"lo{i}"], found[f"hi{i}"]) if x is not None})) for i, r in enumerate(rules)])


def result_frame(spark: SparkSession, results: list[tuple]) -> DataFrame:
    return spark.createDataFrame(results, RESULTS)


def enforce(results: DataFrame) -> DataFrame:
    """Raise :class:`QualityGateError` when a ``stop`` rule has violations."""
    bad = results.where((F.col("severity") == "stop") & (F.col("n") > 0)).collect()
    if bad:
        msg = "; ".join(f"{r['rule']}: {r['n']} rows (e.g. {', '.join(r['sample'] or [])})" for r in bad)
        raise QualityGateError(msg)
    return results
