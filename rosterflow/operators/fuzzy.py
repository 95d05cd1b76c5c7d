"""Fuzzy matching on text keys.

``fuzzy_join`` finds all pairs within Levenshtein distance ``max_dist`` without a
nested-loop join. Strings are first reduced to their *distinct* values (the key
domain is far smaller than the rows: a licence number repeats for every child of
a centre), then matched by deletion-neighbourhood blocking: every string emits
itself and each variant with ``k <= max_dist`` characters deleted; two strings
within distance ``max_dist`` always share a variant, so an equi-join on the
variant finds every candidate pair. Candidates are verified with Spark's
thresholded ``levenshtein`` and joined back to the rows. All of it is hash joins and
aggregates. For distances of 2 and more the variants would grow as ``len^k``; there one
side is cut into ``k + 1`` even segments, of which ``k`` edits leave one whole
(pigeonhole), and the other side offers the substrings that can be such a segment: a
number of keys per string that depends on ``k`` alone.

Skew: because keys are distinct before blocking, the strings sharing one
variant ``v`` (for k = 1) are exactly the distinct strings obtained by inserting
one character into ``v`` — at most ``(len(v) + 1) x |alphabet|`` of them — so a
variant group, and the candidate pairs it produces, is bounded by key length
and alphabet, never by the number of rows. A licence shared by a third of all
rows is one key here; its rows only meet again in the final join back, whose
skewed partition AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .dedupe import first_per_key


def _deletion_variants(s: Column, max_dist: int) -> Column:
    """Array of ``s`` and every string obtained by deleting up to ``max_dist`` chars."""
    def one_deletion(v: Column) -> Column:
        positions = F.sequence(F.lit(1), F.greatest(F.length(v), F.lit(1)))
        return F.array_union(F.array(v), F.transform(
            positions, lambda i: F.concat(v.substr(F.lit(1), i - 1), v.substr(i + 1, F.lit(1 << 30)))))

    variants = F.array(s)
    for _ in range(max_dist):
        variants = F.array_distinct(F.flatten(F.transform(variants, one_deletion)))
    return variants


def _segment(length: str, i: str, k: int) -> tuple[str, str]:
    """SQL: start and size of segment ``i`` of ``k + 1`` even ones of a string of ``length``; the last ones are longer."""
    short = f"({k + 1} - {length} % {k + 1})"           # so many segments have the smaller size
    return f"({i} * ({length} div {k + 1}) + greatest(0, {i} - {short}))", f"({length} div {k + 1} + if({i} >= {short}, 1, 0))"


def _segments(col: str, k: int) -> Column:
    """The ``k + 1`` segments of a string, each with its place and the string's length."""
    start, size = _segment(f"length({col})", "i", k)
    return F.expr(f"transform(sequence(0, {k}), i -> concat_ws(':', length({col}), i, substring({col}, cast({start} + 1 as int), cast({size} as int))))")


def _windows(col: str, k: int) -> Column:
    """The substrings that can be a segment of a string within distance ``k``: for every such length and segment those
    whose shift leaves no more edits before it than segments, nor after it."""
    start, size = _segment("n", "i", k)
    shift = f"(length({col}) - n)"
    low = f"greatest(0, {start} - i, {start} + {shift} - ({k} - i))"
    high = f"least(length({col}) - {size}, {start} + i, {start} + {shift} + ({k} - i))"
    pieces = f"transform(sequence(cast({low} as int), cast({high} as int)), at -> concat_ws(':', n, i, substring({col}, at + 1, cast({size} as int))))"
    return F.expr(f"array_distinct(flatten(flatten(transform(sequence(greatest(length({col}) - {k}, 0), length({col}) + {k}), n -> "
                  f"transform(sequence(0, {k}), i -> if({low} <= {high}, {pieces}, cast(array() as array<string>)))))))")


def fuzzy_key_pairs(left_keys: DataFrame, right_keys: DataFrame, max_dist: int = 1) -> DataFrame:
    """Distinct key pairs ``(lkey, rkey, dist)`` with ``levenshtein <= max_dist``.

    Inputs are one-column frames of (possibly repeated) non-NULL strings.
    """
    lk = left_keys.select(F.col(left_keys.columns[0]).alias("lkey")).where("lkey is not null").distinct()
    rk = right_keys.select(F.col(right_keys.columns[0]).alias("rkey")).where("rkey is not null").distinct()
    if max_dist < 2:
        left, right = _deletion_variants(F.col("lkey"), max_dist), _deletion_variants(F.col("rkey"), max_dist)
    else:
        left, right = _segments("lkey", max_dist), _windows("rkey", max_dist)
    lv = lk.select("lkey", F.explode(left).alias("variant"))
    rv = rk.select("rkey", F.explode(right).alias("variant"))
    cand = lv.join(rv, "variant").select("lkey", "rkey").distinct()
    dist = F.levenshtein("lkey", "rkey", max_dist)
    return cand.withColumn("dist", dist).where(F.col("dist") >= 0)


def fuzzy_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
               max_dist: int = 1, dist_col: str = "fuzzy") -> DataFrame:
    """``stringdist_inner_join(method="lv", max_dist, distance_col)``.

    Returns every (left row, right row) pair within ``max_dist`` plus the
    distance (INT). Rows with a NULL key never match.
    """
    pairs = fuzzy_key_pairs(left.select(left_key), right.select(right_key), max_dist)
    out = (left.join(pairs, left[left_key] == pairs["lkey"], "inner")
               .join(right, F.col("rkey") == right[right_key], "inner")
               .withColumnRenamed("dist", dist_col)
               .drop("lkey", "rkey"))
    return out


def best_match(pairs: DataFrame, keys, dist_col: str = "fuzzy", tiebreak=()) -> DataFrame:
    """Per key the smallest distance; ties to the smallest ``tiebreak``."""
    return first_per_key(pairs, list(keys), [dist_col], list(tiebreak))


def fuzzy_warnings(matches: DataFrame, template_parts, dist_col: str = "fuzzy",
                   msg_col: str = "message") -> DataFrame:
    """One templated message per inexact match (``glue`` renders NA as text)."""
    from ..functions.nulls import glue_text
    return matches.where(F.col(dist_col) > 0).withColumn(msg_col, glue_text(*template_parts))
