"""NULL semantics of the source scripts, expressed as Spark columns.

Every rule lives here once; operators call these helpers instead of inlining
``when``/``coalesce`` chains. All helpers return ``Column`` objects, so they stay
inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def if_else(cond: Column, yes, no) -> Column:
    """Three-valued ``if_else``: a NULL condition gives NULL (not the else branch)."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond, yes).when(~cond, no)


def in_list(col: str | Column, values: Iterable) -> Column:
    """``x %in% values``: never NULL (a NULL ``x`` is simply not in the list)."""
    return F.coalesce(_c(col).isin(list(values)), F.lit(False))


def not_in_list(col: str | Column, values: Iterable) -> Column:
    """``!(x %in% values)``: keeps NULL ``x`` rows (P9, transform.r semantics)."""
    return ~in_list(col, values)


def null_if_in(col: str | Column, values: Iterable) -> Column:
    """Sentinel strings become NULL; everything else is kept."""
    c = _c(col)
    return F.when(~in_list(c, values), c)


def strict_min(col: str | Column) -> Column:
    """Aggregate ``min`` that is NULL as soon as one input is NULL (R without na.rm)."""
    c = _c(col)
    return F.when(F.max(c.isNull().cast("int")) == 1, F.lit(None)).otherwise(F.min(c))


def strict_max(col: str | Column) -> Column:
    """Aggregate ``max`` that is NULL as soon as one input is NULL (R without na.rm)."""
    c = _c(col)
    return F.when(F.max(c.isNull().cast("int")) == 1, F.lit(None)).otherwise(F.max(c))


def sum_or_zero(col: str | Column) -> Column:
    """``sum(x, na.rm=TRUE)``: 0 for an empty or all-NULL group (A1)."""
    return F.coalesce(F.sum(_c(col)), F.lit(0))


def eq_null_safe_cond(left_cols: Sequence[Column], right_cols: Sequence[Column],
                      nullable: Sequence[bool]) -> Column:
    """Join condition where NULL matches NULL on the nullable keys (R dplyr joins)."""
    cond = None
    for lc, rc, nn in zip(left_cols, right_cols, nullable):
        part = lc.eqNullSafe(rc) if nn else (lc == rc)
        cond = part if cond is None else (cond & part)
    return cond


def last_after_arrange(cols: Sequence[str | Column]) -> list[Column]:
    """Ordering whose first row is the *last* row of R's ``arrange(cols)``.

    R sorts NA last in ascending order, so the last row is the NA one: descending
    with NULLs first reproduces ``slice(n())``.
    """
    return [_c(c).desc_nulls_first() for c in cols]


def first_after_arrange(cols: Sequence[str | Column]) -> list[Column]:
    """Ordering whose first row is the first row of R's ``arrange(cols)`` (NA last)."""
    return [_c(c).asc_nulls_last() for c in cols]


def glue_text(*parts) -> Column:
    """``glue`` rendering: NULL pieces print as the text ``NA``."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("NA")) for c in cols])


def apply_all(df, fn, cols=None):
    """Apply one column function to all (or the given) columns, keeping names."""
    cols = list(cols or df.columns)
    return df.select(*[fn(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])
