"""Recodes and scalar text/number functions.

Code tables are data: each is a plain mapping below, turned into a ``when``
chain (small, ordered, NULL-aware) by :func:`recode`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from .nulls import _c, in_list

# --- fixed values (must equal the source scripts' codes) -------------------------
# E1 gender: fixed-width char codes, trailing blank is part of the value.
GENDER_CODES = {"M ": 0, "F ": 1}
GENDER_MISSING = 4
# E2 age groups and their integer codes.
AGE_GROUP_CODES = {"IT": 0, "PS": 1, "SA": 2}
# E2 space-type text fragments, checked in this order.
SPACE_TYPE_AGE = [("Infant/Toddler", "IT"), ("Preschool", "PS"), ("School Age", "SA")]
# E3 report labels.
AGE_GROUP_LABELS = {0: "Infant/Toddler", 1: "Preschool", 2: "School-age"}
TIME_LABELS = {0: "FT", 1: "PT"}
REGION_LABELS = {0: "East", 1: "NorthCentral", 2: "NorthWest", 3: "SouthCentral", 4: "SouthWest"}
# E5 region short codes.
REGION_CODES = {"e": 0, "nc": 1, "nw": 2, "sc": 3, "sw": 4}
# E4 exit category -> exit reason; any other exit date -> "Unknown".
EXIT_REASONS = [
    ("Moved to Another Town", "Moved within Connecticut"),
    ("Other", "Other"),
    ("Parent Withdrew Child", "Other"),
    ("Aged Out", "Aged out"),
    ("Child Stopped Attending", "Stopped attending"),
    ("Chose to Attend A Different Program", "Chose to attend a different program"),
]
EXIT_REASON_UNKNOWN = "Unknown"
# E6 report labels for flags.
ACCREDITED_LABELS = ("Acc.", "Una")
TITLE_I_LABELS = ("Title I", "Standard")
# E9 funding source codes.
FUNDING_SOURCE_CODES = {"CDC": 0}
# ----------------------------------------------------------------------------------


def recode(col: str | Column, mapping: Mapping, default=None) -> Column:
    """Map values through ``mapping`` (a ``case_when`` chain: no match -> ``default``)."""
    c = _c(col)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr if default is None else expr.otherwise(F.lit(default))


def gender_code(col: str | Column) -> Column:
    """NULL -> 4, ``"M "`` -> 0, ``"F "`` -> 1, anything else (``"M"``) -> NULL."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(GENDER_MISSING)).when(c == "M ", 0).when(c == "F ", 1)


def age_group_from_text(col: str | Column, fragments=SPACE_TYPE_AGE) -> Column:
    """First matching substring decides the age group; no match -> NULL."""
    c = _c(col)
    expr = None
    for frag, code in fragments:
        cond = c.contains(frag)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr


def exit_reason(category: str | Column, exit_date: str | Column) -> Column:
    """Ordered chain; the last branch sees the (already computed) exit date."""
    c = _c(category)
    expr = None
    for cat, reason in EXIT_REASONS:
        expr = F.when(c == cat, F.lit(reason)) if expr is None else expr.when(c == cat, F.lit(reason))
    return expr.when(_c(exit_date).isNotNull(), F.lit(EXIT_REASON_UNKNOWN))


def label_when(flag: str | Column, yes: str, no: str) -> Column:
    """``if_else(x == 1, yes, no)``; NULL stays NULL."""
    c = _c(flag)
    return F.when(c == 1, F.lit(yes)).when(c != 1, F.lit(no))


def funding_time(site_col: str | Column, age_col: str | Column, full_time_sites) -> Column:
    """Listed sites are full time (0); else school age is part time (1), other 0."""
    a = _c(age_col)
    by_age = F.when(a == "SA", F.lit(1)).when(a != "SA", F.lit(0))
    return F.when(in_list(site_col, full_time_sites), F.lit(0)).otherwise(by_age) if full_time_sites else by_age


def last_piece(col: str | Column, sep: str = ",") -> Column:
    """last ``sep``-separated piece, trimmed; one trailing empty piece is dropped."""
    pattern = "(" + _re_escape(sep) + ")$"
    stripped = F.regexp_replace(_c(col), pattern, "")
    return F.trim(F.element_at(F.split(stripped, _re_escape(sep)), -1))


def _re_escape(s: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?{}[]\\|()" else ch for ch in s)


def squish(col: str | Column) -> Column:
    """collapse whitespace runs to one blank."""
    return F.regexp_replace(_c(col), r"\s+", " ")


def digits_to_int(col: str | Column) -> Column:
    """keep digits only, then integer; empty or overflow -> NULL.

    Texts without a digit never reach the cast: a failed cast costs an exception per row.
    """
    digits = F.regexp_replace(_c(col), "[^0-9]", "")
    return F.when(F.length(digits) > 0, digits.try_cast("int"))


def concat_or_null(*cols) -> Column:
    """``"{a} {b}"`` unless a part is NULL, then NULL (plain ``concat``)."""
    return F.concat(*[c if isinstance(c, Column) else F.col(c) for c in cols])


def fill_key(id_col: str | Column, first: str | Column, last: str | Column,
             prefix: str = "TEMP") -> Column:
    """placeholder key ``TEMP-first-last`` for rows without an id (NA printed)."""
    return F.coalesce(
        _c(id_col).cast("string"),
        F.concat(F.lit(prefix + "-"), F.coalesce(_c(first).cast("string"), F.lit("NA")), F.lit("-"),
                 F.coalesce(_c(last).cast("string"), F.lit("NA"))))


def blank_placeholder(col: str | Column, marker: str = "TEMP") -> Column:
    """K6: placeholder keys become NULL on load (``grepl`` on NA is FALSE)."""
    c = _c(col)
    return F.when(~F.coalesce(c.contains(marker), F.lit(False)), c)


def tolerant_date(n_a, n_b, amount_a, amount_b, date_col, tol: float = 1.0) -> Column:
    """the date when sizes are equal and amounts differ by less than ``tol``."""
    cond = (_c(n_a) == _c(n_b)) & (F.abs(_c(amount_a) - _c(amount_b)) < tol)
    return F.when(cond, F.to_date(_c(date_col))).when(~cond, F.lit(None).cast("date"))


def keep_if_any(flags, value) -> Column:
    """keep ``value`` when any flag is true; NULL when none is (or unknown)."""
    cond = None
    for f in flags:
        cond = _c(f) if cond is None else (cond | _c(f))
    return F.when(cond, _c(value)).when(~cond, F.lit(None))


def eligibility_flag(income, max_income) -> Column:
    """``Y`` at or under the limit, ``N*`` above, NULL when either is NULL."""
    return F.when(_c(income) <= _c(max_income), F.lit("Y")).when(_c(income) > _c(max_income), F.lit("N*"))


def foster_override(foster, value, override) -> Column:
    """foster children report ``override`` (family of 1, income 0)."""
    f = _c(foster)
    return F.when(f == 0, _c(value)).when(f != 0, F.lit(override))


def presence_flag(col) -> Column:
    """``N`` when NULL, else ``Y``."""
    return F.when(_c(col).isNull(), F.lit("N")).otherwise(F.lit("Y"))


def space_label(time_col, age_col) -> Column:
    """``"{Time} {AgeGroup}"`` with NA rendered as text."""
    return F.concat(F.coalesce(_c(time_col), F.lit("NA")), F.lit(" "), F.coalesce(_c(age_col), F.lit("NA")))
