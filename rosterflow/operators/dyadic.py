"""Intervals of period numbers as nodes of a dyadic tree, so that stabbing joins are equi-joins.

A node of level k stands for 2^k consecutive numbers. An interval is the disjoint union of at most 2 log n
nodes (``cover``), a number lies in one node of each level (``path``), and it lies in the interval exactly if one
node of its path is in the cover, and then in only one. So ``interval contains number`` is one equi-join on the
node that finds each pair once, and an interval costs O(log n) rows instead of one row per number.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Numbers from LOWEST to HIGHEST (months: over 5,000 years) have nodes; an open end is HIGHEST.
LEVELS = 16
LOWEST, HIGHEST = -(1 << (LEVELS - 1)), (1 << (LEVELS - 1)) - 1
_LEVEL = 1 << (LEVELS + 1)


def cover(lo: str, hi: str) -> Column:
    """The nodes (array<int>) whose union is ``lo .. hi`` (columns; clamped to LOWEST .. HIGHEST); empty if lo > hi.

    At each level the leftmost node is taken if it is a right child, the rightmost one if it is a left child; what is
    left are whole nodes of the next level. A NULL end gives NULL.
    """
    a, b = f"(greatest(cast({lo} as int), {LOWEST}) - {LOWEST})", f"(least(cast({hi} as int), {HIGHEST}) - {LOWEST} + 1)"
    left, right = f"shiftright({a} + shiftleft(1, k) - 1, k)", f"shiftright({b}, k)"
    nodes = (f"filter(array(if({left} < {right} and {left} % 2 = 1, k * {_LEVEL} + {left}, -1), "
             f"if({left} < {right} and {right} % 2 = 1, k * {_LEVEL} + {right} - 1, -1)), n -> n >= 0)")
    # a level of nodes longer than the interval has none of them
    levels = f"least(cast(log2({b} - {a}) as int) + 1, {LEVELS})"
    return F.expr(f"case when {lo} is null or {hi} is null then null when {a} >= {b} then cast(array() as array<int>) "
                  f"else flatten(transform(sequence(0, {levels}), k -> {nodes})) end")


def path(number: Column | str) -> Column:
    """The nodes (array<int>) that hold ``number``, one for each level; NULL outside LOWEST .. HIGHEST."""
    n = F.col(number) if isinstance(number, str) else number
    levels = [F.lit(k * _LEVEL) + F.shiftright(n.cast("int") - F.lit(LOWEST), k) for k in range(LEVELS + 1)]
    return F.when(n.between(LOWEST, HIGHEST), F.array(*levels))
