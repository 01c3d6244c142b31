"""Arrays of ids as models return them, made safe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import col, strip


def distinct_in_order(a) -> Column:
    return F.array_distinct(col(a))


def valid_ids(a, n) -> Column:
    """Integers 0 <= id < n out of anything, distinct, ascending."""
    ints = F.transform(col(a), lambda x: x.try_cast("int"))
    return F.array_sort(F.array_distinct(F.filter(ints, lambda x: x.isNotNull() & (x >= 0) & (x < n))))


def in_domain(ids_in, ids_out, n, policy: str = "out") -> tuple[Column, Column]:
    """(in, out) ids of 1..n.  Policy `out`: an id in both is out; `in`: it is in.  Missing ids are out."""
    every = F.sequence(F.lit(1), col(n) if not isinstance(n, int) else F.lit(n))
    a, b = F.array_intersect(every, col(ids_in)), F.array_intersect(every, col(ids_out))
    inside = F.array_except(a, b) if policy == "out" else a
    return inside, F.array_except(every, inside)


def clean_strings(a) -> Column:
    """Stripped, without blanks, distinct in order."""
    return F.array_distinct(F.filter(F.transform(col(a), strip), lambda x: x.isNotNull() & (x != "")))
