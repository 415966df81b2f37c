"""Array helpers that stay O(n log n) per row."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_occurrences(arr: Column, key: Callable[[Column], Column]) -> Column:
    """Elements of ``arr`` whose ``key`` has not appeared earlier, in their
    original order.  Elements are tagged (key, position), sorted, kept when
    their key differs from the sorted neighbour's, and sorted back by
    position - instead of an ``array_position`` lookup per element, which is
    quadratic in the array length.  The sorted array is bound once through a
    one-element ``transform`` so the neighbour lookups do not re-sort."""
    tagged = F.array_sort(F.transform(arr, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("v"))))
    firsts = F.transform(F.array(tagged), lambda srt: F.filter(
        srt, lambda x, i: (i == 0) | ~F.get(srt, i - 1)["k"].eqNullSafe(x["k"])))
    back = F.array_sort(F.transform(F.get(firsts, 0), lambda x: F.struct(x["i"].alias("i"), x["v"].alias("v"))))
    return F.transform(back, lambda x: x["v"])
