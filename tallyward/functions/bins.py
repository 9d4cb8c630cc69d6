"""Bin numbers computed by arithmetic, so that no bin table needs joining."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def closed_right_bin(x: Column, lo: Column, hi: Column, n: int) -> Column:
    """1..n over [lo, hi], each bin open on the left except the first; one bin when lo = hi."""
    place = F.ceil(F.try_divide(x - lo, (hi - lo) / n)).cast("int")
    return F.when(x.isNotNull(), F.greatest(F.lit(1), F.least(F.lit(n), F.coalesce(place, F.lit(1)))))


def closed_left_bin(x: Column, lo: Column, hi: Column, n: int) -> Column:
    """1..n over [lo, hi], each bin open on the right except the last; one bin when lo = hi."""
    place = F.floor(F.try_divide(x - lo, (hi - lo) / n)).cast("int") + 1
    return F.when(x.isNotNull(), F.greatest(F.lit(1), F.least(F.lit(n), F.coalesce(place, F.lit(1)))))


def edge_bin(x: Column, lo: Column, hi: Column, n: int) -> Column:
    """0..n-1: how many of the n-1 inner edges of [lo, hi] are at or below the value.

    The outer bins reach to infinity, so values outside [lo, hi] count too.
    """
    width = (hi - lo) / n
    edges = [F.when(lo + F.lit(float(i)) * width <= x, 1).otherwise(0) for i in range(1, n)]
    total = edges[0]
    for e in edges[1:]:
        total = total + e
    return F.when(x.isNotNull(), total)
