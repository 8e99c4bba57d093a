"""Exact means from additive parts, so that they survive any pre-aggregation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rounded_mean(total: Column, n: Column, digits: int = 0) -> Column:
    """total / n rounded half away from zero to ``digits``, in integer arithmetic.

    A decimal mean would round once to its own scale and then again; this rounds
    once.  NULL when there is nothing to average.
    """
    halves = F.abs(total) * F.lit(2 * 10**digits) + n
    units = F.call_function("div", halves, F.nullif(n * 2, F.lit(0)))
    signed = F.when(total < 0, -units).otherwise(units).cast("decimal(19,0)")
    return (signed / F.lit(10**digits)).cast(f"decimal({19 + digits},{digits})")
