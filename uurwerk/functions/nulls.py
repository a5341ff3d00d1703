"""Arithmetic with the NULL rules the hourly model relies on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_at_zero(x: Column) -> Column:
    """``max(0, x)`` that keeps NULL. ``greatest`` alone would skip the NULL and
    turn a missing temperature into zero heat demand."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), x))


def safe_divide(a: Column, b: Column) -> Column:
    """``a / b``, NULL where ``b`` is zero."""
    return F.try_divide(a, b)


def reconcile(primary: Column, variant: Column) -> Column:
    """One double out of a column that arrived split by type."""
    return F.coalesce(primary.cast("double"), variant)
