"""Many hourly signals on one row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def consolidate_signals(driver: DataFrame, *signals: DataFrame, on: Sequence[str] = ("hour_utc",)) -> DataFrame:
    """Left join every signal to the driver, which sets the grain.

    All joins share one key, so the running result keeps its partitioning and
    each table is shuffled once. Signals hold at most one row per key.
    """
    return reduce(lambda left, right: left.join(right, list(on), "left"), signals, driver)
