"""Hourly and per-day prices on one hourly grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_prices(
    spine: DataFrame,
    hourly: DataFrame,
    daily: DataFrame,
    boundary_hour: int = 6,
    hourly_by: Sequence[str] = (),
    daily_by: Sequence[str] = (),
) -> DataFrame:
    """Left join an hourly price and a per-day price to the spine.

    ``hourly``: ``hour_utc``, ``electricity_price_eur_per_kwh``, one row per hour.
    ``daily``: ``gas_day``, ``gas_price_eur_per_m3``, one row per day, valid from
    ``boundary_hour`` local on that day to the same clock time a day later.

    A local date meets two daily prices: its own from the boundary on, and before
    it the one of the day before. Both are brought to the date first, on the small
    table, so the hours are joined by their own date, the key by which the spine is
    already distributed, and each hour picks one. This equals the interval test as
    long as the boundary is not inside the clock change, which is checked.
    """
    if not 4 <= boundary_hour <= 23:
        raise ValueError("boundary_hour must lie outside the hours of the clock change; use interval_attach")

    def applies(date: Column, own: bool) -> Column:
        return F.struct(date.alias("date_local"), F.lit(own).alias("_own"))

    def only(own: bool, column: str) -> Column:
        return F.max(F.when(F.col("_own") == own, F.col(column)))

    gas = (
        daily.select(
            *daily_by,
            "gas_day",
            "gas_price_eur_per_m3",
            F.inline(F.array(applies(F.col("gas_day"), True), applies(F.date_add("gas_day", 1), False))),
        )
        .groupBy(*daily_by, "date_local")
        .agg(
            only(True, "gas_day").alias("_own_day"),
            only(True, "gas_price_eur_per_m3").alias("_own_price"),
            only(False, "gas_day").alias("_earlier_day"),
            only(False, "gas_price_eur_per_m3").alias("_earlier_price"),
        )
    )
    electricity = hourly.select(*hourly_by, "hour_utc", "electricity_price_eur_per_kwh")
    after = F.hour("hour_local") >= boundary_hour
    return (
        spine.join(gas, [*daily_by, "date_local"], "left")
        .join(electricity, [*hourly_by, "hour_utc"], "left")
        .select(
            *spine.columns,
            "electricity_price_eur_per_kwh",
            F.when(after, F.col("_own_day")).otherwise(F.col("_earlier_day")).alias("gas_day"),
            F.when(after, F.col("_own_price")).otherwise(F.col("_earlier_price")).alias("gas_price_eur_per_m3"),
        )
    )
