"""Market context per hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def market_hourly(prices: DataFrame, grid: DataFrame, weather: DataFrame, on: Sequence[str] = ("hour_utc",)) -> DataFrame:
    """Everything that is known of the market in an hour. An hour counts if it has an
    electricity price or a grid row; weather alone does not make one."""
    return (
        prices.join(grid.withColumn("_has_grid", F.lit(True)), list(on), "left")
        .where(F.col("electricity_price_eur_per_kwh").isNotNull() | F.col("_has_grid").isNotNull())
        .drop("_has_grid")
        .join(weather, list(on), "left")
    )
