"""Scenarios side by side per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uurwerk.functions.nulls import safe_divide

# Output suffix → (hourly column, value an hour of another scenario adds)
DAILY_SUMS = {
    "electricity_kwh": ("electricity_kwh", 0.0),
    "gas_m3": ("gas_m3", 0.0),
    "electricity_cost_eur": ("electricity_cost_eur", None),
    "gas_cost_eur": ("gas_cost_eur", None),
    "total_cost_eur": ("total_energy_cost_eur", None),
    "co2_kg": ("total_co2_kg", None),
}


def daily_compare(
    hourly: DataFrame,
    baseline: str = "baseline",
    optimized: str = "optimized",
    day: str = "date_local",
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per day with a column set per scenario and the savings.

    Amounts of energy are summed over zero for the other scenario's hours; costs
    and CO2 over NULL, so a day without any priced hour has no cost instead of a
    cost of zero. ``is_complete`` looks at the baseline's cost only: a gap in the
    grid signal does not clear it.
    """
    aggregates = []
    for name in (baseline, optimized):
        mine = F.col("scenario") == name
        aggregates.append(F.count_if(mine & F.col("is_lighting_on")).alias(f"{name}_lighting_hours"))
        for suffix, (column, other) in DAILY_SUMS.items():
            aggregates.append(F.sum(F.when(mine, F.col(column)).otherwise(F.lit(other))).alias(f"{name}_{suffix}"))
    no_cost = (F.col("scenario") == baseline) & F.col("total_energy_cost_eur").isNull()
    aggregates += [
        F.count_if(no_cost).alias("hours_missing_cost"),
        F.countDistinct("hour_utc").alias("hours_in_day"),
    ]

    saved = F.col(f"{baseline}_total_cost_eur") - F.col(f"{optimized}_total_cost_eur")
    return (
        hourly.groupBy(*by, F.col(day).alias("date_day"))
        .agg(*aggregates)
        .withColumns(
            {
                "cost_savings_eur": saved,
                "cost_savings_pct": safe_divide(saved, F.col(f"{baseline}_total_cost_eur")),
                "co2_savings_kg": F.col(f"{baseline}_co2_kg") - F.col(f"{optimized}_co2_kg"),
                "is_complete": F.col("hours_missing_cost") == 0,
            }
        )
    )
