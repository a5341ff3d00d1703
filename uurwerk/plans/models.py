"""Staged tables → hourly tables → marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uurwerk.functions.clock import day_at, local_date
from uurwerk.operators.balance import DEMAND_OUTPUT
from uurwerk.operators.calendar import date_dimension, hour_spine
from uurwerk.operators.compare import daily_compare
from uurwerk.operators.costs import hourly_energy, priced_hours
from uurwerk.operators.market import market_hourly
from uurwerk.operators.prices import attach_prices
from uurwerk.operators.schedule import expand_schedule
from uurwerk.operators.signals import consolidate_signals
from uurwerk.params import SiteParams

# Column names of the tables.
MIX_COLUMNS = [
    "wind_mw",
    "solar_mw",
    "gas_mw",
    "coal_mw",
    "nuclear_mw",
    "biomass_mw",
    "hydro_mw",
    "unknown_mw",
    "imports_mw",
    "exports_mw",
]

GRID_COLUMNS = [
    "carbon_intensity_gco2eq_per_kwh",
    "is_carbon_intensity_estimated",
    "renewable_pct",
    "carbon_free_pct",
    "total_load_mw",
    *MIX_COLUMNS,
]

WEATHER_COLUMNS = [
    "temperature_c",
    "relative_humidity_pct",
    "precipitation_mm",
    "wind_speed_kmh",
    "cloud_cover_pct",
    "shortwave_radiation_w_per_m2",
]


def grid_signals(staged: dict[str, DataFrame]) -> DataFrame:
    """All grid signals by hour, for the hours of the carbon intensity."""
    carbon = staged["carbon_intensity"].select(
        "hour_utc",
        "carbon_intensity_gco2eq_per_kwh",
        F.col("is_estimated").alias("is_carbon_intensity_estimated"),
    )
    return consolidate_signals(
        carbon,
        staged["renewable_percentage"].select("hour_utc", "renewable_pct"),
        staged["carbon_free_percentage"].select("hour_utc", "carbon_free_pct"),
        staged["total_load"].select("hour_utc", "total_load_mw"),
        staged["day_ahead_price"].select("hour_utc", "day_ahead_price_eur_per_mwh"),
        staged["electricity_mix"].select("hour_utc", *MIX_COLUMNS),
    )


def build_models(
    spark: SparkSession,
    staged: dict[str, DataFrame],
    profile: DataFrame,
    run_date: dt.date,
    params: SiteParams,
    store: Callable[[DataFrame, str, str], DataFrame] = lambda df, layer, name: df,
    sites: DataFrame | None = None,
    months: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """The five hourly tables and the four marts.

    ``store(df, layer, name)`` decides what a table becomes: written and scanned
    again, a view, or (by default) left as a lazy plan. ``sites`` has one row per
    site, its columns name it and become part of the key of schedule, demand and
    energy; prices, grid and weather are shared. Without it there is one site. ``months``
    (``yyyy-MM`` of local dates, from the spine's start on) limits all tables to these.
    """

    def chosen(df: DataFrame, day: Column) -> DataFrame:
        return df if months is None else df.where(F.date_format(day, "yyyy-MM").isin(*months))

    by = list(sites.columns) if sites is not None else []
    dates = [
        F.lit(params.spine_start_date).cast("date").alias("start_date"), F.lit(str(run_date)).cast("date").alias("run_date")
    ]
    spine = chosen(hour_spine(spark.range(1).select(*dates), params.timezone), F.col("date_local"))
    hours = store(spine, "intermediate", "hours")
    prices = store(
        attach_prices(hours, staged["electricity_prices"], staged["gas_prices"], params.gas_day_start_hour),
        "intermediate",
        "hourly_prices",
    )
    calendar = store(date_dimension(hours, staged["public_holidays"]), "marts", "dim_date")
    since = day_at(F.lit(params.spine_start_date).cast("date"), 0, params.timezone)
    grid = chosen(grid_signals(staged).where(F.col("hour_utc") >= since), local_date(F.col("hour_utc"), params.timezone))
    grid = store(grid, "intermediate", "grid_signals")
    if sites is None:
        spine = hours
    else:
        days = (run_date - dt.date.fromisoformat(params.spine_start_date)).days + 2
        whole = hour_spine(sites.select(*by, *dates), params.timezone, by=by, total_days=sites.count() * max(0, days))
        spine = chosen(whole, F.col("date_local"))
    schedule = store(expand_schedule(spine, profile, params), "intermediate", "hourly_schedule")
    # Demand is a part of the energy table, so both come from one pass over the hours.
    energy = store(
        hourly_energy(priced_hours(schedule, prices, grid), staged["weather"], params, by), "marts", "hourly_energy"
    )
    demand = store(energy.select(*by, *DEMAND_OUTPUT), "intermediate", "hourly_demand")

    market = market_hourly(prices, grid, staged["weather"].select("hour_utc", *WEATHER_COLUMNS)).select(
        *prices.columns, "day_ahead_price_eur_per_mwh", *GRID_COLUMNS, *WEATHER_COLUMNS
    )
    return {
        "hours": hours,
        "hourly_schedule": schedule,
        "hourly_prices": prices,
        "grid_signals": grid,
        "hourly_demand": demand,
        "dim_date": calendar,
        "hourly_market": store(market, "marts", "hourly_market"),
        "hourly_energy": energy,
        "daily_energy": store(daily_compare(energy, by=by), "marts", "daily_energy"),
    }
