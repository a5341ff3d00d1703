"""Cost and emissions of hourly demand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uurwerk.operators.balance import lighting_inputs, scenario_demand
from uurwerk.params import SiteParams


CARRIED = ["electricity_price_eur_per_kwh", "gas_price_eur_per_m3", "carbon_intensity_gco2eq_per_kwh"]


def add_costs(df: DataFrame, params: SiteParams) -> DataFrame:
    """Cost and CO2 columns for demand that already carries its prices and carbon
    intensity. A missing price or grid value leaves the column NULL, never zero,
    so a gap stays visible as a gap."""
    electricity_cost = F.col("electricity_kwh") * F.col("electricity_price_eur_per_kwh")
    gas_cost = F.col("gas_m3") * F.col("gas_price_eur_per_m3")
    electricity_co2 = F.col("electricity_kwh") * F.col("carbon_intensity_gco2eq_per_kwh") / F.lit(1000.0)
    gas_co2 = F.col("gas_m3") * F.lit(float(params.gas_kg_co2_per_m3))
    return df.select(
        *[c for c in df.columns if c not in CARRIED],
        "electricity_price_eur_per_kwh",
        "gas_price_eur_per_m3",
        electricity_cost.alias("electricity_cost_eur"),
        gas_cost.alias("gas_cost_eur"),
        (electricity_cost + gas_cost).alias("total_energy_cost_eur"),
        "carbon_intensity_gco2eq_per_kwh",
        electricity_co2.alias("electricity_co2_kg"),
        gas_co2.alias("gas_co2_kg"),
        (electricity_co2 + gas_co2).alias("total_co2_kg"),
    )


def priced_hours(
    schedule: DataFrame, prices: DataFrame, grid: DataFrame, price_by: Sequence[str] = (), grid_by: Sequence[str] = ()
) -> DataFrame:
    """The schedule's hours with both prices and the carbon intensity."""
    price = prices.select(*price_by, "hour_utc", "electricity_price_eur_per_kwh", "gas_price_eur_per_m3")
    carbon = grid.select(*grid_by, "hour_utc", "carbon_intensity_gco2eq_per_kwh")
    return schedule.join(price, [*price_by, "hour_utc"], "left").join(carbon, [*grid_by, "hour_utc"], "left")


def hourly_energy(
    hours: DataFrame, weather: DataFrame, params: SiteParams, by: Sequence[str] = (), weather_by: Sequence[str] = ()
) -> DataFrame:
    """Demand, cost and CO2 of both scenarios for scheduled hours that carry their
    prices and carbon intensity already, so that nothing is looked up for the rows
    after the scenarios have doubled them."""
    lit = lighting_inputs(hours, weather, None, params, on=[*weather_by, "hour_utc"])
    return add_costs(scenario_demand(lit, params, by=list(by), carry=CARRIED), params)
