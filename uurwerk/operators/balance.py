"""Electricity and gas demand of a lit, heated site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uurwerk.functions.nulls import floor_at_zero
from uurwerk.operators.shifting import scenario_expand, shift_to_cheapest
from uurwerk.params import SiteParams


def lighting_inputs(
    schedule: DataFrame, weather: DataFrame, prices: DataFrame | None, params: SiteParams, on=("hour_utc",), price_on=("hour_utc",)
) -> DataFrame:
    """Scheduled hours that have weather, with their price and lighting flags.

    The inner join sets the coverage. A missing radiation value leaves the flags
    NULL, a missing price stays NULL. Without ``prices`` the schedule must carry
    the price already.
    """
    dark = F.col("shortwave_radiation_w_per_m2") < F.lit(float(params.lighting_radiation_cutoff_w_per_m2))
    hourly = schedule.join(weather.select(*on, "temperature_c", "shortwave_radiation_w_per_m2"), list(on), "inner")
    if prices is not None:
        hourly = hourly.join(prices.select(*price_on, "electricity_price_eur_per_kwh"), list(price_on), "left")
    return hourly.withColumn("is_dark_enough_for_lighting", dark).withColumn(
        "is_lighting_on_baseline", F.col("is_lighting_scheduled") & dark
    )


def energy_balance(df: DataFrame, params: SiteParams) -> DataFrame:
    """Electricity, heat and gas of every hour, taken as in balance by itself.

    Powers are per floor area; over an hour and the whole area they make
    ``area / 1000`` kWh for each W/m². Heat and gas are unknown (NULL) wherever the
    weather is.
    """

    def p(value) -> Column:
        return value if isinstance(value, Column) else F.lit(float(value))

    site_kwh = p(params.area_m2) / F.lit(1000.0)
    lamps = F.when(F.col("is_lighting_on"), p(params.lighting_power_w_per_m2)).otherwise(F.lit(0.0))
    losses = p(params.heat_loss_w_per_m2_k) * (F.col("heating_setpoint_c") - F.col("temperature_c"))
    sun = p(params.solar_heat_gain_fraction) * F.col("shortwave_radiation_w_per_m2")
    lamp_heat = p(params.lighting_heat_fraction) * F.col("_lamps")
    kept = df.columns
    return (
        df.withColumn("_lamps", lamps)
        .withColumn("_heat", floor_at_zero(losses - sun - lamp_heat))
        .select(
            *kept,
            (F.col("_lamps") * site_kwh).alias("lighting_kwh"),
            (p(params.base_load_w_per_m2) * site_kwh).alias("base_load_kwh"),
            ((F.col("_lamps") + p(params.base_load_w_per_m2)) * site_kwh).alias("electricity_kwh"),
            (F.col("_heat") * site_kwh).alias("heat_demand_kwh"),
            (F.col("_heat") * site_kwh / (p(params.boiler_efficiency) * p(params.gas_kwh_per_m3))).alias("gas_m3"),
        )
    )


DEMAND_COLUMNS = [
    "hour_utc",
    "hour_local",
    "date_local",
    "hour_of_day_local",
    "scenario",
    "is_lighting_on",
    "heating_setpoint_c",
    "temperature_c",
    "shortwave_radiation_w_per_m2",
]


DEMAND_OUTPUT = [*DEMAND_COLUMNS, "lighting_kwh", "base_load_kwh", "electricity_kwh", "heat_demand_kwh", "gas_m3"]


def scenario_demand(hourly: DataFrame, params: SiteParams, by=(), carry=()) -> DataFrame:
    """Demand per hour for the fixed schedule and for the price-shifted one.
    ``carry`` names further columns to keep, such as prices for the cost."""
    shifted = shift_to_cheapest(hourly, by=by)
    scenarios = scenario_expand(
        shifted, {"baseline": "is_lighting_on_baseline", "optimized": "is_lighting_on_optimized"}
    )
    return energy_balance(scenarios.select(*by, *DEMAND_COLUMNS, *carry), params)
