"""Raw tables → typed, renamed tables keyed by ``hour_utc`` (or day)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uurwerk.functions.clock import local_date, to_local
from uurwerk.functions.nulls import reconcile
from uurwerk.operators.dedup import dedup_latest
from uurwerk.operators.holidays import fold_holidays
from uurwerk.operators.intervals import day_intervals
from uurwerk.params import SiteParams

# Signal table → name of its measure. total_load keeps its type as loaded.
SIGNAL_MEASURES = {
    "carbon_intensity": "carbon_intensity_gco2eq_per_kwh",
    "renewable_percentage": "renewable_pct",
    "carbon_free_percentage": "carbon_free_pct",
    "total_load": "total_load_mw",
}

# Column of the weather table → name with its unit.
WEATHER_MEASURES = {
    "temperature_2m": "temperature_c",
    "relative_humidity_2m": "relative_humidity_pct",
    "precipitation": "precipitation_mm",
    "wind_speed_10m": "wind_speed_kmh",
    "cloud_cover": "cloud_cover_pct",
    "shortwave_radiation": "shortwave_radiation_w_per_m2",
}


def stage_electricity_prices(raw: DataFrame, params: SiteParams) -> DataFrame:
    return raw.select(
        F.col("timestamp_utc").alias("hour_utc"),
        to_local(F.col("timestamp_utc"), params.timezone).alias("hour_local"),
        F.col("price_eur_per_kwh").alias("electricity_price_eur_per_kwh"),
        "_load_id",
    )


def stage_gas_prices(raw: DataFrame, params: SiteParams) -> DataFrame:
    """A day's price is the newest row of its local date, so a row that a request's edge
    put on midnight gives way to the regular one."""
    by_day = raw.withColumn("gas_day", local_date(F.col("timestamp_utc"), params.timezone))
    latest = dedup_latest(by_day, ["gas_day"], [F.col("timestamp_utc").desc()])
    return day_intervals(latest, "gas_day", params.timezone, params.gas_day_start_hour).select(
        "gas_day",
        "valid_from_utc",
        "valid_to_utc",
        F.col("price_eur_per_m3").alias("gas_price_eur_per_m3"),
        "_load_id",
    )


def stage_signal(raw: DataFrame, measure: str, cast: bool = True) -> DataFrame:
    """Rename the value of a flat signal to its unit name."""
    value = F.col("value").cast("double") if cast else F.col("value")
    return raw.select(F.col("datetime").alias("hour_utc"), value.alias(measure), "is_estimated", "_load_id")


def stage_day_ahead_price(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("datetime").alias("hour_utc"),
        reconcile(F.col("value"), F.col("value__v_double")).alias("day_ahead_price_eur_per_mwh"),
        "_load_id",
    )


def stage_electricity_mix(raw: DataFrame) -> DataFrame:
    """Generation per source in MW; sources that arrived split by type are joined."""

    def paired(name: str):
        return reconcile(F.col(f"mix__{name}"), F.col(f"mix__{name}__v_double")).alias(f"{name}_mw")

    def single(name: str, alias: str):
        return F.col(f"mix__{name}").cast("double").alias(alias)

    return raw.select(
        F.col("datetime").alias("hour_utc"),
        paired("wind"),
        paired("solar"),
        single("hydro", "hydro_mw"),
        single("biomass", "biomass_mw"),
        paired("nuclear"),
        single("gas", "gas_mw"),
        paired("coal"),
        single("unknown", "unknown_mw"),
        single("battery_storage__charge", "battery_storage_charge_mw"),
        single("hydro_storage__charge", "hydro_storage_charge_mw"),
        single("flows__imports", "imports_mw"),
        single("flows__exports", "exports_mw"),
        "estimation_method",
        "_load_id",
    )


def stage_weather(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("datetime").alias("hour_utc"),
        *[F.col(old).alias(new) for old, new in WEATHER_MEASURES.items()],
        "_load_id",
    )


def stage_all(raw: dict[str, DataFrame], params: SiteParams) -> dict[str, DataFrame]:
    """The ten staged tables, by name."""
    staged = {
        "electricity_prices": stage_electricity_prices(raw["electricity_prices"], params),
        "gas_prices": stage_gas_prices(raw["gas_prices"], params),
        "day_ahead_price": stage_day_ahead_price(raw["day_ahead_price"]),
        "electricity_mix": stage_electricity_mix(raw["electricity_mix"]),
        "weather": stage_weather(raw["weather"]),
        "public_holidays": fold_holidays(raw["public_holidays"], raw["public_holidays__types"]),
    }
    for name, measure in SIGNAL_MEASURES.items():
        staged[name] = stage_signal(raw[name], measure, cast=name != "total_load")
    return staged
