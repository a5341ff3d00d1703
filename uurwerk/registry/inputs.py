"""The given tables seen as hourly signals.

An event type plays one signal, an hour's value is the largest of that hour; the
weather takes the latest event of the hour instead, whose distribution does not
change with the number of events. A shift of 75 days moves January onto the
spring clock change, 285 days onto the autumn one.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uurwerk.functions.clock import local_date, trunc_hour
from uurwerk.params import SiteParams
from uurwerk.session import materialize

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

# The model parameters with a cutoff that suits the range of the event values.
PARAMS = replace(SiteParams(), lighting_radiation_cutoff_w_per_m2=40.0)
ZONE = PARAMS.timezone


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shifted(column: str = "ts", days: int = 75):
    return F.col(column) + F.expr(f"INTERVAL '{days}' DAY")


def wide_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per hour with a column per event type: one scan, one shuffle of
    pre-aggregated hours, whatever the number of signals."""
    events = table(spark, sf_dir, "events")

    def largest(*types: str):
        return F.max(F.when(F.col("event_type").isin(*types), F.col("value")))

    def latest(event_type: str):
        mine = F.col("event_type") == event_type
        return F.max_by(F.when(mine, F.col("value")), F.when(mine, F.col("event_id")))

    return events.groupBy(trunc_hour(shifted()).alias("hour_utc")).agg(
        *[largest(t).alias(t) for t in EVENT_TYPES],
        largest("click", "view").alias("price"),
        F.max("value").alias("any_value"),
        latest("error").alias("radiation"),
        latest("purchase").alias("warmth"),
    )


def stored_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly signals as a small written table, for plans that use them in
    several branches; the events are then scanned once."""
    return materialize(wide_signals(spark, sf_dir), "hourly_signals")


def date_range(signals: DataFrame) -> DataFrame:
    """First and last date of the signals, as one request row."""
    return signals.agg(
        F.to_date(F.min("hour_utc")).alias("start_date"),
        F.to_date(F.max("hour_utc")).alias("run_date"),
    )


def user_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last event date of each user; a user plays one site."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("site"))
        .agg(F.to_date(F.min(shifted())).alias("start_date"), F.to_date(F.max(shifted())).alias("run_date"))
    )


def user_day_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest purchase of each user and local day plays the daily price."""
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "purchase")
        .groupBy(F.col("user_id").alias("site"), local_date(shifted(), ZONE).alias("gas_day"))
        .agg(F.max("value").alias("gas_price_eur_per_m3"))
    )


def electricity(signals: DataFrame, column: str = "price") -> DataFrame:
    return signals.where(F.col(column).isNotNull()).select(
        "hour_utc", F.col(column).alias("electricity_price_eur_per_kwh")
    )


def gas(signals: DataFrame) -> DataFrame:
    return (
        signals.where(F.col("purchase").isNotNull())
        .groupBy(local_date(F.col("hour_utc"), ZONE).alias("gas_day"))
        .agg(F.max("purchase").alias("gas_price_eur_per_m3"))
    )


def weather(signals: DataFrame) -> DataFrame:
    """Hours with a temperature or a radiation value; either may be NULL."""
    return signals.where(F.col("warmth").isNotNull() | F.col("radiation").isNotNull()).select(
        "hour_utc",
        (F.col("warmth") / F.lit(10.0)).alias("temperature_c"),
        F.col("radiation").alias("shortwave_radiation_w_per_m2"),
    )


def grid(signals: DataFrame) -> DataFrame:
    return signals.where(F.col("view").isNotNull()).select(
        "hour_utc", F.col("view").alias("carbon_intensity_gco2eq_per_kwh"), F.col("signup").alias("total_load_mw")
    )
