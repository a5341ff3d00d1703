"""Every operator as a query over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uurwerk.functions.clock import hours, local_date, to_local, trunc_hour
from uurwerk.functions.nulls import floor_at_zero, reconcile
from uurwerk.operators import quality, reports
from uurwerk.operators.balance import DEMAND_OUTPUT, lighting_inputs
from uurwerk.operators.calendar import date_dimension, hour_spine, with_local_time
from uurwerk.operators.compare import daily_compare
from uurwerk.operators.costs import hourly_energy
from uurwerk.operators.dedup import dedup_latest
from uurwerk.operators.holidays import fold_holidays
from uurwerk.operators.intervals import day_intervals, interval_attach
from uurwerk.operators.market import market_hourly
from uurwerk.operators.packed import pack_days, shift_days, unpack_days
from uurwerk.operators.prices import attach_prices
from uurwerk.operators.schedule import expand_schedule
from uurwerk.operators.shifting import rank_cheapest, scenario_expand, shift_to_cheapest
from uurwerk.operators.signals import consolidate_signals
from uurwerk.params import default_profile, read_profile
from uurwerk.plans import staging
from uurwerk.plans.staging import SIGNAL_MEASURES, stage_signal
from uurwerk.registry import inputs as src
from uurwerk.registry.inputs import PARAMS, ZONE, shifted, table
from uurwerk.session import materialize, scratch_path
from uurwerk.sources import ranges, records, variants
from uurwerk.sources.chunks import chunk_source
from uurwerk.sources.landing import RequestFailed, landing_read
from uurwerk.sources.tables import (
    backfill_by_year,
    raw_schema,
    read_raw,
    read_table,
    register_view,
    table_schema,
    upsert,
    with_load_id,
    write_table,
)
from uurwerk.sources.versions import current_map, maps_since

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


def money(column: str | Column) -> Column:
    """Exact sum of two-decimal values, whatever the order of the rows."""
    c = F.col(column) if isinstance(column, str) else column
    return F.sum(c.cast("decimal(18,2)")).cast("double")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Computed doubles to a fixed number of places, for comparison across engines."""
    return df.select(
        *[
            F.round(f.name, places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- calendar and time -------------------------------------------------------


def site_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hour_spine(src.user_ranges(spark, sf_dir), ZONE, by=["site"])


@query("hour_spine")
def hour_spine_by_site(spark, sf_dir):
    return site_spine(spark, sf_dir)


@query("local_time")
def local_time(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    spring, autumn = to_local(shifted(days=75), ZONE), to_local(shifted(days=285), ZONE)
    return events.select(
        "event_id",
        spring.alias("spring_local"),
        F.to_date(spring).alias("spring_date"),
        F.hour(spring).alias("spring_hour"),
        autumn.alias("autumn_local"),
        F.to_date(autumn).alias("autumn_date"),
        F.hour(autumn).alias("autumn_hour"),
    )


@query("gas_day_intervals")
def gas_day_intervals(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("gas_day")).distinct()
    return day_intervals(days, "gas_day", ZONE)


@query("dim_date")
def dim_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    holidays = (
        orders.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000))
        .groupBy(F.col("day").alias("holiday_date"))
        .agg(
            F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("is_public_holiday"),
            F.max("o_orderpriority").alias("holiday_name"),
            F.min("o_orderpriority").alias("holiday_types"),
        )
    )
    return date_dimension(orders, holidays, "day")


# --- joins -------------------------------------------------------------------


@query("dedup_latest")
def dedup_latest_by_user_day(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", local_date(shifted(), ZONE))
    latest = dedup_latest(events, ["user_id", "day"], [F.col("ts").desc(), F.col("event_id").desc()])
    return latest.select("user_id", "day", "event_id", "ts", "value")


@query("interval_price_attach")
def interval_price_attach(spark, sf_dir):
    hourly = src.electricity(src.stored_signals(spark, sf_dir))
    daily = src.user_day_prices(spark, sf_dir)
    return attach_prices(site_spine(spark, sf_dir), hourly, daily, daily_by=["site"])


@query("interval_join_generic")
def interval_join_generic(spark, sf_dir):
    """Events against overlapping intervals of their user. Each hour with a signup
    opens one interval of 1 to 62 hours, which may span four days."""
    events = table(spark, sf_dir, "events")
    opened = trunc_hour(F.col("ts"))
    intervals = (
        events.where(F.col("event_type") == "signup")
        .groupBy("user_id", opened.alias("valid_from"))
        .agg(F.max("value").alias("opened_value"))
        .withColumn("length_hours", (F.floor(F.col("opened_value") / 8) + 1).cast("int"))
        .withColumn("valid_to", F.col("valid_from") + F.make_dt_interval(hours=F.col("length_hours")))
    )
    points = events.select("event_id", "user_id", "ts")
    return interval_attach(points, intervals, "ts", "valid_from", "valid_to", by=["user_id"])


@query("interval_join_lengths")
def interval_join_lengths(spark, sf_dir):
    """Events against intervals of their user of 30 seconds, 90 minutes, 3 days, 400 days and without an end."""
    events = table(spark, sf_dir, "events")
    start = F.col("ts")
    kind = F.floor("value").cast("int") % 5
    end = (
        F.when(kind == 0, start + F.expr("INTERVAL '30' SECOND"))
        .when(kind == 1, start + F.expr("INTERVAL '90' MINUTE"))
        .when(kind == 2, start + F.expr("INTERVAL '72' HOUR"))
        .when(kind == 3, start + F.expr("INTERVAL '9600' HOUR"))
        .otherwise(F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"))
    )
    opened = events.where("event_type = 'signup'")
    intervals = opened.select(F.col("event_id").alias("opened_by"), "user_id", start.alias("valid_from"), end.alias("valid_to"))
    return interval_attach(events.select("event_id", "user_id", "ts"), intervals, "ts", "valid_from", "valid_to", by=["user_id"])


@query("signal_consolidate")
def signal_consolidate(spark, sf_dir):
    signals = src.stored_signals(spark, sf_dir)

    def sig(name: str) -> DataFrame:
        return signals.where(F.col(name).isNotNull()).select("hour_utc", F.col(name).alias(f"{name}_value"))

    return consolidate_signals(sig("view"), sig("click"), sig("error"), sig("purchase"), sig("signup"))


# Signal table → event type that plays it.
STAGED_FROM = {
    "carbon_intensity": "view",
    "renewable_percentage": "click",
    "carbon_free_percentage": "purchase",
    "total_load": "signup",
}


def event_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest value of each event type and hour, over the spring clock change."""
    return (
        table(spark, sf_dir, "events")
        .groupBy("event_type", trunc_hour(shifted()).alias("datetime"))
        .agg(F.max("value").alias("value"))
    )


def landed(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """``rows`` stored as the raw table ``name`` and scanned with its declared schema."""
    root = scratch_path(spark, "lake")
    write_table(rows.select(*raw_schema(name).names), root, "prod", "raw", name)
    return read_raw(spark, f"{root}/raw", name)


@query("stage_signal")
def stage_signal_tables(spark, sf_dir):
    """The flat signals scanned as raw tables, each renamed and cast, side by side."""
    raw = materialize(
        event_hours(spark, sf_dir)
        .where(F.col("event_type").isin(*STAGED_FROM.values()))
        .withColumn("is_estimated", F.col("value") < 20)
        .withColumn("_load_id", F.lit("load-1")),
        "raw_signals",
        partition_by=["event_type"],
    )
    staged = [
        stage_signal(raw.where(F.col("event_type") == STAGED_FROM[name]), measure, cast=name != "total_load")
        for name, measure in SIGNAL_MEASURES.items()
    ]
    result = staged[0]
    for df in staged[1:]:
        result = result.unionByName(df, allowMissingColumns=True)
    return result


def of_type(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    return event_hours(spark, sf_dir).where(F.col("event_type") == event_type).withColumn("_load_id", F.lit("load-1"))


@query("stage_electricity_prices")
def stage_electricity_price_table(spark, sf_dir):
    rows = of_type(spark, sf_dir, "click").toDF("event_type", "timestamp_utc", "price_eur_per_kwh", "_load_id")
    return staging.stage_electricity_prices(landed(spark, "electricity_prices", rows), PARAMS)


@query("stage_gas_prices")
def stage_gas_price_table(spark, sf_dir):
    """All hours of a day bring a price; the day's latest stays, with its validity."""
    rows = of_type(spark, sf_dir, "purchase").toDF("event_type", "timestamp_utc", "price_eur_per_m3", "_load_id")
    return staging.stage_gas_prices(landed(spark, "gas_prices", rows), PARAMS)


def split_by_type(value: Column) -> tuple[Column, Column]:
    """A number as a loader stores it that gives whole ones a column of their own."""
    whole = F.when(value == F.floor(value), value.cast("bigint"))
    return whole, F.when(whole.isNull(), value)


@query("stage_day_ahead_price")
def stage_day_ahead_price_table(spark, sf_dir):
    """Values to halves, so that whole ones and others occur."""
    whole, other = split_by_type(F.round(F.col("value") * 2) / 2)
    rows = of_type(spark, sf_dir, "view").select(
        "datetime",
        whole.alias("value"),
        other.alias("value__v_double"),
        F.lit(False).alias("is_estimated"),
        F.col("datetime").alias("created_at"),
        F.col("datetime").alias("updated_at"),
        "_load_id",
    )
    return staging.stage_day_ahead_price(landed(spark, "day_ahead_price", rows))


@query("stage_electricity_mix")
def stage_electricity_mix_table(spark, sf_dir):
    """Each source is the hour's value over its own number; the last ones are missing
    below 100."""
    rows = of_type(spark, sf_dir, "view")
    columns = []
    for k, f in enumerate(raw_schema("electricity_mix").fields):
        name, value = f.name, F.round(F.col("value") / (k + 1))
        if name.endswith("__v_double"):
            continue
        if f.dataType.simpleString() == "bigint":
            whole, other = split_by_type(F.round(F.col("value") * 2 / (k + 1)) / 2)
            columns += [whole.alias(name), other.alias(f"{name}__v_double")]
        elif name.startswith("mix__"):
            columns.append((F.when(F.col("value") >= 100, value) if "flows" in name else value).alias(name))
    rows = rows.select("datetime", *columns, F.lit("MEASURED").alias("estimation_method"), "_load_id")
    return staging.stage_electricity_mix(landed(spark, "electricity_mix", rows))


@query("stage_weather")
def stage_weather_table(spark, sf_dir):
    names = [f.name for f in raw_schema("weather").fields if f.name not in ("datetime", "_load_id")]
    measures = [(F.col("value") - 50 * k).alias(name) for k, name in enumerate(names)]
    rows = of_type(spark, sf_dir, "error").select("datetime", *measures, "_load_id")
    staged = staging.stage_weather(landed(spark, "weather", rows))
    return register_view(rounded(staged), "prod", "staging", "weather")


@query("stage_public_holidays")
def stage_public_holiday_table(spark, sf_dir):
    """Order dates play holidays, the priorities of their orders the types."""
    orders = table(spark, sf_dir, "orders").withColumn("date", F.to_date("o_orderdate").cast("string"))
    parents = orders.groupBy("date").agg(
        F.min("o_orderpriority").alias("local_name"),
        F.max("o_orderpriority").alias("name"),
        F.min("o_orderstatus").alias("country_code"),
        (F.max("o_totalprice") > 300000).alias("is_global"),
        F.concat(F.lit("row-"), F.col("date")).alias("_row_id"),
        F.lit("load-1").alias("_load_id"),
    )
    types = orders.where("o_totalprice > 200000").select(
        F.concat(F.lit("row-"), F.col("date")).alias("_parent_id"), F.col("o_orderpriority").alias("value")
    )
    return fold_holidays(
        landed(spark, "public_holidays", parents), landed(spark, "public_holidays__types", types), public="1-URGENT"
    )


# --- schedule, shifting, demand ----------------------------------------------


@query("hourly_schedule")
def hourly_schedule(spark, sf_dir):
    """The profile comes from a CSV file, as a user's own would."""
    path = scratch_path(spark, "monthly_profile")
    default_profile(spark).write.csv(path, header=True)
    return expand_schedule(site_spine(spark, sf_dir), read_profile(spark, path), PARAMS)


def lamp_hours(df: DataFrame, sun: str, by: list[str]) -> DataFrame:
    """Lamp flags with the window of local hours 2-18 as the fixed schedule."""
    dark = F.col(sun) < 40
    scheduled = (F.col("hour_of_day_local") >= 2) & (F.col("hour_of_day_local") < 18)
    return (
        with_local_time(df, ZONE)
        .withColumn("is_dark_enough_for_lighting", dark)
        .withColumn("is_lighting_on_baseline", scheduled & dark)
        .select(
            *by,
            "hour_utc",
            "date_local",
            "electricity_price_eur_per_kwh",
            "is_dark_enough_for_lighting",
            "is_lighting_on_baseline",
        )
    )


def weather_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours with radiation, in four variants: prices of two signals over the
    spring change, of one signal only (unpriced hours), over the autumn change, and
    with the latest instead of the largest radiation of the hour."""
    signals = src.wide_signals(spark, sf_dir).where(F.col("error").isNotNull())

    def variant(name: str, days: int, price: str, sun: str) -> Column:
        return F.struct(
            F.lit(name).alias("variant"),
            (F.col("hour_utc") + F.expr(f"INTERVAL '{days}' DAY")).alias("hour_utc"),
            F.col(price).alias("electricity_price_eur_per_kwh"),
            F.col(sun).alias("sun"),
        )

    variants = F.array(
        variant("spring", 0, "price", "error"),
        variant("unpriced", 0, "click", "error"),
        variant("autumn", 285 - 75, "price", "error"),
        variant("latest", 0, "price", "radiation"),
    )
    return lamp_hours(signals.select(F.inline(variants)), "sun", ["variant"])


def user_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of each user; the payload's ``k`` plays radiation."""
    sun = F.get_json_object("props", "$.k").cast("int")
    hourly = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("site"), trunc_hour(shifted()).alias("hour_utc"))
        .agg(F.max("value").alias("electricity_price_eur_per_kwh"), F.max(sun).alias("sun"))
    )
    return lamp_hours(hourly, "sun", ["site"])


@query("rank_cheapest")
def rank_cheapest_hours(spark, sf_dir):
    return rank_cheapest(weather_hours(spark, sf_dir), by=["variant"])


def day_totals(df: DataFrame, by: list[str]) -> DataFrame:
    def paid(flag: str) -> Column:
        return money(F.when(F.col(flag), F.col("electricity_price_eur_per_kwh")))

    return df.groupBy(*by, F.col("date_local").alias("date_day")).agg(
        F.count(F.lit(1)).alias("hours_in_day"),
        F.max("unpriced_hours_in_day").alias("unpriced_hours"),
        F.count_if("is_lighting_on_baseline").alias("baseline_on_hours"),
        F.count_if("is_lighting_on_optimized").alias("optimized_on_hours"),
        paid("is_lighting_on_baseline").alias("baseline_price_sum"),
        paid("is_lighting_on_optimized").alias("optimized_price_sum"),
    )


@query("shift_to_cheapest")
def shift_to_cheapest_days(spark, sf_dir):
    return day_totals(shift_to_cheapest(weather_hours(spark, sf_dir), by=["variant"]), ["variant"])


@query("shift_to_cheapest_by_site")
def shift_to_cheapest_by_site(spark, sf_dir):
    return day_totals(shift_to_cheapest(user_hours(spark, sf_dir), by=["site"]), ["site"])


@query("shift_packed_days")
def shift_packed_days(spark, sf_dir):
    """One row for each site and day: ranked, counted and shifted inside the row."""
    fields = ["electricity_price_eur_per_kwh", "is_dark_enough_for_lighting", "is_lighting_on_baseline"]
    packed = pack_days(user_hours(spark, sf_dir), fields, by=["site"])
    return day_totals(unpack_days(shift_days(packed)), ["site"])


@query("scenario_expand")
def scenario_expand_hours(spark, sf_dir):
    shifted_hours = shift_to_cheapest(user_hours(spark, sf_dir), by=["site"])
    long = scenario_expand(
        shifted_hours, {"baseline": "is_lighting_on_baseline", "optimized": "is_lighting_on_optimized"}
    )
    return long.select("site", "hour_utc", "date_local", "scenario", "is_lighting_on")


def spine_with_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    signals = src.stored_signals(spark, sf_dir)
    return hour_spine(src.date_range(signals), ZONE).join(signals, "hour_utc", "left")


@query("null_logic")
def null_logic(spark, sf_dir):
    """Radiation is missing in some hours: flags stay NULL where nothing says false."""
    padded = spine_with_signals(spark, sf_dir).select(
        "hour_utc", "radiation", F.col("any_value").alias("electricity_price_eur_per_kwh")
    )
    return shift_to_cheapest(lamp_hours(padded, "radiation", [])).select(
        "hour_utc",
        "date_local",
        "is_dark_enough_for_lighting",
        "is_lighting_on_baseline",
        "is_lighting_on_optimized",
    )


@query("floor_at_zero")
def floor_at_zero_heat(spark, sf_dir):
    heat = F.lit(6.0) * (F.lit(20.0) - F.col("warmth") / F.lit(10.0)) - F.lit(0.5) * F.col("radiation")
    return rounded(
        spine_with_signals(spark, sf_dir).select("hour_utc", floor_at_zero(heat).alias("heat_demand_w_per_m2"))
    )


class Chain:
    """The hours of one site over the signals, with everything that is looked up for
    an hour joined once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        signals = src.stored_signals(spark, sf_dir)
        schedule = expand_schedule(hour_spine(src.date_range(signals), ZONE), default_profile(spark), PARAMS)
        priced = attach_prices(schedule, src.electricity(signals), src.gas(signals))
        carbon = src.grid(signals).select("hour_utc", "carbon_intensity_gco2eq_per_kwh")
        self.hours = priced.join(carbon, "hour_utc", "left")
        self.weather = src.weather(signals)

    def energy(self) -> DataFrame:
        return hourly_energy(self.hours, self.weather, PARAMS)

    def daily(self) -> DataFrame:
        return daily_compare(self.energy())


@query("lighting_inputs_joined")
def lighting_inputs_joined(spark, sf_dir):
    chain = Chain(spark, sf_dir)
    return rounded(
        lighting_inputs(chain.hours, chain.weather, None, PARAMS).select(
            "hour_utc",
            "date_local",
            "is_day",
            "is_lighting_scheduled",
            "heating_setpoint_c",
            "temperature_c",
            "shortwave_radiation_w_per_m2",
            "electricity_price_eur_per_kwh",
            "is_dark_enough_for_lighting",
            "is_lighting_on_baseline",
        )
    )


@query("hourly_demand")
def hourly_demand_scenarios(spark, sf_dir):
    return rounded(Chain(spark, sf_dir).energy().select(*DEMAND_OUTPUT))


@query("cost_emissions")
def cost_emissions_hourly(spark, sf_dir):
    return rounded(Chain(spark, sf_dir).energy())


@query("daily_scenario_compare")
def daily_scenario_compare(spark, sf_dir):
    return rounded(Chain(spark, sf_dir).daily(), 4)


@query("site_daily_compare")
def site_daily_compare(spark, sf_dir):
    """The whole chain for every user as a site of its own, on shared weather,
    electricity price and grid, and with the user's own daily gas price."""
    signals = src.stored_signals(spark, sf_dir)
    spine = site_spine(spark, sf_dir)
    schedule = expand_schedule(spine, default_profile(spark), PARAMS)
    prices = attach_prices(schedule, src.electricity(signals), src.user_day_prices(spark, sf_dir), daily_by=["site"])
    carbon = src.grid(signals).select("hour_utc", "carbon_intensity_gco2eq_per_kwh")
    energy = hourly_energy(prices.join(carbon, "hour_utc", "left"), src.weather(signals), PARAMS, by=["site"])
    return rounded(daily_compare(energy, by=["site"]), 4)


# --- dimensions, market ------------------------------------------------------


@query("holiday_fold")
def holiday_fold(spark, sf_dir):
    """Orders play holidays, the return flags of their lines the types."""
    orders = table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").cast("string").alias("date"),
        F.col("o_orderpriority").alias("local_name"),
        F.col("o_orderkey").cast("string").alias("name"),
        F.col("o_orderstatus").alias("country_code"),
        (F.col("o_totalprice") > 200000).alias("is_global"),
        F.col("o_orderkey").alias("_row_id"),
        F.lit("load-1").alias("_load_id"),
    )
    flags = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("_parent_id"), F.col("l_returnflag").alias("value")
    )
    return fold_holidays(orders, flags, public="R")


@query("hourly_market")
def hourly_market(spark, sf_dir):
    signals = src.stored_signals(spark, sf_dir)
    prices = attach_prices(
        hour_spine(src.date_range(signals), ZONE), src.electricity(signals, "click"), src.gas(signals)
    )
    return rounded(market_hourly(prices, src.grid(signals), src.weather(signals)))


# --- data tests --------------------------------------------------------------


@query("dq_unique")
def dq_unique(spark, sf_dir):
    return quality.unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("dq_not_null")
def dq_not_null(spark, sf_dir):
    return quality.not_null(signal_consolidate(spark, sf_dir), "click_value")


@query("dq_accepted_range")
def dq_accepted_range(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return quality.accepted_range(events, "value", 0.0, 100.0)


@query("dq_accepted_values")
def dq_accepted_values(spark, sf_dir):
    return quality.accepted_values(table(spark, sf_dir, "events"), "event_type", ["click", "view"])


@query("dq_relationships")
def dq_relationships(spark, sf_dir):
    parents = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return quality.relationships(table(spark, sf_dir, "lineitem"), "l_orderkey", parents, "o_orderkey")


@query("dq_unique_combination")
def dq_unique_combination(spark, sf_dir):
    return quality.unique_combination(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_expression")
def dq_expression(spark, sf_dir):
    """Events of 300 and more; and the days of all sites whose on-hours differ
    between the scenarios (there are none)."""
    dear = quality.expression_is_true(table(spark, sf_dir, "events"), "value < 300")
    unfair = quality.expression_is_true(
        shift_to_cheapest_by_site(spark, sf_dir), "baseline_on_hours = optimized_on_hours"
    )
    return dear.select(F.lit("value").alias("test"), F.col("event_id").alias("row_key")).unionByName(
        unfair.select(F.lit("fairness").alias("test"), F.col("site").alias("row_key"))
    )


@query("dq_freshness")
def dq_freshness(spark, sf_dir):
    return quality.freshness(
        table(spark, sf_dir, "orders"), "o_orderdate", dt.datetime(2001, 8, 2), 2, 7, by=["o_custkey"]
    )


# --- reports -----------------------------------------------------------------


@query("yearly_summary")
def yearly_summary(spark, sf_dir):
    """By month and by calendar year."""
    daily = materialize(Chain(spark, sf_dir).daily(), "daily")
    summaries = [
        reports.summary_by_period(daily, F.date_format("date_day", pattern).alias("period"), PARAMS.area_m2)
        for pattern in ("yyyy-MM", "yyyy")
    ]
    return rounded(summaries[0].unionByName(summaries[1]), 4)


@query("price_per_on_hour")
def price_per_on_hour(spark, sf_dir):
    energy = materialize(Chain(spark, sf_dir).energy(), "energy")
    return rounded(reports.price_per_on_hour(reports.on_complete_days(energy, daily_compare(energy))))


@query("day_outcomes")
def day_outcomes(spark, sf_dir):
    return reports.day_outcomes(Chain(spark, sf_dir).daily(), places=4)


@query("coverage_gaps")
def coverage_gaps(spark, sf_dir):
    """Hours found and missing per event type, in 10-day chunks."""
    hour = trunc_hour(shifted())
    found = materialize(
        table(spark, sf_dir, "events").select("event_type", hour.alias("hour_utc")).distinct(), "found_hours"
    )
    wanted = found.groupBy("event_type").agg(
        F.to_date(F.min("hour_utc")).alias("start_date"), F.to_date(F.max("hour_utc")).alias("end_date")
    )
    chunks = ranges.chunk_ranges(wanted, "start_date", "end_date", 10).select("event_type", "chunk_start", "chunk_end")
    return reports.coverage(found, chunks, ["event_type"])


@query("coverage_by_year")
def coverage_by_year(spark, sf_dir):
    """Hours found per event type and calendar year, over the events and the same ones
    350 days later, in chunks of a month."""
    hour = F.explode(F.array(trunc_hour(F.col("ts")), trunc_hour(shifted(days=350))))
    found = materialize(table(spark, sf_dir, "events").select("event_type", hour.alias("hour_utc")).distinct(), "found_hours")
    wanted = found.groupBy("event_type").agg(
        F.to_date(F.min("hour_utc")).alias("start_date"), F.to_date(F.max("hour_utc")).alias("end_date")
    )
    days = ranges.expand_days(wanted, "start_date", "end_date")
    months = days.groupBy("event_type", F.trunc("day", "month").alias("_month")).agg(
        F.min("day").alias("chunk_start"), F.max("day").alias("chunk_end")
    )
    per_chunk = reports.coverage(found, months.drop("_month"), ["event_type"])
    return reports.coverage_by_year(per_chunk, ["event_type"])


@query("duplicate_days")
def duplicate_days(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", local_date(shifted(), ZONE))
    return reports.duplicate_days(events, ["user_id", "day"], "value")


@query("lag_offset")
def lag_offset(spark, sf_dir):
    """A series that was stored two hours late is compared with the original."""
    signals = src.stored_signals(spark, sf_dir).where(F.col("click").isNotNull()).select("hour_utc", "click")
    late = signals.withColumn("hour_utc", F.col("hour_utc") + hours(2))
    return rounded(reports.lag_scan(late, signals, "click", range(-6, 7)))


# --- ingest ------------------------------------------------------------------


def customer_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day"))
    )


@query("chunk_plan_fixed")
def chunk_plan_fixed(spark, sf_dir):
    return ranges.chunk_ranges(customer_ranges(spark, sf_dir), "first_day", "last_day", 30)


@query("chunk_plan_year")
def chunk_plan_year(spark, sf_dir):
    return ranges.year_chunks(customer_ranges(spark, sf_dir), "first_day", "last_day")


@query("day_expand")
def day_expand(spark, sf_dir):
    return ranges.expand_days(src.user_ranges(spark, sf_dir), "start_date", "run_date")


@query("clip_to_availability")
def clip_to_availability(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    requests = customer_ranges(spark, sf_dir).join(customers, "o_custkey")
    availability = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"),
        F.date_add(F.lit("1995-01-01").cast("date"), F.col("n_nationkey") * 60).alias("available_from"),
    )
    return ranges.clip_ranges(requests, availability, "c_nationkey", "first_day", "last_day")


@query("json_flat_rows")
def json_flat_rows(spark, sf_dir):
    """Events packed as API payloads; a signup has no value, a view no flag."""
    events = table(spark, sf_dir, "events")
    record = F.struct(
        F.concat(F.translate(F.col("ts").cast("string"), " ", "T"), F.lit("Z")).alias("datetime"),
        F.when(F.col("event_type") != "signup", F.col("value")).alias("carbonIntensity"),
        F.when(F.col("event_type") != "view", F.get_json_object("props", "$.k").cast("int") < 50).alias("isEstimated"),
        F.concat(F.translate(F.col("ts").cast("string"), " ", "T"), F.lit("+02:00")).alias("createdAt"),
    )
    payloads = events.select("event_id", F.to_json(F.struct(F.array(record).alias("data"))).alias("payload"))
    return records.flat_records(payloads, "carbonIntensity", keep=["event_id"])


@query("json_struct_flatten")
def json_struct_flatten(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    mix = F.struct(
        F.col("l_quantity").alias("wind"),
        F.col("l_extendedprice").alias("solar"),
        F.struct(F.col("l_discount").alias("imports"), F.col("l_tax").alias("exports")).alias("flows"),
    )
    schema = T.StructType.fromDDL(
        "wind double, solar double, flows struct<imports: double, exports: double>, gas double"
    )
    parsed = lines.select(
        "l_orderkey", "l_linenumber", F.from_json(F.to_json(mix), schema, {"mode": "FAILFAST"}).alias("mix")
    )
    return records.flatten_struct(parsed, "mix")


@query("arrays_to_rows")
def arrays_to_rows(spark, sf_dir):
    """Each day's signals as parallel arrays (24 entries at most); values under 150
    are not published."""
    measures = ["error", "purchase", "signup"]
    hourly = src.wide_signals(spark, sf_dir).select(
        "hour_utc", *[F.when(F.col(m) >= 150, F.col(m)).alias(m) for m in measures]
    )
    in_order = F.array_sort(F.collect_list(F.struct("hour_utc", *measures)))
    payloads = hourly.groupBy(F.to_date("hour_utc").alias("day")).agg(in_order.alias("h"))
    arrays = payloads.select("day", *[F.col(f"h.{c}").alias(c) for c in ["hour_utc", *measures]])
    return records.arrays_to_rows(arrays, "hour_utc", measures, keep=["day"])


@query("list_to_child")
def list_to_child(spark, sf_dir):
    parents = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_set("l_returnflag")).alias("flags"))
    )
    _, child = records.split_list(parents, ["l_orderkey"], "flags")
    return child


@query("variant_reconcile")
def variant_reconcile(spark, sf_dir):
    value = F.col("l_extendedprice")
    whole = F.when(value == F.floor(value), value.cast("bigint"))
    split = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        whole.alias("value"),
        F.when(whole.isNull(), value).alias("value__v_double"),
    )
    return split.select(
        "l_orderkey", "l_linenumber", reconcile(F.col("value"), F.col("value__v_double")).alias("value")
    )


@query("merge_upsert")
def merge_upsert(spark, sf_dir):
    """The hourly signals are stored by day; a later load brings the trailing week
    again with new values, twice, and the hours of one more day."""
    hour = trunc_hour(F.col("ts"))
    first = (
        table(spark, sf_dir, "events")
        .groupBy("event_type", hour.alias("datetime"))
        .agg(F.max("value").alias("value"))
    )

    def dated(df: DataFrame, load_id: str) -> DataFrame:
        return with_load_id(df, load_id).withColumn("day", F.to_date("datetime").cast("string"))

    path = scratch_path(spark, "signals")
    keys = ["event_type", "datetime"]
    upsert(path, dated(first, "load-1"), keys, "day")
    stored = read_table(spark, path).select("event_type", "datetime", "value")
    run_date = dt.date(2024, 1, 30)
    again = ranges.trailing_window(stored, "datetime", run_date, 7)
    ahead = again.where(F.col("datetime") >= F.lit(str(run_date)).cast("timestamp_ntz")).withColumn(
        "datetime", F.col("datetime") + F.expr("INTERVAL '1' DAY")
    )
    batch = dated(again.unionByName(ahead).withColumn("value", F.col("value") + 1), "load-2").unionByName(
        dated(again.withColumn("value", F.col("value") + 2), "load-3")
    )
    upsert(path, batch, keys, "day")
    return rounded(read_table(spark, path).select("event_type", "datetime", "value", "_load_id"))


@query("merge_empty_first")
def merge_empty_first(spark, sf_dir):
    """A load without rows, the events, the events again with new values and one column
    more, and a load without rows."""
    events = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").cast("string").alias("day"), "value")
    path = scratch_path(spark, "events")
    upsert(path, events.limit(0), ["event_id"], "day")
    upsert(path, events, ["event_id"], "day")
    again = with_load_id(events.withColumn("value", F.col("value") + 1), "b")
    upsert(path, again, ["event_id"], "day")
    upsert(path, again.limit(0), ["event_id"], "day")
    return read_table(spark, path).select("event_id", "day", "value", "_load_id")


@query("incremental_window")
def incremental_window(spark, sf_dir):
    """What a run on 2024-01-20 re-loads: views up to that day, the rest one day more."""
    run_date = dt.date(2024, 1, 20)
    is_view = F.col("event_type") == "view"
    wanted = (is_view & ranges.in_trailing_window(F.col("ts"), run_date)) | (
        ~is_view & ranges.in_trailing_window(F.col("ts"), run_date, ahead_days=1)
    )
    return table(spark, sf_dir, "events").where(wanted).select("event_id", "ts", "event_type")


@query("backfill_by_year")
def backfill_years(spark, sf_dir):
    """Orders loaded year by year, a year and a part of it loaded again, then read back."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    start, end = orders.agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    path = scratch_path(spark, "orders_by_year")

    def extract(first: dt.date, last: dt.date) -> DataFrame:
        after = last + dt.timedelta(days=1)
        return orders.where(
            (F.col("o_orderdate") >= F.lit(str(first)).cast("timestamp_ntz"))
            & (F.col("o_orderdate") < F.lit(str(after)).cast("timestamp_ntz"))
        )

    for first, last in ((start, end), (dt.date(1996, 1, 1), dt.date(1996, 12, 31)), (dt.date(1997, 6, 1), dt.date(1997, 12, 31))):
        backfill_by_year(spark, path, first, last, extract, ["o_orderkey"], "o_orderdate")
    return (
        read_table(spark, path)
        .groupBy(F.col("year").cast("int").alias("year"))
        .agg(F.count(F.lit(1)).alias("n_orders"), money("o_totalprice").alias("total_price"))
    )


@query("chunked_read_fallback")
def chunked_read_fallback(spark, sf_dir):
    """Hourly signals land as one file per series and day; all rows are loaded, days with
    fewer than 24 hours are reported as partial, days without any as skipped."""
    hour = trunc_hour(F.col("ts"))
    hourly = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("series"), hour.alias("hour_utc"))
        .agg(F.max("value").alias("value"))
        .withColumn("day", F.to_date("hour_utc"))
    )
    root = scratch_path(spark, "landing")
    hourly.repartition("series", "day").write.partitionBy("series", "day").parquet(root)
    landed = spark.read.schema(hourly.schema).parquet(root)
    wanted = landed.groupBy("series").agg(
        F.to_date(F.min("hour_utc")).alias("start_date"), F.to_date(F.max("hour_utc")).alias("end_date")
    )
    plan = ranges.chunk_ranges(wanted, "start_date", "end_date", 10)
    return landing_read(plan, landed, 24)


@query("chunked_read_source")
def chunked_read_source(spark, sf_dir):
    """A remote that has 24 hours for each day but refuses chunks with a day whose number leaves 1 or 2
    when divided by 6; asked alone, the latter are there. Three series and some weeks of it are
    filtered, so only those are asked; the hours take the signals' values."""
    hourly = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("series"), trunc_hour(F.col("ts")).alias("hour_utc"))
        .agg(F.max("value").alias("value"))
    )
    wanted = hourly.groupBy("series").agg(
        F.to_date(F.min("hour_utc")).alias("start_date"), F.to_date(F.max("hour_utc")).alias("end_date")
    )
    plan = ranges.chunk_ranges(wanted, "start_date", "end_date", 10)

    def fetch(series: str, first: dt.date, last: dt.date) -> list[dict]:
        days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
        if any(d.day % 6 == 1 or (d.day % 6 == 2 and len(days) > 1) for d in days):
            raise RequestFailed(500)
        return [{"hour_utc": dt.datetime(d.year, d.month, d.day, h)} for d in days for h in range(24)]

    row_schema = T.StructType([T.StructField("hour_utc", T.TimestampNTZType())])
    answered = chunk_source(plan, fetch, row_schema, "hour_utc").where(
        F.col("series").isin("click", "view", "purchase")
        & (F.col("day") >= F.lit(dt.date(2024, 1, 4)))
        & (F.col("day") < F.lit(dt.date(2024, 1, 28)))
    )
    return answered.join(hourly, ["series", "hour_utc"], "left").select("series", "status", "day", "hour_utc", "value")


@query("merge_type_change")
def merge_type_change(spark, sf_dir):
    """Narrow numbers are stored first, wide ones follow for a third of the rows, and a load whose
    numbers are texts is refused and leaves no trace."""
    events = table(spark, sf_dir, "events")
    rows = events.select(
        "event_id",
        F.to_date("ts").cast("string").alias("day"),
        F.col("user_id").cast("int").alias("number"),
        F.floor("value").cast("float").alias("measure"),
    )
    path = scratch_path(spark, "typed")
    upsert(path, rows, ["event_id"], "day")
    wide = events.where("event_id % 3 = 0").select(
        "event_id",
        F.to_date("ts").cast("string").alias("day"),
        (F.col("user_id").cast("bigint") * 4294967296).alias("number"),
        F.col("value").alias("measure"),
    )
    upsert(path, wide, ["event_id"], "day")
    try:
        upsert(path, rows.withColumn("number", F.lit("many")), ["event_id"], "day")
    except ValueError:
        return read_table(spark, path).select("event_id", "day", "number", "measure")
    raise AssertionError("a load of another type was not refused")


@query("rebuild_touched")
def rebuild_touched(spark, sf_dir):
    """A table of daily sums is built from merged signals; a later load corrects the clicks of some days
    and brings all views again as they were. Only the days that the merge names are built anew."""
    hourly = (
        table(spark, sf_dir, "events")
        .groupBy("event_type", trunc_hour(F.col("ts")).alias("hour_utc"))
        .agg(F.max("value").alias("value"))
    )
    root = scratch_path(spark, "lake")
    path, keys = f"{root}/raw/signals", ["event_type", "hour_utc"]

    def load(df: DataFrame, load_id: str) -> None:
        dated = with_load_id(df, load_id).withColumn("day", F.to_date("hour_utc").cast("string"))
        upsert(path, dated, keys, "day", days=F.array(F.to_date("hour_utc")))

    def build(only: set[str] | None) -> DataFrame:
        keep = None if only is None else only.__contains__
        sums = read_table(spark, path, keep).groupBy("day").agg(F.count(F.lit(1)).alias("n_hours"), money("value").alias("total"))
        return write_table(sums.withColumn("rebuilt", F.lit(only is not None)), root, "prod", "marts", "daily", "day", keep)

    load(hourly, "load-1")
    build(None)
    built = current_map(spark, path).version
    corrected = hourly.where("event_type = 'click' AND day(hour_utc) % 4 = 0").withColumn("value", F.col("value") + 1)
    load(corrected.unionByName(hourly.where("event_type = 'view'")), "load-2")
    daily = build({d for m in maps_since(spark, path, built) for d in m.days})
    return daily.select(F.col("day").cast("date").alias("day"), "n_hours", "total", "rebuilt")


@query("coverage_islands")
def coverage_gap_islands(spark, sf_dir):
    """Missing hours of each signal as intervals."""
    events = table(spark, sf_dir, "events")
    found = events.select(F.col("event_type").alias("series"), trunc_hour(F.col("ts")).alias("hour_utc")).distinct()
    return reports.gap_islands(found, "hour_utc", by=["series"])


@query("variant_load")
def variant_load(spark, sf_dir):
    """Event values arrive as payloads: whole numbers in the first load, fractions in the second, texts in the
    third. Each type is stored in a column of its own; one number is made of them at the end."""
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "payloads")
    for part, value in enumerate((F.floor("value"), F.col("value"), F.col("value").cast("string"))):
        payloads = events.where(F.col("event_id") % 3 == part).select(
            "event_id", F.to_date("ts").cast("string").alias("day"), F.to_json(F.struct(value.alias("value"))).alias("payload")
        )
        batch = variants.split_by_type(payloads, {"value": "value"}, table_schema(spark, path), keep=["event_id", "day"])
        upsert(path, batch, ["event_id"], "day")
    stored = read_table(spark, path)
    kind = F.when(F.col("value").isNotNull(), "bigint").when(F.col("value__v_string").isNotNull(), "string").otherwise("double")
    return stored.select("event_id", kind.alias("arrived_as"), variants.reconciled(stored, "value").alias("value"))
