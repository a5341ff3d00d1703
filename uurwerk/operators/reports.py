"""Summaries over the comparison, and diagnoses of the loaded series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uurwerk.functions.clock import hours
from uurwerk.functions.nulls import safe_divide
from uurwerk.session import spread


def summary_by_period(daily: DataFrame, period: Column, area_m2: float, by: Sequence[str] = ()) -> DataFrame:
    """Use per m², cost, savings and CO2 per period, and the electricity share of
    the baseline bill."""
    area = F.lit(float(area_m2))
    cost, saved = F.sum("baseline_total_cost_eur"), F.sum("cost_savings_eur")
    return daily.groupBy(*by, period).agg(
        F.count(F.lit(1)).alias("n_days"),
        (F.sum("baseline_gas_m3") / area).alias("gas_m3_per_m2"),
        (F.sum("baseline_electricity_kwh") / area).alias("electricity_kwh_per_m2"),
        cost.alias("baseline_cost_eur"),
        saved.alias("saved_eur"),
        safe_divide(saved, cost).alias("saved_pct"),
        F.sum("co2_savings_kg").alias("co2_saved_kg"),
        F.sum("baseline_co2_kg").alias("baseline_co2_kg"),
        safe_divide(
            F.sum("baseline_electricity_cost_eur"),
            F.sum(F.when(F.col("baseline_total_cost_eur").isNotNull(), F.col("baseline_electricity_cost_eur")))
            + F.sum(F.when(F.col("baseline_total_cost_eur").isNotNull(), F.col("baseline_gas_cost_eur"))),
        ).alias("electricity_share"),
    )


def on_complete_days(hourly: DataFrame, daily: DataFrame, day: str = "date_local", by: Sequence[str] = ()) -> DataFrame:
    """Hours of the days whose cost is complete."""
    complete = daily.where("is_complete").select(*by, F.col("date_day").alias(day))
    return hourly.join(complete, [*by, day], "left_semi")


def price_per_on_hour(hourly: DataFrame) -> DataFrame:
    """Mean price and carbon of the lamp energy, per scenario. Hours without the
    value count neither above nor below the line."""

    def mean_of(column: str) -> Column:
        weight = F.when(F.col(column).isNotNull(), F.col("lighting_kwh"))
        return safe_divide(F.sum(F.col(column) * F.col("lighting_kwh")), F.sum(weight))

    return (
        hourly.where("is_lighting_on")
        .groupBy("scenario")
        .agg(
            F.count(F.lit(1)).alias("on_hours"),
            mean_of("electricity_price_eur_per_kwh").alias("price_per_on_hour"),
            mean_of("carbon_intensity_gco2eq_per_kwh").alias("carbon_per_on_hour"),
        )
    )


def day_outcomes(daily: DataFrame, places: int = 6, by: Sequence[str] = ()) -> DataFrame:
    """Complete days on which shifting was cheaper, equal or dearer, and on which
    it emitted less or more. Differences below ``places`` decimals are equal."""
    saved = F.round("cost_savings_eur", places)
    co2 = F.round("co2_savings_kg", places)
    return (
        daily.where("is_complete")
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("complete_days"),
            F.count_if(saved > 0).alias("cheaper_days"),
            F.count_if(saved == 0).alias("equal_days"),
            F.count_if(saved < 0).alias("dearer_days"),
            F.count_if(co2 > 0).alias("less_co2_days"),
            F.count_if(co2 < 0).alias("more_co2_days"),
        )
    )


def expected_hours(chunks: DataFrame, by: Sequence[str], start: str = "chunk_start", end: str = "chunk_end") -> DataFrame:
    """Every UTC hour of every chunk (dates, both ends inclusive)."""
    first = F.col(start).cast("timestamp_ntz")
    last = F.date_add(F.col(end), 1).cast("timestamp_ntz") - hours(1)
    return spread(chunks.where(F.col(start) <= F.col(end)), *by, start).select(
        *by, start, end, F.explode(F.sequence(first, last, hours(1))).alias("hour_utc")
    )


def missing_hours(found: DataFrame, chunks: DataFrame, by: Sequence[str]) -> DataFrame:
    """Expected hours that the series does not have."""
    have = found.select(*by, "hour_utc").distinct()
    return expected_hours(chunks, by).join(have, [*by, "hour_utc"], "left_anti")


def coverage(
    found: DataFrame, chunks: DataFrame, by: Sequence[str], start: str = "chunk_start", end: str = "chunk_end"
) -> DataFrame:
    """Hours found and expected per chunk, with the missing hours listed.

    Duplicates of an hour are removed before the join. The list of a chunk is
    bounded by the hours of the chunk.
    """
    have = found.select(*by, "hour_utc").distinct().withColumn("_have", F.lit(True))
    missing = F.when(F.col("_have").isNull(), F.substring(F.col("hour_utc").cast("string"), 1, 13))
    return (
        expected_hours(chunks, by, start, end)
        .join(have, [*by, "hour_utc"], "left")
        .groupBy(*by, start, end)
        .agg(
            F.count(F.lit(1)).alias("hours_expected"),
            F.count("_have").alias("hours_found"),
            (F.count(F.lit(1)) - F.count("_have")).alias("hours_missing"),
            F.array_join(F.array_sort(F.collect_list(missing)), ", ").alias("missing_hours"),
        )
    )


def gap_islands(found: DataFrame, ts: str, by: Sequence[str] = (), bounds: DataFrame | None = None) -> DataFrame:
    """The hours that each series lacks, as intervals: ``gap_start`` and ``gap_end`` (both missing) and
    ``gap_hours``, one row per gap.

    Nothing is expanded: a gap is what lies between an hour and the next one that is there, so the
    result grows with the gaps and the work with the rows. ``bounds`` is one row with the first and
    last hour that is expected (``first_hour``, ``last_hour``); by default those of all series
    together, so that a series also lacks what it has at neither end. A series without
    any hour is not listed.
    """
    have = found.select(*by, F.col(ts).alias("_at")).where("_at IS NOT NULL").distinct()
    if bounds is None:
        bounds = have.agg(F.min("_at").alias("first_hour"), F.max("_at").alias("last_hour"))
    first, last = bounds.select("first_hour").scalar(), bounds.select("last_hour").scalar()
    order = Window.partitionBy(*by).orderBy("_at")
    known = have.where((F.col("_at") >= first) & (F.col("_at") <= last)).withColumns(
        {"_before": F.lag("_at").over(order), "_after": F.coalesce(F.lead("_at").over(order), last + hours(1))}
    )
    head = F.struct(first.alias("gap_start"), (F.col("_at") - hours(1)).alias("gap_end"))
    tail = F.struct((F.col("_at") + hours(1)).alias("gap_start"), (F.col("_after") - hours(1)).alias("gap_end"))
    gaps = known.select(*by, F.inline(F.array(F.when(F.col("_before").isNull(), head), tail)))
    length = F.timestamp_diff("HOUR", F.col("gap_start"), F.col("gap_end")) + 1
    return gaps.where("gap_start <= gap_end").withColumn("gap_hours", length.cast("bigint"))


def coverage_by_year(chunks: DataFrame, by: Sequence[str], start: str = "chunk_start") -> DataFrame:
    """Per calendar year: hours found and missing against the hours of the whole year,
    and how many chunks are complete and how many are not. ``chunks`` is the result of
    :func:`coverage` for chunks that don't cross a year."""
    year = F.year(start)
    first = F.make_date(year, F.lit(1), F.lit(1))
    return (
        chunks.groupBy(*by, year.alias("year"))
        .agg(
            F.sum("hours_found").alias("hours_found"),
            F.sum("hours_missing").alias("hours_missing"),
            F.max(F.datediff(F.add_months(first, 12), first) * 24).cast("bigint").alias("hours_in_year"),
            F.count_if(F.col("hours_missing") == 0).alias("chunks_complete"),
            F.count_if(F.col("hours_missing") > 0).alias("chunks_with_gaps"),
        )
    )


def duplicate_days(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys with more than one row whose values differ."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(value).alias("n_values"))
        .where((F.col("n_rows") > 1) & (F.col("n_values") > 1))
    )


def lag_scan(
    series: DataFrame, reference: DataFrame, value: str, lags: range, ts: str = "hour_utc", by: Sequence[str] = ()
) -> DataFrame:
    """Mean absolute difference between a series and a reference at each lag.

    A lag of ``k`` compares the series' hour ``t`` with the reference's hour
    ``t - k``; ``is_best`` marks the lag with the least difference (the smallest
    one on a tie). One row per key and hour is expected; missing values are left out.

    Both are packed into one row for each key and day first, so a day is shuffled
    once, whatever the number of lags.
    """
    days = 1 + max(abs(k) for k in lags) // 24
    day, hour = F.to_date(ts).alias("_day"), F.hour(ts)

    def packed(df: DataFrame, column: str, name: str) -> DataFrame:
        """A map from hour to value for each key and day: at most 24 entries."""
        entry = F.struct(hour.alias("hour"), F.col(column).alias("value"))
        return df.groupBy(*by, day).agg(F.map_from_entries(F.collect_list(entry)).alias(name))

    own = packed(series.where(F.col(value).isNotNull()), value, "_own")
    offsets = F.explode(F.sequence(F.lit(-days), F.lit(days)))
    # Each packed day meets the days around it that some lag reaches.
    around = (
        packed(reference.where(F.col(value).isNotNull()), value, "_other")
        .withColumn("_offset", offsets)
        .withColumn("_day", F.date_add("_day", F.col("_offset")))
    )
    met = own.join(around, [*by, "_day"], "inner")

    def gaps(lag: int) -> Column:
        """Differences at one lag between this day and the reference's day at ``_offset``."""
        there = F.transform(
            F.map_entries("_own"),
            lambda e: F.abs(e["value"] - F.try_element_at("_other", e["key"] - lag + 24 * F.col("_offset"))),
        )
        known = F.filter(there, lambda g: g.isNotNull())
        return F.struct(
            F.lit(lag).alias("lag_hours"),
            F.size(known).cast("bigint").alias("n"),
            F.aggregate(known, F.lit(0.0), lambda a, g: a + g).alias("sum"),
        )

    per_lag = (
        met.select(*by, F.inline(F.array(*[gaps(k) for k in lags])))
        .where("n > 0")
        .groupBy(*by, "lag_hours")
        .agg(F.sum("n").alias("n_hours"), (F.sum("sum") / F.sum("n")).alias("mean_abs_diff"))
    )
    best = F.min(F.struct("mean_abs_diff", "lag_hours")).over(Window.partitionBy(*(by or [F.lit(0)])))
    return per_lag.withColumn("is_best", F.col("lag_hours") == best.getField("lag_hours"))
