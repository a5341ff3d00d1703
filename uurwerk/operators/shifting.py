"""Moving a day's on-hours to its cheapest eligible hours."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_cheapest(
    df: DataFrame,
    day: str = "date_local",
    eligible: str = "is_dark_enough_for_lighting",
    baseline_on: str = "is_lighting_on_baseline",
    price: str = "electricity_price_eur_per_kwh",
    tiebreak: str = "hour_utc",
    by: Sequence[str] = (),
) -> DataFrame:
    """Add the day's on-hours, its unpriced hours and the price rank of each
    eligible hour.

    Input is one row per hour and site, so a window never holds more than the
    25 hours of one day. Within a day the eligible hours sort first, so their
    position is their rank, and the counts can share the same sorted window: one
    exchange on ``by`` + ``day``, one sort.
    """
    cheapest_first = Window.partitionBy(*by, day).orderBy(
        F.col(eligible).desc_nulls_last(), F.col(price).asc_nulls_first(), F.col(tiebreak)
    )
    whole_day = cheapest_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    position = F.row_number().over(cheapest_first)
    return df.select(
        "*",
        F.count_if(F.col(baseline_on)).over(whole_day).alias("lighting_hours_in_day"),
        F.count_if(F.col(price).isNull()).over(whole_day).alias("unpriced_hours_in_day"),
        F.when(F.col(eligible), position).alias("price_rank_among_dark_hours"),
    )


def shift_to_cheapest(
    df: DataFrame,
    day: str = "date_local",
    eligible: str = "is_dark_enough_for_lighting",
    baseline_on: str = "is_lighting_on_baseline",
    price: str = "electricity_price_eur_per_kwh",
    tiebreak: str = "hour_utc",
    by: Sequence[str] = (),
    optimized_on: str = "is_lighting_on_optimized",
) -> DataFrame:
    """Add ``optimized_on``: as many on-hours as the baseline has that day, in the
    cheapest eligible hours. A day with any unpriced hour keeps its baseline."""
    ranked = rank_cheapest(df, day, eligible, baseline_on, price, tiebreak, by)
    cheapest = F.coalesce(F.col("price_rank_among_dark_hours") <= F.col("lighting_hours_in_day"), F.lit(False))
    return ranked.withColumn(
        optimized_on, F.when(F.col("unpriced_hours_in_day") > 0, F.col(baseline_on)).otherwise(cheapest)
    )


def scenario_expand(df: DataFrame, scenarios: Mapping[str, str], flag: str = "is_lighting_on") -> DataFrame:
    """Long form: one row per input row and scenario, with that scenario's flag.

    One pass over the input; a union of filtered copies would run the windows
    that feed it once per scenario.
    """
    rows = F.array(*[F.struct(F.lit(name).alias("scenario"), F.col(c).alias(flag)) for name, c in scenarios.items()])
    kept = [c for c in df.columns if c not in scenarios.values()]
    return df.withColumn("_s", F.explode(rows)).select(*kept, "_s.scenario", f"_s.{flag}")
