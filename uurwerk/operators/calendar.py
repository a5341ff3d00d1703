"""Hour spine and date dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uurwerk.functions.clock import day_at, hours, to_local
from uurwerk.session import spread


def with_local_time(df: DataFrame, tz: str, ts: str = "hour_utc") -> DataFrame:
    """Add the wall clock, local date and local hour of an hourly UTC column."""
    wall = to_local(F.col(ts), tz)
    return df.withColumns(
        {
            "hour_local": wall,
            "date_local": F.to_date(wall),
            "hour_of_day_local": F.hour(wall),
        }
    )


def hour_spine(
    ranges: DataFrame,
    tz: str,
    start: str = "start_date",
    run_date: str = "run_date",
    ahead_days: int = 1,
    by: Sequence[str] = (),
    total_days: int | None = None,
) -> DataFrame:
    """One row per UTC hour, from local midnight of ``start`` through the last
    hour of ``run_date + ahead_days``, for every row of ``ranges``.

    The ranges are spread before they yield their days, the days by site and day
    before they yield their own 23, 24 or 25 hours. Windows over a site's day need no
    further shuffle. Give ``total_days`` for many sites, and the days are spread over
    as many tasks as that takes.
    """
    last = F.date_add(F.col(run_date), ahead_days)
    day = F.col("date_local")
    wanted = spread(ranges.where(F.col(start) <= last).select(*by, start, run_date))
    days = wanted.select(*by, F.explode(F.sequence(F.col(start), last)).alias("date_local"))
    rows = None if total_days is None else 24 * total_days
    bounds = spread(days, *by, "date_local", rows=rows).select(
        *by, "date_local", day_at(day, 0, tz).alias("_first"), day_at(F.date_add(day, 1), 0, tz).alias("_next")
    )
    # On a day of 24 hours the wall clock runs along with UTC, so the zone is
    # looked up per day; only the days of a clock change look it up per hour.
    even = F.col("_next") == F.col("_first") + hours(24)
    spine = bounds.select(
        *by,
        "date_local",
        "_first",
        even.alias("_even"),
        F.explode(F.sequence(F.col("_first"), F.col("_next") - hours(1), hours(1))).alias("hour_utc"),
    )
    wall = F.when(F.col("_even"), day.cast("timestamp_ntz") + (F.col("hour_utc") - F.col("_first"))).otherwise(
        to_local(F.col("hour_utc"), tz)
    )
    return spine.select(*by, "hour_utc", wall.alias("hour_local"), "date_local", F.hour(wall).alias("hour_of_day_local"))


def date_dimension(days: DataFrame, holidays: DataFrame, day: str = "date_local") -> DataFrame:
    """Calendar attributes per distinct day, with the holiday flags of that day.

    ``holidays`` has one row per ``holiday_date`` with ``is_public_holiday``,
    ``holiday_name`` and ``holiday_types``.
    """
    d = F.col("date_day")
    weekend = F.dayofweek(d).isin(1, 7)  # 1 = Sunday
    public = F.coalesce(F.col("is_public_holiday"), F.lit(False))
    seasons = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}
    season = F.lit("Autumn")
    for name, months in seasons.items():
        season = F.when(F.month(d).isin(*months), F.lit(name)).otherwise(season)

    return (
        days.select(F.col(day).alias("date_day"))
        .distinct()
        .join(
            holidays.select("holiday_date", "is_public_holiday", "holiday_name", "holiday_types"),
            d == F.col("holiday_date"),
            "left",
        )
        .select(
            "date_day",
            F.year(d).alias("year"),
            F.quarter(d).alias("quarter"),
            F.month(d).alias("month"),
            F.date_format(d, "MMMM").alias("month_name"),
            F.weekofyear(d).alias("iso_week"),
            F.dayofweek(d).alias("day_of_week"),
            F.date_format(d, "EEEE").alias("day_name"),
            weekend.alias("is_weekend"),
            season.alias("season"),
            public.alias("is_public_holiday"),
            "holiday_name",
            "holiday_types",
            (weekend | public).alias("is_non_working_day"),
        )
    )
