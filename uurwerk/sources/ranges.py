"""Date-range planning on tables: one row per request in, one per chunk out.

A table of ranges is small before it expands and would sit in one task, so it is
spread over all tasks first."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uurwerk.session import broadcast_up_to, spread

MAX_SIGNALS = 100_000


def chunk_ranges(ranges: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """Cut each range into chunks of ``days`` days; the last one may be shorter.
    A range whose start lies after its end yields nothing."""
    first = F.explode(F.sequence(F.col(start), F.col(end), F.expr(f"INTERVAL '{int(days)}' DAY")))
    return (
        spread(ranges.where(F.col(start) <= F.col(end)))
        .withColumn("chunk_start", first)
        .withColumn("chunk_end", F.least(F.date_add("chunk_start", days - 1), F.col(end)))
    )


def year_chunks(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Cut each range at the turn of the year, clipped to both ends."""
    year = F.explode(F.sequence(F.year(start), F.year(end)))
    return (
        spread(ranges.where(F.col(start) <= F.col(end)))
        .withColumn("chunk_year", year)
        .withColumn("chunk_start", F.greatest(F.col(start), F.make_date("chunk_year", F.lit(1), F.lit(1))))
        .withColumn("chunk_end", F.least(F.col(end), F.make_date("chunk_year", F.lit(12), F.lit(31))))
    )


def expand_days(ranges: DataFrame, start: str, end: str, day: str = "day") -> DataFrame:
    """One row per date of each range, both ends included."""
    return spread(ranges.where(F.col(start) <= F.col(end))).withColumn(
        day, F.explode(F.sequence(F.col(start), F.col(end), F.expr("INTERVAL '1' DAY")))
    )


def clip_ranges(
    requests: DataFrame, availability: DataFrame, on: str, start: str, end: str, available_from: str = "available_from"
) -> DataFrame:
    """Move each start up to the first available day; drop requests that end
    before it. A request without an availability row is left as it is. One signal
    may have most of the requests, so a short availability list is broadcast."""
    starts = broadcast_up_to(availability.select(on, available_from), MAX_SIGNALS)
    return (
        requests.join(starts, on, "left")
        .where(F.col(available_from).isNull() | (F.col(end) >= F.col(available_from)))
        .withColumn("effective_start", F.greatest(F.col(start), F.col(available_from)))
    )


def trailing_window(
    df: DataFrame, ts: str, run_date: dt.date, lookback_days: int = 7, ahead_days: int = 0
) -> DataFrame:
    """Rows of ``[run_date - lookback, run_date + ahead]``, whole UTC days.

    A plain range on the raw timestamp, so it reaches the file scan.
    """
    return df.where(in_trailing_window(F.col(ts), run_date, lookback_days, ahead_days))


def in_trailing_window(ts: Column, run_date: dt.date, lookback_days: int = 7, ahead_days: int = 0) -> Column:
    if not 1 <= lookback_days <= 60:
        raise ValueError("lookback_days must be between 1 and 60")
    first = run_date - dt.timedelta(days=lookback_days)
    after = run_date + dt.timedelta(days=ahead_days + 1)
    return (ts >= F.lit(str(first)).cast("timestamp_ntz")) & (ts < F.lit(str(after)).cast("timestamp_ntz"))


def holiday_years(run_date: dt.date) -> tuple[int, int]:
    """Holidays are loaded by whole years: the current one and the next."""
    return run_date.year, run_date.year + 1
