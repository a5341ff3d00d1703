"""Days as one row: a key's 23, 24 or 25 hours in one array.

A packed day is shuffled, joined and sorted as one row instead of one for each hour.
Signals that many sites share are packed once and meet the sites' days by date, so
no hour of a site is ever exchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pack_days(
    df: DataFrame, fields: Sequence[str], day: str = "date_local", by: Sequence[str] = (), tiebreak: str = "hour_utc"
) -> DataFrame:
    """One row for each key and day: ``hours`` holds its rows' ``tiebreak`` and ``fields``
    as structs in the order of ``tiebreak``. Hours of a day that lie in one input
    partition are put together before the exchange. Repeated hours all stay."""
    entry = F.struct(tiebreak, *fields)
    return df.groupBy(*by, day).agg(F.sort_array(F.collect_list(entry)).alias("hours"))


def with_fields(packed: DataFrame, fields: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Add fields to each hour; a function gets the hour and may use the day's columns."""

    def extended(hour: Column) -> Column:
        for name, make in fields.items():
            hour = hour.withField(name, make(hour))
        return hour

    return packed.withColumn("hours", F.transform("hours", extended))


def shift_days(
    packed: DataFrame,
    eligible: str = "is_dark_enough_for_lighting",
    baseline_on: str = "is_lighting_on_baseline",
    price: str = "electricity_price_eur_per_kwh",
    tiebreak: str = "hour_utc",
    optimized_on: str = "is_lighting_on_optimized",
) -> DataFrame:
    """:func:`uurwerk.operators.shifting.shift_to_cheapest` inside each packed day: the
    same counts beside ``hours``, the same rank and flag in each hour, no exchange
    and no window. A day's hours are sorted by price, numbered and sorted back."""
    counted = packed.withColumns(
        {
            "lighting_hours_in_day": F.size(F.filter("hours", lambda h: h[baseline_on])).cast("bigint"),
            "unpriced_hours_in_day": F.size(F.filter("hours", lambda h: h[price].isNull())).cast("bigint"),
        }
    )
    cheapest_first = F.sort_array(
        F.transform(
            "hours",
            lambda h, at: F.struct(
                F.when(h[eligible], 0).when(~h[eligible], 1).otherwise(2).alias("turn"),
                h[price].alias("price"),
                h[tiebreak].alias("moment"),
                at.alias("at"),
                h.alias("hour"),
            ),
        )
    )

    def ranked(entry: Column, before: Column) -> Column:
        hour = entry["hour"]
        rank = F.when(hour[eligible], before + 1)
        cheapest = F.coalesce(rank <= F.col("lighting_hours_in_day"), F.lit(False))
        flag = F.when(F.col("unpriced_hours_in_day") > 0, hour[baseline_on]).otherwise(cheapest)
        return F.struct(
            entry["at"].alias("at"),
            hour.withField("price_rank_among_dark_hours", rank).withField(optimized_on, flag).alias("hour"),
        )

    in_order = F.sort_array(F.transform(cheapest_first, ranked))
    return counted.withColumn("hours", F.transform(in_order, lambda e: e["hour"]))


def unpack_days(packed: DataFrame) -> DataFrame:
    """One row for each hour again; the day's columns are repeated."""
    return packed.select(*[c for c in packed.columns if c != "hours"], F.inline("hours"))
