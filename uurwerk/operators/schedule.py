"""Monthly operating profile → hourly schedule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uurwerk.params import SiteParams
from uurwerk.session import broadcast_up_to


def expand_schedule(hours: DataFrame, profile: DataFrame, params: SiteParams, by: Sequence[str] = ()) -> DataFrame:
    """Look up each hour's month in the profile and apply its rules in local time.

    ``by`` names the key columns of a profile that differs per site. A profile of
    twelve rows is broadcast after its rows have been counted; a larger one, of
    many sites, meets the hours in an ordinary join on site and month.
    """
    hour = F.col("hour_of_day_local")
    is_day = (hour >= params.day_start_hour) & (hour < params.day_end_hour)
    scheduled = F.col("lighting_enabled") & (hour >= F.col("lights_on_hour")) & (hour < F.col("lights_off_hour"))
    return (
        hours.withColumn("month", F.month("date_local"))
        .join(broadcast_up_to(profile, 12), [*by, "month"], "inner")
        .select(
            *hours.columns,
            is_day.alias("is_day"),
            F.coalesce(scheduled, F.lit(False)).alias("is_lighting_scheduled"),
            F.when(is_day, F.col("heating_day_setpoint_c"))
            .otherwise(F.col("heating_night_setpoint_c"))
            .alias("heating_setpoint_c"),
        )
    )
