"""Wall-clock arithmetic on TIMESTAMP_NTZ columns that hold UTC."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_local(ts_utc: Column, tz: str) -> Column:
    """UTC → wall clock. The result repeats an hour in autumn: never join on it."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ts_utc)


def to_utc(wall_clock: Column, tz: str) -> Column:
    """Wall clock → UTC. An ambiguous time is read as the earlier instant."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), wall_clock)


def local_date(ts_utc: Column, tz: str) -> Column:
    return F.to_date(to_local(ts_utc, tz))


def hours(n: int) -> Column:
    return F.expr(f"INTERVAL '{n}' HOUR")


def trunc_hour(ts: Column) -> Column:
    """Start of the hour. Unlike ``date_trunc`` this never passes through the
    session zone, whose clock changes would move some hours."""
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(ts))


def day_at(day: Column, hour: int, tz: str) -> Column:
    """The instant (UTC) at which the local clock shows ``hour`` on ``day``."""
    return to_utc(day.cast("timestamp_ntz") + hours(hour), tz)


def parse_utc(text: Column) -> Column:
    """ISO text → UTC. Text with an offset is converted; text without one is UTC.

    The text is read as an instant and counted from the epoch, so the session
    zone plays no part. Text that is not a time stops the job.
    """
    full = (
        F.when(F.length(text) <= 10, F.concat(text, F.lit("T00:00:00")))
        .when(F.substring(text, 17, 1) == ":", text)
        .otherwise(F.concat(F.substring(text, 1, 16), F.lit(":00"), F.substring(text, 17, 6)))
    )
    zoned = F.when(full.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), full).otherwise(F.concat(full, F.lit("Z")))
    seconds = F.unix_micros(F.to_timestamp(zoned)).cast("decimal(18,0)") * F.lit(Decimal("0.000001"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
