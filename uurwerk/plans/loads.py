"""Loading raw tables: what to ask for, how to read it, how to store history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uurwerk.params import CHUNK_DAYS, SIGNAL_AVAILABLE_FROM
from uurwerk.session import materialize
from uurwerk.sources.landing import Fetch, chunked_read
from uurwerk.sources.ranges import chunk_ranges, clip_ranges, year_chunks

# first and last day → the rows, or the rows and the (series, day) without data
Extract = Callable[[dt.date, dt.date], DataFrame | tuple[DataFrame, DataFrame]]


def _request(spark: SparkSession, name: str, first: dt.date, last: dt.date) -> DataFrame:
    """The request for one table, clipped to the days its source can have."""
    request = spark.sql(f"SELECT '{name}' AS series, DATE'{first}' AS first_day, DATE'{last}' AS last_day")
    starts = ", ".join(f"('{series}', DATE'{day}')" for series, day in SIGNAL_AVAILABLE_FROM.items())
    availability = spark.sql(f"SELECT * FROM VALUES {starts} AS a(series, available_from)")
    return clip_ranges(request, availability, "series", "first_day", "last_day")


def request_plan(spark: SparkSession, name: str, first: dt.date, last: dt.date) -> DataFrame:
    """One row per request that the source of a table accepts."""
    request = _request(spark, name, first, last)
    if name in CHUNK_DAYS:
        return chunk_ranges(request, "effective_start", "last_day", CHUNK_DAYS[name])
    return year_chunks(request, "effective_start", "last_day")


def read_source(
    spark: SparkSession, name: str, fetch: Fetch, row_schema: T.StructType, first: dt.date, last: dt.date
) -> tuple[DataFrame, DataFrame]:
    """Rows of a table's source and the days it had no data for.

    The answers are stored before they are used, so no request is sent twice.
    """
    answers = materialize(chunked_read(request_plan(spark, name, first, last), fetch, row_schema), name)
    rows = answers.where(F.col("status") == "loaded").select(*row_schema.names)
    skipped = answers.where(F.col("status") == "skipped").select("series", "day")
    return rows, skipped


def from_source(spark: SparkSession, name: str, fetch: Fetch, row_schema: T.StructType) -> Extract:
    """The extract that reads a table's source through :func:`read_source`."""
    return lambda first, last: read_source(spark, name, fetch, row_schema, first, last)


def load_history(
    spark: SparkSession, name: str, extract: Extract, store: Callable[[DataFrame], None], first: dt.date, last: dt.date
) -> list[int]:
    """Load a long range one calendar year at a time, each committed by ``store``
    before the next one is asked for. Years before the source's first day are not
    asked for at all."""
    years = year_chunks(_request(spark, name, first, last), "effective_start", "last_day").orderBy("chunk_year")
    done = []
    for year in years.collect():
        store(extract(year["chunk_start"], year["chunk_end"]))
        done.append(year["chunk_year"])
    return done
