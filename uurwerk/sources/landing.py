"""Reading a plan of date chunks, with single days where a chunk has no answer.

For remote sources the chunks are spread over the executors, and each task asks an
injected ``fetch`` for its own. A chunk without an answer is asked for once more,
one day at a time; days that stay without one are reported as skipped. A refused request (401/403) or any other error stops the job: "no data"
and "not allowed to ask" are different failures.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from uurwerk.sources.ranges import expand_days


class RequestFailed(Exception):
    """A request that the source answered with an error status."""

    def __init__(self, status: int, message: str = ""):
        super().__init__(f"{status} {message}".strip())
        self.status = status


AUTH_STATUSES = (401, 403)

# series, first day, last day → the records of that range
Fetch = Callable[[str, dt.date, dt.date], list[dict]]


def answer_schema(row_schema: T.StructType) -> T.StructType:
    """``series``, ``status`` ('loaded' or 'skipped') and ``day`` before the columns of a row."""
    before = [T.StructField("series", T.StringType()), T.StructField("status", T.StringType()), T.StructField("day", T.DateType())]
    return T.StructType([*before, *row_schema.fields])


def answers(
    fetch: Fetch, key: str, first: dt.date, last: dt.date, row_schema: T.StructType, time: str | None = None
) -> Iterator[pa.RecordBatch]:
    """What a chunk answers, or its days one by one if it doesn't. ``time`` names the timestamp whose date is
    a loaded row's day; without it the day stays empty."""
    arrow_schema = to_arrow_schema(answer_schema(row_schema))

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=arrow_schema)

    def loaded(rows: list[dict]) -> pa.RecordBatch:
        days = [None if time is None or row.get(time) is None else row[time].date() for row in rows]
        return batch_of([{**row, "series": key, "status": "loaded", "day": day} for row, day in zip(rows, days)])

    def asked(a: dt.date, b: dt.date) -> pa.RecordBatch | None:
        try:
            return loaded(fetch(key, a, b))
        except RequestFailed as error:
            if error.status in AUTH_STATUSES:
                raise
            return None

    whole = asked(first, last)
    if whole is not None:
        yield whole
        return
    for offset in range((last - first).days + 1):
        day = first + dt.timedelta(days=offset)
        found = asked(day, day)
        yield batch_of([{"series": key, "status": "skipped", "day": day}]) if found is None else found


def chunked_read(
    plan: DataFrame, fetch: Fetch, row_schema: T.StructType, series: str = "series", tasks: int | None = None
) -> DataFrame:
    """Rows of every chunk, plus one ``skipped`` row per day without data.

    ``plan`` has ``series``, ``chunk_start`` and ``chunk_end``. The result has
    ``series``, ``status`` ('loaded' or 'skipped'), ``day`` (of a skipped day)
    and the columns of ``row_schema``. One request at most is held at a time.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for request in batch.to_pylist():
                yield from answers(fetch, request["series"], request["chunk_start"], request["chunk_end"], row_schema)

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    requests = plan.select(F.col(series).cast("string").alias("series"), "chunk_start", "chunk_end")
    width = tasks or plan.sparkSession.sparkContext.defaultParallelism
    return requests.repartition(width, "series", "chunk_start").mapInArrow(read, answer_schema(row_schema))


def landing_read(
    plan: DataFrame, landed: DataFrame, expected_rows: int, series: str = "series", day: str = "day"
) -> DataFrame:
    """The same answer for files that Spark can scan: ``landed`` is a scan of a landing
    folder with the columns ``series`` and ``day``, ``plan`` as in :func:`chunked_read`.

    Whatever rows a day of the plan has are loaded. A day without any is reported as ``skipped``; one
    with fewer than ``expected_rows``, such as the running day of a trailing window or one with a
    gap, is reported as ``partial``, beside its rows. One scan for the counts, one for the rows;
    everything else is as large as the days.
    """
    wanted = expand_days(plan.select(series, "chunk_start", "chunk_end"), "chunk_start", "chunk_end", day)
    wanted = wanted.select(series, day).distinct()
    counts = landed.groupBy(series, day).agg(F.count(F.lit(1)).alias("_rows"))
    found = F.coalesce(F.col("_rows"), F.lit(0))
    status = F.when(found == 0, "skipped").when(found < expected_rows, "partial")
    reported = wanted.join(counts, [series, day], "left").select(
        F.col(series).alias("series"), status.alias("status"), F.col(day).alias("day")
    )
    rows = [c for c in landed.columns if c not in (series, day)]
    loaded = landed.join(wanted, [series, day], "left_semi")
    empty = [F.lit(None).cast(landed.schema[c].dataType).alias(c) for c in rows]
    return loaded.select(
        F.col(series).alias("series"), F.lit("loaded").alias("status"), F.lit(None).cast("date").alias("day"), *rows
    ).unionByName(reported.where("status IS NOT NULL").select("*", *empty))
