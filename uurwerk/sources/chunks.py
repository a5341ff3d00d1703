"""Date chunks of a remote source as a Python data source: one input partition a chunk.

The source can be filtered like a table: conditions on ``series`` and ``day`` reach its plan before
anything is asked for, chunks outside are never asked, chunks that reach over the edge are
cut to it. What a chunk answers, and what becomes of one that does not, is as in
:mod:`uurwerk.sources.landing`.
"""

from __future__ import annotations

import base64
import datetime as dt
import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from uurwerk.sources import landing
from uurwerk.sources.landing import Fetch, answers, answer_schema

# A plan of chunks is held by the driver, as the partitions of any scan are.
MAX_CHUNKS = 200_000


@dataclass
class Chunk(InputPartition):
    series: str
    first: dt.date
    last: dt.date


class ChunkReader(DataSourceReader):
    def __init__(self, plan: list[Chunk], fetch: Fetch, row_schema: T.StructType, time: str):
        self.plan, self.fetch, self.row_schema, self.time = plan, fetch, row_schema, time

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Cut the plan to what the filters can let through. All of them are handed back as well: a source
        may answer more than it was asked for."""
        one = dt.timedelta(days=1)
        for f in filters:
            if f.attribute == ("series",) and isinstance(f, EqualTo):
                self.plan = [c for c in self.plan if c.series == f.value]
            elif f.attribute == ("series",) and isinstance(f, In):
                self.plan = [c for c in self.plan if c.series in f.value]
            elif f.attribute == ("day",) and isinstance(getattr(f, "value", None), dt.date):
                low = {GreaterThanOrEqual: f.value, EqualTo: f.value, GreaterThan: f.value + one}.get(type(f), dt.date.min)
                high = {LessThanOrEqual: f.value, EqualTo: f.value, LessThan: f.value - one}.get(type(f), dt.date.max)
                cut = [Chunk(c.series, max(c.first, low), min(c.last, high)) for c in self.plan]
                self.plan = [c for c in cut if c.first <= c.last]
            yield f

    def partitions(self) -> list[Chunk]:
        # A scan has one partition at least; this one asks for nothing.
        return self.plan or [Chunk("", dt.date.max, dt.date.min)]

    def read(self, partition: Chunk) -> Iterator[pa.RecordBatch]:
        if partition.first <= partition.last:
            yield from answers(self.fetch, partition.series, partition.first, partition.last, self.row_schema, self.time)


class ChunkSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "uurwerk_chunks"

    def _row_schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.options["row_schema"]))

    def schema(self) -> T.StructType:
        return answer_schema(self._row_schema())

    def reader(self, schema: T.StructType) -> ChunkReader:
        fetch = cloudpickle.loads(base64.b64decode(self.options["fetch"]))
        day = dt.date.fromisoformat
        plan = [Chunk(s, day(a), day(b)) for s, a, b in json.loads(self.options["plan"])]
        return ChunkReader(plan, fetch, self._row_schema(), self.options["time"])


def chunk_source(plan: DataFrame, fetch: Fetch, row_schema: T.StructType, time: str, series: str = "series") -> DataFrame:
    """The rows that a plan of chunks (``series``, ``chunk_start``, ``chunk_end``) answers, as a lazy scan with the columns
    ``series``, ``status`` ('loaded' or 'skipped'), ``day`` and those of ``row_schema``. ``time`` names the row's
    timestamp, whose date is the ``day`` of a loaded row.

    Each scan asks anew: store its result before using it twice. Plans of more than
    ``MAX_CHUNKS`` chunks are refused; :func:`uurwerk.sources.landing.chunked_read` takes any number.
    """
    spark = plan.sparkSession
    chunks = plan.select(F.col(series).cast("string"), "chunk_start", "chunk_end").limit(MAX_CHUNKS + 1).collect()
    if len(chunks) > MAX_CHUNKS:
        raise ValueError(f"a plan of more than {MAX_CHUNKS} chunks is not held by the driver; use chunked_read")
    for module in (landing, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(ChunkSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    asked = json.dumps([[s, str(a), str(b)] for s, a, b in chunks])
    return (
        spark.read.format(ChunkSource.name())
        .option("plan", asked)
        .option("row_schema", row_schema.json())
        .option("fetch", base64.b64encode(cloudpickle.dumps(fetch)).decode())
        .option("time", time)
        .load()
    )
