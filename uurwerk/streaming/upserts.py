"""The keyed merge, fed by files as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from uurwerk.sources.tables import upsert


def upsert_stream(stream: DataFrame, path: str, keys: Sequence[str], partition: str, checkpoint: str) -> StreamingQuery:
    """Merge everything that is available, then stop.

    A micro-batch that is repeated after a failure merges the same rows again,
    which changes nothing; so the result is exactly-once.
    """
    return (
        stream.writeStream.foreachBatch(lambda batch, _: upsert(path, batch, keys, partition))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
