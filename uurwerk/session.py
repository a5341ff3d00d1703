"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Timestamps are TIMESTAMP_NTZ holding UTC, so results do not depend on the
# session zone; the zone is pinned anyway for readers that use TIMESTAMP.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


# Rows that one task may generate from a spread table.
ROWS_PER_TASK = 2_000_000


def build_session(app: str = "uurwerk", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.

    Only a local-mode session may go without one; it then gets a temporary
    folder for the life of the session. A cluster without a shared folder is an
    error, because a machine-local folder does not outlive its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="uurwerk-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A fresh path in ``folder``, by default in the shared one; no two calls return
    the same one."""
    return f"{folder or shared_folder(spark) + '/uurwerk'}/{uuid.uuid4().hex}/{name}"


def file_store(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    store, at = file_store(spark, path)
    return store.exists(at)


def remove_path(spark: SparkSession, path: str) -> None:
    store, at = file_store(spark, path)
    store.delete(at, True)


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder in the shared one for the tables of one piece of work, removed at its
    end. Results must have been stored elsewhere by then."""
    folder = f"{shared_folder(spark)}/uurwerk/run-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        remove_path(spark, folder)


def spread(df: DataFrame, *columns: str, rows: int | None = None) -> DataFrame:
    """Distribute the rows by ``columns`` over all shuffle partitions, or over more if
    ``rows`` are to come and a task would get more than ``ROWS_PER_TASK`` of them.

    For small tables that are about to expand: by their size alone they would be
    coalesced into one task, which would then generate every row. The number is
    explicit, so adaptive execution keeps it; later steps keyed by the same
    columns reuse the distribution.
    """
    spark = df.sparkSession
    try:
        width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except ValueError:
        width = spark.sparkContext.defaultParallelism
    if rows is not None:
        width = max(width, -(-rows // ROWS_PER_TASK))
    return df.repartition(width, *columns)


def broadcast_up_to(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else as it is.

    For lookup tables whose few keys would otherwise pull the other side into as
    many tasks. Beyond the bound the join is an ordinary one, whose crowded
    partitions adaptive execution splits.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def materialize(
    df: DataFrame, name: str, partition_by: list[str] | None = None, folder: str | None = None, rows_per_file: int = 0
) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one result feeds several branches of a plan: the input is scanned
    once, the branches prune columns on the copy, and lost executors re-read
    the files instead of recomputing the lineage. A ``folder`` of
    :func:`run_folder` is removed with the work it belongs to; without one the copy is
    left to the shared folder's own clean-up. ``rows_per_file`` bounds the rows of a file.
    """
    path = scratch_path(df.sparkSession, name, folder)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
