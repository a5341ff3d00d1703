"""Raw table schemas, layered sinks, keyed merge and per-year backfill."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uurwerk.operators.dedup import dedup_latest
from uurwerk.session import materialize, run_folder
from uurwerk.sources.ranges import year_chunks
from uurwerk.sources.versions import (
    Conflict,
    TableMap,
    commit,
    current_map,
    note_schema,
    read_parts,
    unified,
)

_SIGNAL = (
    "datetime timestamp_ntz, value double, is_estimated boolean, created_at timestamp_ntz, "
    "updated_at timestamp_ntz, _load_id string"
)
_PAIRED = ("wind", "solar", "nuclear", "coal")
_SINGLE = (
    "hydro",
    "biomass",
    "gas",
    "unknown",
    "battery_storage__charge",
    "hydro_storage__charge",
    "flows__imports",
    "flows__exports",
)

# The raw tables' names, columns and keys.
RAW_SCHEMAS = {
    "electricity_prices": "timestamp_utc timestamp_ntz, price_eur_per_kwh double, _load_id string",
    "gas_prices": "timestamp_utc timestamp_ntz, price_eur_per_m3 double, _load_id string",
    "carbon_intensity": _SIGNAL,
    "renewable_percentage": _SIGNAL,
    "carbon_free_percentage": _SIGNAL,
    "total_load": _SIGNAL,
    "day_ahead_price": "datetime timestamp_ntz, value bigint, value__v_double double, is_estimated boolean, "
    "created_at timestamp_ntz, updated_at timestamp_ntz, _load_id string",
    "electricity_mix": "datetime timestamp_ntz, "
    + ", ".join(f"mix__{n} bigint, mix__{n}__v_double double" for n in _PAIRED)
    + ", "
    + ", ".join(f"mix__{n} double" for n in _SINGLE)
    + ", estimation_method string, _load_id string",
    "weather": "datetime timestamp_ntz, temperature_2m double, relative_humidity_2m double, precipitation double, "
    "wind_speed_10m double, cloud_cover double, shortwave_radiation double, _load_id string",
    "public_holidays": "date string, local_name string, name string, country_code string, is_global boolean, "
    "_row_id string, _load_id string",
    "public_holidays__types": "_parent_id string, value string",
}

MERGE_KEYS = {
    "electricity_prices": "timestamp_utc",
    "gas_prices": "timestamp_utc",
    "carbon_intensity": "datetime",
    "renewable_percentage": "datetime",
    "carbon_free_percentage": "datetime",
    "total_load": "datetime",
    "day_ahead_price": "datetime",
    "electricity_mix": "datetime",
    "weather": "datetime",
    "public_holidays": "date",
}


def raw_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(RAW_SCHEMAS[name])


def read_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan of a raw table with its declared schema."""
    return spark.read.schema(raw_schema(name)).parquet(f"{root}/{name}")


def with_load_id(df: DataFrame, load_id: str) -> DataFrame:
    return df.withColumn("_load_id", F.lit(load_id))


def layer_path(root: str, env: str, layer: str, name: str) -> str:
    """``prod`` tables sit under the layer name, others under ``<env>_<layer>``."""
    return f"{root}/{layer if env == 'prod' else f'{env}_{layer}'}/{name}"


def write_table(
    df: DataFrame,
    root: str,
    env: str,
    layer: str,
    name: str,
    partition_by: str | None = None,
    replaces: Callable[[str], bool] | None = None,
) -> DataFrame:
    """Store a table of a layer and return a scan of it. A table with partitions is replaced as a whole, or
    in the partitions that ``replaces`` chooses by their value; either way one that ``df`` has no
    rows for is gone, and readers see the old table or the new one."""
    path = layer_path(root, env, layer, name)
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    known = current_map(df.sparkSession, path)
    table = commit(df.sparkSession, path, df, partition_by, known, replaces or (lambda value: True))
    return read_parts(df.sparkSession, path, table).select(*df.columns)


def register_view(df: DataFrame, env: str, layer: str, name: str) -> DataFrame:
    df.createOrReplaceTempView(f"{layer}_{name}" if env == "prod" else f"{env}_{layer}_{name}")
    return df


def load_order(df: DataFrame) -> list[Column]:
    """Which of two rows of one load wins: the later load, then the larger row."""
    rest = [c for c in df.columns if c != "_load_id"]
    first = [F.col("_load_id").desc()] if "_load_id" in df.columns else []
    return [*first, *[F.col(c).desc() for c in rest]]


def merge_rows(target: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace the target's rows whose key is in ``fresh`` and add the new ones.
    ``fresh`` holds one row per key."""
    kept = target.join(fresh.select(*keys), list(keys), "left_anti")
    return kept.unionByName(fresh)


def table_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns that any batch so far has brought, or None for a new table. Files of
    older partitions may lack the later ones."""
    known = current_map(spark, path)
    return known.schema if known else None


def read_table(spark: SparkSession, path: str, keep: Callable[[str], bool] | None = None) -> DataFrame:
    """Scan of a merged table as its newest map has it, whatever is merged while the scan is used; empty
    if all its batches were. ``keep`` chooses partitions by their value: those of a trailing window, say,
    so the folders of all other years are not even listed."""
    known = current_map(spark, path)
    if known is None:
        raise ValueError(f"{path} is not a merged table")
    return read_parts(spark, path, known, keep)


def _known(column: str, path: str) -> Column:
    """The column, refusing NULL."""
    problem = F.raise_error(F.lit(f"{column} is NULL in a batch for {path}"))
    return F.when(F.col(column).isNull(), problem).otherwise(F.col(column)).alias(column)


def _changed(old: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The fresh rows that are new or differ from the table's in more than the load that brought them."""
    rest = [F.col(c) for c in fresh.columns if c not in (*keys, "_load_id")]
    known = old.select(*keys, F.struct(F.lit(True).alias("there"), *rest).alias("_old"))
    both = fresh.join(known, list(keys), "left")
    return both.where(~F.struct(F.lit(True).alias("there"), *rest).eqNullSafe(F.col("_old"))).drop("_old")


def upsert(
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition: str,
    days: Column | None = None,
    attempts: int = 3,
) -> None:
    """Keyed merge into a Parquet table partitioned by a function of the key.

    Only the partitions that the batch touches are read, and written anew beside the old ones;
    the merge counts from the moment its map is published (see :mod:`uurwerk.sources.versions`).
    Readers see the table before or after it; a merge that is cut off has changed nothing.
    A merge that another writer has overtaken starts again from the newer table.

    NULL keys and partitions are refused. The batch must have all columns of the table; new ones
    may be added. A type may be wider or narrower than the table's (whole numbers, floats): the wider
    one becomes the table's; other changes of type are refused before anything is written. An
    empty batch only notes its columns. ``days`` is an array of dates that a row bears on: the map then
    lists those of all rows that are new or other than before, once each.
    """
    for attempt in range(attempts):
        try:
            return _merge(path, batch, keys, partition, days)
        except Conflict:
            if attempt + 1 == attempts:
                raise


def _merge(path: str, batch: DataFrame, keys: Sequence[str], partition: str, days: Column | None) -> None:
    spark = batch.sparkSession
    known = current_map(spark, path)
    schema = unified(known.schema if known else None, batch.schema, partition)
    guarded = [
        (_known(c, path) if c in (*keys, partition) else F.col(c)).cast(schema[c].dataType).alias(c) for c in batch.columns
    ]
    rows = dedup_latest(batch.select(*guarded), keys, load_order(batch))
    if known is None and days is None:
        # A new table has nothing to be merged with: one write.
        commit(spark, path, rows, partition, None, schema=schema)
        return
    with run_folder(spark) as folder:
        fresh = materialize(rows, "batch", folder=folder)
        values = {r[0] for r in fresh.select(F.col(partition).cast("string")).distinct().collect()}
        if not values:
            if known is None or known.schema != schema:
                note_schema(spark, path, schema, partition, known)
            return
        base = TableMap(0, schema, partition, known.parts if known else {})
        old = read_parts(spark, path, base, values.__contains__).select(*fresh.columns)
        touched = None
        if days is not None:
            named = _changed(old, fresh, keys).select(F.explode(days.cast("array<string>")).alias("day")).distinct()
            touched = sorted(r.day for r in named.collect() if r.day is not None)
        merged = merge_rows(old, fresh, keys) if values & base.parts.keys() else fresh
        commit(spark, path, merged, partition, known, lambda value: value in values, schema, touched)


def backfill_by_year(
    spark: SparkSession,
    path: str,
    start: dt.date,
    end: dt.date,
    extract: Callable[[dt.date, dt.date], DataFrame],
    keys: Sequence[str],
    day: str,
) -> list[int]:
    """Load a long range one calendar year at a time, each merged by key.

    Each year is committed before the next one starts, so an interruption loses
    at most the year in progress, and running a year or a part of it again changes
    only the keys that come again. The loop is over years only.
    """
    request = spark.sql(f"SELECT DATE'{start}' AS s, DATE'{end}' AS e")
    done = []
    for chunk in year_chunks(request, "s", "e").orderBy("chunk_year").collect():
        rows = extract(chunk["chunk_start"], chunk["chunk_end"])
        upsert(path, rows.withColumn("year", F.year(day)), keys, "year")
        done.append(chunk["chunk_year"])
    return done
