"""Payload shapes → rows: flat records, nested objects, parallel arrays, lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uurwerk.functions.clock import parse_utc


def required(column: Column, name: str) -> Column:
    """The column itself; a NULL stops the job."""
    return F.coalesce(column, F.raise_error(F.lit(f"required key {name} is missing")).cast("string"))


def flat_schema(value_field: str, value_type: T.DataType = T.DoubleType()) -> T.StructType:
    record = T.StructType(
        [
            T.StructField("datetime", T.StringType()),
            T.StructField(value_field, value_type),
            T.StructField("isEstimated", T.BooleanType()),
            T.StructField("createdAt", T.StringType()),
            T.StructField("updatedAt", T.StringType()),
        ]
    )
    return T.StructType([T.StructField("data", T.ArrayType(record))])


def flat_records(payloads: DataFrame, value_field: str, payload: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """``{"data": [{"datetime", value_field, ...}]}`` → one row per record.

    ``datetime`` is required; other absent fields become NULL. Malformed JSON
    stops the job instead of turning into an empty load.
    """
    parsed = F.from_json(F.col(payload), flat_schema(value_field), {"mode": "FAILFAST"})
    rows = payloads.select(*keep, F.explode(parsed["data"]).alias("r"))
    return rows.select(
        *keep,
        parse_utc(required(F.col("r.datetime"), "datetime")).alias("datetime"),
        F.col(f"r.{value_field}").alias("value"),
        F.col("r.isEstimated").alias("is_estimated"),
        parse_utc(F.col("r.createdAt")).alias("created_at"),
        parse_utc(F.col("r.updatedAt")).alias("updated_at"),
    )


def flatten_struct(df: DataFrame, column: str, separator: str = "__") -> DataFrame:
    """Replace a nested object by one column per leaf, named by its path."""

    def leaves(path: list[str], dtype: T.DataType):
        if isinstance(dtype, T.StructType):
            for field in dtype.fields:
                yield from leaves([*path, field.name], field.dataType)
        else:
            yield F.col(".".join(f"`{p}`" for p in path)).alias(separator.join(path))

    others = [c for c in df.columns if c != column]
    return df.select(*others, *leaves([column], df.schema[column].dataType))


def arrays_to_rows(df: DataFrame, time: str, measures: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Parallel arrays → one row per index of ``time``.

    A measure array that is missing or shorter than ``time`` stops the job. Rows
    whose measures are all NULL are hours not yet published and are dropped;
    partly NULL rows stay.
    """
    n = F.size(time)
    aligned = [
        F.when(F.size(m) >= n, F.slice(F.col(m), F.lit(1), n))
        .otherwise(F.raise_error(F.lit(f"array {m} is missing or shorter than {time}")))
        .alias(m)
        for m in measures
    ]
    return (
        df.select(*keep, F.col(time), *aligned)
        .select(*keep, F.explode(F.arrays_zip(F.col(time), *[F.col(m) for m in measures])).alias("r"))
        .select(*keep, *[F.col(f"r.{c}").alias(c) for c in [time, *measures]])
        .dropna(how="all", subset=list(measures))
    )


def row_id(keys: Sequence[str]) -> Column:
    """Stable id of a natural key. 128 bits, so that ids stay distinct at any size."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in keys]
    return F.md5(F.concat_ws("\u001f", *parts))


def split_list(df: DataFrame, keys: Sequence[str], column: str) -> tuple[DataFrame, DataFrame]:
    """Parent rows with ``_row_id``, and a child table with one row per list item
    that points back to its parent."""
    with_id = df.withColumn("_row_id", row_id(keys))
    child = with_id.select(
        F.col("_row_id").alias("_parent_id"), F.posexplode(column).alias("_position", "value")
    )
    return with_id.drop(column), child
