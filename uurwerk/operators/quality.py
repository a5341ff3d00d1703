"""Data tests. Each returns the violating rows; an empty result is a pass.

NULL passes the tests of one column but ``not_null``; ``unique_combination`` reports
repeated keys with NULLs like any other. Tests on keys aggregate before the
shuffle and report each bad key once with its row count, so a key that repeats
very often costs one row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def outside_range(column: Column, minimum=None, maximum=None) -> Column:
    """True for a value below ``minimum`` or above ``maximum``; both inclusive."""
    bad = F.lit(False)
    if minimum is not None:
        bad = bad | (column < F.lit(minimum))
    if maximum is not None:
        bad = bad | (column > F.lit(maximum))
    return bad


def unique(df: DataFrame, column: str) -> DataFrame:
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_range(df: DataFrame, column: str, minimum=None, maximum=None) -> DataFrame:
    return df.where(outside_range(F.col(column), minimum, maximum))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return (
        df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows that hold them."""
    keys = (
        child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    )
    return keys.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def expression_is_true(df: DataFrame, expression: str | Column) -> DataFrame:
    condition = F.expr(expression) if isinstance(expression, str) else expression
    return df.where(~condition)


def freshness(
    df: DataFrame, ts: str, as_of: dt.datetime, warn_days: int = 2, error_days: int = 7, by: Sequence[str] = ()
) -> DataFrame:
    """Age of the newest row (per ``by``) against an injected clock."""
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    newest = F.col("max_loaded_at")

    def older(days: int) -> Column:
        return newest < now - F.expr(f"INTERVAL '{days}' DAY")

    return (
        df.groupBy(*by)
        .agg(F.max(ts).alias("max_loaded_at"))
        .withColumn(
            "status",
            F.when(newest.isNull() | older(error_days), F.lit("error"))
            .when(older(warn_days), F.lit("warn"))
            .otherwise(F.lit("pass")),
        )
    )
