"""Holidays with their list of types folded onto one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold_values(children: DataFrame, parent: str, value: str, flag_value: str, separator: str = ", ") -> DataFrame:
    """Per parent: whether ``flag_value`` occurs, and all values in order, joined.

    Equal values of a parent are counted before they meet in one task, so a
    parent with very many rows brings only its distinct values; the text then
    repeats each value as often as it occurred.
    """
    counted = children.where(F.col(value).isNotNull()).groupBy(parent, value).agg(F.count(F.lit(1)).alias("_n"))
    repeated = counted.withColumn(
        "_text", F.array_join(F.array_repeat(F.col(value), F.col("_n").cast("int")), separator)
    )
    in_order = F.array_sort(F.collect_list(F.struct(F.col(value), F.col("_text"))))
    return repeated.groupBy(parent).agg(
        F.bool_or(F.col(value) == flag_value).alias("has_flag"),
        F.array_join(F.transform(in_order, lambda s: s["_text"]), separator).alias("value_list"),
    )


def fold_holidays(holidays: DataFrame, types: DataFrame, public: str = "Public") -> DataFrame:
    """One row per holiday with ``is_public_holiday`` and the ordered type list.

    A holiday without types is not public and has a NULL list.
    """
    folded = fold_values(types, "_parent_id", "value", public)
    return holidays.join(folded, holidays["_row_id"] == folded["_parent_id"], "left").select(
        F.col("date").cast("date").alias("holiday_date"),
        F.col("local_name").alias("holiday_name_local"),
        F.col("name").alias("holiday_name"),
        "country_code",
        "is_global",
        F.coalesce(F.col("has_flag"), F.lit(False)).alias("is_public_holiday"),
        F.col("value_list").alias("holiday_types"),
        "_load_id",
    )
