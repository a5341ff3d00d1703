"""Helpers shared by the operators: splits, distributed prefix sums, units of
sorted rows, and connected components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from uurwerk.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for rows kept out of training: crc32 of the id as text is divisible
    by five. A null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sheltered(docs: DataFrame, *needed: str):
    """``docs`` with all columns but the ``needed`` ones under names of their own, so that no column of the caller's
    meets one of an operator's, and a function that gives a result its names back (columns that
    the operator added stand behind them). Names that differ in case alone are told apart."""
    inner = [c if c in needed else f"_kept{k}" for k, c in enumerate(docs.columns)]

    def back(df: DataFrame, *added: str) -> DataFrame:
        return df.select(*[F.col(n).alias(c) for n, c in zip(inner, docs.columns)], *added)

    return docs.toDF(*inner), back


def taken(docs: DataFrame, *names: str) -> None:
    """Raise if ``docs`` has a column of one of these names, in any case of its letters."""
    if clash := {c for c in docs.columns if c.lower() in {n.lower() for n in names}}:
        raise ValueError(f"{sorted(clash)} are already columns")


def positions(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], weight: str, name: str = "ordered"
) -> DataFrame:
    """Add ``before_rows``, ``before_weight`` and the group's ``group_rows`` and
    ``group_weight``: what stands before each row within its group in the given
    order.

    A prefix sum in three steps that never gathers a group: rows are dealt by
    ranges of (groups, order), each range is summed, and a row adds the sum of
    the ranges before its own to its place inside its range. The ranges are
    written first, so every later step sees the same ones. The sums of ranges are
    one row per range and group in it. Groups and weights must not be null;
    ``order`` should end in columns that tell rows apart, as rows equal in all of
    them are in one range.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in [*groups, *order]]
    dealt = materialize(
        df.repartitionByRange(width, *keys).withColumn("_range", F.spark_partition_id()), name
    )
    sums = dealt.groupBy("_range", *groups).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(weight).cast("long").alias("_w")
    )
    earlier = Window.partitionBy(*groups).orderBy("_range")
    whole = Window.partitionBy(*groups)
    offsets = sums.select(
        "_range",
        *groups,
        (F.sum("_n").over(earlier) - F.col("_n")).alias("_rows"),
        (F.sum("_w").over(earlier) - F.col("_w")).alias("_weight"),
        F.sum("_n").over(whole).alias("group_rows"),
        F.sum("_w").over(whole).alias("group_weight"),
    )
    inside = Window.partitionBy("_range", *groups).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumns(
        {
            "_i": F.row_number().over(inside).cast("long") - 1,
            "_s": F.sum(weight).over(upto).cast("long") - F.col(weight),
        }
    )
    return placed.join(offsets, ["_range", *groups]).select(
        *df.columns,
        (F.col("_i") + F.col("_rows")).alias("before_rows"),
        (F.col("_s") + F.col("_weight")).alias("before_weight"),
        "group_rows",
        "group_weight",
    )


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """The groups of a stream of batches sorted by ``key``; a group may span batches."""
    held: list[pa.Table] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        keys = part.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for start, end in zip([0, *cuts], [*cuts, len(keys)]):
            start, end = int(start), int(end)
            if held and keys[start] != current:
                yield current, pa.concat_tables(held)
                held = []
            current = keys[start]
            held.append(part.slice(start, end - start))
    if held:
        yield current, pa.concat_tables(held)


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node that the links connect it with."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        np.minimum.at(root, before[left], low)
        np.minimum.at(root, before[right], low)
        root = root[root]
        if np.array_equal(before, root):
            break
    return root


def tiled(df: DataFrame, cell: Sequence[str], counts: DataFrame, tile_rows: int, tie: str) -> DataFrame:
    """Cut crowded cells into tiles of about ``tile_rows`` rows and send every row
    to each unit ``(cell, low tile, high tile)`` that holds its tile, so that two
    rows of a cell meet in exactly one unit and no unit exceeds two tiles.

    ``counts`` holds the rows of each cell as ``n``; only crowded cells are joined.
    """
    crowded = counts.where(F.col("n") > tile_rows).select(
        *cell, F.ceil(F.col("n") / tile_rows).cast("int").alias("_tiles")
    )
    tile = F.pmod(F.xxhash64(tie), F.col("_tiles")).cast("int")
    return (
        df.join(crowded, list(cell), "left")
        .withColumn("_tiles", F.coalesce("_tiles", F.lit(1)))
        .withColumn("_tile", tile)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
        .withColumns({"_low": F.least("_tile", "_other"), "_high": F.greatest("_tile", "_other")})
        .drop("_tiles", "_other")
    )


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, root)``, root being the
    component's smallest node; nodes without a link are left out.

    Alternating large-star and small-star rounds: each node hands its larger,
    then its smaller neighbours to the smallest one. Every round is two grouped
    minima and two joins and is written to the shared folder; the rounds grow with
    the logarithm of the longest chain. Raises if they don't settle.
    """
    current = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    seen = current.select(mark.alias("m")).first().m
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = current.union(current.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(floor, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        current = materialize(small, "links")
        now = current.select(mark.alias("m")).first().m
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select("v", "v").distinct()
    )
