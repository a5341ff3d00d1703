"""Validity intervals: building them and joining points to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uurwerk.functions.clock import day_at

# Nodes of the tree of seconds have 1 << TREE_BITS below them.
TREE_BITS = 6


def day_intervals(df: DataFrame, day: str, tz: str, boundary_hour: int = 6) -> DataFrame:
    """Add ``[valid_from_utc, valid_to_utc)``: ``boundary_hour`` local on ``day``
    to the same clock time on the next day."""
    return df.withColumns(
        {
            "valid_from_utc": day_at(F.col(day), boundary_hour, tz),
            "valid_to_utc": day_at(F.date_add(day, 1), boundary_hour, tz),
        }
    )


def _second(ts: Column) -> Column:
    """Whole seconds since 1970 on the clock of the timestamp itself."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def node_runs(df: DataFrame, low: str, high: str, bits: int = 1) -> DataFrame:
    """Cut each range ``[low, high)`` of whole numbers into the fewest nodes of a tree over all of them, each node
    with ``1 << bits`` below it: one row per run of nodes of one parent, as ``_level`` and ``[_from, _upto)`` (node i of
    level k holds the numbers from ``i << bits * k`` on, ``1 << bits * k`` of them). A range of n numbers
    has at most two runs on each of about log2(n) / bits levels. Empty ranges have none.

    On level k the range still to be covered runs from the first to the last whole node of that
    level; what sticks out of the whole nodes of the next level is runs of this one.
    """
    size = F.greatest(F.col(high) - F.col(low), F.lit(1))
    levels = df.where(F.col(low) < F.col(high)).withColumn(
        "_level", F.explode(F.sequence(F.lit(0), F.floor(F.log2(size.cast("double")) / bits + 1).cast("int")))
    )
    ends = levels.withColumns(
        {"_first": F.expr(f"-shiftright(-`{low}`, _level * {bits})"), "_last": F.expr(f"shiftright(`{high}`, _level * {bits})")}
    ).where("_first < _last")
    # Where the whole parents start and end. If they end before they start, all is in one parent.
    whole = F.expr(f"shiftleft(-shiftright(-_first, {bits}), {bits})")
    end = F.expr(f"shiftleft(shiftright(_last, {bits}), {bits})")
    runs = F.array(
        F.struct(F.col("_first").alias("_from"), F.when(whole <= end, whole).otherwise(F.col("_last")).alias("_upto")),
        F.struct(F.when(whole <= end, end).otherwise(F.col("_last")).alias("_from"), F.col("_last").alias("_upto")),
    )
    return ends.select(*df.columns, "_level", F.inline(runs)).where("_from < _upto")


def dyadic_nodes(df: DataFrame, low: str, high: str) -> DataFrame:
    """:func:`node_runs` of a binary tree, where a run is one node, ``_index``: a range of n numbers has
    at most two on each of log2(n) levels."""
    return node_runs(df, low, high).withColumnRenamed("_from", "_index").drop("_upto")


def interval_attach(
    points: DataFrame, intervals: DataFrame, ts: str, valid_from: str, valid_to: str, by: Sequence[str] = ()
) -> DataFrame:
    """Left join of points to the intervals that contain them, as an equi join, whatever the intervals' lengths.

    Every interval is cut into runs of nodes of a tree over the seconds between the first and the last
    point, at most two on each level, also if it has no end in sight; a point asks once on each
    level that any interval has, with the parent of the node above its own second. So a point
    meets an interval once, and besides those that contain it only those that start or end in
    a parent of its own: there is no bucket width to choose, and no interval of another length
    crowds a point's cell. Only distinct moments ask, and points without an interval stay as they are.
    """
    keys = [f"_by{k}" for k in range(len(by))]
    renamed = [F.col(f"`{c}`").alias(k) for c, k in zip(by, keys)]
    last = F.col(f"`{valid_to}`") - F.expr("INTERVAL '0.000001' SECOND")
    # Queries of one value inside the plan, so nothing runs before the join does.
    moments = points.select(F.col(f"`{ts}`").alias("_ts"))
    first = moments.agg(_second(F.min("_ts"))).scalar()
    # The tree's top covers all points: an interval that starts before them or ends after them sticks out nowhere.
    seconds = moments.agg((_second(F.max("_ts")) - _second(F.min("_ts")) + 1).alias("n"))
    height = F.ceil(F.log2(F.col("n").cast("double")) / TREE_BITS).cast("int") + 1
    top = seconds.select(F.call_function("shiftleft", F.lit(1).cast("bigint"), height * TREE_BITS)).scalar()
    ranged = intervals.where(F.col(f"`{valid_from}`") < F.col(f"`{valid_to}`")).select(
        *renamed,
        F.struct(*[F.col(f"`{c}`") for c in intervals.columns if c not in by]).alias("_interval"),
        F.greatest(_second(F.col(f"`{valid_from}`")) - first, F.lit(0)).alias("_low"),
        F.least(_second(last) + 1 - first, top).alias("_high"),
    )
    nodes = node_runs(ranged, "_low", "_high", TREE_BITS).drop("_low", "_high")
    nodes = nodes.withColumn("_parent", F.expr(f"shiftright(_from, {TREE_BITS})"))
    levels = nodes.agg(F.array_sort(F.collect_set("_level")).alias("levels")).scalar()
    moment = F.col(f"`{ts}`").alias("_ts")
    asked = points.select(*renamed, moment).where("_ts IS NOT NULL").distinct()
    asked = asked.withColumn("_level", F.explode(levels))
    node = F.call_function("shiftright", _second(F.col("_ts")) - first, F.col("_level") * TREE_BITS)
    asked = asked.withColumn("_parent", F.shiftright(node, TREE_BITS))
    found = asked.join(nodes, [*keys, "_level", "_parent"]).where(
        (node >= F.col("_from"))
        & (node < F.col("_upto"))
        & (F.col("_ts") >= F.col(f"_interval.`{valid_from}`"))
        & (F.col("_ts") < F.col(f"_interval.`{valid_to}`"))
    )
    found = found.select(*[F.col(k) for k in keys], "_ts", "_interval")
    on = F.col(f"p.`{ts}`") == F.col("_ts")
    for c, k in zip(by, keys):
        on = on & (F.col(f"p.`{c}`") == F.col(k))
    return points.alias("p").join(found, on, "left").select(
        *[F.col(f"p.`{c}`") for c in points.columns],
        *[F.col(f"_interval.`{c}`").alias(c) for c in intervals.columns if c not in by],
    )
