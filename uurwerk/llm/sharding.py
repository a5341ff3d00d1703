"""Sharding by a k-d tree over metadata.

Every level splits each node at the exact weighted median of its widest
dimension, until the leaves reach the target bytes. Bytes are what is weighed, so
shards differ by less than about one largest document. A level is two shuffles of
narrow rows (id, size, checksum, dimensions); no node is gathered in a task.

Rows that tie in a dimension are ordered by the text's checksum and the id, so
equal texts lie together and a group is cut only where a median falls inside it.

Edge cases: a null text has no bytes and checksum 0; null dimension values are the
smallest; tied and repeated rows are split like any others; an empty table gives an
empty result. Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uurwerk.llm.common import positions, sheltered, taken
from uurwerk.session import materialize

# The table of nodes of one level is broadcast up to this many rows.
MAX_BROADCAST_NODES = 65_536


def text_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of the text plus one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def text_crc(text: str = "text") -> Column:
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def levels_for(total: int, target: int) -> int:
    """Halvings until a leaf holds at most ``target`` bytes."""
    return max(0, math.ceil(math.log2(total / target) - 1e-9)) if total > 0 else 0


def document_dimensions(size: str = "size", crc: str = "text_crc32", lang: str = "lang") -> dict[str, Column]:
    """Dimensions in which equal texts are one point: length on a log scale,
    language and checksum."""
    language = F.when(F.col(lang).isNotNull(), F.crc32(F.col(lang).cast("binary"))).otherwise(F.lit(-1))
    return {
        "length": (F.log2(F.col(size)) * 1e9).cast("long"),
        "language": language.cast("long"),
        "checksum": F.col(crc).cast("long"),
    }


def kd_shards(
    rows: DataFrame,
    dimensions: list[str],
    size: str,
    ties: list[str],
    target_bytes: int | None = None,
    levels: int | None = None,
    within: list[str] | None = None,
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 within the shard).

    ``dimensions`` are long columns, ``ties`` order the rows equal in one. Give the
    bytes a leaf should hold at most or the number of levels. Slots follow the columns
    ``within``, then ``ties``.
    """
    reach = [f(d).alias(f"{n}_{d}") for d in dimensions for n, f in (("lo", F.min), ("hi", F.max))]
    if levels is None:
        levels = levels_for(rows.agg(F.sum(size)).first()[0] or 0, target_bytes)
    columns = rows.columns
    current = materialize(rows.withColumn("_node", F.lit(0).cast("long")), "level")
    whole = current.agg(*reach).first()
    for level in range(levels):
        spans = current.groupBy("_node").agg(*reach)
        widths = [
            (F.col(f"hi_{d}") - F.col(f"lo_{d}")) / F.lit(float(max((whole[f"hi_{d}"] or 0) - (whole[f"lo_{d}"] or 0), 1)))
            for d in dimensions
        ]
        widest = F.array_position(F.array(*widths), F.array_max(F.array(*widths))).cast("int")
        nodes = spans.select("_node", widest.alias("_axis"))
        if 2**level <= MAX_BROADCAST_NODES:
            nodes = F.broadcast(nodes)
        keyed = current.join(nodes, "_node").withColumn(
            "_key", F.element_at(F.array(*[F.col(d) for d in dimensions]), F.col("_axis"))
        )
        keyed = keyed.drop("_axis")
        placed = positions(keyed, ["_node"], ["_key", *ties], size, "median")
        right = 2 * F.col("before_weight") + F.col(size) >= F.col("group_weight")
        current = materialize(
            placed.select(*columns, (2 * F.col("_node") + right.cast("long")).alias("_node")), "level"
        )
    return positions(current, ["_node"], [*(within or []), *ties], size, "slots").select(
        *columns, F.col("_node").cast("int").alias("shard"), F.col("before_rows").alias("slot")
    )


def shard_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The narrow rows that are sharded: id, size, checksum and dimensions."""
    narrow = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        text_bytes(f"`{text}`").alias("size"),
        text_crc(f"`{text}`").alias("text_crc32"),
        F.col(f"`{lang}`").alias("lang"),
    )
    return narrow.select("doc_id", "size", "text_crc32", *[c.alias(n) for n, c in document_dimensions().items()])


DIMENSIONS = ["length", "language", "checksum"]
TIES = ["text_crc32", "doc_id"]


def assign_shards(
    docs: DataFrame, levels: int | None = None, target_bytes: int | None = None, order: DataFrame | None = None, **names
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document. ``order`` has a row for
    each id and checksum; slots follow its other columns, or else checksum and id."""
    rows, within = shard_keys(docs, **names), []
    if order is not None:
        within = [f"_at_{c}" for c in order.columns if c not in ("doc_id", "text_crc32")]
        places = order.select(
            F.col("doc_id").alias("_id"), F.col("text_crc32").alias("_crc"), *[F.col(c[4:]).alias(c) for c in within]
        )
        meet = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_crc32") == F.col("_crc"))
        rows = rows.join(places, meet, "left").drop("_id", "_crc")
    placed = kd_shards(rows, DIMENSIONS, "size", TIES, target_bytes, levels, within)
    return placed.select("doc_id", "size", "text_crc32", "shard", "slot")


def shard_documents(
    docs: DataFrame,
    levels: int | None = None,
    target_bytes: int | None = None,
    into: tuple[str, str] = ("shard", "slot"),
    order: DataFrame | None = None,
) -> DataFrame:
    """``docs`` with their shard and slot, see ``assign_shards``. Rows meet their places by id and
    checksum; the copies of a row that occurs several times take their places in
    turn. Raises if a name in ``into`` is taken."""
    taken(docs, *into)
    docs, back = sheltered(docs, "doc_id", "text", "lang")
    places = assign_shards(docs, levels, target_bytes, order).select(
        F.col("doc_id").alias("_id"), F.col("text_crc32").alias("_crc"), "shard", "slot"
    )
    same = Window.partitionBy("_id", "_crc")
    left = docs.withColumns({"_id": F.col("doc_id"), "_crc": text_crc()})
    left = left.withColumn("_nth", F.row_number().over(same.orderBy(F.lit(1)))).alias("d")
    right = places.withColumn("_nth", F.row_number().over(same.orderBy("shard", "slot"))).alias("p")
    meet = (
        F.col("d._id").eqNullSafe(F.col("p._id"))
        & (F.col("d._crc") == F.col("p._crc"))
        & (F.col("d._nth") == F.col("p._nth"))
    )
    met = left.join(right, meet).select(
        *[F.col(f"d.{c}") for c in docs.columns], F.col("p.shard").alias("_shard"), F.col("p.slot").alias("_slot")
    )
    return back(met, F.col("_shard").alias(into[0]), F.col("_slot").alias(into[1]))
