"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of equal bytes. Of ``period`` slots a source with
integer weight w gets w: its block j is released at floor(j * period / w) and due
at ceil((j + 1) * period / w), and the slots are dealt earliest deadline first among
the released blocks. At every slot each source then stands less than one block
from its share. A period ends with every source exactly at its share, so the
schedule of one period serves all of them, and a block's slot follows from its
number alone: no row waits for another.

The period is chosen so that the smallest weight is ``LEAST_WEIGHT`` or more, or the
blocks of the smallest source if it has fewer. A short schedule is dealt slot by slot in
one expression; a long one, of any number of sources and slots, is halved by priority until its
pieces are small, see ``_halved``. Both give every block the same slot.

When a source runs out, the others keep their proportions to each other: periods
fall into at most two kinds for each source, and each kind has its own schedule.
All rows are kept.

Edge cases: a null source is a source of its own; a source without weight gets
weight 1; null texts count one byte, empty ones too; a document longer than a
block takes the slots of the blocks it spans; tied and repeated rows are placed one
after another; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uurwerk.llm.common import positions, runs, sheltered
from uurwerk.llm.sharding import text_bytes, text_crc
from uurwerk.session import materialize

# Every source takes part in every step of ``edf_schedule``: more sources, slots of a
# period or steps of all schedules than these are dealt in pieces, to the same slots.
MAX_SOURCES = 1024
MAX_SLOTS = 4096
# A hundred thousand steps take some 40 seconds.
MAX_STEPS = 100_000
# Rounding moves a weight of this size or more by a thirty-second at most.
LEAST_WEIGHT = 16
# Slots that one task deals at once.
PIECE = 1 << 16
# Rows of all schedules that are broadcast at most.
MAX_BROADCAST_SLOTS = 1_000_000
PERIOD = 256
BLOCK_BYTES = 1 << 16


def edf_schedule(active: Column) -> Column:
    """The sources (by place in the array, from 0) of the slots of one period.

    ``active`` is an array of each source's blocks in the period. Slots are dealt
    one by one: of the released blocks the one with the earliest deadline, ties to
    the first source. Arithmetic is in whole numbers.
    """
    length = F.aggregate(active, F.lit(0).cast("long"), lambda a, n: a + n)
    steps = F.when(length > 0, F.sequence(F.lit(0).cast("long"), length - 1)).otherwise(F.array().cast("array<bigint>"))
    start = F.struct(
        F.transform(active, lambda n: F.lit(0).cast("long")).alias("given"),
        F.array().cast("array<int>").alias("slots"),
    )

    def deal(state, t):
        urgency = F.transform(
            active,
            lambda n, i: F.when(
                (F.get(state["given"], i) < n) & (F.floor(F.get(state["given"], i) * length / F.greatest(n, F.lit(1))) <= t),
                F.struct(
                    F.ceil((F.get(state["given"], i) + 1) * length / F.greatest(n, F.lit(1))).alias("due"),
                    i.cast("int").alias("source"),
                ),
            ),
        )
        chosen = F.array_min(urgency)["source"]
        return F.struct(
            F.transform(state["given"], lambda g, i: g + (i == chosen).cast("long")).alias("given"),
            F.concat(state["slots"], F.array(chosen)).alias("slots"),
        )

    return F.aggregate(steps, start, deal, lambda s: s["slots"])


def tempered_weights(
    totals: DataFrame, period: int = PERIOD, temperature: float = 0.5, least: int = LEAST_WEIGHT
) -> DataFrame:
    """Integer weights in proportion to bytes ** temperature, ``least`` at least,
    whose sum is about ``period`` or, for small sources, as much more as that takes.
    ``totals`` has a row for each source."""
    tempered = F.pow("bytes", F.lit(temperature))
    # Summed in whole numbers, so that the order of the rows does not matter.
    scale, smallest = totals.agg(F.sum(F.round(tempered * 1024).cast("decimal(38,0)")), F.min(tempered)).first()
    scale = float(scale or 1024) / 1024
    period = max(period, math.ceil(least * scale / smallest)) if smallest else period
    share = F.pow("bytes", F.lit(temperature)) / F.lit(float(scale))
    return totals.select("source", F.greatest(F.lit(1), F.round(share * period)).cast("long").alias("weight"))


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    source: str = "source",
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    period: int = PERIOD,
) -> DataFrame:
    """doc_id, text_crc32, source, size, block, slot and place of every document.

    ``weights(source, weight)`` gives whole-number targets, by default the square
    roots of the sources' bytes, rounded to a period of ``period`` slots or more. Documents of a source are taken in the order of a
    hash of their id. ``slot`` is the schedule's slot of the document's block over all
    sources, ``place`` the position inside its source; (slot, place) orders the mix.
    """
    spark = docs.sparkSession
    docs, _ = sheltered(docs, doc_id, source, text)
    narrow = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("null")).alias("_key"),
        text_bytes(f"`{text}`").alias("size"),
        text_crc(f"`{text}`").alias("text_crc32"),
    ).withColumn("_shuffled", F.xxhash64("doc_id"))
    placed = positions(narrow, ["_key"], ["_shuffled", "doc_id", "text_crc32"], "size", "sources").withColumn(
        "block", F.floor(F.col("before_weight") / block_bytes)
    )
    placed = materialize(
        placed.select(
            "doc_id",
            "source",
            "_key",
            "size",
            "text_crc32",
            "block",
            F.col("before_rows").alias("place"),
            F.col("before_weight").alias("_before"),
            F.col("group_weight").alias("_bytes"),
        ),
        "blocks",
    )
    sources = placed.groupBy("_key").agg(
        F.first("source").alias("source"), F.max("_bytes").alias("bytes"), (F.max("block") + 1).alias("_blocks")
    )
    totals = materialize(sources, "mix_sources")
    smallest = totals.agg(F.min("_blocks")).first()[0]
    if smallest is None:
        return placed.select("doc_id", "text_crc32", "source", "size", "block", F.lit(0).cast("long").alias("slot"), "place")
    # No finer than the smallest source's blocks, else the last period would be the only one.
    given = tempered_weights(totals, period, least=min(LEAST_WEIGHT, smallest)) if weights is None else weights
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    given = given.groupBy(key.alias("_key")).agg(F.max(F.col("weight").cast("long")).alias("_weight"))
    targets = totals.join(given, "_key", "left").select(
        "_key", "_blocks", F.greatest(F.lit(1), F.coalesce("_weight", F.lit(1))).cast("long").alias("_weight")
    )
    targets = materialize(targets, "mix_targets")
    # At most MAX_SOURCES rows from here on: the sources in a fixed order. Their names stay in
    # Spark, as those that are not UTF-8 would be others when they come back from Python.
    in_order = Window.orderBy("_key")
    sources = targets.limit(MAX_SOURCES + 1).withColumn("_index", F.row_number().over(in_order) - 1)
    supply = sorted(tuple(r) for r in sources.select("_index", "_blocks", "_weight").collect())
    slots = sum(w for _, _, w in supply)
    if len(supply) > MAX_SOURCES or slots > MAX_SLOTS or slots * len(supply) * len(_kinds(supply)) > MAX_STEPS:
        return _in_pieces(placed, targets)
    schedules = _schedules(spark, supply)
    if slots * len(_kinds(supply)) <= MAX_BROADCAST_SLOTS:
        schedules = F.broadcast(schedules)
    keyed = placed.join(F.broadcast(sources.drop("_blocks")), "_key").withColumns(
        {"_round": F.floor(F.col("block") / F.col("_weight")), "_j": F.col("block") % F.col("_weight")}
    )
    kind = F.filter(F.lit(_kinds(supply)), lambda r: r <= F.col("_round"))
    keyed = keyed.withColumn("_kind", F.array_max(kind))
    # The schedule of a kind is one array; its blocks' slots are found by source and number.
    met = keyed.join(schedules, ["_kind", "_index", "_j"])
    before = F.aggregate(
        F.lit([b for _, b, _ in supply]),
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("int").alias("i")),
        lambda acc, b: F.struct(
            (acc["sum"] + F.least(b.cast("long"), F.col("_round") * F.get(F.lit([w for _, _, w in supply]), acc["i"]).cast("long"))).alias("sum"),
            (acc["i"] + 1).alias("i"),
        ),
        lambda acc: acc["sum"],
    )
    return met.select(
        "doc_id",
        "text_crc32",
        "source",
        "size",
        "block",
        (before + F.col("_slot")).alias("slot"),
        "place",
    )


def _in_pieces(placed: DataFrame, supply: DataFrame) -> DataFrame:
    """The mix of any number of sources and slots, by joins and prefix sums.

    The schedules of all kinds of periods together have at most one slot for each block.
    """
    whole, last = F.floor(F.col("_blocks") / F.col("_weight")), F.ceil(F.col("_blocks") / F.col("_weight")) - 1
    supply = materialize(supply.withColumns({"_last": last}), "mix_supply")

    # The kinds of periods by number; one row for each kind a source has blocks in.
    ends = supply.agg(F.max("_last")).first()[0]
    starts = supply.select(F.explode(F.array(F.lit(0).cast("long"), whole, whole + 1)).alias("_start"))
    starts = starts.where(F.col("_start") <= ends).distinct().withColumn("_one", F.lit(1))
    kinds = positions(starts.withColumn("_all", F.lit(0)), ["_all"], ["_start"], "_one", "mix_kinds")
    kinds = materialize(kinds.select(F.col("before_rows").alias("_kind"), "_start"), "mix_kind_starts")
    # The period after a source's last one starts a kind, unless no source has blocks then.
    after = kinds.select((F.col("_start") - 1).alias("_last"), (F.col("_kind") - 1).alias("_upto"))
    reached = supply.join(after, "_last", "left").withColumn("_upto", F.coalesce("_upto", F.lit(kinds.count() - 1)))
    pairs = reached.select("_key", "_blocks", "_weight", F.explode(F.sequence(F.lit(0).cast("long"), "_upto")).alias("_kind"))
    pairs = pairs.join(kinds, "_kind").select(
        "_kind", "_start", "_key", "_weight", F.least("_weight", F.col("_blocks") - F.col("_start") * F.col("_weight")).alias("_n")
    )
    per_kind = pairs.groupBy("_kind", "_start").agg(F.sum("_n").alias("_slots"))
    in_order = Window.orderBy("_kind")  # as many rows as kinds
    per_kind = per_kind.withColumn("_rounds", F.lead("_start").over(in_order) - F.col("_start"))
    spent = F.sum(F.col("_rounds") * F.col("_slots")).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    per_kind = materialize(per_kind.withColumn("_base", F.coalesce(spent, F.lit(0))).drop("_rounds", "_start"), "mix_periods")

    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("_j")
    blocks = pairs.join(per_kind, "_kind").select("_kind", "_slots", "_key", "_n", numbers)
    schedules = materialize(_halved(blocks), "mix_schedules")
    starts = kinds.join(per_kind, "_kind")

    keyed = placed.join(supply.select("_key", "_weight"), "_key")
    keyed = keyed.withColumn("_round", F.floor(F.col("block") / F.col("_weight")))
    rounds = keyed.select(F.col("_round").alias("_start")).distinct().withColumn("_one", F.lit(0))
    both = kinds.select("_start", F.lit(1).alias("_one")).unionByName(rounds).withColumn("_all", F.lit(0))
    both = both.withColumn("_after", 1 - F.col("_one"))
    ranked = positions(both, ["_all"], ["_start", "_after"], "_one", "mix_rounds").where("_one = 0")
    ranked = ranked.select(F.col("_start").alias("_round"), (F.col("before_weight") - 1).alias("_kind"))
    rounds = materialize(ranked.join(starts, "_kind"), "mix_round_kinds")
    keyed = keyed.join(rounds, "_round").withColumn("_j", F.col("block") % F.col("_weight"))
    met = keyed.join(schedules, ["_kind", "_key", "_j"])
    slot = F.col("_base") + (F.col("_round") - F.col("_start")) * F.col("_slots") + F.col("_slot")
    return met.select("doc_id", "text_crc32", "source", "size", "block", slot.alias("slot"), "place")


def _div(a: Column, b: Column) -> Column:
    """Whole-number quotient of numbers that are not negative."""
    return F.call_function("div", a, b)


def _halved(blocks: DataFrame) -> DataFrame:
    """(_kind, _key, _j, _slot) of blocks (_kind, _slots, _key, _n, _j), dealt earliest deadline first.

    Blocks are numbered by priority. Those of the first half take slots as if the others were not
    there, and the others get the slots left over: whose slots are whose follows from the
    numbers alone, without dealing either half. A prefix sum that counts each block of the first
    half up at its release and each slot down reaches -1, -2 and so on for the first time at
    the slots left over. So pieces of (blocks, slots) are halved until they have
    ``PIECE`` slots at most, and each piece is dealt by itself.
    """
    j, n, length = F.col("_j"), F.col("_n"), F.col("_slots")
    windows = blocks.select(
        "_kind",
        "_key",
        "_j",
        _div(j * length, n).alias("_release"),
        _div((j + 1) * length + n - 1, n).alias("_due"),
        F.lit(1).cast("long").alias("_one"),
    )
    ranked = positions(windows, ["_kind"], ["_due", "_key"], "_one", "mix_due")
    ranked = materialize(ranked.select("_kind", "_key", "_j", "_release", F.col("before_rows").alias("_rank")), "mix_ranks")
    # There are as many slots as blocks.
    slots = ranked.select("_kind", F.col("_rank").alias("_slot"), F.lit(0).cast("long").alias("_piece"))
    bits = int(ranked.agg(F.max("_rank")).first()[0]).bit_length()
    nothing = F.lit(None).cast("long")
    while 1 << bits > max(1, PIECE):
        first = (F.expr(f"shiftright(_rank, {bits - 1})") % 2 == 0).cast("long")
        released = ranked.select(
            "_kind",
            F.expr(f"shiftright(_rank, {bits})").alias("_piece"),
            F.col("_release").alias("_at"),
            F.lit(0).alias("_late"),
            "_rank",
            first.alias("_count"),
        )
        taken = slots.select("_kind", "_piece", F.col("_slot").alias("_at"), F.lit(1).alias("_late"), nothing.alias("_rank"), F.lit(-1).cast("long").alias("_count"))
        counted = positions(released.unionByName(taken), ["_kind", "_piece"], ["_at", "_late", "_rank"], "_count", "mix_halves")
        over = counted.where("_late = 1 AND before_weight <= 0").groupBy("_kind", "_piece", "before_weight")
        over = over.agg(F.min("_at").alias("_slot")).select("_kind", "_slot", F.lit(1).alias("_over"))
        side = F.coalesce("_over", F.lit(0)).cast("long")
        slots = slots.join(over, ["_kind", "_slot"], "left").select("_kind", "_slot", (F.col("_piece") * 2 + side).alias("_piece"))
        slots = materialize(slots, "mix_pieces")
        bits -= 1

    ready = ranked.select(
        "_kind",
        F.expr(f"shiftright(_rank, {bits})").alias("_piece"),
        F.col("_release").alias("_at"),
        F.lit(0).alias("_late"),
        "_rank",
        "_key",
        "_j",
    )
    free = slots.select("_kind", "_piece", F.col("_slot").alias("_at"), F.lit(1).alias("_late"))
    pieces = ready.unionByName(free, allowMissingColumns=True).withColumn("_unit", F.concat_ws(":", "_kind", "_piece")).drop("_piece")
    sorted_pieces = pieces.repartition("_unit").sortWithinPartitions("_unit", "_at", "_late")
    return sorted_pieces.mapInArrow(_deal, "_kind bigint, _key string, _j bigint, _slot bigint")


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each slot of a piece takes the block of the highest priority among those released."""
    for _, piece in runs(batches, "_unit"):
        rank, late = piece["_rank"].to_pylist(), piece["_late"].to_numpy()
        waiting, chosen = [], []
        for row, slot in enumerate(late.tolist()):
            if slot:
                chosen.append(heapq.heappop(waiting)[1])
            else:
                heapq.heappush(waiting, (rank[row], row))
        dealt = piece.select(["_kind", "_key", "_j"]).take(pa.array(chosen, pa.int64()))
        at = piece["_at"].filter(pa.array(late == 1))
        yield from dealt.append_column("_slot", at).combine_chunks().to_batches()


def _kinds(supply: list[tuple[int, int, int]]) -> list[int]:
    """The periods from which on a new set of blocks takes part: a source's last whole
    period and its last partial one end differently."""
    starts = {0}
    for _, blocks, weight in supply:
        starts |= {blocks // weight, blocks // weight + 1}
    last = max(-(-blocks // weight) for _, blocks, weight in supply)
    return sorted(s for s in starts if s < max(last, 1))


def _schedules(spark, supply: list[tuple[int, int, int]]) -> DataFrame:
    """(_kind, _index, _j, _slot): the slot within its period of the j-th block of a
    source, for each kind of period. ``supply`` has the sources' numbers, blocks and weights.

    Rows: kinds times slots of a period, both bounded by the number of sources and
    the weights, not by the data."""
    kinds = [
        (start, [max(0, min(weight, blocks - start * weight)) for _, blocks, weight in supply])
        for start in _kinds(supply)
    ]
    dealt = spark.createDataFrame(kinds, "_kind long, _active array<bigint>").repartition(len(kinds))
    slots = dealt.select("_kind", F.posexplode(edf_schedule(F.col("_active"))).alias("_slot", "_index"))
    nth = F.row_number().over(Window.partitionBy("_kind", "_index").orderBy("_slot")) - 1
    return slots.select("_kind", "_index", nth.cast("long").alias("_j"), F.col("_slot").cast("long"))


def mix_order(docs: DataFrame, **options) -> DataFrame:
    """doc_id, text_crc32, slot and place, a row for each id and text: the first of the
    places of those that repeat."""
    order = mix(docs, **options).groupBy("doc_id", "text_crc32").agg(F.min(F.struct("slot", "place")).alias("at"))
    return order.select("doc_id", "text_crc32", "at.slot", "at.place")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` in the order of the mix: range after range of slots, each sorted, so
    that files read in order give the mixed stream. Columns and rows stay; rows with
    the same id and text stand side by side, at the first of their places."""
    def key(doc_id, crc):
        return [F.coalesce(doc_id.cast("string"), F.lit("")).alias("_id"), doc_id.isNull().alias("_none"), crc.alias("_crc")]

    docs, back = sheltered(docs, "doc_id", "text", "source")
    order = mix(docs, **options).groupBy(*key(F.col("doc_id"), F.col("text_crc32")))
    order = order.agg(F.min(F.struct("slot", "place")).alias("_at"))
    both = docs.select("*", *key(F.col("doc_id"), text_crc())).join(order, ["_id", "_none", "_crc"])
    both = both.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("_at.slot").alias("_slot"), F.col("_at.place").alias("_place"))
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return back(both.repartitionByRange(width, "_slot", "_place").sortWithinPartitions("_slot", "_place"))
