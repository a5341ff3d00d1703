"""SimHash near-dedup by the generalised pigeonhole principle.

A fingerprint bit is the majority of that bit over the XXH64 hashes of the word
shingles. Two fingerprints at most ``distance`` bits apart agree up to ``t_i`` bits
in at least one part ``i`` if the parts' thresholds satisfy sum(t_i + 1) =
distance + 1. Correlated bits are put in one part, the number of parts and their
thresholds are chosen by estimated cost (the thresholds by dynamic programming
over candidate counts of all fingerprints), parts are probed, and every candidate
is verified on all 64 bits.

Edge cases: null, empty and blank texts have fingerprint zero, which links like any
other; fewer words than a shingle make one shingle; equal fingerprints are one
node, so copies cost nothing; null ids take part and are never a representative
while another id is there; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uurwerk.llm.common import components, local_roots, runs, sheltered, tiled
from uurwerk.session import materialize

BITS = 64
SEED = 42
SHINGLE = 4
DISTANCE = 4
# Rows of a tile: two tiles are compared at once, in slices.
TILE_ROWS = 4096
# Beyond this many parts buckets get too wide to separate anything.
MAX_PARTS = 8
# Moving a probe through a shuffle costs about as much as this many comparisons.
PROBE_COST = 100.0


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint as a signed integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([digest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = np.array(
            [digest(joined[s:e], SEED) for s, e in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist())],
            np.uint64,
        )
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, into: str = "fp") -> DataFrame:
    """``docs`` and a long column ``into``, which must be a free name."""
    if into in docs.columns:
        raise ValueError(f"{into} is already a column")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            values = [fingerprint(t.as_py(), shingle) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.int64())], [*batch.schema.names, into]
            )

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(into, T.LongType())]))


def bit_moments(classes: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in how many each two bits are both set."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            fps = batch.column(0).to_numpy()
            bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += bits.T.astype(np.float32) @ bits.astype(np.float32)
            n += len(fps)
        yield pa.RecordBatch.from_pydict(
            {
                "bit": pa.array(range(BITS), pa.int32()),
                "n": pa.array([n] * BITS, pa.int64()),
                "both": pa.array(list(total)),
            }
        )

    sums = [F.sum(F.element_at("both", j + 1)).alias(f"b{j}") for j in range(BITS)]
    rows = classes.select("fp").mapInArrow(partial, "bit int, n bigint, both array<double>")
    got = rows.groupBy("bit").agg(F.sum("n").alias("n"), *sums).collect()
    n, both = 0, np.zeros((BITS, BITS))
    for row in got:
        n = row.n
        both[row.bit] = [row[f"b{j}"] for j in range(BITS)]
    return n, both


def bit_groups(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """``parts`` groups of bits of nearly equal size, correlated bits together: each
    group starts with the free bit that leans least to one side and takes the free bit
    most correlated with its members."""
    share = np.diag(both) / max(n, 1)
    spread = share * (1 - share)
    covariance = both / max(n, 1) - np.outer(share, share)
    strength = np.abs(covariance) / np.sqrt(np.outer(spread, spread) + 1e-12)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = (BITS * (k + 1)) // parts - (BITS * k) // parts
        group = [max(sorted(free), key=lambda b: spread[b])]
        free -= {group[0]}
        while len(group) < size:
            best = max(sorted(free), key=lambda b: strength[b, group].sum())
            group.append(best)
            free -= {best}
        groups.append(sorted(group))
    return groups


def tail(n: int, both: np.ndarray, group: list[int], most: int) -> list[float]:
    """Probability that two fingerprints differ in at most 0, 1, ... ``most`` bits of
    the group, bits taken as independent."""
    share = np.diag(both)[group] / max(n, 1)
    exact = np.zeros(most + 1)
    exact[0] = 1
    for p in 2 * share * (1 - share):
        exact[1:] = exact[1:] * (1 - p) + exact[:-1] * p
        exact[0] *= 1 - p
    return list(np.cumsum(exact))


def probes(width: int, threshold: int) -> int:
    """Values within ``threshold`` bits of one of ``width`` bits."""
    return sum(comb(width, k) for k in range(threshold + 1))


def allocate(costs: list[list[float]], units: int) -> list[int] | None:
    """Thresholds (-1: the part is not probed) with sum(t + 1) = ``units`` and least
    total cost, or None if the parts cannot take as much. ``costs[i][t]`` is the cost
    of part ``i`` at threshold ``t``."""
    best: list[tuple[float, list[int]] | None] = [(0.0, [])] + [None] * units
    for cost in costs:
        after: list[tuple[float, list[int]] | None] = [None] * (units + 1)
        for used, state in enumerate(best):
            if state is None:
                continue
            for take in range(units - used + 1):
                if take > len(cost):
                    break
                total = state[0] + (cost[take - 1] if take else 0.0)
                if after[used + take] is None or total < after[used + take][0]:
                    after[used + take] = total, state[1] + [take - 1]
        best = after
    return best[units][1] if best[units] else None


def _part_values(groups: list[list[int]]):
    """For each group a function from fingerprints to the group's bits, packed."""

    def pack(fps: np.ndarray, group: list[int]) -> np.ndarray:
        out = np.zeros(len(fps), np.int64)
        for at, bit in enumerate(group):
            out |= ((fps >> bit) & 1) << at
        return out

    return [lambda fps, g=g: pack(fps, g) for g in groups]


def _home(groups: list[list[int]], chosen: list[int]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = _part_values(groups)
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for i in chosen:
                yield pa.RecordBatch.from_pydict(
                    {"part": np.full(len(fps), i, np.int32), "value": values[i](fps), "fp": fps}
                )

    return rows


def _probing(groups: list[list[int]], thresholds: list[int]):
    """A row for every value within the part's threshold of the fingerprint's own."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = _part_values(groups)
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for i, threshold in enumerate(thresholds):
                if threshold < 0:
                    continue
                own = values[i](fps)
                for flips in range(threshold + 1):
                    for chosen in combinations(range(len(groups[i])), flips):
                        mask = sum(1 << c for c in chosen)
                        yield pa.RecordBatch.from_pydict(
                            {
                                "part": np.full(len(fps), i, np.int32),
                                "value": own ^ mask,
                                "fp": fps,
                                "home": np.full(len(fps), flips == 0),
                            }
                        )

    return rows


def plan_parts(classes: DataFrame, distance: int = DISTANCE) -> tuple[list[list[int]], list[int]]:
    """Groups of bits and their thresholds for the given fingerprints."""
    n, both = bit_moments(classes)
    units = distance + 1

    def priced(groups, pairs):
        return [
            [n * probes(len(g), t) * PROBE_COST + c for t, c in enumerate(row)] for g, row in zip(groups, pairs)
        ]

    choices = []
    for parts in range(2, min(units, MAX_PARTS) + 1):
        groups = bit_groups(n, both, parts)
        pairs = [[n * n / 2 * p for p in tail(n, both, g, min(3, units - 1))] for g in groups]
        costs = priced(groups, pairs)
        if thresholds := allocate(costs, units):
            choices.append((sum(c[t] for c, t in zip(costs, thresholds) if t >= 0), parts, groups, pairs))
    _, _, groups, pairs = min(choices, key=lambda c: c[:2])
    # What independence misses is taken from the data: equal values of each part are
    # counted over all fingerprints, and the estimates scaled by what was found.
    homes = classes.select("fp").mapInArrow(_home(groups, list(range(len(groups)))), "part int, value bigint, fp bigint")
    counted = homes.groupBy("part", "value").agg(F.count(F.lit(1)).cast("double").alias("n"))
    found = {r.part: r.c for r in counted.groupBy("part").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("c")).collect()}
    scaled = [[p * (found.get(i, 0.0) + 1) / (row[0] + 1) for p in row] for i, row in enumerate(pairs)]
    return groups, allocate(priced(groups, scaled), units)


def _verify(distance: int):
    """Within each unit, link every two rows at most ``distance`` bits apart of which
    one at least is at home, and give each linked row the least of its group."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, unit in runs(batches, "unit"):
            if unit.num_rows < 2:
                continue
            fps = unit.column("fp").to_numpy().view(np.uint64)
            tile = unit.column("_tile").to_numpy()
            home = unit.column("home").to_numpy(zero_copy_only=False).astype(bool)
            order = np.argsort(fps, kind="stable")
            fps, tile, home = fps[order], tile[order], home[order]
            one = unit.column("_low")[0].as_py() == unit.column("_high")[0].as_py()
            left, right = [], []
            for at in range(0, len(fps), 512):
                near = np.bitwise_count(fps[at : at + 512, None] ^ fps[None, :]) <= distance
                a, b = np.nonzero(near)
                a = a + at
                keep = (a < b) & (home[a] | home[b]) & (one | (tile[a] != tile[b]))
                left.append(a[keep])
                right.append(b[keep])
            left, right = np.concatenate(left), np.concatenate(right)
            if not len(left):
                continue
            root = local_roots(len(fps), left, right)
            linked = np.flatnonzero(root != np.arange(len(fps)))
            signed = fps.view(np.int64)
            yield pa.RecordBatch.from_pydict({"a": signed[linked], "b": signed[root[linked]]})

    return link


def link_fingerprints(classes: DataFrame, distance: int = DISTANCE, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links ``(a, b)`` that connect exactly the distinct fingerprints ``fp`` which
    chains of at most ``distance`` bits connect; within a crowded bucket a spanning
    forest is returned in place of all pairs. A distance of 0 links nothing, as equal
    fingerprints are one; up to ``4 * MAX_PARTS - 1`` bits are possible."""
    if distance == 0:
        return classes.sparkSession.createDataFrame([], "a bigint, b bigint")
    groups, thresholds = plan_parts(classes, distance)
    rows = classes.select("fp").mapInArrow(
        _probing(groups, thresholds), "part int, value bigint, fp bigint, home boolean"
    )
    counts = rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("used"))
    # Without a fingerprint at home, or with a single row, a bucket holds no pair.
    counts = counts.where("used and n > 1")
    units = tiled(rows, ["part", "value"], materialize(counts, "buckets"), tile_rows, "fp")
    units = units.withColumn("unit", F.concat_ws(":", "part", "value", "_low", "_high"))
    return units.repartition("unit").sortWithinPartitions("unit").mapInArrow(_verify(distance), "a bigint, b bigint")


def near_duplicates(prints: DataFrame, doc_id: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """For each distinct fingerprint ``fp`` of ``prints`` its ``component_id``, the
    smallest id that links reach, and ``root``, the smallest fingerprint, which tells
    components apart where an id occurs in several."""
    classes = materialize(prints.groupBy("fp").agg(F.min(doc_id).alias("first_id")), "fingerprints")
    found = components(link_fingerprints(classes, distance))
    joined = classes.join(found, classes.fp == found.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return joined.join(least, "root").select("fp", "component_id", "root")


def deduplicate(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One document of each group: the smallest id (rows that repeat it count once; a
    group of null ids keeps one row). Columns stay as they are."""
    docs, back = sheltered(docs, text, doc_id)
    prints = materialize(with_fingerprint(docs, text, shingle, "_fp"), "with_fingerprints")
    classes = near_duplicates(prints.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col("_fp").alias("fp")), "doc_id", distance)
    joined = prints.join(classes.toDF("_fp", "_component", "_root"), "_fp")
    first = joined.where(F.col(f"`{doc_id}`").eqNullSafe(F.col("_component")))
    # What is left of a group is one document, unless its id occurs in several rows.
    ties = Window.partitionBy("_root").orderBy(F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    return back(first.withColumn("_nth", F.row_number().over(ties)).where("_nth = 1"))
