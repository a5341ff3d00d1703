"""Line dedup with a suffix array over line ids.

Texts are cut at line ends and lines are numbered by content. Only lines that
occur more than once can be part of a repeated run, so suffixes start at those alone
and end where a line occurs once or the document ends. Distributed prefix doubling
ranks the suffixes by their first 1, 2, 4, ... lines: a rank is the place in the
suffix array at which the suffixes with these first lines begin, so equal ranks are
exactly an interval of the array with a longest common prefix of that many lines.

A run counts from ``min_words`` words on. For every line the shortest run of whole
lines with that many words that starts there, and the one that ends there, is looked
up as an interval: two overlapping ranks name any length. All copies in an interval
but the earliest (by document id, then place) are deleted; together these runs cover
exactly the lines of all maximal repeated runs with ``min_words`` words or more.

Edge cases: null texts have no lines; blank lines are lines without words, take part
in runs and count nothing; null ids stand behind all others; repeated rows are
documents of their own, the first stays; a run that overlaps its own copy keeps its
first lines; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uurwerk.llm.common import positions, runs
from uurwerk.session import materialize

MIN_WORDS = 50

LINES = "row bigint, doc_id {kind}, line int, high bigint, low bigint, words int"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each line: its place, a 128-bit digest and its words."""
    for batch in batches:
        rows, ids, lines, marks, words = [], [], [], [], []
        for k, text in enumerate(batch.column(2)):
            text = text.as_py()
            if text is None:
                continue
            parts = text.encode("utf-8", "surrogatepass").split(b"\n")
            rows += [k] * len(parts)
            lines += range(len(parts))
            marks += [hashlib.blake2b(p, digest_size=16).digest() for p in parts]
            words += [len(p.split()) for p in parts]
        digests = np.frombuffer(b"".join(marks), np.int64).reshape(-1, 2)
        index = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(index),
                batch.column(1).take(index),
                pa.array(lines, pa.int32()),
                pa.array(digests[:, 0]),
                pa.array(digests[:, 1]),
                pa.array(words, pa.int32()),
            ],
            ["row", "doc_id", "line", "high", "low", "words"],
        )


def numbered(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row, doc_id and text of every document, stored once; ``row`` tells repeated rows
    apart and stays what it is as the table is written."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")


def line_table(stored: DataFrame) -> DataFrame:
    kind = stored.schema["doc_id"].dataType.simpleString()
    return materialize(stored.select("row", "doc_id", "text").mapInArrow(_cut, LINES.format(kind=kind)), "lines")


def repeated_lines(lines: DataFrame) -> DataFrame:
    """The lines whose content occurs more than once, with the first rank."""
    counted = lines.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ids = materialize(counted.withColumn("weight", F.col("n")).withColumn("_all", F.lit(0)), "line_ids")
    ranked = positions(ids, ["_all"], ["high", "low"], "weight", "line_ranks")
    return lines.join(ranked.select("high", "low", F.col("before_weight").alias("rank0")), ["high", "low"]).select(
        "row", "doc_id", "line", "words", "rank0"
    )


def stretches(repeated: DataFrame) -> DataFrame:
    """Adds ``left``: how many lines remain in the unbroken stretch of repeated lines."""
    by_place = Window.partitionBy("row").orderBy("line")
    marked = repeated.withColumn("_run", F.col("line") - F.row_number().over(by_place))
    backwards = Window.partitionBy("row", "_run").orderBy(F.desc("line"))
    return marked.withColumn("left", F.row_number().over(backwards)).drop("_run")


def doubled(suffixes: DataFrame, level: int) -> DataFrame:
    """Adds ``rank{level+1}``: the place at which suffixes with the same first
    ``2 ** (level + 1)`` lines begin; -1 stands behind a stretch's end."""
    step, rank, after = 2**level, f"rank{level}", f"rank{level + 1}"
    by_place = Window.partitionBy("row").orderBy("line")
    ahead = F.when(F.col("left") > step, F.lead(rank, step).over(by_place)).otherwise(F.lit(-1).cast("long"))
    paired = materialize(suffixes.withColumn("_next", ahead), "pairs")
    pairs = paired.groupBy(rank, "_next").agg(F.count(F.lit(1)).alias("weight")).withColumn("_all", F.lit(0))
    ranked = positions(pairs, ["_all"], [rank, "_next"], "weight", "suffix_ranks")
    return paired.join(ranked.select(rank, "_next", F.col("before_weight").alias(after)), [rank, "_next"]).drop("_next")


def _windows(suffixes: DataFrame, min_words: int) -> DataFrame:
    """For each line the shortest run with ``min_words`` words that starts there and the
    one that ends there: (row, doc_id, start, length), each once."""
    kind = suffixes.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, table in runs(batches, "row"):
            lines = table["line"].to_numpy()
            words = table["words"].to_numpy().astype(np.int64)
            found = set()
            cuts = np.flatnonzero(np.diff(lines) != 1) + 1
            for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(lines)]):
                upto = np.concatenate(([0], np.cumsum(words[first:last])))
                n = last - first
                ends = np.searchsorted(upto, upto[:-1] + min_words)
                starts = np.searchsorted(upto, upto[1:] - min_words, "right") - 1
                base = int(lines[first])
                found |= {(base + i, int(e - i)) for i, e in enumerate(ends.tolist()) if e <= n}
                found |= {(base + s, j + 1 - s) for j, s in enumerate(starts.tolist()) if s >= 0}
            if found:
                starts, lengths = zip(*sorted(found))
                one = table["doc_id"].slice(0, 1).combine_chunks().take(pa.array([0] * len(found)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(found), pa.int64()), one, pa.array(starts, pa.int32()), pa.array(lengths, pa.int32())],
                    ["row", "doc_id", "start", "length"],
                )

    narrow = suffixes.select("row", "doc_id", "line", "words").repartition("row").sortWithinPartitions("row", "line")
    return narrow.mapInArrow(work, f"row bigint, doc_id {kind}, start int, length int")


def repeated_runs(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, start, length) of every run of at least ``min_words`` words that also
    occurs at an earlier place."""
    suffixes = materialize(stretches(repeated_lines(lines)), "suffixes")
    windows = materialize(_windows(suffixes, min_words), "windows")
    longest = windows.agg(F.max("length")).first()[0] or 0
    levels = max(0, int(longest).bit_length() - 1)
    for level in range(levels):
        suffixes = materialize(doubled(suffixes, level), "suffixes")
    ranks = F.array(*[F.col(f"rank{k}") for k in range(levels + 1)])
    places = suffixes.select("row", "line", ranks.alias("ranks"))
    level = F.floor(F.log2(F.col("length") + 0.5)).cast("int")
    sized = windows.withColumn("_level", level).withColumn(
        "_second", (F.col("start") + F.col("length") - F.pow(F.lit(2), F.col("_level"))).cast("int")
    )
    first = sized.join(places.withColumnRenamed("line", "start"), ["row", "start"]).withColumn(
        "a", F.element_at("ranks", F.col("_level") + 1)
    )
    first = first.drop("ranks")
    both = first.join(places.withColumnRenamed("line", "_second"), ["row", "_second"]).withColumn(
        "b", F.element_at("ranks", F.col("_level") + 1)
    )
    named = materialize(both.select("row", "doc_id", "start", "length", "a", "b"), "named")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row", "start")
    earliest = named.groupBy("length", "a", "b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = named.join(earliest, ["length", "a", "b"]).where(
        (F.col("row") != F.col("first.row")) | (F.col("start") != F.col("first.start"))
    )
    return later.select("row", "start", "length")




def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, all_runs = batch.column(1), batch.column(2).to_pylist()
        kept, counts, gone, listed = [], [], [], []
        for text, found in zip(texts, all_runs):
            text = text.as_py()
            lines = text.split("\n") if text is not None else []
            merged: list[list[int]] = []
            for start, length in sorted((r["start"], r["length"]) for r in found or []):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], start + length)
                else:
                    merged.append([start, start + length])
            left, at = [], 0
            for start, end in merged:
                left += lines[at:start]
                at = end
            left += lines[at:]
            kept.append("\n".join(left) if text is not None else None)
            counts.append(len(lines))
            gone.append(len(lines) - len(left))
            listed.append(",".join(f"{s}:{e}" for s, e in merged))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(kept, pa.string()),
                pa.array(counts, pa.int64()),
                pa.array(gone, pa.int64()),
                pa.array(listed, pa.string()),
            ],
            ["doc_id", "text", "n_lines", "n_removed", "removed"],
        )


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the text without later copies of repeated runs, n_lines, n_removed and the
    removed line ranges (``start:end``, end exclusive), one row for each document."""
    stored = numbered(docs, doc_id, text)
    found = repeated_runs(line_table(stored), min_words)
    # A document's runs are fewer than twice its lines, so they fit where its text does.
    gathered = found.groupBy("row").agg(F.collect_list(F.struct("start", "length")).alias("runs"))
    joined = stored.join(gathered, "row", "left").select("doc_id", "text", "runs")
    kind = stored.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(_apply, f"doc_id {kind}, text string, n_lines bigint, n_removed bigint, removed string")
