"""Spelling variants: words one edit apart, grouped under their most frequent form.

The words of all documents are counted. For each word its deletions and replacements
are generated as hashes alone, whole matrices of them at a time, and looked up in
blocked Bloom filters of the vocabulary, one for each word length. The filters are
broadcast; their size is a parameter, and a larger vocabulary is looked up in rounds,
each with the filters of one slice of it, so neither size nor error rate grows with the
data. Only edits that a filter lets pass are shuffled, to an exact join with the
vocabulary by 128-bit hash, and the words of the joined pairs are compared at the end.
An insertion is the deletion of the longer word, and of two words that differ by a
replacement only one asks.

A word's form is its near word of largest count (ties: the smaller in code-point
order) if that has at least twice the word's count. Counts along forms double, so
roots are found by pointer jumping in as many rounds as the logarithm of the longest
possible chain.

Edge cases: null and empty texts have no words; words of any length are probed in pieces of
bounded size; repeated rows count again; a null id is the empty text in the rule of
deletions; other columns are not read; an empty table gives no row.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uurwerk.session import materialize

MIN_LENGTH = 5
MIN_COUNT = 3
# Bytes of the filters of one round, and bits spent on a word.
FILTER_BYTES = 32 << 20
BITS_PER_WORD = 24
PROBES = 5
# Longer words share one filter; a word's hash holds its length.
LONGEST_SHARD = 64

# Distinct tokens that a task holds before it passes its counts on; hashes made at a time.
HELD_TOKENS = 500_000
PIECE = 1 << 21

# The letters of a word, lower-cased: a-z and U+00C0 to U+00FF.
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# Odd factors of the two polynomial hashes.
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _damaged(doc_id: str, run: bytes) -> bytes:
    """The run, without one letter if the checksum of id and run says so."""
    h = zlib.crc32(run, zlib.crc32(f"{doc_id}:".encode()))
    if h % 97:
        return run
    letters = run.decode()
    k = h % len(letters)
    return (letters[:k] + letters[k + 1 :]).encode()


def _count(min_length: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            kept = [(w, n) for w, n in held.items() if len(w) - w.count(b"\xc3") >= min_length]
            held.clear()
            words = pa.array([w for w, _ in kept], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                for run, n in Counter(_RUN.findall(text.translate(_LOWER))).items():
                    held[_damaged(doc_id, run)] += n
                if len(held) > HELD_TOKENS:
                    yield flush()
        yield flush()

    return count


def count_words(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT
) -> DataFrame:
    """(word, n) of all words with ``min_length`` letters and ``min_count`` occurrences."""
    rows = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("doc_id"),
        F.col(f"`{text}`").cast("binary").alias("text"),
    )
    counted = rows.mapInArrow(_count(min_length), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _mixed(h: np.ndarray, length: int) -> np.ndarray:
    """Spread a polynomial hash over all bits; the length goes in."""
    with np.errstate(over="ignore"):
        h = h ^ np.uint64(length * 0x5851F42D4C957F2D & (1 << 64) - 1)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def _letters(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, length).astype(np.uint64)


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        out.setdefault(len(word), []).append(k)
    return out


def _hashes(words: list[str]) -> np.ndarray:
    """Two 64-bit hashes of each word."""
    out = np.zeros((2, len(words)), np.uint64)
    with np.errstate(over="ignore"):
        for length, at in _by_length(words).items():
            letters = _letters([words[k] for k in at], length)
            for b, base in enumerate(_BASES):
                out[b, at] = _mixed((letters * _powers(base, length)).sum(1, dtype=np.uint64), length)
    return out


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        h = _hashes(words).view(np.int64)
        lengths = pa.array([len(w) for w in words], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), lengths, pa.array(h[0]), pa.array(h[1])], ["word", "n", "length", "a", "b"]
        )


class Filters:
    """Blocked Bloom filters side by side in one array of 64-bit blocks: first block and
    number of blocks of each length."""

    def __init__(self, blocks: np.ndarray, shards: dict[int, tuple[int, int]], slices: int, turn: int):
        self.blocks, self.shards, self.slices, self.turn = blocks, shards, slices, turn

    def passes(self, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
        """Which of the hashes may be words of this length and of this round's slice."""
        found = self.shards.get(min(length, LONGEST_SHARD))
        if found is None:
            return np.zeros(a.shape, bool)
        first, n = found
        block = self.blocks[first + ((a >> np.uint64(30)) % np.uint64(n)).astype(np.int64)]
        mask = np.zeros(a.shape, np.uint64)
        for k in range(PROBES):
            mask |= np.uint64(1) << ((a >> np.uint64(6 * k)) & np.uint64(63))
        out = (block & mask) == mask
        if self.slices > 1:
            out &= (b >> np.uint64(1)) % np.uint64(self.slices) == np.uint64(self.turn)
        return out


def _mask() -> str:
    return " | ".join(f"shiftleft(1L, cast(shiftright(a, {6 * k}) & 63L as int))" for k in range(PROBES))


def _filters(vocabulary: DataFrame, counts: dict[int, int], slices: int, turn: int) -> Filters:
    """The filters of one slice, made block by block on Spark; what comes to the driver is
    ``FILTER_BYTES`` at most, give or take a block for each length."""
    shards, at = {}, 0
    for shard, n in sorted(counts.items()):
        size = max(1, -(-n * BITS_PER_WORD // (64 * slices)))
        shards[shard] = at, size
        at += size
    where = F.create_map(*[F.lit(v) for s, (first, n) in shards.items() for v in (s, first)])
    sizes = F.create_map(*[F.lit(v) for s, (first, n) in shards.items() for v in (s, n)])
    own = F.expr(f"pmod(shiftrightunsigned(b, 1), {slices}L)") == turn
    placed = vocabulary.where(own).withColumn("_shard", F.least("length", F.lit(LONGEST_SHARD)))
    block = F.element_at(where, F.col("_shard")) + F.pmod(F.expr("shiftrightunsigned(a, 30)"), F.element_at(sizes, F.col("_shard")))
    made = placed.select(block.cast("long").alias("block"), F.expr(_mask()).alias("mask"))
    found = made.groupBy("block").agg(F.bit_or("mask").alias("mask")).toArrow()
    blocks = np.zeros(max(at, 1), np.uint64)
    blocks[found["block"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return Filters(blocks, shards, slices, turn)


def _edits(letters: np.ndarray, filters: Filters) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows and hash pairs of the edits of words of one length that the filters let pass."""
    m, length = letters.shape
    powers = [_powers(base, length) for base in _BASES]
    whole = [(letters * p).sum(1, dtype=np.uint64) for p in powers]
    # Deletions; of equal neighbours one is enough.
    if length > 1:
        ahead = [letters[:, 1:] * p[:-1] for p in powers]
        behind = [letters * p for p in powers]
        for start in range(0, length, max(1, PIECE // m)):
            stop = min(length, start + max(1, PIECE // m))
            sums = []
            for b in range(2):
                upto = np.zeros((m, stop - start), np.uint64)
                upto[:, 0] = behind[b][:, :start].sum(1, dtype=np.uint64)
                upto[:, 1:] = behind[b][:, start : stop - 1]
                np.cumsum(upto, 1, out=upto)
                left = np.zeros((m, length - start), np.uint64)
                left[:, :-1] = ahead[b][:, start:]
                rest = np.cumsum(left[:, ::-1], 1)[:, ::-1][:, : stop - start]
                sums.append(_mixed(upto + rest, length - 1))
            ok = filters.passes(*sums, length - 1)
            last = np.ones((m, stop - start), bool)
            inner = min(stop, length - 1) - start
            last[:, :inner] = letters[:, start : start + inner] != letters[:, start + 1 : start + inner + 1]
            rows, cols = np.nonzero(ok & last)
            yield rows, sums[0][rows, cols], sums[1][rows, cols]
    # Replacements by a larger letter; the other word of such a pair need not ask.
    step = max(1, PIECE // (m * len(ALPHABET)))
    for start in range(0, length, step):
        part = letters[:, start : start + step, None]
        change = ALPHABET[None, None, :] - part
        sums = [
            _mixed(whole[b][:, None, None] + change * powers[b][None, start : start + step, None], length) for b in range(2)
        ]
        ok = filters.passes(*sums, length) & (ALPHABET[None, None, :] > part)
        found = np.nonzero(ok)
        yield found[0], sums[0][found], sums[1][found]


def _probe(shared):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        for batch in batches:
            words = batch.column(0).to_pylist()
            a, b = (batch.column(k).to_numpy() for k in (1, 2))
            for length, at in _by_length(words).items():
                step = max(1, PIECE // (length * len(ALPHABET)))
                for start in range(0, len(at), step):
                    some = np.array(at[start : start + step])
                    with np.errstate(over="ignore"):
                        for rows, x, y in _edits(_letters([words[k] for k in some], length), filters):
                            if len(rows):
                                own = some[rows]
                                yield pa.RecordBatch.from_arrays(
                                    [pa.array(v) for v in (a[own], b[own], x.view(np.int64), y.view(np.int64))],
                                    ["from_a", "from_b", "a", "b"],
                                )

    return probe


def near_pairs(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, other, other_n): every two words one edit apart, in both directions.
    ``vocabulary`` has distinct words as (word, n)."""
    hashed = materialize(
        vocabulary.select("word", "n").mapInArrow(_hashed, "word string, n bigint, length int, a bigint, b bigint"), "vocabulary"
    )
    spark = vocabulary.sparkSession
    shard = F.least("length", F.lit(LONGEST_SHARD)).alias("shard")
    counts = {r.shard: r["count"] for r in hashed.groupBy(shard).count().collect()}
    slices = max(1, -(-sum(counts.values()) * BITS_PER_WORD // (8 * filter_bytes)))
    asked = hashed.select("word", "a", "b")
    edits = "from_a bigint, from_b bigint, a bigint, b bigint"
    passed = spark.createDataFrame([], edits)
    for turn in range(slices if counts else 0):
        shared = spark.sparkContext.broadcast(_filters(hashed, counts, slices, turn))
        passed = passed.union(asked.mapInArrow(_probe(shared), edits))
    hit = passed.join(hashed.select("a", "b", F.col("word").alias("other"), F.col("n").alias("other_n")), ["a", "b"])
    source = hashed.select(F.col("a").alias("from_a"), F.col("b").alias("from_b"), "word", "n")
    pairs = hit.join(source, ["from_a", "from_b"]).where(F.levenshtein("word", "other", 1) == 1)
    pairs = materialize(pairs.select("word", "n", "other", "other_n"), "near_words")
    return pairs.union(pairs.select("other", "other_n", "word", "n"))


def _roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) of words with a form: each round every word jumps to where its target
    points, so ``steps`` forms in a row need the logarithm of it in rounds."""
    current = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(max(0, (steps - 1).bit_length())):
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        current = materialize(
            current.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots"
        )
    return current


def group_variants(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, form and root, with n, n_near and form_n, for a vocabulary of distinct (word, n)."""
    words = materialize(vocabulary.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    near = near_pairs(words, filter_bytes).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    larger = -F.col("best.less") >= 2 * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(larger, F.col("best.form")).alias("form"),
        F.when(larger, -F.col("best.less")).alias("form_n"),
    )
    joined = materialize(joined, "forms")
    low, high = joined.agg(F.min("n"), F.max("n")).first()
    # The count doubles with every form.
    steps = (int(high) // max(1, int(low))).bit_length() if high else 0
    roots = _roots(joined.where("form IS NOT NULL"), steps)
    return joined.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
