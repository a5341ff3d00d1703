"""Removal of repeated byte strings by a common-prefix-aware distributed merge sort.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the
same document or another; strings never cross documents. Which strings are shared
is settled by sorting the suffixes in question, cut to ``length`` bytes: every task
sorts its own into a run and front-codes it (of each suffix only what its
predecessor does not share), the runs' blocks are exchanged by ranges of sampled
splitters, and each range is merged by a loser tree that carries the common prefix
of every head with the last winner, so that known prefixes are never compared again. A
suffix is shared if a merged neighbour has all its bytes.

Sorting every suffix would exchange ``length`` times the input, so duplicates are
looked for first by hashes, which narrow what is sorted and never decide alone:

1. Of every ``SPREAD`` consecutive grams of ``GRAM`` bytes the least by hash is an anchor, so equal
   strings hold equal anchors at equal distances. Anchors are shuffled as hashes of their gram
   and of their surroundings, all bytes of the strings that they may be the anchor of. An
   anchor whose gram occurs once is dropped; one whose surroundings occur again has only shared
   strings. Where a gram stands in different surroundings, its strings are looked at one by one:
2. all of them are hashed and shuffled, for one anchor of each surroundings. Of those that are
   shared only the first and last in each piece of 128 places matter, as they cover all
   between, each with one witness elsewhere.
3. The strings of covered anchors, and those of claims and witnesses, are sorted and merged. If neighbours differ although their 128-bit digests agree, their
   claim is dropped and the spans are computed again without it.

A task hands on one entry for all its equal strings, so a passage that a third of all
documents share is as many entries as there are tasks.

Edge cases: null texts count as empty; texts shorter than ``length`` lose nothing; repeated
rows are documents of their own, so both lose everything; null or repeated ids do not
matter; texts are read in slices, however long; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uurwerk.llm.common import runs as grouped
from uurwerk.session import materialize

LENGTH = 200
GRAM = 96
SPREAD = 80
# What stands around an anchor: the strings that it may be the anchor of, and the anchor before it.
BEFORE = SPREAD
AROUND = BEFORE + LENGTH
# Bytes hashed at a time, which fit a core's cache; bytes of texts behind one local run.
SLICE = 1 << 16
CHUNK = 12 << 20
# The same where every place is looked at, which takes some hundred bytes each.
DENSE_CHUNK = 3 << 20
# Bytes of texts behind one bucket of hashes.
BUCKET_BYTES = 16 << 20
# Texts sampled for splitters, strings taken of each, bytes that one range merges.
SAMPLE, STRINGS = 4000, 5
RANGE_BYTES = 24 << 20
# Bits of the filter of texts at most.
FILTER_BITS = 1 << 27
# Places of which the first and the last repeated one are kept; less than a string.
PIECE = 128
# Digests whose claim failed; one is a coincidence of 96 bits.
MAX_FAILED = 10_000

# No byte of UTF-8.
PAD = b"\xff" * LENGTH

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mix(a: np.ndarray, b: np.ndarray, factor: np.uint64 = _A) -> np.ndarray:
    """One hash from two, by place."""
    h = (a ^ (a >> np.uint64(32))) * factor + (b ^ (b >> np.uint64(29))) * _C
    return h ^ (h >> np.uint64(31))


def _gram_hashes(data: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of all grams of 1, 2, 4, ... 128 bytes, by doubling."""
    out = {1: (data.astype(np.uint64) + np.uint64(1)) * _B}
    size = 1
    while size < 128:
        half = out[size]
        out[2 * size] = _mix(half[:-size], half[size:], _A + np.uint64(2 * size))
        size *= 2
    return out


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """The least or largest of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return pick(values[:-rest], values[rest:]) if rest else values


class Stream:
    """Texts one behind the other with padding before, between and after them."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(PAD + PAD.join(texts) + PAD, np.uint8)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = LENGTH + np.concatenate([[0], np.cumsum(self.sizes[:-1] + LENGTH)]).astype(np.int64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, place, hash of the gram and hash of the surroundings of all anchors."""
        found = []
        last = self.starts[-1] + self.sizes[-1]
        # First and last place from which SPREAD grams lie inside the text.
        low, high = self.starts, self.starts + self.sizes - GRAM - SPREAD + 1
        with np.errstate(over="ignore"):
            for start in range(LENGTH, int(last), SLICE):
                end = min(start + SLICE, int(last))
                grams = _gram_hashes(self.data[start - BEFORE : end + SPREAD + LENGTH])
                h = _mix(grams[64][: -(GRAM - 64)], grams[32][64:], _B)[BEFORE : BEFORE + end - start + SPREAD - 1]
                least = _sliding(h, SPREAD, np.minimum)
                inside = np.zeros(len(least) + 1, np.int8)
                here = slice(np.searchsorted(high, start), np.searchsorted(low, end))
                np.add.at(inside, np.clip(low[here] - start, 0, len(least)), 1)
                np.add.at(inside, np.clip(high[here] + 1 - start, 0, len(least)), -1)
                least[np.cumsum(inside[:-1]) == 0] = 0
                edge = np.zeros(SPREAD - 1, np.uint64)
                # A gram is chosen if it is the least of any of the windows that hold it.
                chosen = _sliding(np.concatenate([edge, least, edge]), SPREAD, np.maximum)
                at = np.flatnonzero(h[: len(chosen)] == chosen)
                wide = grams[128]
                around = _mix(_mix(wide[at], wide[at + 128], _C), wide[at + AROUND - 128], _B)
                found.append((at + start, h[at], around))
        at, gram, around = (np.concatenate(v) for v in zip(*found))
        at, one = np.unique(at, return_index=True)
        text = np.searchsorted(self.starts, at, "right") - 1
        return text, at - self.starts[text], gram[one], around[one]

    def digests(self, text: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes, of different grams, of the strings at places in ascending order."""
        at = self.starts[text] + place
        out = np.zeros((2, len(at)), np.uint64)
        with np.errstate(over="ignore"):
            low = 0
            while low < len(at):
                start = int(at[low])
                high = int(np.searchsorted(at, start + SLICE))
                grams = _gram_hashes(self.data[start : start + SLICE + LENGTH])
                here = at[low:high] - start
                wide, mid, end = grams[128], grams[64], grams[8]
                out[0, low:high] = _mix(wide[here], wide[here + LENGTH - 128], _B)
                rest = _mix(mid[here + 128], end[here + LENGTH - 8], _A)
                out[1, low:high] = _mix(_mix(mid[here], mid[here + 64], _C), rest, _B)
                low = high
        return out[0], out[1]


def _digest(string: bytes) -> bytes:
    zero = np.zeros(1, np.int64)
    return np.stack(Stream([string]).digests(zero, zero), 1).tobytes()


def _equal_runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and for each place of it the number of its group."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        sorted_key = key[order]
        new[1:] |= sorted_key[1:] != sorted_key[:-1]
    return order, np.cumsum(new)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed block."""
    parts = [np.array([len(arrays), *[a.nbytes for a in arrays]], np.int64).tobytes(), *[a.tobytes() for a in arrays]]
    return zstandard.compress(b"".join(parts), 1)


def _unpacked(block: bytes, *kinds: type) -> list[np.ndarray]:
    raw = zstandard.decompress(block)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, n, 8)
    ends = 8 * (n + 1) + np.cumsum(sizes)
    return [np.frombuffer(raw[e - s : e], k) for s, e, k in zip(sizes, ends, kinds)]


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences, which are small for places in order."""
    return np.diff(values.astype(np.int32), prepend=np.int32(0))


def _summed(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.int32)


def _pieces(batches: Iterator[pa.RecordBatch], text: int, limit: int = CHUNK) -> Iterator[list[tuple]]:
    """The rows in pieces of about ``limit`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*[c.to_pylist() if k != text else c for k, c in enumerate(batch.columns)]):
            row = (*row[:text], row[text].as_py(), *row[text + 1 :])
            held.append(row)
            size += len(row[text])
            if size > limit:
                yield held
                held, size = [], 0
    if held:
        yield held


# ---- step 1: anchors whose gram occurs again

BLOCKS = "bucket int, block binary"

# What is known of an anchor: its own string is shared; its strings are to be looked at one by one.
COVERED, EMIT = 1, 2


def _block_rows(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([b for b, _ in rows], pa.int32()), pa.array([v for _, v in rows], pa.binary())], ["bucket", "block"]
    )


def _gram_entries(buckets: int):
    """Per piece of the input and bucket: an entry for each gram, with a place that has it, its surroundings and
    whether they occur more than once in the piece. A gram that the piece has in different
    surroundings needs no answer, and two of them tell the others all there is to tell; so a
    gram has two entries a piece at most, however many documents share it. Places that are
    settled are only passed on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, 2):
            keys = np.array([r[:2] for r in piece], np.int64)
            row, place, gram, around = Stream([r[2] for r in piece]).anchors()
            order, group = _equal_runs(gram, around)
            first = np.flatnonzero(np.diff(group, prepend=-1))
            many = np.bincount(group) > 1
            lead = order[first]
            same = gram[lead[1:]] == gram[lead[:-1]]
            second = np.concatenate([[False], same])
            mixed = second | np.concatenate([same, [False]])
            third = second & np.concatenate([[False], second[:-1]])
            state = np.zeros(len(gram), np.int8)
            state[order] = np.where(many[group], COVERED, 0)
            state[lead[mixed]] += EMIT
            known = np.flatnonzero(state)
            flag = many.astype(np.int8) + 2 * mixed.astype(np.int8)
            entry, flag = lead[~third], flag[~third]
            in_order = np.argsort(entry)
            entry, flag = entry[in_order], flag[in_order]
            target = gram[entry] % np.uint64(buckets)
            rows = []
            for bucket in range(buckets):
                mine = target == bucket
                here, passed = entry[mine], known[bucket::buckets]
                if len(here) or len(passed):
                    used, local = np.unique(row[np.concatenate([here, passed])], return_inverse=True)
                    n = len(here)
                    block = _packed(
                        gram[here], around[here], _steps(place[here]), _steps(local[:n]), flag[mine],
                        _steps(place[passed]), _steps(local[n:]), state[passed], keys[used],
                    )
                    rows.append((bucket, block))
            if rows:
                yield _block_rows(rows)

    return work


def _shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places whose gram occurs again, with what is known of each."""
    kinds = (np.uint64, np.uint64, np.int32, np.int32, np.int8, np.int32, np.int32, np.int8, np.int64)
    for _, table in grouped(batches, "bucket"):
        parts = []
        for block in table["block"]:
            gram, around, place, local, flag, more, of, state, keys = _unpacked(block.as_py(), *kinds)
            keys = keys.reshape(-1, 2)
            if len(more):
                yield _refs(keys[_summed(of)], _summed(more), state)
            parts.append((gram, around, flag, _summed(place), keys[_summed(local)]))
        gram, around, flag, place, key = (np.concatenate(v) for v in zip(*parts))
        if not len(gram):
            continue
        many, settled = flag & 1 > 0, flag & 2 > 0
        order, group = _equal_runs(gram, around)
        first = np.flatnonzero(np.diff(group, prepend=-1))
        weight = np.bincount(group, np.where(many, 2, 1)[order])
        # Of grams with several surroundings one place of each is looked at.
        of_class = gram[order[first]]
        same = of_class[1:] == of_class[:-1]
        mixed = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        lead = np.zeros(len(order), bool)
        lead[first] = True
        # The places of a class that one piece holds several of are covered already.
        state = np.where((weight[group] > 1) & ~many[order], COVERED, 0)
        state += np.where(lead & mixed[group] & ~settled[order], EMIT, 0)
        known = order[state > 0]
        yield _refs(key[known], place[known], state[state > 0])


def _refs(keys: np.ndarray, places: np.ndarray, state: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(places, pa.int32()), pa.array(state.astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, ["k1", "k2", "place", "state"])


def _filtered(shared):
    """Only texts whose key is marked in a bitmap; a few others pass as well."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) % np.uint64(64 * len(bits))
            hit = bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)
            yield batch.filter(pa.array(hit.astype(bool)))

    return work


def _with_found(long: DataFrame, found: DataFrame) -> DataFrame:
    """The texts with what was found in them. A bitmap of ``FILTER_BITS`` at most keeps texts without anything
    out of the join; where there are more than it can tell apart the join does the rest."""
    spark = long.sparkSession
    words = max(1, min(FILTER_BITS, 16 * found.count()) // 64)
    # The key as an unsigned number, modulo the bits.
    bit = F.expr(f"pmod(pmod(k1, {64 * words}L) + if(k1 < 0, pmod({(1 << 64) % (64 * words)}L, {64 * words}L), 0L), {64 * words}L)")
    marks = found.select(bit.alias("bit")).select(
        F.expr("shiftrightunsigned(bit, 6)").alias("word"), F.expr("shiftleft(1L, cast(bit & 63L as int))").alias("mask")
    )
    made = marks.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(words, np.uint64)
    bits[made["word"].to_numpy()] = made["mask"].to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast(bits)
    return long.mapInArrow(_filtered(shared), "k1 bigint, k2 bigint, data binary").join(found, ["k1", "k2"])


# ---- step 2: the strings of anchors in different surroundings


def _looked_at(size: int, places: np.ndarray) -> np.ndarray:
    """The places of all strings that these anchors may be the anchors of."""
    low, high = np.maximum(0, places - SPREAD + 1), np.minimum(places, size - LENGTH)
    some = low <= high
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, low[some], 1)
    np.add.at(change, high[some] + 1, -1)
    return np.flatnonzero(np.cumsum(change) > 0)


CLAIMS = "tid bigint, piece int, low int, low_tid bigint, low_at int, high int, high_tid bigint, high_at int"
_CLAIM_NAMES = [part.split()[0] for part in CLAIMS.split(", ")]
_CLAIM_KINDS = [np.int64 if part.endswith("bigint") else np.int32 for part in CLAIMS.split(", ")]


def _claims(tid: np.ndarray, place: np.ndarray, wtid: np.ndarray, wplace: np.ndarray) -> list[np.ndarray]:
    """The first and the last place in each piece of a text, with a witness each."""
    order = np.lexsort((place, tid))
    tid, place, wtid, wplace = tid[order], place[order], wtid[order], wplace[order]
    piece = place // PIECE
    new = np.flatnonzero(np.concatenate([[True], (tid[1:] != tid[:-1]) | (piece[1:] != piece[:-1])])[: len(tid)])
    end = np.append(new[1:], len(tid))[: len(new)] - 1
    columns = [tid[new], piece[new], place[new], wtid[new], wplace[new], place[end], wtid[end], wplace[end]]
    return [c.astype(k) for c, k in zip(columns, _CLAIM_KINDS)]


def _claim_blocks(columns: list[np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
    """Claims as blocks, one for each bucket of texts."""
    target = columns[0] % buckets
    order = np.argsort(target, kind="stable")
    used, first = np.unique(target[order], return_index=True)
    rows = []
    for bucket, at in zip(used.tolist(), np.split(order, first[1:])):
        rows.append((bucket, _packed(*[c[at] for c in columns])))
    if rows:
        yield _block_rows(rows)


def _merged_claims(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of all claims to a piece of a text the first and the last."""
    for _, table in grouped(batches, "bucket"):
        parts = [_unpacked(b.as_py(), *_CLAIM_KINDS) for b in table["block"]]
        tid, piece, low, low_tid, low_at, high, high_tid, high_at = (np.concatenate(v) for v in zip(*parts))
        by_low, by_high = np.lexsort((low, piece, tid)), np.lexsort((high, piece, tid))
        new = np.flatnonzero(np.concatenate([[True], (np.diff(tid[by_low]) != 0) | (np.diff(piece[by_low]) != 0)]))
        first, last = by_low[new], by_high[np.append(new[1:], len(tid)) - 1]
        columns = [tid[first], piece[first], low[first], low_tid[first], low_at[first], high[last], high_tid[last], high_at[last]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _CLAIM_NAMES)


def _witnessed(order: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each place of an order that brings equals together, another one of its group: the first one's witness
    is the second, all others' the first."""
    first = np.flatnonzero(np.diff(group, prepend=-1))
    several = np.bincount(group) > 1
    witness = order[first][group]
    witness[first[several]] = order[first[several] + 1]
    return witness


def _string_entries(buckets: int):
    """As :func:`_gram_entries`, for the strings of the anchors to be looked at: one entry a piece for each
    different string. Claims that a piece settles itself are passed on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, 1, DENSE_CHUNK):
            tids = np.array([r[0] for r in piece], np.int64)
            asked = [_looked_at(len(t), np.array(p)[np.array(s) & EMIT > 0]) for _, t, p, s in piece]
            row = np.repeat(np.arange(len(piece)), [len(a) for a in asked])
            if not len(row):
                continue
            place = np.concatenate(asked)
            a, b = Stream([r[1] for r in piece]).digests(row, place)
            b = b.astype(np.uint32)
            order, group = _equal_runs(a, b)
            many = np.bincount(group) > 1
            inside = many[group]
            own, other = order[inside], _witnessed(order, group)[inside]
            settled = _claims(tids[row[own]], place[own], tids[row[other]], place[other])
            entry = order[np.flatnonzero(np.diff(group, prepend=-1))]
            in_order = np.argsort(entry)
            entry, many = entry[in_order], many[in_order]
            target = a[entry] % np.uint64(buckets)
            rows = []
            for bucket in range(buckets):
                mine = target == bucket
                here = entry[mine]
                passed = [c[bucket::buckets] for c in settled]
                if len(here) or len(passed[0]):
                    used, local = np.unique(row[here], return_inverse=True)
                    block = _packed(a[here], b[here], _steps(place[here]), _steps(local), many[mine], tids[used], *passed)
                    rows.append((bucket, block))
            yield _block_rows(rows)

    return work


def _shared_strings(buckets: int):
    """Claims to the strings that occur again."""
    kinds = (np.uint64, np.uint32, np.int32, np.int32, bool, np.int64, *_CLAIM_KINDS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in grouped(batches, "bucket"):
            parts, settled = [], []
            for block in table["block"]:
                a, b, place, local, many, tids, *known = _unpacked(block.as_py(), *kinds)
                settled.append(known)
                parts.append((a, b, _summed(place), tids[_summed(local)] if len(a) else tids[:0], many))
            a, b, place, tid, many = (np.concatenate(v) for v in zip(*parts))
            order, group = _equal_runs(a, b)
            if len(a):
                # Entries that stand for more than one place have settled theirs already.
                open_ = (np.bincount(group) > 1)[group] & ~many[order]
                own, other = order[open_], _witnessed(order, group)[open_]
                if len(own):
                    settled.append(_claims(tid[own], place[own], tid[other], place[other]))
            yield from _claim_blocks([np.concatenate(v) for v in zip(*settled)], buckets)

    return work


# ---- step 3: runs, exchange, merge


def _front_coded(strings: list[bytes], counts: list[int]) -> bytes:
    """Sorted strings, of each only what its predecessor does not share, with how often they occur."""
    matrix = np.frombuffer(b"".join(strings), np.uint8).reshape(len(strings), LENGTH)
    differs = matrix[1:] != matrix[:-1]
    shared = np.where(differs.any(1), differs.argmax(1), LENGTH)
    prefix = np.concatenate([[0], shared]).astype(np.uint16)
    keep = np.arange(LENGTH)[None, :] >= prefix[:, None]
    return _packed(prefix, np.array(counts, np.uint32), matrix[keep])


def _decoded(block: bytes) -> Iterator[tuple[bytes, int, int]]:
    """Strings of a run with the common prefix to the one before and their count."""
    prefix, counts, rest = _unpacked(block, np.uint16, np.uint32, np.uint8)
    rest = rest.tobytes()
    at, text = 0, b""
    for shared, count in zip(prefix.tolist(), counts.tolist()):
        n = LENGTH - shared
        text = text[:shared] + rest[at : at + n]
        at += n
        yield text, shared, count


def _first_difference(a: bytes, b: bytes, start: int) -> int:
    """The first place from ``start`` on at which two strings of one length differ."""
    n = len(a)
    step = 16
    while start < n:
        x, y = a[start : start + step], b[start : start + step]
        if x != y:
            bits = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return start + len(x) - (bits.bit_length() + 7) // 8
        start += step
        step *= 2
    return n


def merged(runs: list[Iterator[tuple]]) -> Iterator[tuple[bytes, int, int]]:
    """The sorted union of sorted runs of (string, prefix shared with the run's last, ...), each with the
    prefix that it shares with the union's last, by a loser tree.

    A head's prefix counts against the last winner. Of two heads the one that shares more is
    the smaller; only if both share the same are bytes compared, from there on, and
    the loser keeps the prefix found. So no byte of a known prefix is looked at twice.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[tuple | None] = [next(r, None) for r in runs] + [None] * (size - len(runs))
    lcp = [0] * size

    def beats(i: int, j: int) -> bool:
        """Whether head i is not behind head j; the loser's prefix becomes the one with the winner."""
        a, b = heads[i], heads[j]
        if b is None:
            return True
        if a is None:
            return False
        if lcp[i] != lcp[j]:
            return lcp[i] > lcp[j]
        h = _first_difference(a[0], b[0], lcp[i])
        if h == len(a[0]) or a[0][h] < b[0][h]:
            lcp[j] = h
            return True
        lcp[i] = h
        return False

    tree = [0] * size

    def build(node: int) -> int:
        if node >= size:
            return node - size
        left, right = build(2 * node), build(2 * node + 1)
        winner, loser = (left, right) if beats(left, right) else (right, left)
        tree[node] = loser
        return winner

    winner = build(1)
    while heads[winner] is not None:
        text, _, *rest = heads[winner]
        yield text, lcp[winner], *rest
        heads[winner] = following = next(runs[winner], None)
        if following is not None:
            lcp[winner] = following[1]
        node = (winner + size) // 2
        while node:
            other = tree[node]
            if not beats(winner, other):
                tree[node], winner = winner, other
            node //= 2


RESULT = "k1 bigint, k2 bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<int>"
WORK = f"part int, run string, block binary, {RESULT}"
_WORK_SCHEMA = pa.schema(
    [("part", pa.int32()), ("run", pa.string()), ("block", pa.binary()), ("k1", pa.int64()), ("k2", pa.int64())]
    + [("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.int32()))]
)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _WORK_SCHEMA)], schema=_WORK_SCHEMA)


def _spans(starts: np.ndarray) -> list[tuple[int, int]]:
    """The maximal runs of bytes that strings at sorted places cover."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > LENGTH) + 1
    first = starts[np.concatenate([[0], cut])]
    last = starts[np.concatenate([cut - 1, [len(starts) - 1]])]
    return [(int(s), int(e) + LENGTH) for s, e in zip(first, last)]


def _own_strings(size: int, places: np.ndarray) -> np.ndarray:
    """The strings that prove covered anchors: the one at the anchor or the text's last one, and the text's first
    one if no anchor need stand before."""
    some = places[np.maximum(0, places - SPREAD + 1) <= size - LENGTH]
    head = np.zeros(int(len(some) > 0 and some.min() < SPREAD), np.int64)
    return np.concatenate([np.minimum(some, size - LENGTH), head])


def _spans_and_runs(splitters: list[bytes], failed: frozenset[bytes]):
    """From texts with their claims: what goes from each text, and the strings behind it as a sorted run, cut at
    the splitters."""
    width = len(splitters) + 1

    def result(text: bytes, starts: np.ndarray) -> tuple:
        spans = _spans(starts)
        kept, at = hashlib.sha256(), 0
        for start, end in spans:
            kept.update(text[at:start])
            at = end
        kept.update(text[at:])
        return sum(e - s for s, e in spans), len(spans), kept.hexdigest(), [v for s in spans for v in s]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, 2):
            claimed, asked = [], []
            for _, _, text, places, states, claims, witnesses in piece:
                covered = np.array(places, np.int64)[np.array(states) & COVERED > 0]
                mine = np.union1d(_own_strings(len(text), covered), np.array(claims or [], np.int64))
                claimed.append(mine)
                asked.append(np.union1d(mine, np.array(witnesses or [], np.int64)))
            row = np.repeat(np.arange(len(piece)), [len(v) for v in asked])
            place = np.concatenate(asked).astype(np.int64)
            digest = np.stack(Stream([r[2] for r in piece]).digests(row, place), 1)
            ok = np.ones(len(row), bool)
            if failed:
                ok = np.array([d.tobytes() not in failed for d in digest], bool)
            ends = np.cumsum([len(v) for v in asked])
            rows = []
            for k, (k1, k2, text, *_) in enumerate(piece):
                here = slice(ends[k] - len(asked[k]), ends[k])
                starts = asked[k][ok[here] & np.isin(asked[k], claimed[k])]
                rows.append((k % width, None, None, k1, k2, *result(text, starts)))
            yield _rows(rows)
            row, place, digest = row[ok], place[ok], digest[ok]
            order, group = _equal_runs(digest[:, 0], digest[:, 1])
            lead = order[np.flatnonzero(np.diff(group, prepend=-1))]
            strings = [piece[r][2][p : p + LENGTH] for r, p in zip(row[lead].tolist(), place[lead].tolist())]
            run = sorted(zip(strings, np.bincount(group).tolist())) if len(order) else []
            edges = [0, *[bisect_left(run, (s,)) for s in splitters], len(run)]
            name, cut = uuid.uuid4().hex, []
            for part, (low, high) in enumerate(zip(edges, edges[1:])):
                if low < high:
                    block = _front_coded(*map(list, zip(*run[low:high])))
                    cut.append((part, name, block, *[None] * 6))
            if cut:
                yield _rows(cut)

    return work


def _unproven(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge each range's runs: passes results on, and adds as blocks the digests of strings that turn out to
    stand alone."""
    for part, table in grouped(batches, "part"):
        has_block = table["run"].is_valid()
        for batch in table.filter(table["run"].is_null()).to_batches():
            yield batch
        blocks = table.filter(has_block)["block"].to_pylist()
        alone: list[bytes] = []
        before, total = b"", 2
        for text, shared, count in merged([_decoded(b) for b in blocks]):
            if shared < LENGTH:
                if total == 1:
                    alone.append(before)
                before, total = text, 0
            total += count
        if total == 1:
            alone.append(before)
        if alone:
            yield _rows([(part, "alone", _digest(v), *[None] * 6) for v in alone])


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few of each text's strings."""
    for batch in batches:
        out = []
        for text, places in zip(batch.column(0), batch.column(1).to_pylist()):
            text = text.as_py()
            picked = sorted(places)[:: max(1, len(places) // STRINGS)]
            out += [text[p : p + LENGTH] for p in picked]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["string"])


def _splitters(texts: DataFrame) -> list[bytes]:
    """Strings that cut what is to be sorted into ranges of about ``RANGE_BYTES``, from a bounded sample."""
    n, strings = texts.agg(F.count(F.lit(1)), F.sum(F.size("places"))).first()
    if not n:
        return []
    least = texts.sparkSession.sparkContext.defaultParallelism
    ranges = max(-(-int(strings) * LENGTH // RANGE_BYTES), least)
    some = texts.select("data", "places").sample(min(1.0, SAMPLE / n), seed=1)
    sample = sorted(some.mapInArrow(_samples, "string binary").toArrow()["string"].to_pylist())
    return sorted({sample[len(sample) * k // ranges] for k in range(1, ranges)}) if sample else []


def _proven(joined: DataFrame, splitters: list[bytes]) -> DataFrame:
    """Spans of all texts whose strings the merge has proven."""
    failed: frozenset[bytes] = frozenset()
    while True:
        worked = joined.mapInArrow(_spans_and_runs(splitters, failed), WORK)
        dealt = worked.repartition(len(splitters) + 1, "part").sortWithinPartitions("part")
        merged_ = materialize(dealt.mapInArrow(_unproven, WORK), "proven")
        wrong = merged_.where("run IS NOT NULL").select("block").limit(MAX_FAILED + 1).collect()
        if len(wrong) > MAX_FAILED:
            raise RuntimeError(f"more than {MAX_FAILED} digests stand for different strings")
        if not wrong:
            return merged_.where("run IS NULL").drop("part", "run", "block")
        # Failed strings are not sorted again, so the rounds end.
        failed |= {bytes(r.block) for r in wrong}


def repeated_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """k1, k2 (a 128-bit key of the text's bytes), n_removed, n_spans, kept_sha256 and the removed ``spans``
    (start, end, start, end, ...) of every text that may lose something, one row for each
    different text."""
    spark = docs.sparkSession
    long = keyed(docs, text).where(F.octet_length("data") >= LENGTH).select("k1", "k2", "data")
    volume = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(volume) // BUCKET_BYTES))

    def in_buckets(entries: DataFrame) -> DataFrame:
        return entries.repartition(width, "bucket").sortWithinPartitions("bucket")

    entries = long.mapInArrow(_gram_entries(width), BLOCKS)
    shared = in_buckets(entries).mapInArrow(_shared_anchors, "k1 bigint, k2 bigint, place int, state int")
    # A text's anchors are fewer than its bytes, so they fit where it does.
    found = shared.groupBy("k1", "k2").agg(F.collect_set(F.struct("place", "state")).alias("found"))
    texts = _with_found(long, materialize(found, "found")).select(
        F.monotonically_increasing_id().alias("tid"), "k1", "k2", "data", F.col("found.place").alias("places"),
        F.col("found.state").alias("states"),
    )
    texts = materialize(texts, "texts")
    strings = texts.select("tid", "data", "places", "states").mapInArrow(_string_entries(width), BLOCKS)
    settled = in_buckets(strings).mapInArrow(_shared_strings(width), BLOCKS)
    claims = materialize(in_buckets(settled).mapInArrow(_merged_claims, CLAIMS), "claims")
    ends = claims.select("tid", F.explode(F.array("low", "high")).alias("place"), F.lit(True).alias("own"))
    seen = claims.select(
        F.explode(
            F.array(
                F.struct(F.col("low_tid").alias("tid"), F.col("low_at").alias("place")),
                F.struct(F.col("high_tid").alias("tid"), F.col("high_at").alias("place")),
            )
        ).alias("w")
    ).select("w.tid", "w.place", F.lit(False).alias("own"))
    asked = ends.union(seen).groupBy("tid").agg(
        F.collect_set(F.when(F.col("own"), F.col("place"))).alias("claims"),
        F.collect_set(F.when(~F.col("own"), F.col("place"))).alias("witnesses"),
    )
    joined = texts.join(asked, "tid", "left").select("k1", "k2", "data", "places", "states", "claims", "witnesses")
    return _proven(joined, _splitters(texts)).dropDuplicates(["k1", "k2"])


def keyed(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The texts' bytes as ``data`` and two 64-bit hashes of them as ``k1`` and ``k2``."""
    data = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    return docs.select(data.alias("data"), *[F.col(c) for c in keep]).withColumns(
        {"k1": F.xxhash64("data"), "k2": F.xxhash64(F.lit(1), "data")}
    )


def dedup_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (digest of the remaining bytes) and the removed
    ``spans`` of every document."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    narrow = keyed(rows, keep=("doc_id",)).select(
        "doc_id", "k1", "k2", F.octet_length("data").cast("long").alias("n_bytes"), F.sha2("data", 256).alias("_sha")
    )
    found = repeated_spans(rows)
    none = F.lit(0).cast("long")
    long = narrow.where(F.col("n_bytes") >= LENGTH).join(found, ["k1", "k2"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "_sha").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast("array<int>")).alias("spans"),
    )
    # Shorter texts, empty ones among them, have nothing to look up.
    short = narrow.where(F.col("n_bytes") < LENGTH).select(
        "doc_id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"), F.col("_sha").alias("kept_sha256"),
        F.array().cast("array<int>").alias("spans"),
    )
    return long.union(short)
