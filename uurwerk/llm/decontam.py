"""Benchmark decontamination: a broadcast hash set of normalised test windows.

Every document is scanned once. Words are numbered by the benchmark's own
vocabulary, so a window can only match inside a stretch of known words; there a
polynomial hash of each window is looked up in the sorted hashes of the
benchmark's windows, and every hit is verified word by word.

Edge cases: a null text has no words; an item without words has no window; a
null item id is reported as the empty string; repeated rows are scanned each for
itself. Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uurwerk.llm.common import sheltered
from uurwerk.session import materialize

WINDOW = 13
# About 20 bytes a word reach each executor: 5M words are 100 MB.
MAX_BROADCAST_WORDS = 5_000_000
MAX_BROADCAST_BYTES = 64 << 20
PIECE_WORDS = 10_000

# A-Z become a-z; digits, a-z and everything beyond ASCII are word characters.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def _pieces(window: int):
    """Items cut into overlapping pieces, so that one long item cannot exceed a block."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                for start in range(0, max(len(words) - window + 1, min(len(words), 1)), PIECE_WORDS):
                    part = words[start : start + PIECE_WORDS + window - 1]
                    out.append((item or "", b" ".join(part).decode("utf-8", "surrogatepass"), len(part)))
            yield pa.RecordBatch.from_pydict(
                {
                    "item": pa.array([o[0] for o in out], pa.string()),
                    "words": pa.array([o[1] for o in out], pa.string()),
                    "n": pa.array([o[2] for o in out], pa.int64()),
                }
            )

    return cut


def _hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """One hash for each window of ``length`` words."""
    n = len(ids) - length + 1
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(length):
            out = out * _FACTOR + ids[k : k + n].astype(np.uint64) + np.uint64(1)
            out ^= out >> np.uint64(29)
    return out


class WindowIndex:
    """The benchmark's windows: their words as numbers, and for each window length
    the sorted hashes with the place and item they come from."""

    def __init__(self, pieces: list[tuple[str, str]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        self.items = [item for item, _ in pieces]
        by_length: dict[int, list[tuple[np.ndarray, int, int]]] = {}
        stream, at = [], 0
        for k, (_, text) in enumerate(pieces):
            ids = np.array([number(w, len(self.vocabulary)) for w in text.encode("utf-8", "surrogatepass").split()])
            length = min(window, len(ids))
            by_length.setdefault(length, []).append((_hashes(ids, length), at, k))
            stream.append(ids)
            at += len(ids)
        self.stream = np.concatenate(stream) if stream else np.empty(0, int)
        self.tables = {}
        for length, parts in by_length.items():
            hashes = np.concatenate([h for h, _, _ in parts])
            places = np.concatenate([np.arange(at, at + len(h)) for h, at, _ in parts])
            owners = np.concatenate([np.full(len(h), k) for h, _, k in parts])
            order = np.argsort(hashes, kind="stable")
            self.tables[length] = hashes[order], places[order], owners[order]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word intervals (end exclusive) that some window covers, and the items."""
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0]))))
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        for length, (hashes, places, owners) in self.tables.items():
            for start, end in edges.reshape(-1, 2)[edges[1::2] - edges[::2] >= length]:
                own = _hashes(ids[start:end], length)
                low = np.searchsorted(hashes, own, "left")
                high = np.searchsorted(hashes, own, "right")
                for k in np.flatnonzero(high > low):
                    here, hit = ids[start + k : start + k + length], False
                    for entry in range(low[k], high[k]):
                        if np.array_equal(here, self.stream[places[entry] : places[entry] + length]):
                            items.add(self.items[owners[entry]])
                            hit = True
                    if hit:
                        found.append((int(start + k), int(start + k + length)))
        return _merged(found), items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


_built: dict[str, WindowIndex] = {}


def _index(token: str, pieces, window: int) -> WindowIndex:
    """Built once in each worker."""
    if token not in _built:
        _built.clear()
        _built[token] = WindowIndex(pieces.value, window)
    return _built[token]


HITS = "struct<n_words:bigint,spans:array<struct<start:int,end:int>>,items:array<string>>"


def _scan(token: str, pieces, window: int, text: str, into: str, first: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(token, pieces, window)
        kind = pa.struct(
            [
                ("n_words", pa.int64()),
                ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ("items", pa.list_(pa.string())),
            ]
        )
        for batch in batches:
            at = batch.schema.get_field_index(text)
            earlier = repeat(None) if first else batch.column(batch.schema.get_field_index(into))
            out = []
            for value, before in zip(batch.column(at), earlier):
                words = words_of(value.as_py())
                spans, items = index.hits(words)
                if before is not None:
                    before = before.as_py()
                    spans = _merged(spans + [(s["start"], s["end"]) for s in before["spans"]])
                    items |= set(before["items"])
                out.append(
                    {
                        "n_words": len(words),
                        "spans": [{"start": s, "end": e} for s, e in spans],
                        "items": sorted(items),
                    }
                )
            columns = [c for n, c in zip(batch.schema.names, batch.columns) if n != into]
            names = [n for n in batch.schema.names if n != into]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, kind)], [*names, into])

    return scan


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    into: str = "hits",
    max_words: int = MAX_BROADCAST_WORDS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` with a struct ``into``: the number of words, the merged word
    intervals that windows of the benchmark cover, and the items they belong to.

    The benchmark is read in blocks of at most ``max_words`` words and ``max_bytes`` bytes, as
    a text without spaces may be one word; one block is the normal case. Further blocks each scan the documents again and add to the
    struct, with the table written in between. ``into`` must be a free name.
    """
    if into in docs.columns:
        raise ValueError(f"{into} is already a column")
    spark = docs.sparkSession
    pieces = benchmark.select(F.col(item).cast("string"), F.col(item_text)).mapInArrow(
        _pieces(window), "item string, words string, n bigint"
    )
    pieces = materialize(pieces, "benchmark_pieces")
    total, size = (v or 0 for v in pieces.agg(F.sum("n"), F.sum(F.octet_length("words") + F.octet_length("item"))).first())
    # Blocks are hash shares, so aim at half the bounds; a piece is small against them.
    blocks = 1
    if total > max_words or size > max_bytes:
        blocks = int(np.ceil(max(2 * total / max_words, 2 * size / max_bytes)))
    schema = T.StructType([*docs.schema.fields, T.StructField(into, T._parse_datatype_string(HITS))])
    for k in range(blocks):
        mine = pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == k).select("item", "words")
        held = [tuple(r) for r in mine.collect()]
        shared = spark.sparkContext.broadcast(held)
        token = f"{id(shared)}-{k}-{hashlib.sha1(repr((len(held), held[:1])).encode()).hexdigest()}"
        docs = docs.mapInArrow(_scan(token, shared, window, text, into, k == 0), schema)
        if k + 1 < blocks:
            docs = materialize(docs, "scanned")
    return docs


def hit_words(into: str = "hits"):
    """Number of document words inside hits."""
    return F.aggregate(
        F.col(f"{into}.spans"), F.lit(0).cast("long"), lambda acc, s: acc + (s["end"] - s["start"]).cast("long")
    )


def contaminated(into: str = "hits", share: int = 20):
    """At least one hit, and hits cover at least one word in ``share``."""
    return (hit_words(into) > 0) & (share * hit_words(into) >= F.col(f"{into}.n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: int = 20, **options) -> DataFrame:
    """``docs`` without contaminated documents, columns as they were."""
    docs, back = sheltered(docs, options.get("text", "text"))
    found = find_hits(docs, benchmark, into="_hits", **options)
    return back(found.where(~contaminated("_hits", share)))


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the hit passages cut out of the text, from the first character
    of a passage's first word to the last of its last; other text stays as it is."""
    docs, back = sheltered(docs, text)
    found = find_hits(docs, benchmark, text=text, into="_hits", **options)
    width = len(docs.columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = [
                _without(t, [(s["start"], s["end"]) for s in h["spans"]]) if h["spans"] else t
                for t, h in zip(batch.column(at).to_pylist(), batch.column(width).to_pylist())
            ]
            columns = list(batch.columns[:width])
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:width])

    return back(found.mapInArrow(cut, docs.schema))


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    raw = text.encode("utf-8", "surrogatepass")
    plain = np.frombuffer(raw.translate(_TABLE), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], plain.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for first, last in spans:
        out.append(raw[at : starts[first]])
        at = ends[last - 1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")
