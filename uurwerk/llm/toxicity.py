"""Toxicity behind a noisy channel.

Insults are written around filters: digits and signs for letters, letters apart,
letters repeated. A token that looks so is turned into a lattice of what each of
its characters may stand for, and a Viterbi search under a character trigram
model of the corpus picks the reading. Words of the plain and the restored text
are then scored.

The character model counts the trigrams of all documents. The scorer is fitted on
at most ``MAX_LABELLED`` labelled rows outside the held-out fold: each word and word
beginning has a shrunken log-odds of the label, and a logistic curve over a document's
strongest ones gives the score; labelled documents are scored there as if they had not
been counted.

Edge cases: null and empty texts have no words and get the score of a text without
evidence; without labels of both kinds every score is 0; a label that is null is
ignored, of several for one document the largest counts; other columns are never
read, so they cannot clash.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uurwerk.llm.common import held_out, sheltered
from uurwerk.session import materialize

MAX_LABELLED = 20_000
MAX_FEATURES = 50_000
MAX_BROADCAST_LINES = 200_000
MIN_DOCS = 2
# Pseudo-counts of a feature's log-odds, and the documents at which it counts half.
PRIOR = 0.5
HALF = 5.0
TOP = 3
CACHE = 150_000
# Letters of the model besides a-z.
ACCENTED = "àáâäãåæçèéêëìíîïñòóôöõøœùúûüýÿß"
ALPHABET = "abcdefghijklmnopqrstuvwxyz" + ACCENTED
EDGE, OTHER = len(ALPHABET), len(ALPHABET) + 1
SYMBOLS = len(ALPHABET) + 2
_CODE = np.full(0x110000, EDGE, np.int32)
for _i, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _i
    if len(_c.upper()) == 1:
        _CODE[ord(_c.upper())] = _i

# What a sign may stand for.
READINGS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
    "*": "aeiou", "#": "aeiou", "%": "aeiou",
}
JOINERS = set(".-_*~'’ ")
_KEEP, _STANDS, _DROP, _GAP, _BREAK, _SINGLE, _DOUBLE = (math.log(p) for p in (0.9, 0.2, 0.3, 0.1, 0.02, 0.7, 0.3))
_LETTER = r"[^\W\d_]"
_WORDS = re.compile(rf"{_LETTER}+")
_ODD = re.compile(rf"(?=.*{_LETTER})(?:.*[0-9@$!|+€£¡*#%(.\-_~ ]|.*({_LETTER})\1\1)", re.DOTALL)
_TRIPLE = re.compile(r"(.)\1\1")
_STOPS = ".,;:?\"'()[]{}"
# Sentence marks and rows of signs around a token are no part of a word.
_MARKS = re.compile(r"^(?:[\"'(\[{<.,;:!?…]|([$&%#*@!+])\1+)+|(?:[\"')\]}>.,;:!?…]|([$&%#*@!+])\2+)+$")


class CharacterModel:
    """Interpolated trigram model over letters, the word's edge and other signs."""

    def __init__(self, counts: np.ndarray):
        tri = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS) + 0.0
        bi, uni = tri.sum(0), tri.sum((0, 1))
        one = (uni + 1) / (uni.sum() + SYMBOLS)
        two = (bi + 5 * one) / (bi.sum(1, keepdims=True) + 5)
        self.log = np.log((tri + 5 * two[None]) / (tri.sum(2, keepdims=True) + 5)).astype(np.float32)

    def restore(self, token: str) -> str:
        """The likeliest reading of a token; a space where a word ends."""
        beams: dict[tuple[int, int], tuple[float, str]] = {(EDGE, EDGE): (0.0, "")}
        for options in _lattice(token.lower()):
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (cost, text) in beams.items():
                for letters, price in options:
                    x, y, total = a, b, cost + price
                    for c in letters:
                        code = int(_CODE[ord(c)])
                        total += float(self.log[x, y, code])
                        x, y = y, code
                    if (x, y) not in after or total > after[x, y][0]:
                        after[x, y] = total, text + letters
            beams = after
        return max(
            ((cost + float(self.log[a, b, EDGE]), text) for (a, b), (cost, text) in beams.items()),
            key=lambda e: (e[0], e[1]),
        )[1]


def _lattice(token: str) -> Iterator[list[tuple[str, float]]]:
    """For each stretch of equal characters its readings with log probabilities."""
    at = 0
    while at < len(token):
        c, end = token[at], at + 1
        while end < len(token) and token[end] == c:
            end += 1
        n, at = end - at, end
        letters = [(c, _KEEP)] if c.isalpha() else [(r, _STANDS) for r in READINGS.get(c, "")]
        options = []
        for letter, price in letters:
            if n == 1:
                options.append((letter, price))
            else:
                options += [(letter, price + _SINGLE), (letter * 2, price + _DOUBLE)]
        if not c.isalpha():
            if c in JOINERS:
                options.append(("", _DROP))
            options.append((" ", _GAP if c == " " else _BREAK))
        yield options


def count_trigrams(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Trigram counts over the whole texts of all documents; other signs part words."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for value in batch.column(0):
                value = value.as_py()
                if not value:
                    continue
                for at in range(0, len(value), 1 << 20):
                    piece = value[max(0, at - 2) : at + (1 << 20)]
                    codes = _CODE[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)]
                    if not at:
                        codes = np.concatenate(([EDGE, EDGE], codes))
                    if len(codes) > 2:
                        grams = (codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:]
                        total += np.bincount(grams, minlength=SYMBOLS**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"gram": pa.array(seen, pa.int32()), "n": pa.array(total[seen], pa.int64())})

    rows = docs.select(F.col(f"`{text}`")).mapInArrow(partial, "gram int, n bigint")
    # At most SYMBOLS ** 3 rows, whatever the corpus.
    found = rows.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SYMBOLS**3, np.int64)
    counts[found["gram"].to_numpy()] = found["n"].to_numpy()
    return counts


class Reader:
    """Distinct words of a text, plain and restored, with a bounded cache by token."""

    def __init__(self, model: CharacterModel):
        self.model = model
        self.cache: dict[str, tuple[str, ...]] = {}

    def words(self, token: str) -> tuple[str, ...]:
        got = self.cache.get(token)
        if got is None:
            plain = token.strip(_STOPS).lower()
            if plain.isalpha() and not _TRIPLE.search(plain):
                got = (plain,)
            else:
                found = _WORDS.findall(token.lower())
                bare = _MARKS.sub("", token)
                if _ODD.match(bare):
                    found += self.model.restore(bare).split()
                got = tuple(dict.fromkeys(found))
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[token] = got
        return got

    def tokens(self, text: str | None) -> set[str]:
        """The tokens of a text; a row of different single letters counts as one more, as
        do its rows without the first and the last, which may be words of their own."""
        parts = text.split() if text else []
        out = set(parts)
        single = np.fromiter(map(len, parts), np.int64, len(parts)) == 1
        if single.any():
            edges = np.flatnonzero(np.diff(np.concatenate(([0], single.view(np.int8), [0]))))
            for start, end in edges.reshape(-1, 2):
                if end - start < 3 or len(set(parts[start:end])) == 1:
                    continue
                out.add(" ".join(parts[start:end]))
                if end - start >= 4:
                    out |= {" ".join(parts[start + 1 : end]), " ".join(parts[start : end - 1])}
        return out


def features_of(word: str) -> list[str]:
    """The word, and its beginnings of four to six letters."""
    return [word, *(word[:n] + "*" for n in (4, 5, 6) if len(word) > n)]


def _labelled(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """Text, label and ``repeated`` of at most ``limit`` training rows, the first by a hash
    of the id. Of texts equal but for case and white space one stays for each label.
    ``repeated`` numbers the lines of 40 characters and more whose words another text
    of the label counts, so that a shared line counts as one document's."""
    known = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(F.col("doc_id").isNotNull() & ~held_out())
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).withColumnRenamed("doc_id", "_id")
    found = docs.join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    even = F.lower(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")))
    found = found.select("text", (F.col("toxic") > 0).cast("int").alias("toxic"), F.md5(even.cast("binary")).alias("_mark"))
    found = materialize(found.groupBy("_mark", "toxic").agg(F.min("text").alias("text")), "distinct")
    lines = found.select("_mark", "toxic", F.posexplode(F.split("text", "\n", -1)).alias("at", "line")).where(F.length("line") >= 40)
    lines = lines.select("_mark", "toxic", "at", F.md5(F.col("line").cast("binary")).alias("line"))
    # The first place of a line that occurs more than once, at most half the labelled lines.
    first = lines.groupBy("line", "toxic").agg(F.min(F.struct("_mark", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = materialize(first.where("n > 1").drop("n"), "repeated_lines")
    if first.count() <= MAX_BROADCAST_LINES:
        first = F.broadcast(first)
    later = lines.join(first, ["line", "toxic"]).where(F.struct("_mark", "at") != F.col("first"))
    later = later.groupBy("_mark", "toxic").agg(F.collect_list("at").alias("repeated"))
    return found.join(later, ["_mark", "toxic"], "left").select("text", "toxic", "repeated")


def _first_told(text: str | None, repeated: list[int] | None) -> str | None:
    """The text without the lines that another text counts."""
    if not text or not repeated:
        return text
    skip = set(repeated)
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in skip)


def _count_features(model):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(CharacterModel(model.value))
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, toxic, repeated in zip(*(batch.column(k).to_pylist() for k in range(3))):
                text = _first_told(text, repeated)
                words = {w for t in reader.tokens(text) for w in reader.words(t)}
                for feature in {f for w in words for f in features_of(w)}:
                    seen.setdefault(feature, [0, 0])[toxic > 0] += 1
            yield pa.RecordBatch.from_pydict(
                {
                    "feature": pa.array(list(seen), pa.string()),
                    "clean": pa.array([n for n, _ in seen.values()], pa.int64()),
                    "toxic": pa.array([n for _, n in seen.values()], pa.int64()),
                }
            )

    return count


_UNKNOWN = object()


class Scorer:
    """A document's strongest evidence and the logistic curve over it."""

    def __init__(self, counts, features, totals, curve=None):
        self.reader = Reader(CharacterModel(counts))
        self.features, self.totals, self.curve = features, totals, curve
        self.cache: dict = {}

    def weight(self, clean: int, toxic: int, own: int | None = None) -> float:
        """Shrunken log-odds; ``own``: a label to take out of the counts first."""
        n_clean, n_toxic = self.totals
        if own is not None:
            # A repeated line's words may not have been counted from this document.
            clean, toxic = max(0, clean - (own == 0)), max(0, toxic - (own == 1))
            n_clean, n_toxic = n_clean - (own == 0), n_toxic - (own == 1)
        odds = math.log((toxic + PRIOR) / (n_toxic + 2 * PRIOR) * (n_clean + 2 * PRIOR) / (clean + PRIOR))
        return odds * toxic / (toxic + HALF)

    def strongest(self, token: str, own: int | None) -> tuple[float, str] | None:
        """The token's strongest feature and its weight, if it has any."""
        found = [f for w in self.reader.words(token) for f in features_of(w) if f in self.features]
        return max(((self.weight(*self.features[f], own), f) for f in found), default=None)

    def evidence(self, text: str | None, own: int | None = None) -> list[float]:
        best: dict[str, float] = {}
        for token in self.reader.tokens(text):
            got = self.cache.get((token, own) if own is not None else token, _UNKNOWN)
            if got is _UNKNOWN:
                got = self.strongest(token, own)
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                self.cache[(token, own) if own is not None else token] = got
            if got:
                best[got[1]] = got[0]
        strongest = sorted(best.values(), reverse=True)[:TOP]
        return [max(w, 0.0) for w in strongest] + [0.0] * (TOP - len(strongest))

    def score(self, text: str | None) -> float:
        if self.curve is None:
            return 0.0
        value = float(np.dot(self.curve[:-1], self.evidence(text)) + self.curve[-1])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, value))))


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Logistic regression by damped Newton steps with a small ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = 1e-2 * np.eye(len(w))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + ridge, x.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED):
    """A broadcast of what :class:`Scorer` needs: character counts, features with their
    counts (at most ``MAX_FEATURES``), totals and curve."""
    spark = docs.sparkSession
    counts = count_trigrams(docs)
    held = spark.sparkContext.broadcast(counts)
    sample = materialize(_labelled(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), max_labelled), "labelled")
    got = {bool(r.toxic): r.n for r in sample.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = got.get(False, 0), got.get(True, 0)
    if not all(totals):
        return spark.sparkContext.broadcast((counts, {}, totals, None))
    parts = sample.mapInArrow(_count_features(held), "feature string, clean bigint, toxic bigint")
    table = parts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log(
        (F.col("toxic") + PRIOR) / (totals[1] + 2 * PRIOR) * (totals[0] + 2 * PRIOR) / (F.col("clean") + PRIOR)
    )
    strong = table.where(F.col("toxic") >= MIN_DOCS).withColumn("odds", odds).where("odds > 0.5")
    rows = strong.orderBy(F.desc(F.col("odds") * F.col("toxic")), "feature").limit(MAX_FEATURES).collect()
    features = {r.feature: (r.clean, r.toxic) for r in rows}
    model = spark.sparkContext.broadcast((counts, features, totals, None))

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model.value)
        for batch in batches:
            labels = [int(t > 0) for t in batch.column(1).to_pylist()]
            found = [scorer.evidence(t, y) for t, y in zip(batch.column(0).to_pylist(), labels)]
            yield pa.RecordBatch.from_pydict(
                {"x": pa.array(found, pa.list_(pa.float64())), "y": pa.array(labels, pa.int32())}
            )

    # At most ``max_labelled`` labelled documents (more only if an id repeats).
    seen = sample.select("text", "toxic").mapInArrow(evidence, "x array<double>, y int").toArrow()
    x = np.array(seen["x"].to_pylist(), float).reshape(-1, TOP)
    curve = fit_curve(x, seen["y"].to_numpy().astype(float))
    return spark.sparkContext.broadcast((counts, features, totals, curve))


def with_score(docs: DataFrame, model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` and a double column ``into``, which must be a free name."""
    if into in docs.columns:
        raise ValueError(f"{into} is already a column")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            scores = [scorer.score(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, into]
            )

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())]))


def restore_text(text: str, model: CharacterModel) -> str:
    """The text with every odd token replaced by its reading, rows of single letters
    joined; other tokens and the white space between stay."""
    reader = Reader(model)

    def plain(match: re.Match) -> str:
        token = match.group()
        bare = _MARKS.sub("", token)
        return token.replace(bare, reader.model.restore(bare)) if bare and _ODD.match(bare) else token

    spaced = re.compile(r"(?<!\S)(?:\S\s){2,}\S(?!\S)")
    text = spaced.sub(lambda m: reader.model.restore(m.group()), text)
    return re.sub(r"\S+", plain, text)


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more; columns as they are."""
    docs, back = sheltered(docs, "doc_id", "text")
    scored = with_score(docs, fit(docs, labels), into="_toxicity")
    return back(scored.where(F.col("_toxicity") < threshold))
