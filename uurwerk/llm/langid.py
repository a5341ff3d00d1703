"""Language identification, words first.

A known word scores by its log frequency in each language. An unseen word falls
back to character n-grams: to its longest ones that are known, five letters down to
one, with the word's edges marked. A text takes the language with the largest
sum over its words.

Every word of every training row counts, however rare. The distinct words of the texts in
question are joined to the whole counted table and scored once; the most frequent of
them are broadcast, and the others, each of them rare in these texts, are joined to the
texts' own words and summed up. Both ways give a word the same score. N-grams are
bounded for each language and length by itself, so that a large language takes no
place of a small one.

Edge cases: a null text and one without a letter are ``und`` with score 0, as is every
text when no training row has a language; ties go to the language first in order;
repeated rows count as often as they occur; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uurwerk.llm.common import held_out
from uurwerk.session import materialize

# What every word counts in a language before it is seen there.
UNSEEN = 0.02
# N-grams of a language and length that the backoff knows.
GRAMS_EACH = 20_000
# Scored words that are broadcast at most, and their bytes.
FAST_WORDS = 200_000
FAST_BYTES = 64 << 20
GRAMS = (5, 4, 3, 2, 1)
# A longer word is cut, so that a text without spaces makes words of bounded size.
WORD_LETTERS = 64
FLUSH = 400_000
_WORDS = re.compile(r"[^\W\d_]+")
# In plain ASCII everything but letters separates words.
_BLANKS = {c: " " for c in range(128) if not chr(c).isalpha()}


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    found = text.lower().translate(_BLANKS).split() if text.isascii() else _WORDS.findall(text.lower())
    if found and max(map(len, found)) > WORD_LETTERS:
        found = [w[i : i + WORD_LETTERS] for w in found for i in range(0, len(w), WORD_LETTERS)]
    return found


def grams_of(word: str, n: int) -> list[str]:
    """N-grams with the edges marked, single letters without."""
    padded = word if n == 1 else f"_{word}_"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _flushed(held: dict[str, Counter], name: str):
    yield pa.RecordBatch.from_pydict(
        {
            "lang": pa.array([k for k, c in held.items() for _ in c], pa.string()),
            name: pa.array([w for c in held.values() for w in c], pa.string()),
            "n": pa.array([n for c in held.values() for n in c.values()], pa.int64()),
        }
    )


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, held.values())) > FLUSH:
                yield from _flushed(held, "word")
                held = {}
    yield from _flushed(held, "word")


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}
    for batch in batches:
        for lang, word, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
            counts = held.setdefault(lang, Counter())
            for size in GRAMS:
                for gram in grams_of(word, size):
                    counts[gram] += n
        if sum(map(len, held.values())) > FLUSH:
            yield from _flushed(held, "gram")
            held = {}
    yield from _flushed(held, "gram")


@dataclass(frozen=True)
class Model:
    """Languages in order, the scores of all words seen (word, scores), and the n-grams with theirs."""

    langs: list[str]
    words: DataFrame | None = None
    grams: list[str] | None = None
    gram_logs: np.ndarray | None = None


def _by_lang(langs: list[str]) -> list:
    return [F.coalesce(F.sum(F.when(F.col("lang") == l, F.col("n"))), F.lit(0)).cast("double") for l in langs]


def _grams(words: DataFrame, langs: list[str], each: int) -> tuple[list[str], np.ndarray]:
    """The ``each`` most frequent n-grams of every language and length, with their frequencies in all languages."""
    counted = words.mapInArrow(_count_grams, "lang string, gram string, n bigint")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = materialize(counted.withColumn("size", F.length("gram")), "grams")
    order = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram")
    kept = counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each).select("gram").distinct()
    wide = counted.join(kept, "gram", "left_semi").groupBy("gram").agg(F.array(*_by_lang(langs)).alias("counts")).toArrow()
    pieces = wide["gram"].to_pylist()
    counts = np.array(wide["counts"].to_pylist(), float).reshape(len(pieces), len(langs))
    sizes = np.array([len(p) for p in pieces])
    logs = np.zeros(counts.shape)
    for n in GRAMS:
        own = sizes == n
        logs[own] = np.log((counts[own] + 0.5) / (counts[own].sum(0) + 0.5 * max(own.sum(), 1)))
    return pieces, logs


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", grams_each: int = GRAMS_EACH) -> Model:
    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    words = rows.mapInArrow(_count_words, "lang string, word string, n bigint")
    words = materialize(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    totals = {r.lang: r.n for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return Model([])
    # The share left to unseen words is the same in every language, however few words it has shown.
    different = words.select("word").distinct().count()
    scores = [F.log((c + UNSEEN) / F.lit(totals[l] + UNSEEN * different)) for c, l in zip(_by_lang(langs), langs)]
    known = words.groupBy("word").agg(F.array(*scores).alias("scores"))
    return Model(langs, known, *_grams(words, langs, grams_each))


class Backoff:
    """Scores of unseen words: the mean over their longest known n-grams."""

    def __init__(self, langs: list[str], grams: list[str], logs: np.ndarray):
        self.grams, self.logs, self.nothing = {g: k for k, g in enumerate(grams)}, logs, [0.0] * len(langs)

    def __call__(self, word: str) -> list[float]:
        for n in GRAMS:
            found = [k for k in map(self.grams.get, grams_of(word, n)) if k is not None]
            if found:
                return self.logs[found].mean(0).tolist()
        return self.nothing


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word with the number of texts that have it."""
    held: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
        held.clear()
        return out

    for batch in batches:
        for text in batch.column(0).to_pylist():
            held.update(set(words_of(text)))
            if len(held) > FLUSH:
                yield flush()
    yield flush()


def scored_words(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(word, n, scores) of all distinct words of the texts, n being the texts that have it."""
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.grams, model.gram_logs))

    def back_off(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unseen = Backoff(*shared.value)
        for batch in batches:
            given = batch.column(2).to_pylist()
            scores = [unseen(w) if s is None else s for w, s in zip(batch.column(0).to_pylist(), given)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.list_(pa.float64()))], ["word", "n", "scores"]
            )

    tokens = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(_count_tokens, "word string, n bigint")
    tokens = tokens.groupBy("word").agg(F.sum("n").alias("n"))
    return tokens.join(model.words, "word", "left").select("word", "n", "scores").mapInArrow(
        back_off, "word string, n bigint, scores array<double>"
    )


def _sums(shared, text: int, keep: Sequence[int]):
    """The sum over a text's broadcast words, and its other words with how often each occurs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, scores = shared.value
        place = {w: k for k, w in enumerate(words)}
        rest = pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())]))
        for batch in batches:
            sums, others = [], []
            for value in batch.column(text).to_pylist():
                counts = Counter(words_of(value))
                if not counts:
                    sums.append(None)
                    others.append([])
                    continue
                at = np.fromiter(map(place.get, counts, repeat(-1)), np.int64, len(counts))
                times = np.fromiter(counts.values(), float, len(counts))
                known = at >= 0
                sums.append((times[known] @ scores[at[known]]).tolist())
                if known.all():
                    others.append([])
                else:
                    others.append([{"word": w, "times": n} for (w, n), k in zip(counts.items(), known) if not k])
            columns = [batch.column(k) for k in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sums, pa.list_(pa.float64())), pa.array(others, rest)],
                [*[batch.schema.names[k] for k in keep], "_sums", "_rare"],
            )

    return work


def with_language(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    into: tuple[str, str] = ("lang_pred", "score"),
    keep: Sequence[str] | None = None,
    fast_words: int = FAST_WORDS,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the predicted language and its share; both names must be free."""
    kept = list(docs.columns if keep is None else keep)
    if taken := set(into) & set(kept):
        raise ValueError(f"{sorted(taken)} are already columns")
    if not model.langs:
        return docs.select(*kept, F.lit("und").alias(into[0]), F.lit(0.0).alias(into[1]))
    spark, width = docs.sparkSession, len(model.langs)
    scored = materialize(scored_words(docs, model, text), "scored_words")
    most = max(1, min(fast_words, FAST_BYTES // (8 * width + 4 * WORD_LETTERS)))
    # Only where there are more words than that is there a last one to draw the line at.
    top = scored.orderBy(F.desc("n"), "word").limit(most).select("word", "scores").toArrow()
    fast = np.array(top["scores"].to_pylist(), float).reshape(-1, width)
    shared = spark.sparkContext.broadcast((top["word"].to_pylist(), fast))

    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)], F.col(f"`{text}`").alias("_text"))
    fields = [*rows.schema.fields[:-1], T.StructField("_sums", T.ArrayType(T.DoubleType()))]
    rare_type = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("times", T.LongType())]))
    work = _sums(shared, len(kept), range(len(kept)))
    summed = rows.mapInArrow(work, T.StructType([*fields, T.StructField("_rare", rare_type)]))
    if scored.limit(most + 1).count() > most:
        summed = materialize(summed.withColumn("_row", F.monotonically_increasing_id()), "sums")
        asked = summed.select("_row", F.inline("_rare"))
        found = asked.join(scored.select("word", "scores"), "word").groupBy("_row").agg(
            F.array(*[F.sum(F.col("times") * F.col("scores")[k]) for k in range(width)]).alias("_more")
        )
        both = F.zip_with("_sums", "_more", lambda a, b: a + F.coalesce(b, F.lit(0.0)))
        summed = summed.join(found, "_row", "left").withColumn("_sums", F.when(F.col("_more").isNull(), F.col("_sums")).otherwise(both))
    best = F.array_max("_sums")
    share = 1 / F.aggregate("_sums", F.lit(0.0), lambda a, v: a + F.exp(v - F.array_max("_sums")))
    lang = F.element_at(F.array(*[F.lit(l) for l in model.langs]), F.array_position("_sums", best).cast("int"))
    return summed.select(
        *[F.col(f"c{k}").alias(c) for k, c in enumerate(kept)],
        F.when(F.col("_sums").isNull(), "und").otherwise(lang).alias(into[0]),
        F.coalesce(share, F.lit(0.0)).alias(into[1]),
    )


def training(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return docs.where(~held_out(doc_id))
