"""Toxicity and language: held-out accuracy and the parts that can be checked exactly."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from uurwerk.llm import langid, toxicity
from uurwerk.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def is_held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def toxic(spark):
    return spark.createDataFrame(QUERIES["op4_toxicity"](spark, MEDIUM).collect())


def test_toxicity_on_held_out_documents(spark, toxic):
    labels = dict(rows(spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "toxic")))
    got = toxic.collect()
    assert len(got) == 1000 and all(r.held_out == is_held(r.doc_id) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([p == t for p, t in held]) > 0.9


def model_of(texts):
    counts = np.zeros(toxicity.SYMBOLS**3, np.int64)
    for text in texts:
        codes = np.concatenate(([toxicity.EDGE] * 2, toxicity._CODE[[ord(c) for c in text + " "]]))
        np.add.at(counts, (codes[:-2] * toxicity.SYMBOLS + codes[1:-1]) * toxicity.SYMBOLS + codes[2:], 1)
    return toxicity.CharacterModel(counts)


def test_the_channel_is_undone():
    model = model_of(["you are an idiot and a moron stupid loser trash scum clown of the list"] * 200)
    said = {
        "1d10t": "idiot", "m0r0n": "moron", "stuuuupid": "stupid", "l0$er": "loser", "tr@sh": "trash",
        "s.c.u.m": "scum", "c l o w n": "clown", "7r45h": "trash", "id!ot": "idiot",
    }
    for written, meant in said.items():
        assert model.restore(written) == meant, (written, model.restore(written))
    text = "You 1d10t, m o r o n of the list!!"
    assert toxicity.restore_text(text, model) == "You idiot, moron of the list!!"


def test_trigrams_count_whole_texts(spark):
    texts = ["abc", "Abc abc", None, "", "x" * (1 << 20) + "yz"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = toxicity.count_trigrams(df)
    want = sum(len(t) for t in texts if t)
    assert got.sum() == want
    a, b, c = (toxicity.ALPHABET.index(x) for x in "abc")
    assert got[(a * toxicity.SYMBOLS + b) * toxicity.SYMBOLS + c] == 3


def test_obfuscated_insults_score_like_plain_ones(spark):
    data = [(i, f"the text number {'abcdefgh'[i % 8] * 2} is a total moron here", 1) for i in range(60)]
    data += [(100 + i, f"the text number {'abcdefgh'[i % 8] * 2} is a fine work here", 0) for i in range(240)]
    docs = spark.createDataFrame([d[:2] for d in data], "doc_id long, text string")
    labels = spark.createDataFrame([(d[0], 1, d[2]) for d in data], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    probe = spark.createDataFrame([(1, "what a m0r0n"), (2, "what a m o r o n indeed"), (3, "a fine text"), (4, None), (5, "")], "doc_id long, text string")
    got = dict(rows(toxicity.with_score(probe, model), "doc_id", "score"))
    assert got[1] > 0.5 and got[2] > 0.5 and max(got[3], got[4], got[5]) < 0.5


def test_documents_that_share_a_line_all_count(spark):
    banner = "this passage is printed at the top of every document of this source\n"
    insults = ["moron", "clown", "trash", "scum"]
    data = [(i, f"{banner}number {i} is a total {insults[i % 4]} here", 1) for i in range(80)]
    data += [(100 + i, f"{banner}number {i} is a fine work here", 0) for i in range(240)]
    data += [(400 + i, "COPIED  text of one loser", 1) if i % 2 else (400 + i, "copied text of one loser", 1) for i in range(40)]
    docs = spark.createDataFrame([d[:2] for d in data], "doc_id long, text string")
    labels = spark.createDataFrame([(d[0], 1, d[2]) for d in data], "doc_id long, quality int, toxic int")
    kept = toxicity._labelled(docs, labels, 1000).collect()
    train = [d for d in data if not is_held(d[0])]
    assert len(kept) == sum(d[0] < 400 for d in train) + 1
    # One text of each label counts the shared line.
    for toxic in (0, 1):
        assert sum(r.repeated is None and r.text.startswith(banner) for r in kept if r.toxic == toxic) == 1
    model = toxicity.fit(docs, labels)
    features = model.value[1]
    assert all(features[w][1] == sum(w in d[1] for d in train) for w in insults) and "loser" not in features
    probe = spark.createDataFrame([(i, banner + f"he is a total {w}") for i, w in enumerate(insults)] + [(9, banner)], "doc_id long, text string")
    got = dict(rows(toxicity.with_score(probe, model), "doc_id", "score"))
    assert min(got[i] for i in range(4)) > 0.5 > got[9]


def test_toxicity_without_labels_and_with_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (None, None), (1, "a")], "doc_id long, text string").withColumn("toxic", F.lit(5))
    none = spark.createDataFrame([(1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert rows(toxicity.reject_toxic(docs, none)) == rows(docs)
    assert toxicity.reject_toxic(docs.limit(0), none.limit(0)).count() == 0


def test_language_on_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op8_language"](spark, MEDIUM).collect()}
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()
    assert len(got) == len(docs)
    held = [(got[d.doc_id].lang_pred, d.lang) for d in docs if is_held(d.doc_id)]
    assert np.mean([p == l for p, l in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.held_out == is_held(r.doc_id) for r in got.values())


def test_counts_and_backoff_by_hand(spark):
    docs = spark.createDataFrame(
        [(1, "the cat the dog", "en"), (2, "der hund der hund", "de"), (3, None, "de"), (4, "ignored", None)],
        "doc_id long, text string, lang string",
    )
    model = langid.fit(docs)
    words = {r.word: r.scores for r in model.words.collect()}
    assert model.langs == ["de", "en"] and sorted(words) == ["cat", "der", "dog", "hund", "the"]
    assert np.isclose(words["the"][1], np.log(2.02 / (4 + 0.02 * 5))) and "_der_" in model.grams
    probe = spark.createDataFrame([(1, "The dog"), (2, "hunde"), (3, "hunderd"), (4, "123 ..."), (5, None), (6, "")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.with_language(probe, model).collect()}
    assert [got[k][0] for k in (1, 2, 3)] == ["en", "de", "de"]
    assert got[4] == got[5] == got[6] == ("und", 0.0)


def language_brute(train, texts, each):
    """Counts, n-gram choice and sums in plain Python."""
    langs = sorted({l for _, l in train if l is not None})
    seen = {l: Counter(w for t, m in train if m == l for w in langid.words_of(t)) for l in langs}
    total = {l: sum(seen[l].values()) for l in langs}
    different = len(set().union(*seen.values()))
    grams = {l: Counter() for l in langs}
    for l in langs:
        for w, n in seen[l].items():
            for size in langid.GRAMS:
                for g in langid.grams_of(w, size):
                    grams[l][g] += n
    kept = set()
    for l in langs:
        for size in langid.GRAMS:
            own = [g for g in grams[l] if len(g) == size]
            kept |= set(sorted(own, key=lambda g: (-grams[l][g], g))[:each])
    sums = {(l, k): sum(grams[l][g] for g in kept if len(g) == k) for l in langs for k in langid.GRAMS}
    many = Counter(len(g) for g in kept)

    def score(word):
        if any(word in seen[l] for l in langs):
            return [math.log((seen[l][word] + 0.02) / (total[l] + 0.02 * different)) for l in langs]
        for size in langid.GRAMS:
            own = [g for g in langid.grams_of(word, size) if g in kept]
            if own:
                logs = [[math.log((grams[l][g] + 0.5) / (sums[l, size] + 0.5 * many[size])) for l in langs] for g in own]
                return [sum(v) / len(own) for v in zip(*logs)]
        return [0.0] * len(langs)

    out = []
    for t in texts:
        words = langid.words_of(t)
        if not words:
            out.append(("und", 0.0))
            continue
        sums_ = [sum(v) for v in zip(*[score(w) for w in words])]
        best = max(sums_)
        out.append((langs[sums_.index(best)], 1 / sum(math.exp(v - best) for v in sums_)))
    return out


@pytest.mark.parametrize("fast", [1, 40, langid.FAST_WORDS])
def test_every_seen_word_scores_by_its_own_counts(spark, fast):
    """Few broadcast words and the join of all others give what plain Python gives, with few n-grams too."""
    docs = [(d.doc_id, d.text, d.lang) for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    train = [d for d in docs if not is_held(d[0])]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.fit(langid.training(df), grams_each=30)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.with_language(df.drop("lang"), model, fast_words=fast).collect()}
    want = language_brute([d[1:] for d in train], [d[1] for d in docs], 30)
    for (doc_id, _, _), (lang, share) in zip(docs, want):
        assert got[doc_id][0] == lang and abs(got[doc_id][1] - share) < 1e-9


def test_a_dominant_language_takes_nothing_from_a_small_one(spark):
    """200,000 words of one language, few of another: each of them still scores by its own counts."""
    large = [(k, " ".join(f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}" + "".join("uvwxyzabcd"[int(c)] for c in str(i)) for i in range(k * 2000, k * 2000 + 2000)), "xx") for k in range(100)]
    small = [(1000, "zebu", "yy"), (1001, "yak", "yy")]
    df = spark.createDataFrame([*large, *small], "doc_id long, text string, lang string").repartition(8)
    model = langid.fit(df)
    assert model.words.count() > 190_000
    probe = spark.createDataFrame([(1, "zebu"), (2, "yak"), (3, large[7][1][:44])], "doc_id long, text string")
    got = dict(rows(langid.with_language(probe, model, fast_words=1), "doc_id", "lang_pred"))
    assert got == {1: "yy", 2: "yy", 3: "xx"}


def test_language_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a" * 200_000, "en"), (2, "b", None), (2, "b", None)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert rows(langid.with_language(docs.drop("lang"), model), "doc_id", "lang_pred") == [(1, "en"), (2, "en"), (2, "en")]
    nothing = langid.fit(docs.where("lang is null"))
    assert rows(langid.with_language(docs, nothing), "lang_pred") == [("und",)] * 3
    with pytest.raises(ValueError):
        langid.with_language(docs.withColumn("score", F.lit(1)), model)


def test_words_of_plain_ascii_are_those_of_the_pattern():
    every = "".join(map(chr, range(128)))
    for text in [every, every[::-1], "Don't_stop 3rd\x1fA\x00b", "x" * 200, "", "naïve Über-Maß", " a"]:
        want = langid._WORDS.findall(text.lower())
        assert "".join(langid.words_of(text)) == "".join(want)
        if all(len(w) <= langid.WORD_LETTERS for w in want):
            assert langid.words_of(text) == want
