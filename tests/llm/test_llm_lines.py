import random

import pytest
from helpers import rows

from uurwerk.llm import lines

SMALL = "/root/testdata/sf0.001"


def brute(docs, min_words):
    """Every line inside a run of at least ``min_words`` words that also starts at an
    earlier place, found by extending each pair of equal lines."""
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is None, docs[k][0] or 0, k))
    texts = [docs[k][1].split("\n") if docs[k][1] is not None else [] for k in order]
    places = [(d, i) for d, t in enumerate(texts) for i in range(len(t))]
    at = {}
    for d, i in places:
        at.setdefault(texts[d][i], []).append((d, i))
    gone = [set() for _ in docs]
    for d, i in places:
        longest = 0
        for e, j in at[texts[d][i]]:
            if (e, j) >= (d, i):
                break
            n = 0
            while i + n < len(texts[d]) and j + n < len(texts[e]) and texts[d][i + n] == texts[e][j + n]:
                n += 1
            if sum(len(l.encode().split()) for l in texts[d][i : i + n]) >= min_words:
                longest = max(longest, n)
        gone[d] |= set(range(i, i + longest))
    out = [None] * len(docs)
    for d, k in enumerate(order):
        text = "\n".join(l for i, l in enumerate(texts[d]) if i not in gone[d])
        out[k] = (docs[k][0], text if docs[k][1] is not None else None, len(texts[d]), len(gone[d]))
    return sorted(out, key=lambda r: tuple(map(str, r)))


def cleaned(spark, docs, min_words):
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    return rows(lines.dedup_lines(df, min_words), "doc_id", "text", "n_lines", "n_removed")


@pytest.mark.parametrize("seed, min_words", [(1, 3), (2, 5), (3, 12), (4, 1)])
def test_random_documents_against_pairwise_extension(spark, seed, min_words):
    rng = random.Random(seed)
    pool = ["a", "b b", "", "c c c", "d d d d d", " "]
    docs = []
    for i in range(25):
        text = [rng.choice(pool) if rng.random() < 0.9 else f"only {i}" for _ in range(rng.randrange(0, 14))]
        if docs and rng.random() < 0.5:
            other = (rng.choice(docs)[1] or "").split("\n")
            text[1:1] = other[: rng.randrange(0, 9)]
        docs.append((i * 7 % 25, "\n".join(text)))
    assert cleaned(spark, docs, min_words) == brute(docs, min_words)


def test_given_documents_against_pairwise_extension(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = brute(docs, lines.MIN_WORDS)
    assert cleaned(spark, docs, lines.MIN_WORDS) == want
    assert any(r[3] for r in want)


def test_passages_go_and_short_lines_stay(spark):
    passage = " ".join(f"w{i}" for i in range(30)) + "\n" + " ".join(f"v{i}" for i in range(30))
    docs = [(1, f"one\n{passage}\nshort"), (2, f"two\n{passage}\nother\nshort"), (3, "short\nfine"), (4, passage)]
    assert dict((r[0], r[1]) for r in cleaned(spark, docs, 50)) == {1: docs[0][1], 2: "two\nother\nshort", 3: "short\nfine", 4: ""}


def test_nulls_empties_repeats_and_runs_over_themselves(spark):
    text = "x y\n" * 8 + "end"
    docs = [(3, text), (None, text), (1, None), (2, ""), (3, text), (5, "solo")]
    assert cleaned(spark, docs, 4) == brute(docs, 4)
    assert cleaned(spark, [(1, "a\n" * 5000)], 2) == [(1, "a\n", 5001, 4999)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lines.dedup_lines(empty).count() == 0


def test_runs_of_any_number_of_lines(spark):
    """Two copies of a text whose fifty words are far apart: the run has more lines than any fixed number of doublings."""
    text = ("\n" * 3000).join(f"w{k}" for k in range(8))
    got = cleaned(spark, [(1, text), (2, text + "\nmore")], 8)
    assert [(r[0], r[3]) for r in got] == [(1, 0), (2, 7 * 3000 + 1)]


def test_other_columns_do_not_clash(spark):
    df = spark.createDataFrame([(1, "a b c\nd", 1, 2), (2, "a b c\ne", 1, 2)], "doc_id long, text string, row int, line int")
    assert rows(lines.dedup_lines(df, 2), "doc_id", "text", "removed") == [(1, "a b c\nd", ""), (2, "e", "0:1")]
