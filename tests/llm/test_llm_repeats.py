import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import rows

from uurwerk.llm import repeats

SMALL = "/root/testdata/sf0.001"
N = repeats.LENGTH


def brute(docs):
    """Every byte under a string of N bytes that starts twice or more, by counting all strings."""
    data = [(text or "").encode() for _, text in docs]
    seen = Counter(hashlib.blake2b(b[i : i + N], digest_size=16).digest() for b in data for i in range(len(b) - N + 1))
    out = []
    for (doc_id, _), b in zip(docs, data):
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - N + 1):
            if seen[hashlib.blake2b(b[i : i + N], digest_size=16).digest()] > 1:
                gone[i] += 1
                gone[i + N] -= 1
        covered = np.cumsum(gone)[: len(b)] > 0
        kept = np.frombuffer(b, np.uint8)[~covered].tobytes()
        spans = int(np.sum(np.diff(covered.astype(int), prepend=0) == 1))
        out.append((doc_id, len(b), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: tuple(map(str, r)))


def removed(spark, docs, parts=3):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    return rows(repeats.dedup_repeats(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def words(rng, n):
    return "".join(rng.choice("abcdeéß ") for _ in range(n))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_passages_of_all_lengths_against_counting_every_string(spark, seed):
    rng = random.Random(seed)
    passages = [words(rng, rng.choice([150, 190, 200, 210, 260, 330, 700])) for _ in range(8)]
    docs = []
    for i in range(60):
        text = ""
        for _ in range(rng.randrange(0, 5)):
            p = rng.choice(passages)
            low = rng.randrange(0, 30)
            text += rng.choice([p, p[low:], p[: len(p) - low], words(rng, rng.randrange(1, 400))])
        docs.append((i, text))
    want = brute(docs)
    assert removed(spark, docs) == want and any(r[2] for r in want) and any(r[2] < r[1] for r in want)


def test_given_documents_against_counting_every_string(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = brute(docs)
    assert removed(spark, docs) == want and any(r[2] for r in want)


def test_edges_of_a_repeat_are_exact(spark):
    rng = random.Random(5)
    shared = words(rng, 400)
    docs = [(1, "x" + shared + "y"), (2, "z" + shared + "w"), (3, shared[:199]), (4, shared[-200:]), (5, shared[100:300] + "q")]
    got = {r[0]: r[2] for r in removed(spark, docs)}
    size = len(shared.encode())
    assert got[1] == got[2] == size and got == {r[0]: r[2] for r in brute(docs)}


def test_matches_with_different_partners_on_either_side(spark):
    """A string whose left part one text shares and whose right part another does is not shared."""
    rng = random.Random(6)
    a, b, c = (words(rng, 150) for _ in range(3))
    docs = [(1, a + b), (2, a + c), (3, c + b), (4, a[40:] + b[:120])]
    assert removed(spark, docs) == brute(docs)


def test_nulls_empties_repeated_rows_and_monotonous_texts(spark):
    rng = random.Random(7)
    one = words(rng, 300)
    docs = [(1, None), (2, ""), (3, one), (3, one), (None, one), (None, "short"), (5, "a" * 199), (6, "a" * 200), (7, "a" * 900),
            (8, "ab" * 400), (9, "b" + "ab" * 120)]
    assert removed(spark, docs) == brute(docs)
    assert repeats.dedup_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_texts_in_slices(spark, monkeypatch):
    rng = random.Random(8)
    long = words(rng, 30_000)
    text = long[:9000] + "-" + long[3000:7000] + "!" + long[20_000:]
    docs = [(1, text), (2, long[15_000:21_000]), (3, long)]
    stream = repeats.Stream([t.encode() for _, t in docs])
    row = np.repeat([0, 1, 2], 4)
    at = np.concatenate([[0, 999, 1000, size - N] for size in stream.sizes])
    whole, digests = stream.anchors(), stream.digests(row, at)
    monkeypatch.setattr(repeats, "SLICE", 1000)
    assert all(np.array_equal(x, y) for x, y in zip(whole, stream.anchors()))
    assert all(np.array_equal(x, y) for x, y in zip(digests, stream.digests(row, at)))
    assert removed(spark, docs) == brute(docs)


def test_anchors_do_not_depend_on_the_texts_beside():
    rng = random.Random(12)
    texts = [words(rng, rng.randrange(200, 3000)).encode() for _ in range(9)]
    row, place, gram, around = repeats.Stream(texts).anchors()
    for k, text in enumerate(texts):
        alone = repeats.Stream([text]).anchors()
        assert all(np.array_equal(x, y[row == k]) for x, y in zip(alone[1:], (place, gram, around)))
        # Some anchor in the first SPREAD grams of every string.
        starts = np.arange(len(text) - N + 1)
        assert (alone[1][np.searchsorted(alone[1], starts)] - starts < repeats.SPREAD).all()


def test_loser_tree_merges_and_knows_every_common_prefix():
    rng = random.Random(9)
    runs = []
    for _ in range(7):
        texts = sorted(bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(rng.randrange(0, 40)))
        shared = [0] + [repeats._first_difference(x, y, 0) for x, y in zip(texts, texts[1:])]
        runs.append([(t, s, 1) for t, s in zip(texts, shared)])
    got = list(repeats.merged([iter(r) for r in runs]))
    texts = [g[0] for g in got]
    assert texts == sorted(t[0] for r in runs for t in r)
    assert [g[1] for g in got[1:]] == [repeats._first_difference(x, y, 0) for x, y in zip(texts, texts[1:])]


def test_front_coding_round_trip_and_strings_that_stand_alone():
    rng = random.Random(10)
    texts = sorted({bytes(rng.choice(b"abc") for _ in range(N)) for _ in range(50)})
    counts = [rng.randrange(1, 9) for _ in texts]
    assert [(t, n) for t, _, n in repeats._decoded(repeats._front_coded(texts, counts))] == list(zip(texts, counts))
    others = texts[:20] + texts[25:]
    rows_ = [(3, "x", repeats._front_coded(texts, [1] * 50)), (3, "y", repeats._front_coded(others, [1] * 45))]
    batch = repeats._rows([(*r, *[None] * 6) for r in rows_])
    found = [b["block"].to_pylist() for b in repeats._unproven(iter([batch]))]
    assert sum(found, []) == [repeats._digest(t) for t in texts[20:25]]


def test_a_claim_that_the_merge_does_not_prove_is_dropped(spark, monkeypatch):
    """With a wrong witness a claim fails, and its text is computed again without it."""
    data = "k1 long, k2 long, data binary, places array<int>, states array<int>, claims array<int>, witnesses array<int>"
    rng = random.Random(13)
    one = words(rng, 300).encode()
    rows_ = [(1, 1, bytearray(one), [50], [repeats.EMIT], [3, 40], [3])]
    df = spark.createDataFrame([*rows_, (2, 2, bytearray(one[3:203]), [0], [0], None, [0])], data)
    got = {r.k1: r.spans for r in repeats._proven(df, []).collect()}
    assert got == {1: [3, 203], 2: []}


def test_other_columns_do_not_clash(spark):
    rng = random.Random(11)
    one = words(rng, 250)
    df = spark.createDataFrame([(1, one, 1, "k"), (2, one, 2, "l")], "doc_id long, text string, tid long, data string")
    assert [r[2] for r in rows(repeats.dedup_repeats(df), "doc_id", "n_bytes", "n_removed")] == [len(one.encode())] * 2
