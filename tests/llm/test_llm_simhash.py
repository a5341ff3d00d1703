import random

import numpy as np
import pytest
import xxhash
from helpers import rows
from pyspark.sql import functions as F

from test_llm_common import union_find
from uurwerk.llm import simhash
from uurwerk.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words, word = [], b""
    for c in (text or "").encode().lower() + b" ":
        if c == 32 or 9 <= c <= 13:
            words += [word] if word else []
            word = b""
        else:
            word += bytes([c])
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_of(docs, distance=4):
    prints = {i: plain_fingerprint(t) for i, t in docs}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= distance]
    return prints, union_find(prints, links)


def test_every_document_against_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    prints, want = classes_of(docs)
    got = QUERIES["op5_simhash_dedup"](spark, SMALL)
    assert rows(got) == sorted(((i, f"{prints[i]:016x}", want[i]) for i, _ in docs), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("distance", [0, 1, 3, 4, 7])
def test_links_connect_what_all_pairs_connect(spark, distance):
    """Chains of flips, a dense group and random values; small tiles."""
    rng = random.Random(distance)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for _ in range(40):
        seed = rng.choice(sorted(fps))
        for _ in range(5):
            for bit in rng.sample(range(64), distance + rng.randrange(-1, 2) if distance else 1):
                seed ^= 1 << bit
            fps.add(seed)
    dense = rng.getrandbits(64)
    fps |= {dense ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    signed = sorted(int(np.uint64(f).astype(np.int64)) for f in fps)
    pairs = np.array(signed, np.int64).view(np.uint64)
    near = np.argwhere(np.triu(np.bitwise_count(pairs[:, None] ^ pairs[None, :]) <= distance, 1))
    want = union_find(signed, [(signed[a], signed[b]) for a, b in near])
    classes = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = simhash.components(simhash.link_fingerprints(classes, distance, tile_rows=16))
    got = {n: n for n in signed} | {r.node: r.root for r in found.collect()}
    assert got == want


def test_allocation_is_the_cheapest():
    from itertools import product

    rng = random.Random(5)
    for _ in range(40):
        costs = [sorted(rng.random() for _ in range(4)) for _ in range(rng.randrange(2, 5))]
        units = rng.randrange(2, 5)
        got = simhash.allocate(costs, units)
        price = lambda t: sum(c[x] for c, x in zip(costs, t) if x >= 0)
        best = min(price(t) for t in product(range(-1, 4), repeat=len(costs)) if sum(x + 1 for x in t) == units)
        assert sum(x + 1 for x in got) == units and abs(price(got) - best) < 1e-12


def test_nulls_blanks_repeats_and_long_texts(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    docs = [(5, None), (3, ""), (9, " \t\n"), (7, "One two"), (8, "one  TWO"), (None, "one two"), (1, long), (2, long), (2, long)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("fp", F.lit("x"))
    prints = simhash.with_fingerprint(df.drop("fp")).select("doc_id", "fp")
    joined = prints.join(simhash.near_duplicates(prints), "fp")
    assert rows(joined, "doc_id", "component_id") == sorted(
        [(1, 1), (2, 1), (2, 1), (3, 3), (5, 3), (7, 7), (8, 7), (9, 3), (None, 7)], key=lambda r: tuple(map(str, r))
    )
    assert rows(simhash.deduplicate(df), "doc_id") == [(1,), (3,), (7,)]
    assert simhash.deduplicate(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        simhash.with_fingerprint(df)
    repeated = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "e f g h"), (None, "e f g h")], "doc_id long, text string")
    assert simhash.deduplicate(repeated).count() == 2


def test_only_ascii_is_folded_and_parts_words():
    for text in ("Äb C d é f g", "a\x0bb\x0cc d e", "x" * 10, "A b c d"):
        assert simhash.fingerprint(text) & (2**64 - 1) == plain_fingerprint(text)


def test_a_group_is_its_component_not_its_smallest_id(spark):
    words = [f"word{i}" for i in range(400)]
    near = [" ".join(words), " ".join([*words, "more"])]
    data = [(1, "a b c d"), (1, "quite another text of other words"), (None, near[0]), (None, near[1])]
    df = spark.createDataFrame(data, "doc_id long, text string")
    prints = simhash.with_fingerprint(df).select("text", "fp").collect()
    fps = {r.text: r.fp for r in prints}
    assert 0 < bin((fps[near[0]] ^ fps[near[1]]) & (2**64 - 1)).count("1") <= simhash.DISTANCE
    kept = [r.doc_id for r in simhash.deduplicate(df).collect()]
    assert sorted(kept, key=str) == [1, 1, None]
