import math
import random
from fractions import Fraction

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from uurwerk.llm import mixing
from uurwerk.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string"


def edf(active):
    """Earliest deadline first, slot by slot."""
    length, given, out = sum(active), [0] * len(active), []
    for t in range(length):
        ready = [
            (math.ceil(Fraction((given[i] + 1) * length, n)), i)
            for i, n in enumerate(active)
            if given[i] < n and math.floor(Fraction(given[i] * length, n)) <= t
        ]
        _, chosen = min(ready)
        given[chosen] += 1
        out.append(chosen)
    return out


@pytest.mark.parametrize("active", [[1], [3, 2, 1], [5, 0, 5], [97, 1, 1, 1], [13, 11, 7, 5, 3, 2], [1] * 9, [0, 0]])
def test_schedule_is_edf_and_stays_within_one_block(spark, active):
    df = spark.createDataFrame([(active,)], "a array<bigint>")
    got = df.select(mixing.edf_schedule(F.col("a"))).first()[0]
    assert got == edf(active)
    given, length = [0] * len(active), sum(active)
    for t, chosen in enumerate(got):
        given[chosen] += 1
        assert all(abs(g - Fraction(n * (t + 1), length)) < 1 for g, n in zip(given, active))


def brute_slots(supply):
    """Slot of each (source, block) by dealing period after period."""
    out, slot, period = {}, 0, 0
    while True:
        active = [max(0, min(w, b - period * w)) for _, b, w in supply]
        if not sum(active):
            return out
        nth = [0] * len(supply)
        for i in edf(active):
            out[supply[i][0], period * supply[i][2] + nth[i]] = slot
            nth[i] += 1
            slot += 1
        period += 1


def test_blocks_stand_where_dealing_them_one_by_one_puts_them(spark):
    docs = [(i, "x" * (9 + i % 50), "abbccccd"[i % 8]) for i in range(400)] + [(1000, "y" * 3000, "e"), (1001, "z", None)]
    weights = spark.createDataFrame([("a", 3), ("b", 2), ("c", 4), ("d", 1)], "source string, weight long")
    got = mixing.mix(spark.createDataFrame(docs, SCHEMA), weights, block_bytes=100).collect()
    assert sorted(r.doc_id for r in got) == sorted(d[0] for d in docs)
    blocks = {}
    for r in got:
        blocks[r.source] = max(blocks.get(r.source, 0), r.block + 1)
    weight = {"a": 3, "b": 2, "c": 4, "d": 1}
    supply = sorted((("null" if s is None else "=" + s), n, weight.get(s, 1)) for s, n in blocks.items())
    want = brute_slots(supply)
    for r in got:
        assert r.slot == want["null" if r.source is None else "=" + r.source, r.block]
    for source in blocks:
        mine = sorted((r.place, r.block, r.size) for r in got if r.source == source)
        assert [m[0] for m in mine] == list(range(len(mine)))
        before = 0
        for _, block, size in mine:
            assert block == before // 100
            before += size


def test_all_documents_are_mixed_in_written_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    mixed = mixing.mixed_documents(docs, block_bytes=4096)
    mixed.write.parquet(str(tmp_path / "mixed"))
    read = spark.read.parquet(str(tmp_path / "mixed"))
    assert rows(read) == rows(docs)
    order = {r.doc_id: (r.slot, r.place) for r in mixing.mix(docs, block_bytes=4096).collect()}
    written = [r.doc_id for f in sorted((tmp_path / "mixed").glob("part-*")) for r in spark.read.parquet(str(f)).collect()]
    assert [order[d] for d in written] == sorted(order.values())


@pytest.mark.parametrize("small", [1000, 1500])
def test_many_sources_keep_their_targets(spark, small):
    """One source with as many bytes as half of the others together."""
    hot = small // 2
    docs = [(i, "x" * 9, "hot") for i in range(4 * hot)] + [(10_000 + i, "x" * 9, f"s{i % small}") for i in range(4 * small)]
    got = mixing.mix(spark.createDataFrame(docs, SCHEMA), block_bytes=10).orderBy("slot").collect()
    assert [r.slot for r in got] == list(range(len(docs)))
    share, given = math.sqrt(hot) / (math.sqrt(hot) + small), 0
    for r in got[: 3 * small]:
        given += r.source == "hot"
        assert abs(given - share * (r.slot + 1)) < 3
    nth = {}
    for r in got:
        assert r.place == nth.get(r.source, 0)
        nth[r.source] = r.place + 1


def check_law(got, weights, bound=2):
    """Slots without gaps, and within each stretch of equal periods every source less
    than ``bound`` blocks from its share of a period's slots."""
    slots, blocks = {}, {}
    for r in got:
        assert slots.setdefault((r.source, r.block), r.slot) == r.slot
        blocks[r.source] = max(blocks.get(r.source, 0), r.block + 1)
    whole = {(s, j) for s, n in blocks.items() for j in range(n)}
    order = sorted((slot, source, block) for (source, block), slot in slots.items())
    assert len({o[0] for o in order}) == len(order)
    if whole == set(slots):
        assert [o[0] for o in order] == list(range(len(order)))
    at = {(source, block): slot for slot, source, block in order}
    period, base, worst = 0, 0, 0
    while True:
        active = {s: max(0, min(weights[s], n - period * weights[s])) for s, n in blocks.items()}
        length = sum(active.values())
        if not length:
            break
        for s, n in active.items():
            for j in range(n):
                if (s, period * weights[s] + j) in at:
                    t = at[s, period * weights[s] + j] - base
                    assert 0 <= t < length
                    worst = max(worst, abs(j - n * t / length), abs(j + 1 - n * (t + 1) / length))
        base, period = base + length, period + 1
    assert worst < bound, worst
    return worst


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pairs_of_a_tree_keep_every_source_near_its_share(spark, monkeypatch, seed):
    """Given weights, sources of any size, long documents and a null source."""
    monkeypatch.setattr(mixing, "MAX_SOURCES", 1)
    rng = random.Random(seed)
    names = [None, *(f"s{i}" for i in range(rng.choice([1, 6, 40])))]
    weights = {n: rng.choice([1, 2, 3, 7, 50, 333]) for n in names}
    docs = [(i, "x" * rng.choice([0, 40, 99, 99]), rng.choice(names)) for i in range(1500)]
    docs += [(9000, "y" * 3000, names[-1]), (9001, "z", None)]
    table = spark.createDataFrame([*weights.items(), ("other", 9)], "source string, weight long")
    got = mixing.mix(spark.createDataFrame(docs, SCHEMA), table, block_bytes=100).collect()
    assert sorted(r.doc_id for r in got) == sorted(d[0] for d in docs)
    check_law(got, weights)


@pytest.mark.parametrize("n", [80, 5000])
def test_any_number_of_sources_is_dealt_by_windows(spark, monkeypatch, n):
    monkeypatch.setattr(mixing, "MAX_STEPS", 0)
    docs = [(i, "x" * 9, f"s{i % n}") for i in range(6 * n)] + [(10**6 + i, "x" * 9, "hot") for i in range(4 * n)]
    got = mixing.mix(spark.createDataFrame(docs, SCHEMA), block_bytes=10).orderBy("slot").collect()
    assert [r.slot for r in got] == list(range(len(docs)))
    hot, small = math.sqrt(4 * n), math.sqrt(6)
    given, share = 0, hot / (hot + n * small)
    for r in got[: 5 * n]:
        given += r.source == "hot"
        # Two blocks, and what rounding the smallest weight to whole numbers moves.
        assert abs(given - share * (r.slot + 1)) < 2 + share * r.slot / 8


def placed_rows(docs, weights=None):
    return sorted(tuple(r) for r in mixing.mix(docs, weights, block_bytes=100).select("doc_id", "source", "block", "slot", "place").fillna("", "source").collect())


@pytest.mark.parametrize("limit, value, piece", [("MAX_SOURCES", 1, 1 << 16), ("MAX_STEPS", 0, 16)])
def test_a_document_has_the_same_slot_however_schedules_are_dealt(spark, monkeypatch, limit, value, piece):
    """By given weights and by default ones, of sources of very different sizes."""
    rng = random.Random(piece)
    names = [None, *(f"s{i}" for i in range(12))]
    data = [(i, "x" * rng.choice([0, 40, 99]), names[min(12, int(rng.expovariate(0.4)))]) for i in range(900)] + [(9000, "y" * 3000, "s1")]
    docs = spark.createDataFrame(data, SCHEMA)
    weights = spark.createDataFrame([(n, rng.choice([1, 2, 7, 20])) for n in names], "source string, weight long")
    whole = placed_rows(docs), placed_rows(docs, weights)
    monkeypatch.setattr(mixing, limit, value)
    monkeypatch.setattr(mixing, "PIECE", piece, raising=False)
    assert (placed_rows(docs), placed_rows(docs, weights)) == whole


@pytest.mark.parametrize("piece", [1, 16])
def test_long_schedules_are_earliest_deadline_first(spark, monkeypatch, piece):
    monkeypatch.setattr(mixing, "MAX_STEPS", 0)
    monkeypatch.setattr(mixing, "PIECE", piece, raising=False)
    blocks = {"a": 61, "b": 1, "c": 17, "d": 90, "e": 5, "f": 5}
    weight = {"a": 13, "b": 40, "c": 3, "d": 25, "e": 5, "f": 2}
    docs = [(k * 1000 + i, "x" * 99, s) for k, (s, n) in enumerate(blocks.items()) for i in range(n)]
    got = mixing.mix(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(list(weight.items()), "source string, weight long"), block_bytes=100)
    want = brute_slots([(s, n, weight[s]) for s, n in sorted(blocks.items())])
    assert {(r.source, r.block): r.slot for r in got.collect()} == want


def test_one_source_is_a_hundred_thousand_times_the_other(spark):
    sizes = [("big", 50 * 10**12), ("small", 5 * 10**8)]
    weights = dict(rows(mixing.tempered_weights(spark.createDataFrame(sizes, "source string, bytes long"))))
    assert weights["small"] == 16 and abs(weights["big"] / 16 / math.sqrt(10**5) - 1) < 1 / 32
    docs = [(i, "x" * 9, "big") for i in range(9000)] + [(10**6 + i, "x" * 9, "small") for i in range(40)]
    table = spark.createDataFrame(list(weights.items()), "source string, weight long")
    assert check_law(mixing.mix(spark.createDataFrame(docs, SCHEMA), table, block_bytes=10).collect(), weights) < 1


def test_small_sources_are_not_rounded_up(spark):
    totals = spark.createDataFrame([("a", 10_000_000_000), ("b", 10_000)], "source string, bytes long")
    got = dict(rows(mixing.tempered_weights(totals)))
    assert abs(got["a"] / got["b"] / 1000 - 1) < 1 / 32


def test_edge_rows(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.mixed_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([(None, None, None), (1, "", "a"), (1, "", "a"), (1, "", "a")], SCHEMA).withColumn("block", F.lit(7))
    got = mixing.mix(docs)
    assert got.count() == 4 and got.select("source", "place").distinct().count() == 4
    assert rows(mixing.mixed_documents(docs)) == rows(docs)


def test_the_plan_has_no_python(spark):
    text = plan(QUERIES["op9_source_mix"](spark, SMALL))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
