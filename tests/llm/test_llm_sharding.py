import zlib

import pytest
from helpers import rows

from uurwerk.llm import sharding
from uurwerk.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def check_shards(docs, placed, shards):
    assert sorted(r.doc_id for r in placed) == sorted(d[0] for d in docs)
    texts = dict((d[0], d[1] or "") for d in docs)
    by_shard = {}
    for r in placed:
        raw = texts[r.doc_id].encode()
        assert r.size == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
        by_shard.setdefault(r.shard, []).append(r)
    assert set(by_shard) <= set(range(shards))
    for members in by_shard.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    sizes = [sum(r.size for r in by_shard.get(s, [])) for s in range(shards)]
    largest = max(r.size for r in placed)
    assert max(sizes) - min(sizes) <= 2 * largest
    return by_shard


def test_shards_of_the_documents_are_even(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = QUERIES["op1_kd_sharding"](spark, SMALL)
    check_shards([(r.doc_id, r.text) for r in docs.collect()], got.collect(), 16)
    assert [t for _, t in got.dtypes[:7]] == ["bigint", "bigint", "bigint", "string", "int", "bigint", "int"]


def test_a_group_of_copies_is_split_only_by_medians(spark):
    docs = [(i, "same text", "en", "s", 9) for i in range(300)] + [(i, f"text {i}" * 3, "de", "s", 9) for i in range(300, 900)]
    placed = sharding.assign_shards(spark.createDataFrame(docs, SCHEMA), levels=3).collect()
    by_shard = check_shards(docs, placed, 8)
    crc = zlib.crc32(b"same text")
    whole = sum(len(m) for m in by_shard.values() if all(r.text_crc32 == crc for r in m))
    mixed = [m for m in by_shard.values() if len({r.text_crc32 == crc for r in m}) == 2]
    assert len(mixed) <= 2 and whole > 0


def test_levels_follow_the_target():
    assert [sharding.levels_for(t, 100) for t in (0, 1, 100, 101, 200, 201, 1600)] == [0, 0, 0, 1, 1, 2, 4]


def test_leaves_reach_the_target_bytes(spark):
    docs = [(i, "x" * 9, "en", "s", 9) for i in range(64)]
    placed = sharding.assign_shards(spark.createDataFrame(docs, SCHEMA), target_bytes=80).collect()
    by_shard = check_shards(docs, placed, 8)
    assert {len(m) for m in by_shard.values()} == {8}


def test_nulls_ties_repeats_and_long_texts(spark):
    docs = [(1, None, None, None, None), (2, "", None, "s", 0), (3, "é" * 100_000, "fr", "s", 1)] + [(4, "x", "en", "s", 1)] * 3 + [(None, "x", "en", "s", 1)]
    placed = sharding.assign_shards(spark.createDataFrame(docs, SCHEMA), levels=2).collect()
    assert len(placed) == 7 and sorted(r.size for r in placed) == [1, 1, 2, 2, 2, 2, 200_001]
    whole = sharding.shard_documents(spark.createDataFrame(docs, SCHEMA), levels=2)
    assert rows(whole.drop("shard", "slot")) == rows(spark.createDataFrame(docs, SCHEMA))
    assert whole.select("shard", "slot").distinct().count() == 7


def test_empty_table_and_clashing_names(spark):
    assert sharding.assign_shards(spark.createDataFrame([], SCHEMA), levels=4).count() == 0
    clash = spark.createDataFrame([(1, "a", "en", 5)], "doc_id long, text string, lang string, _node int")
    assert rows(sharding.assign_shards(clash, levels=1), "doc_id") == [(1,)]
    with pytest.raises(ValueError):
        sharding.shard_documents(spark.createDataFrame([(1, "a", "en", 5)], "doc_id long, text string, lang string, shard int"))


def test_the_plan_has_no_python(spark):
    from helpers import plan

    text = plan(QUERIES["op1_kd_sharding"](spark, SMALL))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
