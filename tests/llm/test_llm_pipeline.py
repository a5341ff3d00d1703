"""Each stage of the pipeline against its own brute force on its own input."""

import os
import sys

import pytest
from helpers import rows
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from test_llm_decontam import brute as hits_of
from test_llm_simhash import classes_of

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as driver  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare import compare, connect  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from uurwerk.llm import mixing, sharding  # noqa: E402
from uurwerk.llm.oracles import ORACLES  # noqa: E402
from uurwerk.llm.queries import QUERIES  # noqa: E402
from uurwerk.session import materialize  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SMALL), name))
    return out


def test_toxicity_removes_what_it_predicts(spark, steps):
    predicted = dict(rows(QUERIES["op4_toxicity"](spark, SMALL), "doc_id", "predicted"))
    want = [r for r in rows(steps[0]) if not predicted[r[0]]]
    assert rows(steps[1]) == want and 0 < len(want) < len(predicted)


def test_one_document_of_each_group_stays(steps):
    before = rows(steps[1])
    _, component = classes_of([(r[0], r[1]) for r in before])
    assert rows(steps[2]) == [r for r in before if component[r[0]] == r[0]]


def test_contaminated_documents_go(spark, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    before = rows(steps[2])
    bad = {r[0] for r in hits_of([(r[0], r[1]) for r in before], items) if r[5]}
    assert bad and rows(steps[3]) == [r for r in before if r[0] not in bad]


def test_mixing_and_sharding_keep_every_row(steps):
    assert rows(steps[4]) == rows(steps[3]) and steps[4].columns == steps[0].columns
    assert rows(steps[5].drop("shard", "slot")) == rows(steps[4])


def test_slots_of_a_shard_follow_the_mix(spark, steps):
    at = {r.doc_id: (r.slot, r.place) for r in mixing.mix(steps[3]).collect()}
    shards = {}
    for r in sorted(steps[5].collect(), key=lambda r: (r.shard, r.slot)):
        shards.setdefault(r.shard, []).append((r.slot, at[r.doc_id]))
    assert len(shards) > 1
    for held in shards.values():
        assert [s for s, _ in held] == list(range(len(held)))
        assert [p for _, p in held] == sorted(p for _, p in held)


def test_run_equals_the_stages(spark, steps):
    assert rows(corpus_pipeline.run(spark, SMALL), "doc_id") == rows(steps[5], "doc_id")


# Every name that an operator gives a column of its own, in other letters as well.
INTERNAL = [
    "_id", "_CRC", "_nth", "_slot", "_Place", "_at", "_none", "_fp", "_root", "_component", "_toxicity", "_hits", "_key", "_kept0",
    "Fp", "score", "hits", "size", "block", "place", "text_crc32", "root", "node", "words", "_range", "_shuffled", "TEXT", "Doc_ID",
]


def test_columns_of_any_name_pass_through(spark, steps):
    docs = steps[0]
    wide = docs.toDF(*docs.columns).select("*", *[F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in INTERNAL[:-2]])
    names = [*docs.columns, *INTERNAL]
    wide = wide.select("*", F.col("doc_id").alias("_a"), F.col("doc_id").alias("_b")).toDF(*names)
    found, at = wide, len(docs.columns)
    for (name, stage), want in zip(corpus_pipeline.STAGES, steps[1:]):
        found = materialize(stage(spark, found, SMALL).toDF(*[f"c{k}" for k in range(len(names) + 2 * (name == "sharding"))]), name)
        if name != "sharding":
            found = found.toDF(*names)
        got = sorted((tuple(r) for r in found.collect()), key=lambda r: r[0])
        given = {r[0]: r for r in (tuple(r) for r in want.collect())}
        assert [r[0] for r in got] == sorted(given)
        for r in got:
            assert r[:at] + r[len(names) :] == given[r[0]]
            assert r[at : len(names)] == (*[f"{n}:{r[0]}" for n in INTERNAL[:-2]], r[0], r[0])
    with pytest.raises(ValueError, match="Shard"):
        sharding.shard_documents(docs.withColumn("Shard", F.lit(1)), levels=2)


def test_mixing_and_sharding_do_not_depend_on_how_schedules_are_dealt(spark, monkeypatch):
    """Sources of uneven sizes, one without a name; slots in shards follow the mix."""
    names = [None, *"abcde"]
    rows = [(i, "x" * (60_000 + 999 * (i % 7)), names[min(5, i % 11)], "en") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")

    def found():
        mixed = [r.doc_id for r in corpus_pipeline.mixing_stage(spark, docs, SMALL).select("doc_id").collect()]
        return mixed, sorted(tuple(r) for r in corpus_pipeline.sharding_stage(spark, docs, SMALL).select("doc_id", "shard", "slot").collect())

    whole = found()
    monkeypatch.setattr(mixing, "MAX_SOURCES", 1)
    monkeypatch.setattr(mixing, "PIECE", 64, raising=False)
    assert found() == whole


def test_sources_named_by_any_bytes_have_the_same_places_however_schedules_are_dealt(spark, monkeypatch):
    """Two of the names are not UTF-8; in Python they read alike."""
    names = F.array(*[F.unhex(F.lit(n)).cast("string") for n in ("C328", "C128", "EFBFBD28", "61")])
    docs = spark.range(90).select(
        F.col("id").alias("doc_id"),
        F.expr("repeat('x', int(60000 + 999 * (id % 7)))").alias("text"),
        F.get(names, F.least(F.col("id") % 6, F.lit(3)).cast("int")).alias("source"),
        F.lit("en").alias("lang"),
    )

    def found():
        mixed = [r.doc_id for r in corpus_pipeline.mixing_stage(spark, docs, SMALL).select("doc_id").collect()]
        return mixed, sorted(tuple(r) for r in corpus_pipeline.sharding_stage(spark, docs, SMALL).select("doc_id", "shard", "slot").collect())

    short = found()
    assert sorted(short[0]) == [r[0] for r in short[1]] == list(range(90))
    monkeypatch.setattr(mixing, "MAX_SOURCES", 1)
    assert found() == short


def test_empty_documents_pass_through(spark, steps):
    docs = steps[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0


def test_queries_and_sql_are_registered():
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())
    assert [n.split("_")[0] for n in QUERIES] == [f"op{n}" for n in range(1, 14)] + ["pipeline"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    verdict, _ = compare(spark, connect(SMALL), SMALL, name)
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict
