import hashlib
import random
import re

import pytest
from helpers import rows
from pyspark.sql import functions as F

from uurwerk.llm import decontam
from uurwerk.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(docs, items, n=13):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1) if w else ():
            windows.setdefault(tuple(w[i : i + size]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (at := tuple(w[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[at]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=lambda r: tuple(map(str, r)))


def digest(found):
    return found.select(
        "doc_id",
        "hits.n_words",
        decontam.hit_words(),
        F.size("hits.items"),
        F.sha2(F.concat_ws(",", F.array_sort("hits.items")).cast("binary"), 256),
        decontam.contaminated(),
    )


def test_given_tables_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(docs, items)
    assert rows(QUERIES["op10_decontamination"](spark, SMALL)) == want
    assert any(r[5] for r in want) and any(r[2] == 0 for r in want)


@pytest.mark.parametrize("max_words", [5_000_000, 40])
def test_random_texts_short_items_and_several_blocks(spark, max_words):
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 13, 14, 30]))) for i in range(12)] + [(3, text(20)), (None, text(15)), (99, None)]
    items += [(50, "quite other words " * 9)]
    docs = [(i, text(rng.choice([0, 1, 5, 40, 200]))) for i in range(40)] + [(100, None), (101, ""), (100, "a b")]
    docs += [(102, "QUITE—other, words! quite/other\nwords " * 3), (103, "é" * 50_000 + " a b")]
    found = decontam.find_hits(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        max_words=max_words,
    )
    assert rows(digest(found)) == brute(docs, items)


def test_spans_and_documents_are_removed(spark):
    passage = "One two three four five six seven eight nine ten eleven twelve thirteen"
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    far = " ".join(f"w{i}" for i in range(400))
    docs = spark.createDataFrame(
        [(1, f"Before, {passage.upper()}! After.", "x"), (2, "clean", "y"), (3, far + " " + passage, "z"), (4, None, "n")],
        "doc_id long, text string, hits string",
    )
    cut = dict(rows(decontam.remove_spans(docs, bench), "doc_id", "text"))
    assert cut == {1: "Before, ! After.", 2: "clean", 3: far + " ", 4: None}
    assert rows(decontam.drop_contaminated(docs, bench), "doc_id") == [(2,), (3,), (4,)]
    with pytest.raises(ValueError):
        decontam.find_hits(docs, bench)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert rows(digest(decontam.find_hits(docs, bench)))[0][:4] == (1, 2, 0, 0)
    assert decontam.find_hits(docs.limit(0), bench).count() == 0


def test_a_long_item_is_cut_into_overlapping_pieces(spark, monkeypatch):
    monkeypatch.setattr(decontam, "PIECE_WORDS", 5)
    item = " ".join(f"w{i}" for i in range(60))
    docs = [(1, " ".join(f"w{i}" for i in range(7, 40))), (2, " ".join(f"w{i}" for i in range(7, 18)))]
    found = decontam.find_hits(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    )
    assert rows(digest(found)) == brute(docs, [(1, item)])


def test_a_benchmark_of_long_words_is_scanned_in_blocks(spark):
    """The bound counts bytes: eight words of a thousand letters are more than a few hundred bytes."""
    items = [(i, chr(0x4E00 + i) * 1000) for i in range(8)]
    docs = spark.createDataFrame([(i, f"{t} x") for i, t in items] + [(9, "x")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = rows(decontam.find_hits(docs, bench), "doc_id", "hits")
    assert rows(decontam.find_hits(docs, bench, max_bytes=9000), "doc_id", "hits") == whole
    assert sum(len(h.items) for _, h in whole) == 8
