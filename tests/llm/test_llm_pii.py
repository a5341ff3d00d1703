import hashlib
import re

import pytest
from helpers import rows
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from uurwerk.llm import pii
from uurwerk.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


@given(st.text(alphabet=st.sampled_from(list("0123456789.+-() @ab_%é,")), max_size=60))
@settings(max_examples=1500, deadline=None)
@example("a@b.c@d.e.f x@y @z.q a@-.- 1.2.3.4.5.6.7.8 256.1.1.1 001.002.3.255")
@example("4111 1111-1111 1111 +1 (2)3 45678 900+12345678 0000000000000000")
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000 + "@", "a" * 300_000 + "@b", "1." * 100_000, "+1" + " " * 200_000, "@" * 200_000, "a@" * 100_000):
        pii.found_in(text)


def test_every_document_against_the_patterns(spark):
    got = {r.doc_id: r for r in QUERIES["op7_personal_data"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want, r = plain(d.text or ""), got[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for k, _, _ in want) for n in PATTERNS]
        digest = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(digest.encode()).hexdigest()
        assert set(digest.split(",")) <= set(r.spans.split(","))


def test_reliabilities_are_recovered():
    """Counted votes of labelers with known error rates."""
    from itertools import product

    yes, no, prior = [0.95, 0.8, 0.7, 0.6, 0.9], [0.05, 0.1, 0.3, 0.2, 0.5], 0.4
    patterns = {}
    for votes in product("01", repeat=5):
        p = q = 1.0
        for v, y, n in zip(votes, yes, no):
            p, q = p * (y if v == "1" else 1 - y), q * (n if v == "1" else 1 - n)
        patterns["phone", "".join(votes)] = round(100_000 * (prior * p + (1 - prior) * q))
    posterior, rates = pii.reliabilities(patterns, 2000)
    for (a, b), y, n in zip(rates["phone"], yes, no):
        assert abs(a - y) < 0.03 and abs(b - n) < 0.03
    assert posterior["phone", "11111"] > 0.99 and posterior["phone", "00000"] < 0.01


def test_added_spans_need_classifier_and_votes(spark):
    docs = [(i, f"please call me, phone (243) 555-{1000 + i} today") for i in range(60)]
    docs += [(100 + i, f"reach me at +1 (243) 555-{1000 + i} now") for i in range(60)]
    docs += [(200 + i, f"order id {1000000 + i} was sent") for i in range(60)]
    docs += [(300, "Mr James Miller wrote"), (301, "The Big House stood"), (302, "ask joe at example.com today")]
    got = dict(rows(pii.find_personal_data(spark.createDataFrame(docs, "doc_id long, text string")), "doc_id", "spans"))
    assert got[0] == "phone:22:36" and got[100].startswith("phone:12:")
    assert got[300] == "name:3:15" and got[301] == ""
    assert got[200] == "" and all("phone" in got[100 + i] for i in range(60))


@pytest.mark.parametrize(
    "text, kind, value",
    [
        ("Mr James Miller", "name", "James Miller"),
        ("Dear Mary Smith", "name", "Mary Smith"),
        ("Contact James Miller", "name", "James Miller"),
        ("Aisha Rahman", "name", "Aisha Rahman"),
        ("Dr. Aisha Rahman", "name", "Aisha Rahman"),
        ("met Mr Okafor there", "name", "Okafor"),
        ("Yesterday James Miller left", "name", "James Miller"),
        ("joe at example.com", "email", "joe at example.com"),
        ("joe at example.com. Next", "email", "joe at example.com"),
        ("ann (at) site dot org", "email", "ann (at) site dot org"),
    ],
)
def test_plain_cases_are_candidates(text, kind, value):
    assert (kind, value) in [(k, text[s:e]) for k, s, e in pii.candidate_spans(text)]


@given(st.text(alphabet=st.sampled_from(list("0123456789.+-() @ab")), max_size=60))
@settings(max_examples=800, deadline=None)
@example("1.1.1.1+2.2.2.2+3.3.3.3+4.4.4.4+5.5.5.5+6.6.6.6.(243)5551234@x.yz")
def test_added_candidates_never_overlap_base_spans(text):
    found = pii.found_in(text)
    base = [(s["start"], s["end"]) for s in found if s["base"]]
    assert all(e <= s["start"] or s["end"] <= b for s in found if not s["base"] for b, e in base)


def test_recall_of_added_spans(spark):
    """Names, numbers and addresses in sentences, with and without a sign that says so,
    among as many texts with look-alikes."""
    given_names = sorted(pii.GIVEN_NAMES)
    family = "Miller Okafor Rahman Novak Silva Haugen Moreau Tanaka Weber Rossi".split()
    docs, want = [], {}

    def put(before, value, after, kind=None):
        doc_id = len(docs)
        docs.append((doc_id, before + value + after))
        want[doc_id] = kind and f"{kind}:{len(before)}:{len(before) + len(value)}"

    for i in range(120):
        put("yesterday ", f"{given_names[i % len(given_names)]} {family[i % 10]}", " came by", "name")
        put("a letter for Dr. ", f"Aisha {family[i % 10]}", " came by", "name")
        put("phone ", f"(243) 555-{1000 + i}", " after five", "phone")
        put("mail ", f"user{i} (at) site{i} dot org", " for more", "email")
        put("we saw the ", f"Green {family[i % 10]}s Park", " again")
        put("order id ", f"{1000000 + i}", " was sent")
        put("they met at ", f"noon in hall {i}", " as planned")
    got = dict(rows(pii.find_personal_data(spark.createDataFrame(docs, "doc_id long, text string")), "doc_id", "spans"))
    planted = [d for d, span in want.items() if span]
    assert sum(want[d] in got[d].split(",") for d in planted) >= 0.9 * len(planted)
    clean = [d for d, span in want.items() if not span]
    assert sum(got[d] == "" for d in clean) >= 0.98 * len(clean)


def test_nulls_empties_repeats_and_clashes(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a@b.cd"), (3, "a@b.cd"), (3, "a@b.cd")], "doc_id long, text string")
    docs = docs.withColumn("found", F.lit(1)).withColumn("spans", F.lit("x"))
    got = rows(pii.find_personal_data(docs), "doc_id", "n_email", "spans")
    assert got == [(1, 0, ""), (2, 0, ""), (3, 1, "email:0:6"), (3, 1, "email:0:6"), (None, 1, "email:0:6")]
    assert pii.find_personal_data(docs.limit(0)).count() == 0


def test_masking():
    assert pii.mask("to a@b.cd, é 1.2.3.4", "email:3:9,ip:13:20") == "to <email>, é <ip>"
    assert pii.mask("x", "") == "x"
