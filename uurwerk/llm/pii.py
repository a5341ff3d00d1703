"""Personal data by weak supervision.

Candidate spans are voted on by labelers: patterns, checksums, gazetteers and the
words around. How often the votes fall together is counted over all documents;
expectation-maximisation over these counts estimates how reliable each labeler is
and how likely each pattern of votes is personal. With those as soft labels a naive
Bayes classifier over the spans' own features, counted over all candidates again,
makes the final decision. Spans of the four base kinds always stay.

Candidates beyond the base kinds are runs of two or more capitalised words (one, behind a
title), numbers with separators, and addresses with a written-out at sign.

Edge cases: null texts are empty; a text without a candidate has no span; added
spans never overlap base ones or each other (the earlier, then the longer stays);
equal rows get equal spans; a kind of candidate that never occurs adds nothing; only
the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uurwerk.session import materialize

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "name")
LABELERS = ("pattern", "checksum", "gazetteer", "context", "bounds")
CONTEXT = 40
MAX_SHAPES = 20_000

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# Candidates beyond the base patterns.
_AT = re.compile(r"(?<![\w.+-])[\w.+-]{1,64}(?:\s?\(at\)\s?|\s?\[at\]\s?|\sat\s)[\w-]{1,63}(?:(?:\.|\s?\(dot\)\s?|\s?\[dot\]\s?|\sdot\s)[\w-]{1,63})+")
_AT_SIGN = re.compile(r"\(at\)|\[at\]|\sat\s")
_NUMBER = re.compile(r"(?<![\w+])\(?[0-9](?:[ ().-]{0,2}[0-9]){6,14}+(?!\w)")
_CAPITALS = re.compile(r"(?<!\w)[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{1,20}(?!\w)(?: [A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{1,20}(?!\w))*")

# Gazetteers and cue words.
DOMAINS = frozenset("com org net edu gov io de fr es uk nl eu info".split())
GIVEN_NAMES = frozenset(
    "James Mary John Patricia Robert Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica "
    "Thomas Sarah Charles Karen Anna Maria Peter Paul Hans Jan Pierre Marie Jean Carlos Juan Jose Ana Luis Sofia Emma".split()
)
CUES = {
    "email": ("mail", "contact", "write", "courriel", "correo"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "telefon", "llama"),
    "name": (
        "mr", "mrs", "ms", "miss", "dr", "prof", "sir", "dear", "contact", "name", "named",
        "herr", "frau", "monsieur", "madame", "señor", "señora",
    ),
}
TITLES = frozenset("mr mrs ms miss dr prof sir herr frau monsieur madame señor señora".split())
# Words that start a sentence or a heading, and days and months: no part of a name.
NO_NAMES = frozenset(
    "the this that these those a an in on at of and or but for from to with when where while if as it he she we they i you "
    "my our your his her its there here what who why how not no yes new all some many most after before since until then "
    "monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september "
    "october november december".split()
)
COUNTER_CUES = frozenset(("version", "isbn", "issn", "order", "id", "no", "sha", "page", "section", "token", "hash"))
_CUE_WORD = re.compile(r"[^\W\d_]+")
_LEADING = NO_NAMES.union(*CUES.values())


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the four base kinds, by kind, then start."""
    out = []
    at, floor = text.find("@"), 0
    while at >= 0:
        run = text[floor:at]
        start = floor + len(run.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append(("email", start, domain.end()))
        floor = domain.end() if domain else at + 1
        at = text.find("@", floor)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = _digits(m.group())
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_digits(m.group())) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


def candidate_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans that might be personal data though no base pattern has them."""
    out = []
    if _AT_SIGN.search(text):
        out += [("email", m.start(), m.end()) for m in _AT.finditer(text)]
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            n = len(_digits(m.group()))
            out.append(("card" if n >= 13 else "phone", m.start(), m.end()))
    for m in _CAPITALS.finditer(text):
        out += [("name", start, end) for start, end in _names(text, m.start(), m.end())]
    return out


def _names(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """The names a run of capitalised words may hold: the run behind the titles, cues and
    sentence words it starts with, and each part that a listed given name begins, three
    words at most. A word by itself is one only behind a title."""
    words, at = [], start
    for word in text[start:end].split(" "):
        words.append((at, word))
        at += len(word) + 1
    first = 0
    while first < len(words) and words[first][1].lower() in _LEADING:
        first += 1
    rest = words[first:]
    if not rest:
        return
    title = words[first - 1][1].lower() if first else _word_before(text, start)
    if len(rest) > 1 or title in TITLES:
        yield rest[0][0], end
    for i, (place, word) in enumerate(rest):
        if word in GIVEN_NAMES and (i or len(rest) > 3) and i + 1 < len(rest):
            at, last = rest[min(i + 2, len(rest) - 1)]
            yield place, at + len(last)


def _word_before(text: str, start: int) -> str:
    """The lower-cased word right before a place, a dot between them or not."""
    found = _CUE_WORD.findall(text[max(0, start - 14) : start].rstrip(" ."))
    return found[-1].lower() if found and text[start - 1 : start] in (" ", ".") else ""


def votes(text: str, kind: str, start: int, end: int, is_base: bool) -> str:
    """A character for each labeler: 1 personal, 0 not, - no opinion."""
    value = text[start:end]
    digits = _digits(value)
    before = [w.lower() for w in _CUE_WORD.findall(text[max(0, start - CONTEXT) : start])]
    pattern = "1" if is_base else "-"
    if kind == "card":
        checksum = "1" if 16 <= len(digits) <= 19 and luhn(digits) else "0"
    elif kind == "ip":
        checksum = "1" if is_base else "0"
    else:
        checksum = "-"
    gazetteer = "-"
    if kind == "email":
        gazetteer = "1" if re.split(r"[^A-Za-z]+", value.lower())[-1] in DOMAINS else "0"
        if not is_base:
            pattern = "1" if "(at)" in value or "[at]" in value else "0" if "www" in value else "-"
    elif kind == "name":
        words = value.split(" ")
        # Most given names are not listed: a first word that isn't says nothing.
        gazetteer = "1" if words[0] in GIVEN_NAMES else "0" if any(w.lower() in _LEADING for w in words) else "-"
        pattern = "-" if len(words) <= 3 else "0"
    elif kind == "phone" and not is_base:
        gazetteer = "1" if re.match(r"\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}$", value) else "0"
    # A cue further away than "name is" speaks of another name.
    cue = any(w in CUES[kind] for w in before[-2 if kind == "name" else -4 :])
    counter = any(w in COUNTER_CUES for w in before[-2:])
    context = "1" if cue else "0" if counter else "-"
    left, right = text[start - 1 : start], text[end : end + 1]
    bounds = "0" if left.isalnum() or right.isalnum() or left in ("=", "#", "_") else "-" if kind == "name" else "1"
    return pattern + checksum + gazetteer + context + bounds


def features(text: str, kind: str, start: int, end: int) -> list[str]:
    """What the final classifier sees: the span's length, digits, separators and shape."""
    value = text[start:end]
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", value))[:12]
    n = len(_digits(value))
    before = text[max(0, start - 2) : start].strip()
    return [
        f"length{min((end - start) // 4, 8)}",
        f"digits{min(n, 20)}",
        f"shape{shape}",
        f"left{'w' if before.isalnum() else before[-1:] or 's'}",
        f"words{min(value.count(' '), 4)}",
        f"first{value[:1] if not value[:1].isalnum() else 'd' if value[:1].isdigit() else 'l'}",
    ]


_SPAN = pa.struct(
    [
        ("kind", pa.string()),
        ("start", pa.int32()),
        ("end", pa.int32()),
        ("base", pa.bool_()),
        ("votes", pa.string()),
        ("features", pa.list_(pa.string())),
    ]
)
SPAN = "array<struct<kind:string,start:int,end:int,base:boolean,votes:string,features:array<string>>>"


def found_in(text: str | None) -> list[dict]:
    """Base spans and candidates of a text with votes and features."""
    if not text:
        return []
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    # The furthest end of the base spans up to each of them.
    furthest = list(accumulate((e for _, e in taken), max))
    out = [(k, s, e, True) for k, s, e in base]
    for kind, start, end in sorted(candidate_spans(text), key=lambda c: (c[1], -c[2])):
        before = bisect_left(taken, (end, 0))
        if not before or furthest[before - 1] <= start:
            out.append((kind, start, end, False))
    return [
        {
            "kind": k,
            "start": s,
            "end": e,
            "base": b,
            "votes": votes(text, k, s, e, b),
            "features": features(text, k, s, e),
        }
        for k, s, e, b in out
    ]


def with_candidates(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``found``, written once without the texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [found_in(t.as_py()) for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(found, pa.list_(_SPAN))], [*keep, "found"]
            )

    rows = docs.select(*[F.col(f"`{k}`").alias(k) for k in keep], F.col(f"`{text}`"))
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keep)
    return materialize(rows.mapInArrow(scan, f"{kinds}, found {SPAN}"), "candidates")


def reliabilities(patterns: dict[tuple[str, str], int], rounds: int = 100):
    """Expectation-maximisation over counted vote patterns, for each kind.

    Returns the probability that a pattern's span is personal, and for each kind and
    labeler the chance of a positive vote on personal and on other spans. An opinion
    counts as the labelers were independent given the truth; no opinion says nothing.
    """
    posterior: dict[tuple[str, str], float] = {}
    rates: dict[str, list[tuple[float, float]]] = {}
    for kind in KINDS:
        own = {v: n for (k, v), n in patterns.items() if k == kind}
        if not own:
            continue
        prior, rate = 0.5, [(0.8, 0.2)] * len(LABELERS)
        for _ in range(rounds):
            belief = {}
            for v in own:
                odds = log(prior / (1 - prior))
                for vote, (yes, no) in zip(v, rate):
                    if vote == "1":
                        odds += log(yes / no)
                    elif vote == "0":
                        odds += log((1 - yes) / (1 - no))
                belief[v] = 1 / (1 + exp(-max(-30.0, min(30.0, odds))))
            total = sum(own.values())
            prior = min(0.95, max(0.05, sum(belief[v] * n for v, n in own.items()) / total))
            after = []
            for i in range(len(LABELERS)):
                yes = [1.6, 2.0]
                no = [0.4, 2.0]
                for v, n in own.items():
                    if v[i] != "-":
                        yes[0] += n * belief[v] * (v[i] == "1")
                        yes[1] += n * belief[v]
                        no[0] += n * (1 - belief[v]) * (v[i] == "1")
                        no[1] += n * (1 - belief[v])
                after.append((yes[0] / yes[1], no[0] / no[1]))
            # Labelers are taken to be better than chance, which fixes which side is which.
            after = [(min(0.99, max(0.5, y)), max(0.01, min(0.5, x))) for y, x in after]
            if max(abs(a - c) + abs(b - d) for (a, b), (c, d) in zip(rate, after)) < 1e-9:
                break
            rate = after
        rates[kind] = rate
        posterior |= {(kind, v): b for v, b in belief.items()}
    return posterior, rates


def fit(found: DataFrame, rounds: int = 100):
    """(classifier, posterior, rates) from all candidates of ``found``.

    Reaches the driver: counts by vote pattern (3 ** labelers for each kind at most)
    and by feature of spans (shapes are at most 12 signs of a small alphabet; the
    ``MAX_SHAPES`` most frequent of each kind are used)."""
    spans = found.select(F.explode("found").alias("s")).select("s.*")
    counted = spans.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()
    posterior, rates = reliabilities({(r.kind, r.votes): r.n for r in counted}, rounds)
    rows = [(k, v, p) for (k, v), p in posterior.items()]
    if not rows:
        return {}, posterior, rates
    table = F.broadcast(found.sparkSession.createDataFrame(rows, "kind string, votes string, p double"))
    soft = spans.join(table, ["kind", "votes"])
    per = soft.select("kind", "p", F.explode("features").alias("feature")).groupBy("kind", "feature")
    sums = per.agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"), F.count(F.lit(1)).alias("n"))
    sums = materialize(sums, "features")
    sums = [
        r
        for kind in KINDS
        for r in sums.where(F.col("kind") == kind).orderBy(F.desc("n"), "feature").limit(MAX_SHAPES).collect()
    ]
    whole = {r.kind: (r.yes, r.no) for r in soft.groupBy("kind").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()}
    classifier = {("", k): log((y + 1) / (n + 1)) for k, (y, n) in whole.items()}
    for r in sums:
        yes, no = whole[r.kind]
        classifier[r.feature, r.kind] = log((r.yes + 0.5) / (yes + 1) * (no + 1) / (r.no + 0.5))
    return classifier, posterior, rates


def accepted(span: dict, classifier: dict, posterior: dict) -> bool:
    """Base spans stay; others if classifier and votes together say so and a labeler
    other than ``bounds`` votes for them."""
    if span["base"]:
        return True
    if "1" not in span["votes"][:-1]:
        return False
    odds = classifier.get(("", span["kind"]), 0.0)
    odds += sum(classifier.get((f, span["kind"]), 0.0) for f in span["features"]) / len(span["features"])
    return odds > 0 and posterior.get((span["kind"], span["votes"]), 0.0) > 0.5


def final_spans(found: list[dict], classifier: dict, posterior: dict) -> list[tuple[str, int, int]]:
    """Accepted spans by kind and start; of added ones that overlap the first stays."""
    out = [(s["kind"], s["start"], s["end"]) for s in found if s["base"]]
    last = -1
    for s in sorted((s for s in found if not s["base"]), key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= last and accepted(s, classifier, posterior):
            out.append((s["kind"], s["start"], s["end"]))
            last = s["end"]
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


def text_of(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


RESULT = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"


def find_personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, counts and digest of the base spans, and all accepted spans as
    ``kind:start:end`` (code points, end exclusive), one row for each document."""
    found = with_candidates(docs, text, (doc_id,))
    classifier, posterior, _ = fit(found)
    # Both are bounded, see ``fit``.
    model = docs.sparkSession.sparkContext.broadcast((classifier, posterior))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {n: [] for n in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
            for spans in batch.column(1).to_pylist():
                base = sorted(
                    ((s["kind"], s["start"], s["end"]) for s in spans if s["base"]),
                    key=lambda s: (BASE.index(s[0]), s[1]),
                )
                for kind in BASE:
                    out[f"n_{kind}"].append(sum(k == kind for k, _, _ in base))
                out["base_sha256"].append(hashlib.sha256(text_of(base).encode()).hexdigest())
                out["spans"].append(text_of(final_spans(spans, *model.value)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, pa.int64() if n[0] == "n" else pa.string()) for n, v in out.items())],
                [doc_id, *out],
            )

    kind = found.schema[doc_id].dataType.simpleString()
    return found.mapInArrow(decide, f"`{doc_id}` {kind}, {RESULT}")


def mask(text: str, spans: str) -> str:
    """The text with each span replaced by its kind in angle brackets."""
    parts = sorted(((int(s), int(e), k) for k, s, e in (p.split(":") for p in spans.split(",") if p)), reverse=True)
    for start, end, kind in parts:
        text = text[:start] + f"<{kind}>" + text[end:]
    return text
