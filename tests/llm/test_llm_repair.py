import hashlib
import heapq
import itertools
import random

import pytest
from helpers import rows

from uurwerk.llm import repair

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
FAULTS = {"blank": repair.BLANK, "duplicate": repair.REPEAT, "truncated": repair.CUT_OFF, None: repair.SOUND}


def search(items):
    """Cheapest edits over (role, fault) by a shortest path over whole letter strings."""
    due, kept = {"": "u", "s": "u", "u": "a", "a": "u"}, {"s": [""], "u": ["", "s", "a"], "a": ["u"]}
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, letters, i, state = heapq.heappop(heap)
        if i == len(items) and state in ("", "a"):
            return cost, letters
        if (i, state) in done:
            continue
        done.add((i, state))
        heapq.heappush(heap, (cost + 3, letters + "I", i, due[state]))
        if i < len(items):
            role, fault = items[i]
            heapq.heappush(heap, (cost + 4, letters + "D", i + 1, state))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if state in kept.get(role[:1], []):
                    heapq.heappush(heap, (cost + more, letters + "K", i + 1, role[:1]))
                heapq.heappush(heap, (cost + 3 + more, letters + "R", i + 1, due[state]))


def judged(conversation):
    """Rows in order with their faults."""
    out, seen = [], set()
    for turn, role, text in sorted(conversation, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        left = text.rstrip(repair.BLANKS)
        fault = "blank" if not left else "duplicate" if (role, text) in seen else None if left[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def replay(rows_, letters):
    due, names = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}
    state, at, lines = "", 0, []
    for letter in letters:
        if letter == "I":
            state = due[state]
            lines.append(f"{names[state]}:")
            continue
        _, role, text, _ = rows_[at]
        at += 1
        if letter == "K":
            state = role[:1]
            lines.append(f"{role}:{text}")
        elif letter == "R":
            state = due[state]
            lines.append(f"{names[state]}:{text}")
    return lines


def brute(conv_id, conversation):
    rows_ = judged(conversation)
    turns = [r[0] for r in rows_ if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = [sum(r[3] == f for r in rows_) for f in ("blank", "duplicate", "truncated")]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows_, rows_[1:]))
    cost, letters = search([(r[1], r[3]) for r in rows_])
    return (conv_id, gaps, *count, illegal, cost, letters), "\n".join(replay(rows_, letters))


def results(spark, data):
    df = repair.rows_of(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))
    audited = repair.audits(df).cache()
    digests = dict(rows(repair.repaired_digests(df, audited)))
    keys = dict(rows(audited, "conv_id", "_key"))
    lines = {}
    for conv_id, _, _, role, text in sorted(rows(repair.repaired(df, audited)), key=lambda r: (str(r[0]), r[1])):
        lines.setdefault(conv_id, []).append(f"{role}:{text}")
    return {r[0]: (r, "\n".join(lines.get(r[0], [])), digests[keys[r[0]]]) for r in rows(audited, *COLUMNS)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_conversations_against_a_shortest_path(spark, seed):
    rng = random.Random(seed)
    data = []
    for conv in range(60):
        turn = 0
        for _ in range(rng.randrange(0, 12)):
            turn += rng.choice([0, 1, 1, 1, 2])
            role = rng.choice(["user", "assistant", "assistant", "user", "system", "tool", ""])
            data.append((conv, rng.choice([turn, turn, turn, None]), role, rng.choice(["a.", "b!", "cut", " ", "", "c? \n", "d", "é."])))
    got = results(spark, data)
    for conv, group in itertools.groupby(sorted(data, key=lambda r: r[0]), key=lambda r: r[0]):
        want, text = brute(conv, [r[1:] for r in group])
        assert got[conv] == (want, text, hashlib.sha256(text.encode()).hexdigest())


def test_all_short_symbol_strings():
    symbols = [(r, f) for r in "suax" for f in (None, "truncated", "blank")]
    for n in range(4):
        for items in itertools.product(symbols, repeat=n):
            runs = [(repair._symbol(r, FAULTS[f]), 1) for r, f in items]
            assert repair.cheapest_edits(runs) == search(list(items)), items


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 64, 100])
@pytest.mark.parametrize("role, fault", [("u", None), ("a", None), ("a", "truncated"), ("s", None), ("x", "blank")])
def test_runs_equal_their_rows_one_by_one(n, role, fault):
    symbol = repair._symbol(role, FAULTS[fault])
    one = repair.cheapest_edits([(symbol, 1)] * n)
    assert repair.cheapest_edits([(symbol, n)]) == one == search([(role, fault)] * n)


def test_long_runs_take_few_matrices():
    repair._power.cache_clear()
    cost, letters = repair.cheapest_edits([(("u", repair.SOUND), 100_000), (("a", repair.SOUND), 1)])
    assert len(letters) >= 100_001 and repair._power.cache_info().currsize <= 2 * 18
    assert cost > 0


def test_nulls_ties_repeats_and_no_rows(spark):
    data = [(None, None, None, None), (None, 1, "user", "hi."), (None, 1, "user", "hi."), (1, 3, "user", "b."), (1, 3, "user", "a."),
            (2, 1, "assistant", "x" * 300_000)]
    got = results(spark, data)
    assert got[None][0][:6] == (None, 0, 1, 1, 0, 2) and got[1][0] == brute(1, [r[1:] for r in data[3:5]])[0]
    assert got[2][0][4] == 1
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.audits(repair.rows_of(empty)).count() == 0


def test_damage_rule(spark):
    import zlib

    data = [(c, t, "assistant", "One. Two!") for c in range(12) for t in range(12)] + [(None, None, None, None)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = rows(repair.damaged(repair.rows_of(df)), "conv_id", "turn", "role", "text", "times")
    want = []
    for conv, turn, role, text in data:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", text or " "
        if kind:
            text = "" if kind == 1 else "One Two" if kind == 2 and text != " " else text
            want.append((conv, turn, "user" if kind == 4 else role, text, 2 if kind == 3 else 1))
    assert got == sorted(want, key=lambda r: tuple(map(str, r)))
    assert {r[4] for r in got} == {1, 2} and "" in {r[3] for r in got}


def test_other_columns_do_not_clash(spark):
    df = spark.createDataFrame([(1, 1, "user", "a.", "x", 7)], "conv_id long, turn long, role string, text string, _key string, times int")
    assert rows(repair.audits(repair.rows_of(df)), *COLUMNS) == [(1, 0, 0, 0, 0, 0, 3, "KI")]
