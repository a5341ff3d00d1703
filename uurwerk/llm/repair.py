"""Repair of the turn structure of conversations by a run-length dynamic programme.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. Every row is
a symbol, its role's initial and its fault, and a symbol is a min-plus matrix over the
four states of that pattern: what it costs to pass the row from one state to another,
inserts before it included. Equal consecutive symbols are one run, and a run of n rows
is one matrix power, put together from cached powers by squaring. The costs to go at
the runs' borders follow from the last run to the first; the edits are then unrolled
from the front, each run halved by the same powers, always taking the smallest
letter that keeps the cost.

Edits: K keeps a row (0), R gives it the role that is due (3), D deletes it (4), I
inserts an empty turn of the role that is due (3). Blank and duplicate rows must go; a
truncated row that stays costs 3 more. As a state has only one role due beside an
opening system turn, the letters determine the repaired conversation.

Order and distribution: rows stand by (turn, nulls first; role; text), equal rows side by
side. What was seen earlier is decided by counted minima per (conversation, role,
text), which combine before they are shuffled. A conversation streams through one task
in that order, as the digest of its text must; the task holds its runs and its audit,
never its texts.

Edge cases: null roles and texts read as one space, so do null ids and turns in the
damage rule; null ids are one conversation; rows equal in all columns are repeats of
each other; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
STATES = range(4)
DUE = (2, 2, 3, 2)
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
FINAL = (0, 3)
NAMES = {2: "user", 3: "assistant"}
FAR = 1 << 60

# A row's fault.
SOUND, CUT_OFF, BLANK, REPEAT = range(4)

Matrix = tuple[tuple[int, ...], ...]
Symbol = tuple[str, int]


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in STATES) for j in STATES) for i in STATES)


def _to_go(a: Matrix, after: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(a[i][k] + after[k] for k in STATES) for i in STATES)


@cache
def _inserts() -> Matrix:
    """Any number of inserted turns; more than two never pay."""
    one = tuple(tuple(0 if i == j else INSERT if DUE[i] == j else FAR for j in STATES) for i in STATES)
    return _times(one, one)


def _symbol(initial: str, fault: int) -> Symbol:
    """What a row means to the programme: a row that must go is the same whatever its role."""
    return ("-", BLANK) if fault in (BLANK, REPEAT) else (initial if initial in KEPT else "-", fault)


@cache
def _row(symbol: Symbol) -> Matrix:
    initial, fault = symbol
    costs = [[FAR] * 4 for _ in STATES]
    more = TRUNCATED if fault == CUT_OFF else 0
    for i in STATES:
        costs[i][i] = DELETE
        if fault in (SOUND, CUT_OFF):
            costs[i][DUE[i]] = min(costs[i][DUE[i]], REROLE + more)
            kept = KEPT.get(initial, {}).get(i)
            if kept is not None:
                costs[i][kept] = min(costs[i][kept], KEEP + more)
    return tuple(map(tuple, costs))


@cache
def _power(symbol: Symbol, k: int) -> Matrix:
    """The transition of 2 ** k equal rows."""
    if k == 0:
        return _times(_inserts(), _row(symbol))
    half = _power(symbol, k - 1)
    return _times(half, half)


def _before(symbol: Symbol, n: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before n equal rows."""
    for k in range(n.bit_length()):
        if n >> k & 1:
            after = _to_go(_power(symbol, k), after)
    return after


def _one(symbol: Symbol, state: int, after: tuple[int, ...], out: list[str]) -> int:
    """The letters of one row and the state behind it."""
    here = _to_go(_power(symbol, 0), after)
    initial, fault = symbol
    more = TRUNCATED if fault == CUT_OFF else 0
    stays = fault in (SOUND, CUT_OFF)
    while True:
        if here[state] == DELETE + after[state]:
            out.append("D")
            return state
        if here[state] == INSERT + here[DUE[state]]:
            out.append("I")
            state = DUE[state]
            continue
        kept = KEPT.get(initial, {}).get(state) if stays else None
        if kept is not None and here[state] == KEEP + more + after[kept]:
            out.append("K")
            return kept
        out.append("R")
        return DUE[state]


def _unroll(symbol: Symbol, n: int, state: int, after: tuple[int, ...], out: list[str]) -> int:
    """The letters of n equal rows: the later half's costs to go come from a cached power."""
    if n == 1:
        return _one(symbol, state, after, out)
    half = 1 << ((n - 1).bit_length() - 1)
    state = _unroll(symbol, n - half, state, _before(symbol, half, after), out)
    return _unroll(symbol, half, state, after, out)


def cheapest_edits(runs: list[tuple[Symbol, int]]) -> tuple[int, str]:
    """Cost and letters of the cheapest repair of runs of equal symbols, of equal costs the
    ASCII-least letters."""
    after = _to_go(_inserts(), tuple(0 if s in FINAL else FAR for s in STATES))
    borders = [after]
    for symbol, n in reversed(runs):
        borders.append(_before(symbol, n, borders[-1]))
    borders.reverse()
    state, out = 0, []
    for k, (symbol, n) in enumerate(runs):
        state = _unroll(symbol, n, state, borders[k + 1], out)
    while state not in FINAL:
        out.append("I")
        state = DUE[state]
    return borders[0][0], "".join(out)


def _spaced(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def rows_of(conversations: DataFrame) -> DataFrame:
    """The four columns with ``times``, how often a row stands there, and ``_key``, a
    conversation's id as text that is never null."""
    return conversations.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("_key"),
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.lit(1).alias("times"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of :func:`rows_of` after the damage that crc32 of ``conv_id:turn`` decides: dropped,
    emptied, without sentence ends, repeated, or given to the user."""
    kind = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20
    marked = rows.withColumn("_kind", kind).where("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    return marked.select(
        "_key",
        "conv_id",
        "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("_kind") == 3, F.col("times") * 2).otherwise(F.col("times")).alias("times"),
    )


def _prepared(rows: DataFrame) -> DataFrame:
    """Each row's fault as far as its own text and earlier turns decide it, in the order of
    the conversations."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    own = (
        F.when(F.length(trimmed) == 0, BLANK)
        .when(F.substring(trimmed, -1, 1).isin(*ENDS), SOUND)
        .otherwise(CUT_OFF)
    )
    mark = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    marked = rows.withColumns({"_mark": mark, "_own": own})
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = marked.groupBy("_key", "_mark").agg(F.min(place).alias("_first"))
    found = marked.join(first, ["_key", "_mark"]).withColumn("_earlier", ~F.col("_first.turn").eqNullSafe(F.col("turn")))
    # Explicit, so that a conversation never spans tasks.
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = found.repartition(width, "_key").sortWithinPartitions("_key", "turn", "role", "text")
    return order.select(
        "_key", "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "times", "_mark", "_own", "_earlier"
    )


AUDIT = (
    "_key string, conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string"
)


class _Conversation:
    """Counts and runs of one conversation, row after row."""

    def __init__(self, key: str, conv_id):
        self.key, self.conv_id = key, conv_id
        self.faults = [0, 0, 0, 0]
        self.illegal = 0
        self.runs: list[list] = []
        self.last_initial = self.last_place = None
        self.low = self.high = self.last_turn = None
        self.turns = 0

    def _symbol(self, initial: str, fault: int, times: int) -> None:
        symbol = _symbol(initial, fault)
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += times
        else:
            self.runs.append([symbol, times])
        self.faults[fault] += times

    def add(self, turn, initial: str, times: int, mark: bytes, own: int, earlier: bool) -> None:
        again = BLANK if own == BLANK else REPEAT
        first = again if earlier or self.last_place == (turn, mark) else own
        self._symbol(initial, first, 1)
        if times > 1:
            self._symbol(initial, again, times - 1)
        pairs = ("su", "ua", "au")
        if self.last_initial is not None and self.last_initial + initial not in pairs:
            self.illegal += 1
        if initial + initial not in pairs:
            self.illegal += times - 1
        self.last_initial, self.last_place = initial, (turn, mark)
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn

    def row(self) -> tuple:
        cost, audit = cheapest_edits([(s, n) for s, n in self.runs])
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        faults = self.faults
        return self.key, self.conv_id, int(gaps), faults[BLANK], faults[REPEAT], faults[CUT_OFF], self.illegal, cost, audit


def audits(rows: DataFrame) -> DataFrame:
    """One row for each conversation that has rows: its faults, the cost of its cheapest repair
    and the edits' initials."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    prepared = _prepared(rows)
    arrow = pa.schema(
        [("_key", pa.string()), ("conv_id", _arrow_type(rows, "conv_id"))]
        + [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        + [("audit", pa.string())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        for batch in batches:
            for key, conv_id, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or current.key != key:
                    if current is not None:
                        done.append(current.row())
                    current = _Conversation(key, conv_id)
                current.add(*row)
            if done:
                yield flush()
        if current is not None:
            done.append(current.row())
            yield flush()

    return prepared.mapInArrow(work, AUDIT.format(kind=kind))


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, object, list[tuple]]]:
    """The repaired rows in pieces: key, id, [(edit, role, text)]. A conversation's first row
    carries its audit; its last piece ends with a None."""
    key = conv_id = audit = None
    at = state = 0

    def inserted(out: list) -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, DUE[state]
            out.append(("I", NAMES[state], ""))

    for batch in batches:
        out: list = []
        for row_key, row_id, part, role, text, times in zip(*(c.to_pylist() for c in batch.columns)):
            if part == 0:
                if key is not None:
                    inserted(out)
                    yield key, conv_id, [*out, None]
                    out = []
                key, conv_id, audit, at, state = row_key, row_id, text, 0, 0
                continue
            for _ in range(times):
                inserted(out)
                letter, at = audit[at], at + 1
                if letter == "K":
                    state = KEPT[role[:1]][state]
                    out.append(("K", role, text))
                elif letter == "R":
                    state = DUE[state]
                    out.append(("R", NAMES[state], text))
        if out:
            yield key, conv_id, out
    if key is not None:
        out = []
        inserted(out)
        yield key, conv_id, [*out, None]


def _with_audits(rows: DataFrame, audited: DataFrame) -> DataFrame:
    none = F.lit(None)
    heads = audited.select(
        "_key", "conv_id", none.cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"),
        F.col("audit").alias("text"), F.lit(1).alias("times"), F.lit(0).alias("_part"),
    )
    both = heads.union(rows.select("_key", "conv_id", "turn", "role", "text", "times", F.lit(1).alias("_part")))
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = both.repartition(width, "_key").sortWithinPartitions("_key", "_part", "turn", "role", "text")
    return order.select("_key", "conv_id", "_part", "role", "text", "times")


def repaired(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, edit (K, R or I), role and text."""
    kind, arrow = rows.schema["conv_id"].dataType.simpleString(), _arrow_type(rows, "conv_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for _, conv_id, piece in _replayed(batches):
            kept = [r for r in piece if r is not None]
            if kept:
                edits, roles, texts = zip(*kept)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([conv_id] * len(kept), arrow),
                        pa.array(range(place, place + len(kept)), pa.int64()),
                        pa.array(edits, pa.string()),
                        pa.array(roles, pa.string()),
                        pa.array(texts, pa.string()),
                    ],
                    ["conv_id", "place", "edit", "role", "text"],
                )
            place = 0 if len(kept) < len(piece) else place + len(kept)

    return _with_audits(rows, audited).mapInArrow(
        work, f"conv_id {kind}, place bigint, edit string, role string, text string"
    )


def repaired_digests(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """_key and the digest of each repaired conversation's ``role:text`` lines."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, started = hashlib.sha256(), False
        for key, _, piece in _replayed(batches):
            for row in piece:
                if row is None:
                    yield pa.RecordBatch.from_pydict({"_key": [key], "repaired_sha256": [digest.hexdigest()]})
                    digest, started = hashlib.sha256(), False
                else:
                    line = f"{row[1]}:{row[2]}".encode("utf-8", "surrogatepass")
                    digest.update(b"\n" + line if started else line)
                    started = True

    return _with_audits(rows, audited).mapInArrow(work, "_key string, repaired_sha256 string")
