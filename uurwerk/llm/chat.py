"""Chat formatting by incremental rendering of a black-box template.

A template is any function from a list of (role, text) turns to a string. The
turns of a conversation are rendered one prefix after another; what a prefix adds
to the one before is its last turn's span. A prefix that does not start with the
one before shows a template that rewrites history. Inside an assistant's span the
text is located after the header that the template writes for an empty turn.

``chat_template`` marks turns and escapes control strings reversibly: ``<`` and any
backslashes before ``|`` get one backslash more, so no text contains ``<|``.

Edge cases: null roles and texts are empty; turns with equal numbers are ordered by
role, then text; a null turn number comes first; repeated rows are turns of their
own; a null conversation id is a conversation; an empty table gives an empty result.

Rendering every prefix costs the square of a conversation's length in time, and one
conversation's text in memory: conversations are streamed from sorted partitions,
one at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uurwerk.llm.common import runs

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """Roles stand on a line of their own, so line ends are written as ``\\n``."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    parts = unescape(role).split("\\\\")
    return "\\".join(p.replace("\\n", "\n") for p in parts)


def chat_template(turns: list[Turn]) -> str:
    return "".join(f"<|im_start|>{escape_role(role)}\n{escape(text)}<|im_end|>\n" for role, text in turns)


def read_back(formatted: str) -> list[Turn]:
    """The turns of a text that ``chat_template`` made."""
    out = []
    for part in formatted.split("<|im_start|>")[1:]:
        role, _, rest = part.partition("\n")
        out.append((unescape_role(role), unescape(rest.removesuffix("<|im_end|>\n"))))
    return out


def _common_start(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def render(
    turns: list[Turn], template: Template, encode: Callable[[str], str] = lambda t: t, trained: frozenset[str] = frozenset({"assistant"})
):
    """(formatted, spans, rewritten_at): spans are (turn, start, end, start and end of
    the text to learn or None); rewritten_at is the first turn whose rendering changed
    what stood before, or None.

    ``encode`` is what the template does to a text. For a template that rewrites
    history only the last turn's span is certain: earlier ones are dropped.
    """
    before, spans, rewritten_at = template([]), [], None
    for k, (role, text) in enumerate(turns):
        now = template(turns[: k + 1])
        start = len(before)
        if not now.startswith(before):
            rewritten_at = k if rewritten_at is None else rewritten_at
            start = _common_start(before, now)
            spans = []
        learn = None
        if role in trained:
            # An empty text in this turn's place shows the header; the text follows it.
            empty = template([*turns[:k], (role, "")])
            header = _common_start(empty, template([*turns[:k], (role, "x")]))
            written = encode(text)
            if now[header : header + len(written)] == written:
                learn = header, header + len(written)
        spans.append((k, start, len(now), learn))
        before = now
    return before, spans, rewritten_at


FORMATTED = "formatted string, spans array<struct<turn:int,start:int,end:int,learn_start:int,learn_end:int>>, rewritten_at int"


def format_conversations(
    rows: DataFrame,
    template: Template = chat_template,
    encode: Callable[[str], str] = escape,
    trained: frozenset[str] = frozenset({"assistant"}),
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row for each conversation: conv_id, formatted text, spans of turns with the
    part to learn, and the turn at which the template rewrote history (or null)."""
    narrow = rows.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(f"`{role}`", F.lit("")).alias("role"),
        F.coalesce(f"`{text}`", F.lit("")).alias("text"),
        # A null id is no id that is written so.
        F.coalesce(F.concat(F.lit("="), F.col(f"`{conv_id}`").cast("string")), F.lit("")).alias("_conv"),
    )
    kind = narrow.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in runs(batches, "_conv"):
            turns = list(zip(table["role"].to_pylist(), table["text"].to_pylist()))
            formatted, spans, rewritten_at = render(turns, template, encode, trained)
            listed = [
                dict(zip(("turn", "start", "end", "learn_start", "learn_end"), (k, s, e, *(learn or (None, None)))))
                for k, s, e, learn in spans
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    table["conv_id"].slice(0, 1).combine_chunks(),
                    pa.array([formatted]),
                    pa.array(
                        [listed],
                        pa.list_(pa.struct([(n, pa.int32()) for n in ("turn", "start", "end", "learn_start", "learn_end")])),
                    ),
                    pa.array([rewritten_at], pa.int32()),
                ],
                ["conv_id", "formatted", "spans", "rewritten_at"],
            )

    order = ["_conv", "turn", "role", "text"]
    return narrow.repartition("_conv").sortWithinPartitions(*order).mapInArrow(work, f"conv_id {kind}, {FORMATTED}")


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from the formatted text and its spans."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {n: [] for n in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for formatted, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = read_back(formatted)
                whole = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = "".join(
                    unescape(formatted[s["learn_start"] : s["learn_end"]]) for s in spans if s["learn_start"] is not None
                )
                out["n_turns"].append(len(turns))
                out["turns_sha256"].append(hashlib.sha256(whole.encode()).hexdigest())
                out["loss_chars"].append(len(loss))
                out["loss_sha256"].append(hashlib.sha256(loss.encode()).hexdigest())
                out["formatted_chars"].append(len(formatted))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, pa.string() if n.endswith("256") else pa.int64()) for n, v in out.items())],
                ["conv_id", *out],
            )

    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return formatted.select("conv_id", "formatted", "spans").mapInArrow(work, schema)
