"""Payload fields whose type changes from load to load: one column for each type.

Fields are read as they come. The first type that a table sees of a field is that of its column;
values of another type go to a column of their own, ``<column>__v_<type>``, so a load never
fails on a type and never changes a stored value. :func:`reconciled` makes one number of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The types that JSON values are stored as, narrowest first.
KINDS = ("bigint", "double", "boolean", "string")


def _kind(text: str) -> str | None:
    """The stored type for a type as the engine names it; nested values are kept as their text."""
    if text == "VOID":
        return None
    if text.startswith(("DECIMAL", "DOUBLE", "FLOAT")):
        return "double"
    return {"BIGINT": "bigint", "BOOLEAN": "boolean"}.get(text, "string")


def _row_kind(field: Column) -> Column:
    name = F.schema_of_variant(field)
    return (
        F.when(name.isNull() | (name == "VOID"), F.lit(None))
        .when(name == "BIGINT", "bigint")
        .when(name.startswith("DECIMAL") | name.isin("DOUBLE", "FLOAT"), "double")
        .when(name == "BOOLEAN", "boolean")
        .otherwise("string")
    )


def _members(text: str) -> dict[str, str]:
    """The fields of ``OBJECT<a: X, b: OBJECT<c: Y>>`` with their types, nested ones whole."""
    if not text.startswith("OBJECT<"):
        return {}
    parts, depth, start, inner = [], 0, 0, text[len("OBJECT<") : -1]
    for i, c in enumerate(inner):
        depth += {"<": 1, "(": 1, ">": -1, ")": -1}.get(c, 0)
        if c == "," and not depth:
            parts.append(inner[start:i])
            start = i + 1
    pairs = [p.strip().partition(": ") for p in [*parts, inner[start:]] if p.strip()]
    return {name.strip("`"): kind for name, _, kind in pairs}


def _holds(kind: str) -> tuple[str, ...]:
    """A column of doubles takes whole numbers as well."""
    return ("bigint", "double") if kind == "double" else (kind,)


def variant_name(column: str, kind: str) -> str:
    return f"{column}__v_{kind}"


def columns_by_type(present: set[str], column: str, known: T.StructType | None) -> dict[str, str]:
    """The columns that a field needs, with their types: the table's own ones first, then what the load adds."""
    stored = {f.name: f.dataType.simpleString() for f in known.fields} if known is not None else {}
    if column in stored:
        base = stored[column]
    else:
        found = [k for k in KINDS if k in present] or ["double"]
        base = "double" if {"bigint", "double"} <= present else found[0]
    out = {column: base}
    for kind in KINDS:
        name = variant_name(column, kind)
        if name in stored or (kind in present and kind not in _holds(base)):
            out[name] = kind
    return out


def split_by_type(
    payloads: DataFrame,
    fields: Mapping[str, str],
    known: T.StructType | None = None,
    payload: str = "payload",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per payload, a JSON object: the columns ``keep`` and, for each field (name in the object → name of
    the column), one column per type. ``known`` is the schema of the table that the rows are for: its
    columns are all there, and a field keeps the type that its column has.

    One pass takes the types from the whole load, so which columns there are does not depend on
    the order of rows. Absent fields and nulls are NULL in all columns; malformed JSON stops the job.
    """
    parsed = payloads.select(*keep, F.parse_json(F.col(payload)).alias("_v"))
    found = parsed.agg(F.schema_of_variant_agg("_v")).first()[0] or ""
    members = _members(found)
    value = {name: F.expr("variant_get(_v, \"$['" + name.replace("'", "\\\\'") + "']\", 'variant')") for name in fields}
    present = {name: {_kind(members[name])} - {None} if name in members else set() for name in fields}
    mixed = [name for name in fields if members.get(name) == "VARIANT"]
    if mixed:
        kinds = parsed.agg(*[F.collect_set(_row_kind(value[name])).alias(f"k{i}") for i, name in enumerate(mixed)]).first()
        present |= {name: set(kinds[i]) for i, name in enumerate(mixed)}
    columns = []
    for name, column in fields.items():
        of_type = columns_by_type(present[name], column, known)
        for at, kind in of_type.items():
            # What the column itself holds does not stand in another one as well.
            taken = () if at == column else _holds(of_type[column])
            mine = _row_kind(value[name]).isin(*[k for k in _holds(kind) if k not in taken])
            columns.append(F.when(mine, F.try_variant_get(value[name], "$", kind)).alias(at))
    return parsed.select(*keep, *columns)


def reconciled(df: DataFrame, column: str) -> Column:
    """One double out of a field's columns; texts that are no number are NULL."""
    parts = [F.col(column)] + [F.col(variant_name(column, k)) for k in KINDS if variant_name(column, k) in df.columns]
    return F.coalesce(*[p.try_cast("double") for p in parts])
