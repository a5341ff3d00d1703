import pytest
from pyspark.sql import functions as F

from helpers import frame, rows
from uurwerk.sources.tables import read_table, table_schema, upsert
from uurwerk.sources.variants import _members, reconciled, split_by_type


def load(spark, path, *payloads):
    df = frame(spark, "k int, payload string", list(payloads))
    batch = split_by_type(df, {"value": "value", "mix wind": "wind"}, table_schema(spark, path), keep=["k"])
    upsert(path, batch.withColumn("day", F.lit("a")), ["k"], "day")
    return read_table(spark, path)


def test_types_of_one_field_are_kept_apart_from_load_to_load(spark, tmp_path):
    path = f"{tmp_path}/t"
    table = load(spark, path, (1, '{"value": 7, "mix wind": 1}'), (2, '{"value": null}'))
    assert table.columns == ["k", "value", "wind", "day"] and dict(table.dtypes)["value"] == "bigint"
    table = load(spark, path, (3, '{"value": 2.5, "mix wind": 2}'), (4, '{"value": 3}'))
    assert table.columns == ["k", "value", "value__v_double", "wind", "day"]
    table = load(spark, path, (5, '{"value": "1e1"}'), (6, '{"value": "none", "mix wind": true}'), (1, '{"value": 0.25}'))
    want = [
        (1, None, 0.25, None), (2, None, None, None), (3, None, 2.5, None), (4, 3, None, None), (5, None, None, "1e1"),
        (6, None, None, "none"),
    ]
    assert rows(table, "k", "value", "value__v_double", "value__v_string") == want
    assert rows(table, "k", "wind", "wind__v_boolean")[-1] == (6, None, True)
    assert rows(table.select("k", reconciled(table, "value").alias("v"))) == [(1, 0.25), (2, None), (3, 2.5), (4, 3.0), (5, 10.0), (6, None)]
    # A load without the field, and one without rows, leave all columns as they are.
    names = table.columns
    assert load(spark, path, (7, "{}")).columns == names and load(spark, path).columns == names


def test_a_first_load_of_several_types(spark):
    df = frame(spark, "payload string", [('{"a": 1}',), ('{"a": 1.5}',), ('{"a": "x"}',), ('{"a": {"b": [1, 2]}}',), ("{}",)])
    got = split_by_type(df, {"a": "a"})
    assert got.dtypes == [("a", "double"), ("a__v_string", "string")]
    assert rows(got) == sorted([(1.0, None), (1.5, None), (None, "x"), (None, '{"b":[1,2]}'), (None, None)], key=lambda r: tuple(map(str, r)))
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        split_by_type(frame(spark, "payload string", [('{"a": ',)]), {"a": "a"}).collect()


def test_names_of_types_are_read_whole():
    text = "OBJECT<a: DECIMAL(3,1), `b c`: OBJECT<x: ARRAY<BIGINT>, y: VARIANT>, d: VOID>"
    assert _members(text) == {"a": "DECIMAL(3,1)", "b c": "OBJECT<x: ARRAY<BIGINT>, y: VARIANT>", "d": "VOID"}
    assert _members("VOID") == {}
