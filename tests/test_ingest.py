import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import day, frame, plan, rows, ts
from uurwerk.session import scratch_path, shared_folder
from uurwerk.sources import ranges, records, tables, versions
from uurwerk.sources.chunks import chunk_source
from uurwerk.sources.landing import RequestFailed, chunked_read, landing_read
from uurwerk.sources.tables import (
    backfill_by_year,
    layer_path,
    merge_rows,
    read_raw,
    read_table,
    register_view,
    upsert,
    write_table,
)

RANGES = "s date, e date"


def chunks(spark, fn, *data):
    df = frame(spark, RANGES, [(day(a), day(b)) for a, b in data])
    return rows(fn(df), "chunk_start", "chunk_end")


@pytest.mark.parametrize("size", [1, 7, 10, 30])
def test_fixed_chunks_tile_the_range(spark, size):
    got = chunks(spark, lambda d: ranges.chunk_ranges(d, "s", "e", size), ("2024-01-01", "2024-03-05"))
    assert got[0][0] == day("2024-01-01") and got[-1][1] == day("2024-03-05")
    for (_, end), (start, _) in zip(got, got[1:]):
        assert start == end + dt.timedelta(days=1)
    assert all((b - a).days + 1 == size for a, b in got[:-1])
    assert 1 <= (got[-1][1] - got[-1][0]).days + 1 <= size


def test_fixed_chunk_edges(spark):
    def plan(*data):
        return chunks(spark, lambda d: ranges.chunk_ranges(d, "s", "e", 10), *data)

    assert plan(("2024-01-01", "2024-01-01")) == [(day("2024-01-01"), day("2024-01-01"))]
    assert plan(("2024-01-02", "2024-01-01")) == []


def test_year_chunks(spark):
    def plan(*data):
        return chunks(spark, lambda d: ranges.year_chunks(d, "s", "e"), *data)

    assert plan(("2022-06-15", "2024-02-10")) == [
        (day("2022-06-15"), day("2022-12-31")),
        (day("2023-01-01"), day("2023-12-31")),
        (day("2024-01-01"), day("2024-02-10")),
    ]
    assert plan(("2024-03-01", "2024-03-05")) == [(day("2024-03-01"), day("2024-03-05"))]
    assert plan(("2023-12-31", "2024-01-01")) == [(day("2023-12-31"),) * 2, (day("2024-01-01"),) * 2]
    assert plan(("2024-05-01", "2024-03-05")) == []


def test_days_are_expanded_with_both_ends(spark):
    df = frame(spark, RANGES, [(day("2024-02-28"), day("2024-03-01")), (day("2024-01-02"), day("2024-01-01"))])
    assert [r[0] for r in rows(ranges.expand_days(df, "s", "e"), "day")] == [
        day("2024-02-28"),
        day("2024-02-29"),
        day("2024-03-01"),
    ]


def test_requests_are_clipped_to_availability(spark):
    requests = frame(
        spark,
        "signal string, s date, e date",
        [
            ("late", day("2017-01-01"), day("2017-12-31")),
            ("late", day("2016-01-01"), day("2016-12-31")),
            ("late", day("2018-01-01"), day("2018-12-31")),
            ("unknown", day("2010-01-01"), day("2010-12-31")),
        ],
    )
    starts = frame(spark, "signal string, available_from date", [("late", day("2017-04-30"))])
    got = rows(ranges.clip_ranges(requests, starts, "signal", "s", "e"), "signal", "effective_start", "e")
    assert got == [
        ("late", day("2017-04-30"), day("2017-12-31")),
        ("late", day("2018-01-01"), day("2018-12-31")),
        ("unknown", day("2010-01-01"), day("2010-12-31")),
    ]


def test_a_short_availability_list_is_broadcast_whatever_the_settings(spark, no_auto_broadcast):
    requests = frame(spark, "signal string, s date, e date", [("a", day("2017-01-01"), day("2017-12-31"))])
    starts = frame(spark, "signal string, available_from date", [("a", day("2017-04-30"))])
    text = ranges.clip_ranges(requests, starts, "signal", "s", "e")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text


def test_trailing_window_is_whole_days_and_reaches_the_scan(spark, tmp_path):
    data = [(ts(t),) for t in ("2024-01-12 23:59", "2024-01-13 00:00", "2024-01-20 23:59", "2024-01-21 12:00")]
    frame(spark, "t timestamp_ntz", data).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    window = ranges.trailing_window(df, "t", day("2024-01-20"))
    assert [r[0] for r in rows(window)] == [ts("2024-01-13 00:00"), ts("2024-01-20 23:59")]
    assert "GreaterThanOrEqual(t" in window._jdf.queryExecution().executedPlan().toString()
    assert ranges.trailing_window(df, "t", day("2024-01-20"), ahead_days=1).count() == 3
    for lookback in (0, 61):
        with pytest.raises(ValueError):
            ranges.trailing_window(df, "t", day("2024-01-20"), lookback)


def test_flat_records(spark):
    payload = (
        '{"data": [{"datetime": "2024-01-01T00:00:00.000Z", "carbonIntensity": 300, "isEstimated": true, '
        '"createdAt": "2024-01-02T00:00:00Z", "updatedAt": "2024-01-03T00:00:00Z", "other": 1}, '
        '{"datetime": "2024-01-01T01:00:00.000Z"}]}'
    )
    df = frame(spark, "payload string", [(payload,), ('{"data": []}',), ("{}",)])
    assert rows(records.flat_records(df, "carbonIntensity")) == [
        (ts("2024-01-01 00:00"), 300.0, True, ts("2024-01-02"), ts("2024-01-03")),
        (ts("2024-01-01 01:00"), None, None, None, None),
    ]


@pytest.mark.parametrize("payload", ['{"data": [{"value": 1.0}]}', '{"data": [{"datetime": '])
def test_bad_payloads_stop_the_job(spark, payload):
    with pytest.raises(Exception, match="required key datetime|MALFORMED|Malformed|malformed"):
        records.flat_records(frame(spark, "payload string", [(payload,)]), "value").collect()


def test_nested_objects_are_flattened_by_path(spark):
    df = frame(spark, "id int, mix struct<wind: int, flows: struct<imports: int, exports: int>>", [(1, (2, (3, 4))), (5, None)])
    flat = records.flatten_struct(df, "mix")
    assert flat.columns == ["id", "mix__wind", "mix__flows__imports", "mix__flows__exports"]
    assert rows(flat) == [(1, 2, 3, 4), (5, None, None, None)]


def test_parallel_arrays(spark):
    df = frame(spark, "time array<string>, a array<double>, b array<double>", [(["t0", "t1", "t2"], [1.0, None, None], [None, None, 3.0, 9.0])])
    assert rows(records.arrays_to_rows(df, "time", ["a", "b"])) == [("t0", 1.0, None), ("t2", None, 3.0)]


@pytest.mark.parametrize("short", [[1.0], None])
def test_a_short_or_missing_array_stops_the_job(spark, short):
    df = frame(spark, "time array<string>, a array<double>", [(["t0", "t1"], short)])
    with pytest.raises(Exception, match="array a is missing or shorter"):
        records.arrays_to_rows(df, "time", ["a"]).collect()


def test_lists_become_a_child_table(spark):
    df = frame(spark, "date string, types array<string>", [("d1", ["x", "y"]), ("d2", []), ("d3", None)])
    parent, child = records.split_list(df, ["date"], "types")
    assert parent.columns == ["date", "_row_id"]
    joined = child.join(parent, child["_parent_id"] == parent["_row_id"])
    assert rows(joined, "date", "_position", "value") == [("d1", 0, "x"), ("d1", 1, "y")]


PLAN = "series string, chunk_start date, chunk_end date"
HOURS = T.StructType().add("hour_utc", T.TimestampNTZType()).add("value", T.DoubleType())


def read(spark, fetch, first="2024-01-01", last="2024-01-20"):
    request = frame(spark, "series string, s date, e date", [("a", day(first), day(last))])
    return chunked_read(ranges.chunk_ranges(request, "s", "e", 10), fetch, HOURS)


def fake(bad_days, status=500):
    def fetch(series, first, last):
        days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
        if any(str(d) in bad_days for d in days):
            raise RequestFailed(status)
        return [{"hour_utc": dt.datetime(d.year, d.month, d.day, h), "value": float(h)} for d in days for h in range(24)]

    return fetch


def test_one_bad_day_does_not_lose_its_chunk(spark):
    got = read(spark, fake({"2024-01-05"}))
    assert rows(got.where("status = 'skipped'"), "series", "day") == [("a", day("2024-01-05"))]
    loaded = got.where("status = 'loaded'")
    assert loaded.count() == 19 * 24 and loaded.select("hour_utc").distinct().count() == 19 * 24


def source(spark, fetch, first="2024-01-01", last="2024-01-20"):
    request = frame(spark, "series string, s date, e date", [(n, day(first), day(last)) for n in ("a", "b")])
    return chunk_source(ranges.chunk_ranges(request, "s", "e", 10), fetch, HOURS, "hour_utc")


def logged(folder, fetch):
    def asked(series, first, last):
        with open(f"{folder}/{series}_{first}_{last}", "a") as handle:
            handle.write("x")
        return fetch(series, first, last)

    return asked


def test_the_source_answers_like_the_chunked_read(spark):
    got = source(spark, fake({"2024-01-05"}))
    assert got.rdd.getNumPartitions() == 4
    assert rows(got.where("status = 'skipped'"), "series", "day") == [("a", day("2024-01-05")), ("b", day("2024-01-05"))]
    loaded = got.where("status = 'loaded'")
    assert loaded.count() == 2 * 19 * 24 and loaded.where("day <> to_date(hour_utc)").count() == 0
    with pytest.raises(Exception, match="RequestFailed: 403"):
        source(spark, fake({"2024-01-05"}, 403)).collect()


def test_filters_reach_the_plan_of_the_source(spark, tmp_path):
    cases = [
        (F.col("series") == "a", {("a", "2024-01-01", "2024-01-10"), ("a", "2024-01-11", "2024-01-20")}),
        ((F.col("day") >= day("2024-01-09")) & (F.col("day") < day("2024-01-12")) & F.col("series").isin("b", "c"),
         {("b", "2024-01-09", "2024-01-10"), ("b", "2024-01-11", "2024-01-11")}),
        ((F.col("day") == day("2024-01-15")) & (F.col("series") == "a"), {("a", "2024-01-15", "2024-01-15")}),
        ((F.col("day") > day("2024-01-19")) & (F.col("day") <= day("2024-01-25")), {("a", "2024-01-20", "2024-01-20"), ("b", "2024-01-20", "2024-01-20")}),
        (F.col("day") > day("2024-02-01"), set()),
    ]
    whole = source(spark, fake(set())).cache()
    for k, (condition, want) in enumerate(cases):
        folder = tmp_path / str(k)
        folder.mkdir()
        got = source(spark, logged(str(folder), fake(set()))).where(condition)
        assert rows(got) == rows(whole.where(condition))
        asked = [f for f in folder.iterdir()]
        assert {tuple(f.name.split("_")) for f in asked} == want and all(set(f.read_text()) == {"x"} for f in asked)


@pytest.mark.parametrize("status", [401, 403])
def test_a_refused_request_stops_the_job(spark, status):
    with pytest.raises(Exception, match=f"RequestFailed: {status}"):
        read(spark, fake({"2024-01-05"}, status)).collect()


def test_refusal_on_the_day_retry_stops_the_job(spark):
    def fetch(series, first, last):
        raise RequestFailed(500 if first != last else 403)

    with pytest.raises(Exception, match="RequestFailed: 403"):
        read(spark, fetch).collect()


def test_other_errors_are_not_taken_for_missing_data(spark):
    def fetch(series, first, last):
        raise TimeoutError("no answer")

    with pytest.raises(Exception, match="TimeoutError"):
        read(spark, fetch).collect()


def test_landing_folder_keeps_partial_days_and_reports_them(spark, tmp_path):
    data = [
        ("a", dt.datetime(2024, 1, d, h), float(h), dt.date(2024, 1, d))
        for d in (1, 2, 4, 9)
        for h in range(24 if d != 2 else 23)
    ]
    df = frame(spark, "series string, hour_utc timestamp_ntz, value double, day date", data)
    df.write.partitionBy("series", "day").parquet(f"{tmp_path}/landing")
    landed = spark.read.schema(df.schema).parquet(f"{tmp_path}/landing")
    request = frame(spark, "series string, s date, e date", [("a", day("2024-01-01"), day("2024-01-04"))])
    got = landing_read(ranges.chunk_ranges(request, "s", "e", 3), landed, 24)
    reported = rows(got.where("status <> 'loaded'"), "status", "day")
    assert reported == [("partial", day("2024-01-02")), ("skipped", day("2024-01-03"))]
    loaded = got.where("status = 'loaded'")
    assert loaded.count() == 24 + 23 + 24 and got.columns == ["series", "status", "day", "hour_utc", "value"]
    assert "Python" not in plan(got) and "Arrow" not in plan(got)


@pytest.mark.parametrize(
    "expand", [lambda df: ranges.expand_days(df, "s", "e"), lambda df: ranges.chunk_ranges(df, "s", "e", 30), lambda df: ranges.year_chunks(df, "s", "e")]
)
def test_ranges_are_spread_before_they_expand(spark, expand):
    request = frame(spark, "site int, s date, e date", [(i, day("2016-01-01"), day("2023-12-31")) for i in range(200)]).coalesce(1)
    text = plan(expand(request))
    assert text.index("Generate") < text.rindex("Exchange RoundRobinPartitioning")
    expanded = expand(request).withColumn("task", F.spark_partition_id())
    assert expanded.select("task").distinct().count() == 4


SIGNAL = "k timestamp_ntz, v double, _load_id string, day string"


def signal(spark, *data):
    return frame(spark, SIGNAL, [(ts(t), v, load, t[:10]) for t, v, load in data])


def stamps(spark, path):
    """The commit that holds each partition, and the times of its files."""
    found = {}
    for value, commit in versions.current_map(spark, path).parts.items():
        folder = os.path.join(path, f"{versions.COMMIT}={commit}", f"day={value}")
        found[value] = commit, sorted(os.stat(os.path.join(folder, f)).st_mtime_ns for f in os.listdir(folder))
    return found


def test_upsert_replaces_known_keys_and_only_touched_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = signal(
        spark, ("2024-01-01 00:00", 1.0, "1"), ("2024-01-02 00:00", 2.0, "1"), ("2024-01-02 01:00", 3.0, "1"), ("2024-01-03 00:00", 4.0, "1")
    )
    upsert(path, first, ["k"], "day")
    before = stamps(spark, path)
    batch = signal(
        spark, ("2024-01-02 00:00", 20.0, "2"), ("2024-01-02 00:00", 21.0, "3"), ("2024-01-02 00:00", 9.0, "3"), ("2024-01-05 00:00", 5.0, "2")
    )
    want = [
        (ts("2024-01-01 00:00"), 1.0),
        (ts("2024-01-02 00:00"), 21.0),
        (ts("2024-01-02 01:00"), 3.0),
        (ts("2024-01-03 00:00"), 4.0),
        (ts("2024-01-05 00:00"), 5.0),
    ]
    for _ in range(2):  # a repeated load changes nothing
        upsert(path, batch, ["k"], "day")
        assert rows(read_table(spark, path), "k", "v") == want
    after = stamps(spark, path)
    assert before["2024-01-01"] == after["2024-01-01"]
    assert before["2024-01-03"] == after["2024-01-03"]
    assert before["2024-01-02"] != after["2024-01-02"]


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    upsert(path, signal(spark, ("2024-01-01 00:00", 1.0, "1")), ["k"], "day")
    before = stamps(spark, path)
    upsert(path, signal(spark), ["k"], "day")
    assert stamps(spark, path) == before


def test_a_batch_may_add_columns_but_not_lose_them(spark, tmp_path):
    path = f"{tmp_path}/t"
    upsert(path, frame(spark, "k int, v int, day string", [(1, 1, "a"), (2, 2, "a")]), ["k"], "day")
    upsert(path, frame(spark, "k int, v int, w int, day string", [(2, 20, 5, "a")]), ["k"], "day")
    assert rows(read_table(spark, path), "k", "v", "w") == [(1, 1, None), (2, 20, 5)]
    with pytest.raises(ValueError, match="w"):
        upsert(path, frame(spark, "k int, v int, day string", [(3, 3, "a")]), ["k"], "day")


def test_merge_of_frames(spark):
    target = frame(spark, "k int, v int", [(1, 1), (2, 2)])
    fresh = frame(spark, "k int, v int", [(2, 20), (3, 30)])
    assert rows(merge_rows(target, fresh, ["k"])) == [(1, 1), (2, 20), (3, 30)]


def test_null_keys_and_partitions_are_refused(spark, tmp_path):
    path = f"{tmp_path}/t"
    upsert(path, frame(spark, "k int, v int, day string", [(1, 1, "a")]), ["k"], "day")
    for bad in ((None, 2, "a"), (2, 2, None)):
        with pytest.raises(Exception, match="is NULL in a batch"):
            upsert(path, frame(spark, "k int, v int, day string", [bad, (3, 3, "b")]), ["k"], "day")
    assert rows(read_table(spark, path), "k") == [(1,)]


def test_an_empty_first_batch_is_a_normal_case(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "k int, v int, day string"
    upsert(path, frame(spark, schema, []), ["k"], "day")
    assert rows(read_table(spark, path)) == []
    upsert(path, frame(spark, schema, [(1, 1, "a")]), ["k"], "day")
    upsert(path, frame(spark, schema, []), ["k"], "day")
    assert rows(read_table(spark, path), "k", "v") == [(1, 1)]


def test_columns_of_partitions_that_other_batches_wrote_are_known(spark, tmp_path):
    path = f"{tmp_path}/t"
    upsert(path, frame(spark, "k int, v int, w int, day string", [(1, 1, 1, "z")]), ["k"], "day")
    upsert(path, frame(spark, "k int, v int, w int, x int, day string", [(2, 2, 2, 2, "a")]), ["k"], "day")
    with pytest.raises(ValueError, match="x"):
        upsert(path, frame(spark, "k int, v int, w int, day string", [(3, 3, 3, "a")]), ["k"], "day")
    assert rows(read_table(spark, path), "k", "x") == [(1, None), (2, 2)]


class Cut(BaseException):
    """The driver is gone."""


def cut_before_the_map(monkeypatch):
    monkeypatch.setattr(versions, "publish_note", lambda *a: (_ for _ in ()).throw(Cut()))


def cut_inside_the_map(monkeypatch):
    """Half of the map is there, as after a copy that was cut off."""

    def half(spark, path, body):
        Path(path).parent.mkdir(exist_ok=True)
        Path(path).write_text(body[: len(body) // 2])
        raise Cut

    monkeypatch.setattr(versions, "_write", half)


def cut_inside_the_files(monkeypatch):
    """Some of the new files are in place, and no map."""

    def partly(spark, path, rows, partition, known, *rest, **named):
        rows.limit(1).write.partitionBy(partition).parquet(f"{path}/{versions.COMMIT}=half")
        raise Cut

    monkeypatch.setattr(tables, "commit", partly)


@pytest.mark.parametrize("cut", [cut_inside_the_files, cut_before_the_map, cut_inside_the_map])
@pytest.mark.parametrize("first", [True, False])
def test_a_merge_that_is_cut_off_changes_nothing(spark, tmp_path, monkeypatch, cut, first):
    path, schema = f"{tmp_path}/t", "k int, v int, day string"
    batch = frame(spark, schema, [(1, 10, "a"), (2, 20, "b")])
    want = []
    if not first:
        upsert(path, frame(spark, schema, [(1, 1, "a"), (2, 2, "b"), (3, 3, "b")]), ["k"], "day")
        want = [(1, 1), (2, 2), (3, 3)]
    with monkeypatch.context() as m:
        cut(m)
        with pytest.raises(Cut):
            upsert(path, batch, ["k"], "day")
    if first:
        with pytest.raises(ValueError, match="not a merged table"):
            read_table(spark, path)
    else:
        assert rows(read_table(spark, path), "k", "v") == want
    upsert(path, batch, ["k"], "day")
    want = [(1, 10), (2, 20)] + ([] if first else [(3, 3)])
    assert rows(read_table(spark, path), "k", "v") == want
    # What the cut-off merge left is removed on request, and nothing else.
    versions.expire(spark, path, keep=1)
    assert rows(read_table(spark, path), "k", "v") == want
    commits = {p.name.partition("=")[2] for p in Path(path).glob(f"{versions.COMMIT}=*")}
    assert commits == set(versions.current_map(spark, path).parts.values())


def test_readers_beside_a_merge_see_the_old_or_the_new_table(spark, tmp_path, monkeypatch):
    path, schema = f"{tmp_path}/t", "k int, v int, day string"
    upsert(path, frame(spark, schema, [(1, 1, "a"), (2, 2, "b")]), ["k"], "day")
    before = read_table(spark, path)
    seen = []
    publish = versions.publish_note

    def watched(*args):
        seen.append(rows(read_table(spark, path), "k", "v"))
        number = publish(*args)
        seen.append(rows(read_table(spark, path), "k", "v"))
        return number

    monkeypatch.setattr(versions, "publish_note", watched)
    upsert(path, frame(spark, schema, [(1, 10, "a"), (2, 20, "b")]), ["k"], "day")
    assert seen == [[(1, 1), (2, 2)], [(1, 10), (2, 20)]]
    # A reader that began before the merge keeps its table, also through one more.
    upsert(path, frame(spark, schema, [(2, 30, "b")]), ["k"], "day")
    assert rows(before, "k", "v") == [(1, 1), (2, 2)]
    assert rows(read_table(spark, path), "k", "v") == [(1, 10), (2, 30)]


def test_a_merge_that_another_overtakes_starts_again(spark, tmp_path, monkeypatch):
    path, schema = f"{tmp_path}/t", "k int, v int, day string"
    upsert(path, frame(spark, schema, [(1, 1, "a")]), ["k"], "day")
    publish, calls = versions.publish_note, []

    def overtaken(*args):
        calls.append(args)
        if len(calls) == 1:
            upsert(path, frame(spark, schema, [(2, 2, "a")]), ["k"], "day")
        return publish(*args)

    monkeypatch.setattr(versions, "publish_note", overtaken)
    upsert(path, frame(spark, schema, [(3, 3, "a")]), ["k"], "day")
    assert rows(read_table(spark, path), "k", "v") == [(1, 1), (2, 2), (3, 3)]
    with pytest.raises(versions.Conflict):
        versions.commit(spark, path, frame(spark, schema, [(9, 9, "a")]), "day", versions.maps_since(spark, path, 0)[0])
    assert rows(read_table(spark, path), "k") == [(1,), (2,), (3,)]


def test_types_are_widened_or_refused_without_a_trace(spark, tmp_path):
    path = f"{tmp_path}/t"
    upsert(path, frame(spark, "k int, v int, x float, day string", [(1, 1, 1.5, "a")]), ["k"], "day")
    upsert(path, frame(spark, "k bigint, v bigint, x double, day string", [(2**40, 2**41, 0.1, "b")]), ["k"], "day")
    want = [(1, 1, 1.5), (2**40, 2**41, 0.1)]
    assert rows(read_table(spark, path), "k", "v", "x") == want
    # A narrower batch takes the table's types.
    upsert(path, frame(spark, "k int, v int, x float, day string", [(1, 7, 2.5, "a")]), ["k"], "day")
    want[0] = (1, 7, 2.5)
    assert rows(read_table(spark, path), "k", "v", "x") == want
    before = sorted(str(p) for p in Path(path).rglob("*"))
    for schema, value in (("string", "z"), ("double", 1.0), ("date", day("2024-01-01"))):
        bad = frame(spark, f"k bigint, v {schema}, x double, day string", [(3, value, 1.0, "c")])
        with pytest.raises(ValueError, match="v is bigint in the table"):
            upsert(path, bad, ["k"], "day")
    with pytest.raises(ValueError, match="day is string"):
        upsert(path, frame(spark, "k bigint, v bigint, x double, day int", [(3, 3, 1.0, 5)]), ["k"], "day")
    assert sorted(str(p) for p in Path(path).rglob("*")) == before
    assert rows(read_table(spark, path), "k", "v", "x") == want


def test_a_merge_names_the_days_it_changed(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "k int, d date, v int, _load_id string, part string"
    dates = F.array("d", F.date_add("d", 1))

    def load(load_id, *data):
        rows_ = [(k, day(d), v, load_id, d[:7]) for k, d, v in data]
        upsert(path, frame(spark, schema, rows_), ["k"], "part", days=dates)
        return versions.current_map(spark, path).days

    assert load("1", (1, "2024-01-31", 1), (2, "2024-02-05", None)) == ("2024-01-31", "2024-02-01", "2024-02-05", "2024-02-06")
    # The same values from a later load change nothing; a null that stays null neither.
    assert load("2", (1, "2024-01-31", 1), (2, "2024-02-05", None)) == ()
    assert load("3", (1, "2024-01-31", 1), (2, "2024-02-05", 5), (3, "2024-02-05", 1)) == ("2024-02-05", "2024-02-06")
    assert [m.days for m in versions.maps_since(spark, path, 1)] == [(), ("2024-02-05", "2024-02-06")]


def test_partitions_are_chosen_before_their_folders_are_listed(spark, tmp_path):
    path = f"{tmp_path}/t"
    data = [(i, i, f"20{10 + i // 12}-{i % 12 + 1:02d}") for i in range(120)]
    upsert(path, frame(spark, "k int, v int, month string", data), ["k"], "month")
    window = read_table(spark, path, lambda month: month >= "2019-11")
    assert len(window.inputFiles()) == 2 and rows(window, "k") == [(118,), (119,)]
    # A filter on the partition prunes as well.
    text = plan(read_table(spark, path).where("month = '2015-03'"))
    assert "PartitionFilters: [isnotnull(month" in text


def test_odd_partition_values(spark, tmp_path):
    path, data = f"{tmp_path}/t", [(1, 1, "a/b=c d%"), (2, 2, "é:"), (3, 3, "x")]
    for _ in range(2):
        upsert(path, frame(spark, "k int, v int, day string", data), ["k"], "day")
        assert rows(read_table(spark, path)) == data


def left_over(spark):
    folder = shared_folder(spark).removeprefix("file:")
    return {str(p) for p in Path(folder).glob("uurwerk/*")}


def test_a_merge_leaves_nothing_behind(spark, tmp_path):
    before = left_over(spark)
    for v in range(3):
        upsert(f"{tmp_path}/t", frame(spark, "k int, v int, day string", [(1, v, "a")]), ["k"], "day")
    assert left_over(spark) == before
    # The two commits of the last two maps stay for readers at work.
    assert versions.expire(spark, f"{tmp_path}/t") == 1
    assert len(list((tmp_path / "t").glob(f"{versions.COMMIT}=*"))) == 2
    assert rows(read_table(spark, f"{tmp_path}/t"), "v") == [(2,)]


def test_finished_years_survive_an_interruption(spark, tmp_path):
    path = f"{tmp_path}/years"
    source = frame(spark, "d date, v int", [(day(f"{y}-0{m}-01"), y * 10 + m) for y in (2020, 2021, 2022) for m in (1, 5)])

    def extract(first, last):
        if first.year == 2022 and not extract.ready:
            raise RequestFailed(500)
        return source.where((F.col("d") >= F.lit(first)) & (F.col("d") <= F.lit(last)))

    def backfill(first, last):
        return backfill_by_year(spark, path, day(first), day(last), extract, ["d"], "d")

    extract.ready = False
    with pytest.raises(RequestFailed):
        backfill("2020-01-01", "2022-03-01")
    assert rows(read_table(spark, path).select("year").distinct()) == [(2020,), (2021,)]
    extract.ready = True
    assert backfill("2022-01-01", "2022-03-01") == [2022]
    assert rows(read_table(spark, path), "v") == [(20201 + 0,), (20205,), (20211,), (20215,), (20221,)]
    # A part of a year, and a year in which the source has nothing, take nothing away.
    assert backfill("2021-04-01", "2021-12-31") == [2021] and backfill("2030-01-01", "2030-12-31") == [2030]
    assert read_table(spark, path).count() == 5


def test_layers_and_views(spark, tmp_path):
    assert layer_path("/lake", "prod", "marts", "dim_date") == "/lake/marts/dim_date"
    assert layer_path("/lake", "dev", "marts", "dim_date") == "/lake/dev_marts/dim_date"
    df = frame(spark, "a int, p string", [(1, "x"), (2, "y")])
    stored = write_table(df, str(tmp_path), "dev", "marts", "t", partition_by="p")
    assert rows(stored) == rows(df)
    # A full write leaves no partition of the one before; one of chosen partitions leaves all others.
    again = write_table(frame(spark, "a int, p string", [(3, "y"), (4, "z")]), str(tmp_path), "dev", "marts", "t", "p")
    assert rows(again) == [(3, "y"), (4, "z")] and rows(stored) == rows(df)
    part = write_table(frame(spark, "a int, p string", [(5, "x")]), str(tmp_path), "dev", "marts", "t", "p", lambda v: v < "z")
    assert rows(part) == [(4, "z"), (5, "x")]
    register_view(df, "dev", "staging", "t")
    assert spark.table("dev_staging_t").count() == 2


def test_raw_scan_uses_the_declared_schema(spark, tmp_path):
    frame(spark, "timestamp_utc timestamp_ntz, price_eur_per_kwh double, _load_id string", [(ts("2024-01-01"), 0.2, "1")]).write.parquet(
        f"{tmp_path}/electricity_prices"
    )
    assert read_raw(spark, str(tmp_path), "electricity_prices").first()["price_eur_per_kwh"] == 0.2


class FakeSession:
    """Just the parts of a session that the choice of the folder looks at."""

    def __init__(self, master, setting=None):
        self.master, self.setting, self.folder = master, setting, None
        self.conf = self.sparkContext = self

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.setting or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_tables_go_to_the_folder_that_the_session_names():
    cluster = FakeSession("yarn", "hdfs://shared/checkpoints/")
    assert shared_folder(cluster) == "hdfs://shared/checkpoints"
    assert scratch_path(cluster, "x").startswith("hdfs://shared/checkpoints/uurwerk/")
    assert scratch_path(cluster, "x") != scratch_path(cluster, "x")


def test_only_a_local_session_may_make_up_its_own_folder():
    with pytest.raises(RuntimeError):
        shared_folder(FakeSession("yarn"))
    local = FakeSession("local[8]")
    assert shared_folder(local) == shared_folder(local) == local.folder
