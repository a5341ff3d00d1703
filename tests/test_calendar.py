import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from helpers import day, frame, rows, ts
from uurwerk.functions.clock import parse_utc, to_local, to_utc, trunc_hour
from uurwerk.operators.calendar import date_dimension, hour_spine

ZONE = "Europe/Amsterdam"


def spine(spark, start, run, **kw):
    request = frame(spark, "start_date date, run_date date", [(day(start), day(run))])
    return hour_spine(request, ZONE, **kw)


def test_clock_change_days_have_23_and_25_hours(spark):
    counts = dict(rows(spine(spark, "2025-03-29", "2025-10-26").groupBy("date_local").count()))
    assert counts[day("2025-03-30")] == 23
    assert counts[day("2025-10-26")] == 25
    assert {n for d, n in counts.items() if d not in (day("2025-03-30"), day("2025-10-26"))} == {24}


def test_spine_runs_through_the_last_hour_of_tomorrow(spark):
    hours = [r[0] for r in rows(spine(spark, "2024-01-01", "2024-01-02"), "hour_utc")]
    assert hours[0] == ts("2023-12-31 23:00:00")
    assert hours[-1] == ts("2024-01-03 22:00:00")
    assert len(hours) == len(set(hours)) == 72


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Europe/Amsterdam"])
def test_local_attributes_match_the_zone_database(spark, zone, session_zone):
    zone(session_zone)
    for utc, local, date, hour in rows(spine(spark, "2024-03-30", "2024-03-31")):
        wall = utc.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(ZONE)).replace(tzinfo=None)
        assert (local, date, hour) == (wall, wall.date(), wall.hour)


def test_each_site_has_its_own_range_and_empty_ranges_vanish(spark):
    request = frame(
        spark,
        "site string, start_date date, run_date date",
        [("a", day("2024-01-01"), day("2024-01-01")), ("b", day("2024-01-05"), day("2024-01-01"))],
    )
    result = hour_spine(request, ZONE, by=["site"], ahead_days=0)
    assert rows(result.groupBy("site").count()) == [("a", 24)]


def test_ambiguous_and_skipped_wall_clock(spark):
    df = frame(spark, "w timestamp_ntz", [(ts("2024-10-27 02:30"),), (ts("2024-03-31 02:30"),)])
    utc = [r[0] for r in df.select(to_utc(F.col("w"), ZONE)).collect()]
    assert utc == [ts("2024-10-27 00:30"), ts("2024-03-31 01:30")]


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_hours_are_truncated_without_the_session_zone(spark, zone, session_zone):
    zone(session_zone)
    df = frame(spark, "t timestamp_ntz", [(ts("2024-03-10 02:45:10.5"),)])
    assert df.select(trunc_hour(F.col("t"))).first()[0] == ts("2024-03-10 02:00")
    assert df.select(to_local(F.col("t"), ZONE)).first()[0] == ts("2024-03-10 03:45:10.5")


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_iso_text_is_read_as_utc(spark, zone, session_zone):
    zone(session_zone)
    cases = {
        "2024-03-10T02:30:00Z": "2024-03-10 02:30",
        "2024-03-10T02:30": "2024-03-10 02:30",
        "2024-03-10 02:30:15.123456+02:00": "2024-03-10 00:30:15.123456",
        "2024-03-10": "2024-03-10 00:00",
        "2024-03-10T02:30:00-0100": "2024-03-10 03:30",
        "2024-03-10T02:30+01:00": "2024-03-10 01:30",
    }
    df = frame(spark, "t string", [(t,) for t in cases])
    assert dict(rows(df.select("t", parse_utc(F.col("t"))))) == {k: ts(v) for k, v in cases.items()}


def test_text_that_is_no_time_stops_the_job(spark):
    df = frame(spark, "t string", [("soon-ish, perhaps",)])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(parse_utc(F.col("t"))).collect()


def test_date_dimension(spark):
    days = frame(spark, "date_local date", [(day(d),) for d in ("2024-12-30", "2024-12-30", "2025-04-26", "2025-07-01")])
    holidays = frame(
        spark,
        "holiday_date date, is_public_holiday boolean, holiday_name string, holiday_types string",
        [(day("2025-07-01"), True, "Midsummer", "Public"), (day("2024-12-30"), False, "Quiet day", "School")],
    )
    got = {r["date_day"]: r.asDict() for r in date_dimension(days, holidays).collect()}
    assert len(got) == 3
    monday = got[day("2024-12-30")]
    assert (monday["iso_week"], monday["day_of_week"], monday["day_name"], monday["quarter"]) == (1, 2, "Monday", 4)
    assert (monday["season"], monday["month_name"], monday["is_non_working_day"]) == ("Winter", "December", False)
    saturday = got[day("2025-04-26")]
    assert saturday["is_weekend"] and saturday["is_non_working_day"] and not saturday["is_public_holiday"]
    assert saturday["holiday_name"] is None and saturday["season"] == "Spring"
    tuesday = got[day("2025-07-01")]
    assert tuesday["is_public_holiday"] and tuesday["is_non_working_day"] and not tuesday["is_weekend"]
