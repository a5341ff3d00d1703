import random

import pytest

from helpers import day, frame, plan, rows, ts
from uurwerk.operators.packed import pack_days, shift_days, unpack_days, with_fields
from uurwerk.operators.shifting import shift_to_cheapest

SCHEMA = (
    "site string, date_local date, hour_utc timestamp_ntz, electricity_price_eur_per_kwh double, "
    "is_dark_enough_for_lighting boolean, is_lighting_on_baseline boolean"
)
FIELDS = ["electricity_price_eur_per_kwh", "is_dark_enough_for_lighting", "is_lighting_on_baseline"]


def random_hours(seed, repeats=0.0):
    rng = random.Random(seed)
    data = []
    for site in ("a", "b", None):
        for d in range(1, 8):
            for n in range(rng.choice([23, 24, 24, 24])):
                price = rng.choice([None, float("nan")]) if rng.random() < 0.02 else rng.randrange(12) / 4
                dark = rng.choice([True, True, False, None])
                on = None if dark is None else dark and rng.random() < 0.5
                row = (site, day(f"2024-01-0{d}"), ts(f"2024-01-0{d} {n:02d}:00"), price, dark, on)
                data += [row] * (1 + (rng.random() < repeats))
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("seed, repeats", [(1, 0.0), (2, 0.0), (3, 0.2)])
def test_packed_days_shift_as_hours_do(spark, seed, repeats):
    df = frame(spark, SCHEMA, random_hours(seed, repeats))
    got = unpack_days(shift_days(pack_days(df, FIELDS, by=["site"])))
    want = shift_to_cheapest(df, by=["site"])
    columns = [c for c in want.columns if c != "electricity_price_eur_per_kwh"]
    if repeats:  # equal hours of a day that differ in nothing else may swap ranks
        columns = [c for c in columns if c not in ("is_lighting_on_baseline", "is_lighting_on_optimized", "price_rank_among_dark_hours")]
    assert rows(got, *columns) == rows(want, *columns)
    assert dict(got.dtypes) == dict(want.dtypes)


def test_a_day_is_exchanged_once_as_one_row(spark):
    df = frame(spark, SCHEMA, random_hours(4))
    text = plan(unpack_days(shift_days(pack_days(df, FIELDS, by=["site"]))))
    assert text.count("Exchange hashpartitioning") == 1 and "Window" not in text


def test_fields_see_their_hour_and_day(spark):
    df = frame(spark, SCHEMA, [("a", day("2024-01-01"), ts(f"2024-01-01 0{n}:00"), float(n), True, False) for n in (1, 0)])
    packed = with_fields(
        pack_days(df, FIELDS, by=["site"]),
        {"twice": lambda h: h["electricity_price_eur_per_kwh"] * 2, "four": lambda h: h["twice"] * 2},
    )
    assert rows(unpack_days(packed), "hour_utc", "twice", "four") == [
        (ts("2024-01-01 00:00"), 0.0, 0.0),
        (ts("2024-01-01 01:00"), 2.0, 4.0),
    ]


def test_no_hours_no_days(spark):
    assert unpack_days(shift_days(pack_days(frame(spark, SCHEMA, []), FIELDS, by=["site"]))).collect() == []
