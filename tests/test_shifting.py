import random

import pytest
from pyspark.sql import functions as F

from helpers import day, frame, plan, rows, ts
from uurwerk.operators.dedup import dedup_latest
from uurwerk.operators.shifting import rank_cheapest, scenario_expand, shift_to_cheapest

SCHEMA = (
    "site string, date_local date, hour_utc timestamp_ntz, electricity_price_eur_per_kwh double, "
    "is_dark_enough_for_lighting boolean, is_lighting_on_baseline boolean"
)
DAY = day("2024-01-01")


def hour(n, price, dark, on, site="a", date=DAY):
    return (site, date, ts(f"{date} {n:02d}:00"), price, dark, on)


def optimized(spark, data, by=("site",)):
    result = shift_to_cheapest(frame(spark, SCHEMA, data), by=by)
    return [r[1] for r in rows(result, "hour_utc", "is_lighting_on_optimized")]


def test_cheapest_eligible_hours_win_and_a_tie_goes_to_the_earlier_hour(spark):
    data = [hour(0, 5.0, True, True), hour(1, 2.0, True, False), hour(2, 2.0, True, False), hour(3, 1.0, False, False)]
    assert optimized(spark, data) == [False, True, False, False]


def test_one_unpriced_hour_keeps_the_baseline_of_its_whole_day(spark):
    data = [hour(0, 5.0, True, True), hour(1, 2.0, True, False), hour(2, None, False, False)]
    assert optimized(spark, data) == [True, False, False]
    other = [hour(n, p, d, o, date=day("2024-01-02")) for n, p, d, o in [(0, 5.0, True, True), (1, 2.0, True, False)]]
    assert optimized(spark, data + other) == [True, False, False, False, True]


def test_missing_radiation_is_off_on_a_priced_day_and_copied_otherwise(spark):
    priced = [hour(0, 5.0, None, None), hour(1, 2.0, True, True)]
    assert optimized(spark, priced) == [False, True]
    unpriced = [hour(0, None, None, None), hour(1, 2.0, True, True)]
    assert optimized(spark, unpriced) == [None, True]


def test_no_eligible_hour_means_no_light(spark):
    assert optimized(spark, [hour(n, 1.0, False, False) for n in range(3)]) == [False] * 3


def test_ranks_count_only_eligible_hours(spark):
    data = [hour(0, 1.0, False, False), hour(1, 3.0, True, True), hour(2, 2.0, True, False), hour(3, 9.0, None, None)]
    ranked = rank_cheapest(frame(spark, SCHEMA, data), by=["site"])
    got = [r[1:] for r in rows(ranked, "hour_utc", "price_rank_among_dark_hours", "lighting_hours_in_day", "unpriced_hours_in_day")]
    assert got == [(None, 1, 0), (2, 1, 0), (1, 1, 0), (None, 1, 0)]


@pytest.mark.parametrize("seed", [1, 2])
def test_shifting_is_fair_and_optimal(spark, seed):
    rng = random.Random(seed)
    data = []
    for site in "abc":
        for d in range(1, 6):
            for n in range(24):
                dark = rng.random() < 0.6
                price = None if rng.random() < 0.01 else rng.randrange(20) / 4
                data.append(hour(n, price, dark, dark and rng.random() < 0.5, site, day(f"2024-01-0{d}")))
    shifted = shift_to_cheapest(frame(spark, SCHEMA, data), by=["site"]).collect()
    groups = {}
    for r in shifted:
        groups.setdefault((r["site"], r["date_local"]), []).append(r)
    for members in groups.values():
        n = sum(bool(r["is_lighting_on_baseline"]) for r in members)
        on = [r for r in members if r["is_lighting_on_optimized"]]
        assert len(on) == n
        if all(r["electricity_price_eur_per_kwh"] is not None for r in members):
            best = sorted(r["electricity_price_eur_per_kwh"] for r in members if r["is_dark_enough_for_lighting"])[:n]
            assert sum(r["electricity_price_eur_per_kwh"] for r in on) == sum(best)
        else:
            assert all(r["is_lighting_on_optimized"] == r["is_lighting_on_baseline"] for r in members)


def test_both_windows_share_one_exchange(spark):
    text = plan(shift_to_cheapest(frame(spark, SCHEMA, [hour(0, 1.0, True, True)]), by=["site"]))
    assert text.count("Exchange hashpartitioning") == 1


def test_scenarios_are_expanded_in_one_pass(spark):
    shifted = shift_to_cheapest(frame(spark, SCHEMA, [hour(0, 5.0, True, True), hour(1, 2.0, True, False)]), by=["site"])
    long = scenario_expand(shifted, {"baseline": "is_lighting_on_baseline", "optimized": "is_lighting_on_optimized"})
    assert [r[1:] for r in rows(long, "hour_utc", "scenario", "is_lighting_on")] == [
        ("baseline", True),
        ("optimized", False),
        ("baseline", False),
        ("optimized", True),
    ]
    assert plan(long).count("Exchange hashpartitioning") == 1


def test_latest_row_per_key_is_limited_before_the_shuffle(spark):
    df = frame(
        spark,
        "k string, t timestamp_ntz, v int",
        [("a", ts("2024-01-01 00:00"), 1), ("a", ts("2024-01-01 04:00"), 2), ("b", None, 3), ("b", ts("2024-01-01"), 4)],
    )
    latest = dedup_latest(df, ["k"], [F.col("t").desc()])
    assert rows(latest, "k", "v") == [("a", 2), ("b", 4)]
    assert latest.columns == df.columns
    text = plan(latest)
    assert "WindowGroupLimit" in text and "Partial" in text
