"""Schedule, heat balance, cost, daily comparison, holidays, market."""

import pytest
from pyspark.sql import functions as F

from helpers import day, frame, plan, rows, ts
from uurwerk.functions.nulls import floor_at_zero, reconcile, safe_divide
from uurwerk.operators.balance import energy_balance, lighting_inputs
from uurwerk.operators.calendar import hour_spine
from uurwerk.operators.compare import daily_compare
from uurwerk.operators.costs import add_costs, priced_hours
from uurwerk.operators.holidays import fold_holidays
from uurwerk.operators.market import market_hourly
from uurwerk.operators.schedule import expand_schedule
from uurwerk.operators.signals import consolidate_signals
from uurwerk.params import MONTHLY_PROFILE, PROFILE_SCHEMA, SiteParams, default_profile, read_profile

P = SiteParams()


def test_floor_keeps_null_and_division_by_zero_is_null(spark):
    df = frame(spark, "x double, y double", [(-2.0, 0.0), (3.0, 2.0), (None, 1.0)])
    got = df.select(floor_at_zero(F.col("x")), safe_divide(F.col("x"), F.col("y"))).collect()
    assert [tuple(r) for r in got] == [(0.0, None), (3.0, 1.5), (None, None)]


def test_split_columns_are_joined(spark):
    df = frame(spark, "v bigint, d double", [(3, None), (None, 2.5), (None, None)])
    assert [r[0] for r in df.select(reconcile(F.col("v"), F.col("d"))).collect()] == [3.0, 2.5, None]


def profile_csv(tmp_path):
    path = tmp_path / "profile.csv"
    lines = [",".join(PROFILE_SCHEMA.names)]
    lines += [",".join("" if v is None else str(v).lower() for v in row) for row in MONTHLY_PROFILE]
    path.write_text("\n".join(lines))
    return str(path)


def test_profile_csv_is_read_by_type(spark, tmp_path):
    scanned = read_profile(spark, profile_csv(tmp_path))
    assert scanned.schema == PROFILE_SCHEMA
    assert rows(scanned) == rows(default_profile(spark))
    assert scanned.where("month = 6").first()["lights_on_hour"] is None


@pytest.mark.parametrize("source", ["values", "csv"])
def test_twelve_rows_are_broadcast_and_more_are_not(spark, tmp_path, source, no_auto_broadcast):
    profile = default_profile(spark) if source == "values" else read_profile(spark, profile_csv(tmp_path))
    request = frame(spark, "start_date date, run_date date", [(day("2024-01-01"), day("2024-01-01"))])
    spine = hour_spine(request, P.timezone)
    assert "BroadcastHashJoin" in plan(expand_schedule(spine, profile, P))
    assert "BroadcastHashJoin" not in plan(expand_schedule(spine, profile.unionByName(profile), P))


def test_schedule_follows_the_local_clock(spark):
    hours = frame(
        spark,
        "hour_utc timestamp_ntz, hour_local timestamp_ntz, date_local date, hour_of_day_local int",
        [
            (ts(u), ts(l), ts(l).date(), ts(l).hour)
            for u, l in [
                ("2024-01-10 00:00", "2024-01-10 01:00"),
                ("2024-01-10 01:00", "2024-01-10 02:00"),
                ("2024-01-10 17:00", "2024-01-10 18:00"),
                ("2024-04-10 04:00", "2024-04-10 06:00"),
                ("2024-06-10 10:00", "2024-06-10 12:00"),
                ("2024-06-10 18:00", "2024-06-10 20:00"),
            ]
        ],
    )
    got = rows(expand_schedule(hours, default_profile(spark), P), "hour_utc", "is_day", "is_lighting_scheduled", "heating_setpoint_c")
    assert [r[1:] for r in got] == [
        (False, False, 17.0),
        (False, True, 17.0),
        (True, False, 20.0),
        (True, True, 19.0),
        (True, False, 18.0),
        (False, False, 15.0),
    ]


def test_profile_per_site(spark):
    hours = frame(
        spark,
        "site string, hour_utc timestamp_ntz, hour_local timestamp_ntz, date_local date, hour_of_day_local int",
        [(s, ts("2024-01-10 11:00"), ts("2024-01-10 12:00"), day("2024-01-10"), 12) for s in "ab"],
    )
    profile = default_profile(spark).where("month = 1").crossJoin(frame(spark, "site string", [("a",)]))
    assert rows(expand_schedule(hours, profile, P, by=["site"]), "site") == [("a",)]


BALANCE = "is_lighting_on boolean, heating_setpoint_c double, temperature_c double, shortwave_radiation_w_per_m2 double"


def test_energy_balance_by_hand(spark):
    data = [
        (True, 20.0, 5.0, 0.0),  # 6*15 - 0 - 70 = 20 W/m2
        (False, 20.0, 5.0, 100.0),  # 90 - 50 = 40
        (False, 20.0, 30.0, 0.0),  # below zero
        (False, 20.0, None, 0.0),
        (True, 20.0, 5.0, None),
        (None, 20.0, 5.0, 0.0),  # unknown lamp flag counts as off
    ]
    got = [
        tuple(r)[4:] for r in energy_balance(frame(spark, BALANCE, data).coalesce(1), P).collect()
    ]
    gas = 40.0 / (0.9 * 9.77)
    assert got[0] == pytest.approx((4000.0, 200.0, 4200.0, 800.0, 20 * gas))
    assert got[1] == pytest.approx((0.0, 200.0, 200.0, 1600.0, 40 * gas))
    assert got[2] == (0.0, 200.0, 200.0, 0.0, 0.0)
    assert got[3] == (0.0, 200.0, 200.0, None, None)
    assert got[4] == (4000.0, 200.0, 4200.0, None, None)
    assert got[5] == pytest.approx((0.0, 200.0, 200.0, 3600.0, 90 * gas))


def test_hours_without_weather_vanish_and_null_flags_stay(spark):
    schedule = frame(
        spark,
        "hour_utc timestamp_ntz, is_lighting_scheduled boolean",
        [(ts(f"2024-01-01 0{h}:00"), h != 3) for h in range(4)],
    )
    weather = frame(
        spark,
        "hour_utc timestamp_ntz, temperature_c double, shortwave_radiation_w_per_m2 double",
        [(ts("2024-01-01 00:00"), 1.0, 10.0), (ts("2024-01-01 01:00"), 1.0, None), (ts("2024-01-01 03:00"), 1.0, None)],
    )
    prices = frame(
        spark, "hour_utc timestamp_ntz, electricity_price_eur_per_kwh double", [(ts("2024-01-01 00:00"), 0.3)]
    )
    got = rows(
        lighting_inputs(schedule, weather, prices, P),
        "hour_utc",
        "electricity_price_eur_per_kwh",
        "is_dark_enough_for_lighting",
        "is_lighting_on_baseline",
    )
    assert [r[1:] for r in got] == [(0.3, True, True), (None, None, None), (None, None, False)]


ENERGY = (
    "hour_utc timestamp_ntz, date_local date, scenario string, is_lighting_on boolean, electricity_kwh double, "
    "gas_m3 double, electricity_cost_eur double, gas_cost_eur double, total_energy_cost_eur double, total_co2_kg double"
)


def energy_rows(spark, data):
    out = []
    for scenario in ("baseline", "optimized"):
        for h, on, kwh, gas, ec, gc, co2 in data[scenario]:
            total = None if ec is None or gc is None else ec + gc
            out.append((ts(f"2024-01-01 {h:02d}:00"), day("2024-01-01"), scenario, on, kwh, gas, ec, gc, total, co2))
    return frame(spark, ENERGY, out)


def test_daily_comparison(spark):
    df = energy_rows(
        spark,
        {
            "baseline": [(0, True, 10.0, 1.0, 4.0, 1.0, 2.0), (1, False, 5.0, 2.0, 1.0, 2.0, 1.0)],
            "optimized": [(0, False, 5.0, 2.0, 2.0, 2.0, 1.0), (1, True, 10.0, 1.0, 2.0, 1.0, 1.5)],
        },
    )
    got = daily_compare(df).first().asDict()
    assert got["date_day"] == day("2024-01-01")
    assert (got["baseline_lighting_hours"], got["optimized_lighting_hours"], got["hours_in_day"]) == (1, 1, 2)
    assert (got["baseline_total_cost_eur"], got["optimized_total_cost_eur"]) == (8.0, 7.0)
    assert (got["baseline_electricity_kwh"], got["optimized_gas_m3"]) == (15.0, 3.0)
    assert (got["cost_savings_eur"], got["cost_savings_pct"], got["co2_savings_kg"]) == (1.0, 0.125, 0.5)
    assert got["is_complete"]


def test_a_day_without_prices_has_no_cost_but_keeps_its_energy(spark):
    hours = [(0, False, 5.0, 2.0, None, None, None)]
    got = daily_compare(energy_rows(spark, {"baseline": hours, "optimized": hours})).first().asDict()
    assert got["baseline_total_cost_eur"] is None and got["cost_savings_pct"] is None
    assert got["baseline_electricity_kwh"] == 5.0 and not got["is_complete"] and got["hours_missing_cost"] == 1


def test_a_grid_gap_alone_leaves_the_day_complete_and_zero_cost_has_no_percentage(spark):
    hours = [(0, False, 0.0, 0.0, 0.0, 0.0, None)]
    got = daily_compare(energy_rows(spark, {"baseline": hours, "optimized": hours})).first().asDict()
    assert got["is_complete"] and got["baseline_co2_kg"] is None and got["cost_savings_pct"] is None


def test_costs_stay_null_where_an_input_is_missing(spark):
    demand = frame(
        spark,
        "hour_utc timestamp_ntz, scenario string, electricity_kwh double, gas_m3 double",
        [(ts(f"2024-01-01 0{h}:00"), "baseline", 100.0, 10.0) for h in range(3)],
    )
    prices = frame(
        spark,
        "hour_utc timestamp_ntz, electricity_price_eur_per_kwh double, gas_price_eur_per_m3 double",
        [(ts("2024-01-01 00:00"), 0.2, 1.0), (ts("2024-01-01 01:00"), None, 1.0)],
    )
    grid = frame(
        spark, "hour_utc timestamp_ntz, carbon_intensity_gco2eq_per_kwh double", [(ts("2024-01-01 00:00"), 300.0)]
    )
    got = rows(
        add_costs(priced_hours(demand, prices, grid), P),
        "hour_utc",
        "electricity_cost_eur",
        "gas_cost_eur",
        "total_energy_cost_eur",
        "electricity_co2_kg",
        "gas_co2_kg",
        "total_co2_kg",
    )
    assert got[0][1:] == pytest.approx((20.0, 10.0, 30.0, 30.0, 17.8, 47.8))
    assert got[1][1:] == pytest.approx((None, 10.0, None, None, 17.8, None))
    assert got[2][1:] == pytest.approx((None, None, None, None, 17.8, None))


def test_holiday_types_are_folded(spark):
    holidays = frame(
        spark,
        "date string, local_name string, name string, country_code string, is_global boolean, _row_id string, _load_id string",
        [(f"2025-01-0{i}", "l", "n", "NL", True, f"r{i}", "x") for i in (1, 2, 3)],
    )
    types = frame(
        spark,
        "_parent_id string, value string",
        [("r1", "School"), ("r1", "Public"), ("r2", "School"), ("r2", "School"), ("r2", None), ("r9", "Public")],
    )
    got = rows(fold_holidays(holidays, types), "holiday_date", "is_public_holiday", "holiday_types")
    assert got == [
        (day("2025-01-01"), True, "Public, School"),
        (day("2025-01-02"), False, "School, School"),
        (day("2025-01-03"), False, None),
    ]


def test_market_drops_only_hours_without_price_and_grid(spark):
    prices = frame(
        spark,
        "hour_utc timestamp_ntz, electricity_price_eur_per_kwh double",
        [(ts("2024-01-01 00:00"), 0.2), (ts("2024-01-01 01:00"), None), (ts("2024-01-01 02:00"), None)],
    )
    grid = frame(spark, "hour_utc timestamp_ntz, carbon double", [(ts("2024-01-01 01:00"), None)])
    weather = frame(spark, "hour_utc timestamp_ntz, temperature_c double", [(ts("2024-01-01 00:00"), 4.0)])
    got = rows(market_hourly(prices, grid, weather))
    assert got == [(ts("2024-01-01 00:00"), 0.2, None, 4.0), (ts("2024-01-01 01:00"), None, None, None)]


def test_the_driver_signal_sets_the_grain_and_each_table_is_shuffled_once(spark, no_auto_broadcast):
    def signal(name, hours):
        return frame(spark, f"hour_utc timestamp_ntz, {name} double", [(ts(f"2024-01-01 0{h}:00"), float(h)) for h in hours])

    joined = consolidate_signals(signal("a", [0, 1]), signal("b", [1, 2]), signal("c", [0]))
    assert plan(joined).count("Exchange hashpartitioning") == 3
    assert rows(joined) == [(ts("2024-01-01 00:00"), 0.0, None, 0.0), (ts("2024-01-01 01:00"), 1.0, 1.0, None)]
