import pytest
from pyspark.sql import functions as F

from helpers import day, frame, plan, rows, ts
from uurwerk.operators import quality, reports
from uurwerk.plans.checks import TESTS, TableTests, run_tests


@pytest.fixture
def df(spark):
    return frame(
        spark,
        "k string, n int, v double",
        [("a", 1, 0.0), ("a", 1, 100.0), ("b", 2, 100.1), ("c", 3, None), (None, 4, -1.0), (None, 4, 5.0)],
    )


def test_unique_ignores_null(df):
    assert rows(quality.unique(df, "k")) == [("a", 2)]
    assert rows(quality.unique(df, "v")) == []


def test_unique_combination(df):
    assert rows(quality.unique_combination(df, ["k", "n"])) == [(None, 4, 2), ("a", 1, 2)]


def test_not_null(df):
    assert rows(quality.not_null(df, "v"), "k") == [("c",)]


def test_accepted_range_is_inclusive_and_open_where_no_bound_is_given(df):
    assert rows(quality.accepted_range(df, "v", 0.0, 100.0), "v") == [(-1.0,), (100.1,)]
    assert rows(quality.accepted_range(df, "v", minimum=0.0), "v") == [(-1.0,)]


def test_accepted_values(df):
    assert rows(quality.accepted_values(df, "k", ["a", "c"])) == [("b", 1)]


def test_relationships_report_each_missing_key_once(spark, df):
    parent = frame(spark, "id string", [("b",), ("c",)])
    assert rows(quality.relationships(df, "k", parent, "id")) == [("a", 2)]


def test_expression_passes_null(df):
    assert rows(quality.expression_is_true(df, "v < 100.05"), "v") == [(100.1,)]


def test_freshness(spark):
    loads = frame(
        spark,
        "s string, t timestamp_ntz",
        [("a", ts("2024-01-08")), ("a", ts("2024-01-01")), ("b", ts("2024-01-07 23:59")), ("c", ts("2024-01-02")), ("d", None)],
    )
    got = dict(rows(quality.freshness(loads, "t", ts("2024-01-10"), by=["s"]), "s", "status"))
    assert got == {"a": "pass", "b": "warn", "c": "error", "d": "error"}
    assert quality.freshness(loads, "t", ts("2024-01-10")).first()["status"] == "pass"


def test_67_tests_are_declared():
    kinds = {f: sum(len(getattr(t, f)) for t in TESTS.values()) for f in TableTests.__dataclass_fields__}
    assert kinds == {
        "unique": 18,
        "not_null": 38,
        "accepted_range": 3,
        "accepted_values": 2,
        "relationships": 3,
        "unique_combination": 2,
        "expression_is_true": 1,
    }
    assert sum(t.count() for t in TESTS.values()) == 67


def test_runner_counts_failures_per_test(spark, df):
    parent = frame(spark, "id string", [("b",)])
    tests = {
        "t": TableTests(
            unique=("k",),
            not_null=("k", "n"),
            accepted_range=(("v", 0.0, 100.0),),
            accepted_values=(("k", ("a",)),),
            relationships=(("k", "p", "id"),),
            unique_combination=(("k", "n"),),
            expression_is_true=("n < 4",),
        )
    }
    got = {r["test"]: r["failures"] for r in run_tests({"t": df, "p": parent}, tests).collect()}
    assert got == {
        "unique:k": 1,
        "not_null:k": 2,
        "not_null:n": 0,
        "accepted_range:v": 2,
        "accepted_values:k": 2,
        "relationships:k": 2,
        "unique_combination:k+n": 2,
        "expression_is_true:n < 4": 2,
    }


def test_coverage_lists_the_missing_hours(spark):
    found = frame(
        spark,
        "s string, hour_utc timestamp_ntz",
        [("a", ts(f"2024-01-01 {h:02d}:00")) for h in range(24) if h not in (3, 20)] + [("a", ts("2024-01-01 00:00"))],
    )
    chunks = frame(
        spark,
        "s string, chunk_start date, chunk_end date",
        [("a", day("2024-01-01"), day("2024-01-01")), ("b", day("2024-01-01"), day("2024-01-02"))],
    )
    got = {r["s"]: r for r in reports.coverage(found, chunks, ["s"]).collect()}
    assert (got["a"]["hours_expected"], got["a"]["hours_found"], got["a"]["hours_missing"]) == (24, 22, 2)
    assert got["a"]["missing_hours"] == "2024-01-01 03, 2024-01-01 20"
    assert (got["b"]["hours_expected"], got["b"]["hours_found"]) == (48, 0)
    assert reports.missing_hours(found, chunks, ["s"]).count() == 2 + 48


def test_duplicate_days_need_differing_values(spark):
    df = frame(spark, "d date, v double", [(day("2024-01-01"), 1.0)] * 2 + [(day("2024-01-02"), v) for v in (1.0, 2.0)])
    assert rows(reports.duplicate_days(df, ["d"], "v")) == [(day("2024-01-02"), 2, 2)]


@pytest.mark.parametrize("by", [[], ["s"]])
def test_the_planted_lag_is_found(spark, by):
    values = [3.0, 9.0, 1.0, 7.0, 4.0, 8.0, 2.0, 6.0]
    schema = "s string, hour_utc timestamp_ntz, v double"
    truth = frame(spark, schema, [("a", ts(f"2024-01-01 {h:02d}:00"), v) for h, v in enumerate(values)])
    late = frame(spark, schema, [("a", ts(f"2024-01-01 {h + 2:02d}:00"), v) for h, v in enumerate(values)])
    scan = reports.lag_scan(late, truth, "v", range(-3, 4), by=by)
    best = scan.where("is_best").collect()
    assert [(r["lag_hours"], r["mean_abs_diff"], r["n_hours"]) for r in best] == [(2, 0.0, 8)]
    assert scan.count() == 7


def test_day_outcomes_and_summary(spark):
    daily = frame(
        spark,
        "date_day date, is_complete boolean, cost_savings_eur double, co2_savings_kg double, baseline_total_cost_eur double, "
        "baseline_gas_m3 double, baseline_electricity_kwh double, baseline_co2_kg double, "
        "baseline_electricity_cost_eur double, baseline_gas_cost_eur double",
        [
            (day("2024-01-01"), True, 2.0, -1.0, 10.0, 40.0, 80.0, 5.0, 8.0, 2.0),
            (day("2024-01-02"), True, 1e-12, 0.0, 10.0, 40.0, 80.0, 5.0, 6.0, 4.0),
            (day("2024-01-03"), True, -1.0, 2.0, 10.0, 40.0, 80.0, 5.0, 7.0, 3.0),
            (day("2024-01-04"), False, 5.0, 2.0, None, 40.0, 80.0, 5.0, None, 3.0),
        ],
    )
    assert tuple(reports.day_outcomes(daily).first()) == (3, 1, 1, 1, 1, 1)
    got = reports.summary_by_period(daily, F.year("date_day").alias("year"), 40.0).first().asDict()
    assert got["year"] == 2024 and got["n_days"] == 4
    assert (got["gas_m3_per_m2"], got["electricity_kwh_per_m2"]) == (4.0, 8.0)
    assert (got["baseline_cost_eur"], got["saved_pct"], got["electricity_share"]) == pytest.approx((30.0, 6.0 / 30.0, 0.7))


def test_price_per_on_hour_ignores_missing_values_on_both_sides(spark):
    hourly = frame(
        spark,
        "scenario string, date_local date, is_lighting_on boolean, lighting_kwh double, "
        "electricity_price_eur_per_kwh double, carbon_intensity_gco2eq_per_kwh double",
        [
            ("baseline", day("2024-01-01"), True, 10.0, 0.2, None),
            ("baseline", day("2024-01-01"), True, 10.0, 0.4, 300.0),
            ("baseline", day("2024-01-01"), False, 0.0, 9.0, 900.0),
            ("baseline", day("2024-01-02"), True, 10.0, 9.0, 900.0),
        ],
    )
    daily = frame(spark, "date_day date, is_complete boolean", [(day("2024-01-01"), True), (day("2024-01-02"), False)])
    got = reports.price_per_on_hour(reports.on_complete_days(hourly, daily)).first()
    assert tuple(got) == pytest.approx(("baseline", 2, 0.3, 300.0))


def test_key_tests_aggregate_before_the_shuffle(spark, df):
    text = plan(quality.unique(df, "k"))
    assert text.index("partial_count") > text.index("Exchange")
