"""The whole build, from payload-like batches to the marts, and the stream sink."""

import datetime as dt
import math
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import day, frame, rows, ts
from uurwerk.params import SiteParams, default_profile
from uurwerk.plans.daily import Lake, DataTestsFailed, load_raw, load_window, read_lake, run_daily
from uurwerk.plans.loads import from_source, load_history, request_plan
from uurwerk.plans.staging import stage_electricity_mix, stage_gas_prices
from uurwerk.session import shared_folder
from uurwerk.sources.landing import RequestFailed
from uurwerk.sources.tables import raw_schema, read_table
from uurwerk.sources.versions import current_map
from uurwerk.streaming.upserts import upsert_stream

RUN = day("2024-03-31")  # a day of 23 hours
PARAMS = SiteParams(spine_start_date="2024-03-28")


def hourly(first, last):
    t = dt.datetime(first.year, first.month, first.day)
    end = dt.datetime(last.year, last.month, last.day) + dt.timedelta(days=1)
    while t < end:
        yield t
        t += dt.timedelta(hours=1)


def price(t):
    return 0.2 + 0.1 * math.sin(t.hour + t.day)


def extracts(spark, bump=0.0):
    def signal(value):
        def extract(first, last):
            data = [(t, value(t), False, t, t) for t in hourly(first, last)]
            return frame(
                spark,
                "datetime timestamp_ntz, value double, is_estimated boolean, created_at timestamp_ntz, updated_at timestamp_ntz",
                data,
            )

        return extract

    def electricity(first, last):
        return frame(
            spark,
            "timestamp_utc timestamp_ntz, price_eur_per_kwh double",
            [(t, price(t) + bump) for t in hourly(first, last)],
        )

    def gas(first, last):
        data = [(t.replace(hour=5), 1.0 + t.day / 100) for t in hourly(first, last) if t.hour == 0]
        data.append((dt.datetime(first.year, first.month, first.day), 99.0))  # extra midnight row
        return frame(spark, "timestamp_utc timestamp_ntz, price_eur_per_m3 double", data)

    def weather(first, last):
        data = [(t, 5.0 + t.hour / 10, 80.0, 0.0, 10.0, 50.0, 250.0 if 11 <= t.hour <= 14 else 20.0) for t in hourly(first, last)]
        names = ["temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m", "cloud_cover", "shortwave_radiation"]
        return frame(spark, "datetime timestamp_ntz, " + ", ".join(f"{n} double" for n in names), data)

    def day_ahead(first, last):
        data = [(t, 40 if t.hour % 2 else None, None if t.hour % 2 else 40.5, False, t, t) for t in hourly(first, last)]
        schema = (
            "datetime timestamp_ntz, value bigint, value__v_double double, is_estimated boolean, "
            "created_at timestamp_ntz, updated_at timestamp_ntz"
        )
        return frame(spark, schema, data)

    def mix(first, last):
        fields = [f for f in raw_schema("electricity_mix").fields if f.name not in ("datetime", "_load_id")]
        base = frame(spark, "datetime timestamp_ntz", [(t,) for t in hourly(first, last)])
        return base.select(
            "datetime",
            *[
                F.lit(None if f.name.endswith("__v_double") else 7 if f.dataType.typeName() != "string" else "MEASURED")
                .cast(f.dataType)
                .alias(f.name)
                for f in fields
            ],
        )

    def holidays(first, last):
        return frame(
            spark,
            "date string, local_name string, name string, country_code string, is_global boolean, "
            "counties array<string>, types array<string>",
            [
                ("2024-03-29", "Goede Vrijdag", "Good Friday", "NL", True, None, ["School", "Authorities"]),
                ("2024-03-31", "Paaszondag", "Easter Sunday", "NL", True, None, ["Public"]),
                ("2025-01-01", "Nieuwjaarsdag", "New Year", "NL", True, None, ["Public"]),
            ],
        )

    return {
        "electricity_prices": electricity,
        "gas_prices": gas,
        "carbon_intensity": signal(lambda t: 300.0 + t.hour),
        "renewable_percentage": signal(lambda t: 40.0),
        "carbon_free_percentage": signal(lambda t: 45.0),
        "total_load": signal(lambda t: 9000.0),
        "day_ahead_price": day_ahead,
        "electricity_mix": mix,
        "weather": weather,
        "public_holidays": holidays,
    }


def test_load_windows():
    assert load_window("weather", RUN, 7) == (day("2024-03-24"), RUN)
    assert load_window("electricity_prices", RUN, 7) == (day("2024-03-24"), day("2024-04-01"))
    assert load_window("public_holidays", RUN, 7) == (day("2024-01-01"), day("2025-12-31"))
    with pytest.raises(ValueError):
        load_window("weather", RUN, 61)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("lake")), env="dev")
    run = run_daily(spark, lake, extracts(spark), default_profile(spark), RUN, params=PARAMS)
    return lake, run.models, {(r["table_name"], r["test"]): r["failures"] for r in run.tests.collect()}


def test_all_67_data_tests_pass(built):
    _, _, tests = built
    assert len(tests) == 67
    # The spine starts before the first gas day and runs past the last one; nothing else may fail.
    assert {k: v for k, v in tests.items() if v} == {}


def test_grains(spark, built):
    _, models, _ = built
    per_day = dict(rows(models["hours"].groupBy("date_local").count()))
    assert per_day == {day("2024-03-28"): 24, day("2024-03-29"): 24, day("2024-03-30"): 24, RUN: 23, day("2024-04-01"): 24}
    assert models["hourly_prices"].count() == models["hours"].count() == 119
    # Weather ends with the last UTC hour of the run date.
    assert models["hourly_demand"].count() == 2 * models["hours"].where("hour_utc < '2024-04-01'").count()
    assert models["dim_date"].where("is_public_holiday").select("date_day").collect() == [(RUN,)]
    friday = models["dim_date"].where("date_day = '2024-03-29'").first()
    assert friday["holiday_types"] == "Authorities, School" and not friday["is_non_working_day"]


def test_shifting_saves_on_every_priced_day(built):
    _, models, _ = built
    daily = {r["date_day"]: r for r in models["daily_energy"].collect()}
    assert all(r["baseline_lighting_hours"] == r["optimized_lighting_hours"] for r in daily.values())
    assert daily[day("2024-03-30")]["is_complete"] and daily[day("2024-03-30")]["cost_savings_eur"] > 0


def test_extra_midnight_rows_of_gas_are_dropped(built):
    _, models, _ = built
    assert models["hourly_prices"].where("gas_price_eur_per_m3 > 50").count() == 0


def test_market_has_prices_grid_and_weather(built):
    _, models, _ = built
    row = models["hourly_market"].where("hour_utc = '2024-03-30 12:00'").first()
    assert (row["day_ahead_price_eur_per_mwh"], row["wind_mw"], row["carbon_intensity_gco2eq_per_kwh"]) == (40.5, 7.0, 312.0)
    assert (row["temperature_c"], row["total_load_mw"], row["renewable_pct"]) == (6.2, 9000.0, 40.0)


def close(df):
    """Rows with sums to 6 places: their order of adding may differ."""
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows(df)]


def test_several_sites_are_built_side_by_side(spark, built, tmp_path):
    _, one, _ = built
    sites = frame(spark, "site string", [("north",), ("south",)])
    run = run_daily(
        spark, Lake(str(tmp_path)), extracts(spark), default_profile(spark), RUN, params=PARAMS, sites=sites
    )
    assert sum(r["failures"] for r in run.tests.collect()) == 0 and run.tests.count() == 67
    for name in ("hourly_schedule", "hourly_demand", "hourly_energy", "daily_energy"):
        for site in ("north", "south"):
            mine = run.models[name].where(F.col("site") == site)
            assert close(mine.select(*one[name].columns)) == close(one[name])
    assert rows(run.models["hourly_prices"]) == rows(one["hourly_prices"])


def test_a_second_run_overwrites_revised_values(spark, built):
    lake, models, _ = built
    before = models["hourly_prices"].count()

    def load_ids():
        return {r[0] for r in read_lake(spark, lake)["electricity_prices"].select("_load_id").distinct().collect()}

    scratch = Path(shared_folder(spark).removeprefix("file:")) / "uurwerk"
    left, first = set(scratch.glob("*")), load_ids()
    run = run_daily(spark, lake, extracts(spark, bump=1.0), default_profile(spark), RUN, params=PARAMS)
    assert sum(r["failures"] for r in run.tests.collect()) == 0
    again = run.models
    assert again["hourly_prices"].count() == before
    assert again["hourly_prices"].agg(F.min("electricity_price_eur_per_kwh")).first()[0] > 1.0
    # Two runs of one day are told apart, and leave no scratch tables.
    assert len(first) == 1 and len(load_ids()) == 1 and max(load_ids()) > max(first)
    assert set(scratch.glob("*")) == left


def parts(spark, lake, layer="marts", name="daily_energy"):
    return current_map(spark, f"{lake.layer(layer)}/{name}").parts


def test_rebuild_from_adds_months(spark, built):
    """Without changes nothing is rebuilt; asked for, the months from a day on are."""
    lake, _, _ = built
    whole = run_daily(spark, lake, extracts(spark, bump=2.0), default_profile(spark), RUN, params=PARAMS)
    want, before = {name: close(df) for name, df in whole.models.items()}, parts(spark, lake)
    later = run_daily(
        spark, lake, extracts(spark, bump=2.0), default_profile(spark), RUN, params=PARAMS, rebuild_from=day("2024-04-01")
    )
    assert later.months == ("2024-04",) and {name: close(df) for name, df in later.models.items()} == want
    after = parts(spark, lake)
    assert after["2024-03"] == before["2024-03"] and after["2024-04"] != before["2024-04"]
    again = run_daily(spark, lake, extracts(spark, bump=2.0), default_profile(spark), RUN, params=PARAMS)
    assert again.months == () and parts(spark, lake) == after and again.tests.count() == 67
    assert {name: close(df) for name, df in again.models.items()} == want


def until(end, given):
    """The extracts of a world that ends with a day."""
    return {name: (lambda first, last, f=f: f(first, min(last, end))) for name, f in given.items()}


def test_a_week_of_runs_equals_one_build_of_everything(spark, tmp_path):
    """Runs over a month's end rebuild what each load changed; a gas price of the month's last day also
    touches the first of the next, a late correction an older month alone."""
    lake, start = Lake(f"{tmp_path}/a"), SiteParams(spine_start_date="2024-01-20")
    profile, world = default_profile(spark), extracts(spark)
    months = []
    for k in range(4):
        now = day("2024-02-28") + dt.timedelta(days=k)
        run = run_daily(spark, lake, world, profile, now, 40 if k == 0 else 3, start)
        months.append(run.months)
    # Each load brings a row of its own for the midnight that it starts with, so its first month counts as changed.
    assert months == [None] + [("2024-02", "2024-03")] * 3
    before = parts(spark, lake)
    late = frame(spark, "timestamp_utc timestamp_ntz, price_eur_per_m3 double", [(ts("2024-01-31 05:00"), 7.0)])
    load_raw(lake, "gas_prices", late, "9")
    run = run_daily(spark, lake, world, profile, now, 3, start)
    assert run.months == ("2024-01", "2024-02") and parts(spark, lake)["2024-03"] == before["2024-03"]

    other = Lake(f"{tmp_path}/b")
    shutil.copytree(f"{tmp_path}/a/raw", f"{tmp_path}/b/raw")
    whole = run_daily(spark, other, world, profile, now, 3, start)
    assert whole.months is None
    for name, df in whole.models.items():
        assert close(run.models[name]) == close(df), name
    # An earlier run date takes the days after it away, with their months.
    back = run_daily(spark, lake, until(day("2024-02-27"), world), profile, day("2024-02-27"), 3, start)
    assert set(parts(spark, lake)) == {"2024-01", "2024-02"}
    assert back.models["hours"].agg(F.max("date_local")).first()[0] == day("2024-02-28")
    # Other parameters rebuild everything.
    changed = SiteParams(spine_start_date="2024-02-01")
    again = run_daily(spark, lake, until(day("2024-02-27"), world), profile, day("2024-02-27"), 3, changed)
    assert again.months is None and set(parts(spark, lake)) == {"2024-02"}


def test_a_failed_run_leaves_its_months_to_the_next(spark, tmp_path):
    lake, profile = Lake(str(tmp_path)), default_profile(spark)
    run_daily(spark, lake, extracts(spark), profile, RUN, params=PARAMS)
    before = parts(spark, lake)
    broken = {**extracts(spark, bump=1.0), "renewable_percentage": lambda a, b: extracts(spark)["total_load"](a, b)}
    with pytest.raises(DataTestsFailed):
        run_daily(spark, lake, broken, profile, RUN, params=PARAMS)
    assert parts(spark, lake) == before
    mended = run_daily(spark, lake, extracts(spark, bump=1.0), profile, RUN, params=PARAMS)
    assert "2024-03" in mended.months
    assert mended.models["hourly_prices"].agg(F.min("electricity_price_eur_per_kwh")).first()[0] > 1.0


def test_a_failing_test_stops_what_depends_on_the_table(spark, tmp_path):
    broken = {**extracts(spark), "renewable_percentage": lambda first, last: extracts(spark)["total_load"](first, last)}
    with pytest.raises(DataTestsFailed, match="renewable_percentage accepted_range:renewable_pct"):
        run_daily(spark, Lake(str(tmp_path)), broken, default_profile(spark), RUN, params=PARAMS)
    assert not (tmp_path / "intermediate").exists() and not (tmp_path / "marts").exists()


def test_days_without_data_and_old_sources_are_reported(spark, tmp_path):
    found = extracts(spark)["electricity_prices"]

    def prices(first, last):
        """As :func:`from_source` answers: the rows, and the days without any."""
        gap = F.to_date("timestamp_utc") == "2024-03-26"
        return found(first, last).where(~gap), frame(spark, "series string, day date", [("electricity_prices", day("2024-03-26"))])

    given = {**extracts(spark), "electricity_prices": prices}
    run = run_daily(
        spark, Lake(str(tmp_path)), given, default_profile(spark), RUN, params=PARAMS, as_of=dt.datetime(2024, 4, 4, 12)
    )
    assert rows(run.skipped) == [("electricity_prices", day("2024-03-26"))]
    status = dict(rows(run.freshness, "table_name", "status"))
    assert len(status) == 9 and status["weather"] == "warn"


def test_a_failing_load_stops_the_run_before_any_table_is_built(spark, tmp_path):
    def broken(first, last):
        raise RuntimeError("load failed")

    with pytest.raises(RuntimeError, match="load failed"):
        run_daily(spark, Lake(str(tmp_path)), {"weather": broken}, default_profile(spark), RUN, params=PARAMS)
    assert not (tmp_path / "marts").exists()


def test_latest_row_of_a_local_day_is_its_gas_price(spark):
    raw = frame(
        spark,
        "timestamp_utc timestamp_ntz, price_eur_per_m3 double, _load_id string",
        [
            (ts("2024-01-02 00:00"), 9.0, "1"),
            (ts("2024-01-02 05:00"), 1.0, "1"),
            (ts("2024-07-02 00:00"), 9.0, "1"),
            (ts("2024-07-02 04:00"), 2.0, "1"),
        ],
    )
    got = rows(stage_gas_prices(raw, SiteParams()), "gas_day", "valid_from_utc", "valid_to_utc", "gas_price_eur_per_m3")
    assert got == [
        (day("2024-01-02"), ts("2024-01-02 05:00"), ts("2024-01-03 05:00"), 1.0),
        (day("2024-07-02"), ts("2024-07-02 04:00"), ts("2024-07-03 04:00"), 2.0),
    ]


def test_mix_joins_split_columns(spark):
    schema = raw_schema("electricity_mix")
    names = schema.names
    row = {n: None for n in names} | {"datetime": ts("2024-01-01"), "mix__wind": 5, "mix__solar__v_double": 1.5, "mix__hydro": 2.0}
    got = stage_electricity_mix(spark.createDataFrame([tuple(row[n] for n in names)], schema)).first()
    assert (got["wind_mw"], got["solar_mw"], got["hydro_mw"], got["coal_mw"]) == (5.0, 1.5, 2.0, None)


def test_files_that_arrive_are_merged_once(spark, tmp_path):
    schema = "k int, v int, day string, _load_id string"
    landing, table, checkpoint = (f"{tmp_path}/{n}" for n in ("landing", "table", "checkpoint"))
    frame(spark, schema, [(1, 1, "a", "1"), (2, 2, "b", "1")]).write.parquet(landing)

    def run():
        stream = spark.readStream.schema(schema).parquet(landing)
        upsert_stream(stream, table, ["k"], "day", checkpoint).awaitTermination()
        return rows(read_table(spark, table), "k", "v")

    assert run() == [(1, 1), (2, 2)]
    frame(spark, schema, [(2, 20, "b", "2"), (3, 30, "b", "2")]).write.mode("append").parquet(landing)
    assert run() == [(1, 1), (2, 20), (3, 30)]
    assert run() == [(1, 1), (2, 20), (3, 30)]


def test_requests_respect_chunk_size_and_availability(spark):
    def plan(name, first, last):
        return rows(request_plan(spark, name, day(first), day(last)), "chunk_start", "chunk_end")

    assert plan("day_ahead_price", "2017-04-25", "2017-05-12") == [
        (day("2017-04-30"), day("2017-05-09")),
        (day("2017-05-10"), day("2017-05-12")),
    ]
    assert plan("day_ahead_price", "2016-01-01", "2016-12-31") == []
    assert len(plan("electricity_prices", "2023-01-01", "2023-12-31")) == 13
    assert plan("weather", "2023-12-31", "2024-02-01") == [
        (day("2023-12-31"), day("2023-12-31")),
        (day("2024-01-01"), day("2024-02-01")),
    ]


def test_a_source_is_asked_once_and_reports_the_days_without_data(spark, tmp_path):
    log = tmp_path / "asked"
    log.mkdir()

    def fetch(series, first, last):
        with open(f"{log}/{first}_{last}", "a") as handle:
            handle.write("x")
        if first <= dt.date(2019, 10, 27) <= last:
            raise RequestFailed(500)
        return [{"timestamp_utc": dt.datetime(first.year, first.month, first.day), "price_eur_per_kwh": 0.2}]

    schema = T.StructType().add("timestamp_utc", T.TimestampNTZType()).add("price_eur_per_kwh", T.DoubleType())
    extract = from_source(spark, "electricity_prices", fetch, schema)
    found, skipped = extract(day("2019-10-01"), day("2019-11-15"))
    assert rows(skipped) == [("electricity_prices", day("2019-10-27"))]
    assert found.count() == 29 + 1 and found.count() == 30
    assert len(list(log.iterdir())) == 2 + 30
    assert {f.read_text() for f in log.iterdir()} == {"x"}


def test_history_is_stored_year_by_year(spark, tmp_path):
    lake, asked = Lake(str(tmp_path)), []

    def extract(first, last):
        asked.append((first, last))
        if first.year == 2019 and len(asked) < 4:
            raise RequestFailed(500)
        return extracts(spark)["day_ahead_price"](first, first)

    def run(first):
        return load_history(
            spark, "day_ahead_price", extract, lambda df: load_raw(lake, "day_ahead_price", df, "1"), first, day("2019-02-01")
        )

    with pytest.raises(RequestFailed):
        run(day("2015-01-01"))
    assert asked == [
        (day("2017-04-30"), day("2017-12-31")),
        (day("2018-01-01"), day("2018-12-31")),
        (day("2019-01-01"), day("2019-02-01")),
    ]
    assert read_table(spark, lake.raw_path("day_ahead_price")).count() == 48
    assert run(day("2018-06-01")) == [2018, 2019]
    assert read_table(spark, lake.raw_path("day_ahead_price")).count() == 96
