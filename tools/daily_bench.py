"""The daily run at the volume of a real deployment: python tools/daily_bench.py [CPUS]

About 103,000 hours of six grid signals (since 2015), 68,000 hours of electricity
prices and weather and 2,900 days of gas prices (since 2019) are stored first, year by
year; then one daily run with a trailing window of seven days is timed, rebuilding
everything, and one that rebuilds the current month only. Values are generated.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from uurwerk.params import default_profile  # noqa: E402
from uurwerk.plans.daily import Lake, load_raw, run_daily, stored_schema  # noqa: E402
from uurwerk.plans.loads import load_history  # noqa: E402
from uurwerk.session import build_session  # noqa: E402

RUN = dt.date(2026, 9, 30)
SINCE = {"electricity_prices": 2019, "gas_prices": 2019, "weather": 2019, "public_holidays": 2019}


def extracts(spark):
    def noise(salt: int, low: float, high: float):
        return F.pmod(F.xxhash64("t", F.lit(salt)), F.lit(10_000)) / 10_000.0 * (high - low) + low

    def times(first: dt.date, last: dt.date, step: str) -> DataFrame:
        last_hour = f"TIMESTAMP_NTZ'{last + dt.timedelta(days=1)} 00:00:00' - INTERVAL 1 HOUR"
        return spark.sql(f"SELECT explode(sequence(TIMESTAMP_NTZ'{first} 00:00:00', {last_hour}, INTERVAL {step})) AS t")

    def extract(name: str):
        def read(first: dt.date, last: dt.date) -> DataFrame:
            rows = times(first, last, "1 DAY" if name in ("gas_prices", "public_holidays") else "1 HOUR")
            if name == "public_holidays":
                rows = rows.where((F.month("t") == 1) & (F.dayofmonth("t") == 1))
            columns = []
            for k, f in enumerate(f for f in stored_schema(name).fields if f.name != "_load_id"):
                kind = f.dataType.simpleString()
                value = {"timestamp_ntz": F.col("t"), "boolean": F.lit(True), "string": F.lit("x")}.get(kind)
                if f.name == "date":
                    value = F.to_date("t").cast("string")
                elif kind.startswith("array"):
                    value = F.array(F.lit("Public"))
                elif name == "gas_prices" and kind == "timestamp_ntz":
                    value = F.col("t") + F.expr("INTERVAL 5 HOUR")
                elif value is None:
                    value = noise(k, 0.0, 90.0)
                columns.append(value.cast(f.dataType).alias(f.name))
            return rows.select(*columns)

        return read

    names = (
        "electricity_prices gas_prices carbon_intensity renewable_percentage carbon_free_percentage total_load "
        "day_ahead_price electricity_mix weather public_holidays"
    )
    return {name: extract(name) for name in names.split()}


def main() -> None:
    cpus = int(sys.argv[1]) if len(sys.argv) > 1 else 8
    spark = build_session("daily", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    lake, given = Lake(tempfile.mkdtemp(prefix="run-")), extracts(spark)
    started = time.perf_counter()
    for name, extract in given.items():
        first = dt.date(SINCE.get(name, 2015), 1, 1)
        load_history(spark, name, extract, lambda df, n=name: load_raw(lake, n, df, "history"), first, RUN)
    print(f"history stored in {time.perf_counter() - started:.1f} s", flush=True)
    for label, since in (("everything", None), ("the current month", RUN)):
        started = time.perf_counter()
        run = run_daily(spark, lake, given, default_profile(spark), RUN, rebuild_from=since)
        took = time.perf_counter() - started
        counts = {n: run.models[n].count() for n in ("grid_signals", "hourly_prices", "hourly_energy", "daily_energy")}
        print(f"daily run, rebuilding {label}: {took:.1f} s, {run.tests.count()} tests, {counts}", flush=True)


if __name__ == "__main__":
    main()
