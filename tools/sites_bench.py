"""The demand chain on many sites: python tools/sites_bench.py SITES YEARS [CPUS] [packed] [joined]

Generated sites and signals, to see how the chain behaves beyond the size of the
given tables. ``packed`` keeps a site's day in one row until its hours are shifted;
``joined`` broadcasts no signals, as if they were large.
Prints totals, which are the same both ways, rows written by all exchanges, and seconds.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from uurwerk.operators.balance import DEMAND_COLUMNS, energy_balance  # noqa: E402
from uurwerk.operators.calendar import hour_spine  # noqa: E402
from uurwerk.operators.compare import daily_compare  # noqa: E402
from uurwerk.operators.costs import CARRIED, add_costs, hourly_energy  # noqa: E402
from uurwerk.operators.packed import pack_days, shift_days, unpack_days, with_fields  # noqa: E402
from uurwerk.operators.prices import attach_prices  # noqa: E402
from uurwerk.operators.schedule import expand_schedule  # noqa: E402
from uurwerk.operators.shifting import scenario_expand  # noqa: E402
from uurwerk.params import SiteParams, default_profile  # noqa: E402
from uurwerk.session import build_session, materialize, spread  # noqa: E402


def packed_energy(site_days, signals, gas, profile, params, rows):
    """The demand chain with a row for each site and day: shared signals are packed once."""
    fields = ["hour_local", "hour_of_day_local", "electricity_price_eur_per_kwh", "temperature_c"]
    fields += ["shortwave_radiation_w_per_m2", "carbon_intensity_gco2eq_per_kwh", "gas_price_eur_per_m3"]
    spine = signals.drop("electricity_price_eur_per_kwh")
    priced = attach_prices(spine, signals.select("hour_utc", "electricity_price_eur_per_kwh"), gas)
    # Stored, so that its size is known and a small one is broadcast.
    shared = materialize(pack_days(priced, fields), "shared_days")
    # Spread after the join, whose small rows would otherwise end in a few tasks that unpack all hours.
    days = spread(site_days.join(shared, "date_local"), "site", "date_local", rows=rows).withColumn("month", F.month("date_local"))
    days = days.join(F.broadcast(profile), "month")

    def scheduled(h):
        hour = h["hour_of_day_local"]
        return F.coalesce(F.col("lighting_enabled") & (hour >= F.col("lights_on_hour")) & (hour < F.col("lights_off_hour")), F.lit(False))

    def setpoint(h):
        hour = h["hour_of_day_local"]
        by_day = (hour >= params.day_start_hour) & (hour < params.day_end_hour)
        return F.when(by_day, F.col("heating_day_setpoint_c")).otherwise(F.col("heating_night_setpoint_c"))

    def dark(h):
        return h["shortwave_radiation_w_per_m2"] < F.lit(float(params.lighting_radiation_cutoff_w_per_m2))

    flags = {
        "heating_setpoint_c": setpoint,
        "is_dark_enough_for_lighting": dark,
        "is_lighting_on_baseline": lambda h: scheduled(h) & dark(h),
    }
    hourly = unpack_days(shift_days(with_fields(days, flags)))
    scenarios = scenario_expand(hourly, {"baseline": "is_lighting_on_baseline", "optimized": "is_lighting_on_optimized"})
    return add_costs(energy_balance(scenarios.select("site", *DEMAND_COLUMNS, *CARRIED), params), params)


def exchanged(df) -> int:
    """Rows written by all exchanges of a plan that has run."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if kind == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def main() -> None:
    packed = "packed" in sys.argv
    numbers = [int(a) for a in sys.argv[1:] if a.isdigit()]
    sites, years, cpus = (*numbers, 8)[:3]
    spark = build_session(
        "sites", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": str(8 * cpus), "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    if "joined" in sys.argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    params = SiteParams()

    def noise(salt: int):
        return F.pmod(F.xxhash64("hour_utc", F.lit(salt)), F.lit(1000)) / 1000.0

    request = spark.sql("SELECT DATE'2019-01-01' AS start_date").withColumn(
        "run_date", F.add_months("start_date", 12 * years)
    )
    hourly = materialize(
        hour_spine(request, params.timezone).select(
            "hour_utc",
            "hour_local",
            "date_local",
            "hour_of_day_local",
            (noise(1) * 0.5).alias("electricity_price_eur_per_kwh"),
            (noise(2) * 25 - 2).alias("temperature_c"),
            (noise(3) * 400).alias("shortwave_radiation_w_per_m2"),
            (noise(4) * 500).alias("carbon_intensity_gco2eq_per_kwh"),
        ),
        "signals",
    )
    gas = hourly.groupBy(F.col("date_local").alias("gas_day")).agg(
        F.max("electricity_price_eur_per_kwh").alias("gas_price_eur_per_m3")
    )
    ranges = spark.range(sites).select(
        F.col("id").alias("site"),
        F.lit("2019-01-01").cast("date").alias("start_date"),
        F.add_months(F.lit("2019-01-01").cast("date"), 12 * years).alias("run_date"),
    )
    days = sites * (366 * years + 1)
    if packed:
        last = F.date_add("run_date", 1)
        site_days = ranges.select("site", F.explode(F.sequence("start_date", last)).alias("date_local"))
        energy = packed_energy(site_days, hourly, gas, default_profile(spark), params, 24 * days)
    else:
        spine = hour_spine(ranges, params.timezone, by=["site"], total_days=days)
        schedule = expand_schedule(spine, default_profile(spark), params)
        prices = attach_prices(schedule, hourly.select("hour_utc", "electricity_price_eur_per_kwh"), gas)
        carbon = hourly.select("hour_utc", "carbon_intensity_gco2eq_per_kwh")
        energy = hourly_energy(prices.join(carbon, "hour_utc", "left"), hourly, params, by=["site"])
    daily = daily_compare(energy, by=["site"])
    started = time.perf_counter()
    result = daily.agg(
        F.count(F.lit(1)).alias("site_days"),
        F.sum("hours_in_day").alias("hours"),
        F.count_if(F.col("baseline_lighting_hours") != F.col("optimized_lighting_hours")).alias("unfair"),
        F.sum("optimized_lighting_hours").alias("optimized_hours"),
        F.round(F.sum("cost_savings_eur"), 2).alias("saved_eur"),
    )
    totals = result.collect()[0]
    took = time.perf_counter() - started
    print(f"{totals.asDict()} {exchanged(result) / 1e6:.2f} M rows exchanged, {took:.1f} s, {2 * totals['hours'] / took / 1e6:.2f} M scenario hours/s")


if __name__ == "__main__":
    main()
