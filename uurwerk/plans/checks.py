"""The data tests of every table, and one runner for all of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uurwerk.operators import quality


@dataclass(frozen=True)
class TableTests:
    """Tests of one table. ``relationships`` maps a column to (table, column)."""

    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted_range: tuple[tuple[str, float | None, float | None], ...] = ()
    accepted_values: tuple[tuple[str, tuple[str, ...]], ...] = ()
    relationships: tuple[tuple[str, str, str], ...] = ()
    unique_combination: tuple[tuple[str, ...], ...] = ()
    expression_is_true: tuple[str, ...] = ()

    def count(self) -> int:
        return sum(len(getattr(self, f)) for f in self.__dataclass_fields__)


SCENARIOS = ("baseline", "optimized")
HOUR = TableTests(unique=("hour_utc",), not_null=("hour_utc",))


def _hourly(measure: str, percentage: bool = False) -> TableTests:
    return TableTests(
        unique=("hour_utc",),
        not_null=("hour_utc", measure),
        accepted_range=((measure, 0.0, 100.0),) if percentage else (),
    )


# The tests of each table.
TESTS = {
    "electricity_prices": _hourly("electricity_price_eur_per_kwh"),
    "gas_prices": TableTests(
        unique=("gas_day",),
        not_null=("gas_day", "valid_from_utc", "valid_to_utc", "gas_price_eur_per_m3"),
    ),
    "carbon_intensity": _hourly("carbon_intensity_gco2eq_per_kwh"),
    "renewable_percentage": _hourly("renewable_pct", percentage=True),
    "carbon_free_percentage": _hourly("carbon_free_pct", percentage=True),
    "total_load": _hourly("total_load_mw"),
    "day_ahead_price": _hourly("day_ahead_price_eur_per_mwh"),
    "electricity_mix": HOUR,
    "weather": TableTests(
        unique=("hour_utc",),
        not_null=("hour_utc", "temperature_c", "shortwave_radiation_w_per_m2"),
    ),
    "public_holidays": TableTests(unique=("holiday_date",), not_null=("holiday_date", "is_public_holiday")),
    "monthly_profile": TableTests(unique=("month",), not_null=("month", "lighting_enabled")),
    "hours": TableTests(unique=("hour_utc",), not_null=("hour_utc", "date_local")),
    "hourly_prices": HOUR,
    "grid_signals": HOUR,
    "hourly_schedule": TableTests(
        unique=("hour_utc",),
        not_null=("hour_utc", "is_lighting_scheduled", "heating_setpoint_c"),
    ),
    "hourly_demand": TableTests(
        not_null=("scenario", "electricity_kwh", "gas_m3"),
        accepted_range=(("gas_m3", 0.0, None),),
        accepted_values=(("scenario", SCENARIOS),),
        unique_combination=(("hour_utc", "scenario"),),
    ),
    "dim_date": TableTests(unique=("date_day",), not_null=("date_day", "is_public_holiday")),
    "hourly_market": TableTests(
        unique=("hour_utc",),
        not_null=("hour_utc",),
        relationships=(("date_local", "dim_date", "date_day"),),
    ),
    "hourly_energy": TableTests(
        accepted_values=(("scenario", SCENARIOS),),
        relationships=(("date_local", "dim_date", "date_day"),),
        unique_combination=(("hour_utc", "scenario"),),
    ),
    "daily_energy": TableTests(
        unique=("date_day",),
        not_null=("date_day",),
        relationships=(("date_day", "dim_date", "date_day"),),
        expression_is_true=("baseline_lighting_hours = optimized_lighting_hours",),
    ),
}

# Tables that have a row for each site if there are several.
SITE_TABLES = ("hourly_schedule", "hourly_demand", "hourly_energy", "daily_energy")


def tests_for(by: Sequence[str] = ()) -> dict[str, TableTests]:
    """The tests, with the site's columns in the keys of the tables that have them."""
    tests = dict(TESTS)
    for name in SITE_TABLES if by else ():
        old = tests[name]
        keys = (*((c,) for c in old.unique), *old.unique_combination)
        tests[name] = replace(old, unique=(), unique_combination=tuple((*by, *k) for k in keys))
    return tests


# Tables whose newest row has an age limit, with the column that dates a row.
FRESHNESS = {
    "electricity_prices": "timestamp_utc",
    "gas_prices": "timestamp_utc",
    "carbon_intensity": "datetime",
    "renewable_percentage": "datetime",
    "carbon_free_percentage": "datetime",
    "total_load": "datetime",
    "day_ahead_price": "datetime",
    "electricity_mix": "datetime",
    "weather": "datetime",
}


def _row_conditions(tests: TableTests) -> dict[str, Column]:
    bad = {f"not_null:{c}": F.col(c).isNull() for c in tests.not_null}
    for column, low, high in tests.accepted_range:
        bad[f"accepted_range:{column}"] = quality.outside_range(F.col(column), low, high)
    for column, values in tests.accepted_values:
        bad[f"accepted_values:{column}"] = ~F.col(column).isin(*values)
    for expression in tests.expression_is_true:
        bad[f"expression_is_true:{expression}"] = ~F.expr(expression)
    return bad


def _failures(df: DataFrame, table: str, test: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(table).alias("table_name"), F.lit(test).alias("test"), "failures")


def run_tests(tables: dict[str, DataFrame], tests: dict[str, TableTests] = TESTS) -> DataFrame:
    """One row per test with its number of failures.

    All tests that look at single rows share one scan of their table. Failures
    of the key tests count distinct bad keys.
    """
    results = []
    for name, spec in tests.items():
        df = tables[name]
        conditions = _row_conditions(spec)
        if conditions:
            counted = df.agg(*[F.count_if(c).alias(f"_c{i}") for i, c in enumerate(conditions.values())])
            pairs = [F.struct(F.lit(t).alias("test"), F.col(f"_c{i}").alias("failures")) for i, t in enumerate(conditions)]
            results.append(counted.select(F.lit(name).alias("table_name"), F.inline(F.array(*pairs))))
        for column in spec.unique:
            results.append(_failures(quality.unique(df, column), name, f"unique:{column}"))
        for columns in spec.unique_combination:
            bad = quality.unique_combination(df, columns)
            results.append(_failures(bad, name, f"unique_combination:{'+'.join(columns)}"))
        for column, parent, parent_column in spec.relationships:
            bad = quality.relationships(df, column, tables[parent], parent_column)
            results.append(_failures(bad, name, f"relationships:{column}"))
    return reduce(DataFrame.unionByName, results)
