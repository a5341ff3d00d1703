"""The daily run: merge a trailing window per source, rebuild what that changed, test.

Every merge notes the local dates that its new or changed rows bear on. A run takes the
dates of all merges since the last finished build, adds the days that the calendar has
gained or lost, and rebuilds the months of these: a model's row depends on nothing
outside its own local date. The other months stay in the commits they are in, and are
neither read nor tested again; as a key decides its partition, tests of the touched
ones are tests of the table.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uurwerk.functions.clock import local_date
from uurwerk.operators import quality
from uurwerk.params import SiteParams
from uurwerk.plans.checks import FRESHNESS, run_tests, tests_for
from uurwerk.plans.loads import Extract
from uurwerk.plans.models import build_models
from uurwerk.plans.staging import stage_all
from uurwerk.sources.ranges import holiday_years
from uurwerk.sources.records import split_list
from uurwerk.sources.tables import (
    MERGE_KEYS,
    layer_path,
    raw_schema,
    read_table,
    register_view,
    upsert,
    with_load_id,
    write_table,
)
from uurwerk.sources.versions import current_map, expire, latest_note, maps_since, publish_note

# Raw tables are partitioned by the month of their key, models by that of their date.
MONTH = "month_key"

# Maps whose files stay for readers at work.
KEPT_MAPS = 3

# Day-ahead prices are published for tomorrow; everything else ends today.
AHEAD_DAYS = {"electricity_prices": 1, "gas_prices": 1}


@dataclass(frozen=True)
class Lake:
    """Where the tables live."""

    root: str
    env: str = "prod"

    def raw_path(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def layer(self, name: str) -> str:
        return layer_path(self.root, self.env, name, "").rstrip("/")


def load_window(name: str, run_date: dt.date, lookback_days: int) -> tuple[dt.date, dt.date]:
    """The range that a daily run asks a source for."""
    if not 1 <= lookback_days <= 60:
        raise ValueError("lookback_days must be between 1 and 60")
    if name == "public_holidays":
        first, last = holiday_years(run_date)
        return dt.date(first, 1, 1), dt.date(last, 12, 31)
    return (
        run_date - dt.timedelta(days=lookback_days),
        run_date + dt.timedelta(days=AHEAD_DAYS.get(name, 0)),
    )


def stored_schema(name: str) -> T.StructType:
    """Schema of a raw table as stored. Holidays keep their list of types, so that
    a merge replaces it together with its parent; the child table is a view."""
    if name == "public_holidays":
        return T.StructType.fromDDL(
            "date string, local_name string, name string, country_code string, is_global boolean, "
            "counties array<string>, types array<string>, _load_id string"
        )
    return raw_schema(name)


def days_of(name: str, tz: str) -> Column:
    """The local dates that a row of a raw table bears on: a gas day runs into the next one."""
    key = MERGE_KEYS[name]
    if name == "public_holidays":
        return F.array(F.col(key).cast("date"))
    day = local_date(F.col(key), tz)
    return F.array(day, F.date_add(day, 1)) if name == "gas_prices" else F.array(day)


def load_raw(lake: Lake, name: str, batch: DataFrame, load_id: str, tz: str = SiteParams().timezone) -> None:
    """Merge a batch into its raw table; the table's map notes the local dates that it changed."""
    key = MERGE_KEYS[name]
    rows = with_load_id(batch, load_id).select(*stored_schema(name).names)
    month = F.date_format(F.col(key).cast("date"), "yyyy-MM")
    upsert(lake.raw_path(name), rows.withColumn(MONTH, month), [key], MONTH, days_of(name, tz))


def read_lake(spark: SparkSession, lake: Lake, months: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The raw tables, with the list of holiday types as a child table. ``months`` limits them to what local dates
    of these months need: their own partitions and the neighbours', as the zone and gas days reach over
    a month's edge."""
    keep = None if months is None else {m for month in months for m in _around(month)}.__contains__
    raw = {
        name: read_table(spark, lake.raw_path(name), keep).select(*stored_schema(name).names) for name in MERGE_KEYS
    }
    raw["public_holidays"], raw["public_holidays__types"] = split_list(raw["public_holidays"], ["date"], "types")
    return raw


def _around(month: str) -> tuple[str, str, str]:
    first = dt.date.fromisoformat(f"{month}-01")
    return f"{first - dt.timedelta(days=1):%Y-%m}", month, f"{first + dt.timedelta(days=31):%Y-%m}"


class DataTestsFailed(RuntimeError):
    """A table did not pass its data tests; what depends on it was not built."""

    def __init__(self, failed: list[tuple[str, str, int]]):
        super().__init__("; ".join(f"{table} {test}: {n}" for table, test, n in failed))
        self.failed = failed


@dataclass(frozen=True)
class DailyRun:
    """What a run made: the models, every test's number of failures, the days that the
    sources had no data for, and the age of the sources' newest rows."""

    models: dict[str, DataFrame]
    tests: DataFrame
    skipped: DataFrame
    freshness: DataFrame
    # The months that were rebuilt; None for all of them.
    months: tuple[str, ...] | None = None


def _recipe(profile: DataFrame, params: SiteParams, sites: DataFrame | None) -> str:
    """What decides the models beside the raw tables. Profile and sites are small tables by their nature; of
    the sites a checksum is enough."""
    rows = sorted(str(r) for r in profile.collect())
    marked = None
    if sites is not None:
        mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64(*sites.columns).cast("decimal(38,0)")))
        marked = sites.columns, str(sites.select(mark.alias("m")).first())
    return hashlib.sha256(json.dumps([rows, asdict(params), marked], default=str).encode()).hexdigest()


def _span(days: int, first: dt.date) -> list[str]:
    return [str(first + dt.timedelta(days=i)) for i in range(days)]


def touched_months(
    spark: SparkSession, lake: Lake, built: dict | None, recipe: str, run_date: dt.date, start: dt.date
) -> tuple[str, ...] | None:
    """The months that have to be rebuilt since the build that ``built`` notes, or None for all of them: after
    the first load, after a change of parameters, profile or sites, and where it is not known
    what changed."""
    if built is None or built["recipe"] != recipe:
        return None
    days: set[str] = set()
    for name in MERGE_KEYS:
        since = maps_since(spark, lake.raw_path(name), built["raw"].get(name, 0))
        if since is None or any(m.days is None for m in since):
            return None
        days.update(d for m in since for d in m.days)
    # The calendar ends with the day after the run; days are gained, or lost by a run for an earlier date.
    before, now = sorted([dt.date.fromisoformat(built["run_date"]), run_date])
    days.update(_span((now - before).days, before + dt.timedelta(days=2)))
    end = max(now, before) + dt.timedelta(days=1)
    return tuple(sorted({d[:7] for d in days if str(start) <= d <= str(end)}))


def source_freshness(raw: Mapping[str, DataFrame], as_of: dt.datetime) -> DataFrame:
    """Age of the newest row of each source against a given clock."""
    parts = [
        quality.freshness(raw[name], column, as_of).select(F.lit(name).alias("table_name"), "max_loaded_at", "status")
        for name, column in FRESHNESS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def month_of(df: DataFrame, tz: str) -> Column:
    """The month by which a table is stored: that of its local date."""
    known = [F.col(c) for c in ("date_day", "date_local") if c in df.columns]
    return F.date_format(known[0] if known else local_date(F.col("hour_utc"), tz), "yyyy-MM")


def run_daily(
    spark: SparkSession,
    lake: Lake,
    extracts: Mapping[str, Extract],
    profile: DataFrame,
    run_date: dt.date,
    lookback_days: int = 7,
    params: SiteParams = SiteParams(),
    loads_at_once: int = 4,
    as_of: dt.datetime | None = None,
    load_id: str | None = None,
    sites: DataFrame | None = None,
    rebuild_from: dt.date | None = None,
) -> DailyRun:
    """Load every source, then build and test. The loads run side by side; all of
    them must succeed before any table is rebuilt. Staged tables are views, the
    rest is stored by month and tested as soon as it is there: a failing test stops
    the run before anything that depends on the table, and the next run builds the same
    months again.

    An extract returns the rows, or the rows and the days without data as
    :func:`uurwerk.plans.loads.read_source` does. ``load_id`` tells loads apart and must
    sort in their order; by default it is the time of the call. Only the months that have
    changed since the last finished run are rebuilt (see :func:`touched_months`).
    ``rebuild_from`` adds all months from that day on, changed or not.
    """
    load_id = load_id or f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S.%f}"
    by = list(sites.columns) if sites is not None else []
    start = dt.date.fromisoformat(params.spine_start_date)

    def load(name: str) -> DataFrame | None:
        got = extracts[name](*load_window(name, run_date, lookback_days))
        rows, skipped = got if isinstance(got, tuple) else (got, None)
        load_raw(lake, name, rows, load_id, params.timezone)
        return skipped

    with ThreadPoolExecutor(loads_at_once) as pool:
        without_data = [s for s in pool.map(load, extracts) if s is not None]
    skipped = reduce(DataFrame.unionByName, without_data, spark.createDataFrame([], "series string, day date"))

    notes = lake.layer("built")
    number, built_before = latest_note(spark, notes)
    recipe = _recipe(profile, params, sites)
    # What a merge by another run adds from here on is left to the next run.
    versions = {name: current_map(spark, lake.raw_path(name)).version for name in MERGE_KEYS}
    months = touched_months(spark, lake, built_before, recipe, run_date, start)
    if rebuild_from is not None and months is not None:
        first, last = max(start, rebuild_from), run_date + dt.timedelta(days=1)
        months = tuple(sorted({*months, *(d[:7] for d in _span((last - first).days + 1, first))}))
    if months is not None:
        params = replace(params, spine_start_date=str(max(start, dt.date.fromisoformat(f"{min(months, default=str(run_date)[:7])}-01"))))

    whole_raw = read_lake(spark, lake)
    raw = whole_raw if months is None else read_lake(spark, lake, months)
    staged = stage_all(raw, params)
    wanted = tests_for(by)
    built: dict[str, DataFrame] = {"monthly_profile": profile}
    results: list[tuple[str, str, int]] = []

    def passed(tables: Mapping[str, DataFrame]) -> None:
        built.update(tables)
        found = [tuple(r) for r in run_tests(built, {name: wanted[name] for name in tables if name in wanted}).collect()]
        results.extend(found)
        if failed := [r for r in found if r[2]]:
            raise DataTestsFailed(failed)

    for name, df in (staged if months is None else stage_all(whole_raw, params)).items():
        register_view(df, lake.env, "staging", name)
    passed({**staged, "monthly_profile": profile})

    whole: dict[str, DataFrame] = {}
    layers: dict[str, str] = {}
    replaces = None if months is None else set(months).__contains__

    def store(df: DataFrame, layer: str, name: str) -> DataFrame:
        """Later tables are built from, and tests run on, the months of this run."""
        dated = df.withColumn(MONTH, month_of(df, params.timezone))
        if months is not None:
            dated = dated.where(F.col(MONTH).isin(*months))
        stored = write_table(dated, lake.root, lake.env, layer, name, MONTH, replaces)
        whole[name], layers[name] = stored.drop(MONTH), layer
        path = layer_path(lake.root, lake.env, layer, name)
        rebuilt = read_table(spark, path, replaces).select(*df.columns)
        passed({name: rebuilt})
        return rebuilt

    models = {name: whole[name] for name in build_models(spark, staged, profile, run_date, params, store, sites, months)}
    publish_note(spark, notes, {"recipe": recipe, "raw": versions, "run_date": str(run_date)}, number)
    for name in MERGE_KEYS:
        expire(spark, lake.raw_path(name), KEPT_MAPS)
    for name, layer in layers.items():
        expire(spark, layer_path(lake.root, lake.env, layer, name), KEPT_MAPS)
    tests = spark.createDataFrame(results, "table_name string, test string, failures long")
    clock = as_of or dt.datetime.combine(run_date + dt.timedelta(days=1), dt.time())
    return DailyRun(models, tests, skipped, source_freshness(whole_raw, clock), months)
