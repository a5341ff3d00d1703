"""Every registered query against its SQL, and the published anchor values."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from helpers import plan, rows

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as driver  # noqa: E402
from compare import compare, connect  # noqa: E402
from uurwerk.registry.oracles import ORACLES  # noqa: E402
from uurwerk.registry.queries import QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"

needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    con = connect(SMALL)
    verdict, _ = compare(spark, con, SMALL, name)
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict


@needs_data
def test_flagship_runs(spark):
    assert driver.entry(spark).count() > 0


@needs_data
def test_anchor_sums(spark):
    """Sums over the shifted days that two engines agreed on beforehand."""
    days = driver.queries()["shift_to_cheapest"](spark, MEDIUM).where("variant <> 'latest'")
    got = days.groupBy("variant").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("unpriced_hours") > 0).alias("unpriced"),
        F.round(F.sum("baseline_price_sum"), 2).alias("b"),
        F.round(F.sum("optimized_price_sum"), 2).alias("o"),
    )
    assert rows(got) == [
        ("autumn", 31, 0, 11326.61, 8313.58),
        ("spring", 31, 0, 11570.54, 8753.64),
        ("unpriced", 31, 22, 7864.44, 7186.11),
    ]


@needs_data
def test_freshness_counts(spark):
    got = driver.queries()["dq_freshness"](spark, MEDIUM).groupBy("status").count()
    assert rows(got) == [("error", 1450), ("pass", 10), ("warn", 40)]


@needs_data
@pytest.mark.parametrize("session_zone", ["America/New_York", "Europe/Amsterdam"])
@pytest.mark.parametrize("name", ["daily_scenario_compare", "coverage_gaps", "local_time", "json_flat_rows"])
def test_results_do_not_depend_on_the_session_zone(spark, zone, name, session_zone):
    con = connect(SMALL)
    zone(session_zone)
    verdict, _ = compare(spark, con, SMALL, name)
    assert verdict.startswith("ok"), verdict


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_plans_a_cross_join(spark, name, no_auto_broadcast):
    text = plan(driver.queries()[name](spark, SMALL))
    assert "NestedLoop" not in text and "Cartesian" not in text
