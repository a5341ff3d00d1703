"""Model parameters and the monthly operating profile."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class SiteParams:
    """Parameters of one site. The defaults are fixed values of the published model."""

    timezone: str = "Europe/Amsterdam"
    spine_start_date: str = "2019-01-01"
    day_start_hour: int = 6
    day_end_hour: int = 20
    gas_day_start_hour: int = 6
    area_m2: float = 40000.0
    lighting_power_w_per_m2: float = 100.0
    lighting_radiation_cutoff_w_per_m2: float = 200.0
    base_load_w_per_m2: float = 5.0
    heat_loss_w_per_m2_k: float = 6.0
    solar_heat_gain_fraction: float = 0.5
    lighting_heat_fraction: float = 0.7
    boiler_efficiency: float = 0.9
    gas_kwh_per_m3: float = 9.77
    gas_kg_co2_per_m3: float = 1.78


PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("month", T.IntegerType()),
        T.StructField("lighting_enabled", T.BooleanType()),
        T.StructField("lights_on_hour", T.IntegerType()),
        T.StructField("lights_off_hour", T.IntegerType()),
        T.StructField("heating_day_setpoint_c", T.DoubleType()),
        T.StructField("heating_night_setpoint_c", T.DoubleType()),
    ]
)

# The default monthly profile, in the column order of PROFILE_SCHEMA.
MONTHLY_PROFILE = [
    (1, True, 2, 18, 20.0, 17.0),
    (2, True, 2, 18, 20.0, 17.0),
    (3, True, 3, 17, 20.0, 17.0),
    (4, True, 4, 10, 19.0, 16.0),
    (5, False, None, None, 18.0, 15.0),
    (6, False, None, None, 18.0, 15.0),
    (7, False, None, None, 18.0, 15.0),
    (8, False, None, None, 18.0, 15.0),
    (9, True, 4, 10, 19.0, 16.0),
    (10, True, 3, 17, 20.0, 17.0),
    (11, True, 2, 18, 20.0, 17.0),
    (12, True, 2, 18, 20.0, 17.0),
]

# First day each signal can be requested.
SIGNAL_AVAILABLE_FROM = {
    "carbon_intensity": "2015-01-01",
    "renewable_percentage": "2015-01-01",
    "carbon_free_percentage": "2015-01-01",
    "total_load": "2015-01-01",
    "day_ahead_price": "2017-04-30",
    "electricity_mix": "2015-01-01",
}

# Largest request per table, in days. Tables that are not listed
# are asked for by calendar year.
CHUNK_DAYS = {
    "electricity_prices": 30,
    "gas_prices": 30,
    "carbon_intensity": 10,
    "renewable_percentage": 10,
    "carbon_free_percentage": 10,
    "total_load": 10,
    "day_ahead_price": 10,
    "electricity_mix": 10,
}


def profile_values_sql() -> str:
    """The default profile as a ``VALUES`` list."""

    def literal(value) -> str:
        if value is None:
            return "CAST(NULL AS INT)"
        if isinstance(value, bool):
            return str(value).lower()
        return f"CAST({value} AS DOUBLE)" if isinstance(value, float) else str(value)

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in MONTHLY_PROFILE)


def default_profile(spark: SparkSession) -> DataFrame:
    """The default profile."""
    return spark.sql(f"SELECT * FROM VALUES {profile_values_sql()} AS profile({', '.join(PROFILE_SCHEMA.names)})")


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan of a profile CSV; empty lighting hours become NULL."""
    return spark.read.csv(path, schema=PROFILE_SCHEMA, header=True, mode="FAILFAST")
