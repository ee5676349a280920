"""Q: data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from ..plans import staging
from ..plans.staging import TRIP_KEY
from .registry import query

RESULT = "SELECT '{check}' AS \"check\", '{column}' AS \"column\", ({count}) AS failing"


def expected(*checks: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(RESULT.format(check=a, column=b, count=c) for a, b, c in checks)


@query("q01_not_null", expected(
    ("not_null", "VendorID", "SELECT count(*) FILTER (VendorID IS NULL) FROM trips"),
    ("not_null", "payment_type", "SELECT count(*) FILTER (payment_type IS NULL) FROM trips"),
    ("not_null", "PULocationID", "SELECT count(*) FILTER (PULocationID IS NULL) FROM trips")), "trips")
def not_null(t):
    return quality.not_null(t.trips, "VendorID", "payment_type", "PULocationID")


def repeated(keys: str, feed: str) -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {feed} GROUP BY {keys} HAVING count(*) > 1)"


@query("q02_unique", expected(
    ("unique", "LocationID", repeated("LocationID", "zones")),
    ("unique", "o_custkey", repeated("o_custkey", "orders")),
    ("unique", "trip_id", repeated("trip_id", "enriched"))), "zones enriched")
def unique(t):
    return quality.run(quality.unique(t.zones, "LocationID"), quality.unique(t.orders, "o_custkey"),
                       quality.unique(t.enriched, "trip_id"))


@query("q03_accepted_values", expected(
    ("accepted_values", "payment_type", "SELECT count(*) FROM trips WHERE payment_type NOT IN (1, 2, 3)"),
    ("accepted_values", "VendorID", "SELECT count(*) FROM trips WHERE VendorID NOT IN (1, 2, 4)")), "trips")
def accepted_values(t):
    return quality.run(quality.accepted_values(t.trips, "payment_type", [1, 2, 3]),
                       quality.accepted_values(t.trips, "VendorID", [1, 2, 4]))


@query("q04_relationships", expected(
    ("relationships", "PULocationID", "SELECT count(*) FROM trips WHERE PULocationID NOT IN (SELECT LocationID FROM some_zones)"),
    ("relationships", "VendorID", "SELECT count(*) FROM trips WHERE VendorID NOT IN (1, 2, 4)")), "trips some_zones")
def relationships(t):
    return quality.run(quality.relationships(t.trips, "PULocationID", t.some_zones, "LocationID"),
                       quality.relationships(t.trips, "VendorID", staging.vendors(t.spark), "vendor_id"))


@query("q05_unique_combination", expected(
    ("unique_combination", ",".join(TRIP_KEY), repeated(", ".join(TRIP_KEY), "unioned"))), "unioned")
def unique_combination(t):
    return quality.unique(t.unioned, *TRIP_KEY)


@query("q06_row_assertions", expected(
    ("existing value", "VendorID", "SELECT count(*) FROM trips WHERE VendorID IS NULL OR VendorID NOT IN (1, 2)"),
    ("positive", "passenger_count", "SELECT count(*) FROM trips WHERE passenger_count <= 0"),
    ("positive", "trip_distance", "SELECT count(*) FROM trips WHERE trip_distance <= 0")), "trips")
def row_assertions(t):
    return quality.row_checks(t.trips, {
        ("existing value", "VendorID"): F.col("VendorID").isin(1, 2),
        ("positive", "passenger_count"): F.col("passenger_count") > 0,
        ("positive", "trip_distance"): F.col("trip_distance") > 0})


def side(column: str, feed: str, suffix: str) -> str:
    v = f"CAST({column} AS DECIMAL(28,9))"
    return (f"count(*) AS rows_{suffix}, CAST(sum({v}) AS DOUBLE) / count({v}) AS mean_{suffix}, "
            f"CAST(min({column}) AS DOUBLE) AS min_{suffix}, CAST(max({column}) AS DOUBLE) AS max_{suffix}, "
            f"CAST(sum({v}) AS DOUBLE) AS total_{suffix} FROM {feed}")


def both_sides(column: str) -> str:
    return (f"SELECT '{column}' AS \"column\", b.*, a.* FROM (SELECT {side(column, 'unioned', 'before')}) b, "
            f"(SELECT {side(column, 'enriched', 'after')}) a")


@query("q07_profile_comparison", f"{both_sides('total_amount')} UNION ALL {both_sides('trip_distance')}", "enriched")
def profile_comparison(t):
    return quality.compare_profiles(t.unioned, t.enriched, ["total_amount", "trip_distance"])


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("q08_load_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in TABLES))
def load_counts(t):
    out = None
    for name in TABLES:
        part = getattr(t, name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionAll(part)
    return out
