"""J: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import joins
from ..plans import marts, staging
from .registry import query

PAIR = "Borough", "Zone"
LOCS = "concat(zpu.Borough, ' | ', zpu.Zone) AS pickup_loc, concat(zdo.Borough, ' | ', zdo.Zone) AS dropoff_loc"
SPAN = "tpep_pickup_datetime, tpep_dropoff_datetime, total_amount"


def located(df):
    """Both zone labels; NULL where the zone is missing."""
    place = lambda p: F.when(F.col(f"{p}_zone").isNotNull(), F.concat_ws(" | ", f"{p}_borough", f"{p}_zone"))
    return df.select("tpep_pickup_datetime", "tpep_dropoff_datetime", "total_amount",
                     place("pickup").alias("pickup_loc"), place("dropoff").alias("dropoff_loc"))


def sql_label(a: str, name: str) -> str:
    return f"CASE WHEN {a}.Zone IS NOT NULL THEN {a}.Borough || ' | ' || {a}.Zone END AS {name}"


LABELS = f"{sql_label('zpu', 'pickup_loc')}, {sql_label('zdo', 'dropoff_loc')}"


@query("j01_implicit_inner", f"""SELECT {SPAN}, {LOCS} FROM trips, zones zpu, zones zdo
       WHERE PULocationID = zpu.LocationID AND DOLocationID = zdo.LocationID""", "trips zones")
def implicit_inner(t):
    t.trips.createOrReplaceTempView("fareflow_trips")
    t.zones.createOrReplaceTempView("fareflow_zones")
    return t.spark.sql(f"""SELECT {SPAN}, {LOCS} FROM fareflow_trips t, fareflow_zones zpu, fareflow_zones zdo
        WHERE t.PULocationID = zpu.LocationID AND t.DOLocationID = zdo.LocationID""")


@query("j02_inner", f"""SELECT {SPAN}, {LABELS} FROM trips JOIN zones zpu ON PULocationID = zpu.LocationID
       JOIN zones zdo ON DOLocationID = zdo.LocationID""", "trips zones")
def inner(t):
    out = joins.with_zone(t.trips, t.zones, "PULocationID", "pickup", "inner")
    return located(joins.with_zone(out, t.zones, "DOLocationID", "dropoff", "inner"))


def _outer(name: str, how: str, sql_how: str):
    @query(name, f"""SELECT {SPAN}, {LABELS} FROM trips {sql_how} some_zones zpu ON PULocationID = zpu.LocationID
           JOIN some_zones zdo ON DOLocationID = zdo.LocationID""", "trips some_zones")
    def outer(t):
        out = joins.with_zone(t.trips, t.some_zones, "PULocationID", "pickup", how)
        return located(joins.with_zone(out, t.some_zones, "DOLocationID", "dropoff", "inner"))


_outer("j03_left", "left", "LEFT JOIN")
_outer("j04_right", "right", "RIGHT JOIN")
_outer("j05_full_outer", "full", "FULL JOIN")

HOUR = """SELECT date_trunc('hour', {ts}) AS hour, PULocationID AS zone,
    CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS amount, count(*) AS number_records
    FROM {feed} WHERE {ts} >= TIMESTAMP '1996-01-01' GROUP BY 1, 2"""
HOURS = f"""g AS ({HOUR.format(ts='lpep_pickup_datetime', feed='green')}),
    y AS ({HOUR.format(ts='tpep_pickup_datetime', feed='yellow')}),
    both_services AS (SELECT coalesce(g.hour, y.hour) AS hour, coalesce(g.zone, y.zone) AS zone,
        g.amount AS green_amount, g.number_records AS green_number_records,
        y.amount AS yellow_amount, y.number_records AS yellow_number_records
        FROM g FULL JOIN y ON g.hour = y.hour AND g.zone = y.zone)"""


def hourly(t):
    make = lambda df, prefix, tag: marts.hourly_zone_revenue(
        df, "1996-01-01", f"{prefix}_pickup_datetime", "PULocationID", "total_amount"
    ).withColumnsRenamed({"amount": f"{tag}_amount", "number_records": f"{tag}_number_records"})
    return make(t.green, "lpep", "green").join(make(t.yellow, "tpep", "yellow"), on=["hour", "zone"], how="outer")


@query("j06_full_using", f"WITH {HOURS} SELECT * FROM both_services", "green yellow")
def full_using(t):
    return hourly(t)


@query("j07_different_keys", f"""WITH {HOURS} SELECT b.* EXCLUDE (zone), z.Borough, z.Zone, z.service_zone
       FROM both_services b JOIN zones z ON b.zone = z.LocationID""", "green yellow zones")
def different_keys(t):
    zones = joins.small_side(t.zones)
    h = hourly(t).withColumnRenamed("zone", "zone_id")
    return h.join(zones, h.zone_id == zones.LocationID).drop("LocationID", "zone_id")


@query("j08_star", "SELECT trip_id, pickup_borough, pickup_zone, dropoff_borough, dropoff_zone FROM fact", "fact")
def star(t):
    return t.fact.select("trip_id", "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")


@query("j09_coalesced_key", """SELECT coalesce(t.payment_type, 0) AS payment_type,
       coalesce(payment_type_description, 'Unknown') AS payment_type_description, count(*) AS n
       FROM trips t LEFT JOIN payments ON coalesce(t.payment_type, 0) = payment_type_code GROUP BY 1, 2""",
       "trips payments")
def coalesced_key(t):
    rows = t.trips.select(F.coalesce("payment_type", F.lit(0)).alias("payment_type"))
    lookup = joins.small_side(staging.payment_types(t.spark))
    return (rows.join(lookup, F.col("payment_type") == F.col("payment_type_code"), "left")
            .groupBy("payment_type", F.coalesce("payment_type_description", F.lit("Unknown")).alias("payment_type_description"))
            .agg(F.count("*").alias("n")))


@query("j10_not_in_either", f"""SELECT {SPAN}, PULocationID, DOLocationID FROM trips
       WHERE DOLocationID NOT IN (SELECT LocationID FROM some_zones)
       OR PULocationID NOT IN (SELECT LocationID FROM some_zones)""", "trips some_zones")
def not_in_either(t):
    return joins.unknown_locations(t.trips, t.some_zones, ["DOLocationID", "PULocationID"]).select(
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "total_amount", "PULocationID", "DOLocationID")


@query("j10_not_in_null_aware", """SELECT count(*) AS n FROM fhv WHERE PUlocationID NOT IN
       (SELECT nullif(LocationID, 3) FROM zones WHERE LocationID < 10)""", "fhv zones")
def not_in_nulls(t):
    listed = t.zones.filter("LocationID < 10").select(F.expr("nullif(LocationID, 3)").alias("id"))
    return joins.not_in(t.fhv, "PUlocationID", listed, "id").agg(F.count("*").alias("n"))


@query("j10_left_anti", """SELECT PUlocationID, count(*) AS n FROM fhv WHERE NOT EXISTS
       (SELECT 1 FROM some_zones WHERE LocationID = PUlocationID) GROUP BY 1""", "fhv some_zones")
def left_anti(t):
    return (t.fhv.join(joins.small_side(t.some_zones), F.col("PUlocationID") == F.col("LocationID"), "left_anti")
            .groupBy("PUlocationID").agg(F.count("*").alias("n")))


@query("j11_semi", """SELECT count(*) AS n FROM trips WHERE EXISTS
       (SELECT 1 FROM some_zones WHERE LocationID = PULocationID)""", "trips some_zones")
def semi(t):
    return t.trips.join(joins.small_side(t.some_zones), F.col("PULocationID") == F.col("LocationID"), "left_semi").agg(
        F.count("*").alias("n"))


@query("j12_latest_dropoff_zone", """SELECT Zone AS taxi_zone, tpep_dropoff_datetime AS latest_dropoff_time
       FROM trips JOIN zones ON DOLocationID = LocationID
       WHERE tpep_dropoff_datetime = (SELECT max(tpep_dropoff_datetime) FROM trips)""", "trips zones")
def latest_dropoff(t):
    latest = joins.at_latest(t.trips, "tpep_dropoff_datetime")
    return joins.with_zone(latest, t.zones, "DOLocationID", "dropoff", "inner").select(
        F.col("dropoff_zone").alias("taxi_zone"), F.col("tpep_dropoff_datetime").alias("latest_dropoff_time"))


@query("j13_trailing_hours", """SELECT PULocationID, count(*) AS n FROM trips
       WHERE tpep_pickup_datetime >= (SELECT max(tpep_pickup_datetime) - INTERVAL 17 HOUR FROM trips)
       GROUP BY 1""", "trips")
def trailing_hours(t):
    return (joins.within_latest(t.trips, "tpep_pickup_datetime", "17 hours")
            .groupBy("PULocationID").agg(F.count("*").alias("n")))


@query("j15_filter_dimension_top", """SELECT zdo.Zone AS dropoff_zone, max(tip_amount) AS tip FROM trips
       JOIN zones zpu ON PULocationID = zpu.LocationID JOIN zones zdo ON DOLocationID = zdo.LocationID
       WHERE zpu.Zone = 'NATION_7' GROUP BY 1 ORDER BY tip DESC, dropoff_zone LIMIT 1""", "trips zones")
def filter_dimension(t):
    out = joins.with_zone(t.trips, t.zones.filter("Zone = 'NATION_7'"), "PULocationID", "pickup", "inner")
    out = joins.with_zone(out, t.zones, "DOLocationID", "dropoff", "inner")
    return out.groupBy("dropoff_zone").agg(F.max("tip_amount").alias("tip")).orderBy(F.desc("tip"), "dropoff_zone").limit(1)


@query("j16_known_locations", """SELECT p.Borough AS pickup_borough, d.Borough AS dropoff_borough, count(*) AS n FROM fhv
       JOIN some_zones p ON PUlocationID = p.LocationID JOIN some_zones d ON DOlocationID = d.LocationID
       GROUP BY 1, 2""", "fhv some_zones")
def known_locations(t):
    fhv = t.fhv.withColumnsRenamed({"PUlocationID": "pickup_location_id", "DOlocationID": "dropoff_location_id"})
    return marts.known_locations(fhv, t.some_zones).groupBy("pickup_borough", "dropoff_borough").agg(F.count("*").alias("n"))


@query("j17_pair_label", """SELECT concat(coalesce(p.Zone, 'Unknown'), ' / ', coalesce(d.Zone, 'Unknown')) AS pu_do_pair,
       count(*) AS n FROM fhv LEFT JOIN some_zones p ON PUlocationID = p.LocationID
       LEFT JOIN some_zones d ON DOlocationID = d.LocationID GROUP BY 1""", "fhv some_zones")
def pair_label(t):
    out = joins.with_zone(t.fhv, t.some_zones, "PUlocationID", "pickup")
    out = joins.with_zone(out, t.some_zones, "DOlocationID", "dropoff")
    return out.groupBy(C.label(" / ", "pickup_zone", "dropoff_zone", missing="Unknown").alias("pu_do_pair")).agg(
        F.count("*").alias("n"))


NEAR = """SELECT r.user_id AS vendor_id, p.user_id AS location_id, p.ts AS pickup_time, r.ts AS last_dropoff_time
    FROM events r JOIN events p ON r.user_id = p.user_id AND r.event_type = 'purchase' AND p.event_type <> 'purchase'
    AND p.ts BETWEEN r.ts - INTERVAL 20 MINUTE AND r.ts + INTERVAL 20 MINUTE
    WHERE floor(abs(epoch_us(p.ts) - epoch_us(r.ts)) / 60000000) <= 10"""


def ride_streams(events):
    """Purchases stand for finished rides, all other events for pickups."""
    rides = events.filter("event_type = 'purchase'").select(
        F.col("user_id").alias("key"), F.col("user_id").alias("vendor_id"), F.col("ts").alias("dropoff_datetime"))
    pickups = events.filter("event_type <> 'purchase'").select(
        F.col("user_id").alias("key"), F.col("user_id").alias("location_id"), F.col("ts").alias("pickup_datetime"))
    return rides, pickups


@query("j18_range_join", NEAR)
def range_join(t):
    rides, pickups = ride_streams(t.events)
    minutes = F.floor(F.abs(F.unix_micros(F.col("pickup_datetime").cast("timestamp"))
                            - F.unix_micros(F.col("dropoff_datetime").cast("timestamp"))) / 60_000_000)
    return joins.near_in_time(rides, pickups, "key", "dropoff_datetime", "pickup_datetime", 20 * 60, minutes <= 10).select(
        "vendor_id", "location_id", F.col("pickup_datetime").alias("pickup_time"),
        F.col("dropoff_datetime").alias("last_dropoff_time"))
