"""Input schemas of the trip feeds, dimensions and stream messages."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "float": T.FloatType(),
          "string": T.StringType(), "binary": T.BinaryType(), "timestamp": T.TimestampType()}


def ddl(text: str) -> T.StructType:
    """Struct from 'name type, ...'; needs no running session."""
    pairs = (field.split() for field in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# --- fixed values: column names and types of the published feeds, in feed order ---
GREEN = ddl(
    "VendorID int, lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp, "
    "store_and_fwd_flag string, RatecodeID int, PULocationID int, DOLocationID int, "
    "passenger_count int, trip_distance double, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, ehail_fee double, "
    "improvement_surcharge double, total_amount double, payment_type int, trip_type int, "
    "congestion_surcharge double"
)
YELLOW = ddl(
    "VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
    "passenger_count int, trip_distance double, RatecodeID int, store_and_fwd_flag string, "
    "PULocationID int, DOLocationID int, payment_type int, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
    "total_amount double, congestion_surcharge double"
)
FHVHV = ddl(
    "hvfhs_license_num string, dispatching_base_num string, pickup_datetime timestamp, "
    "dropoff_datetime timestamp, PULocationID int, DOLocationID int, SR_Flag string"
)
FHV = ddl(
    "dispatching_base_num string, pickup_datetime timestamp, dropOff_datetime timestamp, "
    "PUlocationID int, DOlocationID int, affiliated_base_number string"
)
ZONES = ddl("LocationID int, Borough string, Zone string, service_zone string")
PAYMENT_TYPES = ddl("payment_type_code int, payment_type_description string")

RIDE_TEXT = ddl(
    "vendor_id int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
    "passenger_count int, trip_distance float, payment_type int, total_amount float"
)
GREEN_JSON = ddl(
    "lpep_pickup_datetime string, lpep_dropoff_datetime string, PULocationID int, "
    "DOLocationID int, passenger_count double, trip_distance double, tip_amount double"
)
RIDE_RECORD = ddl(
    "vendorId string, passenger_count int, trip_distance float, payment_type int, total_amount float"
)
TEST_EVENT = ddl("test_data int, event_timestamp double")
ENVELOPE = ddl(
    "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
)
# --- end of fixed values ---

FEEDS = {"green": GREEN, "yellow": YELLOW, "fhvhv": FHVHV, "fhv": FHV}


def as_ntz(schema: T.StructType) -> T.StructType:
    """The same schema with zone-free timestamps (warehouse tables)."""
    return T.StructType([
        T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
        for f in schema
    ])
