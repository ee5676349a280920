"""Trip feeds made from the given tables, and the same feeds as SQL for the oracle.

A trip is a line item: its order gives the pickup day and payment, its supplier's nation the
pickup zone, its customer's nation the dropoff zone, and nations stand for zones.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import staging
from ..session import fresh_path, is_folder, tune
from ..sources import messages

# Expressions that mean the same in both dialects.
SIGN = "(CASE l_linenumber WHEN 5 THEN -1 WHEN 6 THEN 0 ELSE 1 END)"
COMMON = {
    "VendorID": "CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linestatus = 'F' THEN 1 ELSE 2 END",
    "store_and_fwd_flag": "CASE WHEN l_discount = 0 THEN 'Y' ELSE 'N' END",
    "RatecodeID": "1 + l_linenumber % 6",
    "PULocationID": "s_nationkey",
    "DOLocationID": "c_nationkey",
    "passenger_count": "l_linenumber - 1",
    "trip_distance": "l_quantity - 1",
    "fare_amount": f"l_extendedprice * {SIGN}",
    "extra": "CAST(l_linenumber * 0.5 AS DOUBLE)",
    "mta_tax": "CAST(0.5 AS DOUBLE)",
    "tip_amount": "l_discount * l_quantity",
    "tolls_amount": "l_tax * l_quantity",
    "improvement_surcharge": "CAST(0.3 AS DOUBLE)",
    "total_amount": f"l_extendedprice * {SIGN} + CAST(l_linenumber * 0.5 + 0.8 AS DOUBLE)"
                    " + l_discount * l_quantity + l_tax * l_quantity",
    "payment_type": "CAST(nullif(substr(o_orderpriority, 1, 1), '5') AS INT)",
    "congestion_surcharge": "CAST(2.5 AS DOUBLE)",
}
GREEN_ONLY = {"ehail_fee": "CAST(0.0 AS DOUBLE)", "trip_type": "1 + l_linenumber % 2"}
FHV = {
    "dispatching_base_num": "CASE WHEN l_linenumber = 7 THEN NULL ELSE 'B' || lpad(CAST(l_suppkey AS STRING), 5, '0') END",
    "PUlocationID": "nullif(s_nationkey, 3)",
    "DOlocationID": "nullif(c_nationkey, 4)",
    "affiliated_base_number": "'B' || lpad(CAST(l_partkey AS STRING), 5, '0')",
}
SPARK_PICKUP = "o_orderdate + (l_partkey % 1440 * 60 + l_suppkey % 60) * INTERVAL '1' SECOND"
SPARK_DROPOFF = ("o_orderdate + (l_partkey % 1440 * 60 + l_suppkey % 60 + CAST(l_quantity AS INT) * 60 + l_linenumber * 7)"
                 " * INTERVAL '1' SECOND")
DUCK_PICKUP = "o_orderdate + to_minutes(l_partkey % 1440) + to_seconds(l_suppkey % 60)"
DUCK_DROPOFF = f"{DUCK_PICKUP} + to_minutes(CAST(l_quantity AS BIGINT)) + to_seconds(l_linenumber * 7)"
ZONE_SERVICE = "CASE r_name WHEN 'AFRICA' THEN 'Yellow Zone' ELSE 'Boro Zone' END"


def _feed(prefix: str, extra: dict[str, str], pickup: str, dropoff: str) -> dict[str, str]:
    out = {"VendorID": COMMON["VendorID"], f"{prefix}pickup_datetime": pickup, f"{prefix}dropoff_datetime": dropoff}
    return out | {k: v for k, v in COMMON.items() if k != "VendorID"} | extra


class Tables:
    """The given tables by name, and the trip feeds built on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = tune(spark), sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def scratch(self, label: str) -> str:
        return fresh_path(self.spark, label)

    def stream(self, name: str) -> DataFrame:
        """A given table as a stream of its files."""
        path = self.path(name)
        schema = self.spark.read.parquet(path).schema
        if is_folder(self.spark, path):
            return messages.file_stream(self.spark, path, schema)
        return messages.file_stream(self.spark, self.dir, schema, pattern=f"{name}.parquet")

    @cached_property
    def _lines(self) -> DataFrame:
        """Orders meet their customers first, so that the line items are exchanged once, by order."""
        orders = self.orders.join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
        return (self.lineitem.join(self.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
                .join(orders, F.col("l_orderkey") == F.col("o_orderkey")))

    def _select(self, prefix: str, extra: dict[str, str], where: str | None = None) -> DataFrame:
        rows = self._lines.filter(where) if where else self._lines
        return rows.selectExpr(*[f"{e} AS {n}" for n, e in _feed(prefix, extra, SPARK_PICKUP, SPARK_DROPOFF).items()])

    @cached_property
    def trips(self) -> DataFrame:
        """All trips in the yellow layout."""
        return self._select("tpep_", {})

    @cached_property
    def green(self) -> DataFrame:
        return self._select("lpep_", GREEN_ONLY, "l_returnflag = 'R'")

    @cached_property
    def yellow(self) -> DataFrame:
        return self._select("tpep_", {}, "l_returnflag <> 'R'")

    @cached_property
    def fhv(self) -> DataFrame:
        return self._lines.selectExpr(
            f"{FHV['dispatching_base_num']} AS dispatching_base_num", f"{SPARK_PICKUP} AS pickup_datetime",
            f"{SPARK_DROPOFF} AS dropOff_datetime",
            *[f"{e} AS {n}" for n, e in FHV.items() if n != "dispatching_base_num"])

    @cached_property
    def zones(self) -> DataFrame:
        return self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
            "n_nationkey AS LocationID", "r_name AS Borough", "n_name AS Zone", f"{ZONE_SERVICE} AS service_zone")

    @cached_property
    def some_zones(self) -> DataFrame:
        """Zones after one was deleted, as the join lessons do."""
        from ..operators.loads import delete_by_key
        return delete_by_key(self.zones, "LocationID", [17])

    @cached_property
    def unioned(self) -> DataFrame:
        return staging.union_services(
            staging.standardise(self.green, "lpep"), staging.standardise(self.yellow, "tpep"))

    @cached_property
    def enriched(self) -> DataFrame:
        return staging.enrich(self.unioned, staging.payment_types(self.spark))

    @cached_property
    def fact(self) -> DataFrame:
        from ..plans import marts
        return marts.fact_trips(self.enriched, self.some_zones)


def _sql_select(exprs: dict[str, str], where: str = "") -> str:
    body = ", ".join(f"{e} AS {n}" for n, e in exprs.items())
    return (f"SELECT {body} FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey"
            f" JOIN customer ON o_custkey = c_custkey {where}")


def _sql_standard(prefix: str, feed: str) -> str:
    ids = ", ".join(f"CAST({o} AS INTEGER) AS {n}" for o, n in staging.IDS.items())
    times = ", ".join(f"{prefix}_{t} AS {t}" for t in staging.TIMES)
    have = [a for a in ("trip_distance", *staging.AMOUNTS) if feed == "green" or a != "ehail_fee"]
    nums = ", ".join(f"CAST({a} AS DECIMAL(18,3)) AS {a}" for a in have)
    trip_type = ", trip_type" if feed == "green" else ""
    return (f"SELECT {ids}, {times}, store_and_fwd_flag, passenger_count{trip_type}, payment_type, {nums}"
            f" FROM {feed} WHERE VendorID IS NOT NULL")


def _payments_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT {k} AS payment_type_code, '{v}' AS payment_type_description" for k, v in staging.PAYMENTS.items())


_TIE = ", ".join(f"{c} NULLS LAST" for c in staging.TRIP_COLUMNS if c not in (*staging.TRIP_KEY, "dropoff_datetime"))
CTES = {
    "trips": ((), _sql_select(_feed("tpep_", {}, DUCK_PICKUP, DUCK_DROPOFF))),
    "green": ((), _sql_select(_feed("lpep_", GREEN_ONLY, DUCK_PICKUP, DUCK_DROPOFF), "WHERE l_returnflag = 'R'")),
    "yellow": ((), _sql_select(_feed("tpep_", {}, DUCK_PICKUP, DUCK_DROPOFF), "WHERE l_returnflag <> 'R'")),
    "fhv": ((), _sql_select({"dispatching_base_num": FHV["dispatching_base_num"], "pickup_datetime": DUCK_PICKUP,
                             "dropOff_datetime": DUCK_DROPOFF} | FHV)),
    "zones": ((), "SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone, "
                  f"{ZONE_SERVICE} AS service_zone FROM nation JOIN region ON n_regionkey = r_regionkey"),
    "some_zones": (("zones",), "SELECT * FROM zones WHERE LocationID <> 17"),
    "payments": ((), _payments_sql()),
    "stg_green": (("green",), _sql_standard("lpep", "green")),
    "stg_yellow": (("yellow",), _sql_standard("tpep", "yellow")),
    "unioned": (("stg_green", "stg_yellow"),
                "SELECT {c}, 'Green' AS service_type FROM stg_green UNION ALL "
                "SELECT {y}, 'Yellow' AS service_type FROM stg_yellow".format(
                    c=", ".join(staging.TRIP_COLUMNS[:-1]),
                    y=", ".join({"trip_type": "1 AS trip_type", "ehail_fee": "CAST(0 AS DECIMAL(18,3)) AS ehail_fee"}
                                .get(c, c) for c in staging.TRIP_COLUMNS[:-1]))),
    "enriched": (("unioned", "payments"),
                 "SELECT md5(concat_ws('-', CAST(vendor_id AS VARCHAR), strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'),"
                 " CAST(pickup_location_id AS VARCHAR), service_type)) AS trip_id, {c},"
                 " coalesce(payment_type, 0) AS payment_type, service_type,"
                 " coalesce(payment_type_description, 'Unknown') AS payment_type_description"
                 " FROM unioned LEFT JOIN payments ON coalesce(payment_type, 0) = payment_type_code"
                 " QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY dropoff_datetime, {t}) = 1".format(
                     c=", ".join(staging.TRIP_COLUMNS[:-2]), k=", ".join(staging.TRIP_KEY), t=_TIE)),
    "fact": (("enriched", "some_zones"),
             "SELECT t.*, p.Borough AS pickup_borough, p.Zone AS pickup_zone, d.Borough AS dropoff_borough,"
             " d.Zone AS dropoff_zone, date_diff('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes"
             " FROM enriched t LEFT JOIN some_zones p ON pickup_location_id = p.LocationID"
             " LEFT JOIN some_zones d ON dropoff_location_id = d.LocationID"),
}


def with_ctes(body: str, *names: str) -> str:
    """``body`` with the named feeds, and those they build on, in front."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for parent in CTES[name][0]:
            need(parent)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        need(name)
    if not ordered:
        return body
    head = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
