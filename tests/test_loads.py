"""Load, merge, cursor, schema and nested-document behaviour on small golden inputs."""

import datetime
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_DIR

from __spark_entry__ import queries
from fareflow import session
from fareflow.catalog import tables
from fareflow.functions import columns as C
from fareflow.functions.names import snake_case
from fareflow.operators import joins, loads, nested, quality
from fareflow.session import fresh_path, materialise


@pytest.fixture
def path(spark):
    return fresh_path(spark, "test")


def people(spark):
    first = spark.createDataFrame([(i, f"Person_{i}", 25 + i, "City_A") for i in range(1, 6)],
                                  "ID int, Name string, Age int, City string")
    second = spark.createDataFrame([(i, f"Person_{i}", 30 + i, "City_B", f"Job_{i}") for i in range(3, 9)],
                                   "ID int, Name string, Age int, City string, Occupation string")
    return first, second


def test_append_people(spark, path):
    first, second = people(spark)
    table = loads.load(loads.Target(path, first.schema), first, "append")
    out = loads.load(table, second, "append").read(spark)
    assert out.count() == 11 and out.agg(F.sum("Age")).first()[0] == 353
    assert out.filter("Occupation is null").count() == 5


def test_merge_people(spark, path):
    first, second = people(spark)
    table = loads.create(spark, path, first.schema, "City")
    for part in (first, second):
        table = loads.load(table, part, "merge", ["ID"])
    out = table.read(spark)
    assert out.count() == 8 and out.agg(F.sum("Age")).first()[0] == 266
    assert out.filter("ID = 3").first()["Age"] == 33 and out.filter("Occupation is null").count() == 2
    with pytest.raises(ValueError):
        loads.merge(table, first, [])
    with pytest.raises(ValueError):
        loads.merge(loads.Target(path, first.schema), first, ["ID"])


def test_replace_people(spark, path):
    table = loads.Target(path, people(spark)[0].schema)
    for part in people(spark):
        table = loads.load(table, part, "replace")
    out = table.read(spark)
    assert out.count() == 6 and "Occupation" in out.columns
    with pytest.raises(ValueError):
        loads.load(table, out, "overwrite everything")


def files(spark, path):
    """Name, size and time of each file by partition."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    out = {}
    for r in found.select("path", "modificationTime", "length").collect():
        out.setdefault(r["path"].split("/")[-2], set()).add(tuple(r))
    return out


def test_merge_leaves_other_partitions_as_they_are(spark, path):
    day = lambda n: datetime.date(2024, 1, n)
    rows = lambda *r: spark.createDataFrame(r, "id int, day date, v string")
    table = loads.replace(loads.Target(path, rows().schema, "day"), rows(*[(i, day(1 + i % 5), "old") for i in range(50)], (99, None, "old")))
    before = files(spark, path)
    loads.merge(table, rows((3, day(4), "same day"), (6, day(4), "moved"), (77, day(4), "new"), (77, day(4), "older")), ["id"], ["-v"])
    after = files(spark, path)
    changed = {k for k in before | after if before.get(k) != after.get(k)}
    assert changed == {"day=2024-01-04", "day=2024-01-02"}  # 6 left the second day
    got = {r["id"]: (r["day"], r["v"]) for r in table.read(spark).collect()}
    assert table.read(spark).count() == len(got) == 52 and got[3] == (day(4), "same day") and got[6] == (day(4), "moved")
    assert got[77] == (day(4), "older") and got[99] == (None, "old") and got[4] == (day(5), "old")


def test_merge_with_emptied_null_and_repeated_partitions(spark, path):
    rows = lambda *r: spark.createDataFrame(r, "id int, part string, v int")
    table = loads.replace(loads.Target(path, rows().schema, "part"), rows((1, "a", 1), (2, None, 1), (3, "a/b c", 1), (None, "a", 1)))
    source = rows((1, "z", 2), (2, "z", 2), (3, None, 2), (None, "z", 2))
    for _ in range(2):  # a repeated run gives the same rows, but for those without a key, which match nothing
        loads.merge(table, source.filter("id is not null"), ["id"])
    loads.merge(table, source.limit(0), ["id"])
    assert sorted(map(repr, map(tuple, table.read(spark).collect()))) == sorted(map(repr, [(1, 2, "z"), (2, 2, "z"), (3, 2, None), (None, 1, "a")]))
    loads.merge(table, source.filter("id is null"), ["id"])
    assert table.read(spark).filter("id is null").count() == 2


def test_insert_only_keeps_duplicates_of_one_batch_and_is_idempotent(spark, path):
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "id string, v int")
    table = loads.create(spark, path, batch.schema)
    loads.append_missing(table, batch, "id")
    loads.append_missing(table, batch, "id")
    assert table.read(spark).count() == 3
    assert loads.insert_only(batch.limit(0), batch, "id").count() == 3


def test_append_missing_with_null_partition(spark, path):
    batch = spark.createDataFrame([("a", None), ("b", 3)], "id string, v int")
    table = loads.create(spark, path, batch.schema, "v")
    loads.append_missing(table, batch, "id")
    loads.append_missing(table, batch, "id")
    assert table.read(spark).count() == 2


def test_append_missing_reads_the_partitions_of_the_source(spark, path):
    batch = spark.createDataFrame([(f"{m}-{i}", m, i) for m in "abc" for i in range(3)], "id string, month string, n int")
    table = loads.replace(loads.Target(path, batch.schema, "month"), batch)
    before = files(spark, path)
    more = spark.createDataFrame([("b-1", "b", 5), ("b-9", "b", 6)], "id string, month string, n int")
    loads.append_missing(table, more, "id")
    after = files(spark, path)
    assert {k for k in after if before[k] != after[k]} == {"month=b"} and before["month=b"] < after["month=b"]
    assert sorted((r["id"], r["n"]) for r in table.read(spark).filter("month = 'b'").collect()) == [("b-0", 0), ("b-1", 1), ("b-2", 2), ("b-9", 6)]


def test_append_missing_writes_the_new_rows_only(spark, path):
    """Copies of a key on both sides and rows without one; the target's keys are not written a second time."""
    rows = lambda *r: spark.createDataFrame(r, "id string, n int")
    table = loads.create(spark, path, rows().schema)
    loads.append(table, rows(("hot", 1), ("hot", 2), (None, 3), ("a", 4)))
    staged = materialise(rows(("hot", 5), ("hot", 5), (None, 6), ("b", 7), ("b", 7)), "staged")
    folder = os.path.dirname(staged.written_to)
    before = set(os.listdir(folder))
    loads.append_missing(table, staged, "id")
    assert set(os.listdir(folder)) == before
    got = sorted((tuple(r) for r in table.read(spark).collect()), key=repr)
    assert got == sorted([("hot", 1), ("hot", 2), (None, 3), ("a", 4), (None, 6), ("b", 7), ("b", 7)], key=repr)


def test_merged_digests_are_kept_as_bytes(spark):
    folder = session.shared_folder(spark)
    before = set(os.listdir(folder))
    ids = queries()["m02_insert_only_merge"](spark, SF_DIR).select("unique_row_id")
    assert ids.filter("unique_row_id rlike '^[0-9a-f]{32}$'").count() == ids.count() > 0
    for new in set(os.listdir(folder)) - before:
        assert spark.read.parquet(f"{folder}/{new}").schema["unique_row_id"].dataType == T.BinaryType()


def test_trip_orders_meet_their_customers_before_the_line_items(spark):
    """So that the line items are not exchanged once more, by customer."""
    plan = tables.Tables(spark, SF_DIR).trips._jdf.queryExecution().analyzed().toString()
    depth = {k: next(x for x in plan.splitlines() if "Join" in x and k in x).index("Join") for k in ("o_custkey", "l_orderkey")}
    assert depth["o_custkey"] > depth["l_orderkey"]


def test_known_row_with_another_instant(spark, path):
    """The key holds whole seconds: a known row just below the source's first instant is still found."""
    at = lambda micros: datetime.datetime(2024, 1, 1, 12, 0, 5, micros)
    rows = lambda *r: spark.createDataFrame(r, "id string, ts timestamp").withColumn("day", F.to_date("ts"))
    table = loads.create(spark, path, rows(("", at(0))).schema, "day")
    loads.append_missing(table, rows(("12:00:05", at(100))), "id")
    loads.append_missing(table, rows(("12:00:05", at(900)), ("new", at(950))), "id")
    assert sorted(r["id"] for r in table.read(spark).collect()) == ["12:00:05", "new"]


def test_appends_read_nothing(spark, path, monkeypatch):
    table = loads.create(spark, path, "id long")
    with monkeypatch.context() as m:
        m.setattr(loads.Target, "read", lambda *a: pytest.fail("an append read the table"))
        for i in range(4):
            loads.append(table, spark.range(2))
    assert table.read(spark).count() == 8
    for i in range(4):
        loads.replace(table, spark.range(i))
    assert table.read(spark).count() == 3


def test_create_leaves_a_table_as_it_is(spark, path):
    loads.append(loads.create(spark, path, "id long"), spark.range(3))
    assert loads.create(spark, path, "id long").read(spark).count() == 3


def test_unfinished_write_does_not_show(spark, path):
    table = loads.append(loads.create(spark, path, "id long"), spark.range(3))
    with pytest.raises(Exception):
        loads.append(table, spark.range(8).select(F.when(F.col("id") < 7, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id")))
    assert table.read(spark).count() == 3


def test_late_rows_at_the_cursor(spark, path):
    cursor = loads.Cursor(spark, path, "2024-01-01 00:00:00")
    d = lambda day: datetime.datetime(2024, 1, day)
    rows = lambda *r: spark.createDataFrame(r, "id string, ts timestamp")
    first = cursor.extract(rows(("a", d(2)), ("b", d(3))), "ts")
    assert first.count() == 2
    cursor.advance(first, "ts")
    later = rows(("a", d(2)), ("b", d(3)), ("late", d(3)), ("c", d(4)))
    assert {r["id"] for r in cursor.extract(later, "ts", first, "id").collect()} == {"late", "c"}
    assert {r["id"] for r in cursor.extract(later, "ts").collect()} == {"c"}


def test_incremental_strict_and_lookback(spark):
    d = lambda day: datetime.datetime(2024, 1, day)
    rows = lambda *r: spark.createDataFrame(r, "id string, ts timestamp").withColumn("day", F.to_date("ts"))
    old, source = rows(("a", d(1)), ("b", d(5))), rows(("late", d(4)), ("equal", d(5)), ("new", d(6)))
    make = lambda df: loads.replace(loads.Target(fresh_path(spark, "incremental"), df.schema, "day"), df)
    ids = lambda target: {r["id"] for r in target.read(spark).collect()}
    assert ids(loads.incremental(make(old), source, "id", "ts")) == {"a", "b", "new"}
    assert ids(loads.incremental(make(old), source, "id", "ts", lookback="2 days")) == {"a", "b", "late", "equal", "new"}
    empty = loads.create(spark, fresh_path(spark, "incremental"), old.schema, "day")
    assert ids(loads.incremental(empty, source, "id", "ts")) == {"late", "equal", "new"}
    with pytest.raises(loads.SchemaChanged):
        loads.incremental(make(old), source.withColumn("extra", F.lit(1)), "id", "ts")


def test_cursor_second_run_is_empty(spark, path):
    source = spark.createDataFrame([(1, "2009-06-14"), (2, "2009-06-15"), (3, "2009-06-16")], "id int, day string")
    cursor = loads.Cursor(spark, path, "2009-06-15")
    fresh = cursor.extract(source, "day")
    assert fresh.count() == 2
    cursor.advance(fresh, "day")
    assert cursor.extract(source, "day").count() == 0
    cursor.advance(cursor.extract(source, "day"), "day")  # nothing new leaves the cursor as it is
    assert cursor.value() == "2009-06-16"


def test_history(spark):
    df = spark.createDataFrame([("car", 1, "red"), ("car", 5, "blue"), ("bus", 2, "grey")], "id string, at int, colour string")
    out = {(r["id"], r["version"]): (r["valid_to"], r["is_current"]) for r in loads.history(df, ["id"], "at").collect()}
    assert out == {("car", 1): (5, False), ("car", 2): (None, True), ("bus", 1): (None, True)}


def test_schema_compatibility():
    base = T.StructType([T.StructField("vendor_id", T.StringType()), T.StructField("distance", T.DoubleType())])
    wider = T.StructType([*base, T.StructField("pu_location_id", T.LongType())])
    retyped = T.StructType([T.StructField("vendor_id", T.IntegerType()), base[1]])
    required = T.StructType([*base, T.StructField("zone", T.LongType(), False)])
    assert loads.compatible(base, wider) and not loads.compatible(base, retyped) and not loads.compatible(base, required)
    assert loads.schema_changes(wider, base) == [("pu_location_id", "removed")]


def test_delete_by_key_keeps_null_keys(spark):
    df = spark.createDataFrame([(1,), (142,), (None,)], "LocationID int")
    assert loads.delete_by_key(df, "LocationID", [142]).count() == 2


def test_nested_ride(spark, tmp_path):
    doc = ('{"vendor_name":"VTS","record_hash":"b0","time":{"pickup":"2009-06-14 23:23:00"},'
           '"coordinates":{"start":{"lon":-73.78,"lat":40.64},"end":{"lon":-73.98,"lat":40.74}},'
           '"passengers":[{"name":"John","rating":4.9},{"name":"Jack","rating":3.9}],'
           '"stops":[{"lon":-73.6,"seen":["x","y"]},{"lon":-73.5,"seen":[]}]}')
    (tmp_path / "ride.json").write_text(doc)
    df = spark.read.json(str(tmp_path))
    tables = nested.normalise(df, "rides", ["record_hash"])
    assert set(tables) == {"rides", "rides__passengers", "rides__stops", "rides__stops__seen"}
    parent = tables["rides"].first().asDict()
    assert parent["coordinates__end__lat"] == 40.74 and parent["time__pickup"] == "2009-06-14 23:23:00"
    kids = {r["list_idx"]: r for r in tables["rides__passengers"].collect()}
    assert kids[0]["name"] == "John" and kids[1]["rating"] == 3.9 and kids[0]["parent_id"] == parent["row_id"]
    assert [r["value"] for r in tables["rides__stops__seen"].orderBy("list_idx").collect()] == ["x", "y"]


def test_products_with_defaults(spark):
    df = spark.createDataFrame([("A", 1.5), (None, 2.0)], "brand string, price double")
    out = nested.with_defaults(df, ["brand", "price", "sku"]).collect()
    assert [(r["brand"], r["sku"]) for r in out] == [("A", "N/A"), ("N/A", "N/A")]


def test_snake_case():
    assert snake_case("Trip_Pickup_DateTime") == "trip_pickup_date_time"
    assert snake_case("PULocationID") == "pu_location_id"
    assert snake_case("VendorID") == "vendor_id"


def test_column_helpers(spark):
    df = spark.createDataFrame([("B02884",), ("B00003",), ("B00001",)], "base string")
    expected = ["s/b44", "a/003", "e/001"]
    assert [r[0] for r in df.select(C.base_code("base")).collect()] == expected
    assert [r[0] for r in df.select(C.base_code_udf("base")).collect()] == expected
    t = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:59' a, TIMESTAMP_NTZ '2024-01-01 00:01:01' b")
    assert t.select(C.minute_diff("a", "b"), C.second_diff("a", "b")).first()[:] == (1, 2)
    assert t.select(C.quarter_label("a")).first()[0] == "2024/Q1"
    keys = spark.createDataFrame([("1", "23"), ("12", "3")], "a string, b string")
    assert keys.select(C.row_hash("a", "b").alias("h")).distinct().count() == 1
    assert keys.select(C.row_hash_safe("a", "b").alias("h")).distinct().count() == 2
    assert [r[0] for r in df.select(C.parse_ts(F.lit("nonsense"))).distinct().collect()] == [None]


def test_not_in_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = lambda *v: spark.createDataFrame([(x,) for x in v], "r int")
    rows = lambda r: sorted(x["k"] or 0 for x in joins.not_in(left, "k", r, "r").collect())
    assert rows(right(1)) == [2]
    assert rows(right(1, None)) == []
    assert rows(spark.createDataFrame([], "r int")) == [0, 1, 2]
    assert left.join(right(1), F.col("k") == F.col("r"), "left_anti").count() == 2  # keeps the NULL key


def test_near_in_time_matches_brute_force(spark):
    import random
    rng = random.Random(1)
    base = datetime.datetime(2024, 1, 1)
    make = lambda n: [("hot" if rng.random() < .5 else "cold", base + datetime.timedelta(seconds=rng.randrange(20_000))) for _ in range(n)]
    a, b = make(150), make(150)
    left = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(a)], "key string, lt timestamp, li int")
    right = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(b)], "key string, rt timestamp, ri int")
    got = {(r["li"], r["ri"]) for r in joins.near_in_time(left, right, "key", "lt", "rt", 1200).collect()}
    want = {(i, j) for i, (k, t) in enumerate(a) for j, (m, u) in enumerate(b) if k == m and abs((t - u).total_seconds()) <= 1200}
    assert got == want and joins.near_in_time(left, right, "key", "lt", "rt", 1200).count() == len(want)


def test_small_side_is_size_checked(spark):
    df = spark.range(1000)
    hinted = lambda side: "strategy=broadcast" in side._jdf.queryExecution().analyzed().toString()
    assert hinted(joins.small_side(df)) and not hinted(joins.small_side(df, 10))


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "z")], "id int, kind string")
    out = quality.run(quality.not_null(df, "kind"), quality.unique(df, "id"), quality.accepted_values(df, "kind", ["a"]),
                      quality.unique(df, "id", "kind"), quality.relationships(df, "id", spark.createDataFrame([(1,)], "p int"), "p"))
    assert [r["failing"] for r in out.collect()] == [1, 1, 1, 0, 1]


def test_days_back(monkeypatch):
    monkeypatch.setenv("DAYS_BACK", "7")
    assert C.days_back(3) == 3 and C.days_back() == 7
    monkeypatch.delenv("DAYS_BACK")
    assert C.days_back() == 30


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_with_zone_equals_plain_join(spark, how):
    trips = spark.createDataFrame([(1, 1), (2, 1), (3, 9), (4, None)], "id int, loc int")
    zones = spark.createDataFrame([(1, "B1", "Z1"), (2, "B2", "Z2"), (None, "B0", "Z0")], "LocationID int, Borough string, Zone string")
    got = joins.with_zone(trips, zones, "loc", "p", how).select("id", "loc", "p_zone").collect()
    want = trips.join(zones, F.col("loc") == F.col("LocationID"), how).select("id", "loc", F.col("Zone").alias("p_zone")).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
