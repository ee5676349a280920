"""Paged records against the rows that were written, gaps and a cursor included."""

import json

import pytest

from fareflow.schemas import ddl
from fareflow.session import fresh_path
from fareflow.sources import paging, readers

SCHEMA = ddl("id long, name string")


def put(path, page, ids, part="part-0.json"):
    folder = path / f"page={page}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / part).write_text("".join(json.dumps({"id": i, "name": f"n{i}"}) + "\n" for i in ids))


@pytest.mark.parametrize("per_task", [1, 2, 64])
def test_whole_pages(spark, per_task):
    path = fresh_path(spark, "pages")
    df = spark.range(95).selectExpr("id", "concat('n', id) AS name")
    paging.write_pages(df, path, ["id"], 10)
    out = paging.read_pages(spark, path, SCHEMA, per_task).collect()
    assert sorted((r["id"], r["name"], r["page"]) for r in out) == [(i, f"n{i}", 1 + i // 10) for i in range(95)]


@pytest.mark.parametrize("gap", [1, 2, 3, 4, 5])
def test_reading_stops_at_the_first_empty_page(spark, tmp_path, gap):
    for page in range(1, 10):
        put(tmp_path, page, [] if page == gap else [page])
    out = paging.read_pages(spark, str(tmp_path), SCHEMA, 2)
    assert sorted(r["id"] for r in out.collect()) == list(range(1, gap))


def test_no_pages_at_all(spark, tmp_path):
    assert paging.read_pages(spark, str(tmp_path / "none"), SCHEMA).count() == 0
    assert paging.read_pages(spark, f"file:{tmp_path}/none", SCHEMA).count() == 0


@pytest.mark.parametrize("per_task", [1, 64])
def test_a_second_run_reads_only_what_was_added(spark, tmp_path, per_task):
    path, target, state = tmp_path / "pages", str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda: paging.load_new(spark, str(path), SCHEMA, target, state, per_task)
    ids = lambda: sorted(r["id"] for r in spark.read.parquet(target).collect())
    put(path, 1, [0, 1])
    put(path, 2, [2, 3])
    put(path, 3, [4])
    assert run() == 5 and ids() == [0, 1, 2, 3, 4]
    assert run() == 0 and ids() == [0, 1, 2, 3, 4]
    put(path, 3, [4, 5])  # the last page grows
    assert run() == 1 and ids() == [0, 1, 2, 3, 4, 5]
    put(path, 4, [6])
    put(path, 5, [7])
    assert run() == 2 and run() == 0
    assert ids() == list(range(8))


def test_types_widen_to_what_all_rows_hold(spark, tmp_path):
    lines = ["i,l,d,t,b,s,e"] + [f"{n},{n},{n},2024-01-01 00:00:{n % 60:02d},true,{n}," for n in range(2000)]
    lines[-1] = "1999,3000000000,1.5,2024-02-01 10:00:00,false,A-7,"
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    out = readers.csv_widened(spark, str(tmp_path / "a.csv"))
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "bigint", "double", "timestamp", "boolean", "string", "string"]
    assert out.count() == 2000 and out.filter("d = 1.5 AND l = 3000000000 AND s = 'A-7'").count() == 1
    assert out.filter("i IS NULL OR l IS NULL OR d IS NULL OR t IS NULL OR b IS NULL OR s IS NULL").count() == 0


def test_widening_keeps_numbers_with_letters_as_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y,z\n1d,1e3,-.5\n2f,7,+4\n")
    out = readers.csv_widened(spark, str(tmp_path / "a.csv"))
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "double", "double"]
