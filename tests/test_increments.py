"""Warehouses that grow by increments, from several sources and several loads at once, and what they leave behind."""

import datetime
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from test_loads import RAW, good, masters, run_stream, write_files

from tillstar.operators import commits, loads, normalise, quality
from tillstar.operators.commits import Commit
from tillstar.plans import reports
from tillstar.sources import files
from tillstar.streaming import transactions as stream

TABLES = (*loads.DIMENSIONS, "sales")


def rows_of(star):
    return {name: sorted(map(str, getattr(star, name).collect())) for name in TABLES}


def stream_of(spark, tmp_path, groups):
    for name, rows in groups.items():
        write_files(tmp_path / "in", {name: rows})
        run_stream(spark, tmp_path)
    return str(tmp_path / "out")


LINES = {
    "a.csv": [("1", "2019-01-05 10:00:00", "1", "2", "1", ""), ("2", "2019-02-04 09:30:00", "2", "3", "2", "")],
    "b.csv": [("1", "2020-01-05 11:00:00", "2", "1", "1", ""), ("3", "2020-02-04 09:30:00", "1", "3", "2", "")],
    "c.csv": [("4", "2019-06-30 10:00:00", "2", "4", "1", ""), ("5", "2021-02-04 09:30:00", "9", "3", "2", "")],
}


def test_increments_equal_one_load(spark, tmp_path):
    out = stream_of(spark, tmp_path, LINES)
    root, whole = str(tmp_path / "dw"), str(tmp_path / "whole")
    assert [stream.load_new(spark, out, root, upto=b) for b in (0, 1, 2)] == [1, 2, 3]
    assert stream.load_new(spark, out, root) is None
    assert stream.load(spark, [out], whole, "line", sales_key=()) == 1
    one, other = (loads.read_warehouse(spark, r) for r in (root, whole))
    dates = [sorted(r.time_id for r in s.date.collect()) for s in (one, other)]
    assert dates == [[1, 2, 3, 4]] * 2
    parts = [{k: v for k, v in rows_of(s).items() if k != "date"} for s in (one, other)]
    assert parts[0] == parts[1] and len(parts[0]["sales"]) == 5
    # a year reaches the scan of all runs as a partition filter, in one scan
    plan = reports.top_products(one, 2020)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(year_t") == 1 and "Union" not in plan
    assert [tuple(r) for r in reports.half_year_split(one, year=2020).collect()] == [
        tuple(r) for r in reports.half_year_split(other, year=2020).collect()]


def test_more_increments_after_a_whole_load(spark, tmp_path):
    out = stream_of(spark, tmp_path, {"a.csv": LINES["a.csv"]})
    root = str(tmp_path / "dw")
    stream.load_new(spark, out, root)
    stream.load(spark, [out], root, "line", sales_key=())
    assert stream.load_new(spark, out, root) is None
    stream_of(spark, tmp_path, {"b.csv": LINES["b.csv"]})
    assert stream.load_new(spark, out, root) == 3
    assert loads.read_warehouse(spark, root).sales.count() == 4
    assert loads.read_warehouse(spark, root, run=2).sales.count() == 2


def test_each_source_has_its_own_offset(spark, tmp_path):
    out = stream_of(spark, tmp_path, LINES)
    root, again = str(tmp_path / "dw"), str(tmp_path / "again")
    stream.load_new(spark, out, root)
    products, customers = masters(spark)
    late = products.filter("product_id = 1").withColumn("product_id", F.lit(9).cast("bigint"))
    stream.replay(spark, out, lambda: (products.unionByName(late), customers), again)
    assert stream.load_new(spark, again + "/", root) == 2  # its batch 0, though the stream's batch 0 is there
    assert stream.load_new(spark, again, root) is None and stream.load_new(spark, out, root) is None
    assert sorted(r.order_id for r in loads.read_warehouse(spark, root).sales.collect()) == [1, 1, 2, 3, 4, 5]
    assert loads.loaded_upto(spark, root, out) == 2 and loads.loaded_upto(spark, root, again) == 0
    assert loads.loaded_upto(spark, root, "elsewhere") is None


def test_a_repeated_line_is_refused(spark, tmp_path):
    out = stream_of(spark, tmp_path, LINES)
    root, key = str(tmp_path / "dw"), ("order_id", "product_id")
    stream.load_new(spark, out, root, sales_key=key)
    before = rows_of(loads.read_warehouse(spark, root))
    copy = str(tmp_path / "copy")
    rows = stream.accepted(spark, out).drop("generation", "batch_id").filter("order_id = 3").withColumns({
        "matched": F.lit("true"), "reject_reason": F.lit(None).cast("string"), "raw": F.lit(None).cast("string")})
    loads.write_batch(rows, copy, 0, ["matched"])
    with pytest.raises(quality.ConstraintError) as e:
        stream.load_new(spark, copy, root, sales_key=key)
    assert e.value.report == {"sales.key_there": 1}
    assert rows_of(loads.read_warehouse(spark, root)) == before
    loads.write_batch(rows.union(rows).withColumn("order_id", F.lit(77).cast("bigint")), copy, 0, ["matched"])
    with pytest.raises(quality.ConstraintError) as e:
        stream.load_new(spark, copy, root, sales_key=key)
    assert e.value.report == {"sales.key": 1}


def test_an_increment_needs_its_dimensions(spark, tmp_path):
    out = stream_of(spark, tmp_path, LINES)
    root = str(tmp_path / "dw")
    stream.load_new(spark, out, root, upto=0)
    star = normalise.to_star(stream.accepted(spark, out).filter("batch_id > 0"))
    star["store"] = star["store"].filter("false")
    loads.load_increment(star, root)  # the stores are there from before
    star["sales"] = star["sales"].withColumn("store_id", F.lit(99))
    with pytest.raises(quality.ConstraintError) as e:
        loads.load_increment(star, root)
    assert e.value.report == {"sales.store_id": 1}


def test_only_one_load_gets_a_number(spark, tmp_path):
    root = str(tmp_path / "dw")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: commits.claim(spark, root, Commit(1, f"f{i}", "d", 0, {"s": i}, None)), range(8)))
    assert sum(got) == 1
    (commit,) = commits.history(spark, root)
    assert commit.folder == f"f{got.index(True)}" and commit.sources == {"s": got.index(True)}
    assert [f for f in os.listdir(f"{root}/commits") if not f.endswith(".crc")] == ["000000000001.json"]


def test_what_is_in_force():
    def log(*replaces):
        return [Commit(i, "", "", r, {}, None) for i, r in enumerate(replaces, 1)]

    def runs(found):
        return [c.run for c in found]

    assert runs(commits.visible(log(0, 0, 0))) == [1, 2, 3]
    assert runs(commits.visible(log(0, 0, 2))) == [3]
    assert runs(commits.visible(log(0, 0, 1))) == [2, 3]  # the whole load did not know the second run
    assert runs(commits.visible(log(0, 0, 2, 0, 1))) == [3, 4, 5]
    assert runs(commits.visible(log(0, 0, 2), run=2)) == [1, 2]
    assert commits.visible([]) == [] and commits.offset([], "s") is None


def test_increments_at_the_same_time(spark, tmp_path):
    """Two sources at once: both arrive. One source twice at once: its batches arrive once."""
    out = stream_of(spark, tmp_path, LINES)
    other = str(tmp_path / "other")
    rows = stream.accepted(spark, out).drop("generation", "batch_id").withColumns({
        "order_id": F.col("order_id") + 100, "matched": F.lit("true"), "reject_reason": F.lit(None).cast("string"),
        "raw": F.lit(None).cast("string")})
    loads.write_batch(rows, other, 0, ["matched"])
    root = str(tmp_path / "dw")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda path: stream.load_new(spark, path, root, sales_key=("order_id", "product_id")),
                      [out, other, out, other]))
    star = loads.read_warehouse(spark, root)
    assert sorted(r.order_id for r in star.sales.collect()) == [1, 1, 2, 3, 4, 101, 101, 102, 103, 104]
    for name in loads.DIMENSIONS:
        ids = [r[0] for r in getattr(star, name).collect()]
        assert len(ids) == len(set(ids)), name
    assert len(commits.history(spark, root)) == 2


def test_a_whole_load_beside_an_increment(spark, tmp_path, monkeypatch):
    """An increment that is committed while a whole load runs stays; keys that both have are refused."""
    out = stream_of(spark, tmp_path, LINES)
    root = str(tmp_path / "dw")
    rows = stream.accepted(spark, out)
    stream_rows = normalise.to_star(rows.filter("order_id < 3"))
    loads.load_warehouse(stream_rows, root, sales_key=())
    claim, meanwhile = commits.claim, []

    def late(spark_, root_, commit):
        if not meanwhile:
            meanwhile.append(True)
            loads.load_increment(normalise.to_star(rows.filter("order_id = 4")), root)
        return claim(spark_, root_, commit)

    monkeypatch.setattr(loads.commits, "claim", late)
    assert loads.load_warehouse(normalise.to_star(rows.filter("order_id = 3")), root, sales_key=()) == 3
    assert sorted(r.order_id for r in loads.read_warehouse(spark, root).sales.collect()) == [3, 4]
    meanwhile.clear()
    with pytest.raises(quality.ConstraintError) as e:
        loads.load_warehouse(normalise.to_star(rows.filter("order_id = 4")), root)
    assert e.value.report == {"sales.key_there": 1}


def test_rejects_stay_with_their_run(spark, tmp_path):
    root = str(tmp_path / "dw")
    loads.load_transactions(good(spark), *masters(spark), root)
    stored = sorted(r.order_id for r in loads.read_rejects(spark, root).collect())
    assert stored == [3, 4, 7]
    star = normalise.to_star(stream.process(files.read_transactions(spark, write(tmp_path, [RAW[2]])), *masters(spark)))
    loads.load_increment(star, root)
    assert sorted(r.order_id for r in loads.read_rejects(spark, root).collect()) == stored
    assert loads.read_rejects(spark, root).columns == [*good(spark).columns, "reject_reason"]
    products, customers = masters(spark)
    every = good(spark).select("product_id").distinct().crossJoin(products.filter("product_id = 1").drop("product_id"))
    people = good(spark).select("customer_id").distinct().selectExpr("customer_id", "'x' customer_name", "'Male' gender")
    loads.load_transactions(good(spark), every.select(products.columns), people, root, "order")
    assert loads.read_rejects(spark, root).collect() == [] and loads.read_warehouse(spark, root).sales.count() == 5


def write(tmp_path, rows):
    write_files(tmp_path / "one", {"x.csv": rows})
    return str(tmp_path / "one")


def test_replaced_runs_expire(spark, tmp_path):
    root = str(tmp_path / "dw")
    out = stream_of(spark, tmp_path, LINES)
    for b in (0, 1):
        stream.load_new(spark, out, root, upto=b)
    old = loads.read_warehouse(spark, root)
    assert loads.expire(spark, root, datetime.timedelta(0)) == []  # both runs are in force
    stream.load(spark, [out], root, "line", sales_key=())
    with pytest.raises(quality.ConstraintError):  # leaves a folder that no commit names
        stream.load(spark, [out], root, "line", sales_key=("order_id",))
    reader = loads.read_warehouse(spark, root)
    before = rows_of(reader)
    assert loads.expire(spark, root) == [] and old.sales.count() == 4  # not old enough
    gone = loads.expire(spark, root, datetime.timedelta(0))
    assert sum("/sales/" in p for p in gone) == 3 and sum("/commits/" in p for p in gone) == 2
    assert rows_of(reader) == before == rows_of(loads.read_warehouse(spark, root))  # opened before, and after
    folders = [p.name for p in (tmp_path / "dw" / "sales").iterdir() if p.name.startswith("run=")]
    assert len(folders) == 1
    with pytest.raises(FileNotFoundError):
        loads.read_warehouse(spark, root, run=1)
    stream_of(spark, tmp_path, {"d.csv": [("9", "2019-06-30 10:00:00", "2", "4", "1", "")]})
    assert stream.load_new(spark, out, root) == 4  # numbers go on, offsets are kept
    assert loads.read_warehouse(spark, root).sales.count() == 6


def test_loads_leave_no_staged_copies(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = {n for n in os.listdir(shared) if n.startswith(("enriched", "increment"))}
    for grain in ("line", "order"):
        loads.load_transactions(good(spark), *masters(spark), str(tmp_path / grain), grain, check=False)
    loads.load_increment(normalise.to_star(stream.process(files.read_transactions(spark, write(tmp_path, [RAW[2]])),
                                                          *masters(spark))), str(tmp_path / "line"))
    assert {n for n in os.listdir(shared) if n.startswith(("enriched", "increment"))} == before


# -- streaming state ----------------------------------------------------------------------------------------------------------


def follow(spark, tmp_path, **options):
    query = stream.follow(spark, str(tmp_path / "out"), str(tmp_path / "changes"), str(tmp_path / "state"), **options)
    query.awaitTermination()
    return query


def last_lines(spark, tmp_path):
    rows = stream.state_of(spark, str(tmp_path / "state"))
    return sorted((r.order_id, r.product_id, r.quantity) for r in rows.collect())


def test_state_of_the_last_lines(spark, tmp_path):
    out = stream_of(spark, tmp_path, LINES)
    follow(spark, tmp_path)
    assert last_lines(spark, tmp_path) == [(1, 2, 1), (2, 2, 3), (3, 1, 3), (4, 2, 4)]
    latest = stream.latest_orders(spark, out)
    assert last_lines(spark, tmp_path) == sorted((r.order_id, r.product_id, r.quantity) for r in latest.collect())
    # three more batches that overwrite each other, an early line that comes late, and one line once more
    more = {"d.csv": [("1", "2020-03-01 10:00:00", "1", "7", "1", "")], "e.csv": [("1", "2020-04-01 10:00:00", "2", "8", "2", "")],
            "f.csv": [("1", "2020-03-15 10:00:00", "1", "9", "1", ""), ("2", "2019-02-04 09:30:00", "2", "3", "2", "")]}
    stream_of(spark, tmp_path, more)
    query = follow(spark, tmp_path, files_per_batch=1)
    assert last_lines(spark, tmp_path) == [(1, 2, 8), (2, 2, 3), (3, 1, 3), (4, 2, 4)]
    busy = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(busy) == 3 and sum(p["numInputRows"] for p in busy) == 4  # new lines only
    assert [p["stateOperators"][0]["numRowsUpdated"] for p in busy] == [p["numInputRows"] for p in busy]
    assert all(p["stateOperators"][0]["numRowsTotal"] == 4 for p in busy)
    changed = loads.read_batches(spark, str(tmp_path / "changes"))
    assert changed.filter("order_id = 4").count() == 1 and changed.filter("order_id = 1").count() == 4
    again = follow(spark, tmp_path)
    assert not any(p["numInputRows"] for p in again.recentProgress)


def test_state_survives_a_repeated_batch(spark, tmp_path):
    out = stream_of(spark, tmp_path, LINES)
    follow(spark, tmp_path)
    before = last_lines(spark, tmp_path)
    rows = spark.read.option("basePath", out).parquet(f"{out}/batch_id=1").drop("batch_id").collect()
    schema = spark.read.option("basePath", out).parquet(f"{out}/batch_id=1").drop("batch_id").schema
    loads.write_batch(spark.createDataFrame(rows, schema), out, 1, ["matched"])
    follow(spark, tmp_path)
    assert last_lines(spark, tmp_path) == before
