"""Work that grows with the tables: the number of micro-batches, the size of tasks, what is sorted and staged."""

import datetime
import glob

from pyspark.sql import functions as F
from test_loads import good, masters

from tillstar.operators import dedupe, loads
from tillstar.plans import queries
from tillstar.session import CLEANUP, configure, shared_dir
from tillstar.streaming import transactions as stream


def test_state_batches_do_not_follow_the_files(spark, tmp_path):
    out, rows = str(tmp_path / "out"), []
    for i in range(10):
        rows.append((i % 3, datetime.datetime(2020, 1, 1 + i), i))
        line = spark.createDataFrame(rows[-1:], "order_id bigint, order_ts timestamp_ntz, quantity int").withColumns(
            {"matched": F.lit("true"), "reject_reason": F.lit(None).cast("string"), "raw": F.lit(None).cast("string")})
        loads.write_batch(line.coalesce(1), out, i, ["matched"])
    share = stream.share_of_files(spark, out, 4)
    assert share == 3
    query = stream.follow(spark, out, str(tmp_path / "changes"), str(tmp_path / "state"), files_per_batch=share)
    query.awaitTermination()
    batches = loads.read_batches(spark, str(tmp_path / "changes")).select("batch_id").distinct().count()
    assert 2 <= batches <= 4
    got = sorted((r.order_id, r.quantity) for r in stream.state_of(spark, str(tmp_path / "state")).collect())
    assert got == [(0, 9), (1, 7), (2, 8)]


def test_tasks_do_not_grow_with_the_tables(spark):
    """Shuffled data of 40 MB, of which Spark's defaults would make one task a core, goes to tasks of at most 16 MB."""
    configure(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        df = spark.range(2_000_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"))
        df = df.coalesce(2).repartition("id").select(F.spark_partition_id().alias("p"), F.length("t").alias("n"))
        most = df.groupBy("p").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert most <= 17e6
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "32m"
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_least_of_one_column_needs_no_sort(spark):
    day = datetime.datetime(2020, 1, 1)
    rows = [(1, day), (1, day + datetime.timedelta(1)), (2, None), (2, day), (None, day), (3, None)]
    df = spark.createDataFrame(rows, "order_id bigint, order_ts timestamp_ntz").repartition(3)
    one = dedupe.keep_one(df, ["order_id"])
    assert "Sort" not in one._jdf.queryExecution().executedPlan().toString()
    assert {(r.order_id, r.order_ts) for r in one.collect()} == {(1, day), (2, None), (None, day), (3, None)}


def test_staged_rows_carry_no_names(spark, tmp_path, monkeypatch):
    seen, remove = [], loads.remove

    def look(session, path):
        if "enriched" in path:
            seen.append(session.read.parquet(path).columns)
        return remove(session, path)

    monkeypatch.setattr(loads, "remove", look)
    loads.load_transactions(good(spark), *masters(spark), str(tmp_path / "dw"), "order")
    assert len(seen) == 1 and not {"product_name", "supplier_name", "store_name", "customer_name", "price"} & set(seen[0])
    assert loads.read_rejects(spark, str(tmp_path / "dw")).count() == 3


def shuffled(spark):
    """The shuffle files that are on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_stream_leaves_no_shuffles_and_small_files(spark, tmp_path):
    """Each micro-batch's shuffle goes when it ends, that of the state as well as that of the lookups."""
    rows = [(i % 7, datetime.datetime(2020, 1, 1 + i % 20), i) for i in range(60)]
    out, setting = str(tmp_path / "out"), spark.conf.get(CLEANUP, None)
    for i in range(3):
        lines = spark.createDataFrame(rows[i::3], "order_id bigint, order_ts timestamp_ntz, quantity int").withColumns(
            {"matched": F.lit("true"), "reject_reason": F.lit(None).cast("string"), "raw": F.lit(None).cast("string")})
        loads.write_batch(lines.coalesce(1), out, i, ["matched"])
    before = shuffled(spark)
    stream.follow(spark, out, str(tmp_path / "changes"), str(tmp_path / "state"), files_per_batch=1).awaitTermination()
    assert shuffled(spark) <= before
    got = {(r.order_id, r.order_ts, r.quantity) for r in stream.state_of(spark, str(tmp_path / "state")).collect()}
    assert got == {max((x for x in rows if x[0] == k), key=lambda x: x[1:]) for k in range(7)}
    assert spark.conf.get(CLEANUP, None) == setting
    files = glob.glob(f"{tmp_path}/*/batch_id=*/**/*.parquet", recursive=True)
    assert files and all(".zstd." in f for f in files)


def test_streamed_files_go_when_they_are_read(spark):
    shared = shared_dir(spark).removeprefix("file:")
    before, shuffles = set(glob.glob(f"{shared}/stream-*")), shuffled(spark)
    _, out = queries._streamed(spark, "/root/testdata/sf0.001")
    assert len(set(glob.glob(f"{shared}/stream-*")) - before) == 1
    assert glob.glob(f"{out}/batch_id=*") and not glob.glob(f"{out}/../in")
    assert shuffled(spark) <= shuffles
