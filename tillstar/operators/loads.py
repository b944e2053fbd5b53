"""Staging and warehouse loads on Parquet, with checks before the write and one commit after it.

A warehouse is a tree ``<table>/run=<folder>/...`` and a commit log. Every load writes to folders of its own and becomes
visible by its last step, one commit. Readers scan the folders of the commits in force as one table, so a year's filter
prunes all loads alike.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.operators import commits, quality
from tillstar.operators.cleaning import REASON
from tillstar.operators.commits import Commit
from tillstar.operators.dedupe import keep_one
from tillstar.operators.enrich import lookup
from tillstar.operators.normalise import conform, dimensions_of, sales_rows
from tillstar.plans.star import LoadedStar
from tillstar.schema import PRIMARY_KEYS, REFERENCES, star_schema
from tillstar.session import file_system, materialised, remove, scratch_path

DIMENSIONS = ("product", "customer", "store", "supplier", "date")
_USABLE, _REJECT = "usable", "reject"


class ConcurrentLoad(RuntimeError):
    """Another load has taken in the same batches of a source meanwhile."""


def insert_ignore(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` plus one row per key of ``new`` that it does not have yet."""
    new = new.select(*existing.columns)
    fresh = keep_one(new, keys).select(*existing.columns).join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def load_staging(df: DataFrame, path: str, keys: Sequence[str], required: Sequence[str] = ()) -> None:
    """Write a staging table, or nothing at all: refused on duplicate keys, broken rules or an existing target.

    The rows are materialised first, so that parsing and cleaning run once and not again for every check.
    """
    df = materialised(df, "staging")
    quality.require_clean({
        "key": quality.unique(df, keys),
        "rows": quality.row_violations(df, quality.table_rules(df.columns, required or df.columns)),
    })
    df.write.mode("errorifexists").parquet(path)


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# -- writing ------------------------------------------------------------------------------------------------------------


def _new_folder() -> str:
    """A folder name no other load has, so that loads at the same time do not touch each other's files."""
    return f"r-{uuid.uuid4().hex}"


def _write_all(star: Mapping[str, DataFrame], root: str, folder: str) -> None:
    """Write independent tables at the same time: small ones leave executors idle when written one by one."""
    with ThreadPoolExecutor(len(star)) as pool:
        list(pool.map(lambda t: t[1].write.mode("overwrite").parquet(f"{root}/{t[0]}/run={folder}"), star.items()))


def _write_fact(rows: DataFrame, root: str, folder: str) -> None:
    """Write sales, and rejects beside them, in one pass.

    The rebalance lets Spark size the output files and split a year that is larger than the others.
    """
    if _USABLE not in rows.columns:
        rows = rows.withColumn(_USABLE, F.lit(True))
    rows = rows.withColumn(_USABLE, F.col(_USABLE).cast("string")).hint("rebalance", _USABLE, "year_t")
    rows.write.mode("overwrite").partitionBy(_USABLE, "year_t").parquet(f"{root}/sales/run={folder}")


def _read(spark: SparkSession, root: str, folders: Sequence[str], name: str) -> DataFrame:
    """A table's rows in these folders, as one scan."""
    fields = star_schema(name)
    if not folders:
        return spark.createDataFrame([], fields)
    inner = f"/{_USABLE}=true" if name == "sales" else ""
    paths = [path for folder in folders if _exists(spark, path := f"{root}/{name}/run={folder}{inner}")]
    if not paths:
        return spark.createDataFrame([], fields)
    found = T.StructType([*fields, T.StructField("run", T.StringType())])
    return spark.read.schema(found).option("basePath", f"{root}/{name}").parquet(*paths).select(*fields.fieldNames())


def _exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def _tables(spark: SparkSession, root: str, log: Sequence[Commit]) -> dict[str, DataFrame]:
    dimensions = [c.dimensions for c in log]
    tables = {name: _read(spark, root, dimensions, name) for name in DIMENSIONS}
    return tables | {"sales": _read(spark, root, [c.folder for c in log], "sales")}


def _ranges(rows: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """The least and the greatest value of each column, in one pass."""
    found = rows.agg(*[f(c).alias(f"{c}_{i}") for c in columns for i, f in enumerate((F.min, F.max))]).first()
    return {c: (found[f"{c}_0"], found[f"{c}_1"]) for c in columns}


def _near(stored: DataFrame, column: str, range_: tuple) -> DataFrame:
    """The stored rows in the range that new rows have in a key column.

    The range reaches the Parquet scan, where statistics skip what other loads wrote for other ranges; the cost of a
    check then follows the new rows where keys rise with time.
    """
    low, high = range_
    return stored.filter(F.lit(False) if low is None else F.col(column).between(F.lit(low), F.lit(high)))


def _missing(rows: DataFrame, stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows whose key is not stored."""
    near = _near(stored, key[0], _ranges(rows, key[:1])[key[0]])
    return rows.join(near.select(*key), list(key), "left_anti").select(*rows.columns)


def _settle(spark: SparkSession, root: str, log: Sequence[Commit], folder: str, own: Callable[[], Mapping[str, DataFrame]],
            sales_key: Sequence[str], check: bool) -> str:
    """Write the dimension rows that the commits in ``log`` lack and check the new rows against them; the rows' folder."""
    dimensions, there, new = _new_folder(), _tables(spark, root, log), own()
    if log:
        with ThreadPoolExecutor(len(new)) as pool:
            new = dict(pool.map(lambda t: (t[0], _missing(t[1], there[t[0]], PRIMARY_KEYS[t[0]])), new.items()))
    _write_all(new, root, dimensions)
    if not check:
        return dimensions
    rows = _tables(spark, root, [Commit(0, folder, dimensions, 0, {}, None)])
    checks = quality.check_star(rows, sales_key)
    if log:  # what was there is checked already; new sales may use its dimensions, and repeat none of its keys
        ranges = _ranges(rows["sales"], [*REFERENCES, *sales_key[:1]])
        for key, parent in REFERENCES.items():
            known = rows[parent].unionByName(_near(there[parent], PRIMARY_KEYS[parent][0], ranges[key]))
            checks[f"sales.{key}"] = quality.foreign_key(rows["sales"], known, key, PRIMARY_KEYS[parent][0])
        if sales_key:
            stored = _near(there["sales"], sales_key[0], ranges[sales_key[0]])
            checks["sales.key_there"] = quality.already_there(rows["sales"], stored, sales_key)
    quality.require_clean(checks)
    return dimensions


def _commit(spark: SparkSession, root: str, folder: str, base: int | None, own: Callable[[], Mapping[str, DataFrame]],
            sales_key: Sequence[str], check: bool, sources: Mapping[str, int], after: Mapping[str, int | None] | None = None,
            rejects: str | None = None) -> int:
    """Settle and commit what ``folder`` holds, again and again until no other load comes in between; the run number.

    ``base`` is the last run that a whole load replaces, None for an increment. ``after`` are the offsets that an
    increment starts from: if another load has moved them, its batches are there already.
    """
    while True:
        log = commits.history(spark, root)
        kept = [c for c in commits.visible(log) if base is None or c.run > base]
        for source, seen in (after or {}).items():
            if commits.offset(kept, source) != seen:
                raise ConcurrentLoad(f"{source} is loaded up to {commits.offset(kept, source)}, not {seen}")
        dimensions = _settle(spark, root, kept, folder, own, sales_key, check)
        run = max((c.run for c in log), default=0) + 1
        if commits.claim(spark, root, Commit(run, folder, dimensions, base or 0, dict(sources), rejects)):
            return run


def _newest(spark: SparkSession, root: str) -> int:
    return max((c.run for c in commits.history(spark, root)), default=0)


def _key(sales_key: Sequence[str] | None, grain: str) -> Sequence[str]:
    """The columns that must be unique in the sales: the order at order grain. Lines have no key unless one is named."""
    return sales_key if sales_key is not None else ("order_id",) if grain == "order" else ()


def load_warehouse(star: Mapping[str, DataFrame], root: str, sales_key: Sequence[str] = ("order_id",),
                   check: bool = True, sources: Mapping[str, int] | None = None) -> int:
    """Write all tables of a star as one run, check what was written and commit it; returns the run number.

    The run replaces all that was committed when it began. A load that dies or breaks a constraint leaves the previous
    runs in force. Of loads at the same time, the later one checks its keys against the earlier one's rows, adds only
    dimension rows that are not there, and both are in force. ``sources`` are the last batches it holds, by source.
    """
    spark, base = star["sales"].sparkSession, _newest(star["sales"].sparkSession, root)
    folder = _new_folder()
    _write_fact(conform(star["sales"], "sales"), root, folder)
    own = {name: conform(star[name], name) for name in DIMENSIONS}
    return _commit(spark, root, folder, base, lambda: own, sales_key, check, sources or {})


def load_increment(star: Mapping[str, DataFrame], root: str, sales_key: Sequence[str] = (), check: bool = True,
                   sources: Mapping[str, int] | None = None, after: Mapping[str, int | None] | None = None) -> int:
    """Add sales, and the dimension rows whose keys are not there yet, to the warehouse; returns the run number.

    Only new rows are written, and nothing stored is read beyond the keys in the new rows' range. A sale whose
    ``sales_key`` is stored already, or comes twice, is refused with the whole increment. ``sources`` are the last batches
    it brings in and ``after`` the batches they follow, by source; batches that another load brought in are refused too.
    """
    spark, folder = star["sales"].sparkSession, _new_folder()
    _write_fact(conform(star["sales"], "sales"), root, folder)
    scratch = scratch_path(spark, "increment")
    try:  # kept apart, so that they are computed once however often the commit is tried
        _write_all({name: conform(star[name], name) for name in DIMENSIONS}, scratch, "own")
        own = {name: _read(spark, scratch, ["own"], name) for name in DIMENSIONS}
        return _commit(spark, root, folder, None, lambda: own, sales_key, check, sources or {}, after)
    finally:
        remove(spark, scratch)


def load_transactions(transactions: DataFrame, products: DataFrame, customers: DataFrame, root: str,
                      grain: str = "line", sequence: Sequence[str] = ("order_ts",),
                      sales_key: Sequence[str] | None = None, check: bool = True) -> int:
    """Enrich transactions and load the star they form; returns the run number.

    The transactions are joined once and written once: sales, and beside them, by a partition column, the transactions
    that found no master row, with their reason (``read_rejects``). The dimensions are the master rows that the written
    fact uses, found through its id columns alone. Checks and commit are those of ``load_warehouse``; ``sales_key`` names
    the sales' unique columns (default: the order at order grain). At order grain the joined rows are staged for the time
    of the load, as orders are brought together by their last usable line.
    """
    spark, base = transactions.sparkSession, _newest(transactions.sparkSession, root)
    folder, staged = _new_folder(), scratch_path(transactions.sparkSession, "enriched")
    rows = lookup(transactions, products, customers)
    own = [c for c in transactions.columns if c != REASON]
    usable, reject = F.col(REASON).isNull(), F.struct(*own, REASON)
    try:
        if grain == "line":
            rows = rows.withColumns({_USABLE: usable, _REJECT: F.when(~usable, reject)})
            fact = sales_rows(rows, grain, sequence, (_USABLE, _REJECT))
        else:  # staged without the names and prices of the masters, which the fact does not carry
            kept = [f.name for f in star_schema("sales").fields if f.name in rows.columns]
            rows = rows.select(*dict.fromkeys([*kept, *sequence, *transactions.columns, REASON]))
            rows.write.parquet(staged)
            rows = spark.read.schema(rows.schema).parquet(staged)
            fact = sales_rows(rows.filter(usable), grain, sequence).withColumn(_USABLE, F.lit(True))
            refused = rows.filter(~usable).select(reject.alias(_REJECT), F.lit(False).alias(_USABLE))
            fact = fact.unionByName(refused, allowMissingColumns=True)
        _write_fact(fact, root, folder)
    finally:
        remove(spark, staged)
    written = _read(spark, root, [folder], "sales")
    return _commit(spark, root, folder, base, lambda: dimensions_of(written, products, customers), _key(sales_key, grain),
                   check, {}, rejects=fact.schema[_REJECT].dataType.json())


# -- reading ------------------------------------------------------------------------------------------------------------


def _in_force(spark: SparkSession, root: str, run: int | None = None) -> list[Commit]:
    log = commits.visible(commits.history(spark, root), run)
    if not log:
        raise FileNotFoundError(f"no committed load under {root}")
    return log


def read_warehouse(spark: SparkSession, root: str, run: int | None = None) -> LoadedStar:
    """The star of all commits in force, or as it was after an earlier ``run`` that has not expired."""
    return LoadedStar(**_tables(spark, root, _in_force(spark, root, run)))


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """The transactions that found no master row, with the reason, of all commits in force that kept any."""
    out = None
    for commit in _in_force(spark, root):
        if commit.rejects is None:
            continue
        fields = T.StructType.fromJson(json.loads(commit.rejects))
        path = f"{root}/sales/run={commit.folder}/{_USABLE}=false"
        rows = spark.createDataFrame([], T.StructType([T.StructField(_REJECT, fields)]))
        if _exists(spark, path):
            rows = spark.read.schema(rows.schema).parquet(path)
        rows = rows.select(f"{_REJECT}.*")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no load under {root} kept rejects")
    return out


def loaded_upto(spark: SparkSession, root: str, source: str) -> int | None:
    """The number of a source's last batch that is in the warehouse; None when no load in force named one."""
    return commits.offset(commits.visible(commits.history(spark, root)), source)


def expire(spark: SparkSession, root: str, keep: timedelta = timedelta(days=7)) -> list[str]:
    """Delete what no reader needs any more and return the paths.

    That is: runs replaced longer than ``keep`` ago, with their commits, and folders as old that no commit names, which
    failed or retried loads leave. ``keep`` must exceed the longest query and the longest load. Readers of what is in
    force are never touched.
    """
    log, before = commits.history(spark, root), (time.time() - keep.total_seconds()) * 1000
    alive = commits.visible(log)

    def changed(path: str) -> int:
        fs, target = file_system(spark, path)
        return fs.getFileStatus(target).getModificationTime()

    written = {c.run: changed(commits.path(root, c.run)) for c in log if c.replaces}
    dead = [c for c in log if c not in alive and min(written[d.run] for d in log if d.replaces >= c.run) < before]
    gone = {name for c in dead for name in (c.folder, c.dimensions)}
    named = {name for c in log for name in (c.folder, c.dimensions)}
    out = []
    for table in ("sales", *DIMENSIONS):
        fs, target = file_system(spark, f"{root}/{table}")
        for status in fs.listStatus(target) if fs.exists(target) else []:
            name = status.getPath().getName().removeprefix("run=")
            if name in gone or (name not in named and status.getModificationTime() < before):
                out.append(f"{root}/{table}/run={name}")
    out += [commits.path(root, c.run) for c in dead]  # last, so that a broken run of this is taken up again
    for path in out:
        remove(spark, path)
    return out


# -- batches of a stream ----------------------------------------------------------------------------------------------------


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write one micro-batch to a folder of its own; running the batch again replaces it."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches written so far, with their ``batch_id``."""
    return spark.read.option("basePath", path).parquet(path).withColumn(
        "batch_id", F.col("batch_id").cast("bigint")
    )
