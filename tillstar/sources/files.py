"""CSV scans with an explicit schema. Columns are positional; a header line is skipped, its names are ignored.

A row with the wrong number of fields is not lost: its raw text lands in ``_corrupt_record``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar import schema
from tillstar.operators.cleaning import repair_fields
from tillstar.schema import CORRUPT

# Fields may be quoted; a doubled quote inside quotes is a literal quote.
CSV_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "quote": '"',
    "escape": '"',
}


def _with_corrupt(fields: T.StructType) -> T.StructType:
    return T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])


def read_csv(spark: SparkSession, path: str, fields: T.StructType, **options: str) -> DataFrame:
    return spark.read.schema(_with_corrupt(fields)).options(**{**CSV_OPTIONS, **options}).csv(path)


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schema.RAW_CUSTOMERS)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Product rows; an unquoted comma in the supplier name is repaired."""
    return repair_products(read_csv(spark, path, schema.RAW_PRODUCTS))


def repair_products(raw: DataFrame) -> DataFrame:
    names = schema.RAW_PRODUCTS.fieldNames()
    line = F.col(CORRUPT)
    fixed = F.when(
        line.isNotNull() & ~line.contains('"'), repair_fields(line, len(names), names.index("supplier_name"))
    )
    return (
        raw.withColumn("_fixed", fixed)
        .select(
            *[F.coalesce(F.get(F.col("_fixed"), F.lit(i)), F.col(n)).alias(n) for i, n in enumerate(names)],
            F.when(F.col("_fixed").isNull(), line).alias(CORRUPT),
        )
    )


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schema.RAW_TRANSACTIONS)


def stream_transactions(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """Transaction files as a stream, a bounded number of files per micro-batch."""
    return (
        spark.readStream.schema(_with_corrupt(schema.RAW_TRANSACTIONS))
        .options(**CSV_OPTIONS)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )


def load_file(spark: SparkSession, path: str, fields: T.StructType, target: str, name: str | None = None,
              **options: str) -> DataFrame:
    """Bulk-load a delimited file into a Parquet table and return a scan of the table.

    One pass writes the rows and, apart from them, the lines with a wrong number of fields (``rejected_lines``). Each
    load has a folder of its own, named after the path unless ``name`` is given, so loading a file again replaces it.
    """
    load = name or hashlib.sha256(path.encode()).hexdigest()[:16]
    rows = read_csv(spark, path, fields, **options).withColumn("malformed", F.col(CORRUPT).isNotNull())
    rows.write.mode("overwrite").partitionBy("malformed").parquet(f"{target}/load={load}")
    return _loaded(spark, fields, target).filter("not malformed").select(*fields.fieldNames())


def rejected_lines(spark: SparkSession, fields: T.StructType, target: str) -> DataFrame:
    """The malformed lines of all loads into a table."""
    return _loaded(spark, fields, target).filter("malformed").select("load", F.col(CORRUPT).alias("line"))


def _loaded(spark: SparkSession, fields: T.StructType, target: str) -> DataFrame:
    schema_ = _with_corrupt(fields).add("load", "string").add("malformed", "boolean")
    return spark.read.schema(schema_).option("basePath", target).parquet(target)
