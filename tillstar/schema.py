"""Explicit schemas of the raw files, the staging tables and the warehouse."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
REVENUE = T.DecimalType(15, 2)
TOTAL = T.DecimalType(25, 2)

TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
CORRUPT = "_corrupt_record"


def _text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Raw CSV files: every field is read as text and cast afterwards, so that a bad field rejects one row only.
RAW_CUSTOMERS = _text_schema("customer_id", "customer_name", "gender")
RAW_PRODUCTS = _text_schema(
    "product_id", "product_name", "price", "supplier_id", "supplier_name", "store_id", "store_name"
)
RAW_TRANSACTIONS = _text_schema("order_id", "order_date", "product_id", "quantity", "customer_id", "time_id")

# Source tables of the driver. Declared, so that opening a table starts no job to read a footer.
SOURCES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

GENDERS = ("Male", "Female")

# Declared text lengths and decimal shapes of the warehouse columns.
TEXT_LENGTHS = {
    "product_name": 255,
    "customer_name": 255,
    "store_name": 255,
    "supplier_name": 255,
    "gender": 10,
}
DECIMAL_SHAPES = {"price": (10, 2), "sales_revenue": (15, 2)}

# Keys, required columns and references of the star.
PRIMARY_KEYS = {
    "product": ["product_id"],
    "customer": ["customer_id"],
    "store": ["store_id"],
    "supplier": ["supplier_id"],
    "date": ["time_id"],
    "sales": ["order_id"],
}
REQUIRED = {
    "product": ["product_id", "product_name", "price"],
    "customer": ["customer_id", "customer_name"],
    "store": ["store_id", "store_name"],
    "supplier": ["supplier_id", "supplier_name"],
    "date": ["time_id", "date_t", "time_t", "weekend", "half_of_year", "month_t", "quarter_t", "year_t"],
    "sales": [
        "order_id", "product_id", "customer_id", "supplier_id", "time_id", "store_id", "quantity", "sales_revenue",
    ],
}
REFERENCES = {
    "product_id": "product",
    "customer_id": "customer",
    "supplier_id": "supplier",
    "time_id": "date",
    "store_id": "store",
}
# The written warehouse. The sales carry their time, so that reports need no join to the date table.
STAR = {
    "product": "product_id BIGINT, product_name STRING, price DECIMAL(10,2)",
    "customer": "customer_id BIGINT, customer_name STRING, gender STRING",
    "store": "store_id BIGINT, store_name STRING",
    "supplier": "supplier_id BIGINT, supplier_name STRING",
    "date": "time_id BIGINT, date_t DATE, time_t STRING, weekend BOOLEAN, half_of_year INT, month_t INT, "
    "quarter_t INT, year_t INT",
    "sales": "order_id BIGINT, product_id BIGINT, customer_id BIGINT, supplier_id BIGINT, time_id BIGINT, "
    "store_id BIGINT, quantity INT, sales_revenue DECIMAL(15,2), order_ts TIMESTAMP_NTZ, year_t INT",
}


def star_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(STAR[table])
