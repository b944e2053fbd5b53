"""Field cleaning: text from CSV files to typed columns, with a reason for every row that cannot be used."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.schema import CORRUPT, PRICE, TIMESTAMP_SHAPE

ZERO_DATE = "0000-00-00"
REASON = "reject_reason"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: Column | str) -> Column:
    return F.trim(_col(c))


def integer(c: Column | str, kind: str = "int") -> Column:
    """Trimmed whole number; NULL when the text is not one."""
    t = F.trim(_col(c))
    return F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast(kind))


def money(c: Column | str, kind=PRICE) -> Column:
    """Currency text such as ``1299.99$`` or ``$ 1,299.99`` to a decimal; NULL when it is anything else.

    Digits may be grouped by commas, have one dot, and a currency sign before or after. A minus of any kind, brackets
    and words are not stripped: such a text is no price.
    """
    t = F.trim(_col(c))
    shape = r"^\p{Sc}?\s*([0-9]+|[0-9]{1,3}(,[0-9]{3})+)?(\.[0-9]*)?\s*\p{Sc}?$"
    return F.when(t.rlike(shape), F.regexp_replace(t, r"[^0-9.]", "").try_cast(kind))


def timestamp(c: Column | str, zero_date: str = "null") -> Column:
    """Strict parse of ``yyyy-MM-dd HH:mm:ss``; NULL when the text is no valid date. No time zone is involved.

    ``zero_date`` says what an all-zero date becomes: ``null``, ``round`` (the first of January of year 1) or
    ``error``.
    """
    t = F.trim(_col(c))
    parsed = F.when(t.rlike(TIMESTAMP_SHAPE), t.try_cast("timestamp_ntz"))
    is_zero = t.startswith(ZERO_DATE)
    if zero_date == "null":
        return F.when(~is_zero, parsed)
    if zero_date == "round":
        return F.when(is_zero, F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")).otherwise(parsed)
    if zero_date == "error":
        return F.when(is_zero, F.raise_error(F.concat(F.lit("zero date: "), t)).cast("timestamp_ntz")).otherwise(parsed)
    raise ValueError(f"zero_date must be null, round or error, not {zero_date!r}")


def repair_fields(line: Column | str, width: int, glued: int, sep: str = ",") -> Column:
    """Split an unquoted line into ``width`` fields, gluing surplus fields back together at position ``glued``.

    A separator inside the text of field ``glued`` (0-based) makes the line longer than ``width``; the surplus
    fields are joined with the separator again. A line that is too short gives NULL.
    """
    parts = F.split(_col(line), f"[{sep}]", -1)
    surplus = F.size(parts) - width
    middle = F.array_join(F.slice(parts, glued + 1, surplus + 1), sep)
    return F.when(
        surplus >= 0,
        F.transform(
            F.concat(F.slice(parts, 1, glued), F.array(middle), F.slice(parts, surplus + glued + 2, width - glued - 1)),
            lambda part: F.trim(part),
        ),
    )


def with_reject_reason(df: DataFrame, typed: Mapping[str, Column], required: Mapping[str, str]) -> DataFrame:
    """Replace the columns by their typed form and add the reason why a row is unusable (NULL when it is usable).

    ``required`` maps a typed column to the reason that applies when it is NULL; the first reason found wins.
    """
    malformed = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    raw = F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("raw")
    out = df.select(*[e.alias(n) for n, e in typed.items()], raw, malformed.alias("_malformed"))
    reason = F.when(F.col("_malformed"), F.lit("malformed row"))
    for name, why in required.items():
        reason = reason.when(F.col(name).isNull(), F.lit(why))
    # only a row that cannot be used carries its text into what follows
    return out.withColumn(REASON, reason).withColumn("raw", F.when(F.col(REASON).isNotNull(), F.col("raw"))).drop("_malformed")


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejected rows with their raw text and reason)."""
    good = df.filter(F.col(REASON).isNull()).drop(REASON, "raw")
    bad = df.filter(F.col(REASON).isNotNull()).select("raw", REASON)
    return good, bad


def clean_customers(raw: DataFrame) -> DataFrame:
    return with_reject_reason(
        raw,
        {
            "customer_id": integer("customer_id", "bigint"),
            "customer_name": text("customer_name"),
            "gender": F.nullif(text("gender"), F.lit("")),
        },
        {"customer_id": "bad customer_id", "customer_name": "no customer_name"},
    )


def clean_products(raw: DataFrame) -> DataFrame:
    return with_reject_reason(
        raw,
        {
            "product_id": integer("product_id", "bigint"),
            "product_name": text("product_name"),
            "price": money("price"),
            "supplier_id": integer("supplier_id", "bigint"),
            "supplier_name": text("supplier_name"),
            "store_id": integer("store_id", "bigint"),
            "store_name": text("store_name"),
        },
        {
            "product_id": "bad product_id",
            "product_name": "no product_name",
            "price": "bad price",
            "supplier_id": "bad supplier_id",
            "supplier_name": "no supplier_name",
            "store_id": "bad store_id",
            "store_name": "no store_name",
        },
    )


def clean_transactions(raw: DataFrame, zero_date: str = "null") -> DataFrame:
    return with_reject_reason(
        raw,
        {
            "order_id": integer("order_id", "bigint"),
            "order_ts": timestamp("order_date", zero_date=zero_date),
            "product_id": integer("product_id", "bigint"),
            "quantity": integer("quantity"),
            "customer_id": integer("customer_id", "bigint"),
        },
        {
            "order_id": "bad order_id",
            "order_ts": "bad order_date",
            "product_id": "bad product_id",
            "quantity": "bad quantity",
            "customer_id": "bad customer_id",
        },
    )
