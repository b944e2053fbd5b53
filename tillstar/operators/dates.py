"""Calendar columns of the date dimension and date-range filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Each calendar column as an expression over a DATE column.
PARTS = {
    "weekend": lambda d: F.weekday(d) >= 5,
    "half_of_year": lambda d: F.when(F.month(d) <= 6, F.lit(1)).otherwise(F.lit(2)),
    "month_t": lambda d: F.month(d),
    "quarter_t": lambda d: F.quarter(d),
    "year_t": lambda d: F.year(d),
    "season": lambda d: season(F.month(d)),
}
# The columns of the date dimension.
CALENDAR = ("weekend", "half_of_year", "month_t", "quarter_t", "year_t")


def add_date_parts(df: DataFrame, date_col: str = "date_t", parts=CALENDAR) -> DataFrame:
    """Add the named calendar columns, derived from ``date_col`` in place (no join, no shuffle)."""
    return df.withColumns({p: PARTS[p](F.col(date_col)) for p in parts})


def in_year(date_col: str, year: int) -> Column:
    """``date_col`` lies in ``year``, as a half-open range so that it reaches the Parquet scan."""
    d = F.col(date_col)
    return (d >= F.lit(date(year, 1, 1))) & (d < F.lit(date(year + 1, 1, 1)))


def time_text(ts: Column | str) -> Column:
    """Time of day as ``HH:mm:ss``. Cut from the printed timestamp, so no time zone can shift it."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.substring(c.cast("string"), 12, 8)


def date_dimension(orders: DataFrame, key: str = "order_id", ts: str = "order_ts") -> DataFrame:
    """One date row per order: the key of the row is the order's own id."""
    base = orders.select(
        F.col(key).alias("time_id"),
        F.to_date(ts).alias("date_t"),
        time_text(ts).alias("time_t"),
    )
    return add_date_parts(base)


def sale_type(weekend: Column | str = "weekend") -> Column:
    w = F.col(weekend) if isinstance(weekend, str) else weekend
    return F.when(w, F.lit("Weekend")).otherwise(F.lit("Weekday"))


def season(month: Column | str = "month_t") -> Column:
    """Meteorological season of a month number."""
    m = F.col(month) if isinstance(month, str) else month
    return (
        F.when(m.isin(3, 4, 5), "Spring")
        .when(m.isin(6, 7, 8), "Summer")
        .when(m.isin(9, 10, 11), "Fall")
        .when(m.isin(12, 1, 2), "Winter")
    )
