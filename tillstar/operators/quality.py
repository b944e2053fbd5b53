"""Constraint checks. Each returns the violations with a ``rule`` column; an empty result means valid.

Key-level checks (unique, foreign key, conflicts) report one row per offending key with its row count, so that they
aggregate on the map side and a key that holds a third of all rows costs no more than any other. Row-level checks
(not null, check, length, decimal range) run in one pass over the rows and report each row once per broken rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar import schema


# -- key-level ------------------------------------------------------------------------------------------------------


def unique(df: DataFrame, keys: Sequence[str], rule: str | None = None) -> DataFrame:
    """Keys that occur more than once, and keys with a NULL part."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n_rows"))
        .filter((F.col("n_rows") > 1) | has_null)
        .select(F.lit(rule or f"unique({','.join(keys)})").alias("rule"), *keys, "n_rows")
    )


def foreign_key(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None, rule: str | None = None
) -> DataFrame:
    """Child keys without a parent, with the number of child rows; NULL child keys are allowed."""
    parent_key = parent_key or key
    used = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
    known = parent.select(F.col(parent_key).alias(key))
    return used.join(known, key, "left_anti").select(
        F.lit(rule or f"foreign_key({key})").alias("rule"), key, "n_rows"
    )


def already_there(new: DataFrame, stored: DataFrame, keys: Sequence[str], rule: str | None = None) -> DataFrame:
    """Keys of the new rows that a stored row has, with the number of new rows."""
    used = new.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return used.join(stored.select(*keys), list(keys), "left_semi").select(
        F.lit(rule or f"already_there({','.join(keys)})").alias("rule"), *keys, "n_rows")


def conflicts(df: DataFrame, keys: Sequence[str], attributes: Sequence[str], rule: str | None = None) -> DataFrame:
    """Keys that carry more than one set of attributes."""
    variants = df.groupBy(*keys, *attributes).agg(F.count("*").alias("_rows"))
    return (
        variants.groupBy(*keys)
        .agg(F.count("*").alias("n_variants"), F.sum("_rows").alias("n_rows"))
        .filter(F.col("n_variants") > 1)
        .select(F.lit(rule or f"conflict({','.join(keys)})").alias("rule"), *keys, "n_variants", "n_rows")
    )


# -- row-level: rule name -> condition under which a row violates it --------------------------------------------------


def not_null(columns: Sequence[str]) -> dict[str, Column]:
    return {f"not_null({c})": F.col(c).isNull() for c in columns}


def check(name: str, predicate: Column) -> dict[str, Column]:
    """A CHECK clause: only FALSE violates it, NULL passes."""
    return {f"check({name})": ~F.coalesce(predicate, F.lit(True))}


def text_length(limits: Mapping[str, int]) -> dict[str, Column]:
    return {f"length({c})": F.coalesce(F.char_length(c) > n, F.lit(False)) for c, n in limits.items()}


def decimal_range(shapes: Mapping[str, tuple[int, int]]) -> dict[str, Column]:
    """Values that do not fit DECIMAL(p,s) after rounding."""
    return {
        f"decimal({c})": F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()
        for c, (p, s) in shapes.items()
    }


def row_violations(df: DataFrame, rules: Mapping[str, Column], keep: Sequence[str] | None = None) -> DataFrame:
    """Every row that breaks a rule, once per broken rule, with the columns ``keep`` (default: all)."""
    broken = F.filter(
        F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]), lambda r: r.isNotNull()
    )
    keep = list(df.columns if keep is None else keep)
    return df.select(F.explode(broken).alias("rule"), *keep)


# -- the warehouse's own constraints ----------------------------------------------------------------------------------


def table_rules(columns: Sequence[str], required: Sequence[str]) -> dict[str, Column]:
    """The declared row-level constraints that apply to a table with these columns."""
    rules = not_null([c for c in required if c in columns])
    rules |= text_length({c: n for c, n in schema.TEXT_LENGTHS.items() if c in columns})
    rules |= decimal_range({c: s for c, s in schema.DECIMAL_SHAPES.items() if c in columns})
    if "gender" in columns:
        rules |= check("gender", F.col("gender").isin(*schema.GENDERS))
    return rules


def check_star(tables: Mapping[str, DataFrame], sales_key: Sequence[str] = ("order_id",)) -> dict[str, DataFrame]:
    """All checks of a star, by name. Nothing runs until a result is read.

    ``sales_key`` is what identifies a sale: the order at order grain; empty at line grain without a line number.
    """
    out: dict[str, DataFrame] = {}
    for name, df in tables.items():
        keys = list(sales_key) if name == "sales" else schema.PRIMARY_KEYS[name]
        if keys:
            out[f"{name}.key"] = unique(df, keys)
        out[f"{name}.rows"] = row_violations(df, table_rules(df.columns, schema.REQUIRED[name]))
    for key, parent in schema.REFERENCES.items():
        if parent in tables:
            out[f"sales.{key}"] = foreign_key(tables["sales"], tables[parent], key)
    return out


class ConstraintError(ValueError):
    """A load was refused; ``report`` maps each broken check to the number of its violations."""

    def __init__(self, report: Mapping[str, int]):
        super().__init__(f"constraint violations: {dict(report)}")
        self.report = dict(report)


def require_clean(checks: Mapping[str, DataFrame]) -> None:
    """Count the violations of all checks in one job and raise if there are any."""
    counts = None
    for name, df in checks.items():
        one = df.select(F.lit(name).alias("check")).groupBy("check").agg(F.count("*").alias("n"))
        counts = one if counts is None else counts.unionByName(one)
    if counts is None:
        return
    report = {r["check"]: r["n"] for r in counts.collect()}  # one row per broken check
    if report:
        raise ConstraintError(report)
