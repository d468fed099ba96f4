"""Joins and group filters in the forms the call database needs.

Group filters count with an aggregate, whose partial step runs before the shuffle, and join the
counts back, so that no task has to hold all rows of a large group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _renamed(df: DataFrame, names: Sequence[str], prefix: str = "__") -> DataFrame:
    """The named columns only, under new names, so a join with their own source is unambiguous."""
    return df.select(*[F.col(name).alias(prefix + name) for name in names])


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join on ``on`` with NULL equal to NULL, keeping the left side's key columns."""
    other = right.select(
        *[F.col(c).alias("__" + c) for c in on], *[c for c in right.columns if c not in on]
    )
    joined = left.join(other, _all([F.col(c).eqNullSafe(F.col("__" + c)) for c in on]), how)
    return joined.drop(*["__" + c for c in on])


def not_null(df: DataFrame, name: str, where: str = "not_in") -> DataFrame:
    """``df``; a NULL in the column stops the job."""
    message = F.lit(f"{where}: {name} must not be NULL")
    return df.withColumn(
        name, F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(F.col(name)))


def not_in(df: DataFrame, denied: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` for which SQL's ``(keys) NOT IN (SELECT keys FROM denied)`` is true.

    A NULL in a key makes the comparison unknown and drops the row. The first key is the hash key
    of the anti join and must not be NULL; a NULL there stops the job.
    """
    lead, others = keys[0], list(keys[1:])
    denied = _renamed(not_null(denied, lead), keys).distinct()
    unknown_or_equal = [
        (F.col(k) == F.col("__" + k)) | F.col(k).isNull() | F.col("__" + k).isNull() for k in others
    ]
    condition = _all([F.col(lead) == F.col("__" + lead), *unknown_or_equal])
    return not_null(df, lead).join(denied, condition, "left_anti")


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every column name the two sides share; NULL keys do not match."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("natural_join: no common columns")
    return left.join(right, shared, how)


def suffix_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Join on ``on``; other columns that occur on both sides get a suffix."""
    clash = {c for c in left.columns if c in right.columns} - set(on)

    def marked(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(*[F.col(c).alias(c + suffix if c in clash else c) for c in df.columns])

    return marked(left, suffixes[0]).join(marked(right, suffixes[1]), list(on), how)


def groups_larger_than(df: DataFrame, by: Sequence[str], n: int = 1) -> DataFrame:
    """All rows of the groups that have more than ``n`` rows; NULL keys form a group."""
    large = df.groupBy(*by).agg(F.count("*").alias("__n")).filter(F.col("__n") > n)
    return null_safe_join(df, large.select(*by), by, "left_semi")


def with_group_size(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """``df`` with the number of rows of each row's group."""
    return null_safe_join(df, df.groupBy(*by).agg(F.count("*").alias(name)), by, "inner")


def group_max_rows(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """Rows whose ``column`` equals the group's maximum; ties stay, NULLs do not count."""
    top = df.groupBy(*by).agg(F.max(column).alias("__max"))
    return (
        null_safe_join(df, top, by, "inner").filter(F.col(column) == F.col("__max")).drop("__max")
    )


def group_min_rows(
    df: DataFrame, by: Sequence[str], column: str, among: Column | None = None
) -> DataFrame:
    """Rows whose ``column`` equals the least value in the group's rows that meet ``among``.

    The rows kept need not meet ``among`` themselves.
    """
    pool = df if among is None else df.filter(among)
    least = pool.groupBy(*by).agg(F.min(column).alias(column))
    return df.join(least, [*by, column], "inner")
