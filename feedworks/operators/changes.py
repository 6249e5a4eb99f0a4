"""Row changes (U1-U5) as DataFrame rewrites.

Plain Parquet tables have no UPDATE / DELETE, so each operator returns the table
as it is after the change; the affected-row count is a separate one-pass aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedworks.functions.text import _col


def update_where(df: DataFrame, column: str, value, cond: Column) -> DataFrame:
    """``SET column = value WHERE cond``; a NULL condition leaves the row as is."""
    value = _col(value) if isinstance(value, (str, Column)) else F.lit(value)
    return df.withColumn(column, F.when(cond, value).otherwise(F.col(column)))


def affected(df: DataFrame, cond: Column, name: str = "affected") -> DataFrame:
    """Number of rows a change touches."""
    return df.agg(F.count_if(F.coalesce(cond, F.lit(False))).alias(name))


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """U4: ``DELETE WHERE cond``; rows where the condition is NULL stay."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def victims(df: DataFrame, key: str, cond: Column, limit: int) -> DataFrame:
    """L2: the first ``limit`` keys (by key) satisfying ``cond``.

    ``orderBy().limit()`` plans a TakeOrderedAndProject: each task keeps its local
    top ``limit`` and only those reach the final merge.
    """
    return df.filter(cond).select(key).orderBy(key).limit(limit)


def delete_in(df: DataFrame, key: str, doomed: DataFrame) -> DataFrame:
    """``DELETE WHERE key IN (subquery)`` as an anti join; Spark picks the strategy from
    the size it finds."""
    return df.join(doomed.select(F.col(key).alias(key)), key, "left_anti")


def delete_in_limit(df: DataFrame, key: str, cond: Column, limit: int) -> DataFrame:
    """``DELETE FROM t WHERE key IN (SELECT key FROM t WHERE cond ORDER BY key LIMIT n)``."""
    return delete_in(df, key, victims(df, key, cond, limit))
