"""Changes on stored tables (U1, U3-U5, Q14): only the partitions that hold affected rows are
read and rewritten.

A table is partitioned by ranges of its key, ``width`` keys each (:func:`write_ranged`).  A
statement first finds the ranges that it affects, from the columns of its condition, or from
the keys alone where it names keys; then it rewrites these with Spark's dynamic partition
overwrite and counts the affected rows in that write.  Files of other ranges are not touched.
A range that loses all its rows becomes an empty file.  One statement on a table at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedworks.functions.text import _col
from feedworks.operators import changes, metrics, quality

RANGE = "key_range"


def range_of(key: str, width: int) -> Column:
    """The number of the key's range; in whole numbers, so that large keys keep their place."""
    return F.expr(f"(CAST({key} AS BIGINT) - pmod(CAST({key} AS BIGINT), {int(width)}L)) div {int(width)}L").alias(RANGE)


def write_ranged(df: DataFrame, path: str, key: str, width: int, mode: str = "overwrite") -> None:
    """Store ``df`` partitioned by ranges of ``key``; a range is written by few tasks."""
    df.select("*", range_of(key, width)).repartitionByRange(key).write.mode(mode).partitionBy(RANGE).parquet(path)


def read_ranged(spark: SparkSession, path: str) -> DataFrame:
    """The stored table without its range column."""
    return spark.read.parquet(path).drop(RANGE)


def _within(ranges: list) -> Column:
    numbers = F.col(RANGE).isin([r for r in ranges if r is not None])
    return numbers | F.col(RANGE).isNull() if None in ranges else numbers


def _rewrite(rows: DataFrame, path: str) -> None:
    """A range is dealt to one task: where each task holds rows of all ranges, as after a join, it
    would write a file for each, and there are tasks times ranges of them."""
    rows.repartition(RANGE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RANGE).parquet(path)


def update(spark: SparkSession, path: str, column: str, value, cond: Column) -> int:
    """``UPDATE .. SET column = value WHERE cond``; the number of rows changed.  ``column`` is
    not the key; the value takes the column's stored type."""
    table = spark.read.parquet(path)
    ranges = [r[0] for r in table.where(cond).select(RANGE).distinct().collect()]  # no more than the table's partitions
    if not ranges:
        return 0
    rows, seen = metrics.observe(table.where(_within(ranges)), "update", hit=cond)
    value = _col(value) if isinstance(value, (str, Column)) else F.lit(value)
    _rewrite(changes.update_where(rows, column, value.cast(table.schema[column].dataType), cond), path)
    return seen.get["hit"]


def _delete(table: DataFrame, path: str, ranges: list, tagged: DataFrame, hit: Column) -> int:
    rows, seen = metrics.observe(tagged, "delete", hit=hit)
    left = [r[0] for r in tagged.where(~F.coalesce(hit, F.lit(False))).select(RANGE).distinct().collect()]
    kept = changes.delete_where(rows, hit).select(*table.columns)
    if left:
        _rewrite(kept, path)
        gone = seen.get["hit"]
    else:
        gone = tagged.where(hit).count()
    # the overwrite leaves alone what it gets no row for
    empty = table.drop(RANGE).limit(0)
    for r in sorted(set(ranges) - set(left), key=str):
        empty.write.mode("overwrite").parquet(f"{path}/{RANGE}={'__HIVE_DEFAULT_PARTITION__' if r is None else r}")
    return gone


def delete(spark: SparkSession, path: str, cond: Column) -> int:
    """U4: ``DELETE WHERE cond``; the number of rows deleted."""
    table = spark.read.parquet(path)
    ranges = [r[0] for r in table.where(cond).select(RANGE).distinct().collect()]
    return _delete(table, path, ranges, table.where(_within(ranges)), cond) if ranges else 0


def delete_in(spark: SparkSession, path: str, key: str, width: int, doomed: DataFrame) -> int:
    """``DELETE WHERE key IN (doomed)`` on the table that is stored by ranges of ``key``:
    a table itself, or the children of deleted parents stored by their parent's key.  Which
    ranges are affected follows from the keys; the table is not searched for them."""
    table = spark.read.parquet(path)
    keys = doomed.select(key).where(F.col(key).isNotNull()).distinct()
    ranges = [r[0] for r in keys.select(range_of(key, width)).distinct().collect()]
    there = {r[0] for r in table.where(_within(ranges)).select(RANGE).distinct().collect()} if ranges else set()
    if not there:
        return 0
    tagged = quality.fk_tag(table.where(_within(list(there))), key, keys, key, "_doomed")
    return _delete(table, path, list(there), tagged, F.col("_doomed"))


def delete_in_limit(spark: SparkSession, path: str, key: str, width: int, cond: Column, limit: int) -> int:
    """``DELETE WHERE key IN (SELECT key WHERE cond ORDER BY key LIMIT n)`` on a stored table."""
    doomed = changes.victims(spark.read.parquet(path), key, cond, limit)
    fixed = spark.createDataFrame(doomed.collect(), doomed.schema)  # ``limit`` keys; they must not change with the table
    return delete_in(spark, path, key, width, fixed)


def cascade_delete(spark: SparkSession, path: str, key: str, width: int, doomed: DataFrame,
                   children: list[tuple[str, str, int]]) -> dict[str, int]:
    """Q14: delete the ``doomed`` keys and the children that refer to them.  ``children``: (path,
    reference, width) of each child table.  Children go first: a statement that breaks off can
    be given again.  ``doomed`` must not be read from the tables that change."""
    out = {child: delete_in(spark, child, fk, w, doomed.select(F.col(key).alias(fk))) for child, fk, w in children}
    return out | {path: delete_in(spark, path, key, width, doomed)}
