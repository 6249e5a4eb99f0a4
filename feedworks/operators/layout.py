"""Partition layout helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None = None, by: str | None = None) -> DataFrame:
    """Deal rows out to ``partitions`` tasks before CPU-heavy row-local work, for input that the
    caller knows can't be split (a gzip file, one multi-line CSV file, one row group).

    Without ``partitions`` nothing is added, whatever the size: how many tasks scan a
    splittable file is a setting of the scan (``spark.sql.files.maxPartitionBytes``,
    ``spark.sql.files.minPartitionNum``), and costs no shuffle.

    ``by`` names a column that is unique per row and reproduced exactly when a task
    is recomputed (a feed's ingest order: file, split, position); rows are then
    hash-partitioned on it, which needs no sort.  Otherwise the round-robin
    repartition is used, which Spark sorts first so that a retried task sends every
    row to the same place.  Row contents are never hashed: exact copies of one row
    (possibly a third of the input) would all land in one task.
    """
    if not partitions:
        return df
    return df.repartition(partitions, by) if by else df.repartition(partitions)
