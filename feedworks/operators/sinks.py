"""Sinks (K1, K6-K13): typed targets, Parquet / CSV / JDBC writers, layouts.

All writers are plain DataFrameWriter calls, so each task writes its own files and
a failed task is retried by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """K1: an empty DataFrame with a target schema (the "CREATE TABLE IF NOT EXISTS")."""
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the columns of ``schema`` in its order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop denormalised columns; unknown names are ignored (``IF EXISTS``)."""
    return df.drop(*names)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """K12 (mode overwrite resets the target) / K5 (mode append)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_sorted(df: DataFrame, path: str, key: str, partitions: int | None = None,
                 mode: str = "overwrite") -> None:
    """Range-partition and sort by ``key`` so Parquet min/max statistics prune
    lookups by key (the role of a secondary index)."""
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    df.repartitionByRange(n, key).sortWithinPartitions(key).write.mode(mode).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int,
                   mode: str = "overwrite", path: str | None = None) -> None:
    """Bucket and sort by ``key`` in the catalog, so later joins and aggregates on
    ``key`` need no shuffle of this table.  The rows are dealt out to the buckets first, so
    that each bucket is one file, not one for every task."""
    writer = df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def lookup(table: DataFrame, key: str, values: list) -> DataFrame:
    """The rows with one of some keys.  Of a bucketed table Spark reads the buckets of
    these keys alone, of one that :func:`write_sorted` wrote the row groups whose bounds
    may hold them."""
    return table.where(F.col(key).isin(list(values)))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K9: CSV with a header; cells with separators or quotes are quoted."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def jdbc_writer(df: DataFrame, url: str, table: str, properties: dict | None = None,
                batch_size: int = 1000, num_partitions: int | None = None, mode: str = "append"):
    """K6-K8: a configured JDBC writer (PostgreSQL or MySQL URL from the caller).

    Credentials come only from ``properties``.  ``batch_size`` rows go per batch,
    ``num_partitions`` caps concurrent connections.  Returns the writer; call
    ``.save()``.  Not exercised in tests (no database server here).
    """
    writer = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table) \
        .option("batchsize", batch_size)
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    return writer


def write_reports(reports: dict[str, DataFrame], base_path: str, fmt: str = "parquet",
                  files: int | None = None) -> None:
    """One output per report table (timings, per-run counts, age bands).

    A report is written by as many tasks as made it.  ``files`` asks for that many files
    instead, dealt out anew, so that what lies upstream keeps its own parallelism.
    """
    for name, df in reports.items():
        writer = (df.repartition(files) if files else df).write.mode("overwrite")
        if fmt == "csv":
            writer.option("header", True).csv(f"{base_path}/{name}")
        else:
            writer.parquet(f"{base_path}/{name}")


def reset_targets(spark: SparkSession, targets: dict[str, T.StructType], base_path: str) -> None:
    """Every target emptied to its schema, as a load from the beginning needs it."""
    for name, schema in targets.items():
        write_parquet(empty_table(spark, schema), f"{base_path}/{name}")
