"""Stored-table scans (S9): Parquet tables by name from a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the driver tables available under a scale-factor folder.
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``spark.read.parquet(f"{base}/{name}.parquet")``; filters and projections applied
    later are pushed into this scan by Catalyst."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, base: str, names=None) -> None:
    """Register each table as a temporary view of the same name, for ``spark.sql``."""
    for name in names or TABLES:
        table(spark, base, name).createOrReplaceTempView(name)
