"""Load statistics (A8, A9) without extra passes over the data.

``observe`` attaches named aggregate metrics to a plan; they are filled in by the
action that writes the data (one pass), instead of a separate count job per number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observe(df: DataFrame, name: str, **conds: Column) -> tuple[DataFrame, Observation]:
    """Attach ``rows`` plus one ``count_if`` per condition; read ``obs.get`` after an action."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conds.items()]
    return df.observe(obs, *metrics), obs


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows per input partition (the per-chunk counts of a batched loader)."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def stage_counts(df: DataFrame, table: str, stages: dict[str, Column], by_partition: bool = False) -> DataFrame:
    """A8 as a table: one row per (table, stage) with the number of rows of ``df`` that meet the
    stage's condition, all counted in one pass; with ``by_partition`` one per partition of
    ``df`` too, the chunks of a batched loader."""
    counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(f"_{i}") for i, c in enumerate(stages.values())]
    pairs = ", ".join(f"'{name}', _{i}" for i, name in enumerate(stages))
    if by_partition:
        # counted within each task: one row a partition, nothing to bring together
        wide = df.groupBy(F.spark_partition_id().alias("partition")).agg(*counts)
        return wide.selectExpr(f"'{table}' AS table", "partition", f"stack({len(stages)}, {pairs}) AS (stage, rows)")
    return df.agg(*counts).selectExpr(f"'{table}' AS table", f"stack({len(stages)}, {pairs}) AS (stage, rows)")


def totals(counts: DataFrame) -> DataFrame:
    """The counts of :func:`stage_counts` by partition, summed up."""
    return counts.groupBy("table", "stage").agg(F.sum("rows").alias("rows"))


def throughput(rows: int, elapsed_ms: float) -> float:
    """Rows per second of a load (driver-side arithmetic on two numbers)."""
    return rows * 1000.0 / elapsed_ms if elapsed_ms > 0 else float("nan")
