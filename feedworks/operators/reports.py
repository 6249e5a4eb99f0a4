"""Reports: counts, filters, grouped / joined aggregates, compare-to-average
(A1-A7, A10, A11, J1, J4, P5-P10, L1).

All are lazy DataFrames.  Aggregates are hash aggregates with partial (map-side)
aggregation, so a group holding a third of the rows is pre-reduced in every task
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedworks.functions.numeric import decade
from feedworks.functions.text import _col


# ------------------------------------------------------------------ predicates
def between(c, low, high) -> Column:
    """``c BETWEEN low AND high`` (null fails)."""
    return _col(c).between(F.lit(low), F.lit(high))


def greater(c, value) -> Column:
    """P6."""
    return _col(c) > F.lit(value)


def equals(c, value) -> Column:
    """Exact match."""
    return _col(c) == F.lit(value)


def any_case_in(c, values) -> Column:
    """Case-insensitive membership, null-safe (null -> false)."""
    return F.coalesce(F.lower(_col(c)).isin([v.lower() for v in values]), F.lit(False))


def where(df: DataFrame, pred: Column) -> DataFrame:
    """Rows satisfying ``pred`` (pushed into the Parquet scan by Catalyst)."""
    return df.filter(pred)


# ------------------------------------------------------------------ counts (A1, A2, A10)
def count_all(df: DataFrame, name: str = "n") -> DataFrame:
    """A1: ``SELECT COUNT(*)``."""
    return df.agg(F.count(F.lit(1)).alias(name))


def filter_counts(df: DataFrame, preds: dict[str, Column]) -> DataFrame:
    """A2 / A10: several filtered counts in one scan (one ``count_if`` per predicate)."""
    return df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in preds.items()])


# ------------------------------------------------------------------ grouped
def group_having_sort(df: DataFrame, group_col: str, averages: dict[str, str],
                      pred: Column | None = None, min_count: int = 10,
                      order_by: str | None = None, count_name: str = "count") -> DataFrame:
    """A3 + A5 + L1: filter, group, AVG per column, COUNT(*), ``HAVING COUNT(*) > min_count``,
    ``ORDER BY order_by DESC`` with NULLs first (as PostgreSQL orders DESC)."""
    src = df if pred is None else df.filter(pred)
    aggs = [F.avg(c).alias(n) for n, c in averages.items()]
    out = src.groupBy(group_col).agg(*aggs, F.count(F.lit(1)).alias(count_name)) \
        .filter(F.col(count_name) > F.lit(min_count))
    key = order_by or next(iter(averages))
    return out.orderBy(F.col(key).desc_nulls_first())


def decade_average(df: DataFrame, age_col: str, value_col: str, band_name: str = "age_group",
                   avg_name: str = "avg_value", count_name: str | None = None) -> DataFrame:
    """A6 + C15: average of ``value_col`` per ten-year band of ``age_col``.

    Integer values are summed in 64 bits by ``avg`` (no 32-bit overflow)."""
    aggs = [F.avg(value_col).alias(avg_name)]
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    return df.groupBy(decade(age_col).alias(band_name)).agg(*aggs)


def global_stats(df: DataFrame, value_col: str) -> DataFrame:
    """Global sum and mean (mean of an empty input is null)."""
    return df.agg(F.sum(value_col).alias("total"), F.avg(value_col).alias("mean"))


def above_global_avg(df: DataFrame, value_col: str, pred: Column | None = None) -> DataFrame:
    """J4 + P10: rows (matching ``pred``) whose value exceeds the mean over **all** rows.

    The mean is a scalar subquery: Catalyst runs it as its own partially aggregated
    job and inlines the value, so no row is moved to a single partition.
    """
    mean = df.select(F.avg(value_col)).scalar()
    cond = F.col(value_col) > mean
    return df.filter(cond if pred is None else (pred & cond))


# ------------------------------------------------------------------ join + distinct
def left_join_distinct(users: DataFrame, edges: DataFrame, user_key: str, edge_user: str,
                       edge_target: str, group_col: str, value_col: str,
                       pred: Column | None = None, distinct_name: str = "unique_followers",
                       avg_name: str = "avg_followers") -> DataFrame:
    """A4 + J1 + A5 + L1::

        SELECT u.g, COUNT(DISTINCT e.t) AS unique_followers, AVG(u.v) AS avg_followers
        FROM users u LEFT JOIN edges e ON u.k = e.u WHERE pred
        GROUP BY u.g HAVING COUNT(DISTINCT e.t) > 0 ORDER BY unique_followers DESC

    Same result, planned for skew: a left join shuffles all edges of one user to one
    task, and a left outer join cannot split its right side.  Instead

    * the edges are scanned once and counted per (user, target) pair, partially
      aggregated before the shuffle (a pair key spreads even a hot user);
    * the AVG over join rows is a weighted mean, each user weighted by its number of
      edge rows (1 when it has none): the weights are the pair counts summed per
      user, so the join sees one row per user;
    * the distinct targets come from the pairs joined to the filtered users:
      an inner join, which AQE may broadcast or split when a user is hot.
    """
    u = users if pred is None else users.filter(pred)
    whole = users.schema[value_col].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    value = F.col(value_col).cast("decimal(19,0)") if whole else F.col(value_col)
    u = u.select(F.col(user_key).alias("_k"), F.col(group_col).alias("_g"), value.alias("_v"))

    pair_counts = edges.groupBy(F.col(edge_user).alias("_k"), F.col(edge_target).alias("_t")) \
        .agg(F.count(F.lit(1)).alias("_c"))
    fan = pair_counts.groupBy("_k").agg(F.sum("_c").alias("_w"))
    weight = F.coalesce("_w", F.lit(1)).cast("decimal(19,0)" if whole else "bigint")
    weighted = u.join(fan, "_k", "left").select("_g", "_v", weight.alias("_w"))
    means = weighted.groupBy("_g").agg(
        # as decimals of 38 digits for whole numbers: a 64-bit sum would overflow at scale
        (F.sum(F.col("_v") * F.col("_w")).cast("double") /
         F.sum(F.when(F.col("_v").isNotNull(), F.col("_w")))).alias(avg_name))

    # No null filter here (COUNT(DISTINCT) skips nulls), and the count stays
    # referenced: both branches then share one identical pair-count subtree, whose
    # exchange Spark reuses, so the edges are scanned and shuffled once.
    pairs = pair_counts.filter(F.col("_c") > 0).select("_k", "_t")
    reached = pairs.join(u.select("_k", "_g"), "_k").select("_g", "_t")
    distinct = reached.groupBy("_g").agg(F.countDistinct("_t").alias(distinct_name))

    out = distinct.filter(F.col(distinct_name) > 0) \
        .join(means.withColumnRenamed("_g", "_g2"), F.col("_g").eqNullSafe(F.col("_g2"))) \
        .select(F.col("_g").alias(group_col), distinct_name, F.col(avg_name).cast("double").alias(avg_name))
    return out.orderBy(F.col(distinct_name).desc_nulls_first())


# ------------------------------------------------------------------ timings
def timing_summary(timings: DataFrame, op_col: str = "op", ms_col: str = "ms",
                   base_op: str | None = None) -> DataFrame:
    """Mean time per operation over rounds; with ``base_op``, also each mean as a
    ratio of that operation's mean (the suite's "x / count all" ratios)."""
    means = timings.groupBy(op_col).agg(F.avg(ms_col).alias("mean_ms"),
                                        F.count(F.lit(1)).alias("rounds"))
    if base_op is None:
        return means
    base = means.filter(F.col(op_col) == F.lit(base_op)).select(F.max("mean_ms")).scalar()
    return means.withColumn("ratio", F.col("mean_ms") / base)
