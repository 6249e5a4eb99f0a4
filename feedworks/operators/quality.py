"""Data-quality rules (Q1-Q15) as Columns, and the valid / rejects split.

A rule is a named boolean Column with SQL CHECK semantics: a row fails a rule only
when the predicate is FALSE; NULL passes (so nullable columns pass range checks).
Rows are tagged in one projection (no shuffle); ``split`` returns two filtered views
of the same tagged plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedworks.functions.text import _col

REASON = "reject_reason"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Column

    def failed(self) -> Column:
        return ~F.coalesce(self.predicate, F.lit(True))


# ------------------------------------------------------------------ rule builders
def not_null(c) -> Rule:
    """Q2."""
    name = c if isinstance(c, str) else str(c)
    return Rule(f"not_null:{name}", _col(c).isNotNull())


def in_set(c: str, values) -> Rule:
    """Q3: null or one of ``values``."""
    return Rule(f"in_set:{c}", F.col(c).isin(list(values)))


def in_range(c: str, low=None, high=None, low_inclusive: bool = True,
             high_inclusive: bool = True) -> Rule:
    """Q4-Q8: null or within the bounds."""
    col = F.col(c)
    pred = F.lit(True)
    if low is not None:
        pred = pred & ((col >= F.lit(low)) if low_inclusive else (col > F.lit(low)))
    if high is not None:
        pred = pred & ((col <= F.lit(high)) if high_inclusive else (col < F.lit(high)))
    return Rule(f"range:{c}", pred)


def max_length(c: str, n: int) -> Rule:
    """Q9: null or at most ``n`` characters (over-long is an error, never a cut)."""
    return Rule(f"max_length:{c}", F.length(F.col(c)) <= F.lit(n))


def fits(raw, parsed, name: str) -> Rule:
    """Q15: a value that was given but does not fit its target type is a reject."""
    return Rule(f"fits:{name}", ~(_col(raw).isNotNull() & _col(parsed).isNull()))


# ------------------------------------------------------------------ split
def reason_of(rules: list[Rule], read: str | None = None) -> Column:
    """The reason of the reader (column ``read``), else the name of the first failed rule, else null."""
    reason = F.lit(None).cast("string")
    for rule in reversed(rules):
        reason = F.when(rule.failed(), F.lit(rule.name)).otherwise(reason)
    return F.coalesce(F.col(read), reason) if read else reason


def tag(df: DataFrame, rules: list[Rule], read: str | None = None) -> DataFrame:
    """Add ``reject_reason`` (:func:`reason_of`)."""
    return df.withColumn(REASON, reason_of(rules, read))


def split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the reason column, rejected rows with ``reject_reason``)."""
    tagged = tag(df, rules)
    valid = tagged.filter(F.col(REASON).isNull()).drop(REASON)
    rejects = tagged.filter(F.col(REASON).isNotNull())
    return valid, rejects


def rule_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per-rule failure counts in one pass (a row may fail several rules)."""
    aggs = [F.count_if(r.failed()).alias(f"_{i}") for i, r in enumerate(rules)]
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    stack = ", ".join(f"'{r.name}', _{i}" for i, r in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {stack}) as (rule, failed)")


# ------------------------------------------------------------------ referential
def key_set(parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """The distinct non-null keys of ``parent`` in a column ``name``.

    The aggregate is planned on a struct, so its output is not partitioned on ``name``
    and a join on it gets an exchange of its own.  Adaptive execution splits the
    partition of a hot key only where such a plain exchange lies under the join; for a
    distinct planned on the join key itself it can't.
    """
    keys = parent.where(F.col(parent_key).isNotNull()).groupBy(F.struct(F.col(parent_key).alias("k")).alias("_s"))
    return keys.agg(F.lit(True).alias("_one")).select(F.col("_s.k").alias(name))


def fk_tag(df: DataFrame, fk: str, parent: DataFrame, parent_key: str, hit: str) -> DataFrame:
    """``df`` with a boolean ``hit``: whether ``fk`` is a key of ``parent``.  One left join
    whose child side can be split where one key holds much of it."""
    keys = key_set(parent, parent_key, "_fk_hit_key")
    return df.join(keys, F.col(fk) == F.col("_fk_hit_key"), "left") \
        .withColumn(hit, F.col("_fk_hit_key").isNotNull()).drop("_fk_hit_key")


def fk_split(df: DataFrame, fk: str, parent: DataFrame, parent_key: str,
             allow_null: bool = True, name: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``fk`` is in ``parent`` (or null when allowed) vs the rest,
    both views of one tagged plan (:func:`fk_tag`)."""
    ok = F.col("_fk_hit")
    if allow_null:
        ok = ok | F.col(fk).isNull()
    tagged = fk_tag(df, fk, parent, parent_key, "_fk_hit") \
        .withColumn(REASON, F.when(~ok, F.lit(name or f"fk:{fk}"))).drop("_fk_hit")
    return tagged.filter(F.col(REASON).isNull()).drop(REASON), tagged.filter(F.col(REASON).isNotNull())


def semi(df: DataFrame, fk: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows with a parent (EXISTS)."""
    return df.join(key_set(parent, parent_key, fk), fk, "left_semi")


def anti(df: DataFrame, fk: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows without a parent (NOT EXISTS)."""
    return df.join(key_set(parent, parent_key, fk), fk, "left_anti")


def cascade_delete(child: DataFrame, fk: str, deleted_parents: DataFrame,
                   parent_key: str) -> DataFrame:
    """Q14: children of deleted parents go too (ON DELETE CASCADE)."""
    return anti(child, fk, deleted_parents, parent_key)
