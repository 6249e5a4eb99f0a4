"""Query suites (G4, G5) over a users table and its follower edges.

Column names are parameters so the same suites run on the imported ``users`` /
``user_followers`` tables or on any analogue.  Thresholds default to the suites'
fixed constants.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedworks.functions.numeric import decade_label, round2
from feedworks.functions.staged import clean_columns
from feedworks.operators import changes, reports, sinks
from feedworks.schemas import USERS_COLUMNS
from feedworks.sources.csv_feed import read_feed


@dataclass(frozen=True)
class UserCols:
    key: str = "author_id"
    name: str = "author_name"
    gender: str = "gender"
    age: str = "age"
    followers: str = "followers_count"
    following: str = "following_count"
    edge_user: str = "user_id"
    edge_target: str = "follower_id"


@dataclass(frozen=True)
class SuiteParams:
    # Constants of the database suite's statements.
    age_low: int = 25
    age_high: int = 35
    followers_min: float = 100
    gender_value: str = "Female"
    update_age_below: int = 30
    delete_age_above: int = 50
    delete_limit: int = 10
    group_age_low: int = 20
    group_age_high: int = 40
    group_min_count: int = 10
    join_age_low: int = 18
    join_age_high: int = 60
    # The file suite's spellings of "female".
    female_spellings: tuple = ("female", "f")


# =========================================================================== G4
def suite_counts(users: DataFrame, cols: UserCols = UserCols(),
                 p: SuiteParams = SuiteParams()) -> DataFrame:
    """G4 statements 1-4 in one scan: all rows, age range, followers, gender."""
    age, fol = F.col(cols.age), F.col(cols.followers)
    return reports.filter_counts(users, {
        "total": F.lit(True),
        "age_in_range": reports.between(age, p.age_low, p.age_high),
        "followers_over": reports.greater(fol, p.followers_min),
        "gender_match": reports.equals(cols.gender, p.gender_value),
    })


def suite_changes(users: DataFrame, cols: UserCols = UserCols(),
                  p: SuiteParams = SuiteParams()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """G4 statements 5-6: (updated count, deleted count, table after both changes)."""
    age, fol = F.col(cols.age), F.col(cols.followers)
    upd_cond = age < F.lit(p.update_age_below)
    updated_count = changes.affected(users, upd_cond, "updated")
    after_update = changes.update_where(users, cols.followers, fol + F.lit(1), upd_cond)
    doomed = changes.victims(after_update, cols.key, age > F.lit(p.delete_age_above), p.delete_limit)
    deleted_count = doomed.agg(F.count(F.lit(1)).alias("deleted"))
    after = changes.delete_in(after_update, cols.key, doomed)
    return updated_count, deleted_count, after


def suite_grouped(after: DataFrame, cols: UserCols = UserCols(),
                  p: SuiteParams = SuiteParams()) -> DataFrame:
    """G4 statement 7 (A3) on the changed table."""
    return reports.group_having_sort(
        after, cols.gender, {"avg_followers": cols.followers, "avg_following": cols.following},
        pred=reports.between(cols.age, p.group_age_low, p.group_age_high),
        min_count=p.group_min_count, order_by="avg_followers")


def suite_joined(after: DataFrame, edges: DataFrame, cols: UserCols = UserCols(),
                 p: SuiteParams = SuiteParams()) -> DataFrame:
    """G4 statement 8 (A4) on the changed table."""
    return reports.left_join_distinct(
        after, edges, cols.key, cols.edge_user, cols.edge_target, cols.gender, cols.followers,
        pred=reports.between(cols.age, p.join_age_low, p.join_age_high))


def db_suite(users: DataFrame, edges: DataFrame, cols: UserCols = UserCols(),
             p: SuiteParams = SuiteParams()) -> dict[str, DataFrame]:
    """The eight statements in order.  The grouped and join statements see the
    table after the update and the delete, as in the original run order.

    Returns ``counts`` (one row: all, age range, followers, gender), ``updated`` and
    ``deleted`` (affected-row counts), ``users_after`` (table after both changes),
    ``grouped`` (A3) and ``joined`` (A4).
    """
    updated, deleted, after = suite_changes(users, cols, p)
    return {"counts": suite_counts(users, cols, p), "updated": updated, "deleted": deleted,
            "users_after": after, "grouped": suite_grouped(after, cols, p),
            "joined": suite_joined(after, edges, cols, p)}


# =========================================================================== G5
def file_users(spark, path) -> DataFrame:
    """S5 + S6: the file suite's reader: one record per line, missing ints are 0."""
    feed = read_feed(spark, path, USERS_COLUMNS, ingest_order=False)
    r = feed.records
    return clean_columns(r, [
        ("author_id", "int_or_zero", "author_id"), ("author_name", "str", "author_name"),
        ("gender", "str", "gender"), ("age", "int_or_zero", "age"),
        ("followers_count", "int_or_zero", "followers_count"),
        ("following_count", "int_or_zero", "following_count"),
        ("user_followers", "str", "user_followers"), ("user_following", "str", "user_following")])


def file_suite(users: DataFrame, cols: UserCols = UserCols(),
               p: SuiteParams = SuiteParams()) -> dict[str, DataFrame]:
    """Three filters on the read set, update (U2 = U1 repaired), delete of
    ``age > 50`` keeping missing ages (U4), then the decade averages (A6) and the
    compare-to-average (J4) on the changed set, and the per-run summary row (A10).

    Missing ages are 0 in this suite (H7), hence ``coalesce(age, 0)``.
    """
    age = F.coalesce(F.col(cols.age), F.lit(0))
    fol = F.col(cols.followers)
    female = reports.any_case_in(cols.gender, p.female_spellings)
    by_age = users.filter(reports.between(age, p.age_low, p.age_high))
    by_followers = users.filter(reports.greater(fol, p.followers_min))
    females = users.filter(female)
    upd_cond = age < F.lit(p.update_age_below)
    updated = changes.update_where(users, cols.followers, fol + F.lit(1), upd_cond)
    del_cond = age > F.lit(p.delete_age_above)
    remaining = changes.delete_where(updated, del_cond)
    bands = reports.decade_average(remaining.withColumn(cols.age, age), cols.age, cols.followers,
                                   avg_name="avg_followers")
    high_female = reports.above_global_avg(remaining, cols.followers, female)
    # Two scans: the mean of what stays, then all counts (each user before and after its change).
    stays, changed = ~F.coalesce(del_cond, F.lit(False)), F.when(upd_cond, fol + F.lit(1)).otherwise(fol)
    mean = remaining.select(F.avg(cols.followers)).scalar()
    summary = users.agg(F.count_if(reports.between(age, p.age_low, p.age_high)).alias("age_in_range"),
                        F.count_if(reports.greater(fol, p.followers_min)).alias("followers_over"),
                        F.count_if(female).alias("female"),
                        F.count_if(upd_cond).alias("updated"),
                        F.count_if(del_cond).alias("deleted"),
                        F.count_if(stays).alias("remaining_users"),
                        F.count_if(stays & female & (changed > mean)).alias("high_follower_female"))
    return {"by_age": by_age, "by_followers": by_followers, "females": females,
            "updated": updated, "remaining": remaining, "age_bands": bands,
            "high_follower_female": high_female, "summary": summary}


def run_file_suite(spark, path, out_dir: str, rounds: int = 1, p: SuiteParams = SuiteParams()) -> dict[str, DataFrame]:
    """G5 from end to end over the CSV files at ``path``: per round the read, the three filters, the
    update, the delete and both reports, each timed; the users as read, as updated and
    as left are written as CSV (K9) under ``out_dir``.

    Writes and returns the report tables (K10): ``timings`` (op, round, ms), their
    ``means`` (A11), ``runs`` (the counts of each round, A10) and ``age_bands`` (label,
    mean with two decimals, C15, C16).
    """
    timings, runs = [], []

    def timed(op, number, action):
        start = time.perf_counter()
        out = action()
        timings.append((op, number, (time.perf_counter() - start) * 1000.0))
        return out

    def full(df):
        return lambda: df.write.format("noop").mode("overwrite").save()

    for number in range(1, rounds + 1):
        users = file_users(spark, path)
        out = file_suite(users, p=p)
        timed("read", number, full(users))
        timed("write", number, lambda: sinks.write_csv(users, f"{out_dir}/output_all"))
        for op in ("by_age", "by_followers", "females", "updated"):
            timed(op, number, full(out[op]))
        sinks.write_csv(out["updated"], f"{out_dir}/output_updated")
        timed("remaining", number, full(out["remaining"]))
        sinks.write_csv(out["remaining"], f"{out_dir}/output_deleted")
        timed("age_bands", number, full(out["age_bands"]))
        timed("high_follower_female", number, full(out["high_follower_female"]))
        runs.append((number, *out["summary"].first()))
    frame = spark.createDataFrame(timings, "op string, round int, ms double")
    columns = ", ".join(f"{c} long" for c in out["summary"].columns)
    bands = out["age_bands"].select(decade_label("age_group").alias("age_group"), round2(F.col("avg_followers")).alias("avg_followers"))
    reports_ = {"timings": frame, "means": reports.timing_summary(frame), "age_bands": bands,
                "runs": spark.createDataFrame(runs, f"run int, {columns}")}
    sinks.write_reports(reports_, out_dir, fmt="csv")
    return reports_
