"""End-to-end load (G1-G3 in order): reset on request, import each feed against what its
target holds, write every table, commit, report.

Each feed is a load of its own in the ledger (``operators.ledger``): a load that stops on the
way, wherever that is, is not seen by readers, and running it again replaces what it left.
Each table is counted by the write itself; the feed's own counts (A8) come from one pass
over the cleaned feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedworks.operators import ledger, metrics, sinks, upsert
from feedworks.plans import imports
from feedworks.schemas import PARTITION_COUNTS, RECIPES_COLUMNS, REJECTS, REVIEWS_COLUMNS, TARGETS, USERS_COLUMNS

ORDER = ("users", "recipes", "reviews")
# Per feed, its columns, its import job, the parent table and key,
# the unique-pair child tables and the plain child tables.
FEEDS = {
    "users": (USERS_COLUMNS, imports.import_users, ("users", "author_id"),
              {"user_followers": ["user_id", "follower_id"],
               "user_following": ["user_id", "following_id"]}, []),
    "recipes": (RECIPES_COLUMNS, imports.import_recipes, ("recipes", "recipe_id"), {},
                ["keywords", "recipe_ingredients", "recipe_instructions"]),
    "reviews": (REVIEWS_COLUMNS, imports.import_reviews, ("reviews", "review_id"), {},
                ["review_likers"]),
}


def schema_of(table: str) -> T.StructType:
    return REJECTS if table.endswith("_rejects") else TARGETS[table]


def load(spark: SparkSession, feeds: dict[str, object], target: str, reset: bool = False, **options) -> DataFrame:
    """Load ``feeds`` (name -> path or Feed) into the Parquet tables under ``target``.

    Keys and unique pairs that a table has already are not written again; other children
    of a record are appended only if the record's parent is new with this load, so loading a
    feed twice adds nothing, and neither does running a load again that broke off.  Surrogate
    ids go on from load to load.  A stored table that does not fit its target's schema is an
    error before anything is written.  ``options`` go to the imports.  Returns the report
    (``table``, ``stage``, ``rows``), which is also written to ``target``/report.
    """
    if reset:
        # records first: without them no reader sees the tables while these are emptied
        sinks.write_parquet(sinks.empty_table(spark, ledger.COMMITS).drop(ledger.LOAD), f"{target}/commits")
        sinks.reset_targets(spark, TARGETS, target)
    report = []
    for feed in (f for f in ORDER if f in feeds):
        report += load_feed(spark, feed, feeds[feed], target, ledger.begin(spark, target, feed), **options)
    frame = spark.createDataFrame([r[:3] for r in report], "table string, stage string, rows long")
    sinks.write_reports({"report": frame}, target)
    return frame.orderBy(F.col("table"), F.col("stage"))


def load_feed(spark: SparkSession, feed: str, source, target: str, unit: ledger.Load, users: DataFrame | None = None,
              **options) -> list[tuple[str, str, int, int | None]]:
    """One load of one feed, up to its commit record; the (table, stage, rows, next_id) in it.
    ``users``: those that authors of recipes must be among, where not the target's own."""
    _, job, (parent, key), pairs, plain = FEEDS[feed]
    tables = (*pairs, *plain, parent, f"{feed}_rejects")
    for name in tables:
        ledger.check_stored(spark, f"{target}/{name}", schema_of(name))
    have = {name: ledger.committed(spark, target, name, schema_of(name)) for name in (parent, *pairs)}
    more = {f"known_{parent}": have[parent]}
    if feed == "recipes":
        more["users"] = ledger.committed(spark, target, "users", TARGETS["users"]) if users is None else users
    out = job(spark, source, **more, **options)
    imports.keep(out, options.get("persist", True))
    try:
        # the feed is counted once, by partition; the totals are sums of what was written
        ledger.write(sinks.conform(out["partition_metrics"], PARTITION_COUNTS), target, f"{feed}_partitions", unit)
        parts = spark.read.schema(PARTITION_COUNTS).parquet(ledger.path_of(target, f"{feed}_partitions", unit))
        counts = [(r["table"], r["stage"], r["rows"], None) for r in metrics.totals(parts).collect()]  # a dozen numbers
        if have[parent] is not None:
            out |= {child: upsert.without(out[child], have[parent], [key]) for child in plain}
        out |= {child: upsert.append_pairs(out[child], have[child], pair) for child, pair in pairs.items() if have[child] is not None}
        out[f"{feed}_rejects"] = out["rejects"]
        for name in tables:
            rows = sinks.conform(out[name], schema_of(name))
            if name in (*pairs, *plain):
                n, after = ledger.write_with_ids(rows, target, name, unit, schema_of(name).names[0])
            else:
                n, after = ledger.write(rows, target, name, unit), None
            counts.append((name, "loaded", n, after))
        ledger.commit(spark, target, unit, counts)
    finally:
        imports.release(out)
    return counts
