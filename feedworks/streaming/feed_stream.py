"""Incremental feed import with Structured Streaming.

New CSV files landing in a folder are picked up as micro-batches.  Each batch is a load
like any other (``feedworks.plans.load.load_feed``), into the same tables and layout as batch
loads: keep-first against what is committed already, ids that go on, counts and rejects.

The commit record names the checkpoint and the batch.  A batch that is replayed after a
failure finds its record and does nothing; one that broke off before its record replaces
what it left.  So every batch counts once (A8, A9: ``operators.ledger.report``).  The
checkpoint goes to the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedworks.operators import ledger
from feedworks.operators.ledger import existing  # noqa: F401
from feedworks.plans.load import FEEDS, load_feed
from feedworks.schemas import CORRUPT_COLUMN, raw_schema
from feedworks.session import checkpoint_dir
from feedworks.sources.csv_feed import (LINE, ONE_CELL, Feed, split_lines, split_records, whole_line,
                                        with_order)


def _batch_feed(batch: DataFrame, columns: list[str]) -> Feed:
    # Row positions can only be numbered on the static batch, not in the stream.
    numbered = with_order(batch, True, F.col("_file"), F.col("_block")).drop("_file", "_block")
    return split_lines(numbered, columns) if LINE in batch.columns else split_records(numbered, columns)


def load_batch(spark: SparkSession, batch: DataFrame, batch_id: int, feed: str, target: str,
               users: str | None = None, source: str = "stream") -> bool:
    """Load one micro-batch of raw feed rows into the targets under ``target``; False for one
    that ``source`` has loaded already.  ``users`` is the folder of the loaded users, which
    the authors of recipes must be among (Q11), where they are not in the target's own."""
    unit = ledger.begin(spark, target, feed, source, batch_id)
    if unit is None:
        return False
    extra = {"users": spark.read.parquet(users)} if users and feed == "recipes" else {}
    load_feed(spark, feed, _batch_feed(batch, FEEDS[feed][0]), target, unit, persist=True, **extra)
    return True


def start(spark: SparkSession, source_dir: str, target: str, feed: str = "users",
          checkpoint: str | None = None, available_now: bool = True,
          max_files_per_trigger: int | None = None, multi_line: bool = False,
          users: str | None = None):
    """Start the incremental import of ``feed`` files under ``source_dir``.

    ``available_now`` processes what is there in bounded batches and stops (the
    scheduled-job mode); otherwise the query keeps running with default triggers.
    A record is a line unless ``multi_line`` is set (then each file is read by one task).
    Recipes are checked against the users in the folder ``users``.  Returns the
    ``StreamingQuery``.
    """
    columns = FEEDS[feed][0]
    reader = (spark.readStream.option("header", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COLUMN))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if multi_line:
        stream = (reader.schema(raw_schema(columns)).option("multiLine", True).option("quote", '"').option("escape", '"')
                  .option("ignoreLeadingWhiteSpace", True).csv(source_dir))
        cells = [*columns, CORRUPT_COLUMN]
    else:
        stream = reader.schema(f"{LINE} string, {CORRUPT_COLUMN} string").options(**ONE_CELL).csv(source_dir)
        cells = [whole_line().alias(LINE)]
    stream = stream.select(*cells, F.col("_metadata.file_path").alias("_file"),
                           F.col("_metadata.file_block_start").alias("_block"))
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), f"feedworks-stream-{feed}")
    writer = (stream.writeStream.foreachBatch(
        lambda df, batch_id: load_batch(spark, df, batch_id, feed, target, users, ckpt))
        .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
