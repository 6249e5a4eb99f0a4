"""Loads that can be repeated: every table of a load lies in a partition of its own
(``load_id=<feed>-<number>``), and one commit record is written last.

A load that stops on the way leaves no commit record.  Its repetition gets the same number
and replaces each of its partitions, so nothing is there twice; readers go by
:func:`committed` and see only what has a record.  A record holds the counts of the load
(A8, A9), one row for each table and stage, and the next free surrogate id of each
table (K14).  One writer at a time for each feed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from feedworks.operators import flatten, metrics
from feedworks.session import discard, staged

LOAD = "load_id"
COMMITS = T.StructType([T.StructField(n, t()) for n, t in (
    ("feed", T.StringType), ("number", T.LongType), ("source", T.StringType), ("batch", T.LongType), ("table", T.StringType),
    ("stage", T.StringType), ("rows", T.LongType), ("next_id", T.LongType), (LOAD, T.StringType))])


@dataclass(frozen=True)
class Load:
    """A load that has begun: its place in the order of the feed's loads, and for a stream the
    source and batch that it comes from."""
    feed: str
    number: int
    source: str | None = None
    batch: int | None = None

    @property
    def load_id(self) -> str:
        return f"{self.feed}-{self.number:012d}"


def existing(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``; None only where there is no such path.  Any other failure to
    read it is an error: taken for a first load, it would append duplicates."""
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def commits(spark: SparkSession, target: str) -> DataFrame:
    """All commit records below ``target``."""
    found = existing(spark, f"{target}/commits", COMMITS)
    return spark.createDataFrame([], COMMITS) if found is None else found


def begin(spark: SparkSession, target: str, feed: str, source: str | None = None, batch: int | None = None) -> Load | None:
    """The next load of ``feed``; None for a batch of ``source`` that has its record already."""
    own = commits(spark, target).where(F.col("feed") == feed)
    replayed = F.lit(False) if batch is None else (F.col("source") == source) & (F.col("batch") == batch)
    last, done = own.agg(F.max("number"), F.count_if(replayed)).first()
    return None if done else Load(feed, (last or 0) + 1, source, batch)


def committed(spark: SparkSession, target: str, table: str, schema: T.StructType) -> DataFrame | None:
    """The rows of ``table`` that belong to committed loads, with their ``load_id``; None where
    the table has never been written.  The join with the records prunes partitions."""
    stored = existing(spark, f"{target}/{table}", T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())]))
    if stored is None:
        return None
    done = commits(spark, target).where(F.col("table") == table).select(LOAD).distinct()
    return stored.join(done, LOAD, "left_semi").select(*schema.names, LOAD)


def check_stored(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """K1: raise an error that names the column where the table stored at ``path`` differs from
    ``schema`` in a column or its type; a table that is not there yet is no mismatch."""
    stored = existing(spark, path)
    if stored is None:
        return
    have = {f.name: f.dataType for f in stored.schema.fields if f.name != LOAD}
    for field in schema.fields:
        if field.name not in have:
            raise ValueError(f"{path}: column {field.name} is missing in the stored table")
        if have[field.name] != field.dataType:
            raise ValueError(f"{path}: column {field.name} is stored as {have[field.name].simpleString()}, "
                             f"the target has {field.dataType.simpleString()}")
    extra = [c for c in have if c not in schema.names]
    if extra:
        raise ValueError(f"{path}: column {extra[0]} is not a column of the target")


def next_id(spark: SparkSession, target: str, table: str) -> int:
    """The first surrogate id that no committed load of ``table`` has used."""
    return commits(spark, target).where(F.col("table") == table).agg(F.max("next_id")).first()[0] or 0


def path_of(target: str, table: str, load: Load) -> str:
    return f"{target}/{table}/{LOAD}={load.load_id}"


def write(df: DataFrame, target: str, table: str, load: Load) -> int:
    """Write the rows of ``load`` in ``table``, in place of what an attempt that failed may
    have left, and count them in the same pass."""
    observed, seen = metrics.observe(df, f"{load.load_id}-{table}")
    observed.write.mode("overwrite").parquet(path_of(target, table, load))
    return seen.get["rows"]


def write_with_ids(df: DataFrame, target: str, table: str, load: Load, id_name: str) -> tuple[int, int]:
    """As :func:`write`, with ids in ``id_name`` that go on where the last committed load
    ended.  Returns the number of rows and the next free id."""
    spark = df.sparkSession
    rows, path = staged(df.drop(id_name), f"ids-{table}")
    first = next_id(spark, target, table)
    n = write(flatten.with_ids(rows, id_name, first), target, table, load)
    discard(spark, path)
    return n, first + n


def commit(spark: SparkSession, target: str, load: Load, rows: list[tuple[str, str, int, int | None]]) -> None:
    """The commit record of ``load``, from (table, stage, rows, next_id): one file, so it is there
    as a whole or not at all.  From here on readers see the load."""
    records = [(load.feed, load.number, load.source, load.batch, *r) for r in rows]
    schema = T.StructType(COMMITS.fields[:-1])
    spark.createDataFrame(records, schema).coalesce(1).write.mode("overwrite").parquet(path_of(target, "commits", load))


def report(spark: SparkSession, target: str) -> DataFrame:
    """A8 / A9 of all committed loads: ``feed``, ``load_id``, ``batch``, ``table``, ``stage``, ``rows``."""
    return commits(spark, target).select("feed", LOAD, "batch", "table", "stage", "rows")
