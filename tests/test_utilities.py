import os
import tempfile

import pytest
from pyspark.sql import functions as F

from feedworks.functions import cut
from feedworks.operators import metrics, sinks
from feedworks.operators.layout import spread
from feedworks.schemas import TARGETS
from feedworks.session import checkpoint_dir, materialize


def test_observe_and_partition_counts(spark):
    df = spark.range(100).withColumn("odd", F.col("id") % 2 == 1)
    observed, obs = metrics.observe(df, "load", odd=F.col("odd"))
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 100, "odd": 50}
    assert metrics.partition_counts(df.repartition(4)).agg(F.sum("rows")).first()[0] == 100
    assert round(metrics.throughput(1000, 500.0)) == 2000


def test_stage_counts(spark):
    out = metrics.stage_counts(spark.range(5), "t", {"a": F.col("id") < 3, "b": F.lit(True), "none": F.lit(None).cast("boolean")})
    assert sorted(tuple(r) for r in out.collect()) == [("t", "a", 3), ("t", "b", 5), ("t", "none", 0)]


def test_write_reports_and_targets(spark):
    d = tempfile.mkdtemp(prefix="feedworks-rep-")
    t = spark.createDataFrame([("count", 1.0)], "op string, ms double")
    sinks.write_reports({"timings": t}, d, fmt="csv")
    sinks.write_reports({"timings": t}, d + "/pq")
    assert os.path.isdir(d + "/timings") and spark.read.parquet(d + "/pq/timings").count() == 1
    for name, schema in TARGETS.items():
        assert sinks.empty_table(spark, schema).schema == schema


def test_jdbc_writer_is_configured_only(spark):
    w = sinks.jdbc_writer(spark.range(1), "jdbc:postgresql://db:5432/x", "users",
                          {"user": "u", "password": "p"}, batch_size=1000, num_partitions=6)
    assert w is not None          # no server here: never saved


def test_materialize_uses_checkpoint_dir(spark):
    path = checkpoint_dir(spark)
    df = materialize(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.count() == 10 and path


def test_a_missing_shared_folder_is_an_error():
    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_reports_keep_their_parallelism_and_layouts_read_back(spark):
    d = tempfile.mkdtemp(prefix="feedworks-rep-")
    wide = spark.range(0, 100, 1, 4)
    sinks.write_reports({"r": wide}, d)
    assert len([f for f in os.listdir(d + "/r") if f.endswith(".parquet")]) == 4
    sinks.write_reports({"one": wide}, d, files=1)
    assert len([f for f in os.listdir(d + "/one") if f.endswith(".parquet")]) == 1
    sinks.reset_targets(spark, {"users": TARGETS["users"]}, d)
    assert spark.read.parquet(d + "/users").schema.fieldNames() == TARGETS["users"].fieldNames()
    sinks.write_bucketed(wide, "feedworks_bucketed", "id", 4)
    assert spark.table("feedworks_bucketed").count() == 100
    spark.sql("DROP TABLE feedworks_bucketed")
    assert spread(wide) is wide and spread(wide, 3).rdd.getNumPartitions() == 3
    assert [r[0] for r in spark.createDataFrame([("abcdef",), ("a",), (None,)], "v string").select(cut("v", 3)).collect()] == ["abc", "a", None]
