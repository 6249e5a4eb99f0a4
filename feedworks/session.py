"""Session construction and lineage helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every feedworks job relies on.  The session zone is pinned to UTC so that
# instant -> date conversion (C11) does not depend on the host.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "feedworks",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Return a session with the feedworks base settings.

    On a cluster pass ``master=None`` and let spark-submit decide; tests pass
    ``local[*]``.  ``spark.sql.shuffle.partitions`` is only set when asked: on a
    large cluster AQE coalescing starts from the cluster's own setting.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(key, conf[key])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    There is no folder of our own to fall back to: on a cluster each machine would
    write to its own disk.  Tests set the setting themselves.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used where one cleaned DataFrame feeds several outputs and recomputing the scan
    after an executor loss would be costly.  Never a local checkpoint.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster names in ``spark.checkpoint.dir``.  There is no
    folder of our own to fall back to, as on a cluster that would be each machine's own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/feedworks-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, and its path.  What is read twice from
    there is the same rows in the same files both times, also in a repeated task."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`staged` or :func:`shared_path` gave."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
