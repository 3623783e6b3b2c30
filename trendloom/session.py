"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "trendloom", **conf) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if "spark.sql.shuffle.partitions" not in settings:
        # Start wide on a large cluster; AQE merges what turns out small.
        parts = max(200, 3 * spark.sparkContext.defaultParallelism)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a one-machine session (``local`` or ``local[...]``) without the setting gets a temporary
    folder; on a cluster a machine-local folder would lose its files with the machine, so that is
    an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="trendloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_staged: list[str] = []


def stage_path(spark: SparkSession) -> str:
    """A new path in the shared folder; ``clean_stages`` removes what was written there."""
    _staged.append(f"{shared_folder(spark)}/trendloom/{uuid.uuid4().hex}")
    return _staged[-1]


def stage(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder as Parquet now and go on from the written copy.

    For a table that several plans read: its source is scanned once, losing an executor later
    does not repeat that scan, columns and filters are still pushed down, and the size of the
    files lets Spark choose the joins.
    """
    path = stage_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean_stages(spark: SparkSession) -> None:
    """Delete every staged table of this process; call it when no frame reads them any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _staged:
        path = jvm.org.apache.hadoop.fs.Path(_staged.pop())
        path.getFileSystem(conf).delete(path, True)
