"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Scratch folder of a local session that names none, as in tests.
LOCAL_SCRATCH = "/tmp/checkpoints"
_written: list[str] = []
# Removes a query's shuffle files at its end; Spark before 4.1 takes no notice of it.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "wardlight", **extra: str) -> SparkSession:
    """A session with the settings the plans are written for.

    ``master`` and ``shuffle_partitions`` stay unset on a cluster, where the
    submitter decides; AQE coalesces small shuffles and splits skewed joins.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Finding the calling line of every column expression doubles the time
        # it takes to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Split a skewed join even where that costs a further exchange: one
        # patient may hold a large share of the encounters.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the folder that every executor can reach.

    The cluster names the folder in ``spark.checkpoint.dir``. Only a local
    session that names none, as in tests, gets one of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = LOCAL_SCRATCH
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def settled(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written once to shared storage and read back.

    For an intermediate result that several branches of a plan read: it is
    computed once, survives the loss of executors, and its real size is known
    to the planner. The write runs when this is called, so a plan that settles
    something does part of its work while it is being built.
    """
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def settled_alone(frame: DataFrame, label: str) -> DataFrame:
    """:func:`settled`, and the shuffle files behind it are removed when it is written.

    Otherwise they stay until the driver happens to collect its garbage. For large
    shuffles: nothing reads them again, since what was written takes their place.
    """
    conf = frame.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return settled(frame, label)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)


def file_system(spark: SparkSession, path: str):
    """A path and the Hadoop file system that it is on."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder on any storage that Spark reaches."""
    where, files = file_system(spark, path)
    return files.delete(where, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; a folder that is not there has none."""
    where, files = file_system(spark, path)
    return [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []


def release_scratch(spark: SparkSession) -> int:
    """Remove every folder that this process has settled; returns how many.

    Call it when the results that were built on them have been written:
    frames that still read a settled folder fail afterwards.
    """
    removed = 0
    while _written:
        removed += remove_path(spark, _written.pop())
    return removed
