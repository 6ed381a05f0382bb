"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# The road network's local zone; intervals, days and hours are read in it.
LOCAL_ZONE = "Asia/Ho_Chi_Minh"


def build_session(
    app_name: str = "kerbside",
    master: str | None = None,
    time_zone: str = LOCAL_ZONE,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the layers rely on; ``conf`` wins over the defaults.

    Executor counts, memory and shuffle parallelism belong to the cluster's own
    configuration, so none are set here: AQE coalesces or splits from there.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": time_zone,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session that names none (tests, a laptop) gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current is not None:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="kerbside-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as Parquet in the shared folder, read from there: for small frames whose size Spark should know."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read on from there.

    Used where rows must not be recomputed differently (numbering) or where a
    loop would otherwise grow the lineage (forecast steps).
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
