"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "ledgerlens", master: str | None = None, **options: str) -> SparkSession:
    """Session with adaptive execution on; cluster settings win when they are already given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Saves a stack walk per column expression while plans are built.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **options,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by the cluster.

    A folder of this machine is used only when the session itself is local.
    """
    named = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="ledgerlens-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """New, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Later passes read only the columns they need, lost executors cost a re-read rather than a
    recomputation, and every pass sees the same rows.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
