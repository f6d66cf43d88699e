"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the jobs are written for.  They are plain Spark options,
# so a cluster may also set them in spark-defaults.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build(app: str = "kawaraban", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    options = SETTINGS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    A session that runs all tasks on this machine and has no such setting (a
    test, a notebook) gets one folder of its own, named after the application.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(f"/tmp/checkpoints/{context.applicationId}")
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, never used before."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, session: SparkSession | None = None, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read back; ``options`` go to the Parquet writer.

    For a table several later steps read: it is computed once, its size is known
    to the planner, and a lost executor costs a read instead of the whole plan.
    ``session`` is the one that reads it and runs these steps, if it is not that of ``df``.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return (session or df.sparkSession).read.schema(df.schema).parquet(path)
