"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "panelcast", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are designed for.

    AQE coalesces small shuffle partitions and splits skewed join partitions. Only the exchange that
    packs series has a partition count of its own, taken from the points of the panel.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # A record is a whole series, so batches are counted in far fewer records.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        # Saves several driver round trips per column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read: the one named in ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it uses the warehouse folder.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/panelcast/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back.

    Used where one table feeds several jobs (iterative training), so the raw scan is not
    repeated and a lost executor costs one file read instead of a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
