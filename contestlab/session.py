"""Session helpers: building a local session for tests and resolving the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "contestlab") -> SparkSession:
    """A local session for tests and the bench. Cluster jobs get their session from the platform instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the platform sets it to a shared (distributed) path and we only read it.
    Only in local mode, and when it is unset, as in tests, do we pick a fresh scratch folder; a cluster session without
    the setting is an error, because executors would each write to a disk of their own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions have no SparkContext handle
        sc = None
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="contestlab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder for a written intermediate table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


METHOD_CONF = "spark.sql.codegen.hugeMethodLimit"


@contextlib.contextmanager
def compiled_methods(spark: SparkSession):
    """While it lasts, stages whose generated method is too long for the JVM to compile (8,000 bytes) run as separate operators,
    whose expressions are split: a method that is only interpreted takes several times as long on wide rows."""
    before = spark.conf.get(METHOD_CONF)
    spark.conf.set(METHOD_CONF, "8000")
    try:
        yield
    finally:
        spark.conf.set(METHOD_CONF, before)


def materialize_scratch(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back: cuts the lineage so iterative
    consumers (model fits, several passes) read the stored rows instead of recomputing the plan, and a lost
    executor never re-runs the upstream stages."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with compiled_methods(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
