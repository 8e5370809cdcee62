"""Reading the stored tables and persisting intermediates (parquet in, parquet out)."""

from __future__ import annotations

import math
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import compiled_methods


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one parquet table; selecting ``columns`` here lets the scan read only those columns."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only after checking it holds at most ``max_rows`` rows; otherwise leave the join to Spark.

    Only used for dimensions (a few dozen team or nation rows). The check reads at most ``max_rows + 1`` rows.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


#: Rows of a shuffled table that a task should hold: its sorts and windows of them take some hundred MB at most.
TASK_ROWS = 1 << 18
MAX_TASKS = 1 << 16


def shuffle_tasks(stored: DataFrame, times: int = 1) -> int | None:
    """Partitions for a shuffle of ``times`` as many rows as a stored table has (its files' footers tell): ``TASK_ROWS`` each.
    The session's number is fixed while tables grow; where it is enough, None: that plan stays, and small partitions merge."""
    need = min(MAX_TASKS, math.ceil(times * stored.count() / TASK_ROWS))
    return need if need > int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def deal(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """``df`` shuffled by the keys into ``tasks`` partitions, which a join or aggregate by the keys keeps; unchanged for None."""
    return df.repartition(tasks, *keys) if tasks else df


def save(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """``saveRDS`` equivalent: overwrite a parquet table, optionally partitioned (e.g. by season)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with compiled_methods(df.sparkSession):
        w.parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """``readRDS`` equivalent."""
    return spark.read.parquet(path)


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame], partition_by: list[str] | None = None) -> DataFrame:
    """Read-or-build: return the stored table at ``path``; build, write and re-read it when it is missing.

    Re-reading the written table also cuts the lineage, so a lost executor never recomputes the build.
    """
    from .files import exists

    if not exists(spark, path + "/_SUCCESS"):  # a folder without the commit marker is an unfinished build: rebuild it
        save(build(), path, partition_by)
    return load(spark, path)
