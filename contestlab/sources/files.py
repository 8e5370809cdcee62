"""File-system probes (existence, size, modification time) through Hadoop's FileSystem, so they work for any path
the cluster can read; a plain local-path fallback covers sessions without a JVM handle."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    try:
        jvm = spark._jvm  # noqa: SLF001
        conf = spark._jsc.hadoopConfiguration()  # noqa: SLF001
    except Exception:  # noqa: BLE001 - e.g. a remote session
        return None, None
    if jvm is None:
        return None, None
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(conf)


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    if fs is not None:
        return bool(fs.exists(p))
    return os.path.exists(_local(path))


def size_and_mtime(spark: SparkSession, path: str) -> tuple[int, int]:
    """Total bytes and latest modification time (ms) of a file or a folder tree."""
    p, fs = _hadoop(spark, path)
    if fs is not None:
        total, latest = 0, 0
        it = fs.listFiles(p, True)
        while it.hasNext():
            st = it.next()
            total += st.getLen()
            latest = max(latest, st.getModificationTime())
        return total, latest
    total, latest = 0, 0
    local = _local(path)
    walk = [(local, [], [""])] if os.path.isfile(local) else os.walk(local)
    for root, _, names in walk:
        for n in names:
            f = os.path.join(root, n) if n else root
            st = os.stat(f)
            total += st.st_size
            latest = max(latest, int(st.st_mtime * 1000))
    return total, latest
