"""Read-or-build of the adapter tables, stored once per input snapshot in the shared checkpoint folder and
bucketed by ``contest_id``.

``contests`` and ``plays`` feed most queries, often several times inside one plan (a bucketed scan reads its input
twice; offence and defence both read plays). Building them means shuffle joins of the large source tables, so they
are written once and read back, the way a pipeline keeps its intermediate tables. The folder name carries a
fingerprint of the source files (path, size, modification time) and of the adapter code, so changed inputs or
rules get a fresh build; a lost
executor re-reads the stored table instead of re-running the joins.
"""

from __future__ import annotations

import hashlib
import math
import os
import threading

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from . import adapters, files
from .tables import read_table, table_path

CONTEST_SOURCES = ("orders", "customer", "nation")
PLAY_SOURCES = ("orders", "customer", "nation", "lineitem")


def _code_version() -> str:
    """Hash of the adapter rules, so a changed mapping never reads tables built by an older one."""
    with open(adapters.__file__, "rb") as fh:
        return hashlib.sha1(fh.read()).hexdigest()[:12]


def _fingerprint(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> str:
    parts = []
    for n in names:
        total, latest = files.size_and_mtime(spark, table_path(sf_dir, n))
        parts.append(f"{n}:{total}:{latest}")
    key = sf_dir + "|" + _code_version() + "|" + "|".join(parts)
    return hashlib.sha1(key.encode()).hexdigest()[:16]


#: Source rows of a bucket. A task sorts a bucket and holds its windows, so this bounds its memory; compressed bytes would
#: not, since they tell little of the rows. A contest has about four plays, so that both tables get the same buckets.
BUCKET_ROWS = {"orders": 1 << 16, "lineitem": 1 << 18}


#: Spark accepts at most 100,000 buckets.
MAX_BUCKETS = 1 << 16

_ROWS: dict[str, int] = {}  # rows by table and its fingerprint


def _rows(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Rows of a source table, from its files' footers."""
    key = f"{name}-{_fingerprint(spark, sf_dir, (name,))}"
    if key not in _ROWS:
        _ROWS[key] = read_table(spark, sf_dir, name).count()
    return _ROWS[key]


def _n_buckets(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> int:
    """Bucket count from the source rows: ``BUCKET_ROWS`` a bucket at most, a power of two, 8 to ``MAX_BUCKETS`` (above
    16 billion plays the buckets grow instead)."""
    need = max(math.ceil(_rows(spark, sf_dir, n) / BUCKET_ROWS[n]) for n in names if n in BUCKET_ROWS)
    b = 8
    while b < need and b < MAX_BUCKETS:
        b *= 2
    return b


READ_ROWS = 1 << 20  # rows of the largest source that a reading task of a build takes, and holds as it shuffles them
MAX_READ_BYTES = 32 << 20
SPLIT_CONF = "spark.sql.files.maxPartitionBytes"


def _split_bytes(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> int:
    """Bytes of a reading task that hold about ``READ_ROWS`` rows, 1 to 32 MB."""
    found = [(_rows(spark, sf_dir, n), files.size_and_mtime(spark, table_path(sf_dir, n))[0]) for n in names if n in BUCKET_ROWS]
    return min(MAX_READ_BYTES, max(1 << 20, min(READ_ROWS * size // max(1, rows) for rows, size in found)))


_LOCK = threading.RLock()  # re-entrant: building plays reads (or builds) contests


def _bucketed(spark: SparkSession, root: str, name: str, build, n: int, split_bytes: int, sort_by: list[str]) -> DataFrame:
    """Read-or-build a table bucketed by ``contest_id``: every later aggregate or window keyed by the contest reads
    it without a shuffle. The catalog entry is session state, so an existing folder is registered again by DDL."""
    with _LOCK:  # queries may be started from several driver threads
        return _bucketed_locked(spark, root, name, build, n, split_bytes, sort_by)


def _bucketed_locked(spark: SparkSession, root: str, name: str, build, n: int, split_bytes: int, sort_by: list[str]) -> DataFrame:
    if not spark.catalog.tableExists(name):
        if files.exists(spark, root + "/_SUCCESS"):
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(root).schema.fields)
            spark.sql(
                f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY (contest_id) SORTED BY ({', '.join(sort_by)}) "
                f"INTO {n} BUCKETS LOCATION '{root}'"
            )
        else:  # one task per bucket, hence one file per bucket
            rows = build().repartition(n, "contest_id")
            before = spark.conf.get(SPLIT_CONF)
            spark.conf.set(SPLIT_CONF, str(split_bytes))
            try:
                rows.write.mode("overwrite").format("parquet").bucketBy(n, "contest_id").sortBy(*sort_by).option("path", root).saveAsTable(name)
            finally:
                spark.conf.set(SPLIT_CONF, before)
    return spark.table(name)


NAMESPACE_CONF = "contestlab.prepared.namespace"


def _location(spark: SparkSession, what: str, fp: str, n: int) -> tuple[str, str]:
    ns = spark.conf.get(NAMESPACE_CONF, "shared")
    root = os.path.join(ensure_checkpoint_dir(spark), "prepared", ns, f"{what}-{fp}-b{n}")
    return root, f"{what}_{ns}_{fp}_b{n}".replace("-", "_")


def contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _n_buckets(spark, sf_dir, CONTEST_SOURCES)
    root, name = _location(spark, "contests", _fingerprint(spark, sf_dir, CONTEST_SOURCES), n)
    return _bucketed(spark, root, name, lambda: adapters.contests(spark, sf_dir), n,
                     _split_bytes(spark, sf_dir, CONTEST_SOURCES), ["contest_id"])


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _n_buckets(spark, sf_dir, PLAY_SOURCES)
    root, name = _location(spark, "plays", _fingerprint(spark, sf_dir, PLAY_SOURCES), n)
    return _bucketed(spark, root, name, lambda: adapters.plays(spark, sf_dir, contests(spark, sf_dir)), n,
                     _split_bytes(spark, sf_dir, PLAY_SOURCES), ["contest_id", "play_id"])


def _file_hash(path: str) -> str:
    with open(path, "rb") as fh:
        return hashlib.sha1(fh.read()).hexdigest()[:12]


def stored(spark: SparkSession, sf_dir: str, name: str, modules: tuple, build) -> DataFrame:
    """Read-or-build of a table derived from the contests: once per contests snapshot and version of the modules."""
    from .tables import materialize

    version = hashlib.sha1("".join(_file_hash(m.__file__) for m in modules).encode()).hexdigest()[:12]
    ns = spark.conf.get(NAMESPACE_CONF, "shared")
    root = os.path.join(ensure_checkpoint_dir(spark), "prepared", ns, f"{name}-{_fingerprint(spark, sf_dir, CONTEST_SOURCES)}-{version}")
    with _LOCK:
        return materialize(spark, root, build)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elo ratings contest by contest (default parameters, full precision); rounding is left to the caller."""
    from ..operators import ratings as rating_ops

    return stored(spark, sf_dir, "elo", (rating_ops,), lambda: rating_ops.elo_ratings(contests(spark, sf_dir), digits=None))


def period_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elo ratings by week (default parameters, full precision); rounding is left to the caller."""
    from ..operators import ratings as rating_ops

    return stored(spark, sf_dir, "period_elo", (rating_ops,), lambda: rating_ops.period_ratings(contests(spark, sf_dir)))


def record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running record with margins, read by every query that lags, carries or averages it."""
    from ..operators import records, scan

    return stored(spark, sf_dir, "record", (records, scan), lambda: records.with_margin(records.team_record(contests(spark, sf_dir))))
