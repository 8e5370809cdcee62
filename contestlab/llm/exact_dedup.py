"""Exact deduplication by stateful streaming: disk-backed keyed state without expiry, DataFrame operations only.

Texts are equal when identical after lower-casing A-Z only; null counts as empty. Of equal texts the row with the largest
id stays (a null id is smaller than any; rows that repeat an id as well are told apart by their place).

Method. Each row becomes a small record: the SHA-256 of its normalised text, its id, and its locator (the file and the
row's index in it). The records are a stream; a streaming aggregation keyed by the digest keeps in RocksDB, without
watermark or expiry, how many rows had the digest and the largest (id, locator). When the stream has been read, the
state itself is read as a table. On hits full bytes decide: the rows whose digest came back (found by a filter of fixed size
over those digests) have their texts compared whole, pre-aggregated where they lie; a digest with two different texts (never
seen for SHA-256, and tested with short digests) is split by text. The result is made from the records and the state: texts
are read twice, and only texts that came back are shuffled.

Scale. The state is sharded by digest; a key holds about 100 bytes, however many copies it has, and memory is that of
RocksDB's cache. Micro-batches are bounded by ``MAX_BYTES`` of records. Copies are pre-aggregated in each task before any
shuffle, so a text that is a third of all rows is a few rows. Checkpoints and records lie in the shared checkpoint
folder; a lost executor's state is read back from there.

Defined cases: an empty table gives an empty result; other columns, whatever their names, are ignored here and kept by
``drop_copies``; tables made in memory, joined or put together are written first, so that their rows have a place.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize_scratch, scratch_path

_STORE = "spark.sql.streaming.stateStore."
#: The state lies in RocksDB; batches are committed as changes, and files take the space that they fill.
STATE = {
    _STORE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _STORE + "rocksdb.changelogCheckpointing.enabled": "true",
    _STORE + "rocksdb.allowFAllocate": "false",
}
#: Bytes of records that one micro-batch reads.
MAX_BYTES = 64 << 30
#: Bits of the filter for rows whose digest came back (4 MB, broadcast), and of one bitmap (what Spark's aggregate builds).
FILTER_BITS, BITMAP_BITS = 1 << 25, 1 << 15


def normalised(rows: DataFrame, text_col: str = "text") -> Column:
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


_SCAN = {"LogicalRelation", "Project", "Filter", "SubqueryAlias", "View"}


def _scans_files(docs: DataFrame) -> bool:
    """Whether each row of ``docs`` is one row of a file: a scan, perhaps filtered, and nothing that repeats or joins rows."""
    plan = getattr(docs, "_jdf", None)
    nodes = [plan.queryExecution().analyzed()] if plan is not None and docs.inputFiles() and "_metadata" not in docs.columns else []
    ok = bool(nodes)
    while ok and nodes:
        node = nodes.pop()
        ok = node.getClass().getSimpleName() in _SCAN
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return ok


def located(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``, whatever their names), ``file`` and ``at``: a stable place of each row. A table whose
    rows are not those of files (made in memory, joined, put together) is written first; call this once and use its result."""
    if _scans_files(docs):
        place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]
        return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *place)
    path = scratch_path(docs.sparkSession, "documents")
    docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).write.parquet(path)
    return docs.sparkSession.read.parquet(path).select("row", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))


def keyed_state(spark: SparkSession, log: str, digest: Column, max_bytes: int = MAX_BYTES) -> DataFrame:
    """What the stream over the written records leaves in its state: ``digest, n, keep``."""
    state, records = scratch_path(spark, "state"), spark.read.parquet(log)
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        stream = spark.readStream.schema(records.schema).option("maxBytesPerTrigger", max_bytes).parquet(log)
        kept = stream.withColumn("digest", digest).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "file", "at")).alias("keep"))
        query = kept.writeStream.outputMode("update").format("noop").option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if not records.take(1):
        return spark.createDataFrame([], kept.schema)
    found = spark.read.format("statestore").load(state)
    return found.select("key.digest", F.col("value.count").alias("n"), F.col("value.max").alias("keep"))


def _among(hits: DataFrame, key: Column) -> tuple[DataFrame, Column, Column]:
    """A filter for rows whose ``key`` may be among the digests of ``hits``: bitmaps by bucket, ``FILTER_BITS`` bits in all
    whatever the number of hits, the bucket of a row, and whether its bit is set. Others may pass, none is lost."""
    at = lambda x: F.pmod(F.xxhash64(x), F.lit(FILTER_BITS))
    part = lambda x: F.floor(at(x) / F.lit(BITMAP_BITS)).cast("int")
    bit = at(key) % F.lit(BITMAP_BITS)
    bitmaps = hits.groupBy(part(F.col("digest")).alias("part")).agg(F.bitmap_construct_agg(at(F.col("digest")) % F.lit(BITMAP_BITS)).alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return bitmaps, part(key), F.get(F.array(*[F.shiftright(byte, i) for i in range(8)]), (bit % 8).cast("int")).bitwiseAND(1) == 1


def _classes(docs: DataFrame, id_col: str, text_col: str, digest_bits: int, max_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The located rows; their records (``sha, digest, second, place``), written; and each class: ``digest, second, keep, n``,
    where ``second`` tells apart the texts of a digest that has several, else null."""
    spark = docs.sparkSession
    rows = located(docs)
    text = normalised(rows, text_col)
    digest = F.substring("sha", 1, digest_bits // 4)
    log = scratch_path(spark, "records")
    doc_id = F.col("row").getField(id_col).alias("doc_id")
    rows.select(F.sha2(text, 256).alias("sha"), F.xxhash64(F.lit(2), text).alias("second"), doc_id, "file", "at").write.parquet(log)
    place = F.struct("doc_id", "file", "at")
    records = spark.read.parquet(log).select("sha", digest.alias("digest"), "second", place.alias("place"))
    state = keyed_state(spark, log, digest, max_bytes)

    # full bytes on hits: the different texts of a digest that came back, copies pre-aggregated in each task
    hits = state.where("n > 1")
    bitmaps, part, may = _among(hits, F.substring(F.sha2("text", 256), 1, digest_bits // 4))
    found = rows.select(text.alias("text"), doc_id, "file", "at").join(F.broadcast(bitmaps.withColumnRenamed("part", "_part")), part == F.col("_part")).where(may)
    by = [F.substring(F.sha2("text", 256), 1, digest_bits // 4).alias("digest"), F.xxhash64(F.lit(2), "text").alias("second"), "text"]
    texts = found.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.max(place).alias("keep")).drop("text")
    texts = materialize_scratch(texts, "texts")
    several = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest")
    one = state.join(several, "digest", "left_anti").select("digest", F.lit(None).cast("long").alias("second"), "keep", "n")
    split = texts.join(several, "digest").select("digest", "second", "keep", "n")
    return rows, records, one.unionByName(split)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bits: int = 256, max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    _, records, classes = _classes(docs, id_col, text_col, digest_bits, max_bytes)
    r = records.withColumnsRenamed({"digest": "own", "second": "own_second"})
    return r.join(classes, (F.col("own") == F.col("digest")) & F.coalesce(F.col("second") == F.col("own_second"), F.lit(True))).select(
        F.col("place.doc_id").alias("doc_id"),
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("place").eqNullSafe(F.col("keep")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows, _, classes = _classes(docs, id_col, text_col, 256, MAX_BYTES)
    keep = classes.select("keep.file", "keep.at")
    return rows.join(keep, ["file", "at"], "left_semi").select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
