"""Array helpers shared by the text operators: blocks of an Arrow text column as one byte array, word tables, and
rolling 64-bit hashes of byte or word windows.

All functions work on bounded blocks inside a task; a single text longer than a block is a block of its own. Words are
``[^\\x20\\x09-\\x0D]+`` on UTF-8 bytes (none of the separators occurs inside a multi-byte character).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_ROWS = 2000
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of texts holds: at most ``BATCH_ROWS`` rows go to Python at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by_text: bool = False) -> DataFrame:
    """``(doc_id, text, key, tag)``: null texts count as empty; ``key`` (64 bits) and ``tag`` (32 more) identify a row by
    its id and whole text, or with ``by_text`` by its text alone.

    Rows that agree in id and text are the same row repeated and always get the same answer, so these 96 bits are all
    that later joins need, also where ids are null or repeated. Where the answer depends on the text alone, ``by_text``
    brings copies together. Other columns of ``docs``, whatever their names, stay out.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    of = ["text"] if by_text else ["doc_id", "text"]
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text")).withColumn("key", F.xxhash64(*of)).withColumn("tag", F.hash(*reversed(of)))


def packed(rows: DataFrame, once_a_batch: bool = False) -> DataFrame:
    """``rows`` with ``text`` (not null) as compressed bytes, for texts that are shuffled and next read by ``text_column``.

    With ``once_a_batch`` a batch sends rows that agree in ``key`` and ``tag`` once."""

    def run(batches):
        z = zstandard.ZstdCompressor(level=1, write_checksum=False)
        for b in batches:
            if once_a_batch:
                first = {k: i for i, k in reversed(list(enumerate(zip(b.column("key").to_pylist(), b.column("tag").to_pylist(), strict=True))))}
                b = b.take(pa.array(sorted(first.values()), pa.int64()))
            i = b.schema.get_field_index("text")
            text = pa.array([z.compress(t) for t in b.column(i).cast(pa.large_binary()).to_pylist()], pa.binary())
            yield b.set_column(i, "text", text)

    schema = T.StructType([T.StructField("text", T.BinaryType()) if f.name == "text" else f for f in rows.schema])
    return rows.mapInArrow(run, schema)


def text_column(b: pa.RecordBatch) -> pa.Array:
    """The texts of a batch, unpacked where they are compressed."""
    col = b.column("text")
    if not pa.types.is_binary(col.type):
        return col
    z = zstandard.ZstdDecompressor()
    return pa.array([z.decompress(t) for t in col.to_pylist()], pa.large_binary())


@dataclass
class Block:
    """Some consecutive rows of a batch: ``rows`` (lo, hi), their bytes, and the offset of each row's first byte."""

    lo: int
    hi: int
    data: np.ndarray
    off: np.ndarray


def blocks(column: pa.Array, max_bytes: int = 4 << 20) -> Iterator[Block]:
    """Cut a text column into blocks of at most ``max_bytes`` bytes, or one text."""
    column = column.fill_null("").cast(pa.large_string()) if not pa.types.is_large_binary(column.type) else column
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1)
        yield Block(lo, hi, raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values: all bits of the result depend on all bits of the input."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_powers = (np.ones(1, _U), np.ones(1, _U))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        out = []
        for base in (_BASE, _BASE_INV):
            p = np.full(n, base, _U)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers = tuple(out)
    return _powers


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``window_hash`` reads the hash of any window of ``values`` (64-bit, already scrambled)."""
    out = np.zeros(len(values) + 1, _U)
    np.cumsum(values * powers(len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def window_hash(prefix: np.ndarray, start: np.ndarray, length) -> np.ndarray:
    return mix((prefix[start + length] - prefix[start]) * powers(len(prefix))[1][start])


def byte_values(seed: int) -> np.ndarray:
    """A scrambled 64-bit value for each byte."""
    return mix((np.arange(256, dtype=_U) + _U(1)) * _U(0xD6E8FEB86659FD93) + _U(seed))


_BYTES = byte_values(7)


@dataclass
class Words:
    """The words of a block in order: byte range, row within the block, hash; ``first[r]`` is row ``r``'s first word."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def position(self) -> np.ndarray:
        """Of each word within its row."""
        return np.arange(len(self.row)) - self.first[self.row]


def words(block: Block, piece: int = 1 << 20) -> Words:
    """Word table of a block; hashing goes piece by piece, cut at separators."""
    data, off = block.data, block.off
    n, rows = len(data), len(off) - 1
    inside = ~_SEPARATOR[data]
    left = np.empty(n, bool)
    left[1:] = ~inside[:-1]
    right = np.empty(n, bool)
    right[:-1] = ~inside[1:]
    if n:
        left[0] = right[-1] = True
    edge = off[(off > 0) & (off < n)]
    left[edge] = True
    right[edge - 1] = True
    start, end = np.flatnonzero(inside & left), np.flatnonzero(inside & right) + 1
    row = np.searchsorted(off, start, "right") - 1
    h = np.empty(len(start), _U)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + piece, "right")))
        base = start[i]
        p = prefix_hash(_BYTES[data[base : end[j - 1]]])
        h[i:j] = window_hash(p, start[i:j] - base, end[i:j] - start[i:j])
        i = j
    return Words(start, end, row, h, np.searchsorted(row, np.arange(rows + 1)))


def runs(mask: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the maximal runs of True; a run also ends before each index in ``breaks``."""
    m = mask.astype(np.int8)
    first = np.empty(len(m), bool)
    last = np.empty(len(m), bool)
    if len(m):
        first[0], last[-1] = mask[0], mask[-1]
        first[1:] = mask[1:] & ~mask[:-1]
        last[:-1] = mask[:-1] & ~mask[1:]
        if breaks is not None:
            b = breaks[(breaks > 0) & (breaks < len(m))]
            first[b] |= mask[b]
            last[b - 1] |= mask[b - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1 - start


def covered(n: int, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in at least one of the ranges."""
    d = np.bincount(start, minlength=n + 1) - np.bincount(start + length, minlength=n + 1)
    return np.cumsum(d[:n]) > 0


def once(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 64-bit keys (a tuple per place): a mask of the places whose key occurs once, and one place of each other key."""
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys)
    same = np.zeros(len(order) + 1, bool)
    if len(order) > 1:
        eq = np.ones(len(order) - 1, bool)
        for k in keys:
            s = k[order]
            eq &= s[1:] == s[:-1]
        same[1:-1] = eq
    single = np.zeros(len(order), bool)
    single[order[~same[:-1] & ~same[1:]]] = True
    return single, order[~same[:-1] & same[1:]]
