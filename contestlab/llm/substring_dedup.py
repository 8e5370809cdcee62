"""Substring deduplication over words with difference-cover anchors.

A window is ``length`` consecutive words of one document. Every word covered by a window whose word sequence also
starts anywhere else (another document, or another place of the same one) is removed; windows are judged on the input.

Method. Let ``D`` be a difference cover modulo ``v``: each remainder is a difference of two of its members. For any two
places ``i`` and ``j`` there is then an offset below ``v`` at which both are cover positions. So two equal windows of
``length`` words always share an aligned anchor of ``length - v + 1`` words that starts at a cover position of either
document, and only the anchors at cover positions are hashed and shuffled (``len(D) / v`` of all places). Places whose
anchor occurs twice extend to the windows that contain it, and only those windows are compared, by 96-bit hashes of
their whole word sequence.

Scale. One shuffle for anchors, one for candidate windows, one of the texts (read twice). Repeats inside a task's block
are settled there: the block sends one witness for a key that it holds several times, so a key that is in a third of
all documents reaches its reducer once per block and not once per document. Nothing is broadcast or collected.

Defined cases: null text counts as empty (no words, nothing removed, hash of the empty text); rows repeated with the
same id and text are separate documents, so their windows repeat; a null id is an id like any other; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._text import blocks, covered, keyed, mix, once, packed, prefix_hash, small_batches, text_column, window_hash, words

LENGTH = 35
#: Perfect difference sets (period: members).
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}
#: Bytes of text whose anchors or windows are compared inside the task before they are sent.
FLUSH_BYTES = 32 << 20

_U = np.uint64
#: What does not change from row to row of a document comes first: shuffled rows compress well.
_SENT = "n int, len int, tag int, key long, h long, x long"


class Outbox:
    """Collects keys with their places; ``flush`` settles repeats among them and yields Arrow batches of ``_SENT``.

    The key is ``h`` (64 bits) and, where ``wide``, the low half of ``x``; the high half is then the position, else ``x`` is
    (the order in which rows compress best). A key seen once goes out with its place and ``n = 1``. A key
    seen more often goes out once without a place and with ``n = 2``, and each run of its places goes out under a key of
    its own with ``n = 2``: known to repeat, spread evenly.
    """

    def __init__(self, wide: bool) -> None:
        self.wide = wide
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.bytes = 0

    def add(self, h, g, key, tag, pos, size: int) -> None:
        if len(h):
            self.parts.append((h, (g >> _U(32)).astype(np.uint32), key, tag, pos))
        self.bytes += size

    def flush(self):
        if self.parts:
            h, g, key, tag, pos = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            single, witness = once(h, g)
            yield self._batch(h[single], g[single], key[single], tag[single], pos[single], 1, 1)
            yield self._batch(h[witness], g[witness], None, None, None, 0, 2)
            known = np.flatnonzero(~single)
            if len(known):
                order = known[np.lexsort((pos[known], tag[known], key[known]))]
                a, b, p = key[order], tag[order], pos[order]
                new = np.ones(len(order), bool)
                new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (p[1:] > p[:-1] + 1)
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(order)) - 1
                own = mix(a[first].view(_U) ^ mix(p[first].astype(_U)))
                yield self._batch(own, mix(own).astype(np.uint32), a[first], b[first], p[first], p[last] - p[first] + 1, 2)
        self.parts, self.bytes = [], 0

    def _batch(self, h, g, key, tag, pos, length, n) -> pa.RecordBatch:
        size = len(h)
        x = np.zeros(size, np.int64) if pos is None else pos.astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(size, n, np.int32)),
                pa.array(np.broadcast_to(np.asarray(length, np.int32), size)),
                pa.nulls(size, pa.int32()) if tag is None else pa.array(tag),
                pa.nulls(size, pa.int64()) if key is None else pa.array(key),
                pa.array(h.view(np.int64)),
                pa.array(x << 32 | g.astype(np.int64) if self.wide else x),
            ],
            names=["n", "len", "tag", "key", "h", "x"],
        )


def _anchors(length: int, period: int, cover: tuple[int, ...]):
    size = length - period + 1
    members = np.zeros(period, bool)
    members[list(cover)] = True

    def run(batches):
        out = Outbox(wide=False)
        for b in batches:
            key = b.column("key").to_numpy()
            for k in blocks(text_column(b)):
                w = words(k)
                count = np.diff(w.first)
                pos = w.position
                at = np.flatnonzero(members[pos % period] & (pos + size <= count[w.row]) & (count[w.row] >= length))
                h = window_hash(prefix_hash(w.hash), at, size)
                # 64 bits and no tag do for anchors: a false match only adds a candidate
                out.add(h, np.zeros(len(h), _U), key[k.lo + w.row[at]], np.zeros(len(h), np.int32), pos[at], len(k.data))
                if out.bytes >= FLUSH_BYTES:
                    yield from out.flush()
        yield from out.flush()

    return run


def hits(b: pa.RecordBatch, k, tagged: bool):
    """Rows (within the block), positions and lengths of the listed places of a block's rows; with ``tagged`` only those
    that carry the row's tag."""
    row = pa.compute.list_parent_indices(b.column("at")).to_numpy()
    at, length = (pa.compute.list_flatten(b.column(c)).to_numpy() for c in ("at", "len"))
    lo, hi = np.searchsorted(row, [k.lo, k.hi])
    row, at, length = row[lo:hi], at[lo:hi], length[lo:hi].astype(np.int64)
    own = b.column("tag").to_numpy()[row] == at >> 32 if tagged else np.ones(len(row), bool)
    return row[own] - k.lo, at[own] & 0x7FFFFFFF, length[own]


def _windows(length: int, period: int):
    def run(batches):
        out = Outbox(wide=True)
        for b in batches:
            key, tag = (b.column(c).to_numpy() for c in ("key", "tag"))
            for k in blocks(text_column(b)):
                w = words(k)
                row, pos, size = hits(b, k, False)
                lo = w.first[row] + np.maximum(0, pos - (period - 1))
                hi = np.minimum(w.first[row] + pos + size, w.first[row + 1] - length + 1)
                at = np.flatnonzero(covered(len(w.row), lo, np.maximum(0, hi - lo)))
                h = window_hash(prefix_hash(w.hash), at, length)
                g = window_hash(prefix_hash(mix(w.hash + _U(0x5851F42D4C957F2D))), at, length)
                r = k.lo + w.row[at]
                out.add(h, g, key[r], tag[r], w.position[at], len(k.data))
                if out.bytes >= FLUSH_BYTES:
                    yield from out.flush()
        yield from out.flush()

    return run


def repeated(sent: DataFrame, wide: bool) -> DataFrame:
    """Places ``(key, tag, pos, len)`` whose key occurs at least twice."""
    low = F.col("x").bitwiseAND(F.lit(0xFFFFFFFF))
    sent = sent.withColumn("g", low if wide else F.lit(0)).withColumn("pos", F.shiftright("x", 32) if wide else low)
    total = F.sum("n").over(Window.partitionBy("h", "g") if wide else Window.partitionBy("h"))
    return sent.withColumn("total", total).where((F.col("total") >= 2) & F.col("key").isNotNull()).select("key", "tag", "pos", "len")


def listed(places: DataFrame) -> DataFrame:
    """Places by row key, as two parallel lists: tag and position in one number, and length."""
    at = F.shiftleft(F.col("tag").cast("long"), 32).bitwiseOR(F.col("pos").cast("long"))
    return places.groupBy("key").agg(F.collect_list(at).alias("at"), F.collect_list("len").alias("len"))


def _keep(length: int, texts: bool):
    def run(batches):
        for b in batches:
            ids, n_words, n_removed, sha, kept_text = [], [], [], [], []
            for k in blocks(text_column(b)):
                w = words(k)
                row, pos, size = hits(b, k, True)
                gone = covered(len(w.row), w.first[row] + pos, size + length - 1)
                kept = np.flatnonzero(~gone)
                size = w.end[kept] - w.start[kept] + 1  # each kept word and a space
                sums = np.concatenate([[0], np.cumsum(size)])
                source = np.arange(sums[-1]) + np.repeat(w.start[kept] - sums[:-1], size)
                flat = np.append(k.data, np.uint8(32))[source]
                flat[sums[1:] - 1] = 32
                bound = sums[np.searchsorted(kept, w.first)]
                for r in range(k.hi - k.lo):
                    text = flat[bound[r] : max(bound[r], bound[r + 1] - 1)].tobytes()
                    n_words.append(int(w.first[r + 1] - w.first[r]))
                    n_removed.append(int(gone[w.first[r] : w.first[r + 1]].sum()))
                    sha.append(hashlib.sha256(text).hexdigest())
                    if texts:
                        kept_text.append(text.decode())
            cols = [b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if texts:
                cols, names = [*cols, pa.array(kept_text, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def substring_dedup(
    docs: DataFrame, length: int = LENGTH, period: int | None = None, id_col: str = "doc_id", text_col: str = "text", texts: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256`` (and ``kept_text`` with ``texts``)."""
    period = period or max(p for p in COVERS if p <= max(3, 0.6 * length))
    cover = COVERS[period]
    if len({(a - b) % period for a in cover for b in cover}) != period or period > length:
        raise ValueError(f"{cover} is no difference cover modulo {period} for windows of {length}")
    small_batches(docs.sparkSession)
    plain = keyed(docs, id_col, text_col, by_text=True)  # copies have the same words removed
    rows = packed(plain)
    anchors = plain.select("key", "text").mapInArrow(_anchors(length, period, cover), _SENT)
    windows = rows.join(listed(repeated(anchors, False)), "key").mapInArrow(_windows(length, period), _SENT)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts
    return rows.join(listed(repeated(windows, True)), "key", "left").mapInArrow(_keep(length, texts), schema)
