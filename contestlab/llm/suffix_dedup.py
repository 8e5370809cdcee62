"""Exact substring deduplication over bytes by threshold-bounded interval expansion on Burrows-Wheeler transforms.

Every byte covered by a ``length``-byte string that also starts anywhere else (another document, or another place of the
same one) is removed; strings are judged on the input.

Method. Windows that can be equal are brought together by content, and each group's text gets a Burrows-Wheeler
transform. From the intervals of short strings, breadth-first backward extension (prepending one byte a level) sets the
common-prefix value of each border between neighbouring suffixes the first time an interval ends there: values come in
increasing order, an interval whose border is already set is not expanded, and expansion stops at ``length``. Borders
still unset then have a common prefix of at least ``length``, so the suffixes between set borders are the occurrences of
one string; a string with two or more is repeated.

How windows come together. Each window's anchor is its least ``ANCHOR``-byte hash (leftmost of equal ones), a function of
the window's content. Consecutive starts with the same anchor form a run; runs are cut every ``STEP`` offsets from the
anchor, so all windows of a run share a core of ``length - STEP + 1`` bytes, and the core's hash is the group. Equal
windows have equal anchors, offsets and cores, hence meet in one group, and almost only true repeats do. Identical runs
are pre-aggregated into one weighted string before any text moves.

Scale. Shuffles: run descriptors (about one per 110 bytes of text), the texts of documents once, and the bytes of groups
with two different strings. Groups of copies of any size arrive as one weighted string. A group of more than
``GROUP_STRINGS`` different strings (a passage in very many documents, each with other words around it) is not indexed in
one task: its windows are compared one by one, by 96-bit hashes of all their bytes, spread evenly over tasks. Nothing is
broadcast or collected.

Defined cases: null text counts as empty; texts shorter than ``length`` lose nothing; rows repeated with the same id and
text are separate documents; ids may be null; other columns are ignored; an empty table gives an empty result; texts of
any length are cut into overlapping pieces.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize_scratch
from ._text import _BYTES, Block, blocks, covered, keyed, mix, once, packed, prefix_hash, runs, small_batches, text_column, window_hash
from .substring_dedup import _SENT, FLUSH_BYTES, Outbox, hits, listed, repeated

LENGTH = 400
ANCHOR = 64
STEP = 128
#: Different strings of one group that are indexed in one task.
GROUP_STRINGS = 4096
#: Bytes that one transform is built over, but for the last group that is put in.
INDEX_BYTES = 3 << 19
#: Separates strings; never a byte of UTF-8.
END = 255
_SEED = 8

_U = np.uint64
_PLACE = "h long, g long, key long, tag int, pos int, len int, n int"


# ------------------------------------------------------------------------------------------------ index of one task


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``text`` ordered by their first ``depth`` bytes or more, by prefix doubling from 8 bytes; and the 8-byte
    prefixes in that order."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(_SEED, np.uint8)]).astype(_U)
    key = np.zeros(n, _U)
    for i in range(_SEED):
        key = (key << _U(8)) | padded[i : n + i]
    order = np.argsort(key)
    first = key[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.concatenate([[True], first[1:] != first[:-1]]))
    size = _SEED
    while size < depth and rank.max() < n:
        pair = rank * (n + 1)
        pair[: max(0, n - size)] += rank[size:]
        order = np.argsort(pair)
        sorted_pair = pair[order]
        rank[order] = np.cumsum(np.concatenate([[True], sorted_pair[1:] != sorted_pair[:-1]]))
        size *= 2
    return order, key[order]


def borders(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order of ``text`` and, for each place in it, whether its common prefix with the one before is shorter
    than ``length``. Strings end with ``END``; strings with an ``END`` before their last byte are not expanded."""
    n = len(text)
    order, seed = suffix_order(text, length)
    bwt = text[order - 1]
    to = np.empty(n, np.int64)
    to[np.argsort(bwt, kind="stable")] = np.arange(n)

    prefix = np.full(n + 1, -1, np.int32)  # unset
    prefix[0] = prefix[n] = 0
    differ = seed[1:] ^ seed[:-1]
    at = np.flatnonzero(differ) + 1
    d = differ[at - 1]
    prefix[at] = sum((d < _U(1 << (8 * (_SEED - i)))).astype(np.int32) for i in range(1, _SEED))

    # intervals of the 8-byte strings whose right border was set last, without END but in last place
    left = np.concatenate([[0], at])
    right = np.concatenate([at, [n]])
    value = seed[left]
    inner = np.zeros(len(left), bool)
    for i in range(1, _SEED):
        inner |= (value >> _U(8 * i)) & _U(255) == _U(END)
    live = (prefix[right] == _SEED - 1) & ~inner & (right < n)
    left, right = left[live], right[live]
    for level in range(_SEED, length):
        if not len(left):
            break
        size = right - left
        ends = np.cumsum(size)
        row = np.arange(ends[-1]) + np.repeat(left - (ends - size), size)
        byte = bwt[row]
        owner = np.repeat(np.arange(len(left)), size)
        ok = byte != END
        row, tag = row[ok], owner[ok] * 256 + byte[ok]
        if not len(row):
            break
        by = np.argsort(tag, kind="stable")
        row, tag = row[by], tag[by]
        new = np.flatnonzero(np.concatenate([[True], tag[1:] != tag[:-1]]))
        left = to[row[new]]
        right = to[row[np.append(new[1:], len(row)) - 1]] + 1
        unset = prefix[right] < 0
        left, right = left[unset], right[unset]
        prefix[right] = level
    return order, prefix[:n] >= 0


def repeated_windows(strings: list[bytes], weights: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(string, first window, number)`` of the runs of windows that occur twice, by weight, in all the strings."""
    text = np.frombuffer(b"".join(s + bytes([END]) for s in strings), np.uint8)
    size = np.array([len(s) + 1 for s in strings])
    off = np.concatenate([[0], np.cumsum(size)])
    count = np.maximum(0, size - length)  # windows of each string
    weight = np.where(covered(len(text), off[:-1], count), np.repeat(weights, size), 0)
    order, border = borders(text, length)
    of_class = np.cumsum(border) - 1
    total = np.bincount(of_class, weights=weight[order])
    found = np.zeros(len(text), bool)
    found[order] = total[of_class] >= 2
    found &= weight > 0
    first, number = runs(found, off)
    string = np.searchsorted(off, first, "right") - 1
    return string, first - off[string], number


# ------------------------------------------------------------------------------------------------ runs of windows


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(_U).max, _U)
    padded[:n] = x
    grid = padded.reshape(-1, width)
    up = np.minimum.accumulate(grid, axis=1).ravel()
    down = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[: n - width + 1], up[width - 1 : n])


def window_runs(data: np.ndarray, off: np.ndarray, length: int, anchor: int, step: int):
    """Group, digest, start and number of windows of each run in some texts (``off``: their offsets in ``data``)."""
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, t) for t in (_U, _U, np.int64, np.int64))
    prefix = prefix_hash(_BYTES[data])
    place = np.arange(n - anchor + 1)
    low = _U((1 << 24) - 1)
    least = _least((window_hash(prefix, place, anchor) & ~low) | place.astype(_U), length - anchor + 1)
    start = np.flatnonzero(covered(n, off[:-1], np.maximum(0, np.diff(off) - length + 1)))
    if not len(start):
        return tuple(np.zeros(0, t) for t in (_U, _U, np.int64, np.int64))
    at = (least[start] & low).astype(np.int64)
    part = (at - start) // step
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1] + 1) | (at[1:] != at[:-1]) | (part[1:] != part[:-1])
    first = np.flatnonzero(new)
    number = np.diff(np.append(first, len(start)))
    start, at, part = start[first], at[first], part[first]
    core = window_hash(prefix, at - step * part, length - step + 1)
    group = mix(core + part.astype(_U))
    digest = mix(window_hash(prefix, start, number + length - 1) ^ mix((at - start).astype(_U) * _U(1 << 32) + number.astype(_U)))
    return group, digest, start, number


def _pieces(k: Block, length: int, most: int = 4 << 20):
    """Sub-blocks of at most ``most`` windows: (data, offsets, offset of the first byte, row of the first text)."""
    if len(k.data) <= most:
        yield k.data, k.off, 0
    else:  # one long text
        for a in range(0, max(1, len(k.data) - length + 1), most):
            data = k.data[a : a + most + length - 1]
            yield data, np.array([0, len(data)]), a


def _describe(length: int, anchor: int, step: int):
    def out(parts):
        h, g, key, tag, pos, size = (np.concatenate(x) for x in zip(*parts, strict=True))
        single, several = once(h, g)
        yield place(h[single], g[single], key[single], tag[single], pos[single], size[single], 1)
        yield place(h[several], g[several], key[several], tag[several], pos[several], size[several], 2)
        rest = ~single  # known to repeat; each under a group of its own
        own = mix(key[rest].view(_U) ^ mix(pos[rest].astype(_U)))
        yield place(own, own, key[rest], tag[rest], pos[rest], size[rest], 0)

    def place(h, g, key, tag, pos, size, n):
        cols = [h.view(np.int64), g.view(np.int64), key, tag, pos.astype(np.int32), size.astype(np.int32), np.full(len(h), n, np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["h", "g", "key", "tag", "pos", "len", "n"])

    def run(batches):
        parts, held = [], 0
        for b in batches:
            key, tag = (b.column(c).to_numpy() for c in ("key", "tag"))
            for k in blocks(b.column("text"), 2 << 20):
                for data, off, base in _pieces(k, length):
                    h, g, start, size = window_runs(data, off, length, anchor, step)
                    row = np.searchsorted(off, start, "right") - 1
                    if len(h):
                        parts.append((h, g, key[k.lo + row], tag[k.lo + row], start - off[row] + base, size))
                held += len(k.data)
                if held >= FLUSH_BYTES and parts:
                    yield from out(parts)
                    parts, held = [], 0
        if parts:
            yield from out(parts)

    return run


def _own(b: pa.RecordBatch):
    """The ``wanted`` runs of a batch that carry their row's tag: row, position, number of windows, group, weight."""
    col = b.column("wanted")
    row = pa.compute.list_parent_indices(col).to_numpy()
    flat = pa.compute.list_flatten(col)
    pos, size, tag, h, n = (flat.field(i).to_numpy() for i in range(5))
    ok = b.column("tag").to_numpy()[row] == tag
    return row[ok], pos[ok].astype(np.int64), size[ok].astype(np.int64), h[ok], n[ok]


def _cut(length: int):
    """The bytes of wanted runs."""

    def run(batches):
        for b in batches:
            key, tag = (b.column(c).to_numpy() for c in ("key", "tag"))
            row, pos, size, h, n = _own(b)
            for k in blocks(text_column(b)):
                lo, hi = np.searchsorted(row, [k.lo, k.hi])
                raw = k.data.tobytes()
                at = k.off[row[lo:hi] - k.lo] + pos[lo:hi]
                strings = [raw[i : i + s + length - 1] for i, s in zip(at.tolist(), size[lo:hi].tolist(), strict=True)]
                r = row[lo:hi]
                cols = [h[lo:hi], n[lo:hi], key[r], tag[r], pos[lo:hi].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in cols), pa.array(strings, pa.binary())], names=["h", "n", "key", "tag", "pos", "string"])

    return run


def _index(length: int):
    """Transforms over whole groups, which arrive sorted; positions of repeated windows of strings of weight one."""

    def solve(parts):
        n, key, tag, pos = (np.concatenate([p[i] for p in parts]) for i in range(4))
        strings = [s for p in parts for s in p[4]]
        string, first, number = repeated_windows(strings, n, length)
        light = n[string] < 2
        string, first, number = string[light], first[light], number[light]
        cols = [key[string], (pos[string] + first).astype(np.int32), number.astype(np.int32), tag[string]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["key", "pos", "len", "tag"])

    def run(batches):
        parts, held, last = [], 0, None
        for b in batches:
            h = b.column("h").to_numpy()
            cols = [b.column(c).to_numpy() for c in ("n", "key", "tag", "pos")]
            strings = b.column("string").to_pylist()
            starts = [0, *(np.flatnonzero(h[1:] != h[:-1]) + 1).tolist(), len(h)]
            for lo, hi in zip(starts, starts[1:], strict=False):
                if held >= INDEX_BYTES and h[lo] != last:
                    yield solve(parts)
                    parts, held = [], 0
                part = strings[lo:hi]
                parts.append((*(c[lo:hi] for c in cols), part))
                held += sum(map(len, part))
                last = h[lo]
        if parts:
            yield solve(parts)

    return run


def _one_by_one(length: int):
    """Hashes of all bytes of each window of wanted runs, for groups that no single task indexes."""

    def run(batches):
        out = Outbox(wide=True)
        for b in batches:
            key, tag = (b.column(c).to_numpy() for c in ("key", "tag"))
            row, pos, size, _, n = _own(b)
            for k in blocks(text_column(b)):
                lo, hi = np.searchsorted(row, [k.lo, k.hi])
                r, p, s, w = row[lo:hi], pos[lo:hi], size[lo:hi], n[lo:hi]
                ends = np.cumsum(s)
                inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - s, s)
                own, at = np.repeat(r, s), np.repeat(p, s) + inside
                place = k.off[own - k.lo] + at
                h = window_hash(prefix_hash(_BYTES[k.data]), place, length)
                g = window_hash(prefix_hash(mix(_BYTES[k.data])), place, length)
                twice = np.repeat(w, s) >= 2  # a weighted string counts as two
                for take in (np.ones(len(own), bool), twice):
                    out.add(h[take], g[take], key[own[take]], tag[own[take]], at[take], int(take.sum()) * 16)
                if out.bytes >= FLUSH_BYTES:
                    yield from out.flush()
        yield from out.flush()

    return run


def _keep(length: int, texts: bool):
    def run(batches):
        for b in batches:
            n_bytes, n_removed, n_spans, sha, kept = [], [], [], [], []
            for k in blocks(text_column(b)):
                row, pos, size = hits(b, k, True)
                gone = covered(len(k.data), k.off[row] + pos, size + length - 1)
                left = np.concatenate([[0], np.cumsum(~gone)])
                flat = k.data[~gone].tobytes()
                first, _ = runs(gone, k.off)
                spans = np.bincount(np.searchsorted(k.off, first, "right") - 1, minlength=len(k.off) - 1)
                bound = left[k.off]
                for r in range(k.hi - k.lo):
                    text = flat[bound[r] : bound[r + 1]]
                    size_r = int(k.off[r + 1] - k.off[r])
                    n_bytes.append(size_r)
                    n_removed.append(size_r - len(text))
                    sha.append(hashlib.sha256(text).hexdigest())
                    if texts:
                        kept.append(text)
                n_spans += spans[: k.hi - k.lo].tolist()
            cols = [b.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(sha, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if texts:
                cols, names = [*cols, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def suffix_dedup(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, step: int = STEP, group_strings: int = GROUP_STRINGS,
    id_col: str = "doc_id", text_col: str = "text", texts: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, binary, with
    ``texts``). ``anchor`` and ``step`` must be at most ``length``, and ``length`` at least 9."""
    if not (anchor <= length and step <= length and length > _SEED):
        raise ValueError("anchor and step must be at most length, and length over 8")
    small_batches(docs.sparkSession)
    plain = keyed(docs, id_col, text_col)
    rows = packed(plain)
    described = materialize_scratch(plain.select("key", "tag", "text").mapInArrow(_describe(length, anchor, step), _PLACE), "runs")

    # groups that hold two strings or more; a row of a single string has nothing to be compared with
    groups = described.where("n > 0").groupBy("h").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("strings")).where("total >= 2")
    met = described.where("n > 0").join(groups, "h")
    same = Window.partitionBy("h", "g")
    met = met.withColumn("equal", F.sum("n").over(same)).withColumn("at", F.row_number().over(same.orderBy("key", "tag", "pos")))
    copies = met.where("equal >= 2").select("key", "pos", "len", "tag")
    wanted = (
        met.where("total > equal and at = 1")
        .withColumn("n", F.least(F.col("equal"), F.lit(2)).cast("int"))
        .withColumn("many", F.col("strings") > group_strings)
        .groupBy("key", "many")
        .agg(F.collect_list(F.struct("pos", "len", "tag", "h", "n")).alias("wanted"))
    )
    with_text = lambda x: rows.join(x.drop("many"), "key")
    strings = with_text(wanted.where("not many")).mapInArrow(_cut(length), "h long, n int, key long, tag int, pos int, string binary")
    indexed = strings.repartition("h").sortWithinPartitions("h").mapInArrow(_index(length), "key long, pos int, len int, tag int")
    single = repeated(with_text(wanted.where("many")).mapInArrow(_one_by_one(length), _SENT), True)

    known = described.where("n = 0").select("key", "pos", "len", "tag")
    found = known.unionByName(copies).unionByName(indexed).unionByName(single.withColumn("pos", F.col("pos").cast("int")))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    return rows.join(listed(found), "key", "left").mapInArrow(_keep(length, texts), schema)
