"""Alignment of two tokenizers over a corpus, with corpus-wide counts of linked token pairs under a minimal perfect hash.

Tokenizer A is a byte-level BPE file and encodes a space and the text; tokenizer B is a sentencepiece file and encodes the
text, to which it adds the space itself. Both are read as bytes; the byte offsets where a token of each ends cut the
tokens into groups, and the two tokens that end there are a link. A pair's count is the number of links that have its ids.

Method. The first pass aligns the documents and leaves, per task, the pairs it has linked and how often. The distinct pairs
are dealt into buckets of about ``BUCKET_PAIRS``, and each bucket gets a minimal perfect hash: pairs that are alone at
their bit of a level are placed, the others go to the next level, and a pair's slot is the rank of its bit. Buckets keep
their pairs in slot order, so a lookup is verified. The counts become dense vectors indexed by slot, made in a bounded
number of leaf tasks and added up a tree. The second pass aligns the documents again and looks the counts up.

How a text is cut. A space that follows another character than a space and stands before one that is not white space opens
a token in either tokenizer (no piece of B has its space mark but at the front, which is checked; A's pattern lets a single
space only begin a token). So a text is a row of segments, each a space and a string, whose tokens, groups and links do not
depend on their neighbours: a task encodes each different segment once, and keeps up to ``CACHE_SEGMENTS`` of them.

Scale. What is shuffled is pairs, at most one row per task and pair, never text or tokens. Distinct pairs are at most the
product of the two vocabularies, whatever the corpus; they are looked up in shards of at most about ``SHARD_PAIRS``, each
collected, broadcast (17 bytes a pair) and followed by one pass over the documents, which adds to what the passes before
left; more pairs mean more passes. The best counts are one number per id of B. Leaves, tree and buckets are spread evenly.

Defined cases: null and empty texts, and texts of which either tokenizer's bytes are not a space and the text (U+2581 in
the text, for one), have no tokens: zeros and an empty string; rows that repeat count each time; ids may be null; other
columns are ignored; an empty table gives an empty result; a text without spaces is one segment, of any length.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize_scratch
from ._text import blocks, mix, small_batches
from .bpe import byte_letters, load

BUCKET_PAIRS = 4096
SHARD_PAIRS = 1 << 22
CACHE_SEGMENTS = 400_000
FLUSH_PAIRS = 1 << 21
LEAVES, FAN = 256, 8
#: Bits of a level of the hash for each pair that is still to be placed.
LOAD = 2

_U = np.uint64
#: The pattern that A's kind of file stands for (``"type": "ByteLevel"`` with ``"use_regex": true``); fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
_MARK = "▁"
#: Bytes that a segment's string may begin with: no white space, nor a lead byte of a white space character.
_OPENS = np.ones(256, bool)
_OPENS[[*range(0, 0x21), 0x7F, *range(0x80, 0xC3), 0xE1, 0xE2, 0xE3]] = False


# ------------------------------------------------------------------------------------------------ tokenizers


class Pair:
    """Both tokenizers, from their files' contents."""

    def __init__(self, spec_a: dict, spec_b: bytes) -> None:
        pre = spec_a["pre_tokenizer"] or {}
        if spec_a["normalizer"] or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space"):
            raise ValueError("A must be a byte-level BPE file without a normaliser and with the usual pattern")
        byte = {c: b for b, c in enumerate(byte_letters())}
        added = {t["content"] for t in spec_a["added_tokens"]}
        ranks = {bytes(byte[c] for c in w): i for w, i in spec_a["model"]["vocab"].items() if w not in added}
        self._a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_proto=spec_b)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        if any(_MARK in p.lstrip(_MARK) for p in pieces):
            raise ValueError("B has pieces that go over a space")
        self.bytes_a = {i: w for w, i in ranks.items()}
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace(_MARK, " ").encode() for p in pieces]
        if not all(self.bytes_a.values()) or not all(self.bytes_b):
            raise ValueError("tokens without bytes")
        self._size_a = np.zeros(max(self.bytes_a) + 1, np.int64)
        for i, w in self.bytes_a.items():
            self._size_a[i] = len(w)
        self._size_b = np.array([len(w) for w in self.bytes_b])

    def align(self, strings: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """For segments (without their space): ``ok, n_a, n_b, n_links`` of each, where ok says that both tokenizers give
        its bytes back, its groups as text, and the linked ids of all of them in order, as ``a * 2^32 + b``."""
        texts = [s.decode() for s in strings]
        found = [[self._a.encode_ordinary(" " + t) for t in texts], self._b.encode(texts, num_threads=1)]
        size = np.array([len(s) + 1 for s in strings])
        ok = np.ones(len(strings), bool)
        flat = []
        for ids, of, width in zip(found, (self.bytes_a, self.bytes_b), (self._size_a, self._size_b), strict=True):
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            x = np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))
            ok &= np.bincount(np.repeat(np.arange(len(ids)), n), weights=width[x], minlength=len(ids)) == size
            flat.append((n, x, of, width))
        tokens = []
        for n, x, of, width in flat:  # of the segments whose length is right
            x = x[np.repeat(ok, n)]
            tokens.append([np.where(ok, n, 0), x, np.cumsum(width[x]), np.frombuffer(b"".join([of[i] for i in x.tolist()]), np.uint8)])
        raw = np.frombuffer(b"".join([b" " + s for s, good in zip(strings, ok.tolist(), strict=True) if good]), np.uint8)
        wrong = np.flatnonzero((tokens[0][3] != raw) | (tokens[1][3] != raw))
        if len(wrong):
            right, bound = np.flatnonzero(ok), np.cumsum(size[ok])
            bad = np.unique(np.searchsorted(bound, wrong, "right"))
            return self.align_without(strings, right[bad])
        (n_a, a, end_a, _), (n_b, b, end_b, _) = tokens
        common, i, j = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
        owner = np.searchsorted(np.cumsum(np.where(ok, size, 0)), common)
        n_links = np.bincount(owner, minlength=len(strings))
        return np.stack([ok, n_a, n_b, n_links], axis=1).astype(np.int64), self._groups(a, b, i, j, n_links), (a[i] << 32) | b[j]

    def align_without(self, strings: list[bytes], bad: np.ndarray):
        """``align``, where the segments ``bad`` have the right length but not the right bytes."""
        keep = np.ones(len(strings), bool)
        keep[bad] = False
        rows, groups, links = self.align([s for s, k in zip(strings, keep.tolist(), strict=True) if k])
        table, text = np.zeros((len(strings), 4), np.int64), np.full(len(strings), b"", object)
        table[keep] = rows
        text[keep] = groups
        return table, text.tolist(), links

    def _groups(self, a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, n_links: np.ndarray) -> list[bytes]:
        """The groups of each segment, written at once: every id in its place, followed by its separator."""
        of_a, of_b = np.searchsorted(i, np.arange(len(a))), np.searchsorted(j, np.arange(len(b)))  # group of each token
        place_a = np.arange(len(a)) + np.concatenate([[0], j + 1])[of_a]
        place_b = np.arange(len(b)) + (i + 1)[of_b]
        ids, sep = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        sep[place_a[i]], sep[place_b[j]] = ord("|"), ord(";")
        digits = np.empty((len(ids), 8), np.uint8)
        rest = ids
        for c in range(6, -1, -1):
            digits[:, c] = 48 + rest % 10
            rest = rest // 10
        digits[:, 7] = sep
        shown = np.ones(digits.shape, bool)
        for c in range(6):
            shown[:, c] = ids >= 10 ** (6 - c)
        out = digits[shown].tobytes()
        ends = np.concatenate([[0], np.cumsum(shown.sum(axis=1))])
        last = np.concatenate([[-1], place_b[j]])[np.concatenate([[0], np.cumsum(n_links)])] + 1  # tokens up to each segment's end
        bound = ends[last].tolist()
        return [out[x : max(x, y - 1)] for x, y in zip(bound, bound[1:], strict=False)]


_shared: dict[str, Pair] = {}


def shared(spec) -> Pair:
    """The tokenizers of a broadcast ``(name, A, B)``, made once in each worker."""
    name, a, b = spec.value
    if name not in _shared:
        _shared.clear()
        _shared[name] = Pair(a, b)
    return _shared[name]


def segments(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the segments' strings in some texts, and the first segment of each text (empty texts have none)."""
    n = len(data)
    space = data == 0x20
    cut = np.zeros(n, bool)
    if n > 2:
        cut[1:-1] = space[1:-1] & ~space[:-2] & _OPENS[data[2:]]
    bound = off[(off > 0) & (off < n)]
    cut[bound] = False
    cut[bound - 1] = False
    full = np.flatnonzero(np.diff(off) > 0)
    at = np.sort(np.concatenate([off[full], np.flatnonzero(cut)]))
    start = at + cut[at]
    end = np.append(at, n)[1:]
    return start, end, np.searchsorted(at, off)


class Segments:
    """Aligned segments by number; emptied between blocks when it holds too many."""

    def __init__(self, tokenizers: Pair, most: int, looked_up=None) -> None:
        self.tokenizers, self.most, self.looked_up = tokenizers, most, looked_up
        self._clear()

    def _clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.groups: list[bytes] = []
        self.table = np.zeros((0, 6), np.int64)  # ok, n_a, n_b, n_links, n_best, count_sum
        self.pairs = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The segments' numbers in some texts, and the first of each text."""
        start, end, first = segments(data, off)
        flat = data.tobytes()
        held = [flat[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        if len(self.number) > self.most:
            self._clear()
        new = list({s: None for s in held if s not in self.number})
        if new:
            self.number.update(zip(new, range(len(self.groups), len(self.groups) + len(new)), strict=True))
            rows, groups, pairs = self.tokenizers.align(new)
            self.groups += groups
            more = np.zeros((len(rows), 6), np.int64)
            more[:, :4] = rows
            ends = np.cumsum(rows[:, 3])
            if self.looked_up is not None and len(pairs):
                count, best = self.looked_up(pairs)
                for c, x in ((4, best), (5, count)):
                    total = np.concatenate([[0], np.cumsum(x)])
                    more[:, c] = total[ends] - total[ends - rows[:, 3]]
            self.table = np.concatenate([self.table, more])
            self.first = np.concatenate([self.first, self.first[-1] + ends])
            self.pairs = np.concatenate([self.pairs, pairs])
        return np.fromiter(map(self.number.__getitem__, held), np.int64, len(held)), first


def _good(table: np.ndarray, number: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the segments' values by text, zeros for texts with a segment that does not give its bytes back; and those
    texts' segments."""
    total = np.concatenate([np.zeros((1, table.shape[1]), np.int64), np.cumsum(table[number], axis=0)])
    rows = total[first[1:]] - total[first[:-1]]
    bad = rows[:, 0] < np.diff(first)
    rows[bad] = 0
    return rows, ~np.repeat(bad, np.diff(first))


# ------------------------------------------------------------------------------------------------ first pass


def _linked_pairs(spec, cache: int):
    def out(parts):
        pair, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([c for _, c in parts])).astype(np.int64)  # exact below 2^53
        return pair, n

    def run(batches):
        seg = Segments(shared(spec), cache)
        parts, held = [], 0
        for b in batches:
            for k in blocks(b.column("text")):
                number, first = seg(k.data, k.off)
                _, good = _good(seg.table, number, first)
                which, times = np.unique(number[good], return_counts=True)
                size = seg.first[which + 1] - seg.first[which]
                ends = np.cumsum(size)
                if not len(ends) or not ends[-1]:
                    continue
                at = np.arange(ends[-1]) + np.repeat(seg.first[which] - (ends - size), size)
                parts.append(out([(seg.pairs[at], np.repeat(times, size))]))
                held += len(parts[-1][0])
                if held > FLUSH_PAIRS:
                    parts = [out(parts)]
                    held = len(parts[0][0])
                    if 2 * held > FLUSH_PAIRS:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], names=["pair", "n"])
                        parts, held = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out(parts)], names=["pair", "n"])

    return run


# ------------------------------------------------------------------------------------------------ minimal perfect hash


def bucket_of(pair: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(pair.view(_U) * _U(0x9E3779B97F4A7C15)) % _U(buckets)).astype(np.int64)


def _bit(pair: np.ndarray, level, size) -> np.ndarray:
    return (mix(pair.view(_U) ^ mix(np.array([level], _U) + _U(1))) % np.asarray(size).astype(_U)).astype(np.int64)


def perfect_hash(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the levels, their bits, and the pairs in the order of their slots, for different pairs."""
    sizes, bits, order, rest = [], [], [], pairs
    while len(rest):
        if len(sizes) > 200:
            raise RuntimeError("pairs repeat")
        size = LOAD * len(rest)
        at = _bit(rest, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        placed = alone[at]
        order.append(rest[placed][np.argsort(at[placed])])
        sizes.append(size)
        bits.append(alone)
        rest = rest[~placed]
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return np.array(sizes, np.int64), join(bits, bool), join(order, np.int64)


class PairHash:
    """The hashes of some buckets, read together: slots of pairs, over all of them in order of bucket."""

    def __init__(self, rows: list, buckets: int) -> None:
        self.buckets = buckets
        rows = sorted(rows, key=lambda r: r.bucket)
        sizes = [list(r.sizes) for r in rows]
        self.levels = max(map(len, sizes), default=0)
        self.size, self.base = np.zeros((buckets, self.levels), np.int64), np.zeros((buckets, self.levels), np.int64)
        at = 0
        for r, s in zip(rows, sizes, strict=True):
            self.size[r.bucket, : len(s)] = s
            self.base[r.bucket, : len(s)] = at + np.cumsum([0, *s[:-1]])
            at += sum(s)
        bits = [np.unpackbits(np.frombuffer(r.bits, np.uint8), count=sum(s)).astype(bool) for r, s in zip(rows, sizes, strict=True)]
        self.bits = np.concatenate([*bits, np.zeros(1, bool)])
        self.rank = np.concatenate([[0], np.cumsum(self.bits[:-1])])
        self.pairs = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r.pairs, np.int64) for r in rows)])
        self.bucket, self.start = [r.bucket for r in rows], np.cumsum([0, *(len(r.pairs) // 8 for r in rows)])

    def __call__(self, pair: np.ndarray) -> np.ndarray:
        """The slots of pairs; -1 for one that is not in these buckets."""
        slot = np.full(len(pair), -1)
        live, of = np.arange(len(pair)), bucket_of(pair, self.buckets)
        for level in range(self.levels):
            size = self.size[of[live], level]
            live, size = live[size > 0], size[size > 0]
            at = self.base[of[live], level] + _bit(pair[live], level, size)
            hit = self.bits[at]
            slot[live[hit]] = self.rank[at[hit]]
            live = live[~hit]
        known = slot >= 0
        known[known] = self.pairs[slot[known]] == pair[known]  # verified
        return np.where(known, slot, -1)


def _hash_bucket(table: pa.Table) -> pa.Table:
    pair = table.column("pair").to_numpy()
    sizes, bits, order = perfect_hash(pair)
    row = {"bucket": [table.column("bucket")[0].as_py()], "sizes": [sizes.tolist()], "bits": [np.packbits(bits).tobytes()], "pairs": [order.tobytes()]}
    return pa.table(row, schema=pa.schema([("bucket", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("pairs", pa.binary())]))


def _with_bucket(buckets: int):
    def run(batches):
        for b in batches:
            pair = b.column("pair").to_numpy()
            yield pa.RecordBatch.from_arrays([b.column("pair"), pa.array(bucket_of(pair, buckets))], names=["pair", "bucket"])

    return run


# ------------------------------------------------------------------------------------------------ counts


def _leaf(hashed):
    """A leaf's dense count vector, in a row per bucket that it has pairs of."""

    def run(batches):
        from pyspark import TaskContext

        h, leaf = hashed.value, TaskContext.get().partitionId()
        total = np.zeros(len(h.pairs), np.int64)
        for b in batches:
            slot = h(b.column("pair").to_numpy())
            own = slot >= 0
            np.add.at(total, slot[own], b.column("n").to_numpy()[own])
        rows = [(x, total[i:j]) for x, i, j in zip(h.bucket, h.start.tolist(), h.start[1:].tolist(), strict=False) if total[i:j].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in rows], pa.int64()), pa.array([leaf] * len(rows), pa.int64()), pa.array([t.tobytes() for _, t in rows], pa.binary())],
            names=["bucket", "leaf", "counts"],
        )

    return run


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())
    first = table.slice(0, 1)
    return pa.table([first.column("bucket"), first.column("leaf"), pa.array([total.tobytes()], pa.binary())], names=["bucket", "leaf", "counts"])


def _best(batches):
    """The highest count of each id of B, of the pairs in a batch."""
    for b in batches:
        pair, n = (np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for x in b.column(c).to_pylist())]) for c in ("pairs", "counts"))
        ids, at = np.unique(pair & 0xFFFFFFFF, return_inverse=True)
        most = np.zeros(len(ids), np.int64)
        np.maximum.at(most, at, n)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(most)], names=["b", "most"])


def pair_counts(docs_text: DataFrame, spec, bucket_pairs: int = BUCKET_PAIRS, shard_pairs: int = SHARD_PAIRS, leaves: int = LEAVES, cache: int = CACHE_SEGMENTS) -> tuple[DataFrame, int, int]:
    """The counts of all linked pairs, ``bucket, sizes, bits, pairs, counts, shard`` (hash, pairs and counts in slot order),
    and the numbers of buckets and of shards."""
    spark = docs_text.sparkSession
    sc = spark.sparkContext
    partial = materialize_scratch(docs_text.mapInArrow(_linked_pairs(spec, cache), "pair long, n long"), "linked-pairs")
    distinct = materialize_scratch(partial.select("pair").distinct(), "pairs")
    different, rows = distinct.count(), partial.count()
    buckets = max(1, -(-different // bucket_pairs))
    shards = max(1, -(-different // shard_pairs))
    hashes = distinct.mapInArrow(_with_bucket(buckets), "pair long, bucket long").groupBy("bucket").applyInArrow(_hash_bucket, "bucket long, sizes array<long>, bits binary, pairs binary")
    hashes = materialize_scratch(hashes.withColumn("shard", (F.col("bucket") % shards).cast("int")), "pair-hash")
    # as many leaves as keep a leaf's vector mostly filled
    n_leaves = max(1, min(leaves, rows // max(1, 2 * different)))
    made = []
    for shard in range(shards):
        held = sc.broadcast(PairHash(hashes.where(F.col("shard") == shard).drop("shard").collect(), buckets))
        level, n = partial.coalesce(n_leaves).mapInArrow(_leaf(held), "bucket long, leaf long, counts binary"), n_leaves
        while n > 1:
            level = level.withColumn("leaf", F.floor(F.col("leaf") / FAN)).groupBy("bucket", "leaf").applyInArrow(_added, "bucket long, leaf long, counts binary")
            n = -(-n // FAN)
        made.append(materialize_scratch(level, "pair-counts"))
    counts = made[0]
    for x in made[1:]:
        counts = counts.unionByName(x)
    return materialize_scratch(hashes.join(counts.drop("leaf"), "bucket"), "counted-pairs"), buckets, shards


# ------------------------------------------------------------------------------------------------ second pass

_OUT = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def _aligned(spec, counted, cache: int, last: bool, texts: bool):
    """A row's digests, its links' counts in one shard added to those of the shards before."""

    def run(batches):
        h, count, best = counted.value

        def looked_up(pair):
            slot = h(pair)
            known = slot >= 0
            n = np.where(known, count[slot], 0)
            return n, known & (n == best[pair & 0xFFFFFFFF])

        seg = Segments(shared(spec), cache, looked_up)
        for b in batches:
            rows, sha, said = [], [], []
            for k in blocks(b.column("text")):
                number, first = seg(k.data, k.off)
                found, _ = _good(seg.table, number, first)
                rows.append(found)
                if last:
                    groups, at = seg.groups, first.tolist()
                    for ok, lo, hi in zip(found[:, 0].tolist(), at, at[1:], strict=False):
                        text = b";".join([groups[i] for i in number[lo:hi].tolist()]) if ok else b""
                        sha.append(hashlib.sha256(text).hexdigest() if ok else "")
                        if texts:
                            said.append(text.decode())
            t = np.concatenate([np.zeros((0, 6), np.int64), *rows])
            before = [b.column(c).to_numpy() for c in ("n_best", "count_sum")]
            n_best, count_sum = pa.array(t[:, 4] + before[0]), pa.array(t[:, 5] + before[1])
            if not last:
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), n_best, count_sum], names=["doc_id", "text", "n_best", "count_sum"])
                continue
            cols = [b.column("doc_id"), *(pa.array(t[:, c]) for c in (1, 2, 3, 3)), n_best, count_sum, pa.array(sha, pa.string())]
            names = ["doc_id", *_OUT, "groups_sha256"]
            if texts:
                cols, names = [*cols, pa.array(said, pa.string())], [*names, "groups"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def align_tokenizers(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", bucket_pairs: int = BUCKET_PAIRS,
    shard_pairs: int = SHARD_PAIRS, leaves: int = LEAVES, cache: int = CACHE_SEGMENTS, texts: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` (and ``groups``
    with ``texts``)."""
    spark = docs.sparkSession
    small_batches(spark)
    sc = spark.sparkContext
    with open(path_b, "rb") as f:
        spec = sc.broadcast((uuid.uuid4().hex, load(path_a), f.read()))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    table, buckets, shards = pair_counts(rows.select("text"), spec, bucket_pairs, shard_pairs, leaves, cache)
    best = np.zeros(len(shared(spec).bytes_b), np.int64)
    for r in table.select("pairs", "counts").mapInArrow(_best, "b long, most long").groupBy("b").agg(F.max("most").alias("most")).collect():
        best[r.b] = r.most  # one number per id of B

    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("*", F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    for shard in range(shards):
        found = table.where(F.col("shard") == shard).drop("shard").collect()  # at most about SHARD_PAIRS pairs
        found.sort(key=lambda r: r.bucket)
        count = np.concatenate([*(np.frombuffer(r.counts, np.int64) for r in found), np.zeros(1, np.int64)])
        held = sc.broadcast((PairHash(found, buckets), count, best))
        last = shard == shards - 1
        schema = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string" + ", groups string" * texts
        rows = rows.mapInArrow(_aligned(spec, held, cache, last, texts), f"doc_id {kind}, " + (schema if last else "text string, n_best long, count_sum long"))
        if not last:
            rows = materialize_scratch(rows, "aligned")
    return rows
