"""Ranked lexical search over an index of document shards, by Block-Max MaxScore.

Terms are the maximal runs of letters, digits and characters beyond ASCII, only A-Z lower-cased. A document's score for a
query sums, over the query's terms, ``w * ((10^9 * tf) div (1000 * tf + 8 * m))`` in 64-bit integers, where ``w`` grows with
the term's rarity (``term_weight``) and ``m`` with the document's length against the mean (``length_measure``).

Index. ``build_index`` cuts the documents into shards (bounded by bytes and rows) where they lie and inverts each in its
task: one row per shard and term, whose postings are blocks of ``BLOCK`` documents, each stored compressed beside its last
document, its largest frequency and its least document length; and one row per shard with the documents' ids and lengths.
The index holds every term of every document, is written in the shared checkpoint folder and serves any number of queries.

Search. A shard's lists for the queries' terms meet in one task. For a query, a list's global bound is the best score that
any of its blocks allows. Documents are visited in ranges; with the bounds sorted, the lists whose bounds together cannot
lift a document over the shard's ``k``-th best score so far are non-essential: only the essential lists yield candidates. A
candidate whose score plus the block maxima of the non-essential lists does not exceed that score is rejected before any of
those blocks is decompressed; the lists are then taken from the highest bound down, and candidates are rejected again after
each. The shards' heaps are merged by rank. Documents of a shard are numbered in the order of their ids, so that of equal
scores the least id stays, and a bound equal to the ``k``-th score rejects.

Scale. No posting is shuffled while the index is built. A search reads only the queries' terms and shuffles their postings
by shard; a task holds one shard's, however often a term occurs in the corpus. Queries go in blocks of at most
``QUERY_BYTES`` of text (or one query), which the driver holds one at a time and sends to the tasks. Corpus counts are exact.

Defined cases: null texts, and texts without a term, are in no result and do not count in the number of documents; rows
that repeat are documents of their own; a null id comes after all others; a query's repeated terms count once; queries that
repeat id and text are one query; queries with the same id and different texts are ranked each for itself; null queries and
queries without a known term give no row; other columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize_scratch
from ._text import _BYTES, blocks, prefix_hash, small_batches, window_hash

#: Documents of a block of postings.
BLOCK = 64
SHARD_BYTES, SHARD_ROWS = 16 << 20, 1 << 16
#: Documents that a search visits at a time.
RANGE = 2048
QUERY_BYTES = 4 << 20
K = 10

_U = np.uint64
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def terms_of(text: str | None) -> list[str]:
    """The terms of one text, in order."""
    raw = _LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    start, end = _term_places(raw, np.array([0, len(raw)]))
    flat = raw.tobytes()
    return [flat[a:b].decode() for a, b in zip(start.tolist(), end.tolist(), strict=True)]


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_measure(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 10 + (90 * n.astype(np.int64) * n_docs) // n_terms


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Grows with ``tf`` and falls with ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


# ------------------------------------------------------------------------------------------------ index


def _term_places(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw)
    inside = _TERM[raw]
    left, right = np.ones(n, bool), np.ones(n, bool)
    left[1:], right[:-1] = ~inside[:-1], ~inside[1:]
    edge = off[(off > 0) & (off < n)]
    left[edge] = True
    right[edge - 1] = True
    return np.flatnonzero(inside & left), np.flatnonzero(inside & right) + 1


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative numbers as bytes of seven bits, the last one marked, and the offset of each number's first byte."""
    size = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28, 35):
        size += values >= (1 << bits)
    off = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(off[-1], np.uint8)
    rest, at, live = values.copy(), off[:-1].copy(), np.arange(len(values))
    while len(live):
        out[at[live]] = rest[live] & 127
        last = size[live] == 1
        out[at[live[last]]] |= 128
        live = live[~last]
        rest[live] >>= 7
        size[live] -= 1
        at[live] += 1
    return out, off


def numbers(raw: np.ndarray) -> np.ndarray:
    """What ``varints`` wrote."""
    end = np.flatnonzero(raw & 128)
    first = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
    which = np.repeat(np.arange(len(end)), end - first + 1)
    part = (raw & 127).astype(np.int64) << (7 * (np.arange(len(raw)) - first[which]))
    return np.add.reduceat(part, first) if len(end) else np.zeros(0, np.int64)


def _invert(parts, ids: pa.Array, shard: int, names: list[str]):
    """The index rows of a shard: its documents, in order of id, and its terms."""
    raw = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint8)
    size = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
    off = np.concatenate([[0], np.cumsum(size)])
    start, end = _term_places(raw, off)
    by_id = pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()
    number = np.empty(len(ids), np.int64)
    number[by_id] = np.arange(len(ids))
    doc = number[np.searchsorted(off, start, "right") - 1]
    length = np.bincount(doc, minlength=len(ids))

    h = np.empty(len(start), _U)
    i = 0
    while i < len(start):  # piece by piece, cut between terms
        j = max(i + 1, int(np.searchsorted(end, start[i] + (1 << 20), "right")))
        h[i:j] = window_hash(prefix_hash(_BYTES[raw[start[i] : end[j - 1]]]), start[i:j] - start[i], end[i:j] - start[i:j])
        i = j
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    new_term = np.ones(len(h), bool)
    new_term[1:] = h[1:] != h[:-1]
    new = new_term.copy()
    new[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new)  # a posting each
    tf, pdoc, first = np.diff(np.append(at, len(h))), doc[at], new_term[at]
    bound = np.append(np.flatnonzero(first), len(at))  # of the terms' postings
    df = np.diff(bound)
    place = np.arange(len(at)) - np.repeat(bound[:-1], df)
    opens = place % BLOCK == 0
    gap = pdoc.copy()
    gap[1:] -= np.where(first[1:], 0, pdoc[:-1])
    pair = np.empty(2 * len(at), np.int64)
    pair[::2], pair[1::2] = gap, tf
    data, byte = varints(pair)

    blk = np.flatnonzero(opens)
    blk_end = np.append(blk[1:], len(at)) - 1
    per_term = np.append(np.searchsorted(blk, bound[:-1]), len(blk)).astype(np.int32)
    term_byte = byte[2 * bound]
    last = pdoc[blk_end] if len(blk) else pdoc
    most = np.maximum.reduceat(tf, blk) if len(blk) else tf
    least = np.minimum.reduceat(length[pdoc], blk) if len(blk) else tf
    where = byte[2 * blk] - np.repeat(term_byte[:-1], np.diff(per_term))
    flat = raw.tobytes()
    t = order[np.flatnonzero(new_term)]
    term = [flat[a:b] for a, b in zip(start[t].tolist(), end[t].tolist(), strict=True)]

    n = len(term)
    lists = [pa.ListArray.from_arrays(pa.array(per_term), pa.array(x.astype(np.int32))) for x in (last, most, least, where)]
    payload = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(term_byte.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())
    kinds = [pa.list_(ids.type), pa.list_(pa.int32())]
    row = [pa.array([shard] * n, pa.int64()), pa.array(term, pa.binary()), pa.array(df, pa.int64()), *lists, payload, *(pa.nulls(n, k) for k in kinds)]
    for lo in range(0, n, 20_000):
        yield pa.RecordBatch.from_arrays([c.slice(lo, 20_000) for c in row], names=names)
    docs = [pa.ListArray.from_arrays([0, len(ids)], ids.take(pa.array(by_id))), pa.ListArray.from_arrays([0, len(ids)], pa.array(length.astype(np.int32)))]
    docs = [d.cast(k) for d, k in zip(docs, kinds, strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), *(pa.nulls(1, c.type) for c in row[1:8]), *docs], names=names)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The written index: rows ``shard, term, df, last, most, least, place, payload`` and, with a null term, ``ids, lengths``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["shard", "term", "df", "last", "most", "least", "place", "payload", "ids", "lengths"]

    def run(batches):
        ctx = TaskContext.get()
        shard, parts, ids, held, kept = (ctx.partitionId() if ctx else 0) << 32, [], [], 0, 0
        for b in batches:
            for k in blocks(b.column("text"), shard_bytes):
                if kept and (held + len(k.data) > shard_bytes or kept + k.hi - k.lo > shard_rows):
                    yield from _invert(parts, pa.concat_arrays(ids), shard, names)
                    shard, parts, ids, held, kept = shard + 1, [], [], 0, 0
                parts.append((_LOWER[k.data], np.diff(k.off)))
                ids.append(b.column("doc_id").slice(k.lo, k.hi - k.lo))
                held, kept = held + len(k.data), kept + k.hi - k.lo
        if kept:
            yield from _invert(parts, pa.concat_arrays(ids), shard, names)

    schema = f"shard long, term binary, df long, last array<int>, most array<int>, least array<int>, place array<int>, payload binary, ids array<{kind}>, lengths array<int>"
    return materialize_scratch(rows.mapInArrow(run, schema), "lexical-index")


# ------------------------------------------------------------------------------------------------ search


class Postings:
    """A shard's list of one term; impacts of a block are decoded when first asked for."""

    def __init__(self, weight: int, df: int, last, most, least, place, payload: bytes, n_docs: int, n_terms: int):
        self.weight, self.last = weight, last
        self.top = weight * impact(most.astype(np.int64), length_measure(least, n_docs, n_terms))
        self.bound = int(self.top.max())
        self._raw, self._place = np.frombuffer(payload, np.uint8), np.append(place, len(payload))
        self._size = np.minimum(BLOCK, df - BLOCK * np.arange(len(last)))
        self.doc, self.score = np.repeat(last.astype(np.int64), self._size), np.zeros(df, np.int64)  # in order also where not decoded
        self.ready = np.zeros(len(last), bool)

    def decode(self, which: np.ndarray, m: np.ndarray) -> None:
        """Fill the blocks ``which`` (ascending)."""
        which = which[~self.ready[which]]
        if not len(which):
            return
        self.ready[which] = True
        raw = np.concatenate([self._raw[self._place[i] : self._place[i + 1]] for i in which.tolist()]) if len(which) < len(self.last) else self._raw
        pair = numbers(raw)
        size = self._size[which]
        ends = np.cumsum(size)
        gap = pair[::2].copy()
        gap[(ends - size)[which > 0]] += self.last[which[which > 0] - 1]  # a block's first gap is from the block before
        run = np.cumsum(gap)
        base = np.concatenate([[0], run[ends[:-1] - 1]])
        doc = run - np.repeat(base, size)
        to = np.arange(ends[-1]) + np.repeat(which * BLOCK - (ends - size), size)
        self.doc[to] = doc
        tf = pair[1::2]
        self.score[to] = self.weight * impact(tf, m[doc])


def top_documents(lists: list[Postings], m: np.ndarray, k: int, width: int = RANGE) -> tuple[np.ndarray, np.ndarray]:
    """Scores and documents of the ``k`` best, best first, equal scores by document."""
    lists = sorted((p for p in lists if p.bound > 0), key=lambda p: p.bound)
    reach = np.cumsum([p.bound for p in lists])
    score, doc, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for lo in range(0, len(m), width):
        hi = min(lo + width, len(m))
        first = int(np.searchsorted(reach, least, "right"))  # the lists before it cannot lift a document over ``least``
        if first == len(lists):
            break
        total = np.zeros(hi - lo, np.int64)
        for p in lists[first:]:
            a, b = np.searchsorted(p.last, [lo, hi])
            if a == len(p.last):
                continue
            p.decode(np.arange(a, min(b + 1, len(p.last))), m)
            i, j = np.searchsorted(p.doc[a * BLOCK : (b + 1) * BLOCK], [lo, hi]) + a * BLOCK
            total[p.doc[i:j] - lo] += p.score[i:j]
        live = np.flatnonzero(total)
        if not len(live):
            continue
        total, live = total[live], live + lo
        rest = lists[:first][::-1]
        block = [np.searchsorted(p.last, live) for p in rest]
        most = [np.append(p.top, 0)[x] for p, x in zip(rest, block, strict=True)]
        still = np.sum(most, axis=0) if rest else np.zeros(len(live), np.int64)
        for i, p in enumerate(rest):
            ok = total + still > least
            if not ok.all():
                total, still, live = total[ok], still[ok], live[ok]
                block, most = [x[ok] for x in block], [x[ok] for x in most]
            if not len(live):
                break
            still = still - most[i]
            inside = np.flatnonzero(block[i] < len(p.last))
            p.decode(np.unique(block[i][inside]), m)
            total[inside] += _looked_up(p, live[inside])
        ok = total > least
        if ok.any():
            score, doc = np.concatenate([score, total[ok]]), np.concatenate([doc, live[ok]])
            best = np.lexsort((doc, -score))[:k]
            score, doc = score[best], doc[best]
            least = int(score[-1]) if len(score) == k else 0
    return score, doc


def _looked_up(p: Postings, doc: np.ndarray) -> np.ndarray:
    """The scores of documents in decoded blocks; 0 where a block lacks the document."""
    at = np.searchsorted(p.doc, doc)
    return np.where(p.doc[at] == doc, p.score[at], 0)


def _ranked(queries: list[tuple[int, list[bytes]]], weights: dict[bytes, int], n_docs: int, n_terms: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        row = table.filter(pa.compute.is_null(table.column("term"))).to_batches()[0]
        ids, m = row.column("ids")[0].values, length_measure(row.column("lengths")[0].values.to_numpy(), n_docs, n_terms)
        lists = {}
        for b in table.filter(pa.compute.is_valid(table.column("term"))).to_batches():
            flat = [pa.compute.list_flatten(b.column(c)).to_numpy() for c in ("last", "most", "least", "place")]
            ends = np.cumsum(pa.compute.list_value_length(b.column("last")).to_numpy()).tolist()
            for i, (term, df, payload) in enumerate(zip(*(b.column(c).to_pylist() for c in ("term", "df", "payload")), strict=True)):
                lo, hi = ends[i - 1] if i else 0, ends[i]
                lists[term] = Postings(weights[term], df, *(x[lo:hi] for x in flat), payload, n_docs, n_terms)
        number, score, doc = [], [], []
        for q, terms in queries:
            s, d = top_documents([lists[t] for t in terms if t in lists], m, k)
            number.append(np.full(len(s), q))
            score.append(s)
            doc.append(d)
        number, score, doc = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (number, score, doc))
        return pa.table([pa.array(number, pa.int64()), ids.take(pa.array(doc, pa.int64())), pa.array(score, pa.int64())], names=["query", "doc_id", "score"])

    return run


def search(index: DataFrame, queries: DataFrame, k: int = K, id_col: str = "item_id", text_col: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """Each query's ``k`` highest-scoring documents with a score above 0: ``item_id, rank, doc_id, score``."""
    spark = index.sparkSession
    asked = queries.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null").distinct()
    kind, doc_kind = asked.schema["item_id"].dataType.simpleString(), index.schema["ids"].dataType.elementType.simpleString()
    empty = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {doc_kind}, score long")
    n_docs, n_terms = index.where("term is null").select(F.explode("lengths").alias("n")).agg(F.count_if(F.col("n") > 0), F.sum(F.col("n").cast("long"))).first()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0]
    if not n_docs or not size:
        return empty
    n_blocks = -(-size // query_bytes)
    asked = materialize_scratch(asked.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))), "queries")
    found = [_searched(index, asked.where(F.col("part") == i), n_docs, n_terms, k, kind, doc_kind) for i in range(n_blocks)]
    out = [x for x in found if x is not None]
    for x in out[1:]:
        out[0] = out[0].unionByName(x)
    return out[0] if out else empty


def _searched(index: DataFrame, asked: DataFrame, n_docs: int, n_terms: int, k: int, kind: str, doc_kind: str) -> DataFrame | None:
    """One block of queries."""
    spark: SparkSession = index.sparkSession
    rows = asked.select("item_id", "text").collect()  # at most QUERY_BYTES of text, or one query
    queries = [(i, sorted({t.encode() for t in terms_of(r.text)})) for i, r in enumerate(rows)]
    terms = sorted({t for _, ts in queries for t in ts})
    if not terms:
        return None
    wanted = spark.createDataFrame([(t,) for t in terms], "term binary")
    held = index.where("term is not null").join(F.broadcast(wanted), "term", "left_semi")
    weights = {bytes(r.term): term_weight(n_docs, r.df) for r in held.groupBy("term").agg(F.sum("df").alias("df")).collect()}
    lists = held.select(index.columns).unionByName(index.where("term is null"))
    hits = lists.groupBy("shard").applyInArrow(_ranked(queries, weights, n_docs, n_terms, k), f"query long, doc_id {doc_kind}, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"query long, item_id {kind}")
    return best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")


def lexical_search(docs: DataFrame, queries: DataFrame, k: int = K, **index_options) -> DataFrame:
    """``search`` over an index of ``docs`` that is built for it."""
    return search(build_index(docs, **index_options), queries, k)
