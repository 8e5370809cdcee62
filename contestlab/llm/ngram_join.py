"""Similarity self-join of documents on word n-grams: a MinHash LSH forest with exact verification.

Two texts are linked when the Jaccard similarity of their sets of ``n`` consecutive words is at least ``threshold``; a
class is a connected component of links. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.

Method. Documents with the same set are collapsed to one representative, with a weight. Each representative has a signature
of ``depth`` values in each of ``trees`` trees; a tree is the sorted trie of its signatures, a node of it a prefix and the
representatives that share it. A representative starts with whole signatures and a neighbourhood of two: in each tree its
matched prefix is shortened as long as the node holds no more than the neighbourhood, and the neighbourhood is doubled until
the chance that a pair at the threshold shares a matched prefix in some tree, 1 - product of (1 - s^length) over the trees,
reaches ``recall``. So prefixes stay long in crowded branches and get short in empty ones, and a node is opened for all its
representatives when one of them asks for it: the recall holds for every pair. In an open node, signatures are compared
whole: pairs that share at least as many values as a pair at the threshold does, less ``MARGIN`` standard deviations, join
families, and all sets of a family are compared exactly.

Scale. Nodes with the same representatives in several trees are visited once. Nodes and families are cut into blocks (of
``block`` representatives, families also by bytes of their sets), one task for each pair of blocks, so no task holds a whole
large group; a task returns one row per representative (its number of links and the least representative that it reaches),
never pairs. Signatures take 2 bytes a value; texts move once, and only those of documents in a family. Joins on hot nodes,
families and representatives have one side with a row per key, so that Spark can split the other, or are salted. Components
are joined by alternating star operations on written tables. Nothing is collected but a checksum per round.

Defined cases: texts with fewer than ``n`` words have their whole word sequence as only n-gram; texts without words (and
null) are linked to nothing and are a class each, also among themselves; rows that repeat are documents of their own; null
ids are kept; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize_scratch
from ._text import blocks, byte_values, keyed, mix, packed, prefix_hash, small_batches, text_column, window_hash, words

N = 5
#: The similarity as a fraction, so that comparisons are exact.
THRESHOLD = (4, 5)
TREES, DEPTH = 16, 8
RECALL = 0.9995
BLOCK = 768
#: Bytes of n-gram hashes in a block of a family (a single longer text is a block of its own size).
BLOCK_BYTES = 32 << 20
#: Standard deviations below the expected number of shared values at which a pair is still verified.
MARGIN = 5
SALTS = 16

_U = np.uint64


def prefix_length(similarity: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix, from ``depth`` down, that finds a pair of this similarity with at least ``recall``."""
    for d in range(depth, 1, -1):
        if 1 - (1 - similarity**d) ** trees >= recall:
            return d
    return 1


def matched_lengths(sizes: np.ndarray, floor: int, similarity: float, recall: float) -> np.ndarray:
    """The prefix length by row and tree (0: none) from ``sizes[row, tree, i]``, the size of the node of length ``floor + i``.

    The shortest length whose node is within the row's neighbourhood; that is doubled until the row's recall is reached."""
    out = np.zeros(sizes.shape[:2], np.int64)
    left, limit = np.arange(len(sizes)), 2
    while len(left):
        fits = sizes[left] <= limit
        length = np.where(fits.any(axis=2), floor + fits.argmax(axis=2), 0)
        missed = np.where(length > 0, 1 - similarity ** np.maximum(length, 1), 1.0).prod(axis=1)
        done = (1 - missed >= recall) | (length == floor).all(axis=1)
        out[left[done]] = length[done]
        left, limit = left[~done], limit * 2
    return out


def shingles(k, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each n-gram of a block's rows, and the bounds of each row's. Shorter texts have one."""
    w = words(k)
    count = np.diff(w.first)
    size = np.minimum(n, count)[w.row] if len(w.row) else np.zeros(0, np.int64)
    at = np.flatnonzero(w.position + size <= count[w.row])
    at = at[w.position[at] <= np.maximum(0, count[w.row[at]] - n)] if len(at) else at
    h = mix(window_hash(prefix_hash(w.hash), at, size[at]) + size[at].astype(_U))
    return h, np.searchsorted(w.row[at], np.arange(len(count) + 1))


def _sketch(n: int, values: int):
    factor = (byte_values(99)[:values] if values <= 256 else mix(np.arange(values, dtype=_U) + _U(99))) | _U(1)

    def run(batches):
        for b in batches:
            rep, size, sigs = [], [], []
            for k in blocks(b.column("text")):
                h, bound = shingles(k, n)
                full = np.flatnonzero(np.diff(bound) > 0)
                sig = np.zeros((len(bound) - 1, values), np.uint16)
                code = np.sort((np.repeat(np.arange(len(bound) - 1), np.diff(bound)).astype(_U) << _U(48)) | (h >> _U(16)))
                code = code[np.concatenate([[True], code[1:] != code[:-1]])] if len(code) else code
                start = np.searchsorted(code >> _U(48), full.astype(_U))
                ids = [np.add.reduceat(mix((code & _U((1 << 48) - 1)) * _U(f) + _U(1)), start) if len(full) else start for f in (3, 5)]
                if len(full):
                    for v in range(values):
                        sig[full, v] = mix(np.minimum.reduceat(h * factor[v], bound[:-1][full])) >> _U(48)
                have = dict(zip(full.tolist(), zip(ids[0].tolist(), ids[1].tolist(), strict=True), strict=True))
                rep += [f"{have[r][0]:016x}{have[r][1]:016x}" if r in have else None for r in range(len(bound) - 1)]
                size += np.diff(bound).tolist()
                sigs += [row.tobytes() for row in sig]
            cols = [b.column(c) for c in ("doc_id", "key", "tag")]
            cols += [pa.array(rep, pa.string()), pa.array(size, pa.int64()), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "key", "tag", "rep", "size", "sig"])

    return run


def components(spark: SparkSession, edges: DataFrame, most: int = 50) -> DataFrame:
    """``(v, root)`` for each node ``v`` of edges ``(a, b)`` that is not the least of its component; ``root`` is the least.

    Alternating large-star and small-star operations: each round hangs nodes on smaller neighbours, until nothing changes.
    Every round is written, so lineage does not grow and a lost executor repeats one round.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("root")).distinct()
    edges, before = materialize_scratch(edges, "edges"), None
    for _ in range(most):
        both = edges.select(F.col("v").alias("x"), F.col("root").alias("y")).unionByName(edges.select(F.col("root").alias("x"), F.col("v").alias("y")))
        # written, so that the join's sides are both plain shuffles and Spark can split a hot node's edges
        least = materialize_scratch(both.groupBy("x").agg(F.min(F.least("x", "y")).alias("m")), "least")
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("root")).distinct()
        lower = large.groupBy("v").agg(F.min("root").alias("m"))
        joined = large.join(lower, "v")
        small = joined.select(F.col("root").alias("v"), F.col("m").alias("root")).where("v <> root").unionByName(lower.select("v", F.col("m").alias("root")))
        edges = materialize_scratch(small.distinct(), "edges")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "root").cast("decimal(38,0)"))).first())
        if now == before:
            return edges
        before = now
    raise RuntimeError("components did not settle")


def _sets(n: int):
    def run(batches):
        for b in batches:
            for k in blocks(text_column(b)):
                h, bound = shingles(k, n)
                sets = [np.unique(h[lo:hi]).tobytes() for lo, hi in zip(bound, bound[1:], strict=False)]
                part = b.slice(k.lo, k.hi - k.lo)
                cols = [part.column(c) for c in ("rep", "weight", "family", "block", "blocks")]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(sets, pa.binary())], names=["rep", "weight", "family", "block", "blocks", "grams"])

    return run


def linked(sets: list[np.ndarray], threshold: tuple[int, int]) -> np.ndarray:
    """Which pairs of sets reach the threshold (a symmetric matrix)."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, gram, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[gram] > 1
    owner, gram = owner[shared], gram[shared]
    _, gram = np.unique(gram, return_inverse=True)
    by = np.argsort(gram, kind="stable")
    owner, gram = owner[by], gram[by]
    common = np.zeros((len(sets), len(sets)), np.float32)  # exact: counts below 2^24
    width = 8192
    for lo in range(0, int(gram[-1]) + 1 if len(gram) else 0, width):
        i, j = np.searchsorted(gram, [lo, lo + width])
        x = np.zeros((len(sets), min(width, int(gram[-1]) + 1 - lo)), np.float32)
        x[owner[i:j], gram[i:j] - lo] = 1
        common += x @ x.T
    c = common.astype(np.int64)
    a, b = threshold
    return b * c >= a * (size[:, None] + size[None, :] - c)


def least_reached(link: np.ndarray, rep: tuple[str, ...]) -> list[str]:
    """For each row the least ``rep`` of its component (repeated passes over the links)."""
    at = np.argsort(np.array(rep))
    rank = np.empty(len(rep), np.int64)
    rank[at] = np.arange(len(rep))
    name = rank.copy()
    while True:
        new = np.minimum(name, np.where(link, name[None, :], len(rep)).min(axis=1))
        if (new == name).all():
            return [rep[at[i]] for i in name]
        name = new


def _by_task(columns: tuple[str, ...], solve, schema: pa.Schema):
    """Rows arrive sorted by ``task``; ``solve`` gets the rows of one task, once each, and returns columns of ``schema``."""

    def run(batches):
        task, rows = None, {}
        for b in batches:
            out = tuple([] for _ in schema)
            for t, *row in zip(*(b.column(c).to_pylist() for c in ("task", *columns)), strict=True):
                if t != task and rows:
                    for o, x in zip(out, solve(list(rows.values())), strict=True):
                        o.extend(x)
                    rows = {}
                task = t
                rows[row[0]] = row  # a row that the table repeats comes once for each batch that holds it
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(o, f.type) for o, f in zip(out, schema, strict=True)], schema=schema)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(o, f.type) for o, f in zip(solve(list(rows.values())), schema, strict=True)], schema=schema)

    return run


def shared_values(sigs: np.ndarray) -> np.ndarray:
    """How many values each two rows share."""
    m, values = sigs.shape
    if m * m * values <= 1 << 20:
        return (sigs[:, None, :] == sigs[None, :, :]).sum(axis=2)
    same = np.zeros((m, m), np.int32)
    for v in range(values):
        same += sigs[:, v][:, None] == sigs[:, v][None, :]
    return same


def _neighbours(enough: int):
    """Tasks are a node, or two blocks of one; a row for each representative that is not the least it reaches."""

    def solve(rows):
        rep, sig = zip(*rows, strict=True)
        least = least_reached(shared_values(np.stack([np.frombuffer(x, np.uint16) for x in sig])) >= enough, rep)
        found = [(r, x) for r, x in zip(rep, least, strict=True) if r != x]
        return [r for r, _ in found], [x for _, x in found]

    return _by_task(("rep", "sig"), solve, pa.schema([("rep", pa.string()), ("least", pa.string())]))


def _verify(threshold: tuple[int, int]):
    """Tasks are a family, or two blocks of one; a row per representative: links by weight, and the least representative of
    its component in the task."""

    def solve(rows):
        rep, weight, side, grams = zip(*rows, strict=True)
        link = linked([np.frombuffer(g, _U) for g in grams], threshold)
        side = np.array(side)
        if side.min() != side.max():
            link &= side[:, None] != side[None, :]
        np.fill_diagonal(link, False)
        return rep, (link @ np.array(weight)).tolist(), least_reached(link, rep)

    return _by_task(("rep", "weight", "block", "grams"), solve, pa.schema([("rep", pa.string()), ("links", pa.int64()), ("least", pa.string())]))


def _lengths(trees: int, depth: int, floor: int, similarity: float, recall: float):
    """``sizes`` of a row: ``(node size * trees + tree) * (depth + 1) + length``. Trees without an entry have no neighbour."""

    def run(batches):
        for b in batches:
            sizes = b.column("sizes")
            code = sizes.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), np.diff(sizes.offsets.to_numpy()))
            rest, length = np.divmod(code, depth + 1)
            size, tree = np.divmod(rest, trees)
            table = np.ones((len(sizes), trees, depth - floor + 1), np.int64)
            table[row, tree, length - floor] = size
            out = matched_lengths(table, floor, similarity, recall)
            yield pa.RecordBatch.from_arrays([b.column("rep"), pa.array(list(out.astype(np.int32)), pa.list_(pa.int32()))], names=["rep", "lengths"])

    return run


def forest(reps: DataFrame, trees: int, depth: int, similarity: float, recall: float, block: int) -> DataFrame:
    """Edges ``a, b`` whose components are the families of ``reps (rep, sig)``."""
    floor = max(1, prefix_length(similarity, trees, depth, recall) - 1)
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    at = reps.select("rep", "sig", tree).select("rep", "tree", F.expr(f"substring(sig, 1 + tree * {2 * depth}, {2 * depth})").alias("path"))
    at = at.withColumn("prefix", F.expr(f"substring(path, 1, {2 * floor})"))
    shared = at.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    near = materialize_scratch(at.join(shared, ["tree", "prefix"], "left_semi").select("rep", "tree", "path"), "trie")

    node = ["tree", "length", "prefix"]
    prefix = F.expr("substring(path, 1, 2 * length)").alias("prefix")
    paths = near.select("rep", "tree", "path", F.explode(F.sequence(F.lit(floor), F.lit(depth))).alias("length")).select("rep", "tree", "length", prefix)
    sizes = paths.groupBy(*node).agg(F.count(F.lit(1)).alias("n"))
    code = (F.col("n") * trees + F.col("tree")) * (depth + 1) + F.col("length")
    sized = paths.join(sizes, node).groupBy("rep").agg(F.collect_list(code).alias("sizes"))
    lengths = sized.mapInArrow(_lengths(trees, depth, floor, similarity, recall), "rep string, lengths array<int>")
    opened = near.join(lengths, "rep").select("tree", "path", F.expr("lengths[tree]").alias("length")).where("length > 0").select("tree", "length", prefix).distinct()
    # of the open nodes on a path the shortest holds the others
    members = paths.join(opened, node, "left_semi").groupBy("rep", "tree").agg(F.min(F.struct("length", "prefix")).alias("node"))
    members = materialize_scratch(members.select("rep", "tree", "node.*"), "members")

    whole = members.groupBy(*node).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y")).where("n > 1")
    visited = whole.groupBy("n", "x", "y").agg(F.min(F.struct(*node)).alias("node")).select("node.*", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    placed = members.join(visited, node).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).join(reps.select("rep", "sig"), "rep")
    tasks = _paired(placed, F.col("tree"), F.col("length"), F.hex("prefix")).select("task", "rep", "sig")
    values = trees * depth
    enough = int(np.ceil(values * similarity - MARGIN * (values * similarity * (1 - similarity)) ** 0.5))
    found = tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_neighbours(enough), "rep string, least string")
    return found.select(F.col("rep").alias("a"), F.col("least").alias("b"))


def _paired(placed: DataFrame, *group) -> DataFrame:
    """Each row once for each other block of its group, with the name of the ``task`` of the two."""
    both = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return both.withColumn("task", F.concat_ws("/", *group, F.least("block", "other"), F.greatest("block", "other")))


def _classes(docs: DataFrame, n: int, threshold, trees: int, depth: int, recall: float, block: int, id_col: str, text_col: str):
    """Sketched rows ``doc_id, key, tag, rep`` and linked representatives ``rep, root, links``; weights by ``rep``."""
    spark = docs.sparkSession
    small_batches(spark)
    plain = keyed(docs, id_col, text_col)
    id_type = plain.schema["doc_id"].dataType.simpleString()
    sketch = materialize_scratch(plain.mapInArrow(_sketch(n, trees * depth), f"doc_id {id_type}, key long, tag int, rep string, size long, sig binary"), "sketch")
    reps = sketch.where("rep is not null").groupBy("rep").agg(F.count(F.lit(1)).alias("weight"), F.min(F.struct("key", "tag", "size", "sig")).alias("row"))
    reps = materialize_scratch(reps.select("rep", "weight", "row.*"), "representatives")

    family = components(spark, forest(reps, trees, depth, threshold[0] / threshold[1], recall, block))
    family = family.select(F.col("v").alias("rep"), F.col("root").alias("family")).unionByName(family.select(F.col("root").alias("rep"), F.col("root").alias("family")).distinct())
    family = materialize_scratch(family.join(reps.drop("sig"), "rep"), "families")
    blocks_of = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(8 * F.sum("size") / F.lit(BLOCK_BYTES))).cast("int")
    # only families of several blocks are looked up, each under every salt, so that a hot family is spread
    large = family.groupBy("family").agg(blocks_of.alias("blocks")).where("blocks > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = family.withColumn("salt", F.pmod(F.xxhash64("rep", F.lit("salt")), F.lit(SALTS)).cast("int")).join(large, ["family", "salt"], "left")
    members = salted.withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))

    sets = packed(plain, once_a_batch=True).join(members.select("rep", "weight", "family", "block", "blocks", "key", "tag"), ["key", "tag"])
    sets = sets.mapInArrow(_sets(n), "rep string, weight long, family string, block int, blocks int, grams binary")
    tasks = _paired(sets, F.col("family"))
    checked = tasks.select("task", "rep", "weight", "block", "grams").repartition("task").sortWithinPartitions("task").mapInArrow(_verify(threshold), "rep string, links long, least string")
    checked = materialize_scratch(checked, "links")
    root = components(spark, checked.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    links = checked.groupBy("rep").agg(F.sum("links").alias("links"))
    linked_reps = links.join(root.withColumnRenamed("v", "rep"), "rep", "left").select("rep", F.coalesce("root", "rep").alias("root"), "links")
    return sketch, reps.select("rep", "weight").join(linked_reps, "rep", "left").select("rep", "weight", F.coalesce("root", "rep").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))


def ngram_join(
    docs: DataFrame, n: int = N, threshold: tuple[int, int] = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL,
    block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, class_size, n_links``: the least id of its class, the number of
    documents in it, and the number of other documents that the document is linked to (copies count each)."""
    sketch, reps = _classes(docs, n, threshold, trees, depth, recall, block, id_col, text_col)
    ids = sketch.where("rep is not null").groupBy("rep").agg(F.min("doc_id").alias("doc_id")).join(reps, "rep")
    classes = ids.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("weight").alias("class_size"))
    found = reps.join(classes, "root").select("rep", "class_id", "class_size", (F.col("links") + F.col("weight") - 1).alias("n_links"))
    alone = sketch.where("rep is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(0).cast("long").alias("n_links"))
    return sketch.where("rep is not null").select("doc_id", "rep").join(found, "rep").select("doc_id", "class_id", "class_size", "n_links").unionByName(alone)


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names: of each class the row with the least id
    (then the least row key; one of them where rows repeat id and text), and every row without words."""
    sketch, reps = _classes(docs, N, THRESHOLD, TREES, DEPTH, RECALL, BLOCK, id_col, text_col)
    first = sketch.where("rep is not null").groupBy("rep").agg(F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "key", "tag")).alias("row")).join(reps, "rep")
    keep = first.groupBy("root").agg(F.min("row").alias("row")).select("row.key", "row.tag")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    key, tag = F.xxhash64(F.col(f"`{id_col}`"), text).alias("key"), F.hash(text, F.col(f"`{id_col}`")).alias("tag")
    worded = text.rlike(r"[^\x20\x09-\x0D]")
    kept = docs.where(worded).select(row, key, tag).join(keep, ["key", "tag"], "left_semi").dropDuplicates(["key", "tag"]).select("row")
    kept = kept.unionByName(docs.where(~worded).select(row))
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
