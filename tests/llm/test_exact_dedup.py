import hashlib
import string
from collections import defaultdict

import pytest
from cases import frame, rows

from contestlab.llm.exact_dedup import drop_copies, exact_dedup

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(data):
    groups = defaultdict(list)
    for r in data:
        groups[(r[1] or "").translate(LOWER)].append(r[0])
    return sorted(
        ((i is None, i or 0), (k is None, k or 0), len(ids), hashlib.sha256(t.encode()).hexdigest())
        for t, ids in groups.items()
        for k in [max((x for x in ids if x is not None), default=None)]
        for i in ids
    ), len(groups)


DATA = [*rows(), (300, "ÀB İ x", "", "", 0, 0, 0, "", ""), (301, "Àb İ X", "", "", 0, 0, 0, "", ""), (302, "àb i̇ x", "", "", 0, 0, 0, "", "")]


@pytest.mark.parametrize("bits,max_bytes", [(256, 1 << 36), (256, 1000), (4, 1 << 36)])
def test_matches_brute_force(spark, bits, max_bytes):
    """Also over several micro-batches, and with digests so short that different texts share them."""
    got = exact_dedup(frame(spark, DATA).repartition(5), digest_bits=bits, max_bytes=max_bytes).collect()
    want, classes = brute(DATA)
    assert sorted(((r.doc_id is None, r.doc_id or 0), (r.keep_id is None, r.keep_id or 0), r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == classes
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_drop_copies(spark, tmp_path):
    frame(spark, DATA).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    kept = drop_copies(docs)
    assert kept.schema == docs.schema
    assert len({(r.text or "").translate(LOWER) for r in kept.collect()}) == kept.count() == brute(DATA)[1]


def test_empty_table(spark):
    assert exact_dedup(frame(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = exact_dedup(frame(spark, DATA[:5]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def _left(kept):
    return sorted((r.text or "").translate(LOWER) for r in kept.collect())


def test_drop_copies_of_any_table(spark, tmp_path):
    """Tables in memory, unions of files, joins that repeat rows, filtered tables."""
    data = [(1, "A b"), (2, "a B"), (3, None), (4, ""), (5, "c")]
    memory = spark.createDataFrame(data, "doc_id long, text string")
    assert sorted(map(tuple, drop_copies(memory).collect()), key=str) == [(2, "a B"), (4, ""), (5, "c")]
    memory.write.parquet(str(tmp_path / "a"))
    memory.write.parquet(str(tmp_path / "b"))
    a, b = (spark.read.parquet(str(tmp_path / x)) for x in "ab")
    assert _left(drop_copies(a.unionByName(b))) == ["", "a b", "c"]
    twice = a.crossJoin(spark.createDataFrame([(1,), (2,)], "turn int"))
    kept = drop_copies(twice)
    assert kept.columns == ["doc_id", "text", "turn"] and _left(kept) == ["", "a b", "c"]
    assert _left(drop_copies(a.where("doc_id < 3"))) == ["a b"]
    assert sorted(r.group_size for r in exact_dedup(a.unionByName(b)).collect()) == [2, 2] + [4] * 8


def test_clashing_names(spark, tmp_path):
    """Columns with the names that the operator uses itself come back as they were."""
    names = ["row", "file", "at", "sha", "digest", "second", "place", "keep", "n", "part", "_part", "bits", "_metadata", "_file", "_row", "_key", "texts"]
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in names)
    data = [(i, t, *(f"{c}{i}" for c in names)) for i, t in enumerate(["x", "X", "y", None])]
    memory = spark.createDataFrame(data, schema)
    memory.write.parquet(str(tmp_path / "d"))
    for docs in (memory, spark.read.parquet(str(tmp_path / "d"))):
        kept = drop_copies(docs)
        assert kept.schema == docs.schema
        assert sorted(map(tuple, kept.collect())) == sorted(data[1:], key=lambda r: r[0])
        assert sorted((r.doc_id, r.keep_id) for r in exact_dedup(docs).collect()) == [(0, 1), (1, 1), (2, 2), (3, 3)]


def test_only_rows_whose_digest_came_back_are_compared(spark, tmp_path):
    from pyspark.sql import functions as F

    from contestlab.llm.exact_dedup import _among

    rows = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("own"), "id")
    hits = rows.where("id % 100 = 0").select(F.col("own").alias("digest"))
    bitmaps, part, may = _among(hits, F.col("own"))
    found = {r.id for r in rows.join(F.broadcast(bitmaps.withColumnRenamed("part", "_part")), part == F.col("_part")).where(may).collect()}
    assert found >= set(range(0, 5000, 100)) and len(found) < 60
