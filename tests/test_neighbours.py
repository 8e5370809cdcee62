"""Synthetic rows lie on their segment and their number is exact; neighbours do not depend on block sizes."""

import random

import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors

from contestlab.operators import ml
from contestlab.operators.ml import nearest_neighbours, smote


def points(spark, data):
    return spark.createDataFrame([(i, Vectors.dense(v), y) for i, v, y in data], ["id", "features", "y"])


def test_smote_points_and_count(spark):
    r = random.Random(1)
    data = [(i, [r.random() for _ in range(4)], int(i < 100)) for i in range(1000)]
    by_id = {i: v for i, v, _ in data}
    out = smote(points(spark, data), "y", 1).collect()
    assert sum(x.y == 1 for x in out) == 810
    gaps = set()
    for x in out:
        if x.synthetic:
            a, b, _ = x.id.split("~")
            a, b = by_id[int(a)], by_id[int(b)]
            gap = [(v - p) / (q - p) for v, p, q in zip(x.features, a, b)]
            assert max(gap) - min(gap) < 1e-9 and 0 <= gap[0] < 1
            gaps.add(round(gap[0], 9))
    assert len(gaps) > 700
    again = smote(points(spark, data).repartition(5), "y", 1).collect()
    assert {(x.id, tuple(x.features)) for x in out if x.synthetic} == {(x.id, tuple(x.features)) for x in again if x.synthetic}


@pytest.mark.parametrize("block", [7, 64, 1024])
def test_equal_distances_go_by_id(spark, block):
    data = [(i, [1.0, 2.0], 0) for i in range(150)] + [(500, [5.0, 5.0], 0)]
    df = points(spark, data)
    got = nearest_neighbours(df.where("id = 500"), df, 3, exclude_self=True, block_rows=block).collect()
    assert sorted(x.right_id for x in got) == [0, 1, 2]


def brute(left, right, k, exclude_self):
    out = set()
    for i, v, _ in left:
        d = sorted((sum((a - b) ** 2 for a, b in zip(v, w, strict=True)) ** 0.5, j) for j, w, _ in right if not (exclude_self and i == j))
        out |= {(i, j, n + 1) for n, (_, j) in enumerate(d[:k])}
    return out


@pytest.mark.parametrize("block,cells", [(1024, None), (16, 40), (7, 1)])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_cells_equal_brute_force_under_ties(spark, block, cells, exclude_self):
    """A grid with many equal distances, and a vector that a third of all rows share."""
    r = random.Random(6)
    data = [(i, [float(r.randrange(6)), float(r.randrange(6)), float(r.randrange(3))], 0) for i in range(200)] + [(1000 + i, [2.0, 2.0, 1.0], 0) for i in range(100)]
    left = data if exclude_self else data[::7] + [(5000, [99.0, 99.0, 99.0], 0)]
    got = nearest_neighbours(points(spark, left), points(spark, data), 4, exclude_self=exclude_self, block_rows=block, cells=cells)
    assert {(x.left_id, x.right_id, x.nn_rank) for x in got.collect()} == brute(left, data, 4, exclude_self)


def test_few_rows_and_no_rows(spark):
    data = [(1, [0.0], 0), (2, [3.0], 0)]
    got = nearest_neighbours(points(spark, data), points(spark, data), 5, exclude_self=True).collect()
    assert {(x.left_id, x.right_id, x.nn_rank) for x in got} == {(1, 2, 1), (2, 1, 1)}
    none = points(spark, data).limit(0)
    assert nearest_neighbours(points(spark, data), none, 2).count() == 0
    assert nearest_neighbours(none, points(spark, data), 2).count() == 0


def test_clustered_rows_compare_few_pairs(spark):
    """In clusters only cells near a row are visited, and the share of compared pairs falls as rows are added."""
    share = []
    for n in (1000, 4000):
        r = random.Random(n)
        centre = [[r.uniform(-100, 100) for _ in range(6)] for _ in range(30)]
        data = [(i, [c + r.gauss(0, 1) for c in centre[i % 30]], 0) for i in range(n)]
        seen = {}
        got = nearest_neighbours(points(spark, data[::20]), points(spark, data), 3, exclude_self=True, compared=seen)
        assert {(x.left_id, x.right_id, x.nn_rank) for x in got.collect()} == brute(data[::20], data, 3, True)
        share.append(seen["pairs"] / seen["all"])
    assert share[0] < 0.2 and share[1] < share[0]


def test_index_tasks_work_in_bounded_pieces(spark):
    """Where nothing can be ruled out a row visits every cell; what a task holds and hands over at a time stays bounded."""
    batch = pd.DataFrame({"lid": range(10_000)})
    for cells in (1, 40, 1024, 1 << 20):
        pieces = list(ml._slices([batch, batch.iloc[:0], batch], cells))
        assert all(len(p) * cells <= max(ml.SLICE_CELLS, cells) for p in pieces)
        assert [i for p in pieces for i in p["lid"]] == [*range(10_000)] * 2
    r = random.Random(3)
    data = [(i, [r.gauss(0, 1) for _ in range(24)], 0) for i in range(900)]
    df = points(spark, data)
    seen: dict = {}
    got = nearest_neighbours(df.where("id < 300"), df, 3, exclude_self=True, compared=seen).collect()
    for i in range(0, 300, 37):
        want = sorted((sum((a - b) ** 2 for a, b in zip(data[i][1], v)), j) for j, v, _ in data if j != i)[:3]
        assert [x.right_id for x in sorted((x for x in got if x.left_id == i), key=lambda x: x.nn_rank)] == [j for _, j in want]
