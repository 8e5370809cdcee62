"""The bucketed scan equals plain windows for any bucket width and chunk size, also for rows with a NULL group key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from contestlab.operators.scan import GroupOrder, framed, scan


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)
    data = []
    for i in range(600):
        g = rnd.choice(["a", None, "c"]) if rnd.random() < 0.9 else "hot"
        v = None if rnd.random() < 0.15 else rnd.randint(-5, 9)
        data.append((g, rnd.randint(0, 40), i, v))
    return spark.createDataFrame(data, "g string, t int, id int, v int")


@pytest.mark.parametrize("width", [1, 7, 1000])
@pytest.mark.parametrize("depth", [0, 1, 3])
def test_scan_matches_windows(spark, rows, width, depth):
    levels = [
        {"__b1": F.col("t"), "__b2": F.floor(F.col("id") / width)},
        {"__c1": F.col("t")},
        {"__d1": F.floor(F.col("t") / 10)},
    ][:depth]
    go = GroupOrder(keys=["g"], order=["t", "id"], levels=levels)
    got = scan(rows, go, sums={"s": F.col("v"), "n": F.lit(1)}, lags={"prev": "v"}, carry={"last_v": "v"})
    w = Window.partitionBy("g").orderBy("t", "id")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    exp = rows.select(
        "id",
        F.coalesce(F.sum("v").over(run), F.lit(0)).alias("s"),
        F.count(F.lit(1)).over(run).alias("n"),
        F.lag("v").over(w).alias("prev"),
        F.last("v", ignorenulls=True).over(run).alias("last_v"),
    )
    a = {r.id: (r.s, r.n, r.prev, r.last_v) for r in got.collect()}
    b = {r.id: (r.s, r.n, r.prev, r.last_v) for r in exp.collect()}
    assert a == b


@pytest.mark.parametrize("chunk", [4, 16, 1 << 20])
def test_framed_matches_windows(spark, rows, chunk):
    go = GroupOrder(keys=["g"], order=["t", "id"], levels=[{"__b": F.col("t")}, {"__c": F.floor(F.col("t") / 8)}])

    def build(w):
        return {"m3": F.avg("v").over(w.rowsBetween(-3, -1)), "s1": F.sum("v").over(w.rowsBetween(-1, -1))}

    got = framed(rows, go, build, halo=3, chunk_rows=chunk)
    w = Window.partitionBy("g").orderBy("t", "id")
    exp = rows.select("id", F.avg("v").over(w.rowsBetween(-3, -1)).alias("m3"), F.sum("v").over(w.rowsBetween(-1, -1)).alias("s1"))
    a = {r.id: (r.m3, r.s1) for r in got.collect()}
    b = {r.id: (r.m3, r.s1) for r in exp.collect()}
    assert a == b


def test_global_scan_without_keys(spark, rows):
    go = GroupOrder(keys=[], order=["t", "id"], levels=[{"__b": F.col("t")}, {"__c": F.floor(F.col("t") / 8)}])
    got = scan(rows, go, sums={"n": F.lit(1)})
    exp = rows.select("id", F.row_number().over(Window.orderBy("t", "id")).alias("n"))
    assert {r.id: r.n for r in got.collect()} == {r.id: r.n for r in exp.collect()}
