"""Small helpers: reshaping, names, statistics, validity rules, model workflow pieces."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from contestlab.functions import nulls, text
from contestlab.operators import ml, reshape, stats


def test_wider_longer_round_trip(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 10), (1, "b", 2.0, 20), (2, "a", 3.0, 30)], "id int, k string, x double, y int")
    w = reshape.wider(df, ["id"], "k", ["x", "y"], ["a", "b"], glue="{value}_{name}")
    assert sorted(w.columns) == ["id", "x_a", "x_b", "y_a", "y_b"]
    row = {r.id: r for r in w.collect()}
    assert row[1].x_b == 2.0 and row[2].y_b is None
    long = reshape.longer(w.select("id", "x_a", "x_b"), ["id"], ["x_a", "x_b"])
    assert long.count() == 4


def test_name_rules(spark):
    df = spark.createDataFrame([(1, 2, 3)], "GameId int, `pts lag1_roll_4` int, opp int")
    assert reshape.snake_names(df).columns == ["game_id", "pts_lag1_roll_4", "opp"]
    assert reshape.strip_suffix(reshape.snake_names(df), r"_lag1_roll_4$").columns == ["game_id", "pts", "opp"]
    assert reshape.column_range(df, "GameId", "pts lag1_roll_4") == ["GameId", "pts lag1_roll_4"]
    assert reshape.prefix_columns(df, "opp_", ["GameId"]).columns == ["GameId", "opp_pts lag1_roll_4", "opp_opp"]


def test_text_helpers(spark):
    df = spark.createDataFrame([("Chicago CHI", "J.J. Watt-Jr", "12:05", "September 9")], "a string, n string, c string, d string")
    r = df.select(text.last_token(F.col("a")).alias("t"), text.clean_name(F.col("n")).alias("n"),
                  text.clock_to_seconds(F.col("c")).alias("s")).first()
    assert (r.t, r.n, r.s) == ("CHI", "j_j_watt_jr", 725)
    from contestlab.operators.nested import parse_dates
    assert parse_dates(df, "d", 2021).first().gameday == dt.date(2021, 9, 9)
    ages = spark.createDataFrame([(dt.date(1990, 7, 15), dt.date(2021, 1, 3))], "b date, a date")
    assert ages.select(text.age_years(F.col("b"), F.col("a")).alias("x")).first().x == 30.5


def test_clamp_and_regex_filter(spark):
    df = spark.createDataFrame([(1999, 1), (2021, 30), (2010, 18), (2021, 18)], "s int, w int")
    got = [r.c for r in df.select(nulls.clamp_week(F.col("s"), F.col("w")).alias("c")).collect()]
    assert got == [2, 18, 17, 18]
    rows = spark.createDataFrame([("Week",), ("1",), ("Playoffs",)], "week string")
    assert [r.week for r in nulls.drop_matching(rows, "week", "^(Week|Playoffs)$").collect()] == ["1"]


def test_mean_fill_and_diagnostics(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 4.0), ("b", float("nan"))], "g string, x double")
    filled = {(r.g, r.x) for r in nulls.fill_with_mean(df.where(~F.isnan("x") | F.col("x").isNull()), ["x"], by=["g"]).collect()}
    assert ("a", 1.0) in filled and len(filled) == 2
    assert nulls.rows_with_missing(df).count() == 1
    assert sum(r.x for r in nulls.nan_mask(df).collect() if r.x) == 1


def test_group_stats(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 7.0), ("a", 3, 9.0), ("b", 1, 2.0)], "g string, t int, v double")
    assert {r.g: r.second_last for r in stats.second_to_last(df, ["g"], "t", "v").collect()} == {"a": 7.0}
    ids = {r.g: r.group_id for r in stats.group_ids(df, ["g"]).collect()}
    assert ids == {"a": 1, "b": 2}
    s = stats.spread_summary(df, "v", ["g"]).where(F.col("g") == "a").first()
    assert (s.sd, s.mean, s.scaled_mean) == (2.0, 7.0, 3.5)
    tot = {r.g: r.v for r in stats.numeric_totals(df, ["g"]).collect()}
    assert tot == {"a": 21.0, "b": 2.0}


def test_quantile_bins_and_workflows(spark):
    df = spark.range(0, 400).withColumn("y", F.col("id") * 1.0)
    binned = ml.quantile_strata(df, "y", n_bins=4)
    counts = sorted(r["count"] for r in binned.groupBy("stratum").count().collect())
    assert len(counts) == 4 and min(counts) >= 90
    pre = {"base": ml.preprocess_stages(["a"]), "poly": ml.preprocess_stages(["a"], poly_degree=2)}
    ws = ml.workflow_set(pre, ml.classifiers("label"))
    assert "poly__logistic" in ws and len(ws) == 8


@pytest.mark.parametrize("margin", [0.0, 1.0])
def test_racing_keeps_leaders(spark, margin):
    from pyspark.ml.tuning import ParamGridBuilder

    rows = [(i, float(i % 2), float((i * 7) % 11) + (i % 2) * 3.0) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, label double, a double")
    df = ml.stratified_folds(df, ["label"], "id", k=4)
    est = ml.classifiers("label")["logistic"]
    grid = ParamGridBuilder().addGrid(est.regParam, [0.0, 10.0]).build()
    res = ml.race(ml.workflow(ml.preprocess_stages(["a"]), est), grid, df, "label", k=4, burn_in=2, margin=margin)
    assert res.kept and all(len(v) >= 2 for v in res.fold_scores.values())


def test_nearest_neighbours_are_exact(spark):
    """Blockwise search equals brute force (small blocks force many block pairs)."""
    import numpy as np

    from contestlab.plans import models
    from contestlab.sources.tables import read_table

    from testdata_paths import SF_SMALL

    e = models.embedding_table(read_table(spark, SF_SMALL, "embeddings", ["vec_id", "embedding", "label"])).limit(120)
    e = spark.createDataFrame(e.collect(), e.schema)
    left, right = e.where(F.col("id") % 3 == 0), e.where(F.col("id") % 3 != 0)
    got = {}
    for r in ml.nearest_neighbours(left, right, 4, block_rows=16).collect():
        got.setdefault(r.left_id, []).append((r.nn_rank, r.right_id))
    R = right.toPandas()
    X = np.stack(R.features.map(lambda v: v.toArray()))
    for r in left.toPandas().itertuples():
        d = np.sqrt(((X - r.features.toArray()) ** 2).sum(1))
        want = list(R.id.values[np.lexsort((R.id.values, d))[:4]])
        assert [rid for _, rid in sorted(got[r.id])] == want


def test_smote_reaches_ratio(spark):
    rows = [(i, float(i % 7), float(i % 5), 1 if i % 10 == 0 else 0) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label int")
    from pyspark.ml.feature import VectorAssembler

    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    out = ml.smote(df, "label", 1, ratio=0.9, k=3)
    counts = {(r.label, r.synthetic): r["count"] for r in out.groupBy("label", "synthetic").count().collect()}
    assert counts[(1, 0)] + counts[(1, 1)] >= int(0.9 * counts[(0, 0)])
