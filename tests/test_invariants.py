"""Structural invariants on the driver tables."""

from pyspark.sql import functions as F

from testdata_paths import SF_SMALL
from contestlab.operators import ml, ratings
from contestlab.registry import QUERIES
from contestlab.sources import prepared


def test_two_sides_per_contest(spark):
    s = QUERIES["sides_long"](spark, SF_SMALL)
    assert s.groupBy("contest_id").count().where(F.col("count") != 2).count() == 0


def test_rating_points_are_conserved(spark):
    k = prepared.contests(spark, SF_SMALL)
    elo = ratings.elo_ratings(k, digits=None)
    pre = ratings.pregame_ratings(elo)
    moved = pre.withColumn("d", F.col("elo") - F.col("pre_elo")).groupBy("contest_id").agg(F.sum("d").alias("d"))
    assert moved.where(F.abs("d") > 1e-9).count() == 0


def test_lagged_values_use_only_earlier_rows(spark):
    lag = QUERIES["lagged_record"](spark, SF_SMALL)
    rec = QUERIES["team_record"](spark, SF_SMALL).select("contest_id", "team", F.col("win_pct").alias("now"))
    j = lag.join(rec, ["contest_id", "team"])
    first = j.groupBy("season", "team").agg(F.min_by("win_pct", F.struct("gameday", "contest_id")).alias("w"))
    assert first.where(F.col("w").isNotNull()).count() == 0


def test_split_is_exactly_stratified(spark):
    k = prepared.contests(spark, SF_SMALL).select("contest_id", (F.col("home_score") > F.col("away_score")).cast("int").alias("y"))
    s = ml.stratified_split(k, ["y"], "contest_id", prop=0.75)
    for r in s.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("split") == "train").cast("int")).alias("t")).collect():
        assert r.t == int(0.75 * r.n + 0.5)


def test_shares_sum_to_one(spark):
    s = QUERIES["possession_share"](spark, SF_SMALL)
    bad = s.groupBy("contest_id").agg(F.sum("possession_pct").alias("s")).where(F.abs(F.col("s") - 1) > 1e-3)
    assert bad.count() == 0


def test_play_numbers_are_unique_and_dense(spark):
    p = prepared.plays(spark, SF_SMALL)
    g = p.groupBy("contest_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("play_id").alias("d"), F.max("play_id").alias("m"))
    assert g.where((F.col("n") != F.col("d")) | (F.col("m") != F.col("n"))).count() == 0
