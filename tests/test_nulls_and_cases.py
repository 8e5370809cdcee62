"""NULL rules, ties, unplayed contests, zero denominators and single-event periods."""

import datetime as dt

from pyspark.sql import functions as F

from contestlab.functions import nulls
from contestlab.operators import records, side_stats


def test_aggregate_null_rules(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (2, None)], "g int, x int")
    out = {r.g: r for r in df.groupBy("g").agg(
        nulls.sum_or_zero(F.col("x")).alias("s"), nulls.strict_max(F.col("x")).alias("m"), nulls.strict_mean(F.col("x")).alias("a")
    ).collect()}
    assert out[2].s == 0 and out[1].m is None and out[1].a is None


def test_safe_div_and_finite(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "a double, b double")
    got = [r.q for r in df.select(nulls.safe_div(F.col("a"), F.col("b")).alias("q")).collect()]
    assert got == [None, 0.5]
    inf = spark.createDataFrame([(float("inf"),), (1.0,)], "x double").select(nulls.finite_or_null(F.col("x")).alias("x"))
    assert [r.x for r in inf.collect()] == [None, 1.0]


def test_round_half_up(spark):
    df = spark.createDataFrame([(0.0625,), (-2.5,), (2.675,)], "x double")
    got = [r.r for r in df.select(nulls.round_half_up(F.col("x"), 3).alias("r")).collect()]
    assert got[0] == 0.063


def test_tie_and_unplayed(spark):
    d = dt.date(2020, 1, 1)
    rows = [
        (2020, 1, d, 1, "g1", "A", "B", 10, 10, 0.0, 0),
        (2020, 2, d + dt.timedelta(days=7), 2, "g2", "A", "B", None, None, 0.0, 0),
        (2020, 3, d + dt.timedelta(days=14), 3, "g3", "A", "B", 21, 3, 0.0, 0),
    ]
    k = spark.createDataFrame(rows, "season bigint, week bigint, gameday date, contest_id bigint, game_id string, home_team string, away_team string, home_score bigint, away_score bigint, line double, div_game bigint")
    rec = {r.contest_id: r for r in records.team_record(k).where(F.col("team") == "A").collect()}
    assert rec[1].win == 0  # a tie is not a win
    assert rec[2].win is None and rec[2].win_total == 0  # unplayed: NULL win, totals unchanged
    assert rec[3].win_total == 1 and rec[3].games == 3


def test_single_play_period_is_null(spark):
    rows = [
        (1, 2020, 1, "g", "A", "B", 0.0, 0, 10, 7, 1, 1, "A", "B", 1, 1, 3, 0, 0, 1, 1, "1:00", 10, 1, 3, 0, 3, 0),
        (1, 2020, 1, "g", "A", "B", 0.0, 0, 10, 7, 2, 2, "A", "B", 1, 0, 0, 0, 1, 0, 0, "0:30", 10, 0, 3, 0, 3, 0),
        (1, 2020, 1, "g", "A", "B", 0.0, 0, 10, 7, 3, 2, "A", "B", 2, 1, 7, 0, 1, 0, 2, "2:05", 20, 1, 10, 0, 10, 0),
    ]
    schema = ("contest_id long, season long, week long, game_id string, home_team string, away_team string, line double, "
              "div_game long, home_score long, away_score long, play_id long, period long, off_team string, def_team string, "
              "drive long, drive_scored long, points long, lost_ball long, converted long, failed long, value_added long, "
              "possession_clock string, air_yards long, completed long, off_score_post long, def_score_post long, "
              "total_home_score long, total_away_score long")
    p = spark.createDataFrame(rows, schema)
    o = side_stats.offense_stats(p).collect()[0]
    assert o.qtr_pts_1 is None  # one play in period 1: start only, no end
    assert o.qtr_pts_2 == 7
    assert o.pts_scored is None
    assert o.ndrives == 2 and o.score_drives == 2
