"""Adapter views: the stored tables seen as contests, plays and players.

The analysis works on contests (one row per home-versus-away pairing, with a final score and a bookmaker line),
on plays (events inside a contest) and on per-player event series. The driver tables are mapped onto those shapes by
fixed, documented rules; ``contestlab.oracle`` holds the same rules as SQL so both engines see identical inputs.

Scale notes: ``orders`` joins ``customer`` on the customer key (a shuffle join of two large tables); ``nation`` is the
fixed 25-row team dimension and is broadcast after a size check. ``plays`` joins ``lineitem`` to ``contests`` on the
contest key; the play number window and every later per-contest aggregate reuse that one hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import bounded_broadcast, read_table

# Fixed values of the mapping (shared with the SQL text in contestlab/oracle.py)
N_TEAMS = 25            # nation keys 0..24 act as team ids
SCORE_MOD = 45          # scores are derived from the order price modulo 45
LINE_MOD, LINE_SHIFT = 29, 14   # line = contest_id % 29 - 14, positive = home favoured
DIM_MAX_ROWS = 1000     # largest dimension we agree to broadcast


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team dimension: ``team_id`` (nation key), ``team`` (code), ``league`` (region key)."""
    return read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"]).select(
        F.col("n_nationkey").alias("team_id"),
        F.regexp_replace("n_name", "[^A-Za-z0-9]", "").alias("team"),
        F.col("n_regionkey").alias("league"),
    )


def contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contest.

    ``season, week, gameday, contest_id, game_id, home_team, away_team, home_score, away_score, line, div_game``.
    """
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    dim = bounded_broadcast(teams(spark, sf_dir), DIM_MAX_ROWS)
    home = dim.select(F.col("team_id").alias("home_id"), F.col("team").alias("home_team"), F.col("league").alias("home_league"))
    away = dim.select(F.col("team_id").alias("away_id"), F.col("team").alias("away_team"), F.col("league").alias("away_league"))
    base = o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        F.year("o_orderdate").cast("bigint").alias("season"),
        (F.floor((F.dayofyear("o_orderdate") - 1) / 7) + 1).cast("bigint").alias("week"),
        F.to_date("o_orderdate").alias("gameday"),
        F.col("o_orderkey").alias("contest_id"),
        F.col("c_nationkey").alias("home_id"),
        ((F.col("c_nationkey") + 1 + F.col("o_orderkey") % (N_TEAMS - 1)) % N_TEAMS).alias("away_id"),
        (F.floor("o_totalprice").cast("bigint") % SCORE_MOD).alias("home_score"),
        (F.floor(F.col("o_totalprice") / SCORE_MOD).cast("bigint") % SCORE_MOD).alias("away_score"),
        (F.col("o_orderkey") % LINE_MOD - LINE_SHIFT).cast("double").alias("line"),
    )
    out = base.join(home, "home_id").join(away, "away_id")
    return out.select(
        "season",
        "week",
        "gameday",
        "contest_id",
        F.format_string("%d_%02d_%s_%s", "season", "week", "away_team", "home_team").alias("game_id"),
        "home_team",
        "away_team",
        "home_score",
        "away_score",
        "line",
        (F.col("home_league") == F.col("away_league")).cast("bigint").alias("div_game"),
    )


def plays(spark: SparkSession, sf_dir: str, contest_df: DataFrame | None = None) -> DataFrame:
    """One row per play (event inside a contest).

    ``contest_id, season, week, game_id, home_team, away_team, line, div_game, play_id, period, off_team, def_team, drive,
    drive_scored, points, lost_ball, converted, failed, value_added, possession_clock, air_yards, completed,
    off_score_post, def_score_post, total_home_score, total_away_score``.
    Periods above 4 play the part of overtime.
    """
    k = contest_df if contest_df is not None else contests(spark, sf_dir)
    k = k.select("contest_id", "season", "week", "game_id", "home_team", "away_team", "line", "div_game", "home_score", "away_score")
    li = read_table(
        spark,
        sf_dir,
        "lineitem",
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
         "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    )
    j = li.join(k, li.l_orderkey == k.contest_id, "inner")
    play_order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus", "l_shipdate"]
    w_play = Window.partitionBy("contest_id").orderBy(*play_order)
    # the running scores use the same ordering (play_id is its row number), so both windows share one sort
    w_run = w_play.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    home_off = (F.col("l_linenumber") + F.col("l_orderkey")) % 2 == 0
    scored = F.col("l_tax") > F.lit(0.04)
    p = j.select(
        "contest_id", "season", "week", "game_id", "home_team", "away_team", "line", "div_game", "home_score", "away_score",
        *play_order,
        F.row_number().over(w_play).cast("bigint").alias("play_id"),
        F.col("l_linenumber").cast("bigint").alias("period"),
        F.when(home_off, F.col("home_team")).otherwise(F.col("away_team")).alias("off_team"),
        F.when(home_off, F.col("away_team")).otherwise(F.col("home_team")).alias("def_team"),
        (F.col("l_partkey") % 8).alias("drive"),
        F.when(scored, 1).otherwise(0).cast("bigint").alias("drive_scored"),
        F.when(scored, 3 + F.col("l_suppkey") % 5).otherwise(0).cast("bigint").alias("points"),
        F.when(F.col("l_quantity") <= 5, 1).otherwise(0).cast("bigint").alias("lost_ball"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).cast("bigint").alias("converted"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).cast("bigint").alias("failed"),
        F.round((F.col("l_discount") - 0.05) * 100).cast("bigint").alias("value_added"),
        F.concat(
            (F.floor("l_quantity").cast("bigint") % 10).cast("string"),
            F.lit(":"),
            F.lpad((F.floor("l_extendedprice").cast("bigint") % 60).cast("string"), 2, "0"),
        ).alias("possession_clock"),
        F.floor("l_quantity").cast("bigint").alias("air_yards"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).cast("bigint").alias("completed"),
    )
    # running scores inside a contest (a contest holds a handful of plays, so this window is small)
    home_pts = F.when(F.col("off_team") == F.col("home_team"), F.col("points")).otherwise(0)
    away_pts = F.when(F.col("off_team") == F.col("away_team"), F.col("points")).otherwise(0)
    p = p.withColumns(
        {
            "total_home_score": F.sum(home_pts).over(w_run),
            "total_away_score": F.sum(away_pts).over(w_run),
        }
    )
    is_home = F.col("off_team") == F.col("home_team")
    return p.withColumns(
        {
            "off_score_post": F.when(is_home, F.col("total_home_score")).otherwise(F.col("total_away_score")),
            "def_score_post": F.when(is_home, F.col("total_away_score")).otherwise(F.col("total_home_score")),
        }
    ).drop(*play_order)


def player_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-player event series: ``player_id, ts, event_id, day, event_type, value, k``."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    return e.select(
        F.col("user_id").alias("player_id"),
        "ts",
        "event_id",
        F.to_date("ts").alias("day"),
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
