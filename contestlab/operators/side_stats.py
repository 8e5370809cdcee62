"""Event roll-ups: plays to one row per side per contest (offence, defence, drives, periods, possession).

Every aggregate here is keyed by ``contest_id`` plus a side. The plays adapter is already hash-partitioned by
``contest_id`` (its play-number window), and a partitioning on ``contest_id`` satisfies every grouping that starts
with it, so the whole roll-up runs without another exchange. A contest holds a bounded number of plays, so no
group is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import round_half_up, safe_div, strict_max
from ..functions.text import clock_to_seconds
from ..sources.tables import deal, shuffle_tasks

REGULAR_PERIODS = (1, 2, 3, 4)


def regulation(plays: DataFrame, side: str = "off_team") -> DataFrame:
    """Drop overtime (period above 4) and rows without a side."""
    return plays.where((F.col("period") <= max(REGULAR_PERIODS)) & F.col(side).isNotNull() & (F.col(side) != ""))


def _ids() -> list[Column]:
    return [F.any_value(c).alias(c) for c in ("season", "week", "game_id")]


def _period_span(value: str, k: int, name: str) -> Column:
    """End minus start of ``value`` inside period ``k`` (first and last play); NULL for a one-play period."""
    in_k = F.col("period") == k
    start = F.min_by(F.when(in_k, F.col(value)), F.when(in_k, F.col("play_id")))
    end = F.max_by(F.when(in_k, F.col(value)), F.when(in_k, F.col("play_id")))
    n = F.sum(F.when(in_k, 1).otherwise(0))
    return F.when(n > 1, end - start).alias(name)


def drive_stats(plays: DataFrame, side: str = "off_team", prefix: str = "") -> DataFrame:
    """Scoring-unit rate: drives, scoring drives and their share per contest side.

    A drive that spans periods keeps the flag of its first period (the largest flag within that period).
    """
    reg = regulation(plays, side)
    per_drive = reg.groupBy("contest_id", side, "drive").agg(
        F.max_by("drive_scored", F.struct(-F.col("period"), F.col("drive_scored"))).alias("flag")
    )
    out = per_drive.groupBy("contest_id", side).agg(
        F.count(F.lit(1)).alias("ndrives"), F.sum("flag").cast("bigint").alias("score_drives")
    )
    out = out.withColumn("score_drives_pct", round_half_up(safe_div(F.col("score_drives"), F.col("ndrives")), 3))
    return out.withColumnsRenamed({c: prefix + c for c in ("ndrives", "score_drives", "score_drives_pct")})


def offense_stats(plays: DataFrame, digits: int = 3) -> DataFrame:
    """Per contest and attacking side: venue, division flag, conversion %, turnovers, mean value added, points per
    period (end minus start of the side's running score), points in regulation, final margin and drive stats."""
    reg = regulation(plays, "off_team")
    is_home = (F.col("off_team") == F.col("home_team")).cast("bigint")
    margin = F.when(F.col("off_team") == F.col("home_team"), F.col("home_score") - F.col("away_score")).when(
        F.col("off_team") == F.col("away_team"), F.col("away_score") - F.col("home_score")
    )
    main = reg.groupBy("contest_id", "off_team").agg(
        *_ids(),
        strict_max(is_home).alias("home"),
        strict_max(F.col("div_game")).alias("div_game"),
        F.sum("converted").alias("__conv"),
        F.sum("failed").alias("__fail"),
        F.sum("lost_ball").cast("bigint").alias("turnovers"),
        round_half_up(F.avg("value_added"), digits).alias("value_added"),
        *[_period_span("off_score_post", k, f"qtr_pts_{k}") for k in REGULAR_PERIODS],
        F.any_value(margin).alias("score_diff"),
    )
    main = main.withColumn("third_down_pct", round_half_up(safe_div(F.col("__conv"), F.col("__conv") + F.col("__fail")), digits)).drop("__conv", "__fail")
    main = main.withColumn("pts_scored", sum((F.col(f"qtr_pts_{k}") for k in REGULAR_PERIODS), F.lit(0)))
    out = deal(main, shuffle_tasks(plays), "contest_id", "off_team").join(drive_stats(plays, "off_team"), ["contest_id", "off_team"], "left")
    return out.withColumnRenamed("off_team", "team").select(
        "season", "week", "contest_id", "game_id", "team", "home", "div_game", "third_down_pct", "turnovers",
        "value_added", *[f"qtr_pts_{k}" for k in REGULAR_PERIODS], "pts_scored", "score_diff",
        "ndrives", "score_drives", "score_drives_pct",
    )


def defense_stats(plays: DataFrame, digits: int = 3) -> DataFrame:
    """Mirror of :func:`offense_stats` by defending side: points allowed per period, conversion % allowed,
    takeaways, mean value allowed and the opponents' drive stats, all as ``def_*`` columns."""
    reg = regulation(plays, "def_team")
    main = reg.groupBy("contest_id", "def_team").agg(
        *_ids(),
        F.sum("converted").alias("__conv"),
        F.sum("failed").alias("__fail"),
        F.sum("lost_ball").cast("bigint").alias("def_turnovers"),
        round_half_up(F.avg("value_added"), digits).alias("def_value_added"),
        *[_period_span("off_score_post", k, f"def_qtr_pts_{k}") for k in REGULAR_PERIODS],
    )
    main = main.withColumn("def_third_down_pct", round_half_up(safe_div(F.col("__conv"), F.col("__conv") + F.col("__fail")), digits)).drop("__conv", "__fail")
    out = deal(main, shuffle_tasks(plays), "contest_id", "def_team").join(drive_stats(plays, "def_team", prefix="def_"), ["contest_id", "def_team"], "left")
    return out.withColumnRenamed("def_team", "team").select(
        "season", "week", "contest_id", "game_id", "team", *[f"def_qtr_pts_{k}" for k in REGULAR_PERIODS],
        "def_value_added", "def_third_down_pct", "def_turnovers", "def_ndrives", "def_score_drives", "def_score_drives_pct",
    )


def period_points(plays: DataFrame) -> DataFrame:
    """Points per period from the running score: period 1 is the running total itself, later periods are the
    change from the previous period the side attacked in; a period without plays for the side is NULL."""
    reg = regulation(plays, "off_team")
    own = F.when(F.col("off_team") == F.col("home_team"), F.col("total_home_score")).otherwise(F.col("total_away_score"))
    # a period the side never attacked in has no row in the reference, so a plain max (NULL when absent)
    per = reg.groupBy("contest_id", "off_team").agg(
        *_ids(), *[F.max(F.when(F.col("period") == k, own)).alias(f"__v{k}") for k in REGULAR_PERIODS]
    )
    cols = {}
    for k in REGULAR_PERIODS:
        if k == 1:
            cols["qtr_pts_1"] = F.col("__v1")
        else:
            prev = F.coalesce(*[F.col(f"__v{j}") for j in range(k - 1, 0, -1)])
            cols[f"qtr_pts_{k}"] = F.col(f"__v{k}") - prev
    out = per.withColumns(cols)
    return out.withColumnRenamed("off_team", "team").select("season", "week", "contest_id", "game_id", "team", *cols)


def period_margin(plays: DataFrame, digits: int = 3) -> DataFrame:
    """Margin after each play, by period: mean per period, mean of the period means, and change over the period."""
    reg = regulation(plays, "off_team")
    m = F.col("off_score_post") - F.col("def_score_post")
    reg = reg.withColumn("__m", m)
    per = reg.groupBy("contest_id", "off_team").agg(
        *_ids(),
        *[F.avg(F.when(F.col("period") == k, F.col("__m"))).alias(f"__a{k}") for k in REGULAR_PERIODS],
        *[_period_span("__m", k, f"dscore_diff_qtr_{k}") for k in REGULAR_PERIODS],
    )
    present = [F.col(f"__a{k}") for k in REGULAR_PERIODS]
    n_present = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in present), F.lit(0))
    total = sum((F.coalesce(c, F.lit(0.0)) for c in present), F.lit(0.0))
    out = per.withColumns({f"score_diff_qtr_{k}": round_half_up(F.col(f"__a{k}"), digits) for k in REGULAR_PERIODS})
    out = out.withColumn("score_diff", round_half_up(safe_div(total, n_present), digits))
    return out.withColumnRenamed("off_team", "team").select(
        "season", "week", "contest_id", "game_id", "team", "score_diff",
        *[f"score_diff_qtr_{k}" for k in REGULAR_PERIODS], *[f"dscore_diff_qtr_{k}" for k in REGULAR_PERIODS],
    )


def possession_share(plays: DataFrame, digits: int = 4) -> DataFrame:
    """Possession time per side (sum over drives of the mean clock per drive and period) and its share of the
    contest total."""
    reg = regulation(plays, "off_team").withColumn("__sec", clock_to_seconds(F.col("possession_clock")))
    per_drive = reg.groupBy("contest_id", "off_team", "period", "drive").agg(F.avg("__sec").alias("top"))
    side = per_drive.groupBy("contest_id", "off_team").agg(F.sum("top").alias("possession_sec"))
    share = safe_div(F.col("possession_sec"), F.sum("possession_sec").over(Window.partitionBy("contest_id")))
    return side.select(
        "contest_id",
        F.col("off_team").alias("team"),
        round_half_up(F.col("possession_sec"), digits).alias("possession_sec"),
        round_half_up(share, digits).alias("possession_pct"),
    )


def closing_line(plays: DataFrame) -> DataFrame:
    """One line per contest (from its first play), as a row for each side."""
    one = plays.groupBy("contest_id").agg(
        *_ids(),
        F.min_by("line", "play_id").alias("line"),
        F.min_by("home_team", "play_id").alias("home_team"),
        F.min_by("away_team", "play_id").alias("away_team"),
    )
    return one.select(
        "contest_id", "season", "week", "line",
        F.inline(F.array(
            F.struct(F.lit("home").alias("home_away"), F.col("home_team").alias("team")),
            F.struct(F.lit("away").alias("home_away"), F.col("away_team").alias("team")),
        )),
    )


DEEP_YARDS = 15


def pass_splits(plays: DataFrame, digits: int = 4) -> DataFrame:
    """Per contest and attacking side: deep (air yards >= 15) and short attempts and completions, the best running
    value total within the contest, value per play, and plays."""
    w = Window.partitionBy("contest_id", "off_team").orderBy("play_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p = plays.where(F.col("off_team").isNotNull()).withColumn("__cum", F.sum("value_added").over(w))
    deep = F.col("air_yards") >= DEEP_YARDS
    short = F.col("air_yards") < DEEP_YARDS
    g = p.groupBy("contest_id", "off_team").agg(
        *_ids(),
        F.sum(F.when(deep, 1).otherwise(0)).cast("bigint").alias("deep_pass_attempt"),
        F.sum(F.when(deep, F.col("completed")).otherwise(0)).cast("bigint").alias("deep_pass_complete"),
        F.sum(F.when(short, 1).otherwise(0)).cast("bigint").alias("short_pass_attempt"),
        F.sum(F.when(short, F.col("completed")).otherwise(0)).cast("bigint").alias("short_pass_complete"),
        F.max("__cum").cast("bigint").alias("max_value"),
        F.count(F.lit(1)).alias("total_plays"),
    )
    g = g.withColumn("value_per_play", round_half_up(F.col("max_value") / F.col("total_plays"), digits))
    return g.withColumnRenamed("off_team", "team")


def yards_long(plays: DataFrame) -> DataFrame:
    """Passing (completed) and running (not completed) yards per season and attacking side, in long form."""
    g = plays.where(F.col("off_team").isNotNull()).groupBy("season", F.col("off_team").alias("team")).agg(
        F.sum(F.when(F.col("completed") == 1, F.col("air_yards")).otherwise(0)).cast("bigint").alias("pass_yards"),
        F.sum(F.when(F.col("completed") == 0, F.col("air_yards")).otherwise(0)).cast("bigint").alias("run_yards"),
    )
    return g.unpivot(["season", "team"], ["pass_yards", "run_yards"], "kind", "yards")


def game_stats(plays: DataFrame) -> DataFrame:
    """Wide per-side contest table: offence roll-up, possession time and share, period margins and their change."""
    off = offense_stats(plays)
    poss = possession_share(plays)
    marg = period_margin(plays).drop("season", "week", "game_id", "score_diff").withColumnRenamed("team", "team")
    return off.join(poss, ["contest_id", "team"], "left").join(marg, ["contest_id", "team"], "left")
