"""Coming fixtures with each side's latest snapshot (record, rating, season-to-date margin) before a given week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import round_half_up
from ..operators import ratings, records


def snapshot(contests: DataFrame, season: int, week: int, digits: int = 4) -> DataFrame:
    """Latest state of every team in ``season`` from contests before ``week``: running record values of its last
    contest, its rating after it, and its mean margin so far. The latest row is a ``max_by`` on the order key."""
    k = contests.where(F.col("season") == season)
    rec = records.with_margin(records.team_record(k)).where(F.col("week") < week)
    elo = ratings.elo_ratings(k, digits=None).select("contest_id", "team", "elo")
    t = rec.join(elo, ["contest_id", "team"], "left")
    order = F.struct("gameday", "contest_id")
    return t.groupBy("team").agg(
        F.max_by(F.struct("games", "win_pct", "home_win_pct", "away_win_pct", "elo"), order).alias("s"),
        round_half_up(F.avg("spread"), digits).alias("mean_margin"),
    ).select(
        "team", F.col("s.games").alias("games"), F.col("s.win_pct").alias("win_pct"), F.col("s.home_win_pct").alias("home_win_pct"),
        F.col("s.away_win_pct").alias("away_win_pct"), round_half_up(F.col("s.elo"), digits).alias("elo"), "mean_margin",
    )


def next_matchups(contests: DataFrame, season: int, week: int) -> DataFrame:
    """Fixtures of ``(season, week)`` with the home side's snapshot and the away side's as ``opp_*``.

    Same result as two left joins of the fixtures to the snapshot (home team, then away team), but the snapshot is
    computed and joined once: each fixture is split into its two sides, joined on team, and paired again with one
    aggregation per contest."""
    ids = ["season", "week", "game_id", "home_team", "away_team", "line"]
    fx = contests.where((F.col("season") == season) & (F.col("week") == week)).select("contest_id", *ids)
    playing = fx.select(F.col("home_team").alias("team")).unionByName(fx.select(F.col("away_team").alias("team")))
    # only teams with a fixture need a snapshot (semi join, the %in% filter)
    snap = snapshot(contests, season, week).join(playing, "team", "left_semi")
    vals = [c for c in snap.columns if c != "team"]
    two = fx.select(
        "contest_id", *ids,
        F.inline(F.array(
            F.struct(F.lit("home").alias("home_away"), F.col("home_team").alias("team")),
            F.struct(F.lit("away").alias("home_away"), F.col("away_team").alias("team")),
        )),
    ).join(snap, "team", "left")
    home, away = F.col("home_away") == "home", F.col("home_away") == "away"
    return two.groupBy("contest_id").agg(
        *[F.first(c).alias(c) for c in ids],
        *[F.first(F.when(home, F.col(v)), ignorenulls=True).alias(v) for v in vals],
        *[F.first(F.when(away, F.col(v)), ignorenulls=True).alias(f"opp_{v}") for v in vals],
    )
