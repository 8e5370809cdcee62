"""Running records per (season, team): wins, win %, venue win %, rest days, margins.

Every running value is a prefix sum computed by :func:`contestlab.operators.scan.scan`, so a team with a very long
season is still split over many tasks. The home (away) win % carried onto away (home) rows is the ratio of running
home (away) wins to running home (away) games, which is exactly the last home value carried forward, and 0 before
the first such game.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import round_half_up, safe_div
from ..sources.tables import shuffle_tasks
from .reshape import sides
from .scan import ID_WIDTH, GroupOrder, date_levels, scan

DEFAULT_REST_DAYS = 7


def season_order(keys: list[str] | None = None, id_width: int = ID_WIDTH, tasks: int | None = None) -> GroupOrder:
    """Group by (season, team); order by (gameday, contest_id); buckets: id range within a day, day, month."""
    return GroupOrder(keys or ["season", "team"], ["gameday", "contest_id"], date_levels("gameday", "contest_id", id_width), tasks)


def team_record(contests: DataFrame, digits: int = 3, id_width: int = ID_WIDTH, keep: list[str] | None = None) -> DataFrame:
    """Record rows: one per team per contest with win flag, running totals and win %s, rest days and opponent.

    Tie and loss are 0; a contest without a score gives a NULL win and does not change the totals. ``keep`` passes
    further contest columns through (e.g. the line), so callers need no join back to the contests.
    """
    s = sides(contests)
    win = F.when(F.col("own_score") > F.col("opp_score"), 1).when(F.col("own_score") <= F.col("opp_score"), 0)
    ids = ["season", "week", "gameday", "contest_id", "game_id", "team", "opponent", "home_away", "is_home", "own_score", "opp_score"]
    s = s.select(*ids, *[c for c in keep or [] if c not in ids], win.cast("bigint").alias("win"))
    go = season_order(id_width=id_width, tasks=shuffle_tasks(contests, 2))
    home = F.col("is_home")
    r = scan(
        s,
        go,
        sums={
            "games": F.lit(1),
            "win_total": F.col("win"),
            "home_games": home,
            "home_win": F.col("win") * home,
            "away_games": 1 - home,
            "away_win": F.col("win") * (1 - home),
        },
        lags={"prev_gameday": "gameday"},
    )
    return r.select(
        "season", "week", "gameday", "contest_id", "game_id", "team", "opponent", "home_away",
        F.coalesce(F.datediff("gameday", "prev_gameday"), F.lit(DEFAULT_REST_DAYS)).cast("bigint").alias("rest_days"),
        "win", "own_score", "opp_score",
        F.col("games").cast("bigint").alias("games"),
        F.col("win_total").cast("bigint").alias("win_total"),
        F.col("home_win").cast("bigint").alias("home_win"),
        F.col("away_win").cast("bigint").alias("away_win"),
        round_half_up(safe_div(F.col("win_total"), F.col("games")), digits).alias("win_pct"),
        round_half_up(F.coalesce(safe_div(F.col("home_win"), F.col("home_games")), F.lit(0.0)), digits).alias("home_win_pct"),
        round_half_up(F.coalesce(safe_div(F.col("away_win"), F.col("away_games")), F.lit(0.0)), digits).alias("away_win_pct"),
        *(keep or []),
    )


def with_margin(record: DataFrame) -> DataFrame:
    """``get_spread``: the record plus the final margin ``spread = own - other``."""
    return record.withColumn("spread", F.col("own_score") - F.col("opp_score"))


def rest_bucket(rest_days_col: str = "rest_days") -> F.Column:
    """Rest days as a category: under 7 short, 7 normal, above 7 long."""
    d = F.col(rest_days_col)
    return F.when(d < 7, "short").when(d == 7, "normal").when(d > 7, "long")


def wlt_record(contests: DataFrame, digits: int = 4, id_width: int = ID_WIDTH) -> DataFrame:
    """Win / loss / tie record where a tie is worth half a win: ``win_pct = (wins + ties) / games`` with tie = 0.5."""
    s = sides(contests)
    played = F.col("own_score").isNotNull() & F.col("opp_score").isNotNull()
    s = s.withColumns(
        {
            "win": F.when(played & (F.col("own_score") > F.col("opp_score")), 1).otherwise(0).cast("bigint"),
            "loss": F.when(played & (F.col("own_score") < F.col("opp_score")), 1).otherwise(0).cast("bigint"),
            "tie": F.when(played & (F.col("own_score") == F.col("opp_score")), 0.5).otherwise(0.0),
        }
    )
    go = season_order(id_width=id_width, tasks=shuffle_tasks(contests, 2))
    r = scan(s, go, sums={"games_played": F.lit(1), "win_csum": F.col("win"), "loss_csum": F.col("loss"), "tie_csum": F.col("tie")})
    return r.select(
        "season", "team", "opponent", "contest_id", "gameday", "home_away", "win", "loss", "tie",
        F.col("games_played").cast("bigint").alias("games_played"),
        F.col("win_csum").cast("bigint").alias("win_csum"),
        F.col("loss_csum").cast("bigint").alias("loss_csum"),
        round_half_up((F.col("win_csum") + F.col("tie_csum")) / F.col("games_played"), digits).alias("win_pct"),
    )
