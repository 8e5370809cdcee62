"""Prediction table for evaluation: a rating model's home-win probability and margin next to the bookmaker line.

One row per contest (home view): ``truth`` (home won), ``prob`` (Elo expected score from pre-contest ratings),
``model_pick``, ``fav_pick`` (line favours home), ``actual_margin``, ``model_margin`` (rating gap / 25) and ``line``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import round_half_up
from ..operators import ratings

POINTS_PER_RATING = 25.0


def rating_predictions(contests: DataFrame, elo: DataFrame | None = None) -> DataFrame:
    elo = elo if elo is not None else ratings.elo_ratings(contests, digits=None)
    pre = ratings.pregame_ratings(elo)
    pair = pre.groupBy("contest_id").agg(
        F.max(F.when(F.col("home_away") == "home", F.col("pre_elo"))).alias("home_pre"),
        F.max(F.when(F.col("home_away") == "away", F.col("pre_elo"))).alias("away_pre"),
    )
    k = contests.select("season", "week", "contest_id", F.col("home_team").alias("team"), "line", "home_score", "away_score")
    j = k.join(pair, "contest_id", "inner")
    prob = round_half_up(1.0 / (1.0 + F.pow(F.lit(10.0), (F.col("away_pre") - F.col("home_pre")) / ratings.SCALE)), 6)
    out = j.select(
        "season", "week", "contest_id", "team", "line", "home_pre", "away_pre",
        F.when(F.col("home_score") > F.col("away_score"), 1).otherwise(0).cast("bigint").alias("truth"),
        F.when(F.col("line") > 0, 1).otherwise(0).cast("bigint").alias("fav_pick"),
        prob.alias("prob"),
        (F.col("home_score") - F.col("away_score")).alias("actual_margin"),
        round_half_up((F.col("home_pre") - F.col("away_pre")) / POINTS_PER_RATING, 4).alias("model_margin"),
    )
    return out.withColumn("model_pick", F.when(F.col("prob") >= 0.5, 1).otherwise(0).cast("bigint"))
