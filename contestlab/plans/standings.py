"""Final standings per season and league: record, seed by win % and games behind the leader."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import round_half_up
from ..operators.reshape import sides


def standings(contests: DataFrame, teams: DataFrame, digits: int = 4) -> DataFrame:
    """One row per (season, team): wins, losses, ties, win % (tie = half), seed inside its league (win % desc, wins
    desc, team) and games behind the league leader. The ranking window covers one league of one season."""
    s = sides(contests).where(F.col("own_score").isNotNull() & F.col("opp_score").isNotNull())
    rec = s.groupBy("season", "team").agg(
        F.sum(F.when(F.col("own_score") > F.col("opp_score"), 1).otherwise(0)).cast("bigint").alias("wins"),
        F.sum(F.when(F.col("own_score") < F.col("opp_score"), 1).otherwise(0)).cast("bigint").alias("losses"),
        F.sum(F.when(F.col("own_score") == F.col("opp_score"), 1).otherwise(0)).cast("bigint").alias("ties"),
        F.count(F.lit(1)).alias("games"),
    )
    rec = rec.withColumn("win_pct", round_half_up((F.col("wins") + 0.5 * F.col("ties")) / F.col("games"), digits))
    rec = rec.join(teams.select("team", "league"), "team", "left")
    w = Window.partitionBy("season", "league").orderBy(F.col("win_pct").desc(), F.col("wins").desc(), F.col("team"))
    ranked = rec.withColumns({
        "seed": F.row_number().over(w).cast("bigint"),
        "__lw": F.first("wins").over(w),
        "__ll": F.first("losses").over(w),
    })
    gb = ((F.col("__lw") - F.col("wins")) + (F.col("losses") - F.col("__ll"))) / 2.0
    return ranked.withColumn("games_behind", gb).drop("__lw", "__ll").withColumn(
        "record", F.format_string("%d-%d", F.col("wins"), F.col("losses"))
    )
