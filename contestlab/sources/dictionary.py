"""Data dictionary: column descriptions as metadata of the schema, and a table of them with how full each column is.

Descriptions travel with the schema (``StructField.metadata["comment"]``), so a stored table keeps them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTESTS = {
    "season": "year in which the contest is played",
    "week": "week of the season, from 1",
    "gameday": "date of the contest",
    "contest_id": "identifier of the contest",
    "game_id": "season, week, away team and home team in one key",
    "home_team": "team that plays at home",
    "away_team": "team that travels",
    "home_score": "points of the home team at the end",
    "away_score": "points of the away team at the end",
    "line": "bookmaker's line; above 0 the home team is the favourite",
    "div_game": "1 if both teams are of one division, else 0",
}


def described(df: DataFrame, descriptions: dict[str, str]) -> DataFrame:
    """``df`` with a comment on each column that has a description; other columns stay as they are."""
    cols = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        cols.append(c.alias(f.name, metadata={**f.metadata, "comment": descriptions[f.name]}) if f.name in descriptions else c)
    return df.select(*cols)


def dictionary(df: DataFrame) -> DataFrame:
    """``column_name, position, column_type, description, n_filled, n_missing``: a row per column, in one aggregation.

    Columns without a comment have a NULL description; an empty table has zero counts."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(df.schema)])
    rows = []
    for i, f in enumerate(df.schema):
        note = F.lit(f.metadata.get("comment")).cast("string")
        rows.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(i + 1).cast("bigint").alias("position"), F.lit(f.dataType.simpleString()).alias("column_type"),
            note.alias("description"), F.col(f"c{i}").alias("n_filled"), (F.col("n") - F.col(f"c{i}")).alias("n_missing"),
        ))
    return counts.select(F.inline(F.array(*rows)))
