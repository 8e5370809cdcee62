"""Reshaping: contest rows to side rows, long/wide pivots, column-name rules and composite keys."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sides(contests: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``pivot_longer(c(home_team, away_team))``: each contest becomes a home row and an away row.

    Output adds ``team, opponent, home_away ('home'|'away'), is_home, own_score, opp_score``. Built with one
    ``inline`` generator, so it is a map-side step with no shuffle.
    """
    keep = keep if keep is not None else [c for c in contests.columns if c not in ("home_team", "away_team", "home_score", "away_score")]
    home = F.struct(
        F.col("home_team").alias("team"), F.col("away_team").alias("opponent"), F.lit("home").alias("home_away"),
        F.lit(1).cast("bigint").alias("is_home"), F.col("home_score").alias("own_score"), F.col("away_score").alias("opp_score"),
    )
    away = F.struct(
        F.col("away_team").alias("team"), F.col("home_team").alias("opponent"), F.lit("away").alias("home_away"),
        F.lit(0).cast("bigint").alias("is_home"), F.col("away_score").alias("own_score"), F.col("home_score").alias("opp_score"),
    )
    return contests.select(*keep, F.inline(F.array(home, away)))


def longer(df: DataFrame, ids: list[str], values: list[str], name: str = "name", value: str = "value") -> DataFrame:
    """``pivot_longer(values)``: metrics to ``(name, value)`` rows."""
    return df.unpivot(ids, values, name, value)


def wider(df: DataFrame, ids: list[str], names_from: str, values_from: str | list[str], names: list, glue: str | None = None,
          agg: str = "first") -> DataFrame:
    """``pivot_wider``: ``(name, value)`` rows to columns.

    ``names`` is the explicit list of pivot values (no extra pass to discover them). ``glue`` formats the output
    column name from ``{name}`` (pivot value) and ``{value}`` (value column), e.g. ``"{value}_{name}"``. ``agg`` combines
    several rows that land in one cell (``first`` for one value per cell, or ``sum``).
    """
    vals = [values_from] if isinstance(values_from, str) else list(values_from)
    fn = {"first": lambda v: F.first(v, ignorenulls=True), "sum": F.sum, "max": F.max, "min": F.min}[agg]
    out = df.groupBy(*ids).pivot(names_from, names).agg(*[fn(v).alias(v) for v in vals])
    renames = {}
    for n in names:
        for v in vals:
            src = f"{n}_{v}" if len(vals) > 1 else f"{n}"
            target = (glue or ("{value}_{name}" if len(vals) > 1 else "{name}")).format(name=n, value=v)
            renames[src] = target
    return out.withColumnsRenamed(renames)


def prefix_columns(df: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    """Mirror a side: prefix every non-key column (``opp_`` for the opponent copy)."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keys})


def strip_suffix(df: DataFrame, pattern: str) -> DataFrame:
    """Rename columns by removing a regex (``gsub("_lag1|_roll_4", "")`` on names)."""
    return df.toDF(*[re.sub(pattern, "", c) for c in df.columns])


def snake_names(df: DataFrame) -> DataFrame:
    """``clean_names``: lower-case snake names."""
    def clean(c: str) -> str:
        c = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", c)
        return re.sub(r"[^0-9a-zA-Z]+", "_", c).strip("_").lower()
    return df.toDF(*[clean(c) for c in df.columns])


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Columns from ``first`` to ``last`` in schema order (``a:b``), resolved once from the schema."""
    cols = df.columns
    return cols[cols.index(first): cols.index(last) + 1]


def columns_like(df: DataFrame, fragment: str) -> list[str]:
    return [c for c in df.columns if fragment in c]


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("bigint", "int", "double", "float", "smallint", "tinyint") or t.startswith("decimal")]


def contest_key(season: Column, week: Column, away: Column, home: Column) -> Column:
    """Composite contest key ``{season}_{week:02d}_{away}_{home}``."""
    return F.format_string("%d_%02d_%s_%s", season, week, away, home)


def parse_contest_key(key: Column) -> dict[str, Column]:
    """Inverse of :func:`contest_key`: season, week, away and home codes."""
    return {
        "key_season": F.substring(key, 1, 4).cast("bigint"),
        "key_week": F.substring(key, 6, 2).cast("bigint"),
        "key_away": F.split_part(F.substring(key, 9, 1 << 16), F.lit("_"), F.lit(1)),
        "key_home": F.split_part(F.substring(key, 9, 1 << 16), F.lit("_"), F.lit(2)),
    }
