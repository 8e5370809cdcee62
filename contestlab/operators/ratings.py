"""Elo ratings, by rating period or contest by contest.

``period_ratings`` moves all ratings of a period (a week) together: each contest changes its sides' ratings by what the
ratings at the start of the period expected, and the changes are added up. Where a side plays once a period, as in a
schedule of weekly rounds, that is the contest-by-contest rating. A period needs only sums (contests and home wins of each
pair of teams), so contests of any number are aggregated first, in parallel; what is left is one small table of pairs.

``elo_ratings`` is the order-dependent fold contest by contest, which the rating queries return.

Elo is not a combinable aggregate: each result moves two ratings and the next expected score depends on them. What can be
split is the *data*. Contests are sorted by season and fold order into range partitions of about ``chunk_rows`` rows. A chunk
of a season is packed to nine bytes a contest; one pass over a season's packed chunks yields the ratings at the start of each
chunk (one row per chunk, one rating per team), and with these all chunks are folded again in parallel, now emitting the
rows. Seasons run in parallel; no task holds more than one chunk of contests or the packed contests of one season.

Fixed values: start rating 1500, k = 20, no home advantage; expected home score
``p = 1 / (1 + 10 ^ ((R_away - R_home) / 400))``; home win = 1, tie or loss = 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import round_half_up
from ..session import materialize_scratch
from ..sources.tables import bounded_broadcast

START_RATING = 1500.0
K_FACTOR = 20.0
SCALE = 400.0
DEFAULT_CHUNK_ROWS = 250_000
#: Rows (season, period, team) of the rating table that are broadcast; a larger one is shuffled.
MAX_RATING_ROWS = 200_000


def _in_order(games: pa.Table) -> tuple[pa.Table, list[str], list[list]]:
    """The games in playing order, their teams, and per game the number of the home and the away team (-1: none) and the home win."""
    games = games.sort_by("seq")
    both = pa.chunked_array([*games["home_team"].chunks, *games["away_team"].chunks], pa.string()).combine_chunks().dictionary_encode()
    at, n = both.indices.fill_null(-1).to_numpy(zero_copy_only=False), games.num_rows
    return games, both.dictionary.to_pylist(), [at[:n].tolist(), at[n:].tolist(), games["w"].to_pylist()]


def _fold(now: list[float | None], games: list[list], k: float, start: float, scale: float, moved: tuple[list, ...] | None = None) -> None:
    """Fold games into ``now``, one rating per team (None: not yet seen) and one slot for no team, which rates nobody. ``moved``
    takes the ratings of the home side before and after each game and those of the away side."""
    for h, a, w in zip(*games, strict=True):
        home, away = now[h], now[a]
        rh, ra = start if home is None else home, start if away is None else away
        d = k * (w - 1.0 / (1.0 + math.pow(10.0, (ra - rh) / scale))) if h >= 0 and a >= 0 else 0.0
        now[a] = ra - d
        now[h] = rh + d
        if moved:
            for to, x in zip(moved, (home, rh + d, away, ra - d), strict=True):
                to.append(x)


def _packed(games: pa.Table) -> pa.Table:
    """A chunk of a season as one row: its teams and nine bytes a game."""
    games, teams, (hs, as_, ws) = _in_order(games)
    packed = np.array(hs, "<i4").tobytes() + np.array(as_, "<i4").tobytes() + np.array(ws, "<i1").tobytes()
    return pa.table({"season": games["season"][:1], "chunk": games["chunk"][:1], "teams": pa.array([teams], pa.list_(pa.string())), "games": pa.array([packed], pa.binary())})


def _seeds(k: float, start: float, scale: float):
    def run(chunks: pa.Table) -> pa.Table:
        state: dict[str, float] = {}
        out: list[tuple[list[str], list[float]]] = []
        chunks = chunks.sort_by("chunk")
        for teams, packed in zip(chunks["teams"].to_pylist(), chunks["games"], strict=True):
            out.append((list(state), list(state.values())))
            raw = packed.as_py()
            n = len(raw) // 9
            games = [np.frombuffer(raw, t, n, at).tolist() for t, at in (("<i4", 0), ("<i4", 4 * n), ("<i1", 8 * n))]
            now = [*map(state.get, teams), None]
            _fold(now, games, k, start, scale)
            state.update(zip(teams, now[:-1], strict=True))
        return pa.table({
            "season": chunks["season"], "chunk": chunks["chunk"],
            "teams": pa.array([t for t, _ in out], pa.list_(pa.string())), "ratings": pa.array([r for _, r in out], pa.list_(pa.float64())),
        })

    return run


def _rated(k: float, start: float, scale: float):
    def run(games: pa.Table, seed: pa.Table) -> pa.Table:
        games, teams, played = _in_order(games)
        state = dict(zip(seed["teams"][0].as_py(), seed["ratings"][0].as_py(), strict=True))
        moved: tuple[list, ...] = ([], [], [], [])
        _fold([*map(state.get, teams), None], played, k, start, scale, moved)
        for name, x in zip(("home_prior", "home_elo", "away_prior", "away_elo"), moved, strict=True):
            games = games.append_column(name, pa.array(x, pa.float64()))
        return games

    return run


def period_ratings(contests: DataFrame, period: str = "week", k: float = K_FACTOR, start: float = START_RATING, scale: float = SCALE) -> DataFrame:
    """Ratings of both sides: ``season, contest_id, gameday, team, opponent, home_away, win, elo, prior_elo``; ``elo`` is the
    rating at the end of the contest's period, ``prior_elo`` the one at its start (NULL before the side's first period).

    ``period`` is the column that orders the rating periods of a season. Contests are counted by (season, period, home,
    away); a season's periods are then one array, folded by a JVM expression over one rating per team. That array is
    bounded by periods x pairs of teams, whatever the number of contests. Seasons run in parallel.
    """
    home_win = F.when(F.col("home_score") > F.col("away_score"), 1).otherwise(0)
    pairs = contests.groupBy("season", F.col(period).alias("period"), "home_team", "away_team").agg(
        F.count(F.lit(1)).alias("n"), F.sum(home_win).alias("wins")
    )
    # each pair seen from both sides; d is what the side wins: its sign, times k, times (home wins less what was expected)
    view = lambda team, other, sign: F.struct(F.col(team).alias("team"), F.col(other).alias("other"), F.lit(sign).alias("sign"))
    seen = pairs.select("season", "period", "n", "wins", F.inline(F.array(view("home_team", "away_team", 1.0), view("away_team", "home_team", -1.0))))
    teams = seen.groupBy("season").agg(F.array_sort(F.collect_set("team")).alias("teams"))
    own = seen.join(teams, "season").withColumn("other", F.array_position("teams", F.col("other")))
    side = own.groupBy("season", "period", "team").agg(F.array_sort(F.collect_list(F.struct("other", "sign", "n", "wins"))).alias("games"))
    by_period = side.groupBy("season", "period").agg(F.map_from_entries(F.collect_list(F.struct("team", "games"))).alias("games"))
    seasons = by_period.groupBy("season").agg(F.array_sort(F.collect_list(F.struct("period", F.map_entries("games").alias("games")))).alias("periods")).join(teams, "season")

    def moved(before: Column, i: Column, games: Column) -> Column:
        """The change of team ``i`` in a period."""
        rating = F.element_at(before, i)

        def change(total: Column, g: Column) -> Column:
            other = F.element_at(before, g["other"].cast("int"))
            expected = 1.0 / (1.0 + F.pow(F.lit(10.0), (other - rating) * g["sign"] / F.lit(scale)))  # of the home side
            return total + g["sign"] * F.lit(k) * (g["wins"] - g["n"] * expected)

        return F.aggregate(games, F.lit(0.0), change)

    def step(state: Column, p: Column) -> Column:
        before, held = state["ratings"], F.map_from_entries(p["games"])

        def rated(team: Column, i: Column) -> Column:
            return F.element_at(before, i + 1) + F.coalesce(moved(before, i + 1, F.try_element_at(held, team)), F.lit(0.0))

        after = F.transform(F.col("teams"), rated)
        row = F.struct(p["period"].alias("period"), before.alias("before"), after.alias("after"))
        return F.struct(after.alias("ratings"), F.concat(state["rows"], F.array(row)).alias("rows"))

    kind = dict(seen.dtypes)["period"]
    first = F.struct(
        F.transform("teams", lambda _: F.lit(float(start))).alias("ratings"),
        F.array().cast(f"array<struct<period:{kind},before:array<double>,after:array<double>>>").alias("rows"),
    )
    folded = seasons.select("season", "teams", F.inline(F.aggregate("periods", first, step)["rows"]))
    table = folded.select("season", "period", F.inline(F.arrays_zip(F.col("teams").alias("team"), F.col("before"), F.col("after").alias("elo"))))
    began = seen.groupBy("season", "team").agg(F.min("period").alias("began"))
    table = table.join(began, ["season", "team"]).select("season", "period", "team", "elo", F.when(F.col("period") > F.col("began"), F.col("before")).alias("prior_elo"))
    table = bounded_broadcast(materialize_scratch(table, "period-ratings"), MAX_RATING_ROWS)

    away_win = F.when(F.col("away_score") > F.col("home_score"), 1).otherwise(0)
    row = lambda team, other, where, win: F.struct(
        F.col(team).alias("team"), F.col(other).alias("opponent"), F.lit(where).alias("home_away"), win.cast("bigint").alias("win")
    )
    sides = contests.select(
        "season", "contest_id", "gameday", F.col(period).alias("period"),
        F.inline(F.array(row("home_team", "away_team", "home", home_win), row("away_team", "home_team", "away", away_win))),
    )
    return sides.join(table, ["season", "period", "team"]).select("season", "contest_id", "gameday", "team", "opponent", "home_away", "win", "elo", "prior_elo")


def pregame_ratings(elo: DataFrame, start: float = START_RATING) -> DataFrame:
    """Rating each side takes into a contest: its previous post-contest rating in the season (``start`` before the
    first): the rating at the start of its period, or a bucketed lag per (season, team)."""
    if "prior_elo" in elo.columns:
        return elo.withColumn("pre_elo", F.coalesce("prior_elo", F.lit(start)))
    from .records import season_order
    from .scan import scan

    r = scan(elo, season_order(), lags={"__prev": "elo"})
    return r.withColumn("pre_elo", F.coalesce(F.col("__prev"), F.lit(start))).drop("__prev")


def elo_ratings(
    contests: DataFrame,
    order: tuple[str, ...] = ("gameday", "contest_id"),
    k: float = K_FACTOR,
    start: float = START_RATING,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    digits: int | None = 4,
) -> DataFrame:
    """Post-contest rating of both sides: ``season, contest_id, gameday, team, opponent, home_away, win, elo, prior_elo``;
    ``prior_elo`` is the side's rating before the contest (NULL before its first of the season).

    ``order`` is the fold order inside a season (default chronological ``(gameday, contest_id)``). ``win`` is the side's own
    result (tie = 0). Contests without a season are left out; one without a team moves no rating.
    """
    spark: SparkSession = contests.sparkSession
    home_win = F.when(F.col("home_score") > F.col("away_score"), 1).otherwise(0)
    away_win = F.when(F.col("away_score") > F.col("home_score"), 1).otherwise(0)
    slim = contests.where(F.col("season").isNotNull()).select(
        "season", "gameday", "contest_id", "home_team", "away_team", home_win.cast("bigint").alias("w"), away_win.cast("bigint").alias("aw"), *[c for c in order if c not in ("gameday", "contest_id")]
    )
    # rows equal in the order columns are told apart by the rest of what the fold reads; the ordered rows are stored once
    by = ["season", *dict.fromkeys([*order, "contest_id", "home_team", "away_team", "w", "aw"])]
    chunks = max(1, math.ceil(slim.count() / chunk_rows))
    ordered = slim.repartitionByRange(chunks, *by).sortWithinPartitions(*by).withColumn("seq", F.monotonically_increasing_id())
    games = materialize_scratch(ordered, "elo-games").select("season", F.shiftright("seq", 33).alias("chunk"), "seq", "contest_id", "gameday", "home_team", "away_team", "w", "aw")
    chunk = ["season", "chunk"]
    packed = games.select(*chunk, "seq", "home_team", "away_team", "w").groupBy(*chunk).applyInArrow(_packed, "season bigint, chunk bigint, teams array<string>, games binary")
    seeds = packed.groupBy("season").applyInArrow(_seeds(k, start, SCALE), "season bigint, chunk bigint, teams array<string>, ratings array<double>")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in games.schema.fields)
    rated = games.groupBy(*chunk).cogroup(seeds.groupBy(*chunk)).applyInArrow(_rated(k, start, SCALE), f"{kinds}, home_prior double, home_elo double, away_prior double, away_elo double")

    def view(side: str, other: str, win: str) -> Column:
        return F.struct(F.col(f"{side}_team").alias("team"), F.col(f"{other}_team").alias("opponent"), F.lit(side).alias("home_away"), F.col(win).alias("win"),
                        F.col(f"{side}_elo").alias("elo"), F.col(f"{side}_prior").alias("prior_elo"))

    both = rated.select("season", "contest_id", "gameday", F.inline(F.array(view("home", "away", "w"), view("away", "home", "aw")))).where(F.col("team").isNotNull())
    return both.withColumns({c: round_half_up(F.col(c), digits) for c in ("elo", "prior_elo")}) if digits is not None else both
