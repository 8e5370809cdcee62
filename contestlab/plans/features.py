"""Feature tables: side-level inputs joined per contest side, made leakage-free and mirrored for the opponent.

Plan shape (one pass each):

1. contests -> record (bucketed scan), plays -> offence and defence roll-ups (no exchange past the plays join),
   Elo (chunked fold, read back from the checkpoint folder);
2. one join of those side tables on ``(contest_id, team)``;
3. one bucketed scan per (season, team) that yields every lag and season-to-date mean at once;
4. the home row and the away row of a contest are put side by side with a single aggregation on ``contest_id``
   (each contest has exactly two side rows), which replaces the opponent self-join without a second shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import drop_incomplete, nearest_whole, round_half_up
from ..operators import ratings, records, side_stats
from ..operators.scan import scan
from ..session import materialize_scratch
from ..sources.tables import deal, shuffle_tasks

KEYS = ["contest_id", "team"]
# Season-to-date inputs that every contest with plays has.
OFFENSE_MEANS = ["third_down_pct", "turnovers", "value_added", "score_drives", "score_drives_pct", "score_diff", "possession_sec", "possession_pct"]
DEFENSE_MEANS = ["def_third_down_pct", "def_turnovers", "def_value_added", "def_score_drives", "def_score_drives_pct"]
# Drive counts and period values. With a handful of plays per contest most periods hold a single play per side, which gives
# NULL; so they are carried where the wide tables have them, but no row is dropped for lacking one.
CHANGES = [f"dscore_diff_qtr_{k}" for k in side_stats.REGULAR_PERIODS]
PERIOD_MEANS = [
    "ndrives", "def_ndrives", "pts_scored", *[f"qtr_pts_{k}" for k in side_stats.REGULAR_PERIODS],
    *[f"score_diff_qtr_{k}" for k in side_stats.REGULAR_PERIODS], *CHANGES, *[f"def_qtr_pts_{k}" for k in side_stats.REGULAR_PERIODS],
]
RECORD_LAGS = ["win_pct", "home_win_pct", "away_win_pct"]


def favorite_flags(df: DataFrame, line: str = "line", home_away: str = "home_away") -> DataFrame:
    """``home_fav`` (the home side is favoured), ``fav`` (this side is favoured) and ``abs_spread_line``.

    A positive line means the home side is favoured; a zero line favours nobody.
    """
    ln = F.col(line)
    home_fav = F.when(ln > 0, 1).otherwise(0).cast("bigint")
    fav = F.when((F.col(home_away) == "home") & (ln > 0), 1).when((F.col(home_away) == "away") & (ln < 0), 1).otherwise(0).cast("bigint")
    return df.withColumns({"home_fav": home_fav, "fav": fav, "abs_spread_line": F.abs(ln)})


def side_table(contests: DataFrame, plays: DataFrame, elo: DataFrame | None = None, periods: bool = False) -> DataFrame:
    """Post-contest side table: record, margin, line, offence, possession, defence and (optionally) period margins and rating
    per contest side."""
    rec = records.with_margin(records.team_record(contests, keep=["line"]))
    off = side_stats.game_stats(plays) if periods else side_stats.offense_stats(plays).join(side_stats.possession_share(plays), KEYS, "left")
    deff = side_stats.defense_stats(plays).drop("season", "week", "game_id")
    t = rec.join(off.drop("season", "week", "game_id", "home", "div_game"), KEYS, "left")
    t = t.join(deff, KEYS, "left")
    if elo is not None:
        t = t.join(_with_prior(elo), KEYS, "left")
    return t


def _with_prior(elo: DataFrame) -> DataFrame:
    """The rating columns of a side: ``elo`` and, where the table has it, the rating before the contest's period."""
    return elo.select("contest_id", "team", "elo", *[c for c in ("prior_elo",) if c in elo.columns])


def _prior(t: DataFrame, mean_cols: list[str]) -> DataFrame:
    """``prior_values`` of a side table with whole inputs, with ``elo`` replaced by the rating before the contest's period (or, of a table
    rated contest by contest, by the previous contest's)."""
    if "prior_elo" not in t.columns:
        return prior_values(t, mean_cols, RECORD_LAGS + ["elo"], whole=True)
    return prior_values(t, mean_cols, RECORD_LAGS, whole=True).withColumn("elo", whole_number(F.col("prior_elo"), LAG_DIGITS)).drop("prior_elo")


MEAN_DIGITS, LAG_DIGITS = 3, 4


def whole_number(c: Column, digits: int) -> Column:
    """``round_half_up`` before its last division: a whole number of ``10^-digits``."""
    return nearest_whole(c.cast("double") * F.lit(float(10 ** digits))).cast("bigint")


def whole_inputs(df: DataFrame, cols: list[str], digits: int = 3) -> DataFrame:
    """The columns as whole numbers of ``10^-digits``."""
    return df.withColumns({c: whole_number(F.col(c), digits) for c in cols})


def units(mean_cols: list[str]) -> dict[str, int]:
    """The digits of the whole numbers of a table made by ``prior_values(whole=True)``, ``elo`` included."""
    return {**{c: MEAN_DIGITS for c in mean_cols}, **{c: LAG_DIGITS for c in [*RECORD_LAGS, "elo"]}}


def prior_values(
    df: DataFrame,
    mean_cols: list[str],
    lag_cols: list[str],
    mean_digits: int = MEAN_DIGITS,
    lag_digits: int = LAG_DIGITS,
    input_digits: int = 3,
    strict: bool = False,
    whole: bool = False,
) -> DataFrame:
    """Replace ``mean_cols`` by their season-to-date mean before the contest and ``lag_cols`` by the previous
    contest's value, per (season, team), in one bucketed scan. ``df`` is a stored table.

    Inputs are summed as exact integers in units of ``10^-input_digits`` (they are rounded to that many places
    upstream), so the mean does not depend on the summation order. ``strict=False`` skips contests where a value is
    missing (a side without events in one contest keeps its history); ``strict=True`` is the NULL-propagating
    running mean. ``whole``: ``mean_cols`` are stored as those integers (``whole_inputs``), and the results are left as integers
    of the last place as well: shuffles carry these instead of doubles, until ``matchup_rows`` divides them by ``units``.
    """
    scale = float(10 ** input_digits)
    t = df if whole else whole_inputs(df, mean_cols, input_digits)
    rounded = whole_number if whole else round_half_up
    sums: dict[str, Column] = {"__n": F.lit(1)}
    for c in mean_cols:
        sums[f"__s_{c}"] = F.col(c)
        sums[f"__c_{c}"] = F.col(c).isNotNull().cast("bigint")
    r = scan(t, records.season_order(tasks=shuffle_tasks(df)), sums=sums, lags={f"__l_{c}": c for c in lag_cols})
    out = {}
    for c in mean_cols:
        here = F.col(c).isNotNull().cast("bigint")
        n_prev = F.col("__n") - 1
        c_prev = F.col(f"__c_{c}") - here
        s_prev = F.col(f"__s_{c}") - F.coalesce(F.col(c), F.lit(0))
        ok = (c_prev > 0) & (c_prev == n_prev) if strict else (c_prev > 0)
        out[c] = rounded(F.when(ok, s_prev / c_prev / F.lit(scale)), mean_digits)
    for c in lag_cols:
        out[c] = rounded(F.col(f"__l_{c}"), lag_digits)
    helpers = ["__n", *[f"__s_{c}" for c in mean_cols], *[f"__c_{c}" for c in mean_cols], *[f"__l_{c}" for c in lag_cols]]
    return r.withColumns(out).drop(*helpers)


def matchup_rows(sides_df: DataFrame, ids: list[str], features: list[str], label: str | None = "win", tasks: int | None = None,
                 digits: dict[str, int] | None = None) -> DataFrame:
    """One row per contest: the home side's columns plus ``opp_*`` copies of the away side's features. Columns of ``digits`` are
    whole numbers, divided by that power of ten once they are paired.

    Each contest has exactly two side rows, so one aggregation on ``contest_id`` pairs them (a missing side gives
    NULL ``opp_*`` values, as a left join would).
    """
    home = F.col("home_away") == "home"
    away = F.col("home_away") == "away"
    h_cols = list(dict.fromkeys([c for c in ids if c != "contest_id"] + ([label] if label else []) + features))
    # a side is one value: an aggregate a column would not be compiled for tables this wide
    side = lambda cond, cols, name: F.collect_list(F.when(cond, F.struct(*cols))).alias(name)
    # dealt by contest first: partial aggregates would shuffle each side's columns twice, one copy of them empty
    rows = deal(sides_df, tasks, "contest_id") if tasks else sides_df.repartition("contest_id")
    two = rows.groupBy("contest_id").agg(side(home, h_cols, "__h"), side(away, features, "__a")).where(F.size("__h") > 0)
    pair = F.struct(_merged("__h", h_cols).alias("__home"), _merged("__a", features).alias("__away"))
    out = two.select("contest_id", F.inline(F.array(pair)))  # a generator, so that the fields below don't each merge again
    digits = digits or {}
    value = lambda side, c: F.col(f"{side}.{c}") / F.lit(float(10 ** digits[c])) if c in digits else F.col(f"{side}.{c}")
    # a generator once more: a filter on plain aliases of the fields (incomplete rows) would be moved below them, and under a join
    # Catalyst derives a constraint for every subset of these aliases
    fields = [*[value("__home", c).alias(c) for c in h_cols], *[value("__away", c).alias(f"opp_{c}") for c in features]]
    return out.select("contest_id", F.inline(F.array(F.struct(*fields))))


def _merged(rows: str, cols: list[str]) -> Column:
    """The first value of each column that is not NULL, of an array of structs: its only struct but where a side came twice."""
    first = F.get(F.col(rows), F.lit(0))
    both = lambda a, b: F.struct(*[F.coalesce(a[c], b[c]).alias(c) for c in cols])
    return F.when(F.size(rows) > 1, F.aggregate(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))), first, both)).otherwise(first)


def opponent_mirror(sides_df: DataFrame, features: list[str]) -> DataFrame:
    """Every side row with the opponent's ``features`` as ``opp_*``: the result of a left self-join on
    ``(contest_id, opponent = team)``, computed as one aggregation per contest (its two side rows) and a generator,
    so the side table is neither computed twice nor shuffled twice."""
    cols = sides_df.columns
    grouped = sides_df.groupBy("contest_id").agg(F.collect_list(F.struct(*[F.col(c) for c in cols])).alias("__s"))

    def pair(e):
        other = F.try_element_at(F.filter(F.col("__s"), lambda x: x["team"] == e["opponent"]), F.lit(1))
        return F.struct(*[e[c].alias(c) for c in cols], *[other[f].alias(f"opp_{f}") for f in features])

    return grouped.select(F.inline(F.transform(F.col("__s"), pair)))


PREGAME_FEATURES = ["line", "home_fav", "abs_spread_line", "rest_days", *RECORD_LAGS, "elo", *OFFENSE_MEANS, *DEFENSE_MEANS]
OPP_FEATURES = ["rest_days", *RECORD_LAGS, "elo", *OFFENSE_MEANS, *DEFENSE_MEANS]


def pregame_features(contests: DataFrame, plays: DataFrame, elo: DataFrame | None = None) -> DataFrame:
    """Model table: one row per contest (home view) with the home side's label, line, rest days, lagged record,
    lagged rating, season-to-date offence and defence means, and the same values for the away side as ``opp_*``.

    Only values known before the contest are used. Rows with any missing feature are dropped (first contests of a
    season have no history).
    """
    elo = elo if elo is not None else ratings.period_ratings(contests)
    # the side table is the join of four side-level inputs; the bucketed scan reads it twice, so store it once
    means = OFFENSE_MEANS + DEFENSE_MEANS
    ids = ["season", "week", "gameday", "contest_id", "game_id", "team", "opponent"]
    t = side_table(contests, plays, elo)
    rated = [c for c in ("elo", "prior_elo") if c in t.columns]
    t = t.select(*ids, "home_away", "win", "line", "rest_days", *RECORD_LAGS, *rated, *means)
    t = materialize_scratch(whole_inputs(t, means), "side_table")
    tasks = shuffle_tasks(t)
    if "prior_elo" in rated:  # the rating after the contest is not used
        t = t.drop("elo")
    t = _prior(t, means)
    t = favorite_flags(t)
    m = matchup_rows(t, ids, [c for c in PREGAME_FEATURES if c not in ("line", "home_fav", "abs_spread_line")] + ["line", "home_fav", "abs_spread_line"], tasks=tasks, digits=units(means))
    m = m.drop("opp_line", "opp_home_fav", "opp_abs_spread_line")
    cols = ids + ["win"] + PREGAME_FEATURES + [f"opp_{c}" for c in OPP_FEATURES]
    return drop_incomplete(m.select(*cols), subset=PREGAME_FEATURES + [f"opp_{c}" for c in OPP_FEATURES])


POST_FEATURES = ["rest_days", *RECORD_LAGS, "elo", *OFFENSE_MEANS, *DEFENSE_MEANS, *PERIOD_MEANS]


def postgame_features(contests: DataFrame, plays: DataFrame, elo: DataFrame | None = None) -> DataFrame:
    """Both sides of every contest with their own post-contest values and the opponent's as ``opp_*``, plus points
    for, points against, the margin, the line and who it favours."""
    elo = elo if elo is not None else ratings.period_ratings(contests)
    t = favorite_flags(side_table(contests, plays, elo, periods=True))
    t = deal(t, shuffle_tasks(contests, 2), "contest_id")
    t = t.withColumns({"points_for": F.col("own_score"), "points_against": F.col("opp_score")})
    return opponent_mirror(t.select("season", "week", "contest_id", "team", "opponent", "home_away", "win", "points_for", "points_against",
                                    "spread", "line", "home_fav", "fav", "abs_spread_line", *POST_FEATURES), POST_FEATURES)


REDUCED = ["spread", "turnovers", *RECORD_LAGS, "elo"]


def reduced_features(contests: DataFrame, plays: DataFrame, elo: DataFrame | None = None) -> DataFrame:
    """Reduced model table: season-to-date margin and turnovers, lagged record and lagged rating, home view with
    ``opp_*`` for the away side."""
    elo = elo if elo is not None else ratings.elo_ratings(contests, digits=None)
    rec = records.with_margin(records.team_record(contests))
    off = side_stats.offense_stats(plays).select("contest_id", "team", "turnovers")
    t = rec.join(off, KEYS, "left").join(_with_prior(elo), KEYS, "left")
    t = materialize_scratch(whole_inputs(t, ["spread", "turnovers"]), "reduced_side_table")
    tasks = shuffle_tasks(t)
    t = _prior(t, ["spread", "turnovers"])
    ids = ["season", "week", "gameday", "contest_id", "game_id", "team", "opponent"]
    m = matchup_rows(t, ids, REDUCED, tasks=tasks, digits=units(["spread", "turnovers"]))
    cols = ids + ["win"] + REDUCED + [f"opp_{c}" for c in REDUCED]
    return drop_incomplete(m.select(*cols), subset=REDUCED + [f"opp_{c}" for c in REDUCED])


SPREAD_MEANS = [*OFFENSE_MEANS, *DEFENSE_MEANS, "spread_lag"]
SPREAD_FEATURES = ["line", "rest", *RECORD_LAGS, *SPREAD_MEANS]
SPREAD_OPP = ["rest", *RECORD_LAGS, *SPREAD_MEANS]


def spread_features(contests: DataFrame, plays: DataFrame) -> DataFrame:
    """Margin model table: home margin as label, line, rest category, lagged record, season-to-date offence, defence, period
    values and margin (``spread_lag``), with the away side's values as ``opp_*``. Missing changes between periods are 0;
    ``pts_for``, ``pts_against`` and ``point_diff`` are sums of the period means (NULL where one is)."""
    t = side_table(contests, plays, periods=True).withColumn("spread_lag", F.col("spread"))
    means = [*SPREAD_MEANS, *PERIOD_MEANS]
    ids = ["season", "week", "gameday", "contest_id", "game_id", "team", "opponent"]
    t = t.select(*ids, "home_away", "spread", "line", "rest_days", *RECORD_LAGS, *means)
    t = materialize_scratch(whole_inputs(t, means), "spread_side_table")
    tasks = shuffle_tasks(t)
    t = prior_values(t, means, RECORD_LAGS, whole=True)
    t = t.withColumn("rest", records.rest_bucket())
    m = matchup_rows(t, ids, [c for c in SPREAD_FEATURES if c != "line"] + PERIOD_MEANS + ["line"], label="spread", tasks=tasks, digits=units(means)).drop("opp_line")
    m = m.fillna(0.0, subset=[f"{p}{c}" for p in ("", "opp_") for c in CHANGES])
    for p in ("", "opp_"):
        for name, c in (("pts_for", "qtr_pts"), ("pts_against", "def_qtr_pts")):
            a, *more = [F.col(f"{p}{c}_{k}") for k in side_stats.REGULAR_PERIODS]
            m = m.withColumn(f"{p}{name}", sum(more, a))
        m = m.withColumn(f"{p}point_diff", F.col(f"{p}pts_for") - F.col(f"{p}pts_against"))
    carried = [*PERIOD_MEANS, "pts_for", "pts_against", "point_diff"]
    cols = ids + ["spread"] + SPREAD_FEATURES + carried + [f"opp_{c}" for c in [*SPREAD_OPP, *carried]]
    return drop_incomplete(m.select(*cols), subset=SPREAD_FEATURES + [f"opp_{c}" for c in SPREAD_OPP])
