"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the stored tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import nulls as nullf
from .functions.text import clean_name, clock_to_seconds
from .operators import evaluation, ml, nested, ratings, records, reshape, rolling, side_stats, stats, tuning
from .operators import scan as scan_ops
from .operators.reshape import sides
from .operators.scan import GroupOrder, scan, time_levels
from .plans import documents, features, models, predictions, workflows
from .plans.matchups import next_matchups
from .plans.standings import standings
from .session import materialize_scratch
from .sources import adapters, dictionary, prepared
from .sources.tables import bounded_broadcast, read_table, shuffle_tasks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates as ISO text in registered outputs, so results compare equal across engines and client libraries."""
    return df.select(*[F.col(c).cast("string").alias(c) if t in ("date", "timestamp", "timestamp_ntz") else F.col(c) for c, t in df.dtypes])


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


@register("team_record")
def q_team_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared.record(spark, sf_dir).drop("spread")


def _plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared.plays(spark, sf_dir)


@register("offense_stats")
def q_offense_stats(spark, sf_dir):
    return side_stats.offense_stats(_plays(spark, sf_dir))


@register("defense_stats")
def q_defense_stats(spark, sf_dir):
    return side_stats.defense_stats(_plays(spark, sf_dir))


@register("unit_score_rate")
def q_unit_score_rate(spark, sf_dir):
    return side_stats.drive_stats(_plays(spark, sf_dir)).withColumnRenamed("off_team", "team")


@register("period_delta")
def q_period_delta(spark, sf_dir):
    return side_stats.period_points(_plays(spark, sf_dir))


@register("period_margin")
def q_period_margin(spark, sf_dir):
    return side_stats.period_margin(_plays(spark, sf_dir))


@register("possession_share")
def q_possession_share(spark, sf_dir):
    return side_stats.possession_share(_plays(spark, sf_dir))


@register("first_line")
def q_first_line(spark, sf_dir):
    return side_stats.closing_line(_plays(spark, sf_dir))


@register("pass_splits")
def q_pass_splits(spark, sf_dir):
    return side_stats.pass_splits(_plays(spark, sf_dir))


def _record(spark, sf_dir):
    return prepared.record(spark, sf_dir)


def _season_team(spark, sf_dir):
    return records.season_order(tasks=shuffle_tasks(_record(spark, sf_dir)))


@register("season_to_date_mean")
def q_season_to_date_mean(spark, sf_dir):
    rec = _record(spark, sf_dir).select("season", "team", "contest_id", "gameday", "spread", "own_score", "opp_score")
    return rolling.season_to_date_mean(rec, _season_team(spark, sf_dir), ["spread", "own_score", "opp_score"], digits=3)


@register("lagged_record")
def q_lagged_record(spark, sf_dir):
    rec = _record(spark, sf_dir).select("season", "team", "contest_id", "gameday", "win_pct", "home_win_pct", "away_win_pct")
    return rolling.lagged(rec, _season_team(spark, sf_dir), ["win_pct", "home_win_pct", "away_win_pct"], digits=4)


@register("margin")
def q_margin(spark, sf_dir):
    rec = _record(spark, sf_dir).select(
        "season", "team", "opponent", "contest_id", "gameday", "home_away", "spread", "win_pct", "home_win_pct", "away_win_pct"
    )
    out = rolling.lagged(rec, _season_team(spark, sf_dir), ["win_pct", "home_win_pct", "away_win_pct"], digits=4)
    out = out.withColumn("spread_lag", F.col("spread"))
    return rolling.season_to_date_mean(out, _season_team(spark, sf_dir), ["spread_lag"], digits=4)


@register("locf")
def q_locf(spark, sf_dir):
    rec = _record(spark, sf_dir)
    rec = rec.select(
        "season", "team", "contest_id", "gameday",
        F.when(F.col("home_away") == "home", F.col("home_win") / F.col("games")).alias("home_row_value"),
    )
    return rolling.carry_forward(rec, _season_team(spark, sf_dir), ["home_row_value"])


@register("rest_days")
def q_rest_days(spark, sf_dir):
    rec = _record(spark, sf_dir)
    return rec.select("season", "team", "contest_id", "gameday", "rest_days", records.rest_bucket().alias("rest"))


@register("wlt_pct")
def q_wlt_pct(spark, sf_dir):
    return records.wlt_record(prepared.contests(spark, sf_dir))


@register("lag_win_pct")
def q_lag_win_pct(spark, sf_dir):
    rec = _record(spark, sf_dir).select("season", "team", "contest_id", "gameday", "win_pct")
    return rolling.lag_win_pct(rec, periods=8)


@register("trailing_mean_p")
def q_trailing_mean_p(spark, sf_dir):
    ev = adapters.player_events(spark, sf_dir).select("player_id", "ts", "event_id", "value", "k")
    go = GroupOrder(keys=["player_id"], order=["ts", "event_id"], levels=time_levels("ts"))
    return rolling.trailing_means(ev, go, ["value", "k"], periods=(1, 2, 4, 8, 16), digits=4)


@register("elo")
def q_elo(spark, sf_dir):
    e = prepared.ratings(spark, sf_dir)
    return e.withColumns({c: nullf.round_half_up(F.col(c), 4) for c in ("elo", "prior_elo")})


@register("elo_top20")
def q_elo_top20(spark, sf_dir):
    return stats.best_and_worst(prepared.ratings(spark, sf_dir), ["season", "team"], "elo", "mean_elo", n=20, digits=4)


@register("pregame_features")
def q_pregame_features(spark, sf_dir):
    k = prepared.contests(spark, sf_dir)
    return features.pregame_features(k, prepared.plays(spark, sf_dir), prepared.period_ratings(spark, sf_dir))


@register("reduced_features")
def q_reduced_features(spark, sf_dir):
    k = prepared.contests(spark, sf_dir)
    return features.reduced_features(k, prepared.plays(spark, sf_dir), prepared.ratings(spark, sf_dir))


@register("postgame_features")
def q_postgame_features(spark, sf_dir):
    k = prepared.contests(spark, sf_dir)
    elo = prepared.period_ratings(spark, sf_dir).withColumn("elo", nullf.round_half_up(F.col("elo"), 4))
    return features.postgame_features(k, prepared.plays(spark, sf_dir), elo)


@register("favorite_flags")
def q_favorite_flags(spark, sf_dir):
    s = sides(prepared.contests(spark, sf_dir)).select("contest_id", "team", "home_away", "line")
    return features.favorite_flags(s).withColumn("fav_label", evaluation.favourite_label())


def _pred(spark, sf_dir):
    return predictions.rating_predictions(prepared.contests(spark, sf_dir), prepared.ratings(spark, sf_dir))


def _period_pred(spark, sf_dir):
    return predictions.rating_predictions(prepared.contests(spark, sf_dir), prepared.period_ratings(spark, sf_dir))


@register("confusion")
def q_confusion(spark, sf_dir):
    return evaluation.confusion(_pred(spark, sf_dir), pred="model_pick", truth="truth")


@register("class_metrics")
def q_class_metrics(spark, sf_dir):
    return evaluation.class_metrics(_pred(spark, sf_dir), pred="model_pick", truth="truth")


@register("log_loss")
def q_log_loss(spark, sf_dir):
    return evaluation.log_loss(_pred(spark, sf_dir), prob="prob", truth="truth")


@register("roc_points_by_fold")
def q_roc_points_by_fold(spark, sf_dir):
    folded = ml.stratified_folds(_period_pred(spark, sf_dir).select("contest_id", "truth", "prob"), ["truth"], "contest_id", k=10, seed=234)
    return evaluation.roc_points_by(folded, "fold")


@register("roc_points")
def q_roc_points(spark, sf_dir):
    return evaluation.roc_points(_pred(spark, sf_dir), prob="prob", truth="truth")


@register("roc_auc")
def q_roc_auc(spark, sf_dir):
    return evaluation.roc_auc(_pred(spark, sf_dir), prob="prob", truth="truth")


@register("pick_accuracy")
def q_pick_accuracy(spark, sf_dir):
    return evaluation.pick_accuracy(_pred(spark, sf_dir), ["season"], {"model": "model_pick", "favourite": "fav_pick"})


@register("disagreement")
def q_disagreement(spark, sf_dir):
    p = _pred(spark, sf_dir).select("season", "week", "contest_id", "team", "line", "truth", "fav_pick", "model_pick", "prob")
    return evaluation.disagreements(p, "model_pick", "fav_pick")


@register("closer_to_margin")
def q_closer_to_margin(spark, sf_dir):
    return evaluation.closer_to_margin(_pred(spark, sf_dir), ["season", "week"], "line", "model_margin", "actual_margin")


@register("favourite_outcomes")
def q_favourite_outcomes(spark, sf_dir):
    return evaluation.outcome_cells(_period_pred(spark, sf_dir), ["season"], pred="fav_pick", truth="truth")


@register("correct_picks_week")
def q_correct_picks_week(spark, sf_dir):
    return evaluation.correct_long(_pred(spark, sf_dir), ["season", "week"], {"model": "model_pick", "favourite": "fav_pick"})


_CORR_COLS = ["third_down_pct", "turnovers", "value_added", "score_drives_pct", "score_diff", "ndrives"]


@register("corr_long")
def q_corr_long(spark, sf_dir):
    return stats.corr_long(side_stats.offense_stats(_plays(spark, sf_dir)), _CORR_COLS)


@register("corr_target")
def q_corr_target(spark, sf_dir):
    off = side_stats.offense_stats(_plays(spark, sf_dir)).withColumn("won", (F.col("score_diff") > 0).cast("bigint"))
    return stats.corr_with_target(off, _CORR_COLS, "won")


@register("histogram")
def q_histogram(spark, sf_dir):
    k = prepared.contests(spark, sf_dir).withColumn("margin", F.col("home_score") - F.col("away_score"))
    return stats.histogram(k, "margin", 5.0, by=["season"])


@register("class_balance")
def q_class_balance(spark, sf_dir):
    k = prepared.contests(spark, sf_dir).withColumn("home_win", (F.col("home_score") > F.col("away_score")).cast("bigint"))
    return stats.class_share(k, "home_win")


@register("season_means")
def q_season_means(spark, sf_dir):
    return stats.nested_mean(_record(spark, sf_dir), ["season", "team"], ["team"], "win", "mean_wins")


@register("five_number")
def q_five_number(spark, sf_dir):
    s = sides(prepared.contests(spark, sf_dir)).withColumn("margin", F.col("own_score") - F.col("opp_score"))
    return stats.quantiles(s, ["season"], "margin", ["contest_id", "team"])


@register("home_away_wins")
def q_home_away_wins(spark, sf_dir):
    k = prepared.contests(spark, sf_dir)
    w = k.groupBy("season").agg(
        F.sum(F.when(F.col("home_score") > F.col("away_score"), 1).otherwise(0)).cast("bigint").alias("home_wins"),
        F.sum(F.when(F.col("away_score") > F.col("home_score"), 1).otherwise(0)).cast("bigint").alias("away_wins"),
    )
    return w.unpivot(["season"], ["home_wins", "away_wins"], "venue", "wins")


@register("home_fav_pct")
def q_home_fav_pct(spark, sf_dir):
    return stats.favourite_win_rates(prepared.contests(spark, sf_dir))


@register("multiple_lm")
def q_multiple_lm(spark, sf_dir):
    off = side_stats.offense_stats(_plays(spark, sf_dir))
    return stats.multiple_regression(off, "score_diff", ["value_added", "turnovers"])


@register("simple_lm")
def q_simple_lm(spark, sf_dir):
    return stats.simple_regression(side_stats.offense_stats(_plays(spark, sf_dir)), "score_diff", "value_added")


@register("sides_long")
def q_sides_long(spark, sf_dir):
    return reshape.sides(prepared.contests(spark, sf_dir))


@register("key_parse")
def q_key_parse(spark, sf_dir):
    k = prepared.contests(spark, sf_dir).select("contest_id", "season", "week", "home_team", "away_team",
                                                 reshape.contest_key(F.col("season"), F.col("week"), F.col("away_team"), F.col("home_team")).alias("game_id"))
    p = k.withColumns(reshape.parse_contest_key(F.col("game_id")))
    ok = (F.col("key_season") == F.col("season")) & (F.col("key_week") == F.col("week")) & (F.col("key_away") == F.col("away_team")) & (F.col("key_home") == F.col("home_team"))
    return p.select("contest_id", "game_id", "key_season", "key_week", "key_away", "key_home", ok.cast("bigint").alias("round_trip"))


@register("clock_seconds")
def q_clock_seconds(spark, sf_dir):
    p = _plays(spark, sf_dir)
    return p.select("contest_id", "play_id", "possession_clock", clock_to_seconds(F.col("possession_clock")).alias("seconds"))


@register("period_points_wide")
def q_period_points_wide(spark, sf_dir):
    p = _plays(spark, sf_dir).select("contest_id", F.col("off_team").alias("team"), "period", "points")
    return reshape.wider(p, ["contest_id", "team"], "period", "points", list(range(1, 8)), glue="pts_p{name}", agg="sum")


@register("fill_rules")
def q_fill_rules(spark, sf_dir):
    pp = side_stats.period_points(_plays(spark, sf_dir))
    qcols = [f"qtr_pts_{k}" for k in side_stats.REGULAR_PERIODS]
    n_missing = sum((F.col(c).isNull().cast("bigint") for c in qcols), F.lit(0).cast("bigint"))
    out = pp.select("contest_id", "team", *qcols, n_missing.alias("n_missing"))
    return out.fillna(0, subset=qcols)


@register("roster_names")
def q_roster_names(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    return c.select(F.col("c_custkey").alias("player_id"), clean_name(F.col("c_name")).alias("name"))


@register("html_rows")
def q_html_rows(spark, sf_dir):
    return nested.list_items(read_table(spark, sf_dir, "pages", ["page_id", "html"]))


@register("html_table_rows")
def q_html_table_rows(spark, sf_dir):
    return documents.supplier_rows(read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]))


@register("fixture_rows")
def q_fixture_rows(spark, sf_dir):
    return documents.fixture_rows(prepared.contests(spark, sf_dir))


@register("team_table")
def q_team_table(spark, sf_dir):
    alias = bounded_broadcast(adapters.teams(spark, sf_dir).select(F.lower("team").alias("team_name"), F.col("team").alias("team_abb")), adapters.DIM_MAX_ROWS)
    return documents.team_rows(_record(spark, sf_dir), alias)


@register("standings_json")
def q_standings_json(spark, sf_dir):
    return documents.standings_rows(_record(spark, sf_dir), bounded_broadcast(adapters.teams(spark, sf_dir), adapters.DIM_MAX_ROWS))


@register("json_stats")
def q_json_stats(spark, sf_dir):
    return nested.json_field_stats(read_table(spark, sf_dir, "events", ["event_type", "props"]), "props", "k", ["event_type"])


@register("standings_rank")
def q_standings_rank(spark, sf_dir):
    k = prepared.contests(spark, sf_dir)
    return standings(k, bounded_broadcast(adapters.teams(spark, sf_dir), adapters.DIM_MAX_ROWS))


@register("next_matchups")
def q_next_matchups(spark, sf_dir):
    return next_matchups(prepared.contests(spark, sf_dir), season=1998, week=27)


def _home_wins(spark, sf_dir):
    k = prepared.contests(spark, sf_dir)
    return k.select("contest_id", (F.col("home_score") > F.col("away_score")).cast("bigint").alias("home_win"))


@register("stratified_split")
def q_stratified_split(spark, sf_dir):
    return ml.stratified_split(_home_wins(spark, sf_dir), ["home_win"], "contest_id", prop=0.75, seed=234)


@register("fold_counts")
def q_fold_counts(spark, sf_dir):
    s = ml.stratified_split(_home_wins(spark, sf_dir), ["home_win"], "contest_id", prop=0.75, seed=234)
    f = ml.stratified_folds(s.where(F.col("split") == "train"), ["home_win"], "contest_id", k=10, seed=234)
    return f.groupBy("fold", "home_win").agg(F.count(F.lit(1)).alias("n"))


def _model_table(spark, sf_dir):
    k = prepared.contests(spark, sf_dir)
    return models.model_table(k, prepared.plays(spark, sf_dir), prepared.period_ratings(spark, sf_dir))


@register("fit_logistic")
def q_fit_logistic(spark, sf_dir):
    return models.fit_and_score(_model_table(spark, sf_dir), "logistic")


@register("fit_gbt")
def q_fit_gbt(spark, sf_dir):
    return models.fit_and_score(_model_table(spark, sf_dir), "gbt")


@register("tune_logistic")
def q_tune_logistic(spark, sf_dir):
    rows = models.tune_logistic(_model_table(spark, sf_dir))
    return spark.createDataFrame(rows, "candidate long, reg_param double, elastic_net double, mean_auc double, rank long")


@register("race_steps")
def q_race_steps(spark, sf_dir):
    rows = models.race_logistic(_model_table(spark, sf_dir))
    return spark.createDataFrame(rows, "candidate long, reg_param double, fold long, auc double, alive boolean")


@register("holdout_scores")
def q_holdout_scores(spark, sf_dir):
    t = _model_table(spark, sf_dir)
    last = t.agg(F.max("season")).first()[0]
    return models.holdout_scores(spark, t, int(last))


def _emb(spark, sf_dir):
    return models.embedding_table(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]))


@register("knn_vote")
def q_knn_vote(spark, sf_dir):
    e = ml.stratified_split(_emb(spark, sf_dir), ["label"], "id", prop=0.75, seed=234)
    train, test = e.where(F.col("split") == "train"), e.where(F.col("split") == "test")
    pred = ml.knn_predict(train, test, "label", k=5)
    return test.select("id", "label").join(pred, "id", "left")


@register("smote_counts")
def q_smote_counts(spark, sf_dir):
    e = _emb(spark, sf_dir).withColumn("label", (F.col("label") == 0).cast("int"))
    out = ml.smote(e, "label", 1, ratio=0.9, k=5)
    return out.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"))


@register("upsample_counts")
def q_upsample_counts(spark, sf_dir):
    e = _emb(spark, sf_dir).withColumn("label", (F.col("label") == 0).cast("int"))
    return ml.upsample(e, "label", 1, "id", ratio=1.0).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


_QTR = range(1, 5)
_OFF_ROLL = [
    *[f"qtr_pts_{q}" for q in _QTR], "pts_scored", "third_down_pct", "turnovers", "value_added", "score_diff",
    "possession_sec", "possession_pct", *[f"score_diff_qtr_{q}" for q in _QTR], *[f"dscore_diff_qtr_{q}" for q in _QTR],
    "ndrives", "score_drives", "score_drives_pct",
]
_DEF_ROLL = [
    *[f"def_qtr_pts_{q}" for q in _QTR], "def_value_added", "def_third_down_pct", "def_turnovers",
    "def_ndrives", "def_score_drives", "def_score_drives_pct",
]


def _with_day(spark, sf_dir, df):
    return df.join(prepared.contests(spark, sf_dir).select("contest_id", "gameday"), "contest_id")


@register("rolling_offense")
def q_rolling_offense(spark, sf_dir):
    off = _with_day(spark, sf_dir, side_stats.game_stats(_plays(spark, sf_dir)).select("season", "team", "contest_id", *_OFF_ROLL))
    off = materialize_scratch(off, "offense_sides")  # the scan reads its input more than once
    return features.prior_values(off, _OFF_ROLL, [], strict=True).select("season", "team", "contest_id", "gameday", *_OFF_ROLL)


@register("rolling_defense")
def q_rolling_defense(spark, sf_dir):
    d = _with_day(spark, sf_dir, side_stats.defense_stats(_plays(spark, sf_dir)).select("season", "team", "contest_id", *_DEF_ROLL))
    d = materialize_scratch(d, "defense_sides")
    return features.prior_values(d, _DEF_ROLL, [], strict=True).select("season", "team", "contest_id", "gameday", *_DEF_ROLL)


@register("rolling_elo")
def q_rolling_elo(spark, sf_dir):
    elo = prepared.ratings(spark, sf_dir)
    return elo.select("season", "contest_id", "gameday", "team", "home_away", nullf.round_half_up(F.col("prior_elo"), 4).alias("elo"))


@register("trailing_mean_group")
def q_trailing_mean_group(spark, sf_dir):
    ev = adapters.player_events(spark, sf_dir).select("player_id", "event_type", "ts", "event_id", "value")
    go = GroupOrder(keys=["player_id", "event_type"], order=["ts", "event_id"], levels=time_levels("ts"))
    return rolling.trailing_means(ev, go, ["value"], periods=(1, 2, 4, 8, 16), digits=4)


@register("player_model_input")
def q_player_model_input(spark, sf_dir):
    ev = adapters.player_events(spark, sf_dir).select("player_id", "ts", "event_id", "event_type", "value", "k")
    go = GroupOrder(keys=["player_id"], order=["ts", "event_id"], levels=time_levels("ts"))
    t = rolling.trailing_means(ev, go, ["value", "k"], periods=(4,), digits=4)
    t = t.where(F.col("event_type") == "purchase").withColumn("label", (F.col("value") > 50).cast("bigint"))
    keep = ["player_id", "ts", "event_id", "label"] + reshape.columns_like(t, "_roll_4")
    return reshape.strip_suffix(t.select(*keep), r"_lag1_roll_4$")


@register("regression_metrics")
def q_regression_metrics(spark, sf_dir):
    return evaluation.regression_metrics(_pred(spark, sf_dir), pred="model_margin", actual="actual_margin")


@register("spread_features")
def q_spread_features(spark, sf_dir):
    return features.spread_features(prepared.contests(spark, sf_dir), prepared.plays(spark, sf_dir))


@register("game_stats")
def q_game_stats(spark, sf_dir):
    return side_stats.game_stats(_plays(spark, sf_dir))


@register("yards_long")
def q_yards_long(spark, sf_dir):
    return side_stats.yards_long(_plays(spark, sf_dir))


@register("half_ppr")
def q_half_ppr(spark, sf_dir):
    ev = adapters.player_events(spark, sf_dir)
    return stats.half_ppr(ev, ["player_id", "event_type"], "value", "k")


@register("metric_by_wins")
def q_metric_by_wins(spark, sf_dir):
    rec = _record(spark, sf_dir).select("season", "team", "contest_id", "win")
    off = side_stats.offense_stats(_plays(spark, sf_dir)).select("contest_id", "team", "turnovers")
    return stats.metric_by_wins(rec.join(off, ["contest_id", "team"], "left"), "turnovers")


@register("season_value_total")
def q_season_value_total(spark, sf_dir):
    ps = _with_day(spark, sf_dir, side_stats.pass_splits(_plays(spark, sf_dir)).select("season", "team", "contest_id", "max_value"))
    out = scan(ps, _season_team(spark, sf_dir), sums={"season_total": F.col("max_value")})
    return out.select("season", "team", "contest_id", "gameday", "max_value", F.col("season_total").cast("bigint").alias("season_total"))


@register("variable_importance")
def q_variable_importance(spark, sf_dir):
    t = _model_table(spark, sf_dir)
    est = ml.classifiers("label")["gbt"]
    model = ml.workflow(ml.preprocess_stages(models.FEATURE_COLS, drop_zero_variance=False), est).fit(t)
    rows = ml.importance(model, models.FEATURE_COLS)
    return spark.createDataFrame(rows, "feature string, importance double")


TUNED_PAIRS, TUNED_FOLDS = [("scaled", "logistic"), ("plain", "forest")], 5


def _tuned(spark, sf_dir):
    """The scoring table of the workflow set, stored once per contests snapshot and version of the code that makes it."""
    def build():
        return workflows.tuned_scores(spark, _model_table(spark, sf_dir), workflows.win_workflows(pairs=TUNED_PAIRS), k=TUNED_FOLDS)
    return prepared.stored(spark, sf_dir, "tuned", (workflows, tuning, ml, features, models, side_stats, records, ratings), build)


@register("tune_workflows")
def q_tune_workflows(spark, sf_dir):
    return workflows.tuned_metrics(_tuned(spark, sf_dir))


@register("tune_ranking")
def q_tune_ranking(spark, sf_dir):
    return tuning.ranking(spark, workflows.win_workflows(pairs=TUNED_PAIRS), workflows.tuned_metrics(_tuned(spark, sf_dir)))


@register("tune_fold_sizes")
def q_tune_fold_sizes(spark, sf_dir):
    return _tuned(spark, sf_dir).groupBy("workflow", "candidate", "fold").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("truth").alias("n_wins"))


def _spread_split(spark, sf_dir):
    """The margin model's table, stored once per contests snapshot and version of the code that makes it, with its split."""
    def build():
        return features.spread_features(prepared.contests(spark, sf_dir), prepared.plays(spark, sf_dir))
    return workflows.spread_split(prepared.stored(spark, sf_dir, "spread_table", (features, side_stats, records, scan_ops), build))


@register("spread_split")
def q_spread_split(spark, sf_dir):
    return _spread_split(spark, sf_dir).select("contest_id", "spread", "bin", "split")


def _register_spread(model: str) -> None:
    @register(f"fit_spread_{model}")
    def q_fit_spread(spark, sf_dir):
        return workflows.fit_spread(_spread_split(spark, sf_dir), model)


for _model in ("linear", "gbt", "forest", "bagged"):
    _register_spread(_model)


@register("spread_model_metrics")
def q_spread_model_metrics(spark, sf_dir):
    split = _spread_split(spark, sf_dir)
    parts = [evaluation.regression_metrics(workflows.fit_spread(split, m), actual="truth").withColumn("model", F.lit(m)) for m in ("linear", "bagged")]
    return parts[0].unionByName(parts[1])


COMING = (1998, 27)


def _coming(spark, sf_dir):
    k = prepared.contests(spark, sf_dir)
    return workflows.coming_week(k, features.side_table(k, prepared.plays(spark, sf_dir), prepared.period_ratings(spark, sf_dir)), *COMING)


@register("coming_week_features")
def q_coming_week_features(spark, sf_dir):
    return _coming(spark, sf_dir)


@register("coming_week_scores")
def q_coming_week_scores(spark, sf_dir):
    return workflows.coming_week_scores(spark, _model_table(spark, sf_dir), _coming(spark, sf_dir), *COMING)


@register("contest_dictionary")
def q_contest_dictionary(spark, sf_dir):
    return dictionary.dictionary(dictionary.described(prepared.contests(spark, sf_dir), dictionary.CONTESTS))


def _dated_sides(spark, sf_dir):
    return sides(prepared.contests(spark, sf_dir)).withColumn("played", F.struct("gameday", "contest_id"))


@register("second_last_score")
def q_second_last_score(spark, sf_dir):
    return stats.second_to_last(_dated_sides(spark, sf_dir), ["season", "team"], "played", "own_score", "second_last_score")


@register("team_season_ids")
def q_team_season_ids(spark, sf_dir):
    return stats.group_ids(sides(prepared.contests(spark, sf_dir)).select("season", "team", "contest_id"), ["season", "team"])


@register("team_totals")
def q_team_totals(spark, sf_dir):
    s = sides(prepared.contests(spark, sf_dir)).select("season", "team", "opponent", "own_score", "opp_score", "is_home", "div_game")
    return stats.numeric_totals(s, ["season", "team"])


@register("margin_summary")
def q_margin_summary(spark, sf_dir):
    return stats.spread_summary(prepared.contests(spark, sf_dir).withColumn("margin", F.col("home_score") - F.col("away_score")), "margin", ["season"])


@register("requested_weeks")
def q_requested_weeks(spark, sf_dir):
    week = nullf.clamp_week(F.col("season"), F.col("week")).cast("bigint").alias("asked_week")
    asked = prepared.contests(spark, sf_dir).select("season", F.greatest("season", F.lit(2002)).cast("bigint").alias("asked_season"), week)
    return asked.groupBy("season", "asked_season", "asked_week").agg(F.count(F.lit(1)).alias("contests"))
