"""The tuned workflow set of the win model, the workflows of the margin model, and the scoring of a coming week."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import drop_incomplete, round_half_up
from ..operators import evaluation, ml, records
from ..operators.scan import GroupOrder, numeric_levels, scan
from ..operators.tuning import Span, Workflow, bagged_prediction, bagged_trees, score_folds, workflow_set
from ..session import materialize_scratch, scratch_path
from ..sources.tables import bounded_broadcast
from . import features
from .models import FEATURE_COLS

CANDIDATES, FOLDS = 20, 10
PAIRS = [("scaled", "logistic"), ("scaled", "svm"), ("plain", "forest")]


def win_workflows(n: int = CANDIDATES, seed: int = 234, pairs: list[tuple[str, str]] = PAIRS) -> dict[str, Workflow]:
    """Scaled recipes for the linear models, plain ones for the forest; ``n`` candidates a model."""
    recipes = {"scaled": ml.preprocess_stages(FEATURE_COLS), "plain": ml.preprocess_stages(FEATURE_COLS, scale=False)}
    models = {
        "logistic": (LogisticRegression(labelCol="label", maxIter=50), {"regParam": Span(1e-4, 1.0, "log"), "elasticNetParam": Span(0.0, 1.0)}),
        "svm": (LinearSVC(labelCol="label", maxIter=25), {"regParam": Span(1e-4, 1.0, "log")}),
        "forest": (RandomForestClassifier(labelCol="label", seed=7), {"numTrees": Span(10, 40, "int"), "maxDepth": Span(2, 6, "int"), "minInstancesPerNode": Span(1, 40, "int")}),
    }
    return workflow_set(recipes, models, n, seed, pairs)


def training_folds(table: DataFrame, k: int = FOLDS, seed: int = 234) -> DataFrame:
    """The training part of the stratified split, dealt to ``k`` stratified folds, and stored: every fit reads it."""
    train = ml.stratified_split(table, ["win"], "contest_id", prop=0.75, seed=seed).where(F.col("split") == "train")
    return materialize_scratch(ml.stratified_folds(train, ["win"], "contest_id", k=k, seed=seed), "folds")


def tuned_scores(spark: SparkSession, table: DataFrame, workflows: dict[str, Workflow], k: int = FOLDS, parallelism: int = 4) -> DataFrame:
    return score_folds(spark, workflows, training_folds(table, k), "contest_id", "label", k, parallelism=parallelism)


def tuned_metrics(scored: DataFrame) -> DataFrame:
    """``workflow, candidate, fold, metric, value``."""
    return evaluation.metric_table(scored, ["workflow", "candidate", "fold"])


# Margin model -----------------------------------------------------------------------------------------------------------

SPREAD_NUMERIC = [c for c in [*features.SPREAD_FEATURES, *[f"opp_{c}" for c in features.SPREAD_OPP]] if c not in ("rest", "opp_rest")]
SPREAD_CATEGORIES = ["rest", "opp_rest"]


MAX_VALUES = 200_000  # different values whose bins are broadcast; more are shuffled


def value_bins(df: DataFrame, col: str, bins: int = 4, out: str = "bin") -> DataFrame:
    """Add the exact quantile bin of a number: ``floor(bins * rows with a smaller value / rows)``, so equal values share a bin.
    Rows are counted by value first; the counts are what is scanned."""
    counts = df.groupBy(F.col(col).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    go = GroupOrder(keys=[], order=["__v"], levels=numeric_levels("__v", (1.0, 64.0, 4096.0)))
    upto = scan(counts, go, sums={"__upto": F.col("__n")})
    rows = counts.agg(F.sum("__n").alias("__rows")).withColumn("__k", F.lit(1))
    upto = upto.withColumn("__k", F.lit(1)).join(F.broadcast(rows), "__k")  # one-row table
    bounds = upto.select("__v", F.floor(bins * (F.col("__upto") - F.col("__n")) / F.col("__rows")).cast("bigint").alias(out))
    bounds = bounded_broadcast(materialize_scratch(bounds, "value-bins"), MAX_VALUES)
    return df.join(bounds, F.col(col).eqNullSafe(F.col("__v")), "left").drop("__v")


def spread_split(table: DataFrame, seed: int = 234, prop: float = 0.75) -> DataFrame:
    """The margin model's rows (a stored table, one row a contest) with the quartile bin of the margin and the split stratified
    by it. Bins and last train rows are small tables, so the rows are read, never shuffled."""
    return ml.unique_split(value_bins(table, "spread"), ["bin"], "contest_id", prop=prop, seed=seed)


def fit_spread(split: DataFrame, model: str, bags: int = 25) -> DataFrame:
    """Test rows ``contest_id, season, truth, pred`` of a regression workflow fitted on the training rows: ``linear`` (elastic
    net), ``gbt``, ``forest`` or ``bagged`` (trees on Poisson row weights, averaged)."""
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    train = train.withColumn("label", F.col("spread").cast("double"))
    recipe = Pipeline(stages=ml.preprocess_stages(SPREAD_NUMERIC, SPREAD_CATEGORIES, scale=model == "linear")).fit(train)
    ready = materialize_scratch(recipe.transform(train).select("contest_id", "label", "features"), "spread_train")
    rows = recipe.transform(test).select("contest_id", "season", F.col("spread").alias("truth"), "features")
    if model == "bagged":
        tree = DecisionTreeRegressor(labelCol="label", maxDepth=6, minInstancesPerNode=10, seed=7)
        pred = bagged_prediction(bagged_trees(ready, tree, "contest_id", bags), rows)
    else:
        pred = ml.regressors("label")[model].fit(ready).transform(rows)
    return pred.select("contest_id", "season", "truth", F.col("prediction").alias("pred"))


# Coming week ------------------------------------------------------------------------------------------------------------


def team_states(side: DataFrame, season: int, week: int) -> DataFrame:
    """Every team's state after its contests of the season before the week, from the side table: the record and rating of its
    last contest, the day of it, and its means so far. One aggregation by team with map-side combining; no ordering."""
    t = side.where((F.col("season") == season) & (F.col("week") < week))
    means = features.OFFENSE_MEANS + features.DEFENSE_MEANS
    thousandths = {c: F.round(F.col(c) * 1000).cast("bigint") for c in means}
    last = F.struct("gameday", *features.RECORD_LAGS, "elo")
    state = t.groupBy("team").agg(
        F.max_by(last, F.struct("gameday", "contest_id")).alias("last"),
        *[(F.sum(v) / F.count(v)).alias(c) for c, v in thousandths.items()],
    )
    return state.select(
        "team", F.col("last.gameday").alias("last_day"), *[round_half_up(F.col(f"last.{c}"), 4).alias(c) for c in (*features.RECORD_LAGS, "elo")],
        *[round_half_up(F.col(c) / 1000.0, 3).alias(c) for c in means],
    )


def coming_week(contests: DataFrame, side: DataFrame, season: int, week: int) -> DataFrame:
    """Fixtures of a week with exactly the feature columns of the win model, from states known before the week. A team without
    an earlier contest in the season has no state; its fixtures are left out, as incomplete rows are in training."""
    ids = ["season", "week", "gameday", "contest_id", "game_id"]
    fx = contests.where((F.col("season") == season) & (F.col("week") == week)).select(*ids, "home_team", "away_team", "line")
    two = fx.select(*ids, "line", F.inline(F.array(
        F.struct(F.lit("home").alias("home_away"), F.col("home_team").alias("team"), F.col("away_team").alias("opponent")),
        F.struct(F.lit("away").alias("home_away"), F.col("away_team").alias("team"), F.col("home_team").alias("opponent")),
    )))
    t = two.join(team_states(side, season, week), "team", "left")
    t = t.withColumn("rest_days", F.coalesce(F.datediff("gameday", "last_day"), F.lit(records.DEFAULT_REST_DAYS)).cast("bigint"))
    t = features.favorite_flags(t)
    cols = [*ids, "team", "opponent"]
    m = features.matchup_rows(t, cols, features.PREGAME_FEATURES, label=None).select(*cols, *FEATURE_COLS)
    return drop_incomplete(m, subset=FEATURE_COLS)


def require_inputs(model: PipelineModel, rows: DataFrame) -> None:
    """An error that names the columns that a stored pipeline's assemblers need and the rows lack, or have with a type that is
    no number. Columns that earlier stages make are not asked for."""
    made, have = set(), dict(rows.dtypes)
    numbers = ("double", "float", "bigint", "int", "smallint", "tinyint", "boolean", "decimal")
    wrong = []
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            wrong += [c for c in stage.getInputCols() if c not in made and not have.get(c, "").startswith(numbers)]
        for get in ("getOutputCol", "getOutputCols"):
            if hasattr(stage, get) and (get == "getOutputCol" or stage.isSet("outputCols")):
                found = getattr(stage, get)()
                made |= {found} if isinstance(found, str) else set(found)
    if wrong:
        raise ValueError("the rows lack, or have as other than numbers: " + ", ".join(sorted(set(wrong))))


def coming_week_scores(spark: SparkSession, table: DataFrame, fixtures: DataFrame, season: int, week: int) -> DataFrame:
    """Fit on the contests before the week, store the pipeline, load it, check the fixtures against it and score them."""
    before = table.where((F.col("season") < season) | ((F.col("season") == season) & (F.col("week") < week)))
    path = scratch_path(spark, "win_model")
    ml.workflow(ml.preprocess_stages(FEATURE_COLS), ml.classifiers("label")["logistic"]).fit(before).write().overwrite().save(path)
    model = PipelineModel.load(path)
    require_inputs(model, fixtures)
    pred = ml.with_probability(model.transform(fixtures))
    return pred.select("season", "week", "contest_id", "game_id", "team", "opponent", F.col("prediction").cast("bigint").alias("pick"), "prob")
