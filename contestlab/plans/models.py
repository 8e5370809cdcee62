"""Model workflows on the pre-game feature table and on the embedding table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ml
from ..session import materialize_scratch, scratch_path
from . import features

FEATURE_COLS = features.PREGAME_FEATURES + [f"opp_{c}" for c in features.OPP_FEATURES]


def model_table(contests: DataFrame, plays: DataFrame, elo: DataFrame | None = None) -> DataFrame:
    t = features.pregame_features(contests, plays, elo)
    # model fitting makes many passes over its input: store the table once instead of recomputing its plan
    return materialize_scratch(t.withColumn("label", F.col("win").cast("double")), "model_table")


def fit_and_score(table: DataFrame, model: str = "logistic", seed: int = 234) -> DataFrame:
    """Stratified 75/25 split, fit recipe + model on the training rows, score the test rows."""
    s = ml.stratified_split(table, ["win"], "contest_id", prop=0.75, seed=seed)
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    est = ml.classifiers("label", n_features=len(FEATURE_COLS))[model]
    pipe = ml.workflow(ml.preprocess_stages(FEATURE_COLS), est)
    fitted = pipe.fit(train)
    pred = fitted.transform(test)
    if "probability" in pred.columns:
        pred = ml.with_probability(pred)
    else:
        pred = pred.withColumn("prob", F.lit(None).cast("double"))
    return pred.select("contest_id", "season", F.col("win").alias("truth"), F.col("prediction").cast("bigint").alias("pred"), "prob")


def tune_logistic(table: DataFrame, seed: int = 234, k: int = 10, parallelism: int = 4) -> list[tuple]:
    """Cross-validated grid over regularisation strength and elastic-net mix on stratified folds; rows of
    ``(candidate, reg_param, elastic_net, mean_auc, rank)``."""
    s = ml.stratified_split(table, ["win"], "contest_id", prop=0.75, seed=seed).where(F.col("split") == "train")
    folded = ml.stratified_folds(s, ["win"], "contest_id", k=k, seed=seed)
    est = ml.classifiers("label")["logistic"]
    pipe = ml.workflow(ml.preprocess_stages(FEATURE_COLS), est)
    grid = ParamGridBuilder().addGrid(est.regParam, [0.001, 0.1]).addGrid(est.elasticNetParam, [0.0, 0.5]).build()
    folded = materialize_scratch(folded, "folds")  # every candidate and fold reads this table
    _, metrics = ml.tune(pipe, grid, folded, "label", fold_col="fold", parallelism=parallelism, k=k)
    rows = [(i, float(g[est.regParam]), float(g[est.elasticNetParam]), float(m)) for i, (g, m) in enumerate(zip(grid, metrics))]
    order = sorted(rows, key=lambda r: -r[3])
    rank = {r[0]: n + 1 for n, r in enumerate(order)}
    return [(*r, rank[r[0]]) for r in rows]


def race_logistic(table: DataFrame, seed: int = 234, k: int = 5, burn_in: int = 3) -> list[tuple]:
    """Racing over regularisation strengths on stratified folds: rows ``(candidate, reg_param, fold, auc, alive)``."""
    s = ml.stratified_split(table, ["win"], "contest_id", prop=0.75, seed=seed).where(F.col("split") == "train")
    folded = materialize_scratch(ml.stratified_folds(s, ["win"], "contest_id", k=k, seed=seed), "folds")
    est = ml.classifiers("label")["logistic"]
    grid = ParamGridBuilder().addGrid(est.regParam, [0.0001, 0.01, 0.3, 3.0]).build()
    found = ml.race(ml.workflow(ml.preprocess_stages(FEATURE_COLS), est), grid, folded, "label", k=k, burn_in=burn_in)
    return [(i, float(grid[i][est.regParam]), f, float(x), alive) for i, f, x, alive in found.steps]


def holdout_scores(spark: SparkSession, table: DataFrame, holdout_season: int) -> DataFrame:
    """Temporal hold-out: fit on earlier seasons, save the fitted pipeline, load it back and score the hold-out
    season (the stored model is what a weekly scoring job would load)."""
    train, hold = ml.temporal_holdout(table, "season", holdout_season)
    pipe = ml.workflow(ml.preprocess_stages(FEATURE_COLS), ml.classifiers("label")["logistic"])
    path = scratch_path(spark, "model")
    pipe.fit(train).write().overwrite().save(path)
    model = PipelineModel.load(path)
    pred = ml.with_probability(model.transform(hold))
    return pred.select("contest_id", "season", "week", "team", "opponent", F.col("win").alias("truth"),
                       F.col("prediction").cast("bigint").alias("pred"), "prob")


def embedding_table(emb: DataFrame) -> DataFrame:
    return emb.select(F.col("vec_id").alias("id"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), "label")
