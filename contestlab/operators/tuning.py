"""Workflow sets tuned over a space-filling design: every candidate of every workflow scored on every fold.

The result of a tuning run is a table of scored rows ``(workflow, candidate, fold, id, truth, prob, score, pred)``, written
fold by fold under the shared folder; all metrics are aggregates of it. A recipe is fitted once a fold and shared by the
candidates of a workflow. Fits are Spark jobs, started from a few driver threads; nothing but parameters is on the driver.
"""

from __future__ import annotations

import json
import math
import os
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.nulls import round_half_up
from ..session import scratch_path

SCORED = "workflow string, candidate bigint, fold int, id bigint, truth bigint, prob double, score double, pred bigint"


@dataclass(frozen=True)
class Span:
    """The range of a tuned parameter: ``linear``, ``log`` (both ends above 0) or ``int`` (both ends included)."""

    low: float
    high: float
    scale: str = "linear"

    def at(self, u: float) -> float | int:
        """The value at the fraction ``u`` in [0, 1) of the range."""
        if self.scale == "log":
            return math.exp(math.log(self.low) + u * (math.log(self.high) - math.log(self.low)))
        if self.scale == "int":
            return min(int(self.high), int(self.low) + int(u * (int(self.high) - int(self.low) + 1)))
        return self.low + u * (self.high - self.low)


def latin_hypercube(space: dict[str, Span], n: int = 20, seed: int = 234, tries: int = 25) -> list[dict[str, float | int]]:
    """``n`` candidates that fill the space: in each parameter every n-th of the range holds one candidate. Of ``tries`` such
    designs of the seed, the one whose closest pair of candidates is farthest apart."""
    rng = random.Random(seed)
    best, widest = [], -1.0
    for _ in range(max(1, tries)):
        columns = []
        for _ in space:
            cells = list(range(n))
            rng.shuffle(cells)
            columns.append([(c + rng.random()) / n for c in cells])
        points = list(zip(*columns, strict=True)) if columns else [()] * n
        apart = min((math.dist(a, b) for i, a in enumerate(points) for b in points[:i]), default=0.0)
        if apart > widest:
            best, widest = points, apart
    return [{name: span.at(u) for (name, span), u in zip(space.items(), point, strict=True)} for point in best]


@dataclass
class Workflow:
    """A recipe (stages that end in ``features``), a model and the candidates of its parameters."""

    recipe: list
    model: object
    candidates: list[dict]


def workflow_set(recipes: dict[str, list], models: dict[str, tuple], n: int = 20, seed: int = 234, pairs: list[tuple[str, str]] | None = None) -> dict[str, Workflow]:
    """``{"recipe__model": Workflow}`` of all (or the given) pairs; ``models`` maps a name to ``(estimator, space)``."""
    pairs = pairs if pairs is not None else [(r, m) for r in recipes for m in models]
    return {f"{r}__{m}": Workflow(recipes[r], models[m][0], latin_hypercube(models[m][1], n, seed)) for r, m in pairs}


def _scored(pred: DataFrame, workflow: str, candidate: int, fold: int, id_col: str, label: str) -> DataFrame:
    """Scored rows of one model: the score is the probability of class 1 or, where a model has none, its raw margin."""
    prob: Column = vector_to_array(F.col("probability"))[1] if "probability" in pred.columns else F.lit(None).cast("double")
    score = prob if "probability" in pred.columns else vector_to_array(F.col("rawPrediction"))[1]
    return pred.select(
        F.lit(workflow).alias("workflow"), F.lit(candidate).cast("bigint").alias("candidate"), F.lit(fold).cast("int").alias("fold"),
        F.col(id_col).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("truth"), prob.alias("prob"), score.alias("score"),
        F.col("prediction").cast("bigint").alias("pred"),
    )


def score_folds(spark: SparkSession, workflows: dict[str, Workflow], folded: DataFrame, id_col: str, label: str, k: int = 10,
                fold_col: str = "fold", parallelism: int = 4, rows_per_task: int = 100_000, path: str | None = None, fits: int = 4) -> DataFrame:
    """The scoring table: every candidate of every workflow, fitted on the other folds, applied to the rows of each fold.

    Each (workflow, fold) is one folder, written whole, so that a run again replaces it; ``parallelism`` of them are worked on
    at a time, with ``fits`` candidates each. An iterative fit starts a task a partition and iteration, so training rows lie in
    partitions of about ``rows_per_task``, as many as the table needs."""
    path = path or scratch_path(spark, "scored")
    tasks = max(1, math.ceil(folded.count() / rows_per_task))

    def one(name: str, fold: int) -> None:
        w = workflows[name]
        train, held = folded.where(F.col(fold_col) != fold), folded.where(F.col(fold_col) == fold)
        recipe = Pipeline(stages=w.recipe).fit(train)
        ready = recipe.transform(train).select(label, "features").coalesce(tasks).persist()
        rows = recipe.transform(held).select(id_col, label, "features").coalesce(tasks).persist()
        try:
            grid = [{w.model.getParam(p): v for p, v in c.items()} for c in w.candidates]
            with ThreadPoolExecutor(fits) as fitting:
                models = [f.result() for f in [fitting.submit(inheritable_thread_target(spark)(w.model.fit), ready, g) for g in grid]]
            parts = [_scored(m.transform(rows), name, i, fold, id_col, label) for i, m in enumerate(models)]
            reduce(DataFrame.unionByName, parts).write.mode("overwrite").parquet(os.path.join(path, f"{name}-{fold}"))
        finally:
            ready.unpersist()
            rows.unpersist()

    jobs = [(name, fold) for name in workflows for fold in range(k)]
    with ThreadPoolExecutor(parallelism) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(one), *job) for job in jobs]:
            done.result()
    return spark.read.schema(SCORED).parquet(*[os.path.join(path, f"{name}-{fold}") for name, fold in jobs])


def ranking(spark: SparkSession, workflows: dict[str, Workflow], metrics: DataFrame, metric: str = "roc_auc", higher: bool = True, digits: int = 6) -> DataFrame:
    """Candidates by the mean of a metric over folds: ``workflow, candidate, params, n_folds, mean, std_err, rank`` (of all) and
    ``workflow_rank`` (within a workflow). The table holds one row a candidate, whatever the size of the data."""
    params = spark.createDataFrame([(n, i, json.dumps(c, sort_keys=True)) for n, w in workflows.items() for i, c in enumerate(w.candidates)],
                                   "workflow string, candidate bigint, params string")
    m = metrics.where((F.col("metric") == metric) & F.col("value").isNotNull()).groupBy("workflow", "candidate").agg(
        F.count(F.lit(1)).alias("n_folds"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    order = [F.col("mean").desc_nulls_last() if higher else F.col("mean").asc_nulls_last(), F.col("workflow"), F.col("candidate")]
    t = params.join(m, ["workflow", "candidate"], "left")
    return t.select(
        "workflow", "candidate", "params", F.coalesce("n_folds", F.lit(0)).cast("bigint").alias("n_folds"), round_half_up(F.col("mean"), digits).alias("mean"),
        round_half_up(F.col("sd") / F.sqrt("n_folds"), digits).alias("std_err"),
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rank"),
        F.row_number().over(Window.partitionBy("workflow").orderBy(*order)).cast("bigint").alias("workflow_rank"),
    )


# Bagging ----------------------------------------------------------------------------------------------------------------


def poisson_weight(id_col: str, bag: int, seed: int = 7, most: int = 8) -> Column:
    """How often a row is in a bag: a Poisson(1) draw from a hash of the id, so that it does not depend on partitions. ``most``
    ends the table of the distribution (the chance of more is about one in a million)."""
    u = F.pmod(F.xxhash64(F.col(id_col), F.lit(bag), F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    total, step, weight = 0.0, math.exp(-1), F.lit(0.0)
    for times in range(most):
        total += step
        step /= times + 1
        weight = weight + (u >= F.lit(total)).cast("double")
    return weight


def bagged_trees(train: DataFrame, tree, id_col: str, bags: int = 25, seed: int = 7, parallelism: int = 4) -> list:
    """Trees fitted on Poisson-weighted copies of the rows (``tree`` is a tree estimator; weights go through its
    ``weightCol``): the bootstrap without moving or repeating a row."""
    spark = train.sparkSession

    def fit(bag: int):
        weighted = train.withColumn("__weight", poisson_weight(id_col, bag, seed)).where("__weight > 0")
        return tree.copy({tree.weightCol: "__weight", tree.predictionCol: f"__bag_{bag}"}).fit(weighted)

    with ThreadPoolExecutor(parallelism) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(fit), b) for b in range(bags)]]


def bagged_prediction(models: list, rows: DataFrame, out: str = "prediction") -> DataFrame:
    """The mean of the trees' predictions, as one column expression over the rows."""
    for m in models:
        rows = m.transform(rows)
    mean = reduce(Column.__add__, [F.col(m.getPredictionCol()) for m in models]) / float(len(models))
    return rows.withColumn(out, mean).drop(*[m.getPredictionCol() for m in models])
