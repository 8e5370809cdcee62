"""Model preparation, training, tuning and scoring with ``pyspark.ml``.

Splits and folds are deterministic functions of an id and a seed (an md5 rank inside each stratum), so they are
reproducible on any cluster and checkable in SQL. Ranking inside a stratum uses the bucketed scan (buckets = the first
hex digits of the hash), so a large class is never ranked in one task.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import (
    Bucketizer,
    Imputer,
    OneHotEncoder,
    PolynomialExpansion,
    StandardScaler,
    StringIndexer,
    VarianceThresholdSelector,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize_scratch
from ..sources.tables import bounded_broadcast, shuffle_tasks
from .scan import GroupOrder, prefix_levels, scan
from .stats import t_two_sided

HASH_PREFIXES = (5, 3, 1)  # bucket levels of the rank scan: 16^5, 16^3 and 16 hash prefixes per stratum


def _hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))


def _positions_in_strata(df: DataFrame, strata: list[str], id_col: str, seed: int, tasks: int | None = None) -> DataFrame:
    h = df.withColumn("__h", _hash(id_col, seed))
    go = GroupOrder(keys=strata, order=["__h", id_col], levels=prefix_levels("__h", HASH_PREFIXES), tasks=tasks)
    return scan(h, go, sums={"__pos": F.lit(1)})


def _rank_in_strata(df: DataFrame, strata: list[str], id_col: str, seed: int) -> DataFrame:
    h = df.withColumn("__h", _hash(id_col, seed))
    ranked = _positions_in_strata(df, strata, id_col, seed, shuffle_tasks(df))
    sizes = h.groupBy(*strata).agg(F.count(F.lit(1)).alias("__n"))
    return ranked.join(sizes, strata, "left")


def stratified_split(df: DataFrame, strata: list[str], id_col: str, prop: float = 0.75, seed: int = 234) -> DataFrame:
    """Add ``split`` = ``train`` for the first ``floor(prop * n + 0.5)`` rows of each stratum in md5 order, else
    ``test``: an exact stratified split whose class shares match the whole table."""
    r = _rank_in_strata(df, strata, id_col, seed)
    cut = F.floor(F.lit(prop) * F.col("__n") + F.lit(0.5))
    return r.withColumn("split", F.when(F.col("__pos") <= cut, "train").otherwise("test")).drop("__h", "__pos", "__n")


MAX_STRATA = 100_000  # last train rows (one a stratum) that are broadcast; more are shuffled


def unique_split(df: DataFrame, strata: list[str], id_col: str, prop: float = 0.75, seed: int = 234) -> DataFrame:
    """``stratified_split`` of a stored table without a repeated id, however wide its rows: only strata and ids are ranked. The
    last train row of each stratum in md5 order then tells the rows apart, so the table itself is not shuffled."""
    ranked = _rank_in_strata(df.select(*strata, id_col), strata, id_col, seed)
    key = F.struct("__h", id_col)
    last = ranked.where(F.col("__pos") == F.floor(F.lit(prop) * F.col("__n") + F.lit(0.5))).select(*strata, key.alias("__last"))
    last = bounded_broadcast(materialize_scratch(last, "last-train-rows"), MAX_STRATA)
    train = F.coalesce(key <= F.col("__last"), F.lit(False))
    rows = df.withColumn("__h", _hash(id_col, seed)).join(last, strata, "left")
    return rows.withColumn("split", F.when(train, "train").otherwise("test")).drop("__h", "__last")


def stratified_folds(df: DataFrame, strata: list[str], id_col: str, k: int = 10, seed: int = 234) -> DataFrame:
    """Add ``fold`` in ``0..k-1``: rows of each stratum dealt round-robin in md5 order (stratified k-fold)."""
    r = _positions_in_strata(df, strata, id_col, seed)
    return r.withColumn("fold", ((F.col("__pos") - 1) % k).cast("int")).drop("__h", "__pos")


def quantile_strata(df: DataFrame, col: str, n_bins: int = 4, rel_error: float = 1e-3, out: str = "stratum") -> DataFrame:
    """Numeric outcome to ``n_bins`` quantile bins for stratification (bounded sketch, then a ``Bucketizer``)."""
    probs = [i / n_bins for i in range(1, n_bins)]
    cuts = df.approxQuantile(col, probs, rel_error)
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    return Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="keep").transform(df)


def temporal_holdout(df: DataFrame, season_col: str, holdout_season: int) -> tuple[DataFrame, DataFrame]:
    """Everything before the hold-out season for training, the hold-out season for scoring."""
    return df.where(F.col(season_col) < holdout_season), df.where(F.col(season_col) == holdout_season)


def preprocess_stages(numeric: list[str], categorical: list[str] | None = None, scale: bool = True,
                      drop_zero_variance: bool = True, impute: bool = False, poly_degree: int | None = None) -> list:
    """Recipe: (impute) -> index unseen-level-safe categoricals -> one-hot -> assemble -> zero-variance filter ->
    centre and scale -> (polynomial expansion). Id columns are simply not listed, so they ride along unused."""
    categorical = categorical or []
    stages: list = []
    num = numeric
    if impute:
        num = [f"{c}__imp" for c in numeric]
        stages.append(Imputer(inputCols=numeric, outputCols=num, strategy="mean"))
    idx = [f"{c}__idx" for c in categorical]
    oh = [f"{c}__oh" for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=idx, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=oh, dropLast=True, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=num + oh, outputCol="__raw", handleInvalid="keep"))
    cur = "__raw"
    if drop_zero_variance:
        stages.append(VarianceThresholdSelector(featuresCol=cur, outputCol="__nzv", varianceThreshold=0.0))
        cur = "__nzv"
    if scale:
        stages.append(StandardScaler(inputCol=cur, outputCol="__scaled", withMean=True, withStd=True))
        cur = "__scaled"
    if poly_degree:
        stages.append(PolynomialExpansion(inputCol=cur, outputCol="__poly", degree=poly_degree))
        cur = "__poly"
    stages.append(VectorAssembler(inputCols=[cur], outputCol="features"))
    return stages


def classifiers(label: str = "label", n_features: int | None = None, seed: int = 7) -> dict:
    """Model specifications (tunable parameters are set through param grids)."""
    specs = {
        "logistic": LogisticRegression(labelCol=label, featuresCol="features", maxIter=100, regParam=0.01, elasticNetParam=0.5),
        "gbt": GBTClassifier(labelCol=label, featuresCol="features", maxIter=30, maxDepth=4, seed=seed),
        "forest": RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=50, seed=seed),
        "svm": LinearSVC(labelCol=label, featuresCol="features", maxIter=100, regParam=0.01),
    }
    if n_features:
        specs["mlp"] = MultilayerPerceptronClassifier(labelCol=label, featuresCol="features", layers=[n_features, 16, 2], maxIter=100, seed=seed)
    return specs


def regressors(label: str = "label", seed: int = 7) -> dict:
    return {
        "linear": LinearRegression(labelCol=label, featuresCol="features", regParam=0.01, elasticNetParam=0.5),
        "gbt": GBTRegressor(labelCol=label, featuresCol="features", maxIter=30, maxDepth=4, seed=seed),
        "forest": RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=50, seed=seed),
        # bagged trees: a forest that considers every feature at every split
        "bagged": RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=50, featureSubsetStrategy="all", seed=seed),
    }


def workflow(pre: list, model) -> Pipeline:
    return Pipeline(stages=[*pre, model])


def workflow_set(pre: dict[str, list], models: dict) -> dict[str, Pipeline]:
    """Every preprocessing recipe paired with every model: ``{"recipe__model": Pipeline}``."""
    return {f"{p}__{m}": workflow(stages, est) for p, stages in pre.items() for m, est in models.items()}


def _fold_scores(pipeline: Pipeline, grid: list, candidates: list[int], folded: DataFrame, fold: int, label: str, fold_col: str, ev, parallelism: int) -> list[float]:
    """Scores of candidates on a fold, each fitted on the other folds. Where the grid is of the last stage only, the stages
    before it are fitted once and their rows kept for all candidates; fits are started from a few threads."""
    train, held = folded.where(F.col(fold_col) != fold), folded.where(F.col(fold_col) == fold)
    *recipe, model = pipeline.getStages()
    if all(p.parent == model.uid for g in grid for p in g):
        fitted = Pipeline(stages=recipe).fit(train)
        train, held = (fitted.transform(rows).select(label, model.getFeaturesCol()) for rows in (train, held))
    else:
        model = pipeline
    train, held = train.persist(), held.persist()

    def score(i: int) -> float:
        return ev.evaluate(model.fit(train, grid[i]).transform(held))

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            return [f.result() for f in [pool.submit(inheritable_thread_target(folded.sparkSession)(score), i) for i in candidates]]
    finally:
        train.unpersist()
        held.unpersist()


def tune(pipeline: Pipeline, grid: list, train: DataFrame, label: str, fold_col: str = "fold", metric: str = "areaUnderROC",
         parallelism: int = 4, k: int = 10) -> tuple[PipelineModel, list[float]]:
    """Grid search with cross-validation on precomputed folds ``0..k-1``; returns the refit best model and the mean
    metric of every candidate."""
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName=metric)
    folds = [_fold_scores(pipeline, grid, list(range(len(grid))), train, f, label, fold_col, ev, parallelism) for f in range(k)]
    means = [sum(s) / k for s in zip(*folds, strict=True)]
    return pipeline.fit(train, grid[max(range(len(grid)), key=means.__getitem__)]), means


@dataclass
class RaceResult:
    kept: list[int]
    fold_scores: dict[int, list[float]]
    steps: list[tuple[int, int, float, bool]]  # candidate, fold, score, alive after the fold


def trails(leader: list[float], other: list[float], alpha: float = 0.05, margin: float = 0.0) -> bool:
    """Whether the leader beats a candidate by more than ``margin``, by the differences on the same folds: the one-sided
    confidence bound of their mean (Student's t, level ``alpha``) lies above it. Differences that are all equal decide as
    they are."""
    d = [a - b - margin for a, b in zip(leader, other, strict=True)]
    n, mean = len(d), sum(d) / len(d)
    if n < 2 or mean <= 0:
        return False
    error = math.sqrt(sum((x - mean) ** 2 for x in d) / (n - 1) / n)
    return error < 1e-12 or t_two_sided(mean / error, n - 1) / 2 < alpha


def race_folds(score, candidates: int, k: int, burn_in: int = 3, alpha: float = 0.05, margin: float = 0.0, together=None) -> RaceResult:
    """Racing over folds: ``score(candidate, fold)`` is asked for every candidate on the first ``burn_in`` folds, then after
    each fold for those only that do not trail the leader, the best mean of the folds so far (the first of equal ones).
    ``together(candidates, fold)``, if given, is asked instead for all of a fold's scores."""
    alive = list(range(candidates))
    scores: dict[int, list[float]] = {i: [] for i in alive}
    steps = []
    for f in range(k):
        for i, x in zip(alive, together(alive, f) if together else [score(i, f) for i in alive], strict=True):
            scores[i].append(x)
        before = alive
        if f + 1 >= burn_in and len(alive) > 1:
            leader = max(alive, key=lambda i: (sum(scores[i]), -i))
            alive = [i for i in alive if i == leader or not trails(scores[leader], scores[i], alpha, margin)]
        steps += [(i, f, scores[i][-1], i in alive) for i in before]
    return RaceResult(kept=alive, fold_scores=scores, steps=steps)


def race(pipeline: Pipeline, grid: list, train: DataFrame, label: str, fold_col: str = "fold", k: int = 10,
         burn_in: int = 3, alpha: float = 0.05, margin: float = 0.0, metric: str = "areaUnderROC", parallelism: int = 4) -> RaceResult:
    """``race_folds`` over the candidates of a grid: each score is a fit on the other folds and an evaluation on the fold,
    both Spark jobs; only scores reach the driver."""
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName=metric)

    def together(alive: list[int], f: int) -> list[float]:
        return _fold_scores(pipeline, grid, alive, train, f, label, fold_col, ev, parallelism)

    return race_folds(None, len(grid), k, burn_in, alpha, margin, together)


def with_probability(pred: DataFrame, out: str = "prob") -> DataFrame:
    """Probability of class 1 as a plain double column."""
    return pred.withColumn(out, vector_to_array(F.col("probability"))[1])


def importance(model: PipelineModel, names: list[str]) -> list[tuple[str, float]]:
    """Variable importance from the last stage: tree importances or absolute coefficients."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals = last.featureImportances.toArray().tolist()
    elif hasattr(last, "coefficients"):
        vals = [abs(v) for v in last.coefficients.toArray().tolist()]
    else:
        return []
    return list(zip(names, vals))


def upsample(df: DataFrame, label: str, minority: int | str, id_col: str, ratio: float = 1.0, seed: int = 11) -> DataFrame:
    """Plain up-sampling: minority rows drawn with replacement until minority = ``floor(ratio x majority)`` exactly.

    Draw ``t`` takes the row whose position among the minority rows, in hash order of the id, is a hash of ``(t, seed)``
    modulo their number: multinomial multiplicities with an exact total that do not depend on partitions. Draws are counted
    by position before they meet the rows. Without minority rows, or with enough, ``df`` comes back as it is.
    """
    from .scan import positions

    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}  # one row per class
    most = max((v for k, v in counts.items() if k != minority), default=0)
    n = counts.get(minority, 0)
    need = int(ratio * most) - n
    if need <= 0 or not n:
        return df
    rows = df.where(F.col(label) == minority).withColumn("__h", _hash(id_col, seed))
    go = GroupOrder(keys=[], order=["__h", id_col], levels=prefix_levels("__h", HASH_PREFIXES))
    placed = positions(rows, go, "__pos").drop("__h")
    draws = df.sparkSession.range(need).groupBy((F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)) + 1).alias("__pos")).agg(F.count(F.lit(1)).cast("int").alias("__n"))
    extra = placed.join(draws, "__pos").withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    return df.unionByName(extra.select(df.columns))


NEIGHBOUR_BLOCK_ROWS = 2048
#: Cells of the neighbour index at most, and sampled rows a cell that its centres are fitted on (a bounded sample; every
#: row is indexed, and results do not depend on it).
MAX_CELLS, SAMPLE_PER_CELL = 1024, 16
_SLACK = 1e-9
#: Rows x cells that a task of the index holds at a time, so also its visits at most (a row may have to visit every cell).
SLICE_CELLS = 1 << 16


def _distances(a, b):
    """Euclidean distances of the rows of two matrices, by plain differences: the same value in whatever block a pair meets."""
    import numpy as np

    d = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        d += (a[:, i, None] - b[None, :, i]) ** 2
    return np.sqrt(d)


def _slices(batches, cells: int):
    """The rows of the batches in pieces of ``SLICE_CELLS`` distances to the cells: neither the matrices nor what is made of a
    piece grow with the batch."""
    step = max(1, SLICE_CELLS // max(1, cells))
    for b in batches:
        for i in range(0, len(b), step):
            yield b.iloc[i : i + step].reset_index(drop=True)


def _centres(sample, m: int, turns: int = 4):
    """Centres of ``m`` cells by Lloyd's steps from the first ``m`` different rows of the sample."""
    import numpy as np

    _, first = np.unique(sample, axis=0, return_index=True)
    centres = sample[np.sort(first)[:m]]
    for _ in range(turns):
        cell = np.concatenate([_distances(sample[i : i + 1024], centres).argmin(axis=1) for i in range(0, len(sample), 1024)])
        n = np.bincount(cell, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, cell, sample)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def _meet(visits: DataFrame, rows: DataFrame, k: int, exclude_self: bool, carry: list[str], block_rows: int, schema: str) -> DataFrame:
    """The ``k`` closest rows of a cell's block for each left row that visits the cell. Cells are cut into blocks of about
    ``block_rows`` rows and so are their visitors; a task holds one block of each."""
    import numpy as np
    import pandas as pd

    def cut(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(name))

    sizes = cut(visits, "lbs").join(cut(rows, "rbs"), "cell")  # a row a cell
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = visits.join(sizes, "cell").withColumn("lb", F.pmod(F.xxhash64("lid"), F.col("lbs")).cast("int")).withColumn("rb", spread("rbs"))
    right = rows.join(sizes, "cell").withColumn("rb", F.pmod(F.xxhash64("rid"), F.col("rbs")).cast("int")).withColumn("lb", spread("lbs"))

    def block(_key, lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        if lp.empty or rp.empty:
            return pd.DataFrame(columns=["lid", "rid", "dist", *carry])
        rp = rp.sort_values("rid", ignore_index=True)  # among equal distances the smaller id comes first
        d = _distances(np.stack(lp["lv"].to_numpy()), np.stack(rp["rv"].to_numpy()))
        if exclude_self:
            d = np.where(lp["lid"].to_numpy()[:, None] == rp["rid"].to_numpy()[None, :], np.inf, d)
        kk = min(k, d.shape[1])
        idx = np.argsort(d, axis=1, kind="stable")[:, :kk]
        at, cols = np.repeat(np.arange(d.shape[0]), kk), idx.ravel()
        out = pd.DataFrame({"lid": lp["lid"].to_numpy()[at], "rid": rp["rid"].to_numpy()[cols], "dist": d[at, cols]})
        for c in carry:
            out[c] = rp[c].to_numpy()[cols]
        return out[np.isfinite(out["dist"])]

    key = ["cell", "lb", "rb"]
    return left.select(*key, "lid", "lv").groupBy(*key).cogroup(right.select(*key, "rid", "rv", *carry).groupBy(*key)).applyInPandas(block, schema)


def nearest_neighbours(left: DataFrame, right: DataFrame, k: int, features: str = "features", id_col: str = "id",
                       carry: list[str] | None = None, exclude_self: bool = False,
                       block_rows: int = NEIGHBOUR_BLOCK_ROWS, cells: int | None = None, compared: dict | None = None) -> DataFrame:
    """Exact ``k`` nearest ``right`` rows (Euclidean) for every ``left`` row: ``(left_id, right_id, dist, nn_rank,
    *carry)``; equal distances go by id.

    A metric index: every right row lies in the cell of its nearest centre (about the root of the number of rows, at most
    ``MAX_CELLS``), and a cell's radius is its farthest row. A left row first visits its nearest cells, until they hold
    ``k`` rows: its ``k``-th distance there bounds the search. By the triangle inequality a cell can hold a closer row only
    if the distance to its centre, less its radius, is at most that bound; only those cells are visited in the second turn.
    Visits, not pairs, are shuffled; cells and their visitors are cut into blocks, so a cell that holds a third of all rows
    is many tasks. What the driver holds is the centres and one row a cell. ``compared`` gets the number of pairs compared.
    """
    import numpy as np
    import pandas as pd

    carry = carry or []
    kind = {"l": dict(left.dtypes)[id_col], "r": dict(right.dtypes)[id_col]}
    carry_schema = "".join(f", {f.name} {f.dataType.simpleString()}" for f in right.select(*carry).schema.fields)
    schema = f"lid {kind['l']}, rid {kind['r']}, dist double{carry_schema}"
    out_names = {"lid": "left_id", "rid": "right_id"}
    spark = left.sparkSession
    rvec = right.select(F.col(id_col).alias("rid"), vector_to_array(F.col(features)).alias("rv"), *carry)
    n_right = rvec.count()
    if not n_right:
        return spark.createDataFrame([], schema + ", nn_rank int").withColumnsRenamed(out_names)
    m = min(cells or max(1, math.isqrt(n_right)), MAX_CELLS)
    sample = rvec.orderBy(F.xxhash64("rid"), "rid").select("rv").limit(m * SAMPLE_PER_CELL).collect()
    centres = _centres(np.array([r.rv for r in sample], float), m)

    def assigned(batches):
        for b in _slices(batches, len(centres)):
            d = _distances(np.stack(b["rv"].to_numpy()), centres)
            b["cell"] = d.argmin(axis=1)
            b["far"] = d.min(axis=1)
            yield b

    rows = materialize_scratch(rvec.mapInPandas(assigned, f"rid {kind['r']}, rv array<double>{carry_schema}, cell long, far double"), "cells")
    held = rows.groupBy("cell").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n")).orderBy("cell").collect()  # a row a cell
    cell, radius, size = (np.array([r[c] for r in held]) for c in ("cell", "radius", "n"))
    own = centres[cell]
    wanted = k + int(exclude_self)

    def near(lv):
        """Distances to the centres, and which cells the first turn visits."""
        d = _distances(lv, own)
        order = np.argsort(d, axis=1, kind="stable")
        before = np.cumsum(size[order], axis=1) - size[order]
        first = np.zeros(d.shape, bool)
        np.put_along_axis(first, order, before < wanted, axis=1)
        return d, first

    def visiting(b, chosen):
        at, which = np.nonzero(chosen)
        return pd.DataFrame({"lid": b["lid"].to_numpy()[at], "lv": b["lv"].to_numpy()[at], "cell": cell[which]})

    def first_turn(batches):
        for b in _slices(batches, len(own)):
            yield visiting(b, near(np.stack(b["lv"].to_numpy()))[1])

    def second_turn(batches):
        for b in _slices(batches, len(own)):
            d, first = near(np.stack(b["lv"].to_numpy()))
            bound = b["bound"].to_numpy()[:, None]
            yield visiting(b, ~first & (d - radius[None, :] <= bound + _SLACK * (1 + bound)))

    visit = f"lid {kind['l']}, lv array<double>, cell long"
    lvec = materialize_scratch(left.select(F.col(id_col).alias("lid"), vector_to_array(F.col(features)).alias("lv")), "left")
    by = Window.partitionBy("lid").orderBy("dist", "rid")
    best = lambda found: found.withColumn("nn_rank", F.row_number().over(by)).where(F.col("nn_rank") <= k)
    turn1 = materialize_scratch(lvec.mapInPandas(first_turn, visit), "visits")
    found = materialize_scratch(best(_meet(turn1, rows, k, exclude_self, carry, block_rows, schema)).drop("nn_rank"), "first-neighbours")
    bound = found.groupBy("lid").agg(F.when(F.count(F.lit(1)) >= k, F.max("dist")).otherwise(F.lit(float("inf"))).alias("bound"))
    bounded = lvec.join(bound, "lid", "left").fillna(float("inf"), "bound")
    turn2 = materialize_scratch(bounded.mapInPandas(second_turn, visit), "visits")
    if compared is not None:
        per = spark.createDataFrame([(int(c), int(n)) for c, n in zip(cell, size)], "cell long, n long")
        compared["pairs"] = turn1.unionByName(turn2).join(F.broadcast(per), "cell").agg(F.sum("n")).first()[0]
        compared["all"] = n_right * lvec.count()
    more = _meet(turn2, rows, k, exclude_self, carry, block_rows, schema)
    return best(found.unionByName(more)).withColumnsRenamed(out_names)


def smote(df: DataFrame, label: str, minority, features: str = "features", id_col: str = "id", ratio: float = 0.9,
          k: int = 5, seed: int = 13) -> DataFrame:
    """SMOTE: synthetic minority rows on the segment between a minority row and one of its ``k`` nearest minority
    neighbours (exact search), until minority = ``floor(ratio x majority)`` exactly. Each minority row seeds
    ``floor(need / n)`` synthetic rows, cycling through its neighbours, and the first rows by a hash of the id seed one
    more. The place on the segment is one draw for each synthetic row, a hash of the two ids and the turn, so it does not
    depend on partitions."""
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}  # one row per class
    maj = max((v for kk, v in counts.items() if kk != minority), default=0)
    n_min = counts.get(minority, 0)
    need = int(ratio * maj) - n_min
    base = df.select(F.col(id_col).cast("string").alias(id_col), features, label).withColumn("synthetic", F.lit(0))
    if need <= 0 or n_min < 2:
        return base
    mino = df.where(F.col(label) == minority).select(id_col, features)
    nn = nearest_neighbours(mino, mino, k, features, id_col, exclude_self=True)
    each, rest = divmod(need, n_min)
    first = mino.orderBy(F.xxhash64(id_col, F.lit(seed)), id_col).limit(rest).select(F.col(id_col).alias("left_id"), F.lit(1).alias("__extra"))
    n_nb = nn.groupBy("left_id").agg(F.max("nn_rank").alias("__m")).join(first, "left_id", "left")
    turns = F.lit(each) + F.coalesce("__extra", F.lit(0))
    seeds = nn.join(n_nb, "left_id").where(turns > 0).withColumn("__j", F.explode(F.sequence(F.lit(0), turns - 1)))
    seeds = seeds.where(((F.col("__j") % F.col("__m")) + 1) == F.col("nn_rank"))
    a = mino.select(F.col(id_col).alias("left_id"), vector_to_array(F.col(features)).alias("a"))
    b = mino.select(F.col(id_col).alias("right_id"), vector_to_array(F.col(features)).alias("b"))
    gen = seeds.join(a, "left_id").join(b, "right_id")
    gen = gen.withColumn("gap", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "left_id", "right_id", "__j"), 11) / F.lit(float(1 << 53)))
    synth = gen.select(
        F.concat_ws("~", F.col("left_id").cast("string"), F.col("right_id").cast("string"), F.col("__j").cast("string")).alias(id_col),
        array_to_vector(F.zip_with("a", "b", lambda x, y: x + (y - x) * F.col("gap"))).alias(features),
    ).withColumn(label, F.lit(minority)).withColumn("synthetic", F.lit(1))
    return base.unionByName(synth.select(id_col, features, label, "synthetic"))


def knn_predict(train: DataFrame, test: DataFrame, label: str, features: str = "features", id_col: str = "id", k: int = 5) -> DataFrame:
    """k-nearest-neighbour vote with an exact neighbour search: majority label among the ``k`` closest training
    rows (ties broken by the smaller mean distance, then the smaller label)."""
    nn = nearest_neighbours(test, train, k, features, id_col, carry=[label])
    votes = nn.groupBy("left_id", label).agg(F.count(F.lit(1)).alias("votes"), F.avg("dist").alias("mean_d"))
    w2 = Window.partitionBy("left_id").orderBy(F.col("votes").desc(), F.col("mean_d").asc(), F.col(label).asc())
    best = votes.withColumn("__r", F.row_number().over(w2)).where(F.col("__r") == 1)
    return best.select(F.col("left_id").alias(id_col), F.col(label).alias("pred"), "votes")


def regression_evaluate(pred: DataFrame, label: str) -> dict[str, float]:
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction")
    return {m: ev.setMetricName(m).evaluate(pred) for m in ("rmse", "mae", "r2")}
