"""Space-filling designs, scored folds, metric tables, bagging, bins and the coming week."""

import math
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F
from testdata_paths import SF_SMALL

from contestlab.operators import evaluation, ml, ratings
from contestlab.operators.tuning import Span, bagged_prediction, bagged_trees, latin_hypercube, poisson_weight, ranking, score_folds, workflow_set
from contestlab.plans import features, workflows
from contestlab.sources import prepared


def test_latin_hypercube_fills_every_range():
    space = {"a": Span(0.0, 1.0), "b": Span(1e-4, 1.0, "log"), "c": Span(1, 40, "int")}
    design = latin_hypercube(space, 20, seed=1)
    assert design == latin_hypercube(space, 20, seed=1) != latin_hypercube(space, 20, seed=2)
    assert sorted(int(p["a"] * 20) for p in design) == list(range(20))
    assert sorted(int((math.log(p["b"]) - math.log(1e-4)) / -math.log(1e-4) * 20) for p in design) == list(range(20))
    assert sorted((p["c"] - 1) // 2 for p in design) == list(range(20))
    assert latin_hypercube({}, 3) == [{}, {}, {}]


def brute_metrics(rows):
    tp, fp, fn, tn = (sum(p == a and t == b for t, p, _, _ in rows) for a, b in ((1, 1), (1, 0), (0, 1), (0, 0)))
    n, acc = len(rows), (tp + tn) / len(rows)
    chance = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / n / n
    pairs = [(x, y) for t, _, _, x in rows if t == 1 for u, _, _, y in rows if u == 0]
    probs = [(t, q) for t, _, q, _ in rows if q is not None]
    div = lambda a, b: a / b if b else None
    sens, spec = div(tp, tp + fn), div(tn, tn + fp)
    return {
        "accuracy": acc, "kappa": div(acc - chance, 1 - chance), "sensitivity": sens, "specificity": spec, "precision": div(tp, tp + fp),
        "j_index": None if sens is None or spec is None else sens + spec - 1,
        "roc_auc": div(sum((x > y) + 0.5 * (x == y) for x, y in pairs), len(pairs)),
        "log_loss": div(sum(-math.log(q if t else 1 - q) for t, q in probs), len(probs)),
    }


def test_metric_table_equals_brute_force(spark):
    r = random.Random(5)
    data = []
    for g in ("p", "q"):
        for c in range(2):
            for _ in range(60):
                q = r.randrange(1, 20) / 20
                data.append((g, c, r.randrange(2), int(q >= 0.5), q if g == "p" else None, q * 8 - 4))
    data += [("one", 0, 1, 1, 0.75, 0.75)] * 3  # a single class
    df = spark.createDataFrame(data, "g string, c int, truth long, pred long, prob double, score double").repartition(5)
    got = {(x.g, x.c, x.metric): x.value for x in evaluation.metric_table(df, ["g", "c"]).collect()}
    for g, c in {(d[0], d[1]) for d in data}:
        want = brute_metrics([d[2:] for d in data if d[:2] == (g, c)])
        for m, v in want.items():
            assert got.pop((g, c, m)) == (None if v is None else pytest.approx(v, abs=2e-6)), (g, c, m)
    assert not got


def test_scored_folds_equal_single_fits(spark):
    r = random.Random(2)
    rows = [(i, i % 4, float(x := r.gauss(0, 1)), float(r.gauss(0, 1)), float(x + r.gauss(0, 1) > 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, fold int, a double, b double, label double")
    recipe = [VectorAssembler(inputCols=["a", "b"], outputCol="features")]
    flows = workflow_set({"r": recipe}, {
        "lr": (LogisticRegression(labelCol="label"), {"regParam": Span(1e-3, 10.0, "log")}), "svm": (LinearSVC(labelCol="label", maxIter=5), {"regParam": Span(1e-3, 1.0, "log")}),
    }, n=3)
    scored = score_folds(spark, flows, df, "id", "label", k=4)
    assert scored.count() == 2 * 3 * 400
    assert scored.groupBy("workflow", "candidate", "id").count().where("count <> 1").count() == 0
    reg = flows["r__lr"].candidates[1]["regParam"]
    model = Pipeline(stages=[*recipe, LogisticRegression(labelCol="label", regParam=reg)]).fit(df.where("fold <> 2"))
    want = {x.id: x.probability[1] for x in model.transform(df.where("fold = 2")).collect()}
    got = {x.id: x.prob for x in scored.where("workflow = 'r__lr' and candidate = 1 and fold = 2").collect()}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-6) for i in want)
    assert scored.where("workflow = 'r__svm' and (prob is not null or score is null)").count() == 0

    table = evaluation.metric_table(scored, ["workflow", "candidate", "fold"])
    ranks = ranking(spark, flows, table).orderBy("rank").collect()
    assert [x["rank"] for x in ranks] == list(range(1, 7)) and all(x.n_folds == 4 for x in ranks)
    assert [x["mean"] for x in ranks] == sorted((x["mean"] for x in ranks), reverse=True)
    assert sorted(x.workflow_rank for x in ranks if x.workflow == "r__lr") == [1, 2, 3]


def test_bagging_draws_and_average(spark):
    df = spark.range(20_000).withColumn("w", poisson_weight("id", 3))
    share = {x.w: x["count"] / 20_000 for x in df.groupBy("w").count().collect()}
    for times in range(4):
        assert share[float(times)] == pytest.approx(math.exp(-1) / math.factorial(times), abs=0.015)
    r = random.Random(9)
    rows = spark.createDataFrame([(i, x := r.random(), 3 * x + r.gauss(0, 1)) for i in range(800)], "id long, x double, label double")
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    models_ = bagged_trees(rows, DecisionTreeRegressor(labelCol="label", maxDepth=4), "id", bags=5)
    out = bagged_prediction(models_, rows)
    assert out.columns == [*rows.columns, "prediction"]
    each = [m.transform(rows).select("id", F.col(m.getPredictionCol()).alias("p")).collect() for m in models_]
    want = {i: sum(dict(map(tuple, e))[i] for e in each) / 5 for i in (0, 17, 401)}
    got = {x.id: x.prediction for x in out.collect()}
    assert all(got[i] == pytest.approx(want[i]) for i in want)
    assert len({tuple(x.p for x in e[:50]) for e in each}) == 5  # the bags differ


def test_bins_keep_equal_values_together(spark):
    values = [1] * 50 + [2] * 10 + list(range(3, 43))
    got = workflows.value_bins(spark.createDataFrame([(v,) for v in values], "v long"), "v").collect()
    for x in got:
        assert x.bin == sum(v < x.v for v in values) * 4 // len(values)


@pytest.mark.parametrize("model", ["linear", "bagged", "forest", "gbt"])
def test_margin_models_beat_the_mean(spark, model):
    r = random.Random(4)
    cols = workflows.SPREAD_NUMERIC
    rows = []
    for i in range(400):
        x = [r.gauss(0, 1) for _ in cols]
        rows.append((i, 1995, int(10 * x[0] + r.gauss(0, 5)), r.choice(["short", "normal", "long"]), r.choice(["short", "long"]), "train" if i % 4 else "test", *x))
    df = spark.createDataFrame(rows, "contest_id long, season long, spread long, rest string, opp_rest string, split string, " + ", ".join(f"{c} double" for c in cols))
    out = workflows.fit_spread(df, model, bags=8)
    m = evaluation.regression_metrics(out, actual="truth").first()
    assert m.n == 100
    assert m.rmse < 11 * 0.9 and m.rsq > 0.3  # the margins' own deviation is about 11


def test_coming_week_equals_the_table_where_it_is_a_teams_first_contest(spark):
    k, p = prepared.contests(spark, SF_SMALL), prepared.plays(spark, SF_SMALL)
    elo = ratings.period_ratings(k)
    table = features.pregame_features(k, p, elo)
    first = k.select("season", "week", F.explode(F.array("home_team", "away_team")).alias("t"), F.struct("gameday", "contest_id").alias("o"))
    first = first.groupBy("season", "week", "t").agg(F.min("o.contest_id").alias("id"), F.min_by("o.contest_id", "o").alias("first"))
    got = workflows.coming_week(k, features.side_table(k, p, elo), 1995, 30)
    assert got.columns == [c for c in table.columns if c != "win"]
    f = first.where("season = 1995 and week = 30").select("t", "first")
    both = got.join(f.select(F.col("t").alias("team"), F.col("first").alias("contest_id")), ["team", "contest_id"], "left_semi")
    both = both.join(f.select(F.col("t").alias("opponent"), F.col("first").alias("contest_id")), ["opponent", "contest_id"], "left_semi").select(*got.columns)
    rows = both.collect()
    assert rows
    want = {x.contest_id: x for x in table.where("season = 1995 and week = 30").select(*got.columns).collect()}
    assert rows == [want[x.contest_id] for x in rows]


def test_stored_pipelines_name_the_columns_that_rows_lack(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0), (2.0, 1.0, 1.0)] * 5, "a double, b double, label double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), VectorAssembler(inputCols=["features"], outputCol="f2")]).fit(df)
    workflows.require_inputs(model, df)
    with pytest.raises(ValueError, match="a, b"):
        workflows.require_inputs(model, df.select(F.col("a").cast("string").alias("a"), "label"))


def test_a_folds_candidates_share_the_fitted_recipe(spark, monkeypatch):
    """The stages before the model are fitted once a fold, and scores equal those of whole pipelines."""
    r = random.Random(5)
    rows = [(i, i % 3, float(x := r.gauss(0, 1)), float(x + r.gauss(0, 1) > 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, fold int, a double, label double")
    est = LogisticRegression(labelCol="label")
    pipe = ml.workflow(ml.preprocess_stages(["a"]), est)
    grid = [{est.regParam: x} for x in (0.0, 0.1, 5.0)]
    fitted = []
    fit = Pipeline._fit
    monkeypatch.setattr(Pipeline, "_fit", lambda self, rows: fitted.append(len(self.getStages())) or fit(self, rows))
    best, means = ml.tune(pipe, grid, df, "label", k=3)
    whole = len(pipe.getStages())
    assert fitted == [whole - 1] * 3 + [whole] and best.stages[-1].getRegParam() == grid[max(range(3), key=means.__getitem__)][est.regParam]
    fitted.clear()
    steps = ml.race(pipe, grid, df, "label", k=3).steps
    assert fitted == [whole - 1] * 3 and len(steps) == 9
    ev = BinaryClassificationEvaluator(labelCol="label")
    want = {(i, f): ev.evaluate(pipe.fit(df.where(f"fold <> {f}"), g).transform(df.where(f"fold = {f}"))) for i, g in enumerate(grid) for f in range(3)}
    assert all(x == pytest.approx(want[i, f]) for i, f, x, _ in steps)
    assert means == [pytest.approx(sum(want[i, f] for f in range(3)) / 3) for i in range(3)]
