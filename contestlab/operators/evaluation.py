"""Evaluation of binary picks, probabilities and margin predictions, as plain aggregates over a prediction table.

Global statistics (ROC, AUC) need a rank over the whole table. They use the bucketed scan with an empty group key:
rows are bucketed by the score, each bucket is ranked in its own task and only the bucket totals (a bounded table)
are scanned in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import round_half_up, safe_div
from .scan import GroupOrder, numeric_levels, scan

SCORE_WIDTHS = (1e-4, 1e-2, 1.0)  # bucket levels over the score


def confusion(df: DataFrame, pred: str = "pred", truth: str = "truth") -> DataFrame:
    """Confusion cells with their share of all rows and a good/bad flag (prediction equals truth)."""
    cells = df.groupBy(pred, truth).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # at most four rows here
    return cells.select(
        F.col(pred).alias("pred"), F.col(truth).alias("truth"), "n",
        round_half_up(F.col("n") / total, 6).alias("share"),
        F.when(F.col(pred) == F.col(truth), "good").otherwise("bad").alias("outcome"),
    )


def _counts(df: DataFrame, pred: str, truth: str) -> DataFrame:
    p, t = F.col(pred), F.col(truth)
    return df.agg(
        F.sum(F.when((p == 1) & (t == 1), 1).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when((p == 1) & (t == 0), 1).otherwise(0)).cast("bigint").alias("fp"),
        F.sum(F.when((p == 0) & (t == 1), 1).otherwise(0)).cast("bigint").alias("fn"),
        F.sum(F.when((p == 0) & (t == 0), 1).otherwise(0)).cast("bigint").alias("tn"),
    )


def class_metrics(df: DataFrame, pred: str = "pred", truth: str = "truth", digits: int = 6) -> DataFrame:
    """Accuracy, misclassification, kappa, sensitivity (recall), specificity, precision, negative predictive value
    and Youden's J, with the standard definitions (event class = 1)."""
    c = _counts(df, pred, truth)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    acc = safe_div(tp + tn, n)
    pe = safe_div((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    sens = safe_div(tp, tp + fn)
    spec = safe_div(tn, tn + fp)
    return c.select(
        "tp", "fp", "fn", "tn",
        (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n"),
        round_half_up(acc, digits).alias("accuracy"),
        round_half_up(1 - acc, digits).alias("misclassification"),
        round_half_up(safe_div(acc - pe, 1 - pe), digits).alias("kappa"),
        round_half_up(sens, digits).alias("sensitivity"),
        round_half_up(spec, digits).alias("specificity"),
        round_half_up(safe_div(tp, tp + fp), digits).alias("precision"),
        round_half_up(safe_div(tn, tn + fn), digits).alias("npv"),
        round_half_up(sens + spec - 1, digits).alias("j_index"),
    )


def log_loss(df: DataFrame, prob: str = "prob", truth: str = "truth", eps: float = 1e-15, digits: int = 6) -> DataFrame:
    """Mean negative log-likelihood of the event probability, clipped to ``[eps, 1 - eps]``."""
    p = F.least(F.greatest(F.col(prob), F.lit(eps)), F.lit(1 - eps))
    ll = F.when(F.col(truth) == 1, -F.log(p)).otherwise(-F.log(1 - p))
    return df.agg(F.count(F.lit(1)).alias("n"), round_half_up(F.avg(ll), digits).alias("log_loss"))


def _score_table(df: DataFrame, prob: str, truth: str) -> DataFrame:
    """Positives and negatives per distinct score (pre-aggregated before any ordering)."""
    return df.groupBy(F.col(prob).alias("score")).agg(
        F.sum(F.when(F.col(truth) == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col(truth) == 0, 1).otherwise(0)).cast("bigint").alias("neg"),
    )


def roc_points(df: DataFrame, prob: str = "prob", truth: str = "truth", digits: int = 6) -> DataFrame:
    """ROC curve: for each distinct score used as threshold (predict 1 when score >= threshold), TPR and FPR."""
    st = _score_table(df, prob, truth).withColumn("__neg_score", -F.col("score"))
    go = GroupOrder(keys=[], order=["__neg_score"], levels=numeric_levels("__neg_score", SCORE_WIDTHS))
    cum = scan(st, go, sums={"tp": F.col("pos"), "fp": F.col("neg")})
    totals = st.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).withColumn("__k", F.lit(1))
    cum = cum.withColumn("__k", F.lit(1)).join(F.broadcast(totals), "__k").drop("__k")  # one-row table
    return cum.select(
        F.col("score").alias("threshold"),
        F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
        round_half_up(safe_div(F.col("tp"), F.col("P")), digits).alias("tpr"),
        round_half_up(safe_div(F.col("fp"), F.col("N")), digits).alias("fpr"),
    )


def roc_points_by(df: DataFrame, fold: str, prob: str = "prob", truth: str = "truth", digits: int = 6) -> DataFrame:
    """ROC curves of every fold and of all rows (``curve`` = ``all``), in one scan with the curve as its group: rows
    ``curve, threshold, tp, fp, tpr, fpr``. A row counts for its fold and for ``all``; scores are pre-aggregated first."""
    both = df.select(F.explode(F.array(F.col(fold).cast("string"), F.lit("all"))).alias("curve"), F.col(prob).alias("score"), F.col(truth).alias("t"))
    st = both.groupBy("curve", "score").agg(
        F.sum(F.when(F.col("t") == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col("t") == 0, 1).otherwise(0)).cast("bigint").alias("neg"),
    ).withColumn("__neg_score", -F.col("score"))
    go = GroupOrder(keys=["curve"], order=["__neg_score"], levels=numeric_levels("__neg_score", SCORE_WIDTHS))
    cum = scan(st, go, sums={"tp": F.col("pos"), "fp": F.col("neg")})
    totals = st.groupBy(F.col("curve").alias("__curve")).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return cum.join(totals, F.col("curve").eqNullSafe(F.col("__curve"))).select(
        "curve", F.col("score").alias("threshold"),
        F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
        round_half_up(safe_div(F.col("tp"), F.col("P")), digits).alias("tpr"),
        round_half_up(safe_div(F.col("fp"), F.col("N")), digits).alias("fpr"),
    )


def roc_auc(df: DataFrame, prob: str = "prob", truth: str = "truth", digits: int = 6) -> DataFrame:
    """Area under the ROC curve as the Mann-Whitney statistic: P(score of a positive > score of a negative) plus
    half the probability of a tie."""
    st = _score_table(df, prob, truth)
    go = GroupOrder(keys=[], order=["score"], levels=numeric_levels("score", SCORE_WIDTHS))
    cum = scan(st, go, sums={"neg_upto": F.col("neg")})
    contrib = cum.select(
        (F.col("pos").cast("double") * (F.col("neg_upto") - F.col("neg"))).alias("below"),
        (F.col("pos").cast("double") * F.col("neg")).alias("ties"),
        "pos", "neg",
    )
    agg = contrib.agg(F.sum("below").alias("below"), F.sum("ties").alias("ties"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return agg.select(
        F.col("P").cast("bigint").alias("positives"), F.col("N").cast("bigint").alias("negatives"),
        round_half_up(safe_div(F.col("below") + F.col("ties") / 2.0, F.col("P").cast("double") * F.col("N")), digits).alias("roc_auc"),
    )


def regression_metrics(df: DataFrame, pred: str = "pred", actual: str = "actual", digits: int = 6) -> DataFrame:
    """RMSE, MAE and R-squared (squared correlation of prediction and actual)."""
    d = F.col(pred) - F.col(actual)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        round_half_up(F.sqrt(F.avg(d * d)), digits).alias("rmse"),
        round_half_up(F.avg(F.abs(d)), digits).alias("mae"),
        round_half_up(F.pow(F.corr(pred, actual), 2), digits).alias("rsq"),
    )


def outcome_cells(df: DataFrame, by: list[str], pred: str = "pred", truth: str = "truth") -> DataFrame:
    """Per group: TP, FP, FN, TN counts of a pick against the truth and the accuracy (TP + TN) / all."""
    p, t = F.col(pred), F.col(truth)
    g = df.groupBy(*by).agg(
        F.sum(F.when((p == 1) & (t == 1), 1).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when((p == 1) & (t == 0), 1).otherwise(0)).cast("bigint").alias("fp"),
        F.sum(F.when((p == 0) & (t == 1), 1).otherwise(0)).cast("bigint").alias("fn"),
        F.sum(F.when((p == 0) & (t == 0), 1).otherwise(0)).cast("bigint").alias("tn"),
    )
    return g.withColumn("accuracy", round_half_up((F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")), 6))


def pick_accuracy(df: DataFrame, by: list[str], picks: dict[str, str], truth: str = "truth") -> DataFrame:
    """Correct picks and accuracy per group for several predictors (``{name: pick column}``)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for name, col in picks.items():
        aggs.append(F.sum(F.when(F.col(col) == F.col(truth), 1).otherwise(0)).cast("bigint").alias(f"{name}_correct"))
    g = df.groupBy(*by).agg(*aggs)
    return g.withColumns({f"{name}_acc": round_half_up(F.col(f"{name}_correct") / F.col("n"), 6) for name in picks})


def correct_long(df: DataFrame, by: list[str], picks: dict[str, str], truth: str = "truth") -> DataFrame:
    """Correct picks per group and predictor in long form (``predictor``, ``correct``)."""
    wide = pick_accuracy(df, by, picks, truth).select(*by, *[F.col(f"{n}_correct").alias(n) for n in picks])
    return wide.unpivot(by, list(picks), "predictor", "correct")


def disagreements(df: DataFrame, model: str, favourite: str, truth: str = "truth") -> DataFrame:
    """Rows where exactly one of two pickers was right, labelled ``model_right`` or ``favourite_right``."""
    m_ok = F.col(model) == F.col(truth)
    f_ok = F.col(favourite) == F.col(truth)
    return df.where(m_ok != f_ok).withColumn("who", F.when(m_ok, "model_right").otherwise("favourite_right"))


def closer_to_margin(df: DataFrame, by: list[str], line_pred: str, model_pred: str, actual: str, digits: int = 4) -> DataFrame:
    """Which of two margin predictions is closer to the true margin, per row, and the share per group."""
    le = F.abs(F.col(actual) - F.col(line_pred))
    me = F.abs(F.col(actual) - F.col(model_pred))
    rows = df.withColumns({
        "line_error": round_half_up(le, digits),
        "model_error": round_half_up(me, digits),
    }).withColumn(
        "closer", F.when(F.col("model_error") < F.col("line_error"), "model").when(F.col("model_error") > F.col("line_error"), "line").otherwise("tie")
    )
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("closer") == "model", 1).otherwise(0)).cast("bigint").alias("model_closer"),
        F.sum(F.when(F.col("closer") == "line", 1).otherwise(0)).cast("bigint").alias("line_closer"),
        # errors are rounded to ``digits`` places, so they are summed as exact integers in those units
        round_half_up(F.sum(F.round(F.col("line_error") * 10 ** digits).cast("bigint")) / F.count(F.lit(1)) / float(10 ** digits), digits).alias("mean_line_error"),
        round_half_up(F.sum(F.round(F.col("model_error") * 10 ** digits).cast("bigint")) / F.count(F.lit(1)) / float(10 ** digits), digits).alias("mean_model_error"),
    ).withColumn("model_closer_share", round_half_up(F.col("model_closer") / F.col("n"), 6))


def favourite_label(line: str = "line", home_away: str = "home_away"):
    """``favourite`` / ``underdog`` / ``even`` for a side, from the line (positive = home favoured)."""
    ln = F.col(line)
    is_home = F.col(home_away) == "home"
    return (
        F.when(ln == 0, "even")
        .when((is_home & (ln > 0)) | (~is_home & (ln < 0)), "favourite")
        .otherwise("underdog")
    )


def metric_table(df: DataFrame, by: list[str], truth: str = "truth", pred: str = "pred", prob: str = "prob", score: str = "score",
                 eps: float = 1e-15, digits: int = 6) -> DataFrame:
    """All class metrics of every group of a scoring table, long: rows ``(*by, metric, value)`` with accuracy, kappa, log loss,
    ROC AUC, sensitivity, specificity, precision and Youden's J. A metric that a group has no value for (log loss without
    probabilities, AUC of one class) is NULL. One aggregation for the counts; the AUC ranks distinct scores of all groups in
    one scan, so neither a large group nor many groups meet in one task."""
    p, t = F.col(pred), F.col(truth)
    clipped = F.least(F.greatest(F.col(prob), F.lit(eps)), F.lit(1 - eps))
    loss = F.when(F.col(prob).isNotNull(), F.when(t == 1, -F.log(clipped)).otherwise(-F.log(1 - clipped)))

    def cell(a: int, b: int) -> Column:
        return F.sum(F.when((p == a) & (t == b), 1.0).otherwise(0.0))

    cells = df.groupBy(*by).agg(cell(1, 1).alias("tp"), cell(1, 0).alias("fp"), cell(0, 1).alias("fn"), cell(0, 0).alias("tn"), F.avg(loss).alias("log_loss"))
    group = F.struct(*by).alias("__g")
    st = df.where(F.col(score).isNotNull()).groupBy(group, F.col(score).alias("score")).agg(
        F.sum(F.when(t == 1, 1).otherwise(0)).cast("bigint").alias("pos"), F.sum(F.when(t == 0, 1).otherwise(0)).cast("bigint").alias("neg"))
    cum = scan(st, GroupOrder(keys=["__g"], order=["score"], levels=numeric_levels("score", SCORE_WIDTHS)), sums={"upto": F.col("neg")})
    below = F.col("pos").cast("double") * (F.col("upto") - F.col("neg") / 2.0)
    area = cum.groupBy("__g").agg(safe_div(F.sum(below), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    acc, sens, spec = safe_div(tp + tn, n), safe_div(tp, tp + fn), safe_div(tn, tn + fp)
    chance = safe_div((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    values = {
        "accuracy": acc, "kappa": safe_div(acc - chance, 1 - chance), "log_loss": F.col("log_loss"), "roc_auc": F.col("roc_auc"),
        "sensitivity": sens, "specificity": spec, "precision": safe_div(tp, tp + fp), "j_index": sens + spec - 1,
    }
    rows = F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), round_half_up(v, digits).alias("value")) for m, v in values.items()]))
    return cells.withColumn("__g", group).join(area, "__g", "left").select(*by, rows)
