"""Summary statistics: group means, top/bottom-k, correlations, five numbers, histograms, shares."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import round_half_up


def best_and_worst(df: DataFrame, by: list[str], value: str, name: str, n: int = 20, digits: int | None = 4) -> DataFrame:
    """Group mean of ``value`` and the ``n`` highest and ``n`` lowest groups (``side`` = best / worst).

    The group means are pre-aggregated (partial + final hash aggregate); each top-n is a TakeOrderedAndProject that
    keeps ``n`` rows per partition, so nothing unbounded reaches one task.
    """
    m = df.groupBy(*by).agg(F.avg(value).alias(name))
    if digits is not None:
        m = m.withColumn(name, round_half_up(F.col(name), digits))
    best = m.orderBy(F.col(name).desc(), *by).limit(n).select(F.lit("best").alias("side"), *by, name)
    worst = m.orderBy(F.col(name).asc(), *by).limit(n).select(F.lit("worst").alias("side"), *by, name)
    return best.unionByName(worst)


def corr_long(df: DataFrame, cols: list[str], digits: int = 4, pairwise: bool = True) -> DataFrame:
    """Correlation matrix in long form ``(var1, var2, value)``.

    All pairs come out of one aggregate (each ``corr`` is a partial/final combinable statistic), then the single row
    is unpivoted. ``pairwise=True`` uses every row where both values are present (Spark's ``corr`` skips a pair with a
    NULL); ``pairwise=False`` first keeps complete rows only.
    """
    src = df if pairwise else df.na.drop(subset=cols)
    aggs = []
    names = []
    for a in cols:
        for b in cols:
            name = f"{a}__{b}"
            names.append(name)
            aggs.append((F.lit(1.0) if a == b else F.corr(a, b)).alias(name))
    one = src.agg(*aggs)
    long = one.unpivot([], names, "pair", "value")
    return long.select(
        F.split_part("pair", F.lit("__"), F.lit(1)).alias("var1"),
        F.split_part("pair", F.lit("__"), F.lit(2)).alias("var2"),
        round_half_up(F.col("value"), digits).alias("value"),
    )


def corr_with_target(df: DataFrame, cols: list[str], target: str, digits: int = 4) -> DataFrame:
    """Absolute correlation of each column with a target (feature screen), one row per column."""
    one = df.agg(*[F.corr(c, target).alias(c) for c in cols])
    long = one.unpivot([], cols, "variable", "corr")
    return long.select("variable", round_half_up(F.col("corr"), digits).alias("corr"), round_half_up(F.abs("corr"), digits).alias("abs_corr"))


def histogram(df: DataFrame, col: str, width: float, by: list[str] | None = None) -> DataFrame:
    """Counts per bin ``[k * width, (k + 1) * width)`` (map-side partial counts, then a small final aggregate)."""
    b = (F.floor(F.col(col) / F.lit(width)) * F.lit(width)).alias("bin_start")
    return df.groupBy(*(by or []), b).agg(F.count(F.lit(1)).alias("n"))


def class_share(df: DataFrame, col: str, digits: int = 4) -> DataFrame:
    """Count per value and its share of all rows. The per-value counts are a small table; the total is one more
    aggregate over it (no unpartitioned window over the raw rows)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("__total")).withColumn("__k", F.lit(1))
    out = counts.withColumn("__k", F.lit(1)).join(F.broadcast(total), "__k").drop("__k")
    return out.select(col, "n", round_half_up(F.col("n") / F.col("__total"), digits).alias("share"))


def nested_mean(df: DataFrame, inner: list[str], outer: list[str], value: str, name: str, digits: int = 4) -> DataFrame:
    """Sum ``value`` per ``inner`` group, then average those sums per ``outer`` group (e.g. season wins per team,
    then mean wins per season for each team)."""
    s = df.groupBy(*inner).agg(F.sum(value).alias("__s"))
    return s.groupBy(*outer).agg(round_half_up(F.avg("__s"), digits).alias(name), F.count(F.lit(1)).alias("groups"))


def quantiles(df: DataFrame, by: list[str], value: str, tiebreak: list[str], probs=(0.0, 0.25, 0.5, 0.75, 1.0),
              digits: int = 4) -> DataFrame:
    """Exact quantiles per group (linear interpolation between order statistics, R's default type 7).

    Rows are ranked by a bucketed scan (no group is gathered into one task or one buffer), the two order statistics
    around each ``h = (n - 1) p`` are picked by position and interpolated.
    """
    from .scan import GroupOrder, numeric_levels, positions

    base = df.where(F.col(value).isNotNull()).select(*by, value, *tiebreak)
    go = GroupOrder(keys=by, order=[value, *tiebreak], levels=numeric_levels(value, (1.0, 64.0, 4096.0), then_id=tiebreak[0]))
    ranked = positions(base, go, "__pos")
    sizes = base.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    wanted = []
    for i, p in enumerate(probs):
        wanted.append(F.struct(F.lit(i).alias("qi"), F.lit(float(p)).alias("p")))
    targets = sizes.select(*by, "__n", F.inline(F.array(*wanted)))
    targets = targets.withColumns({
        "__h": (F.col("__n") - 1) * F.col("p"),
    }).withColumns({
        "__lo": F.floor("__h").cast("bigint") + 1,
        "__frac": F.col("__h") - F.floor("__h"),
    }).withColumn("__hi", F.least(F.col("__lo") + 1, F.col("__n")))
    lo = targets.join(ranked.select(*by, F.col("__pos").alias("__lo"), F.col(value).alias("__xlo")), [*by, "__lo"])
    both = lo.join(ranked.select(*by, F.col("__pos").alias("__hi"), F.col(value).alias("__xhi")), [*by, "__hi"])
    q = F.col("__xlo") + F.col("__frac") * (F.col("__xhi") - F.col("__xlo"))
    return both.select(*by, F.col("p").alias("prob"), round_half_up(q, digits).alias("value"))


def favourite_win_rates(contests: DataFrame, digits: int = 4) -> DataFrame:
    """Per season: home win %, favourite win % overall and when the favourite plays at home or away.

    A positive line favours the home side; a zero line has no favourite.
    """
    ln = F.col("line")
    venue = F.when(ln > 0, "home").when(ln < 0, "away").otherwise("none")
    fav_won = ((ln > 0) & (F.col("home_score") > F.col("away_score"))) | ((ln < 0) & (F.col("away_score") > F.col("home_score")))
    c = contests.select("season", venue.alias("v"), fav_won.cast("int").alias("fw"), (F.col("home_score") > F.col("away_score")).cast("int").alias("hw"))
    g = c.groupBy("season").agg(
        F.count(F.lit(1)).alias("games"),
        F.sum("hw").alias("home_wins"),
        F.sum(F.when(F.col("v") != "none", F.col("fw")).otherwise(0)).alias("fav_wins"),
        F.sum(F.when(F.col("v") != "none", 1).otherwise(0)).alias("fav_games"),
        F.sum(F.when(F.col("v") == "home", F.col("fw")).otherwise(0)).alias("hf_wins"),
        F.sum(F.when(F.col("v") == "home", 1).otherwise(0)).alias("hf_games"),
        F.sum(F.when(F.col("v") == "away", F.col("fw")).otherwise(0)).alias("af_wins"),
        F.sum(F.when(F.col("v") == "away", 1).otherwise(0)).alias("af_games"),
    )
    return g.select(
        "season", "games",
        round_half_up(F.col("home_wins") / F.col("games"), digits).alias("home_win_pct"),
        round_half_up(F.try_divide(F.col("fav_wins"), F.col("fav_games")), digits).alias("fav_win_pct"),
        round_half_up(F.try_divide(F.col("hf_wins"), F.col("hf_games")), digits).alias("home_fav_win_pct"),
        round_half_up(F.try_divide(F.col("af_wins"), F.col("af_games")), digits).alias("away_fav_win_pct"),
    )


def simple_regression(df: DataFrame, y: str, x: str, digits: int = 4) -> DataFrame:
    """Least-squares line ``y ~ x``: slope, intercept and R-squared from combinable aggregates."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return d.agg(
        F.count(F.lit(1)).alias("n"),
        round_half_up(F.regr_slope(y, x), digits).alias("slope"),
        round_half_up(F.regr_intercept(y, x), digits).alias("intercept"),
        round_half_up(F.regr_r2(y, x), digits).alias("r2"),
    )


def t_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) of Student's t distribution: the regularised incomplete beta function by its continued fraction."""
    a, b, x = df / 2, 0.5, df / (df + t * t)
    if x >= 1:
        return 1.0
    if x <= 0:
        return 0.0
    swap = x > (a + 1) / (a + b + 2)
    if swap:
        a, b, x = b, a, 1 - x
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    f, c, d = 1.0, 1.0, 0.0
    for i in range(400):
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / max(1 + term * d, 1e-300) if 1 + term * d > 0 else 1 / min(1 + term * d, -1e-300)
        c = 1 + term / c
        f *= c * d
        if abs(1 - c * d) < 1e-14:
            break
    value = front * (f - 1)
    return 1 - value if swap else value


def multiple_regression(df: DataFrame, y: str, xs: list[str], digits: int = 4) -> DataFrame:
    """Least squares of ``y`` on ``xs``: rows ``term, estimate, std_error, t_value, p_value, n, r2, adj_r2``.

    One aggregation gives the centred Gram matrix (means and co-moments, which Spark merges without cancellation); the
    p x p matrix, whatever the number of rows, is factored by Cholesky on the driver. Rows with a missing value are left
    out. Regressors that depend on each other, and fewer rows than terms, raise ``ValueError``.
    """
    cols = [*xs, y]
    d = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).where(" and ".join(f"`{c}` is not null" for c in cols))
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = d.agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[(F.covar_pop(cols[i], cols[j]) * F.count(F.lit(1))).alias(f"s{i}_{j}") for i, j in pairs],
    ).first()
    n, p = row["n"], len(xs)
    if n <= p + 1:
        raise ValueError("fewer rows than terms")
    gram = np.zeros((p + 1, p + 1))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = row[f"s{i}_{j}"]
    sxx, sxy, syy = gram[:p, :p], gram[:p, p], gram[p, p]
    scale = np.sqrt(np.diag(sxx))
    if not scale.all():
        raise ValueError("a regressor is constant")
    corr = sxx / np.outer(scale, scale)
    if np.linalg.eigvalsh(corr)[0] < 1e-12:
        raise ValueError("regressors depend on each other")
    lower = np.linalg.cholesky(corr)
    half = np.linalg.solve(lower, np.eye(p))
    inverse = half.T @ half / np.outer(scale, scale)
    beta = inverse @ sxy
    mean = np.array([row[f"m{i}"] for i in range(p)])
    rss, free = max(0.0, syy - beta @ sxy), n - p - 1
    sigma2 = rss / free
    estimates = [row[f"m{p}"] - beta @ mean, *beta]
    errors = [math.sqrt(sigma2 * (1 / n + mean @ inverse @ mean)), *np.sqrt(sigma2 * np.diag(inverse))]
    r2 = 1 - rss / syy if syy else math.nan
    out = []
    for term, e, se in zip(["(intercept)", *xs], estimates, errors, strict=True):
        t = e / se if se else math.inf
        out.append((term, float(e), float(se), float(t), t_two_sided(float(t), free), n, float(r2), 1 - (1 - float(r2)) * (n - 1) / free))
    made = df.sparkSession.createDataFrame(out, "term string, estimate double, std_error double, t_value double, p_value double, n long, r2 double, adj_r2 double")
    return made.withColumns({c: round_half_up(F.col(c), 6 if c == "p_value" else digits) for c, t in made.dtypes if t == "double"})


def metric_by_wins(side_rows: DataFrame, metric: str, digits: int = 4) -> DataFrame:
    """Metric against outcome: per (season, team) the wins and the mean metric, then per win total the mean of
    those team means and the number of team seasons."""
    per = side_rows.groupBy("season", "team").agg(F.sum("win").cast("bigint").alias("wins"), F.avg(metric).alias("__m"))
    return per.groupBy("wins").agg(round_half_up(F.avg("__m"), digits).alias(f"mean_{metric}"), F.count(F.lit(1)).alias("team_seasons"))


def half_ppr(df: DataFrame, by: list[str], points: str, receptions: str, digits: int = 4) -> DataFrame:
    """Half-point-per-reception scoring (points + 0.5 x receptions), total and mean per group, in long form."""
    pts = F.col(points) + 0.5 * F.col(receptions)
    g = df.groupBy(*by).agg(
        round_half_up(F.sum(pts), digits).alias("total"),
        round_half_up(F.avg(pts), digits).alias("mean"),
    )
    return g.unpivot(by, ["total", "mean"], "measure", "half_ppr")


def spread_summary(df: DataFrame, col: str, by: list[str] | None = None, digits: int = 4) -> DataFrame:
    """Sample standard deviation, mean and the mean scaled by the deviation."""
    g = df.groupBy(*(by or [])).agg(F.stddev_samp(col).alias("sd"), F.avg(col).alias("mean"))
    return g.select(*(by or []), round_half_up(F.col("sd"), digits).alias("sd"), round_half_up(F.col("mean"), digits).alias("mean"),
                    round_half_up(F.try_divide(F.col("mean"), F.col("sd")), digits).alias("scaled_mean"))


def numeric_totals(df: DataFrame, by: list[str], how: str = "sum") -> DataFrame:
    """Sum (or mean) of every numeric non-key column per group."""
    num = [c for c, t in df.dtypes if c not in by and (t in ("bigint", "int", "double", "float", "smallint") or t.startswith("decimal"))]
    fn = F.sum if how == "sum" else F.avg
    return df.groupBy(*by).agg(*[fn(c).alias(c) for c in num])


def second_to_last(df: DataFrame, by: list[str], order: str, value: str, name: str = "second_last") -> DataFrame:
    """Value on the second-to-last row of each group (``nth(value, -2)``): the last order value per group, then the
    latest row before it. Two aggregations and a join, so no group is sorted in one task."""
    last = df.groupBy(*by).agg(F.max(order).alias("__last"))
    rest = df.join(last, by).where(F.col(order) < F.col("__last"))
    return rest.groupBy(*by).agg(F.max_by(value, order).alias(name))


def group_ids(df: DataFrame, keys: list[str], name: str = "group_id") -> DataFrame:
    """``cur_group_id()``: a dense 1-based id per distinct key, in key order. The distinct keys are ranked with the
    bucketed global scan (bucket = first key), then joined back."""
    from .scan import GroupOrder, numeric_levels, prefix_levels, scan

    distinct = df.select(*keys).distinct()
    numeric = dict(distinct.dtypes)[keys[0]] in ("bigint", "int", "smallint", "double", "float")
    levels = numeric_levels(keys[0], (1.0, 1024.0, float(1 << 20))) if numeric else prefix_levels(keys[0], (6, 3, 1))
    ranked = scan(distinct, GroupOrder(keys=[], order=keys, levels=levels), sums={name: F.lit(1)})
    return df.join(ranked, keys, "left")
