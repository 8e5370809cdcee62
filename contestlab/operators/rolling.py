"""Leakage-free features: values known before a contest (lag, season-to-date mean, trailing means, carry-forward)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import round_half_up
from .scan import DEFAULT_CHUNK_ROWS, GroupOrder, framed, scan


def season_to_date_mean(df: DataFrame, go: GroupOrder, cols: list[str], digits: int | None = 3, suffix: str = "") -> DataFrame:
    """``lag(cummean(x))``: mean of the earlier rows of the group, excluding the current one.

    Strict like ``cummean``: once a NULL has been seen the mean stays NULL. The first row of a group is NULL.
    Computed from running sums and counts, so any group size splits over tasks.
    """
    sums: dict[str, Column] = {"__n": F.lit(1)}
    for c in cols:
        sums[f"__s_{c}"] = F.col(c)
        sums[f"__z_{c}"] = F.col(c).isNull().cast("bigint")
    r = scan(df, go, sums=sums)
    out = {}
    for c in cols:
        n_prev = F.col("__n") - 1
        s_prev = F.col(f"__s_{c}") - F.coalesce(F.col(c), F.lit(0))
        z_prev = F.col(f"__z_{c}") - F.col(c).isNull().cast("bigint")
        v = F.when((n_prev > 0) & (z_prev == 0), s_prev / n_prev)
        out[c + suffix] = round_half_up(v, digits) if digits is not None else v
    r = r.withColumns(out)
    return r.drop("__n", *[f"__s_{c}" for c in cols], *[f"__z_{c}" for c in cols])


def lagged(df: DataFrame, go: GroupOrder, cols: list[str], digits: int | None = 4, suffix: str = "") -> DataFrame:
    """``lag(x)``: the value on the previous row of the group (NULL on the first)."""
    r = scan(df, go, lags={f"__lag_{c}": c for c in cols})
    out = {}
    for c in cols:
        v = F.col(f"__lag_{c}")
        out[c + suffix] = round_half_up(v, digits) if digits is not None else v
    return r.withColumns(out).drop(*[f"__lag_{c}" for c in cols])


def carry_forward(df: DataFrame, go: GroupOrder, cols: list[str], suffix: str = "_locf") -> DataFrame:
    """``na.locf(x, na.rm = FALSE)``: last non-NULL value so far (NULL before the first)."""
    r = scan(df, go, carry={f"{c}{suffix}": c for c in cols})
    return r


def trailing_means(
    df: DataFrame,
    go: GroupOrder,
    cols: list[str],
    periods: tuple[int, ...] = (1, 2, 4, 8, 16),
    digits: int | None = 4,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """Trailing mean of the lag-1 value over ``p`` rows, right aligned, partial at the start, NULLs skipped.

    Column ``{x}_lag1_roll_{p}`` = mean of the ``p`` rows before the current one. A window with no non-NULL value
    gives NULL.
    """
    halo = max(periods)

    def build(w):
        exprs = {}
        for c in cols:
            for p in periods:
                v = F.avg(F.col(c)).over(w.rowsBetween(-p, -1))
                exprs[f"{c}_lag1_roll_{p}"] = round_half_up(v, digits) if digits is not None else v
        return exprs

    return framed(df, go, build, halo=halo, chunk_rows=chunk_rows)


def lag_win_pct(record: DataFrame, periods: int = 8, digits: int = 4, chunk_rows: int = DEFAULT_CHUNK_ROWS,
                id_width: int = 1 << 16) -> DataFrame:
    """Trailing mean of the lagged win % over ``periods`` contests per team across seasons.

    When no earlier contest exists the value falls back to the current win % if that is exactly 1 or 0.
    """
    day = F.col("gameday").cast("date")
    levels = [
        {"__lv_s0": F.col("season"), "__lv_d0": day, "__lv_id": F.floor(F.col("contest_id") / F.lit(id_width))},
        {"__lv_s1": F.col("season"), "__lv_d1": day},
        {"__lv_s2": F.col("season"), "__lv_m2": F.trunc(day, "month")},
        {"__lv_s3": F.col("season")},
    ]
    go = GroupOrder(keys=["team"], order=["season", "gameday", "contest_id"], levels=levels)
    t = trailing_means(record, go, ["win_pct"], periods=(periods,), digits=digits, chunk_rows=chunk_rows)
    m = F.col(f"win_pct_lag1_roll_{periods}")
    return t.withColumn(
        "win_pct_rmean",
        F.when(m.isNull() & (F.col("win_pct") == 1), F.lit(1.0)).when(m.isNull() & (F.col("win_pct") == 0), F.lit(0.0)).otherwise(m),
    ).drop(f"win_pct_lag1_roll_{periods}")
