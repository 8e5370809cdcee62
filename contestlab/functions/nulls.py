"""Column helpers for the null, NaN and rounding rules the analysis needs (see README, "Null semantics")."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL for a zero or NULL denominator instead of raising under ANSI mode."""
    return F.try_divide(num, den)


def round_half_up(c: Column, digits: int) -> Column:
    """Round half away from zero at ``digits`` places as ``round(x * 10^d) / 10^d``.

    Written this way so the same text in SQL (``round(x * 1000) / 1000``) gives bit-identical doubles
    in any engine that rounds a double to an integer half away from zero.
    """
    scale = float(10 ** digits)
    return F.round(c.cast("double") * F.lit(scale), 0) / F.lit(scale)


def nearest_whole(x: Column) -> Column:
    """``F.round(x)`` of a double, half away from zero, as plain arithmetic: ``F.round`` goes through a decimal text of every
    value, which wide tables feel. The fraction ``a - rint(a)`` is exact, and the last term makes a negative zero positive."""
    a = F.abs(x)
    return F.signum(x) * (F.rint(a) + F.when(a - F.rint(a) == 0.5, 1.0).otherwise(0.0)) + F.lit(0.0)


def sum_or_zero(c: Column) -> Column:
    """``sum(x, na.rm = TRUE)``: an all-NULL group sums to 0, not NULL."""
    return F.coalesce(F.sum(c), F.lit(0))


def strict_max(c: Column) -> Column:
    """``max(x, na.rm = FALSE)``: NULL as soon as any input is NULL."""
    return F.when(F.count(c) == F.count(F.lit(1)), F.max(c))


def strict_mean(c: Column) -> Column:
    """``mean(x, na.rm = FALSE)`` as an aggregate: NULL as soon as any input is NULL."""
    return F.when(F.count(c) == F.count(F.lit(1)), F.avg(c))


def finite_or_null(c: Column) -> Column:
    """Inf, -Inf and NaN become NULL (ratio clean-up before modelling)."""
    d = c.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), c)


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """``na.omit``: drop rows with NULL (or NaN) in any of ``subset`` (default: every column)."""
    return df.na.drop(how="any", subset=subset)


def rows_with_missing(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Diagnostic: rows that have a NULL in any of ``subset``."""
    cols = subset or df.columns
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def fill_with_mean(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """``mean_na``: replace NULL with the column mean, overall or per ``by`` group.

    The overall mean is one global aggregate joined back as a single row; the per-group form is a grouped
    aggregate joined on ``by`` (no unpartitioned window).
    """
    means = df.groupBy(*(by or [])).agg(*[F.avg(c).alias(f"__mean_{c}") for c in columns])
    if by:
        # one row per group: its size grows with the number of groups, so Spark (AQE) picks the join
        joined = df.join(means, on=by, how="left")
    else:
        # exactly one row: a proven size bound, attached by a constant-key equi-join (no cross join)
        means = means.withColumn("__k", F.lit(1))
        joined = df.withColumn("__k", F.lit(1)).join(F.broadcast(means), on="__k", how="left").drop("__k")
    out = joined.select(
        *[
            F.coalesce(F.col(c), F.col(f"__mean_{c}")).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )
    return out


def nan_mask(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``is_nan_data_frame``: one boolean column per numeric column, true where the value is NaN."""
    numeric = [c for c, t in df.dtypes if t in ("double", "float")]
    cols = [c for c in (columns or numeric) if c in numeric]
    return df.select(*[F.isnan(F.col(c)).alias(c) for c in cols])


def drop_matching(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """``filter(!grepl(pattern, col))``: drop rows whose column matches a regex (NULL rows are kept out too)."""
    return df.where(~F.col(col).rlike(pattern))


def clamp_week(season: Column, week: Column, min_season: int = 2002) -> Column:
    """Validity rule for a requested week: 2..18 from 2021 on, 2..17 before (season is clamped up to ``min_season``
    first)."""
    s = F.greatest(season, F.lit(min_season))
    top = F.when(s >= 2021, 18).otherwise(17)
    return F.least(F.greatest(week, F.lit(2)), top)
