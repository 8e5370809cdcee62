"""Ordered per-group scans (running sums, lag, carry-forward, trailing frames) that never put one group in one task.

A plain ``Window.partitionBy(group).orderBy(...)`` sends every row of a group to a single task; when one team or
user holds a large share of all rows, that task is the whole job. Here the rows of a group are split into *buckets*:
columns that never decrease along the sort order (for contests: the day plus an id range). Buckets come in levels,
each a coarsening of the one before (id range within a day -> day -> month). Every scan is built from two associative
operations, ``sum`` and ``max`` of a struct keyed by the sort order, evaluated as *exclusive* prefixes:

    prefix(row) = combine(prefix of the earlier buckets, prefix of the earlier rows in the same bucket)

The in-bucket part is a window over ``(group, bucket)``. The part over earlier buckets is the same problem one level
up, on a summary with one row per bucket, aggregated where the bucket's rows were dealt to; each coarser summary is aggregated
from the one below, so the input is read and dealt once whatever the number of levels. Only the coarsest summary (a few rows per group) is scanned with a
window over the group alone. The offsets are combined from the coarsest level down and joined back on the bucket, the
partitioning the in-bucket window already has. No task holds more than one bucket of one level.

From the two prefixes: running sum = exclusive sum + own value; lag = the value inside the exclusive max of
``struct(order, value)``; carry-forward = own value, else the exclusive max over non-NULL values.

Bounded frames (``rowsBetween(-p, -1)``) use exact row positions from a scan, cut each group into chunks of
``chunk_rows`` rows and copy the last ``p`` rows of each chunk into the next one as a halo, so every frame is complete
inside one chunk.

All order columns are ascending and together unique within a group.

There is one path, whatever the size of a group. Group and bucket columns meet in one struct per level, which is never
NULL itself and equal where its fields are equal or both NULL: rows with a NULL key are a group like any other, and the
in-bucket windows and the offset joins share one partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK_ROWS = 1 << 20
#: Ids of a bucket within a day. A bucket should hold many rows of its group, or its summary is as long as the rows; it
#: holds this many at most (one group with a whole range of ids in one day), which the sort and the window spill.
ID_WIDTH = 1 << 20
_ids = count()


@dataclass
class GroupOrder:
    """``keys`` (group), ``order`` (unique ascending sort key), ``levels`` (bucket columns, finest first), ``tasks`` (partitions
    the rows are dealt to; None: the session's number)."""

    keys: list[str]
    order: list[str]
    levels: list[dict[str, Column]] = field(default_factory=list)
    tasks: int | None = None


def date_levels(date_col: str, id_col: str | None = None, id_width: int = ID_WIDTH) -> list[dict[str, Column]]:
    """Levels for the order ``(date, id)``: id range within the day, the day, the month."""
    day = F.col(date_col).cast("date")
    levels = []
    if id_col is not None:
        levels.append({"__lv_day0": day, "__lv_id": F.floor(F.col(id_col) / F.lit(id_width))})
    levels.append({"__lv_day": day})
    levels.append({"__lv_month": F.trunc(day, "month")})
    return levels


def time_levels(ts_col: str) -> list[dict[str, Column]]:
    """Levels for an order that starts with a timestamp: second, day, month."""
    ts = F.col(ts_col)
    return [
        {"__lv_sec": F.date_trunc("second", ts)},
        {"__lv_day": F.to_date(ts)},
        {"__lv_month": F.trunc(F.to_date(ts), "month")},
    ]


def numeric_levels(col: str, widths: tuple[float, ...], then_id: str | None = None, id_width: int = 1 << 16) -> list[dict[str, Column]]:
    """Levels for an order that starts with a number: ``floor(x / widths[0])``, then each coarser level divides the
    previous bucket number by ``widths[i] / widths[i - 1]`` (a whole ratio), so every level is an exact function of
    the finer one. With ``then_id`` the finest level also splits equal values by an id range (order ``(x, id, ...)``)."""
    levels = []
    if then_id is not None:
        levels.append({"__lv_x0": F.col(col), "__lv_id": F.floor(F.col(then_id) / F.lit(id_width))})
    prev = F.floor(F.col(col) / F.lit(float(widths[0])))
    levels.append({"__lv_x1": prev})
    for i in range(1, len(widths)):
        ratio = round(widths[i] / widths[i - 1])
        prev = F.floor(F.col(f"__lv_x{i}") / F.lit(ratio))
        levels.append({f"__lv_x{i + 1}": prev})
    return levels


def prefix_levels(col: str, lengths: tuple[int, ...] = (5, 3, 1)) -> list[dict[str, Column]]:
    """Levels for an order that starts with a string (e.g. a hex hash): shrinking prefixes."""
    return [{f"__lv_p{n}": F.substring(F.col(col), 1, n)} for n in lengths]


def _with_all(e: Column, cols: list[str]) -> Column:
    """``e``, by an expression that the optimizer cannot tell from one that needs ``cols``. Two consumers of a shuffle that need
    different columns would each shuffle their own; where both need all, Spark shuffles once and reads twice."""
    return F.when(F.pmod(F.xxhash64(*cols), F.lit(2)) < 2, e) if cols else e


def _hashable(df: DataFrame, cols: list[str]) -> list[str]:
    kinds = dict(df.dtypes)
    return [f"`{c}`" for c in cols if "map<" not in kinds[c] and "variant" not in kinds[c]]


def _exclusive(rows: DataFrame, keys: list[str], order: list[str], levels: list[dict[str, Column]],
               sums: dict[str, Column], maxes: dict[str, Column], tag: str, tasks: int | None = None) -> DataFrame:
    """Columns of the rows and ``{tag}s_{n}`` (sum over earlier rows of the group) and ``{tag}m_{n}`` (max over earlier rows).

    ``{tag}g{k}`` is the level-``k`` bucket with its group (``k = n``: the group alone). Summary ``k`` has one row per
    level-``k`` bucket; its exclusive prefix within the level-``k + 1`` bucket is a window, and the offsets are combined
    from the coarsest level down and joined to the rows once.
    """
    cols = {**{f"s_{n}": e for n, e in sums.items()}, **{f"m_{n}": e for n, e in maxes.items()}}
    agg = lambda c: F.sum if c.startswith("s_") else F.max
    last = list(cols)[-1]
    n = len(levels)
    g = [f"{tag}g{k}" for k in range(n + 1)]

    def windowed(df: DataFrame, part: str, order_cols: list[str], src: dict[str, Column], prefix: str) -> DataFrame:
        w = Window.partitionBy(part).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({f"{prefix}{c}": agg(c)(e).over(w) for c, e in src.items()})

    def total(c: str, also: list[str]) -> Column:
        """A summary's column; the last one of all with the need for ``also``."""
        return _with_all(F.col(f"{tag}t{c}"), also if c == last else [])

    def combine(off: str, loc: str) -> dict[str, Column]:
        out = {}
        for c in cols:
            if c.startswith("s_"):
                out[f"{tag}{c}"] = F.coalesce(F.col(f"{off}{c}"), F.lit(0)) + F.coalesce(F.col(f"{loc}{c}"), F.lit(0))
            else:
                out[f"{tag}{c}"] = F.greatest(F.col(f"{off}{c}"), F.col(f"{loc}{c}"))
        return out

    buckets = [[F.col(c) for c in [*keys, *(levels[k] if k < n else [])]] or [F.lit(0)] for k in range(n + 1)]
    own, leveled = rows.columns, rows
    for lv in levels:
        leveled = leveled.withColumns(lv)
    # shuffled before the window's inputs are computed: the exchange carries the rows alone, not a column a sum beside them
    rows = leveled.withColumn(g[0], F.struct(*buckets[0])).select(*[f"`{c}`" for c in own], g[0])
    rows = rows.repartition(tasks, g[0]) if tasks else rows.repartition(g[0])
    if n == 0:
        base = windowed(rows, g[0], order, cols, f"{tag}l")
        return base.withColumnsRenamed({f"{tag}l{c}": f"{tag}{c}" for c in cols}).drop(*g)
    every = _hashable(rows, own)
    inputs = {c: _with_all(e, every) if c == last else e for c, e in cols.items()}
    base = windowed(rows, g[0], order, inputs, f"{tag}l")

    # the summary too is made of dealt rows, the same ones: a reading task meets few rows of a bucket, so that partial aggregates
    # would sort all it reads, with a column a sum, and shuffle as many rows
    for lv in levels:
        rows = rows.withColumns(lv)
    rows = rows.withColumns({g[k]: F.struct(*buckets[k]) for k in range(1, n + 1)})
    summary = rows.groupBy(*g).agg(*[agg(c)(e).alias(f"{tag}t{c}") for c, e in inputs.items()])
    # the finest summary grows with the rows; dealt here, it serves its own window and the next summary
    summaries = [summary.repartition(tasks, g[1]) if tasks else summary.repartition(g[1])]
    for k in range(1, n):
        summaries.append(summaries[-1].groupBy(*g[k:]).agg(*[agg(c)(total(c, g[: 1 if k == 1 else 0])).alias(f"{tag}t{c}") for c in cols]))
    offs = None
    for k in range(n - 1, -1, -1):
        tk = windowed(summaries[k], g[k + 1], [g[k]], {c: total(c, g[2:] if k == 0 else []) for c in cols}, f"{tag}l")
        if offs is not None:
            tk = tk.join(offs, g[k + 1], "left").withColumns(combine(f"{tag}o", f"{tag}l"))
        else:
            tk = tk.withColumnsRenamed({f"{tag}l{c}": f"{tag}{c}" for c in cols})
        offs = tk.select(g[k], *[F.col(f"{tag}{c}").alias(f"{tag}o{c}") for c in cols])
    out = base.join(offs, g[0], "left").withColumns(combine(f"{tag}o", f"{tag}l"))
    return out.drop(*g, *[f"{tag}{p}{c}" for c in cols for p in ("l", "o")])


def scan(
    df: DataFrame,
    go: GroupOrder,
    sums: dict[str, Column] | None = None,
    lags: dict[str, str] | None = None,
    carry: dict[str, str] | None = None,
) -> DataFrame:
    """Add ordered running columns to ``df``.

    * ``sums``  name -> expression: running sum (inclusive of the current row); NULL counts as 0.
    * ``lags``  name -> column: value of the column on the previous row of the group (NULL on the first).
    * ``carry`` name -> column: last non-NULL value of the column up to and including the current row.
    """
    sums = sums or {}
    lags = lags or {}
    carry = carry or {}
    ordkey = F.struct(*[F.col(c) for c in go.order])
    s_exprs = {n: F.coalesce(e, F.lit(0)) for n, e in sums.items()}
    m_exprs = {f"lag_{n}": F.struct(ordkey.alias("o"), F.col(c).alias("v")) for n, c in lags.items()}
    m_exprs.update({f"car_{n}": F.when(F.col(c).isNotNull(), F.struct(ordkey.alias("o"), F.col(c).alias("v"))) for n, c in carry.items()})
    tag = f"__x{next(_ids)}_"
    out = _exclusive(df, go.keys, go.order, go.levels, s_exprs, m_exprs, tag, go.tasks)
    final: dict[str, Column] = {}
    for n in sums:
        final[n] = F.coalesce(F.col(f"{tag}s_{n}"), F.lit(0)) + s_exprs[n]
    for n in lags:
        final[n] = F.col(f"{tag}m_lag_{n}").getField("v")
    for n, c in carry.items():
        final[n] = F.coalesce(F.col(c), F.col(f"{tag}m_car_{n}").getField("v"))
    drop = [f"{tag}s_{n}" for n in s_exprs] + [f"{tag}m_{n}" for n in m_exprs]
    out = out.withColumns(final).drop(*drop)
    keep = list(df.columns) + [c for c in final if c not in df.columns]
    return out.select(*keep)


def positions(df: DataFrame, go: GroupOrder, name: str = "__pos") -> DataFrame:
    """Exact 1-based row position of each row within its group, computed by a bucketed scan."""
    return scan(df, go, sums={name: F.lit(1)})


def framed(
    df: DataFrame,
    go: GroupOrder,
    exprs_builder,
    halo: int,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """Evaluate window expressions whose frame reaches at most ``halo`` rows back.

    ``exprs_builder(window)`` gets a window partitioned by ``(group, chunk)`` and ordered by the exact position, and
    returns name -> Column. Each chunk holds ``chunk_rows`` rows plus the ``halo`` rows that precede it.
    """
    if chunk_rows < max(1, halo):
        raise ValueError("chunk_rows must be at least the halo size")
    p = positions(df, go, "__pos")
    p = p.withColumn("__chunk", F.floor((F.col("__pos") - 1) / F.lit(chunk_rows)))
    base = p.withColumn("__halo", F.lit(False))
    if halo > 0:
        tail = (
            p.where(((F.col("__pos") - 1) % F.lit(chunk_rows)) >= F.lit(chunk_rows - halo))
            .withColumn("__chunk", F.col("__chunk") + 1)
            .withColumn("__halo", F.lit(True))
        )
        base = base.unionByName(tail)
    w = Window.partitionBy(*go.keys, "__chunk").orderBy("__pos")
    out = base.withColumns(exprs_builder(w)).where(~F.col("__halo"))
    return out.drop("__chunk", "__halo", "__pos")
