"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents are counted by cell (source, language, topic), in tokens (words ``[^\\x20\\x09-\\x0D]+``). Raking multiplies the
cells' weights so that their sums by source, by language and by topic reach the targets, one margin after the other, over
and over. The bound is inside the fit: a cell's probability is the product of its factors, at most 1, and a step sets a
margin's factors so that what cells below 1 give is the goal less what cells at 1 give. A hash of each document is held
against its cell's probability.

A target that asks for more tokens than its value has cannot be met at the budget: all of the value is taken, and the
margin's other goals are raised by their targets, so that the budget holds. Targets of different margins may contradict
each other as well. ``mix_report`` and the ``_miss`` columns say what was reached against what was wanted.

The topic is a column if ``topic_col`` names one. Otherwise it is a bucket of the document's most frequent word of at
least six bytes (the least hash of equally frequent ones; ``TOPICS`` buckets, -1 without such a word): a stand-in that
depends on the text only.

Targets are shares of tokens by value for each margin; by default the tempered shares of the input (share to the power
``TEMPER``), which raise small sources, languages and topics.

Scale. One pass over the texts without a shuffle; the cells, a pre-aggregated table, are raked by
aggregations on one margin at a time; only the margins' factors change, and are written at each step. The driver sees one
number a round. Up to ``HERE`` cells are raked by the same steps on the driver; cells may be many: more are not collected.

Defined cases: null text counts as empty (no tokens, so its draw decides nothing about tokens); null source and language
are values like any other; rows that repeat id and text share a draw; values without a target
keep, together, their share of the margin; targets
without documents are left out; other columns are ignored by ``mix_sources`` and kept by ``mixed``; an empty table gives an
empty result.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize_scratch
from ._text import blocks, mix, small_batches, words

TOPICS = 16
TEMPER = 0.7
#: Expected tokens of the sample as a share of all tokens.
BUDGET = 0.8
#: Raking goes on until all margins are within TOLERANCE of their goals. ROUNDS is only a safety limit, as targets may
#: contradict each other; what is left then is said.
ROUNDS, TOLERANCE = 1000, 1e-3
#: So many cells at most (three numbers each) are raked on the driver, where a round costs no job.
HERE = 200_000
MARGINS = ("source", "lang", "topic")
MISSES = tuple(f"{m}_miss" for m in MARGINS)
#: Bound of a factor and of its inverse, where targets contradict each other.
LEAST = 1e-90

_U = np.uint64


def _count(batches):
    """Tokens and stand-in topic of each text."""
    for b in batches:
        tokens, topic = [], []
        for k in blocks(b.column("text")):
            w = words(k)
            rows = len(k.off) - 1
            tokens.append(np.diff(w.first))
            found = np.full(rows, -1, np.int32)
            at = np.flatnonzero(w.end - w.start >= 6)
            order = at[np.lexsort((w.hash[at], w.row[at]))]
            if len(order):
                new = np.ones(len(order), bool)
                new[1:] = (w.row[order][1:] != w.row[order][:-1]) | (w.hash[order][1:] != w.hash[order][:-1])
                first = np.flatnonzero(new)
                number = np.diff(np.append(first, len(order)))
                row, h = w.row[order][first], w.hash[order][first]
                best = np.lexsort((h, -number, row))
                lead = best[np.concatenate([[True], row[best][1:] != row[best][:-1]])]
                found[row[lead]] = (mix(h[lead]) % _U(TOPICS)).astype(np.int32)
            topic.append(found)
        i = b.schema.get_field_index("text")
        b = b.set_column(i, "tokens", pa.array(np.concatenate(tokens).astype(np.int64) if tokens else [], pa.int64()))
        yield b.append_column("topic", pa.array(np.concatenate(topic) if topic else [], pa.int32()))


def default_targets(cells: DataFrame, margin: str, temper: float = TEMPER) -> DataFrame:
    return cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temper)).alias("target"))


def _coded(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """``cells`` with a key ``k_`` (a string, never null; one for all values without a target) and ``t_``, the target, for each
    margin."""
    for m in MARGINS:
        t = targets[m].where("target IS NOT NULL").select(F.col(m).alias("value"), F.col("target").cast("double").alias(f"t_{m}"))
        key = F.when(F.col(f"t_{m}").isNull(), "r").otherwise(F.coalesce(F.concat(F.lit("v"), F.col(m).cast("string")), F.lit("n")))
        cells = cells.join(t, cells[m].eqNullSafe(t["value"]), "left").withColumn(f"k_{m}", key).drop("value")
    return cells


def _goals(coded: DataFrame, m: str, part: float, bounded: bool) -> DataFrame:
    """``key, tokens, wanted, goal`` of a margin's values, in tokens. ``wanted`` has the targets' shares of ``part`` of the tokens.
    A bounded goal is at most the value's tokens; what such values cannot give is dealt to the others by their targets."""
    t = coded.groupBy(F.col(f"k_{m}").alias("key")).agg(F.sum("tokens").alias("tokens"), F.first(f"t_{m}").alias("target")).where("tokens > 0")
    t = materialize_scratch(t, "goals")
    given = t.where("target IS NOT NULL")
    tokens, target = given.agg(F.sum("tokens"), F.sum("target")).first()
    first = scale = part * tokens / target if target else 0.0
    while bounded and target:
        full = F.col("tokens") <= F.col("target") * scale
        taken, rest = given.agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("target")))).first()
        if not rest or (after := (part * tokens - (taken or 0)) / rest) <= scale * (1 + 1e-12):
            break
        scale = after
    goal = F.least(F.col("tokens").cast("double"), F.col("target") * scale) if bounded else F.col("target") * scale
    kept = F.col("tokens") * part
    return materialize_scratch(t.select("key", "tokens", F.coalesce(F.col("target") * first, kept).alias("wanted"), F.coalesce(goal, kept).alias("goal")), "goals")


def _product(coded: DataFrame, factors: dict[str, DataFrame]) -> DataFrame:
    """``coded`` with ``x``, the product of its factors."""
    x = F.lit(1.0)
    for m, f in factors.items():
        coded = coded.join(f.select(F.col("key").alias(f"k_{m}"), F.col("factor").alias(f"f_{m}")), f"k_{m}", "left")
        x = x * F.coalesce(f"f_{m}", F.lit(1.0))
    return coded.withColumn("x", x).drop(*(f"f_{m}" for m in factors))


def _fit(coded: DataFrame, goals: dict[str, DataFrame], part: float, cap: float, rounds: int, tolerance: float) -> dict[str, DataFrame]:
    """The margins' factors. A step is one aggregation over the cells, written, three to a round; see ``_fit_here`` for few cells."""
    factors = {m: goals[m].select("key", F.lit(part if m == MARGINS[0] else 1.0).alias("factor")) for m in MARGINS}
    for _ in range(rounds):
        for m in MARGINS:
            x = _product(coded, {k: f for k, f in factors.items() if k != m}).join(factors[m].withColumnRenamed("key", f"k_{m}"), f"k_{m}")
            over, w = F.col("x") * F.col("factor") >= cap, F.col("tokens") * F.col("x")
            sums = x.groupBy(F.col(f"k_{m}").alias("key")).agg(
                F.first("factor").alias("last"), F.coalesce(F.sum(F.when(over, F.col("tokens").cast("double"))), F.lit(0.0)).alias("fixed"),
                F.coalesce(F.sum(F.when(~over, w)), F.lit(0.0)).alias("free"), F.sum(w).alias("all"),
            )
            factor = (
                F.when((F.col("free") > 0) & (F.col("goal") > F.col("fixed")), (F.col("goal") - F.col("fixed")) / F.col("free"))
                .when((F.col("free") <= 0) & (F.col("goal") >= F.col("fixed") * (1 - 1e-12)), F.col("last"))
                .otherwise(F.col("goal") / F.col("all"))
            )
            off = F.abs(F.col("fixed") + F.col("last") * F.col("free") - F.col("goal")) / F.greatest(F.col("goal"), F.lit(1.0))
            new = goals[m].join(sums, "key").select("key", F.least(F.greatest(factor, F.lit(LEAST)), F.lit(1 / LEAST)).alias("factor"), off.alias("off"))
            factors[m] = materialize_scratch(new, "factors")
        worst = factors[MARGINS[0]].select("off")
        for m in MARGINS[1:]:
            worst = worst.unionByName(factors[m].select("off"))
        factors = {m: f.select("key", "factor") for m, f in factors.items()}
        if (worst.agg(F.max("off")).first()[0] or 0) < tolerance:
            break
    return factors


def _fit_here(coded: DataFrame, goals: dict[str, DataFrame], part: float, cap: float, rounds: int, tolerance: float) -> dict[str, DataFrame]:
    """The same steps as ``_fit`` on the driver."""
    table = coded.select(*(f"k_{m}" for m in MARGINS), "tokens").toArrow()
    tokens = table["tokens"].to_numpy().astype(float)
    keys, code, goal, factor = {}, {}, {}, {}
    for m in MARGINS:
        d = table[f"k_{m}"].combine_chunks().dictionary_encode()
        keys[m], code[m] = d.dictionary, d.indices.to_numpy()
        by_key = {r.key: r.goal for r in goals[m].select("key", "goal").collect()}
        goal[m] = np.array([by_key[k] for k in keys[m].to_pylist()])
        factor[m] = np.full(len(keys[m]), part if m == MARGINS[0] else 1.0)
    for _ in range(rounds):
        worst = 0.0
        for m in MARGINS:
            x = np.ones(len(tokens))
            for k in MARGINS:
                x = x * factor[k][code[k]] if k != m else x
            last, g, n = factor[m], goal[m], len(goal[m])
            over, w = x * last[code[m]] >= cap, tokens * x
            fixed, free = np.bincount(code[m], np.where(over, tokens, 0.0), n), np.bincount(code[m], np.where(over, 0.0, w), n)
            worst = max(worst, (np.abs(fixed + last * free - g) / np.maximum(g, 1.0)).max(initial=0.0))
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                new = np.where((free > 0) & (g > fixed), (g - fixed) / free, np.where((free <= 0) & (g >= fixed * (1 - 1e-12)), last, g / np.bincount(code[m], w, n)))
            factor[m] = np.clip(new, LEAST, 1 / LEAST)
        if worst < tolerance:
            break
    return {m: coded.sparkSession.createDataFrame(pa.table({"key": keys[m].cast(pa.string()), "factor": pa.array(factor[m], pa.float64())})) for m in MARGINS}


def _raked(cells: DataFrame, targets: dict[str, DataFrame], budget: float | None, rounds: int, tolerance: float) -> tuple[DataFrame, dict[str, DataFrame]]:
    """``cells`` with keys and ``x``, their weight by token, and the margins' goals."""
    coded = materialize_scratch(_coded(cells, targets), "coded")
    part, cap = (1.0, float("inf")) if budget is None else (min(float(budget), 1.0), 1.0)
    goals = {m: _goals(coded, m, part, budget is not None) for m in MARGINS}
    some = coded.where("tokens > 0")
    fit = _fit_here if some.count() <= HERE else _fit
    x = _product(coded, fit(some, goals, part, cap, rounds, tolerance))
    return materialize_scratch(x.withColumn("x", F.least("x", F.lit(cap))), "cells"), goals


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (margins and ``tokens``) with ``weight``, not bounded: the targets' shares by margin of the tokens of all values
    that have a target."""
    raked, _ = _raked(cells, targets, None, rounds, tolerance)
    return raked.select(*cells.columns, (F.col("tokens") * F.col("x")).alias("weight"))


def with_probability(
    cells: DataFrame, targets: dict[str, DataFrame], budget: float, rounds: int = ROUNDS, tolerance: float = TOLERANCE
) -> tuple[DataFrame, DataFrame]:
    """``cells`` with ``probability`` and ``{margin}_miss``; and the report: for each margin and value its ``tokens`` and the
    expected tokens ``wanted`` by the target, ``goal`` (the nearest that the budget allows) and ``reached``, ``feasible`` (wanted is
    no more than there is) and ``miss``, reached over wanted less 1. Warns of targets that are infeasible or missed."""
    raked, goals = _raked(cells, targets, budget, rounds, tolerance)
    report = None
    for m in MARGINS:
        reached = raked.groupBy(F.col(f"k_{m}").alias("key"), F.col(m).cast("string").alias("value")).agg(F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.col("x")).alias("reached"))
        by_key = reached.groupBy("key").agg(F.sum("reached").alias("r"))
        g = goals[m].select("key", F.col("tokens").alias("of"), "wanted", "goal").join(by_key, "key")
        own = F.col("tokens") / F.col("of")  # values without a target share a goal
        rows = reached.join(g, "key").select(
            F.lit(m).alias("margin"), "key", "value", "tokens", (F.col("wanted") * own).alias("wanted"), (F.col("goal") * own).alias("goal"), "reached",
            (F.col("wanted") <= F.col("of") * (1 + 1e-9)).alias("feasible"),
            F.when(F.col("wanted") > 0, F.col("r") / F.col("wanted") - 1).alias("miss"),
            (F.abs(F.col("r") - F.col("goal")) / F.greatest(F.col("goal"), F.lit(1.0))).alias("off"),
        )
        report = rows if report is None else report.unionByName(rows)
    report = materialize_scratch(report, "report")
    cut, off = report.agg(F.count(F.when(~F.col("feasible"), 1)), F.max("off")).first()
    if cut or (off or 0) >= tolerance:
        warnings.warn(f"mix_sources: at budget {budget}, {cut} targets ask for more tokens than there are; worst distance from a goal {off or 0:.2g}", stacklevel=2)
    for m in MARGINS:
        miss = report.where(F.col("margin") == m).groupBy(F.col("key").alias(f"k_{m}")).agg(F.first("miss").alias(f"{m}_miss"))
        raked = raked.join(miss, f"k_{m}", "left")
    probability = F.when(F.col("tokens") > 0, F.col("x")).otherwise(F.lit(min(float(budget), 1.0)))
    return raked.select(*cells.columns, probability.alias("probability"), *MISSES), report.drop("key", "off")


def _counted(docs: DataFrame, id_col: str, text_col: str, topic_col: str | None) -> DataFrame:
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    id_ = F.col(f"`{id_col}`")
    rows = docs.select(
        id_.alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        *([F.col(f"`{topic_col}`").cast("string").alias("given")] if topic_col else []), F.xxhash64(id_, text, F.lit("draw")).alias("draw"), text.alias("text"),
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    counted = rows.select(*[c for c in rows.columns if c != "text"], "text").mapInArrow(_count, f"{schema}, tokens long, topic int")
    return counted.withColumn("topic", F.col("given")).drop("given") if topic_col else counted


def _mixing(docs: DataFrame, targets: dict[str, DataFrame] | None, budget: float, id_col: str, text_col: str, topic_col: str | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counted documents, cells with their probability, and the report."""
    counted = materialize_scratch(_counted(docs, id_col, text_col, topic_col), "counted")
    cells = materialize_scratch(counted.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    targets = {m: (targets or {}).get(m) if (targets or {}).get(m) is not None else default_targets(cells, m) for m in MARGINS}
    return counted, *with_probability(cells, targets, budget)


def mix_sources(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET, id_col: str = "doc_id", text_col: str = "text", topic_col: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, lang, topic, tokens, probability, sampled``; and ``source_miss, lang_miss,
    topic_miss``: by how much the expected tokens of its source, language and topic are off what the targets want (-0.1: a
    tenth less), null where nothing is wanted."""
    counted, cells, _ = _mixing(docs, targets, budget, id_col, text_col, topic_col)
    cells = cells.select(*(F.col(m).alias(f"c_{m}") for m in MARGINS), "probability", *MISSES)
    same = [counted[m].eqNullSafe(cells[f"c_{m}"]) for m in MARGINS]
    uniform = (F.shiftrightunsigned("draw", 11) / F.lit(float(1 << 53))).cast("double")
    return counted.join(cells, same).select("doc_id", *MARGINS, "tokens", "probability", (uniform < F.col("probability")).alias("sampled"), *MISSES, "draw")


def mix_report(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET, id_col: str = "doc_id", text_col: str = "text", topic_col: str | None = None
) -> DataFrame:
    """One row per margin and value: ``margin, value, tokens, wanted, goal, reached, feasible, miss`` (see ``with_probability``)."""
    return _mixing(docs, targets, budget, id_col, text_col, topic_col)[2]


def mixed(docs: DataFrame, budget: float = BUDGET) -> DataFrame:
    """The rows of ``docs`` that are sampled, with all their columns."""
    cells = mix_sources(docs, budget=budget).where("sampled").select("draw").distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))  # whatever the columns' names
    own = docs.select(row.alias("row"), F.xxhash64("doc_id", text, F.lit("draw")).alias("draw"))
    return own.join(cells, "draw", "left_semi").select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
