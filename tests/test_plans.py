"""Physical-plan checks: the stored adapter tables remove shuffles, scans read only what they need."""

import re

from testdata_paths import SF_SMALL
from pyspark.sql import functions as F

from contestlab.operators import side_stats
from contestlab.sources import prepared
from contestlab.sources.tables import bounded_broadcast


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_contest_rollups_need_no_shuffle(spark):
    plays = prepared.plays(spark, SF_SMALL)
    for df in (side_stats.offense_stats(plays), side_stats.defense_stats(plays), side_stats.pass_splits(plays)):
        assert "Exchange hashpartitioning" not in _plan(df)


def test_filters_and_columns_reach_the_scan(spark):
    k = prepared.contests(spark, SF_SMALL).where(F.col("season") == 1998).select("contest_id", "line")
    plan = _plan(k)
    assert "EqualTo(season,1998)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(x.split(":")[0] for x in schema.split(",")) == {"contest_id", "line", "season"}


def test_broadcast_only_after_size_check(spark):
    small = spark.range(10)
    big = spark.range(5000)
    assert "BroadcastExchange" in _plan(big.join(bounded_broadcast(small, 100), "id"))
    joined = spark.range(5000).join(bounded_broadcast(big, 100), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastExchange" not in _plan(spark.range(5000).join(bounded_broadcast(big, 100), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.count() == 5000


def test_period_ratings_run_in_the_jvm_and_count_pairs_first(spark):
    """No Python in the plan, and what reaches the fold is counts of pairs, pre-aggregated where the contests lie."""
    from contestlab.operators import ratings

    held = []
    keep = ratings.materialize_scratch
    ratings.materialize_scratch = lambda df, name: held.append(_plan(df)) or keep(df, name)
    try:
        out = ratings.period_ratings(prepared.contests(spark, SF_SMALL))
    finally:
        ratings.materialize_scratch = keep
    for plan in (*held, _plan(out)):
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert "partial_count(1)" in held[0] and "home_team" in held[0]


def test_buckets_and_reads_of_the_stored_tables_hold_bounded_rows(spark, tmp_path):
    """Rows count, not bytes: these compress to almost nothing."""
    for name, n in (("orders", 600_000), ("lineitem", 4_300_000)):
        spark.range(n).select((F.col("id") % 1).alias("k")).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    assert prepared._n_buckets(spark, str(tmp_path), prepared.CONTEST_SOURCES) == 16
    assert prepared._n_buckets(spark, str(tmp_path), prepared.PLAY_SOURCES) == 32
    assert prepared._split_bytes(spark, str(tmp_path), prepared.PLAY_SOURCES) == 1 << 20
    before = spark.conf.get(prepared.SPLIT_CONF)
    prepared.contests(spark, SF_SMALL)
    assert spark.conf.get(prepared.SPLIT_CONF) == before


def test_the_margin_split_shuffles_no_wide_rows(spark, tmp_path):
    """Bins and last train rows are small tables: the stored rows are read, not dealt again, and split as rows ranked whole."""
    from contestlab.operators import ml
    from contestlab.plans import workflows

    odd = F.when(F.col("id") % 50 != 0, F.col("id") * 7 % 23)
    spark.range(1000).select(F.col("id").alias("contest_id"), odd.alias("spread"), *[F.lit(i).alias(f"c{i}") for i in range(5)]).write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    got = workflows.spread_split(t)
    assert "Exchange hashpartitioning" not in _plan(got) and "Exchange rangepartitioning" not in _plan(got)
    want = ml.stratified_split(workflows.value_bins(t, "spread"), ["bin"], "contest_id")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect())) and got.count() == 1000


def test_scans_and_pairing_shuffle_each_row_once_and_summaries_stay_short(spark):
    """The exchange of a scan carries no column a sum beside the rows, sides are not aggregated before they are dealt, and a day's
    ids share a bucket."""
    import datetime as dt

    from contestlab.operators import records
    from contestlab.plans import features

    day = dt.date(2000, 1, 1)
    rows = [(2000, "A" if s else "B", day, c * 5000, "home" if s else "away", float(c)) for c in range(200) for s in (0, 1)]
    t = spark.createDataFrame(rows, "season bigint, team string, gameday date, contest_id bigint, home_away string, x double")
    level = records.season_order().levels[0]
    assert t.withColumns(level).select("team", *level).distinct().count() == 2
    plan = _plan(features.prior_values(t, ["x"], []))
    assert "REPARTITION_BY_COL" in plan
    paired = _plan(features.matchup_rows(t, ["contest_id", "season"], ["x"], label=None))
    assert paired.count("Exchange") == 1 and "REPARTITION_BY_COL" in paired


def test_the_summary_of_a_scan_is_made_of_dealt_rows(spark, tmp_path):
    """Reading tasks aggregate nothing: no partial aggregate sorts all that a task of the input reads, with a column a sum."""
    import datetime as dt

    from contestlab.plans import features

    day = dt.date(2000, 1, 1)
    rows = [(2000, "AB"[c % 2], day + dt.timedelta(c % 3), c, float(c), c) for c in range(60)]
    spark.createDataFrame(rows, "season bigint, team string, gameday date, contest_id bigint, x double, y bigint").write.parquet(f"{tmp_path}/t")
    got = features.prior_values(spark.read.parquet(f"{tmp_path}/t"), ["x"], ["y"])
    lines = _plan(got).splitlines()
    assert any("Aggregate" in line for line in lines)
    for i, line in enumerate(lines):
        if "FileScan" in line:  # the nodes above an input, from the nearest up
            above = [x for x in reversed(lines[:i]) if "Exchange" in x or "Aggregate" in x]
            assert "REPARTITION_BY_COL" in above[0]
    assert got.count() == 60


def test_shuffles_have_more_partitions_as_tables_grow(spark, monkeypatch):
    """The session's partition number is fixed; a table with more rows than that many tasks should hold is dealt to more."""
    from contestlab.operators import ml
    from contestlab.plans import features
    from contestlab.sources import tables

    k, p = prepared.contests(spark, SF_SMALL), prepared.plays(spark, SF_SMALL)
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cases = {
        "pregame": lambda: features.pregame_features(k, p, prepared.period_ratings(spark, SF_SMALL)),
        "spread": lambda: features.spread_features(k, p),
        "split": lambda: ml.stratified_split(k.select("contest_id", "season"), ["season"], "contest_id"),
    }
    before = {n: sorted(map(str, f().collect())) for n, f in cases.items()}
    monkeypatch.setattr(tables, "TASK_ROWS", 100)
    n_sides, n_plays = -(-2 * k.count() // 100), -(-p.count() // 100)
    assert n_sides > own and n_plays > own
    for n, f in cases.items():
        got = f()
        assert "REPARTITION_BY_NUM" in _plan(got)
        assert sorted(map(str, got.collect())) == before[n]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = _plan(features.side_table(k, p, periods=True)).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joined = [x for x in lines if re.search(r"Exchange hashpartitioning\(contest_id#\d+L, (off_|def_)?team#", x)]
    assert joined and all(f", {n_plays})" in x for x in joined)
    assert any(f", {n_sides}), REPARTITION_BY_NUM" in x for x in lines)


def test_wide_sides_are_paired_as_one_value_and_stored_as_whole_numbers(spark, tmp_path, monkeypatch):
    """An aggregate a column was a sorted one, never compiled; a side that came twice still gives the first value of each column."""
    from contestlab.functions.nulls import nearest_whole
    from contestlab.plans import features

    cols = ["x", "name"]
    rows = [(1, "home", 1.5, "a"), (1, "away", None, "b"), (2, "home", None, "c"), (2, "home", 2.5, "d"), (3, "away", 3.5, "e"), (4, "home", 4.5, None), (None, "home", 0.5, "n"), (5, None, 0.5, "n")]
    t = spark.createDataFrame(rows, "contest_id bigint, home_away string, x double, name string").coalesce(1)
    got = features.matchup_rows(t, ["contest_id"], cols, label=None)
    assert "SortAggregate" not in _plan(got)
    assert got.columns == ["contest_id", "x", "name", "opp_x", "opp_name"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 1.5, "a", None, "b"), (2, 2.5, "c", None, None), (4, 4.5, None, None, None), (None, 0.5, "n", None, None)], key=str)

    wide = t.select("contest_id", "home_away", *[F.col("x").alias(f"x{i}") for i in range(40)])
    full = features.matchup_rows(wide, ["contest_id"], [f"x{i}" for i in range(40)], label=None, digits={"x1": 1}).na.drop(subset=["x0", *[f"x{i}" for i in range(2, 40)]])
    joined = full.join(t.select("contest_id"), "contest_id", "left_semi")  # no constraint for every subset of the columns
    assert sorted((r.contest_id, r.x1) for r in joined.collect()) == [(1, 0.15), (2, 0.25), (4, 0.45)]

    kept = {}
    monkeypatch.setattr(features, "materialize_scratch", lambda df, name: kept.setdefault(name, df))
    k, p = prepared.contests(spark, SF_SMALL), prepared.plays(spark, SF_SMALL)
    features.spread_features(k, p)
    stored = dict(kept["spread_side_table"].dtypes)
    assert all(stored[c] == "bigint" for c in [*features.SPREAD_MEANS, *features.PERIOD_MEANS])

    values = [0.0, -0.0, 0.49999999999999994, 0.5, -0.5, 1.5, 2.5, -2.5, 8191.5, 12345.499999999998, 0.4999, 4503599627370497.0, 1e300, float("inf"), float("nan"), None, *[i * 0.1 * 7 / 3 for i in range(-200, 200)]]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(nearest_whole(F.col("v")).alias("a"), F.round("v").alias("b"))
    assert all(str(r.a) == str(r.b) for r in df.collect())


def test_a_scan_reads_and_deals_its_rows_once(spark, tmp_path):
    """The window, the summary and the next summary need the same columns, so that Spark shuffles for all of them together."""
    import datetime as dt

    from contestlab.plans import features

    day = dt.date(2000, 1, 1)
    rows = [(2000, "AB"[c % 2], day + dt.timedelta(c % 3), c, float(c), c) for c in range(60)]
    spark.createDataFrame(rows, "season bigint, team string, gameday date, contest_id bigint, x double, y bigint").write.parquet(f"{tmp_path}/t")
    got = features.prior_values(spark.read.parquet(f"{tmp_path}/t"), ["x"], ["y"])
    assert got.count() == 60
    got.collect()
    ran = _plan(got).split("== Initial Plan ==")[0]
    assert ran.count("FileScan") == 1 and ran.count("ReusedExchange") >= 2
