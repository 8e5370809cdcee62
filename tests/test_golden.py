"""Printed example values: ratings after five contests and the running record of one team."""

import datetime as dt

from pyspark.sql import functions as F

from contestlab.operators import ratings, records
from contestlab.plans import predictions


def _contests(spark, rows):
    return spark.createDataFrame(
        rows,
        "season bigint, week bigint, gameday date, contest_id bigint, game_id string, home_team string, "
        "away_team string, home_score bigint, away_score bigint, line double, div_game bigint",
    )


def test_elo_first_team_values(spark):
    # the team meets five fresh opponents (all still at 1500): loss, win, loss, loss, win
    res = [(10, 20), (20, 10), (10, 20), (10, 20), (20, 10)]
    d0 = dt.date(2021, 9, 12)
    rows = [
        (2021, i + 1, d0 + dt.timedelta(days=7 * i), i + 1, f"g{i}", "ARI", f"OP{i}", h, a, 0.0, 0)
        for i, (h, a) in enumerate(res)
    ]
    out = ratings.elo_ratings(_contests(spark, rows), digits=3).where(F.col("team") == "ARI").orderBy("contest_id")
    assert [r["elo"] for r in out.collect()] == [1490.0, 1500.288, 1490.279, 1480.559, 1491.118]


def test_period_ratings_first_team_values(spark):
    """With one contest a side and period, the printed ratings."""
    res = [(10, 20), (20, 10), (10, 20), (10, 20), (20, 10)]
    d0 = dt.date(2021, 9, 12)
    rows = [(2021, i + 1, d0 + dt.timedelta(days=7 * i), i + 1, f"g{i}", "ARI", f"OP{i}", h, a, 0.0, 0) for i, (h, a) in enumerate(res)]
    out = ratings.period_ratings(_contests(spark, rows)).where(F.col("team") == "ARI").orderBy("contest_id").collect()
    assert [round(r.elo, 3) for r in out] == [1490.0, 1500.288, 1490.279, 1480.559, 1491.118]
    assert [r.prior_elo and round(r.prior_elo, 3) for r in out] == [None, 1490.0, 1500.288, 1490.279, 1480.559]


def _rounds(seasons=2, teams=6, weeks=9):
    """Schedules in which every team plays once a week."""
    rows = []
    for season in range(seasons):
        for week in range(weeks):
            order = [(t * (2 * week + 1) + season) % teams for t in range(teams)] if teams % 2 else sorted(range(teams), key=lambda t: (t * 7 + week * 5) % teams)
            for i in range(0, teams, 2):
                c = len(rows) + 1
                day = dt.date(2020 + season, 9, 1) + dt.timedelta(days=7 * week + i % 3)
                rows.append((2020 + season, week + 1, day, c, f"g{c}", f"T{order[i]}", f"T{order[i + 1]}", (c * 7) % 31, (c * 11) % 29, 0.0, 0))
    return rows


def test_period_ratings_equal_the_fold_in_weekly_rounds(spark):
    k = _contests(spark, _rounds())
    one = {(r.contest_id, r.team): round(r.elo, 6) for r in ratings.elo_ratings(k, digits=None).collect()}
    assert one == {(r.contest_id, r.team): round(r.elo, 6) for r in ratings.period_ratings(k).collect()}


def test_period_ratings_of_crowded_periods(spark):
    """Many contests of a side in one period, repeated pairs, both venues, periods a team sits out."""
    rows = []
    for c in range(300):
        h, a = c * c % 7, (c * 3 + 1) % 7
        if h != a:
            rows.append((2020 + c % 2, c // 40, dt.date(2020, 1, 1), c, "g", f"T{h}", f"T{a}", c * 7 % 31, c * 11 % 29, 0.0, 0))
    want, state, began = {}, {}, {}
    for season, week in sorted({r[:2] for r in rows}):
        before = dict(state.get(season, {}))
        now = state.setdefault(season, {})
        for r in (r for r in rows if r[:2] == (season, week)):
            h, a = (before.get(t, 1500.0) for t in r[5:7])
            d = 20 * ((r[7] > r[8]) - 1 / (1 + 10 ** ((a - h) / 400)))
            for t, x in ((r[5], d), (r[6], -d)):
                now[t] = now.get(t, 1500.0) + x
                began.setdefault((season, t), week)
        for r in (r for r in rows if r[:2] == (season, week)):
            for t in r[5:7]:
                prior = before.get(t, 1500.0) if began[season, t] < week else None
                want[r[3], t] = (round(now[t], 6), None if prior is None else round(prior, 6))
    got = {(r.contest_id, r.team): (round(r.elo, 6), None if r.prior_elo is None else round(r.prior_elo, 6)) for r in ratings.period_ratings(_contests(spark, rows)).collect()}
    assert got == want
    assert ratings.period_ratings(_contests(spark, [])).count() == 0


def test_elo_order_option_and_chunks_agree(spark):
    rows = []
    d0 = dt.date(2020, 9, 1)
    teams = ["A", "B", "C", "D"]
    cid = 0
    for day in range(40):
        for j in range(2):
            h, a = teams[(day + j) % 4], teams[(day + j + 1 + day % 3) % 4]
            if h == a:
                continue
            cid += 1
            rows.append((2020, day // 7 + 1, d0 + dt.timedelta(days=day), cid, f"g{cid}", h, a, (cid * 7) % 31, (cid * 11) % 29, 0.0, 0))
    k = _contests(spark, rows)
    one = {(r.contest_id, r.team): r.elo for r in ratings.elo_ratings(k, digits=6).collect()}
    many = {(r.contest_id, r.team): r.elo for r in ratings.elo_ratings(k, digits=6, chunk_rows=3).collect()}
    assert one == many
    # rating points move between the two sides only
    deltas = ratings.elo_ratings(k, digits=None).groupBy("contest_id").agg(F.sum("elo").alias("s")).collect()
    assert len(deltas) == len(rows)


def test_ratings_and_predictions_follow_every_contest(spark):
    """Teams that play several times a week, contests without a season or a team, chunks that cut seasons."""
    rows = []
    for c in range(200):
        h, a = c * c % 7, (c * 3 + 1) % 7
        if h != a:
            rows.append((2020 + c % 2, c // 80, dt.date(2020, 1, 1) + dt.timedelta(days=c // 9), c, "g", f"T{h}", f"T{a}", c * 7 % 31, c * 11 % 29, 0.0, 0))
    odd = [(None, None, None, 900, "g", "T1", "T2", 3, 1, 0.0, 0), (2020, 1, dt.date(2020, 1, 5), 901, "g", None, "T2", 3, 1, 0.0, 0)]
    now, want, prob = {}, {}, {}
    for r in sorted([*rows, odd[1]], key=lambda r: (r[0], r[2], r[3])):
        h, a = (now.get((r[0], t)) for t in r[5:7])
        p = 1 / (1 + 10 ** (((a or 1500.0) - (h or 1500.0)) / 400))
        d = 20 * ((r[7] > r[8]) - p) if r[5] else 0.0
        prob[r[3]] = p
        for t, x, was in ((r[5], d, h), (r[6], -d, a)):
            if t:
                now[r[0], t] = (was or 1500.0) + x
                want[r[3], t] = (round(now[r[0], t], 6), was and round(was, 6))
    k = _contests(spark, rows + odd)
    for chunk_rows in (7, 1000):
        got = ratings.elo_ratings(k, digits=None, chunk_rows=chunk_rows).collect()
        assert {(r.contest_id, r.team): (round(r.elo, 6), r.prior_elo and round(r.prior_elo, 6)) for r in got} == want
        assert len(got) == len(want)
    predicted = {r.contest_id: r.prob for r in predictions.rating_predictions(_contests(spark, rows)).collect()}
    assert predicted.keys() == {r[3] for r in rows} and all(abs(p - prob[c]) < 1e-6 for c, p in predicted.items())


def test_record_rest_days_and_win_pct(spark):
    # rest 7 (first), 7, 8, 6, 7, 7, 14 and results W L L L W L W
    gaps = [0, 7, 8, 6, 7, 7, 14]
    results = [1, 0, 0, 0, 1, 0, 1]
    day = dt.date(2021, 9, 12)
    rows = []
    for i, (g, w) in enumerate(zip(gaps, results)):
        day = day + dt.timedelta(days=g)
        rows.append((2021, i + 1, day, 100 + i, f"g{i}", "ARI", f"X{i}", 20 if w else 10, 10 if w else 20, 0.0, 0))
    rec = records.team_record(_contests(spark, rows)).where(F.col("team") == "ARI").orderBy("gameday").collect()
    assert [r.rest_days for r in rec] == [7, 7, 8, 6, 7, 7, 14]
    assert [r.win_pct for r in rec][:6] == [1.0, 0.5, 0.333, 0.25, 0.4, 0.333]
