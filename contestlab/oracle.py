"""Reference SQL for every registered query, runnable by DuckDB over the stored tables.

The adapter rules of ``contestlab.sources.adapters`` are repeated here as common table expressions, so the Spark
query and its SQL see the same contests and plays. Integer outputs are BIGINT, fractions are rounded with
``round(x * 10^d) / 10^d`` exactly as ``round_half_up`` does on the Spark side.
"""

from __future__ import annotations

CONTESTS = """
teams as (
  select n_nationkey, regexp_replace(n_name, '[^A-Za-z0-9]', '', 'g') as team, n_regionkey from nation
),
contests as (
  select cast(year(o.o_orderdate) as bigint) as season,
         cast(floor((dayofyear(o.o_orderdate) - 1) / 7) + 1 as bigint) as week,
         cast(o.o_orderdate as date) as gameday,
         o.o_orderkey as contest_id,
         printf('%d_%02d_%s_%s', cast(year(o.o_orderdate) as bigint),
                cast(floor((dayofyear(o.o_orderdate) - 1) / 7) + 1 as bigint), an.team, hn.team) as game_id,
         hn.team as home_team,
         an.team as away_team,
         cast(floor(o.o_totalprice) as bigint) % 45 as home_score,
         cast(floor(o.o_totalprice / 45) as bigint) % 45 as away_score,
         cast(o.o_orderkey % 29 - 14 as double) as line,
         cast(case when hn.n_regionkey = an.n_regionkey then 1 else 0 end as bigint) as div_game
  from orders o
  join customer c on o.o_custkey = c.c_custkey
  join teams hn on hn.n_nationkey = c.c_nationkey
  join teams an on an.n_nationkey = (c.c_nationkey + 1 + o.o_orderkey % 24) % 25
)"""

SIDES = """
sides as (
  select season, week, gameday, contest_id, game_id, line, div_game,
         home_team as team, away_team as opponent, 'home' as home_away, cast(1 as bigint) as is_home,
         home_score as own_score, away_score as opp_score
  from contests
  union all
  select season, week, gameday, contest_id, game_id, line, div_game,
         away_team as team, home_team as opponent, 'away' as home_away, cast(0 as bigint) as is_home,
         away_score as own_score, home_score as opp_score
  from contests
)"""

PLAYS = """
plays0 as (
  select l.l_orderkey as contest_id, k.season, k.week, k.game_id, k.home_team, k.away_team, k.line, k.div_game, k.home_score, k.away_score,
         cast(row_number() over (partition by l.l_orderkey
              order by l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_quantity, l.l_discount,
                       l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate) as bigint) as play_id,
         cast(l.l_linenumber as bigint) as period,
         case when (l.l_linenumber + l.l_orderkey) % 2 = 0 then k.home_team else k.away_team end as off_team,
         case when (l.l_linenumber + l.l_orderkey) % 2 = 0 then k.away_team else k.home_team end as def_team,
         l.l_partkey % 8 as drive,
         cast(case when l.l_tax > 0.04 then 1 else 0 end as bigint) as drive_scored,
         cast(case when l.l_tax > 0.04 then 3 + l.l_suppkey % 5 else 0 end as bigint) as points,
         cast(case when l.l_quantity <= 5 then 1 else 0 end as bigint) as lost_ball,
         cast(case when l.l_linestatus = 'O' then 1 else 0 end as bigint) as converted,
         cast(case when l.l_linestatus = 'F' then 1 else 0 end as bigint) as failed,
         cast(round((l.l_discount - 0.05) * 100) as bigint) as value_added,
         concat(cast(cast(floor(l.l_quantity) as bigint) % 10 as varchar), ':',
                lpad(cast(cast(floor(l.l_extendedprice) as bigint) % 60 as varchar), 2, '0')) as possession_clock,
         cast(floor(l.l_quantity) as bigint) as air_yards,
         cast(case when l.l_linestatus = 'O' then 1 else 0 end as bigint) as completed
  from lineitem l join contests k on l.l_orderkey = k.contest_id
),
plays1 as (
  select *,
         cast(sum(case when off_team = home_team then points else 0 end)
           over (partition by contest_id order by play_id rows between unbounded preceding and current row) as bigint) as total_home_score,
         cast(sum(case when off_team = away_team then points else 0 end)
           over (partition by contest_id order by play_id rows between unbounded preceding and current row) as bigint) as total_away_score
  from plays0
),
plays as (
  select *,
         case when off_team = home_team then total_home_score else total_away_score end as off_score_post,
         case when off_team = home_team then total_away_score else total_home_score end as def_score_post
  from plays1
)"""


def with_ctes(*ctes: str) -> str:
    return "with " + ",\n".join(c.strip() for c in ctes) + "\n"


def r(expr: str, digits: int) -> str:
    """SQL twin of ``round_half_up``."""
    scale = float(10 ** digits)
    return f"(round(cast({expr} as double) * {scale}) / {scale})"


def div(num: str, den: str) -> str:
    """SQL twin of ``safe_div``: NULL for a zero denominator."""
    return f"(case when ({den}) = 0 then null else cast({num} as double) / ({den}) end)"


RUN = "partition by season, team order by gameday, contest_id rows between unbounded preceding and current row"
PREV = "partition by season, team order by gameday, contest_id"

SQL: dict[str, str] = {}

SQL["team_record"] = with_ctes(CONTESTS, SIDES) + f"""
, rec as (
  select *, cast(case when own_score > opp_score then 1 when own_score <= opp_score then 0 end as bigint) as win
  from sides
), run as (
  select *,
         count(*) over ({RUN}) as games,
         sum(win) over ({RUN}) as win_total,
         sum(is_home) over ({RUN}) as home_games,
         sum(win * is_home) over ({RUN}) as home_win,
         sum(1 - is_home) over ({RUN}) as away_games,
         sum(win * (1 - is_home)) over ({RUN}) as away_win,
         lag(gameday) over ({PREV}) as prev_gameday
  from rec
)
select season, week, cast(gameday as varchar) as gameday, contest_id, game_id, team, opponent, home_away,
       cast(coalesce(datediff('day', prev_gameday, gameday), 7) as bigint) as rest_days,
       win, own_score, opp_score,
       cast(games as bigint) as games, cast(win_total as bigint) as win_total,
       cast(home_win as bigint) as home_win, cast(away_win as bigint) as away_win,
       {r(div('win_total', 'games'), 3)} as win_pct,
       {r('coalesce(' + div('home_win', 'home_games') + ', 0.0)', 3)} as home_win_pct,
       {r('coalesce(' + div('away_win', 'away_games') + ', 0.0)', 3)} as away_win_pct
from run
"""

REG = "reg as (select * from plays where period <= 4 and off_team is not null and off_team <> '')"
DREG = "dreg as (select * from plays where period <= 4 and def_team is not null and def_team <> '')"

OFFENSE_Q = f"""
spans as (
  select contest_id, off_team, period,
         case when count(*) > 1 then arg_max(off_score_post, play_id) - arg_min(off_score_post, play_id) end as pts
  from reg group by contest_id, off_team, period
), dp as (
  select contest_id, off_team, drive, period, max(drive_scored) as mx from reg group by contest_id, off_team, drive, period
), d as (
  select contest_id, off_team, drive, arg_min(mx, period) as flag from dp group by contest_id, off_team, drive
), ds as (
  select contest_id, off_team, count(*) as ndrives, cast(sum(flag) as bigint) as score_drives from d group by contest_id, off_team
), m as (
  select contest_id, off_team, any_value(season) as season, any_value(week) as week, any_value(game_id) as game_id,
         cast(max(case when off_team = home_team then 1 else 0 end) as bigint) as home,
         max(div_game) as div_game, sum(converted) as conv, sum(failed) as fail,
         cast(sum(lost_ball) as bigint) as turnovers, {r('avg(value_added)', 3)} as value_added,
         any_value(case when off_team = home_team then home_score - away_score
                        when off_team = away_team then away_score - home_score end) as score_diff
  from reg group by contest_id, off_team
)
select m.season, m.week, m.contest_id, m.game_id, m.off_team as team, m.home, m.div_game,
       {r(div('m.conv', 'm.conv + m.fail'), 3)} as third_down_pct, m.turnovers, m.value_added,
       s1.pts as qtr_pts_1, s2.pts as qtr_pts_2, s3.pts as qtr_pts_3, s4.pts as qtr_pts_4,
       s1.pts + s2.pts + s3.pts + s4.pts as pts_scored, m.score_diff,
       ds.ndrives, ds.score_drives, {r(div('ds.score_drives', 'ds.ndrives'), 3)} as score_drives_pct
from m
left join spans s1 on s1.contest_id = m.contest_id and s1.off_team = m.off_team and s1.period = 1
left join spans s2 on s2.contest_id = m.contest_id and s2.off_team = m.off_team and s2.period = 2
left join spans s3 on s3.contest_id = m.contest_id and s3.off_team = m.off_team and s3.period = 3
left join spans s4 on s4.contest_id = m.contest_id and s4.off_team = m.off_team and s4.period = 4
left join ds on ds.contest_id = m.contest_id and ds.off_team = m.off_team
"""

SQL["offense_stats"] = with_ctes(CONTESTS, PLAYS, REG) + ", " + OFFENSE_Q
OFF_CTE = f"off as (with {OFFENSE_Q})"

DEFENSE_Q = f"""
spans as (
  select contest_id, def_team, period,
         case when count(*) > 1 then arg_max(off_score_post, play_id) - arg_min(off_score_post, play_id) end as pts
  from dreg group by contest_id, def_team, period
), dp as (
  select contest_id, def_team, drive, period, max(drive_scored) as mx from dreg group by contest_id, def_team, drive, period
), d as (
  select contest_id, def_team, drive, arg_min(mx, period) as flag from dp group by contest_id, def_team, drive
), ds as (
  select contest_id, def_team, count(*) as ndrives, cast(sum(flag) as bigint) as score_drives from d group by contest_id, def_team
), m as (
  select contest_id, def_team, any_value(season) as season, any_value(week) as week, any_value(game_id) as game_id,
         sum(converted) as conv, sum(failed) as fail,
         cast(sum(lost_ball) as bigint) as def_turnovers, {r('avg(value_added)', 3)} as def_value_added
  from dreg group by contest_id, def_team
)
select m.season, m.week, m.contest_id, m.game_id, m.def_team as team,
       s1.pts as def_qtr_pts_1, s2.pts as def_qtr_pts_2, s3.pts as def_qtr_pts_3, s4.pts as def_qtr_pts_4,
       m.def_value_added, {r(div('m.conv', 'm.conv + m.fail'), 3)} as def_third_down_pct, m.def_turnovers,
       ds.ndrives as def_ndrives, ds.score_drives as def_score_drives,
       {r(div('ds.score_drives', 'ds.ndrives'), 3)} as def_score_drives_pct
from m
left join spans s1 on s1.contest_id = m.contest_id and s1.def_team = m.def_team and s1.period = 1
left join spans s2 on s2.contest_id = m.contest_id and s2.def_team = m.def_team and s2.period = 2
left join spans s3 on s3.contest_id = m.contest_id and s3.def_team = m.def_team and s3.period = 3
left join spans s4 on s4.contest_id = m.contest_id and s4.def_team = m.def_team and s4.period = 4
left join ds on ds.contest_id = m.contest_id and ds.def_team = m.def_team
"""

SQL["defense_stats"] = with_ctes(CONTESTS, PLAYS, DREG) + ", " + DEFENSE_Q
DEF_CTE = f"deff as (with {DEFENSE_Q})"

SQL["unit_score_rate"] = with_ctes(CONTESTS, PLAYS, REG) + f"""
, dp as (
  select contest_id, off_team, drive, period, max(drive_scored) as mx from reg group by contest_id, off_team, drive, period
), d as (
  select contest_id, off_team, drive, arg_min(mx, period) as flag from dp group by contest_id, off_team, drive
)
select contest_id, off_team as team, count(*) as ndrives, cast(sum(flag) as bigint) as score_drives,
       {r(div('sum(flag)', 'count(*)'), 3)} as score_drives_pct
from d group by contest_id, off_team
"""

SQL["period_delta"] = with_ctes(CONTESTS, PLAYS, REG) + """
, pm as (
  select contest_id, off_team, period, any_value(season) as season, any_value(week) as week, any_value(game_id) as game_id,
         max(case when off_team = home_team then total_home_score else total_away_score end) as v
  from reg group by contest_id, off_team, period
), lg as (
  select *, v - lag(v) over (partition by contest_id, off_team order by period) as dv from pm
)
select any_value(season) as season, any_value(week) as week, contest_id, any_value(game_id) as game_id, off_team as team,
       max(case when period = 1 then v end) as qtr_pts_1,
       max(case when period = 2 then dv end) as qtr_pts_2,
       max(case when period = 3 then dv end) as qtr_pts_3,
       max(case when period = 4 then dv end) as qtr_pts_4
from lg group by contest_id, off_team
"""

SQL["period_margin"] = with_ctes(CONTESTS, PLAYS, REG) + f"""
, pm as (
  select contest_id, off_team, period, any_value(season) as season, any_value(week) as week, any_value(game_id) as game_id,
         avg(off_score_post - def_score_post) as a,
         case when count(*) > 1 then arg_max(off_score_post - def_score_post, play_id)
                                   - arg_min(off_score_post - def_score_post, play_id) end as dd
  from reg group by contest_id, off_team, period
)
select any_value(season) as season, any_value(week) as week, contest_id, any_value(game_id) as game_id, off_team as team,
       {r('avg(a)', 3)} as score_diff,
       {r('max(case when period = 1 then a end)', 3)} as score_diff_qtr_1,
       {r('max(case when period = 2 then a end)', 3)} as score_diff_qtr_2,
       {r('max(case when period = 3 then a end)', 3)} as score_diff_qtr_3,
       {r('max(case when period = 4 then a end)', 3)} as score_diff_qtr_4,
       max(case when period = 1 then dd end) as dscore_diff_qtr_1,
       max(case when period = 2 then dd end) as dscore_diff_qtr_2,
       max(case when period = 3 then dd end) as dscore_diff_qtr_3,
       max(case when period = 4 then dd end) as dscore_diff_qtr_4
from pm group by contest_id, off_team
"""

SQL["possession_share"] = with_ctes(CONTESTS, PLAYS, REG) + f"""
, pd as (
  select contest_id, off_team, period, drive,
         avg(try_cast(split_part(possession_clock, ':', 1) as bigint) * 60
             + try_cast(split_part(possession_clock, ':', 2) as bigint)) as top
  from reg group by contest_id, off_team, period, drive
), side as (
  select contest_id, off_team, sum(top) as possession_sec from pd group by contest_id, off_team
)
select contest_id, off_team as team, {r('possession_sec', 4)} as possession_sec,
       {r(div('possession_sec', 'sum(possession_sec) over (partition by contest_id)'), 4)} as possession_pct
from side
"""

SQL["first_line"] = with_ctes(CONTESTS, PLAYS) + """
, one as (
  select contest_id, any_value(season) as season, any_value(week) as week, arg_min(line, play_id) as line,
         arg_min(home_team, play_id) as home_team, arg_min(away_team, play_id) as away_team
  from plays group by contest_id
)
select contest_id, season, week, line, 'home' as home_away, home_team as team from one
union all
select contest_id, season, week, line, 'away' as home_away, away_team as team from one
"""

SQL["pass_splits"] = with_ctes(CONTESTS, PLAYS) + f"""
, p as (
  select *, sum(value_added) over (partition by contest_id, off_team order by play_id
                                   rows between unbounded preceding and current row) as cum
  from plays where off_team is not null
)
select contest_id, off_team as team, any_value(season) as season, any_value(week) as week, any_value(game_id) as game_id,
       cast(sum(case when air_yards >= 15 then 1 else 0 end) as bigint) as deep_pass_attempt,
       cast(sum(case when air_yards >= 15 then completed else 0 end) as bigint) as deep_pass_complete,
       cast(sum(case when air_yards < 15 then 1 else 0 end) as bigint) as short_pass_attempt,
       cast(sum(case when air_yards < 15 then completed else 0 end) as bigint) as short_pass_complete,
       cast(max(cum) as bigint) as max_value, count(*) as total_plays,
       {r('cast(max(cum) as double) / count(*)', 4)} as value_per_play
from p group by contest_id, off_team
"""

RECORD = f"""
rec0 as (
  select *, cast(case when own_score > opp_score then 1 when own_score <= opp_score then 0 end as bigint) as win
  from sides
), rec1 as (
  select *,
         count(*) over ({RUN}) as games,
         sum(win) over ({RUN}) as win_total,
         sum(is_home) over ({RUN}) as home_games,
         sum(win * is_home) over ({RUN}) as home_win,
         sum(1 - is_home) over ({RUN}) as away_games,
         sum(win * (1 - is_home)) over ({RUN}) as away_win,
         lag(gameday) over ({PREV}) as prev_gameday
  from rec0
), record as (
  select season, week, gameday, contest_id, game_id, team, opponent, home_away, is_home,
         cast(coalesce(datediff('day', prev_gameday, gameday), 7) as bigint) as rest_days,
         win, own_score, opp_score, own_score - opp_score as spread,
         cast(games as bigint) as games, cast(win_total as bigint) as win_total,
         cast(home_win as bigint) as home_win, cast(away_win as bigint) as away_win,
         {r(div('win_total', 'games'), 3)} as win_pct,
         {r('coalesce(' + div('home_win', 'home_games') + ', 0.0)', 3)} as home_win_pct,
         {r('coalesce(' + div('away_win', 'away_games') + ', 0.0)', 3)} as away_win_pct
  from rec1
)"""

BEFORE = "partition by season, team order by gameday, contest_id rows between unbounded preceding and 1 preceding"


def strict_prev_mean(col: str, digits: int = 3, frame: str = BEFORE) -> str:
    return r(f"case when count(*) over ({frame}) = count({col}) over ({frame}) then avg({col}) over ({frame}) end", digits)


SQL["season_to_date_mean"] = with_ctes(CONTESTS, SIDES, RECORD) + f"""
select season, team, contest_id, cast(gameday as varchar) as gameday,
       {strict_prev_mean('spread')} as spread, {strict_prev_mean('own_score')} as own_score,
       {strict_prev_mean('opp_score')} as opp_score
from record
"""

SQL["lagged_record"] = with_ctes(CONTESTS, SIDES, RECORD) + f"""
select season, team, contest_id, cast(gameday as varchar) as gameday,
       {r(f'lag(win_pct) over ({PREV})', 4)} as win_pct,
       {r(f'lag(home_win_pct) over ({PREV})', 4)} as home_win_pct,
       {r(f'lag(away_win_pct) over ({PREV})', 4)} as away_win_pct
from record
"""

SQL["margin"] = with_ctes(CONTESTS, SIDES, RECORD) + f"""
select season, team, opponent, contest_id, cast(gameday as varchar) as gameday, home_away, spread,
       {r(f'lag(win_pct) over ({PREV})', 4)} as win_pct,
       {r(f'lag(home_win_pct) over ({PREV})', 4)} as home_win_pct,
       {r(f'lag(away_win_pct) over ({PREV})', 4)} as away_win_pct,
       {strict_prev_mean('spread', 4)} as spread_lag
from record
"""

SQL["locf"] = with_ctes(CONTESTS, SIDES, RECORD) + f"""
, h as (
  select *, case when is_home = 1 then {div('home_win', 'games')} end as home_row_value
  from record
)
select season, team, contest_id, cast(gameday as varchar) as gameday, home_row_value,
       last_value(home_row_value ignore nulls) over ({RUN}) as home_row_value_locf
from h
"""

SQL["rest_days"] = with_ctes(CONTESTS, SIDES, RECORD) + """
select season, team, contest_id, cast(gameday as varchar) as gameday, rest_days,
       case when rest_days < 7 then 'short' when rest_days = 7 then 'normal' when rest_days > 7 then 'long' end as rest
from record
"""

SQL["wlt_pct"] = with_ctes(CONTESTS, SIDES) + f"""
, t as (
  select *,
         cast(case when own_score > opp_score then 1 else 0 end as bigint) as win,
         cast(case when own_score < opp_score then 1 else 0 end as bigint) as loss,
         cast(case when own_score = opp_score then 0.5 else 0.0 end as double) as tie
  from sides
), c as (
  select *, count(*) over ({RUN}) as games_played, sum(win) over ({RUN}) as win_csum,
         sum(loss) over ({RUN}) as loss_csum, sum(tie) over ({RUN}) as tie_csum
  from t
)
select season, team, opponent, contest_id, cast(gameday as varchar) as gameday, home_away, win, loss, tie,
       cast(games_played as bigint) as games_played, cast(win_csum as bigint) as win_csum,
       cast(loss_csum as bigint) as loss_csum, {r('(win_csum + tie_csum) / games_played', 4)} as win_pct
from c
"""

TEAM_RUN8 = "partition by team order by season, gameday, contest_id rows between 8 preceding and 1 preceding"
SQL["lag_win_pct"] = with_ctes(CONTESTS, SIDES, RECORD) + f"""
, t as (select *, {r(f'avg(win_pct) over ({TEAM_RUN8})', 4)} as m from record)
select season, team, contest_id, cast(gameday as varchar) as gameday, win_pct,
       case when m is null and win_pct = 1 then 1.0 when m is null and win_pct = 0 then 0.0 else m end as win_pct_rmean
from t
"""


def _player_roll(col: str, p: int) -> str:
    return r(f"avg({col}) over (partition by player_id order by ts, event_id rows between {p} preceding and 1 preceding)", 4)


SQL["trailing_mean_p"] = """
with pe as (
  select user_id as player_id, ts, event_id, value, cast(json_extract_string(props, '$.k') as bigint) as k from events
)
select player_id, cast(ts as varchar) as ts, event_id, value, k, """ + ",\n       ".join(
    f"{_player_roll(c, p)} as {c}_lag1_roll_{p}" for c in ("value", "k") for p in (1, 2, 4, 8, 16)
) + "\nfrom pe\n"

ELO = """
g as (
  select season, contest_id, gameday, home_team, away_team,
         case when home_score > away_score then 1.0 else 0.0 end as w,
         cast(case when away_score > home_score then 1 else 0 end as bigint) as aw,
         row_number() over (partition by season order by gameday, contest_id) as rn
  from contests
), tm as (
  select team, cast(row_number() over (order by team) as integer) as ti
  from (select home_team as team from contests union select away_team from contests)
), g2 as (
  select g.*, h.ti as hi, a.ti as ai from g join tm h on h.team = g.home_team join tm a on a.team = g.away_team
), walk(season, rn, ratings, rh, ra) as (
  select season, cast(0 as bigint), list_transform(range((select count(*) from tm)), lambda x: 1500.0::double),
         cast(null as double), cast(null as double)
  from (select distinct season from g2)
  union all
  select season, rn, list_transform(ratings, lambda x, i: case when i = hi then x + d when i = ai then x - d else x end),
         ratings[hi] + d, ratings[ai] - d
  from (
    select w.season, w.rn + 1 as rn, w.ratings, g2.hi, g2.ai,
           20.0 * (g2.w - 1.0 / (1.0 + pow(10.0, (w.ratings[g2.ai] - w.ratings[g2.hi]) / 400.0))) as d
    from walk w join g2 on g2.season = w.season and g2.rn = w.rn + 1
  )
), post as (
  select g2.season, g2.contest_id, g2.gameday, g2.home_team as team, g2.away_team as opponent, 'home' as home_away,
         cast(g2.w as bigint) as win, walk.rh as elo
  from g2 join walk on walk.season = g2.season and walk.rn = g2.rn
  union all
  select g2.season, g2.contest_id, g2.gameday, g2.away_team as team, g2.home_team as opponent, 'away' as home_away,
         g2.aw as win, walk.ra as elo
  from g2 join walk on walk.season = g2.season and walk.rn = g2.rn
), elo as (
  select *, lag(elo) over (partition by season, team order by gameday, contest_id) as prior_elo from post
)"""

# ratings by week, for the queries that rate so
PERIOD_ELO = """
g as (
  select season, contest_id, gameday, week, home_team, away_team,
         case when home_score > away_score then 1 else 0 end as w,
         cast(case when away_score > home_score then 1 else 0 end as bigint) as aw
  from contests
), tm as (
  select team, cast(row_number() over (order by team) as integer) as ti
  from (select home_team as team from contests union select away_team from contests)
), pair_week as (
  select season, week, home_team, away_team, count(*) as n, sum(w) as wins from g group by season, week, home_team, away_team
), pv as (
  select q.season, q.week, h.ti as i, a.ti as o, 1.0::double as s, n, wins from pair_week q join tm h on h.team = home_team join tm a on a.team = away_team
  union all
  select q.season, q.week, a.ti, h.ti, -1.0::double, n, wins from pair_week q join tm h on h.team = home_team join tm a on a.team = away_team
), wk as (
  select season, week, row_number() over (partition by season order by week) as rn,
         list(struct_pack(i := i, o := o, s := s, n := n, wins := wins) order by i, o, s) as games
  from pv group by season, week
), walk(season, rn, before, ratings) as (
  select season, cast(0 as bigint), cast(null as double[]), list_transform(range((select count(*) from tm)), lambda x: 1500.0::double)
  from (select distinct season from wk)
  union all
  select w.season, w.rn + 1, w.ratings,
         list_transform(w.ratings, lambda x, j: x + coalesce(list_sum(list_transform(list_filter(wk.games, lambda e: e.i = j),
           lambda e: e.s * 20.0 * (e.wins - e.n / (1.0 + pow(10.0, (w.ratings[e.o] - x) * e.s / 400.0))))), 0.0))
  from walk w join wk on wk.season = w.season and wk.rn = w.rn + 1
), pe as (
  select wk.season, wk.week, tm.team, walk.ratings[tm.ti] as elo,
         case when wk.week > (select min(week) from pv where pv.season = wk.season and pv.i = tm.ti) then walk.before[tm.ti] end as prior_elo
  from walk join wk on wk.season = walk.season and wk.rn = walk.rn, tm
), elo as (
  select g.season, g.contest_id, g.gameday, g.home_team as team, g.away_team as opponent, 'home' as home_away,
         cast(g.w as bigint) as win, pe.elo, pe.prior_elo
  from g join pe on pe.season = g.season and pe.week = g.week and pe.team = g.home_team
  union all
  select g.season, g.contest_id, g.gameday, g.away_team as team, g.home_team as opponent, 'away' as home_away,
         g.aw as win, pe.elo, pe.prior_elo
  from g join pe on pe.season = g.season and pe.week = g.week and pe.team = g.away_team
)"""

SQL["elo"] = "with recursive " + CONTESTS.strip() + ",\n" + ELO.strip() + f"""
select season, contest_id, cast(gameday as varchar) as gameday, team, opponent, home_away, win, {r('elo', 4)} as elo,
       {r('prior_elo', 4)} as prior_elo from elo
"""

SQL["elo_top20"] = "with recursive " + CONTESTS.strip() + ",\n" + ELO.strip() + f"""
, m as (select season, team, {r('avg(elo)', 4)} as mean_elo from elo group by season, team)
select * from (select 'best' as side, season, team, mean_elo from m order by mean_elo desc, season, team limit 20)
union all
select * from (select 'worst' as side, season, team, mean_elo from m order by mean_elo asc, season, team limit 20)
"""

_PRE_REG = with_ctes(CONTESTS, PLAYS, REG)
POSS_CTE = "poss as (with " + SQL["possession_share"][len(_PRE_REG):].lstrip().lstrip(",") + ")"
MARG_CTE = "marg as (with " + SQL["period_margin"][len(_PRE_REG):].lstrip().lstrip(",") + ")"

OFFENSE_MEANS = ["third_down_pct", "turnovers", "value_added", "score_drives", "score_drives_pct", "score_diff", "possession_sec", "possession_pct"]
DEFENSE_MEANS = ["def_third_down_pct", "def_turnovers", "def_value_added", "def_score_drives", "def_score_drives_pct"]
CHANGES = [f"dscore_diff_qtr_{k}" for k in range(1, 5)]
PERIOD_MEANS = [
    "ndrives", "def_ndrives", "pts_scored", *[f"qtr_pts_{k}" for k in range(1, 5)], *[f"score_diff_qtr_{k}" for k in range(1, 5)], *CHANGES,
    *[f"def_qtr_pts_{k}" for k in range(1, 5)],
]
RECORD_LAGS = ["win_pct", "home_win_pct", "away_win_pct"]

def _feature_source(c: str) -> str:
    """The subquery that has a column of the side table."""
    if c.startswith("def_"):
        return f"d.{c}"
    if c.startswith("possession"):
        return f"p.{c}"
    return f"m.{c}" if "score_diff_qtr" in c else f"o.{c}"


FEATURE_BASE = "with recursive " + ",\n".join(
    c.strip() for c in (CONTESTS, SIDES, PLAYS, REG, DREG, RECORD, ELO, OFF_CTE, DEF_CTE, POSS_CTE, MARG_CTE)
) + """,
st as (
  select rc.*, k.line, """ + ", ".join(_feature_source(c) for c in OFFENSE_MEANS + DEFENSE_MEANS + PERIOD_MEANS) + """, e.elo, e.prior_elo
  from record rc
  left join contests k on k.contest_id = rc.contest_id
  left join off o on o.contest_id = rc.contest_id and o.team = rc.team
  left join deff d on d.contest_id = rc.contest_id and d.team = rc.team
  left join poss p on p.contest_id = rc.contest_id and p.team = rc.team
  left join marg m on m.contest_id = rc.contest_id and m.team = rc.team
  left join elo e on e.contest_id = rc.contest_id and e.team = rc.team
)"""


def scaled_prev_mean(col: str, digits: int = 3, input_digits: int = 3, frame: str = BEFORE) -> str:
    scale = 10 ** input_digits
    num = f"sum(cast(round({col} * {scale}) as bigint)) over ({frame})"
    return r(f"{div(num, f'count({col}) over ({frame})')} / {float(scale)}", digits)


def _prior_select(mean_cols: list[str], lag_cols: list[str]) -> str:
    parts = [f"{scaled_prev_mean(c, 3)} as {c}" for c in mean_cols]
    parts += [f"{r('prior_elo' if c == 'elo' else f'lag({c}) over ({PREV})', 4)} as {c}" for c in lag_cols]
    return ",\n         ".join(parts)


def _matchup_sql(base_cols: list[str], feats: list[str], opp_feats: list[str], label: str = "win") -> str:
    sel = ["h.season", "h.week", "cast(h.gameday as varchar) as gameday", "h.contest_id", "h.game_id", "h.team",
           "h.opponent", f"h.{label}"] + [f"h.{c}" for c in feats] + [f"a.{c} as opp_{c}" for c in opp_feats]
    conds = [f"h.{c} is not null" for c in feats] + [f"a.{c} is not null" for c in opp_feats]
    return (
        "select " + ",\n       ".join(sel)
        + "\nfrom fl h left join fl a on a.contest_id = h.contest_id and a.home_away = 'away'\n"
        + "where h.home_away = 'home' and " + " and ".join(conds) + "\n"
    )


PREGAME_FEATURES = ["line", "home_fav", "abs_spread_line", "rest_days", *RECORD_LAGS, "elo", *OFFENSE_MEANS, *DEFENSE_MEANS]
OPP_FEATURES = ["rest_days", *RECORD_LAGS, "elo", *OFFENSE_MEANS, *DEFENSE_MEANS]

PERIOD_FEATURE_BASE = FEATURE_BASE.replace(ELO.strip(), PERIOD_ELO.strip())

SQL["pregame_features"] = PERIOD_FEATURE_BASE + f""",
pr as (
  select season, week, gameday, contest_id, game_id, team, opponent, home_away, win, line, rest_days,
         {_prior_select(OFFENSE_MEANS + DEFENSE_MEANS, RECORD_LAGS + ['elo'])}
  from st
), fl as (
  select *, cast(case when line > 0 then 1 else 0 end as bigint) as home_fav, abs(line) as abs_spread_line from pr
)
""" + _matchup_sql([], PREGAME_FEATURES, OPP_FEATURES)

REDUCED = ["spread", "turnovers", *RECORD_LAGS, "elo"]
SQL["reduced_features"] = FEATURE_BASE + f""",
fl as (
  select season, week, gameday, contest_id, game_id, team, opponent, home_away, win,
         {_prior_select(['spread', 'turnovers'], RECORD_LAGS + ['elo'])}
  from st
)
""" + _matchup_sql([], REDUCED, REDUCED)

_POST_FEATS = ["rest_days", *RECORD_LAGS, "elo", *OFFENSE_MEANS, *DEFENSE_MEANS, *PERIOD_MEANS]
SQL["postgame_features"] = PERIOD_FEATURE_BASE + """,
t as (
  select season, week, contest_id, team, opponent, home_away, win, own_score as points_for, opp_score as points_against,
         spread, line, cast(case when line > 0 then 1 else 0 end as bigint) as home_fav,
         cast(case when (home_away = 'home' and line > 0) or (home_away = 'away' and line < 0) then 1 else 0 end as bigint) as fav,
         abs(line) as abs_spread_line, """ + ", ".join(r("elo", 4) + " as elo" if c == "elo" else c for c in _POST_FEATS) + """
  from st
)
select t.*, """ + ", ".join(f"o.{c} as opp_{c}" for c in _POST_FEATS) + """
from t left join t o on o.contest_id = t.contest_id and o.team = t.opponent
"""

SQL["favorite_flags"] = with_ctes(CONTESTS, SIDES) + """
select contest_id, team, home_away, line,
       case when line = 0 then 'even' when (home_away = 'home' and line > 0) or (home_away = 'away' and line < 0) then 'favourite'
            else 'underdog' end as fav_label,
       cast(case when line > 0 then 1 else 0 end as bigint) as home_fav,
       cast(case when home_away = 'home' and line > 0 then 1 when home_away = 'away' and line < 0 then 1 else 0 end as bigint) as fav,
       abs(line) as abs_spread_line
from sides
"""

PRED = f"""
eg as (select * from elo),
pre as (
  select contest_id, team, home_away,
         coalesce(prior_elo, 1500.0) as pre_elo
  from eg
), pred0 as (
  select k.season, k.week, k.contest_id, k.home_team as team, k.line, h.pre_elo as home_pre, a.pre_elo as away_pre,
         cast(case when k.home_score > k.away_score then 1 else 0 end as bigint) as truth,
         cast(case when k.line > 0 then 1 else 0 end as bigint) as fav_pick,
         {r('1.0 / (1.0 + pow(10.0, (a.pre_elo - h.pre_elo) / 400.0))', 6)} as prob,
         k.home_score - k.away_score as actual_margin,
         {r('(h.pre_elo - a.pre_elo) / 25.0', 4)} as model_margin
  from contests k
  join pre h on h.contest_id = k.contest_id and h.home_away = 'home'
  join pre a on a.contest_id = k.contest_id and a.home_away = 'away'
), pred as (
  select *, cast(case when prob >= 0.5 then 1 else 0 end as bigint) as model_pick from pred0
)"""

PRED_BASE = "with recursive " + ",\n".join(c.strip() for c in (CONTESTS, ELO, PRED)) + "\n"
PERIOD_PRED_BASE = PRED_BASE.replace(ELO.strip(), PERIOD_ELO.strip())

SQL["confusion"] = PRED_BASE + f"""
, cells as (select model_pick as pred, truth, count(*) as n from pred group by model_pick, truth)
select pred, truth, n, {r('n / sum(n) over ()', 6)} as share,
       case when pred = truth then 'good' else 'bad' end as outcome
from cells
"""

_CM = f"""
, c as (
  select cast(sum(case when model_pick = 1 and truth = 1 then 1 else 0 end) as bigint) as tp,
         cast(sum(case when model_pick = 1 and truth = 0 then 1 else 0 end) as bigint) as fp,
         cast(sum(case when model_pick = 0 and truth = 1 then 1 else 0 end) as bigint) as fn,
         cast(sum(case when model_pick = 0 and truth = 0 then 1 else 0 end) as bigint) as tn
  from pred
), d as (
  select *, cast(tp as double) as dtp, cast(fp as double) as dfp, cast(fn as double) as dfn, cast(tn as double) as dtn from c
), e as (
  select *, dtp + dfp + dfn + dtn as dn,
         {div('dtp + dtn', 'dtp + dfp + dfn + dtn')} as acc,
         {div('(dtp + dfp) * (dtp + dfn) + (dfn + dtn) * (dfp + dtn)', '(dtp + dfp + dfn + dtn) * (dtp + dfp + dfn + dtn)')} as pe,
         {div('dtp', 'dtp + dfn')} as sens, {div('dtn', 'dtn + dfp')} as spec
  from d
)
select tp, fp, fn, tn, tp + fp + fn + tn as n,
       {r('acc', 6)} as accuracy, {r('1 - acc', 6)} as misclassification,
       {r(div('acc - pe', '1 - pe'), 6)} as kappa, {r('sens', 6)} as sensitivity, {r('spec', 6)} as specificity,
       {r(div('dtp', 'dtp + dfp'), 6)} as precision, {r(div('dtn', 'dtn + dfn'), 6)} as npv,
       {r('sens + spec - 1', 6)} as j_index
from e
"""
SQL["class_metrics"] = PRED_BASE + _CM

SQL["log_loss"] = PRED_BASE + f"""
select count(*) as n,
       {r("avg(case when truth = 1 then -ln(least(greatest(prob, 1e-15), 1 - 1e-15)) else -ln(1 - least(greatest(prob, 1e-15), 1 - 1e-15)) end)", 6)} as log_loss
from pred
"""

SQL["roc_points"] = PRED_BASE + f"""
, st as (
  select prob as score, cast(sum(case when truth = 1 then 1 else 0 end) as bigint) as pos,
         cast(sum(case when truth = 0 then 1 else 0 end) as bigint) as neg
  from pred group by prob
), cum as (
  select score, sum(pos) over (order by score desc rows between unbounded preceding and current row) as tp,
         sum(neg) over (order by score desc rows between unbounded preceding and current row) as fp,
         sum(pos) over () as P, sum(neg) over () as N
  from st
)
select score as threshold, cast(tp as bigint) as tp, cast(fp as bigint) as fp,
       {r(div('tp', 'P'), 6)} as tpr, {r(div('fp', 'N'), 6)} as fpr
from cum
"""

SQL["roc_auc"] = PRED_BASE + f"""
, pos as (select prob from pred where truth = 1), neg as (select prob from pred where truth = 0),
st as (
  select prob as score, sum(case when truth = 1 then 1 else 0 end) as p, sum(case when truth = 0 then 1 else 0 end) as n
  from pred group by prob
), cum as (
  select *, sum(n) over (order by score rows between unbounded preceding and 1 preceding) as below from st
)
select cast(sum(p) as bigint) as positives, cast(sum(n) as bigint) as negatives,
       {r(div('sum(p * coalesce(below, 0)) + sum(p * n) / 2.0', 'sum(p) * sum(n)'), 6)} as roc_auc
from cum
"""

SQL["pick_accuracy"] = PRED_BASE + f"""
select season, count(*) as n,
       cast(sum(case when model_pick = truth then 1 else 0 end) as bigint) as model_correct,
       cast(sum(case when fav_pick = truth then 1 else 0 end) as bigint) as favourite_correct,
       {r('sum(case when model_pick = truth then 1 else 0 end) / count(*)', 6)} as model_acc,
       {r('sum(case when fav_pick = truth then 1 else 0 end) / count(*)', 6)} as favourite_acc
from pred group by season
"""

SQL["disagreement"] = PRED_BASE + """
select season, week, contest_id, team, line, truth, fav_pick, model_pick, prob,
       case when model_pick = truth then 'model_right' else 'favourite_right' end as who
from pred where (model_pick = truth) <> (fav_pick = truth)
"""

SQL["closer_to_margin"] = PRED_BASE + f"""
, e as (
  select season, week, {r('abs(actual_margin - line)', 4)} as line_error, {r('abs(actual_margin - model_margin)', 4)} as model_error
  from pred
), c as (
  select *, case when model_error < line_error then 'model' when model_error > line_error then 'line' else 'tie' end as closer from e
)
select season, week, count(*) as n,
       cast(sum(case when closer = 'model' then 1 else 0 end) as bigint) as model_closer,
       cast(sum(case when closer = 'line' then 1 else 0 end) as bigint) as line_closer,
       {r('sum(cast(round(line_error * 10000) as bigint)) / count(*) / 10000.0', 4)} as mean_line_error,
       {r('sum(cast(round(model_error * 10000) as bigint)) / count(*) / 10000.0', 4)} as mean_model_error,
       {r('sum(case when closer = ' + "'model'" + ' then 1 else 0 end) / count(*)', 6)} as model_closer_share
from c group by season, week
"""

SQL["favourite_outcomes"] = PERIOD_PRED_BASE + f"""
, fo as (
  select season,
         cast(sum(case when fav_pick = 1 and truth = 1 then 1 else 0 end) as bigint) as tp,
         cast(sum(case when fav_pick = 1 and truth = 0 then 1 else 0 end) as bigint) as fp,
         cast(sum(case when fav_pick = 0 and truth = 1 then 1 else 0 end) as bigint) as fn,
         cast(sum(case when fav_pick = 0 and truth = 0 then 1 else 0 end) as bigint) as tn
  from pred group by season
)
select *, {r('(tp + tn) / (tp + fp + fn + tn)', 6)} as accuracy from fo
"""

SQL["correct_picks_week"] = PRED_BASE + """
select season, week, 'model' as predictor, cast(sum(case when model_pick = truth then 1 else 0 end) as bigint) as correct
from pred group by season, week
union all
select season, week, 'favourite' as predictor, cast(sum(case when fav_pick = truth then 1 else 0 end) as bigint) as correct
from pred group by season, week
"""

_CORR_COLS = ["third_down_pct", "turnovers", "value_added", "score_drives_pct", "score_diff", "ndrives"]


def _corr_rows(cols: list[str]) -> str:
    rows = []
    for a in cols:
        for b in cols:
            if a == b:
                rows.append(f"select '{a}' as var1, '{b}' as var2, {r('1.0', 4)} as value")
            else:
                rows.append(f"select '{a}' as var1, '{b}' as var2, {r(f'corr({a}, {b})', 4)} as value from off")
    return "\nunion all\n".join(rows)


SQL["corr_long"] = with_ctes(CONTESTS, PLAYS, REG, OFF_CTE) + _corr_rows(_CORR_COLS) + "\n"

SQL["corr_target"] = with_ctes(CONTESTS, PLAYS, REG, OFF_CTE) + ", t as (select o.*, cast(case when o.score_diff > 0 then 1 else 0 end as bigint) as won from off o)\n" + "\nunion all\n".join(
    f"select '{c}' as variable, {r(f'corr({c}, won)', 4)} as corr, {r(f'abs(corr({c}, won))', 4)} as abs_corr from t"
    for c in _CORR_COLS
) + "\n"

SQL["histogram"] = with_ctes(CONTESTS) + """
select season, floor((home_score - away_score) / 5.0) * 5.0 as bin_start, count(*) as n
from contests group by season, floor((home_score - away_score) / 5.0) * 5.0
"""

SQL["class_balance"] = with_ctes(CONTESTS) + f"""
, c as (select cast(case when home_score > away_score then 1 else 0 end as bigint) as home_win, count(*) as n from contests group by 1)
select home_win, n, {r('n / sum(n) over ()', 4)} as share from c
"""

SQL["season_means"] = with_ctes(CONTESTS, SIDES, RECORD) + f"""
, s as (select season, team, sum(win) as w from record group by season, team)
select team, {r('avg(w)', 4)} as mean_wins, count(*) as groups from s group by team
"""

SQL["five_number"] = with_ctes(CONTESTS, SIDES) + f"""
, q as (
  select season, quantile_cont(own_score - opp_score, [0.0, 0.25, 0.5, 0.75, 1.0]) as qs from sides group by season
)
select season, unnest([0.0, 0.25, 0.5, 0.75, 1.0]::double[]) as prob, {r('unnest(qs)', 4)} as value from q
"""

SQL["home_away_wins"] = with_ctes(CONTESTS) + """
, w as (
  select season,
         cast(sum(case when home_score > away_score then 1 else 0 end) as bigint) as home_wins,
         cast(sum(case when away_score > home_score then 1 else 0 end) as bigint) as away_wins
  from contests group by season
)
select season, 'home_wins' as venue, home_wins as wins from w
union all
select season, 'away_wins' as venue, away_wins as wins from w
"""

SQL["home_fav_pct"] = with_ctes(CONTESTS) + f"""
, c as (
  select season,
         case when line > 0 then 'home' when line < 0 then 'away' else 'none' end as fav_venue,
         case when (line > 0 and home_score > away_score) or (line < 0 and away_score > home_score) then 1 else 0 end as fav_won,
         case when home_score > away_score then 1 else 0 end as home_won
  from contests
), v as (
  select season, fav_venue, count(*) as n, cast(sum(fav_won) as bigint) as fav_wins from c where fav_venue <> 'none' group by season, fav_venue
), s as (
  select season, count(*) as games, cast(sum(home_won) as bigint) as home_wins,
         cast(sum(case when fav_venue <> 'none' then fav_won else 0 end) as bigint) as fav_wins_all,
         sum(case when fav_venue <> 'none' then 1 else 0 end) as fav_games
  from c group by season
)
select s.season, s.games, {r('s.home_wins / s.games', 4)} as home_win_pct,
       {r(div('s.fav_wins_all', 's.fav_games'), 4)} as fav_win_pct,
       {r(div('h.fav_wins', 'h.n'), 4)} as home_fav_win_pct,
       {r(div('a.fav_wins', 'a.n'), 4)} as away_fav_win_pct
from s
left join v h on h.season = s.season and h.fav_venue = 'home'
left join v a on a.season = s.season and a.fav_venue = 'away'
"""

SQL["simple_lm"] = with_ctes(CONTESTS, PLAYS, REG, OFF_CTE) + f"""
select count(*) as n, {r('regr_slope(score_diff, value_added)', 4)} as slope,
       {r('regr_intercept(score_diff, value_added)', 4)} as intercept, {r('regr_r2(score_diff, value_added)', 4)} as r2
from off
"""

SQL["sides_long"] = with_ctes(CONTESTS, SIDES) + """
select season, week, cast(gameday as varchar) as gameday, contest_id, game_id, line, div_game, team, opponent, home_away,
       is_home, own_score, opp_score
from sides
"""

SQL["key_parse"] = with_ctes(CONTESTS) + """
, p as (
  select contest_id, season, week, home_team, away_team, game_id,
         cast(substr(game_id, 1, 4) as bigint) as key_season, cast(substr(game_id, 6, 2) as bigint) as key_week,
         split_part(substr(game_id, 9), '_', 1) as key_away, split_part(substr(game_id, 9), '_', 2) as key_home
  from contests
)
select contest_id, game_id, key_season, key_week, key_away, key_home,
       cast(case when key_season = season and key_week = week and key_away = away_team and key_home = home_team then 1 else 0 end as bigint) as round_trip
from p
"""

SQL["clock_seconds"] = with_ctes(CONTESTS, PLAYS) + """
select contest_id, play_id, possession_clock,
       try_cast(split_part(possession_clock, ':', 1) as bigint) * 60 + try_cast(split_part(possession_clock, ':', 2) as bigint) as seconds
from plays
"""

SQL["period_points_wide"] = with_ctes(CONTESTS, PLAYS) + "select contest_id, off_team as team, " + ", ".join(
    f"cast(sum(case when period = {k} then points end) as bigint) as pts_p{k}" for k in range(1, 8)
) + "\nfrom plays group by contest_id, off_team\n"

SQL["fill_rules"] = with_ctes(CONTESTS, PLAYS, REG) + """
, pm as (
  select contest_id, off_team, period, max(case when off_team = home_team then total_home_score else total_away_score end) as v
  from reg group by contest_id, off_team, period
), lg as (
  select *, v - lag(v) over (partition by contest_id, off_team order by period) as dv from pm
), w as (
  select contest_id, off_team as team,
         max(case when period = 1 then v end) as q1, max(case when period = 2 then dv end) as q2,
         max(case when period = 3 then dv end) as q3, max(case when period = 4 then dv end) as q4
  from lg group by contest_id, off_team
)
select contest_id, team, coalesce(q1, 0) as qtr_pts_1, coalesce(q2, 0) as qtr_pts_2, coalesce(q3, 0) as qtr_pts_3,
       coalesce(q4, 0) as qtr_pts_4,
       cast((q1 is null)::int + (q2 is null)::int + (q3 is null)::int + (q4 is null)::int as bigint) as n_missing
from w
"""

SQL["roster_names"] = """
select c_custkey as player_id, replace(lower(regexp_replace(c_name, '[^[:alnum:]]+', ' ', 'g')), ' ', '_') as name from customer
"""

_LI = '<li><a href="([^"]*)">([^<]*)</a></li>'
SQL["html_rows"] = f"""
with items as (
  select page_id, regexp_extract_all(html, '{_LI}', 1) as hrefs, regexp_extract_all(html, '{_LI}', 2) as texts from pages
), ex as (
  select page_id, hrefs, texts, unnest(generate_series(1, len(hrefs))) as pos from items
)
select page_id, cast(pos as bigint) as pos, hrefs[pos] as href, texts[pos] as text from ex
"""

SQL["json_stats"] = """
with e as (select event_type, try_cast(json_extract_string(props, '$.k') as bigint) as v from events)
select event_type, count(*) as n, count(v) as n_present, cast(sum(v) as bigint) as sum_k, min(v) as min_k, max(v) as max_k
from e group by event_type
"""

SQL["standings_rank"] = with_ctes(CONTESTS, SIDES) + f"""
, rec as (
  select season, team,
         cast(sum(case when own_score > opp_score then 1 else 0 end) as bigint) as wins,
         cast(sum(case when own_score < opp_score then 1 else 0 end) as bigint) as losses,
         cast(sum(case when own_score = opp_score then 1 else 0 end) as bigint) as ties,
         count(*) as games
  from sides where own_score is not null and opp_score is not null group by season, team
), rec2 as (
  select rec.*, {r('(wins + 0.5 * ties) / games', 4)} as win_pct, t.n_regionkey as league
  from rec left join teams t on t.team = rec.team
), rk as (
  select *, cast(row_number() over (partition by season, league order by win_pct desc, wins desc, team) as bigint) as seed
  from rec2
), lead as (select season, league, wins as lw, losses as ll from rk where seed = 1)
select rk.team, rk.season, rk.wins, rk.losses, rk.ties, rk.games, rk.win_pct, rk.league, rk.seed,
       ((lead.lw - rk.wins) + (rk.losses - lead.ll)) / 2.0 as games_behind,
       printf('%d-%d', rk.wins, rk.losses) as record
from rk join lead on lead.season = rk.season and lead.league = rk.league
"""

SQL["next_matchups"] = "with recursive " + CONTESTS.strip() + """,
contests_s as (select * from contests where season = 1998),
""" + ELO.strip().replace("from contests\n", "from contests_s\n").replace("from contests union select away_team from contests)", "from contests_s union select away_team from contests_s)") + ",\n" + SIDES.strip().replace("from contests", "from contests_s") + ",\n" + RECORD.strip() + f"""
, t as (select rc.*, e.elo from record rc left join elo e on e.contest_id = rc.contest_id and e.team = rc.team where rc.week < 27),
lastrow as (
  select *, row_number() over (partition by team order by gameday desc, contest_id desc) as rn,
         {r('avg(spread) over (partition by team)', 4)} as mean_margin
  from t
), snap as (
  select team, games, win_pct, home_win_pct, away_win_pct, {r('elo', 4)} as elo, mean_margin from lastrow where rn = 1
)
select fx.away_team, fx.home_team, fx.season, fx.week, fx.contest_id, fx.game_id, fx.line,
       h.games, h.win_pct, h.home_win_pct, h.away_win_pct, h.elo, h.mean_margin,
       a.games as opp_games, a.win_pct as opp_win_pct, a.home_win_pct as opp_home_win_pct,
       a.away_win_pct as opp_away_win_pct, a.elo as opp_elo, a.mean_margin as opp_mean_margin
from contests_s fx
left join snap h on h.team = fx.home_team
left join snap a on a.team = fx.away_team
where fx.week = 27
"""

_SPLIT = """
t as (
  select contest_id, cast(case when home_score > away_score then 1 else 0 end as bigint) as home_win,
         md5(cast(contest_id as varchar) || '-234') as h
  from contests
), rk as (
  select *, row_number() over (partition by home_win order by h, contest_id) as pos,
         count(*) over (partition by home_win) as n
  from t
), sp as (
  select contest_id, home_win, h, case when pos <= floor(0.75 * n + 0.5) then 'train' else 'test' end as split from rk
)"""

SQL["stratified_split"] = with_ctes(CONTESTS, _SPLIT) + "select contest_id, home_win, split from sp\n"

SQL["fold_counts"] = with_ctes(CONTESTS, _SPLIT) + """
, tr as (select *, row_number() over (partition by home_win order by h, contest_id) as fpos from sp where split = 'train')
select cast((fpos - 1) % 10 as integer) as fold, home_win, count(*) as n from tr group by 1, 2
"""


def scaled_prev_mean_strict(col: str, digits: int = 3, input_digits: int = 3, frame: str = BEFORE) -> str:
    scale = 10 ** input_digits
    num = f"sum(cast(round({col} * {scale}) as bigint)) over ({frame})"
    cond = f"count(*) over ({frame}) = count({col}) over ({frame}) and count({col}) over ({frame}) > 0"
    return r(f"case when {cond} then {num} / (count({col}) over ({frame})) / {float(scale)} end", digits)


_QTR = range(1, 5)
_OFF_ROLL = [
    *[f"qtr_pts_{q}" for q in _QTR], "pts_scored", "third_down_pct", "turnovers", "value_added", "score_diff",
    "possession_sec", "possession_pct", *[f"score_diff_qtr_{q}" for q in _QTR], *[f"dscore_diff_qtr_{q}" for q in _QTR],
    "ndrives", "score_drives", "score_drives_pct",
]
_DEF_ROLL = [
    *[f"def_qtr_pts_{q}" for q in _QTR], "def_value_added", "def_third_down_pct", "def_turnovers",
    "def_ndrives", "def_score_drives", "def_score_drives_pct",
]

SQL["rolling_defense"] = with_ctes(CONTESTS, PLAYS, DREG, DEF_CTE) + """
, t as (select d.*, k.gameday from deff d join contests k on k.contest_id = d.contest_id)
select season, team, contest_id, cast(gameday as varchar) as gameday, """ + ", ".join(
    f"{scaled_prev_mean_strict(c)} as {c}" for c in _DEF_ROLL) + "\nfrom t\n"

SQL["rolling_elo"] = "with recursive " + CONTESTS.strip() + ",\n" + ELO.strip() + f"""
select season, contest_id, cast(gameday as varchar) as gameday, team, home_away,
       {r('prior_elo', 4)} as elo
from elo
"""


def _group_roll(col: str, p: int) -> str:
    return r(f"avg({col}) over (partition by player_id, event_type order by ts, event_id rows between {p} preceding and 1 preceding)", 4)


SQL["trailing_mean_group"] = """
with pe as (select user_id as player_id, event_type, ts, event_id, value from events)
select player_id, event_type, cast(ts as varchar) as ts, event_id, value, """ + ", ".join(
    f"{_group_roll('value', p)} as value_lag1_roll_{p}" for p in (1, 2, 4, 8, 16)
) + "\nfrom pe\n"

SQL["player_model_input"] = f"""
with pe as (
  select user_id as player_id, ts, event_id, event_type, value, cast(json_extract_string(props, '$.k') as bigint) as k from events
), t as (
  select player_id, ts, event_id, event_type, value,
         {_player_roll('value', 4)} as value_roll, {_player_roll('k', 4)} as k_roll
  from pe
)
select player_id, cast(ts as varchar) as ts, event_id, cast(case when value > 50 then 1 else 0 end as bigint) as label,
       value_roll as value, k_roll as k
from t where event_type = 'purchase'
"""

SQL["regression_metrics"] = PRED_BASE + f"""
select count(*) as n,
       {r('sqrt(avg((model_margin - actual_margin) * (model_margin - actual_margin)))', 6)} as rmse,
       {r('avg(abs(model_margin - actual_margin))', 6)} as mae,
       {r('pow(corr(model_margin, actual_margin), 2)', 6)} as rsq
from pred
"""

SQL["game_stats"] = with_ctes(CONTESTS, PLAYS, REG, OFF_CTE, POSS_CTE, MARG_CTE) + """
select o.*, p.possession_sec, p.possession_pct, """ + ", ".join(
    [f"m.score_diff_qtr_{k}" for k in range(1, 5)] + [f"m.dscore_diff_qtr_{k}" for k in range(1, 5)]
) + """
from off o
left join poss p on p.contest_id = o.contest_id and p.team = o.team
left join marg m on m.contest_id = o.contest_id and m.team = o.team
"""

SQL["yards_long"] = with_ctes(CONTESTS, PLAYS) + """
, g as (
  select season, off_team as team,
         cast(sum(case when completed = 1 then air_yards else 0 end) as bigint) as pass_yards,
         cast(sum(case when completed = 0 then air_yards else 0 end) as bigint) as run_yards
  from plays where off_team is not null group by season, off_team
)
select season, team, 'pass_yards' as kind, pass_yards as yards from g
union all
select season, team, 'run_yards' as kind, run_yards as yards from g
"""

SQL["half_ppr"] = f"""
with e as (select user_id as player_id, event_type, value + 0.5 * cast(json_extract_string(props, '$.k') as bigint) as pts from events),
g as (select player_id, event_type, {r('sum(pts)', 4)} as total, {r('avg(pts)', 4)} as mean from e group by player_id, event_type)
select player_id, event_type, 'total' as measure, total as half_ppr from g
union all
select player_id, event_type, 'mean' as measure, mean as half_ppr from g
"""

SQL["metric_by_wins"] = with_ctes(CONTESTS, SIDES, RECORD, PLAYS, REG, OFF_CTE) + f"""
, j as (select rc.season, rc.team, rc.win, o.turnovers from record rc left join off o on o.contest_id = rc.contest_id and o.team = rc.team),
per as (select season, team, cast(sum(win) as bigint) as wins, avg(turnovers) as m from j group by season, team)
select wins, {r('avg(m)', 4)} as mean_turnovers, count(*) as team_seasons from per group by wins
"""

SQL["season_value_total"] = with_ctes(CONTESTS, PLAYS) + f"""
, p as (
  select *, sum(value_added) over (partition by contest_id, off_team order by play_id
                                   rows between unbounded preceding and current row) as cum
  from plays where off_team is not null
), g as (
  select contest_id, off_team as team, any_value(season) as season, cast(max(cum) as bigint) as max_value from p group by contest_id, off_team
), d as (select g.*, k.gameday from g join contests k on k.contest_id = g.contest_id)
select season, team, contest_id, cast(gameday as varchar) as gameday, max_value,
       cast(sum(max_value) over ({RUN}) as bigint) as season_total
from d
"""

SPREAD_MEANS = [*OFFENSE_MEANS, *DEFENSE_MEANS, "spread_lag"]
SPREAD_FEATURES = ["line", "rest", *RECORD_LAGS, *SPREAD_MEANS]
SPREAD_OPP = ["rest", *RECORD_LAGS, *SPREAD_MEANS]

def _carried(side: str, prefix: str) -> list[str]:
    pts = {n: " + ".join(f"{side}.{c}_{k}" for k in range(1, 5)) for n, c in (("pts_for", "qtr_pts"), ("pts_against", "def_qtr_pts"))}
    cols = [f"coalesce({side}.{c}, 0.0) as {prefix}{c}" if c in CHANGES else f"{side}.{c} as {prefix}{c}" for c in PERIOD_MEANS]
    return cols + [f"{e} as {prefix}{n}" for n, e in pts.items()] + [f"({pts['pts_for']}) - ({pts['pts_against']}) as {prefix}point_diff"]


SQL["spread_features"] = PERIOD_FEATURE_BASE + f""",
pr as (
  select season, week, gameday, contest_id, game_id, team, opponent, home_away, spread, line,
         case when rest_days < 7 then 'short' when rest_days = 7 then 'normal' when rest_days > 7 then 'long' end as rest,
         {_prior_select(OFFENSE_MEANS + DEFENSE_MEANS + PERIOD_MEANS, RECORD_LAGS)},
         {scaled_prev_mean('spread', 3)} as spread_lag
  from st
), fl as (select * from pr)
""" + _matchup_sql([], SPREAD_FEATURES, SPREAD_OPP, label="spread").replace("\nfrom fl h", ",\n       " + ",\n       ".join(_carried("h", "") + _carried("a", "opp_")) + "\nfrom fl h", 1)

SQL["rolling_offense"] = with_ctes(CONTESTS, PLAYS, REG, OFF_CTE, POSS_CTE, MARG_CTE) + ", gs as (" + SQL["game_stats"].split(MARG_CTE)[1].strip() + """)
, t as (select gs.*, k.gameday from gs join contests k on k.contest_id = gs.contest_id)
select season, team, contest_id, cast(gameday as varchar) as gameday, """ + ", ".join(
    f"{scaled_prev_mean_strict(c)} as {c}" for c in _OFF_ROLL) + "\nfrom t\n"

SQL["roc_points_by_fold"] = PERIOD_PRED_BASE + f"""
, fd as (
  select truth, prob,
         cast((row_number() over (partition by truth order by md5(cast(contest_id as varchar) || '-234'), contest_id) - 1) % 10 as varchar) as fold
  from pred
), both_ as (select fold as curve, truth, prob from fd union all select 'all', truth, prob from fd),
st as (
  select curve, prob as score, cast(sum(case when truth = 1 then 1 else 0 end) as bigint) as pos,
         cast(sum(case when truth = 0 then 1 else 0 end) as bigint) as neg
  from both_ group by curve, prob
), cum as (
  select curve, score, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over (partition by curve) as P, sum(neg) over (partition by curve) as N
  from st window w as (partition by curve order by score desc rows between unbounded preceding and current row)
)
select curve, score as threshold, cast(tp as bigint) as tp, cast(fp as bigint) as fp,
       {r(div('tp', 'P'), 6)} as tpr, {r(div('fp', 'N'), 6)} as fpr
from cum
"""

# least squares with two regressors in closed form; the t distribution by Simpson's rule
SQL["multiple_lm"] = with_ctes(CONTESTS, PLAYS, REG, OFF_CTE) + f"""
, d as (select score_diff::double as y, value_added::double as a, turnovers::double as b from off
        where score_diff is not null and value_added is not null and turnovers is not null),
g as (
  select count(*)::double as n, avg(y) as my, avg(a) as ma, avg(b) as mb, var_pop(y) * count(*) as syy, var_pop(a) * count(*) as saa,
         var_pop(b) * count(*) as sbb, covar_pop(a, b) * count(*) as sab, covar_pop(a, y) * count(*) as say, covar_pop(b, y) * count(*) as sby
  from d
), c as (
  select *, saa * sbb - sab * sab as det, (say * sbb - sby * sab) / (saa * sbb - sab * sab) as ba, (sby * saa - say * sab) / (saa * sbb - sab * sab) as bb
  from g
), e as (select *, syy - ba * say - bb * sby as rss, n - 3 as df from c),
tt as (
  select 0 as ord, '(intercept)' as term, my - ba * ma - bb * mb as est,
         sqrt(rss / df * (1 / n + (ma * ma * sbb - 2 * ma * mb * sab + mb * mb * saa) / det)) as se, n, df, 1 - rss / syy as r2 from e
  union all select 1, 'value_added', ba, sqrt(rss / df * sbb / det), n, df, 1 - rss / syy from e
  union all select 2, 'turnovers', bb, sqrt(rss / df * saa / det), n, df, 1 - rss / syy from e
), tv as (select *, est / se as t, least(abs(est / se), 40.0) / 4000 as h from tt),
pv as (
  select tv.term, 1 - 2 * exp(lgamma((any_value(df) + 1) / 2) - lgamma(any_value(df) / 2)) / sqrt(any_value(df) * pi()) * any_value(h) / 3
           * sum((case when i = 0 or i = 4000 then 1 when i % 2 = 1 then 4 else 2 end) * pow(1 + (i * h) * (i * h) / df, -(df + 1) / 2)) as p
  from tv, (select unnest(range(4001)) as i) group by tv.term
)
select tv.term, {r('est', 4)} as estimate, {r('se', 4)} as std_error, {r('t', 4)} as t_value, {r('greatest(p, 0.0)', 6)} as p_value,
       cast(n as bigint) as n, {r('r2', 4)} as r2, {r('1 - (1 - r2) * (n - 1) / df', 4)} as adj_r2
from tv join pv on pv.term = tv.term
"""

SQL["upsample_counts"] = """
with c as (select cast(label = 0 as integer) as label, count(*) as n from embeddings group by 1)
select label, case when label = 1 then greatest(n, coalesce((select n from c where label = 0), 0)) else n end as n from c
"""

SQL["html_table_rows"] = f"""
select s_nationkey as page_id, s_suppkey as supplier, s_name as name, case when s_suppkey % 7 <> 0 then s_acctbal::double end as balance
from supplier
"""

SQL["fixture_rows"] = with_ctes(CONTESTS) + """
select season, week, contest_id, away_team, home_team, printf('%d_%02d_%s_%s', season, week, away_team, home_team) as game_id from contests
"""

SQL["team_table"] = with_ctes(CONTESTS, SIDES) + """
select season, lower(team) as team, cast(count(*) as double) as games,
       cast(sum(case when own_score > opp_score then 1 else 0 end) as double) as wins, cast(sum(own_score) as double) as points, team as team_abb
from sides group by season, team
"""

SQL["standings_json"] = with_ctes(CONTESTS, SIDES) + f"""
, b as (
  select season, team, case when own_score > opp_score then 1 else 0 end as w, is_home, own_score, opp_score from sides
), a as (
  select season, team, sum(w) as wins, sum(1 - w) as losses, round(sum(w) / count(*) * 10000.0) / 10000.0 as win_pct,
         sum(own_score) as pf, sum(opp_score) as pa, sum(w * is_home) as hw, sum((1 - w) * is_home) as hl,
         sum(w * (1 - is_home)) as aw, sum((1 - w) * (1 - is_home)) as al
  from b group by season, team
), l as (
  select a.*, t.team_id, r_name as conf from a join (select n_nationkey as team_id, team, cast(n_regionkey as varchar) as r_name from teams) t using (team)
), s as (select *, max(wins - losses) over (partition by season, conf) as top from l)
select conf, season, cast(team_id as varchar) as team_id, team as team_abb,
       cast(row_number() over (partition by conf, season order by win_pct desc, (top - (wins - losses)) / 2.0, cast(team_id as varchar)) as double) as seed,
       cast(wins as double) as wins, cast(losses as double) as losses, win_pct, (top - (wins - losses)) / 2.0 as g_behind,
       cast(pf as double) as pts_for, cast(pa as double) as pts_against, cast(pf - pa as double) as pts_diff,
       cast(hw as bigint) as home_wins, cast(hl as bigint) as home_losses, cast(aw as bigint) as away_wins, cast(al as bigint) as away_losses
from s
"""

SQL["smote_counts"] = """
with c as (select cast(label = 0 as integer) as label, count(*) as n from embeddings group by 1),
x as (select coalesce((select n from c where label = 1), 0) as mino, coalesce((select n from c where label = 0), 0) as maj)
select label, cast(0 as integer) as synthetic, n from c
union all
select 1, 1, cast(floor(0.9 * maj) as bigint) - mino from x where floor(0.9 * maj) > mino and mino >= 2
"""

SQL["knn_vote"] = """
with e as (select vec_id as id, label, list_transform(embedding, lambda x: x::double) as v from embeddings),
h as (select *, row_number() over (partition by label order by md5(cast(id as varchar) || '-234'), id) as pos, count(*) over (partition by label) as n from e),
s as (select id, label, v, case when pos <= floor(0.75 * n + 0.5) then 'train' else 'test' end as split from h),
d as (
  select q.id, q.label, t.id as rid, t.label as vote,
         sqrt(list_sum(list_transform(list_zip(q.v, t.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) as dist
  from (select * from s where split = 'test') q, (select * from s where split = 'train') t
), k as (select *, row_number() over (partition by id order by dist, rid) as rn from d),
votes as (select id, label, vote, count(*) as votes, avg(dist) as mean_d from k where rn <= 5 group by id, label, vote)
select id, label, vote as pred, votes
from (select *, row_number() over (partition by id order by votes desc, mean_d, vote) as r from votes) where r = 1
"""

SQL["tune_fold_sizes"] = "with pg as (" + SQL["pregame_features"] + """), sp as (
  select contest_id, win, md5(cast(contest_id as varchar) || '-234') as h,
         row_number() over (partition by win order by md5(cast(contest_id as varchar) || '-234'), contest_id) as pos,
         count(*) over (partition by win) as n
  from pg
), fd as (
  select win, (row_number() over (partition by win order by h, contest_id) - 1) % 5 as fold from sp where pos <= floor(0.75 * n + 0.5)
), sizes as (select cast(fold as integer) as fold, count(*) as n_rows, cast(sum(win) as bigint) as n_wins from fd group by fold)
select w.workflow, cast(c.candidate as bigint) as candidate, fold, n_rows, n_wins
from sizes, (values ('scaled__logistic'), ('plain__forest')) w(workflow), range(20) c(candidate)
"""

SQL["spread_split"] = "with sf as (" + SQL["spread_features"] + """), b as (
  select contest_id, spread, cast(floor(4.0 * (rank() over (order by spread) - 1) / count(*) over ()) as bigint) as bin from sf
), p as (
  select *, row_number() over (partition by bin order by md5(cast(contest_id as varchar) || '-234'), contest_id) as pos, count(*) over (partition by bin) as n from b
)
select contest_id, spread, bin, case when pos <= floor(0.75 * n + 0.5) then 'train' else 'test' end as split from p
"""

_STATE = "partition by team"
SQL["coming_week_features"] = PERIOD_FEATURE_BASE + f""",
hist as (
  select *, row_number() over (partition by team order by gameday desc, contest_id desc) as rn from st where season = 1998 and week < 27
), state0 as (
  select team, rn, gameday as last_day, """ + ", ".join(f"{r(c, 4)} as {c}" for c in (*RECORD_LAGS, "elo")) + ", " + ", ".join(
    f"{scaled_prev_mean(c, 3, frame=_STATE)} as {c}" for c in OFFENSE_MEANS + DEFENSE_MEANS) + """
  from hist
), state as (select * from state0 where rn = 1),
fx as (
  select season, week, gameday, contest_id, game_id, home_team as team, away_team as opponent, line, 'home' as home_away from contests where season = 1998 and week = 27
  union all
  select season, week, gameday, contest_id, game_id, away_team, home_team, line, 'away' from contests where season = 1998 and week = 27
), fl as (
  select fx.*, 0 as win, cast(coalesce(datediff('day', s.last_day, fx.gameday), 7) as bigint) as rest_days,
         cast(case when line > 0 then 1 else 0 end as bigint) as home_fav, abs(line) as abs_spread_line,
         """ + ", ".join(f"s.{c}" for c in (*RECORD_LAGS, "elo", *OFFENSE_MEANS, *DEFENSE_MEANS)) + """
  from fx left join state s on s.team = fx.team
)
""" + _matchup_sql([], PREGAME_FEATURES, OPP_FEATURES).replace("h.win,", "", 1)

_CONTEST_COLUMNS = [
    ("season", "bigint", "year in which the contest is played"),
    ("week", "bigint", "week of the season, from 1"),
    ("gameday", "date", "date of the contest"),
    ("contest_id", "bigint", "identifier of the contest"),
    ("game_id", "string", "season, week, away team and home team in one key"),
    ("home_team", "string", "team that plays at home"),
    ("away_team", "string", "team that travels"),
    ("home_score", "bigint", "points of the home team at the end"),
    ("away_score", "bigint", "points of the away team at the end"),
    ("line", "double", "bookmaker''s line; above 0 the home team is the favourite"),
    ("div_game", "bigint", "1 if both teams are of one division, else 0"),
]

SQL["contest_dictionary"] = with_ctes(CONTESTS) + "\nunion all\n".join(
    f"select '{c}' as column_name, cast({i} as bigint) as position, '{t}' as column_type, '{d}' as description, "
    f"count({c}) as n_filled, count(*) - count({c}) as n_missing from contests"
    for i, (c, t, d) in enumerate(_CONTEST_COLUMNS, 1)
)

SQL["second_last_score"] = with_ctes(CONTESTS, SIDES) + """
select season, team, own_score as second_last_score from sides
qualify row_number() over (partition by season, team order by gameday desc, contest_id desc) = 2
"""

SQL["team_season_ids"] = with_ctes(CONTESTS, SIDES) + """
select season, team, contest_id, dense_rank() over (order by season, team) as group_id from sides
"""

SQL["team_totals"] = with_ctes(CONTESTS, SIDES) + """
select season, team, cast(sum(own_score) as bigint) as own_score, cast(sum(opp_score) as bigint) as opp_score,
       cast(sum(is_home) as bigint) as is_home, cast(sum(div_game) as bigint) as div_game
from sides group by season, team
"""

SQL["margin_summary"] = with_ctes(CONTESTS) + f"""
, m as (select season, stddev_samp(home_score - away_score) as sd, avg(home_score - away_score) as mean from contests group by season)
select season, {r('sd', 4)} as sd, {r('mean', 4)} as mean, {r(div('mean', 'sd'), 4)} as scaled_mean from m
"""

SQL["requested_weeks"] = with_ctes(CONTESTS) + """
select season, greatest(season, 2002) as asked_season,
       least(greatest(week, 2), case when greatest(season, 2002) >= 2021 then 18 else 17 end) as asked_week, count(*) as contests
from contests group by 1, 2, 3
"""
