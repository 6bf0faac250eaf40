"""Queries over facts, rolling form, timelines, standings and insights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hockeylake.operators import features, gold, insights, trends
from hockeylake.plans.adapters import cte, table, view
from hockeylake.plans.registry import query

_ROUND = 6


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, so that the order of additions doesn't show."""
    return df.select(*(F.round(c, _ROUND).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def player_games(spark: SparkSession, d: str) -> DataFrame:
    return gold.player_game_stats(view(spark, d, "game_players"), view(spark, d, "games"), view(spark, d, "players"))


#: Rows of players' games that one task adds up, joins or sorts for windows, on average.
_ROWS_A_TASK = 150_000


def by_player(spark: SparkSession, d: str) -> DataFrame:
    """``player_games`` dealt by game, and then by player, over so many tasks that none holds more as the tables grow; what groups by game, or has windows by player, needs no further shuffle."""
    rows = table(spark, d, "lineitem")
    n = max(spark.sparkContext.defaultParallelism, -(-rows.count() // _ROWS_A_TASK))  # from the footers of its files
    players = view(spark, d, "game_players", lineitem=rows.repartition(n, "l_orderkey"))
    return gold.player_game_stats(players, view(spark, d, "games"), view(spark, d, "players")).repartition(n, "player_id")


def team_games(spark: SparkSession, d: str) -> DataFrame:
    return gold.team_game_stats(view(spark, d, "games"))


def corsi(spark: SparkSession, d: str) -> DataFrame:
    games = view(spark, d, "games")
    return gold.team_corsi(gold.team_game_stats(games), gold.shot_attempts(view(spark, d, "game_events"), games))


_PGS = (
    cte("games", "game_players", "players")
    + """, pgs AS (SELECT gp.*, g.game_date, g.season, g.game_type, split_part(p.name, ' ', 1) AS player_first_name,
  CASE WHEN contains(p.name, ' ') THEN substr(p.name, length(split_part(p.name, ' ', 1)) + 2) ELSE p.name END AS player_last_name,
  'T' || CASE WHEN is_home THEN home_team_id ELSE away_team_id END AS team_abbr, CASE WHEN shots_against > 0 THEN saves / shots_against END AS save_pct
  FROM game_players gp JOIN games g USING (game_id) LEFT JOIN players p ON p.id = gp.player_id)"""
)
_POINTS = "CASE WHEN {o} > {t} THEN 2 WHEN {o} < {t} AND (contains(status, 'OT') OR contains(status, 'SO') OR contains(status, 'Shootout')) THEN 1 WHEN {o} < {t} THEN 0 END"


def _side(own: str, other: str) -> str:
    return f"""SELECT game_id, game_date, season, game_type, status, {str(own == "home").upper()} AS is_home, {own}_team_id AS team_id, 'T' || {own}_team_id AS team_abbr, 'T' || {other}_team_id AS opponent_abbr,
  {own}_score AS goals_for, {other}_score AS goals_against, CAST({_POINTS.format(o=own + "_score", t=other + "_score")} AS BIGINT) AS team_points, {own}_sog AS sog, {own}_pp_goals AS pp_goals, {own}_pp_opps AS pp_opps, {own}_pim AS pim FROM games"""


_TGS_ONLY = f", tgs AS ({_side('home', 'away')} UNION ALL {_side('away', 'home')})"
_TGS = cte("games") + _TGS_ONLY
_CORSI = (
    cte("games", "game_events")
    + _TGS_ONLY
    + """, att AS (SELECT e.game_id, 'T' || CASE WHEN by_home THEN home_team_id ELSE away_team_id END AS team_abbr, g.game_date, count(*) AS attempts FROM game_events e JOIN games g USING (game_id)
  WHERE event_type IN ('GOAL', 'SHOT', 'MISSED_SHOT', 'BLOCKED_SHOT') GROUP BY ALL),
corsi AS (SELECT t.game_id, t.game_date, t.season, t.game_type, t.status, t.team_abbr, t.opponent_abbr, coalesce(f.attempts, 0) AS corsi_for, coalesce(a.attempts, 0) AS corsi_against,
  CASE WHEN coalesce(f.attempts, 0) + coalesce(a.attempts, 0) > 0 THEN round(coalesce(f.attempts, 0) / (coalesce(f.attempts, 0) + coalesce(a.attempts, 0)), 4) END AS corsi_pct
  FROM tgs t LEFT JOIN att f ON f.game_id = t.game_id AND f.team_abbr = t.team_abbr LEFT JOIN att a ON a.game_id = t.game_id AND a.team_abbr = t.opponent_abbr)"""
)


def _win(n: int, entity: str) -> str:
    return f"(PARTITION BY {entity} ORDER BY game_date, game_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _windows(entity: str) -> str:
    return f"w5 AS {_win(5, entity)}, w10 AS {_win(10, entity)}, w20 AS {_win(20, entity)}, ws AS (PARTITION BY {entity}, season ORDER BY game_date, game_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), wr AS (PARTITION BY {entity} ORDER BY game_date DESC, game_id DESC)"


_Z = "CASE WHEN {s} > 0 THEN round(({a} - {b}) / {s}, 3) ELSE 0.0 END"
_PRS = f"""{_PGS}, prs AS (SELECT *, {_Z.format(a="pts_avg_5g", b="pts_avg_20g", s="pts_stddev_20g")} AS pts_zscore_5v20, {_Z.format(a="goals_avg_5g", b="goals_avg_20g", s="goals_stddev_20g")} AS goals_zscore_5v20 FROM (
SELECT *, avg(points) OVER w5 AS pts_avg_5g, avg(points) OVER w10 AS pts_avg_10g, avg(points) OVER w20 AS pts_avg_20g, avg(goals) OVER w5 AS goals_avg_5g, avg(goals) OVER w10 AS goals_avg_10g, avg(goals) OVER w20 AS goals_avg_20g,
  avg(shots) OVER w10 AS shots_avg_10g, avg(toi_seconds) OVER w10 AS toi_avg_10g, CAST(sum(points) OVER ws AS BIGINT) AS pts_season, CAST(sum(goals) OVER ws AS BIGINT) AS goals_season, CAST(sum(assists) OVER ws AS BIGINT) AS assists_season,
  count(*) OVER ws AS gp_season, stddev(points) OVER w20 AS pts_stddev_20g, stddev(goals) OVER w20 AS goals_stddev_20g, row_number() OVER wr AS game_recency_rank
FROM pgs WHERE position <> 'G' AND toi_seconds > 0 WINDOW {_windows("player_id")}))"""
_GRS = f"""{_PGS}, grs AS (SELECT *, {_Z.format(a="sv_pct_avg_5g", b="sv_pct_avg_20g", s="sv_pct_stddev_20g")} AS sv_pct_zscore_5v20 FROM (
SELECT *, avg(save_pct) OVER w5 AS sv_pct_avg_5g, avg(save_pct) OVER w10 AS sv_pct_avg_10g, avg(save_pct) OVER w20 AS sv_pct_avg_20g, avg(goals_against) OVER w5 AS ga_avg_5g, avg(goals_against) OVER w10 AS ga_avg_10g,
  CAST(sum(saves) OVER ws AS BIGINT) AS saves_season, CAST(sum(shots_against) OVER ws AS BIGINT) AS shots_against_season, count(*) OVER ws AS gp_season, stddev(save_pct) OVER w20 AS sv_pct_stddev_20g, row_number() OVER wr AS game_recency_rank
FROM pgs WHERE position = 'G' AND toi_seconds > 600 WINDOW {_windows("player_id")}))"""
_TRS = f"""{_TGS}, trs AS (SELECT *, {_Z.format(a="pts_avg_5g", b="pts_avg_20g", s="pts_stddev_20g")} AS pts_zscore_5v20 FROM (
SELECT *, avg(p) OVER w5 AS pts_avg_5g, avg(p) OVER w10 AS pts_avg_10g, avg(p) OVER w20 AS pts_avg_20g, avg(goals_for) OVER w10 AS gf_avg_10g, avg(goals_against) OVER w10 AS ga_avg_10g, avg(sog) OVER w10 AS sog_avg_10g,
  CAST(sum(CASE WHEN p = 2 THEN 1 ELSE 0 END) OVER w5 AS BIGINT) AS wins_last_5, CAST(sum(CASE WHEN p = 0 THEN 1 ELSE 0 END) OVER w5 AS BIGINT) AS losses_last_5,
  CAST(sum(p) OVER ws AS BIGINT) AS pts_cumulative, CAST(sum(goals_for) OVER ws AS BIGINT) AS gf_cumulative, CAST(sum(goals_against) OVER ws AS BIGINT) AS ga_cumulative, count(*) OVER ws AS gp_season,
  stddev(p) OVER w20 AS pts_stddev_20g, CASE WHEN sog > 0 THEN goals_for / sog END AS shooting_pct_game, row_number() OVER wr AS game_recency_rank
FROM (SELECT *, coalesce(team_points, 0) AS p FROM tgs WHERE game_type = 2 AND status NOT IN ('FUT', 'PRE')) WINDOW {_windows("team_abbr")}))"""


def _pick(columns: str, source: str, ctes: str, rest: str = "", doubles: str = "") -> str:
    """SELECT with the doubles rounded."""
    parts = [c.strip() for c in columns.split(",")] + [f"round({c.strip()}, {_ROUND}) AS {c.strip()}" for c in doubles.split(",") if c.strip()]
    return f"WITH {ctes} SELECT {', '.join(parts)} FROM {source} {rest}"


_PLAYER_KEYS = "player_id, game_id, player_first_name, player_last_name, game_date, season, team_abbr, position"
_PRS_D = "pts_avg_5g, pts_avg_10g, pts_avg_20g, goals_avg_5g, goals_avg_10g, goals_avg_20g, shots_avg_10g, toi_avg_10g, pts_stddev_20g, goals_stddev_20g, pts_zscore_5v20, goals_zscore_5v20"
_PRS_I = _PLAYER_KEYS + ", points, goals, assists, shots, pts_season, goals_season, assists_season, gp_season, game_recency_rank"
_GRS_D = "save_pct, sv_pct_avg_5g, sv_pct_avg_10g, sv_pct_avg_20g, ga_avg_5g, ga_avg_10g, sv_pct_stddev_20g, sv_pct_zscore_5v20"
_GRS_I = _PLAYER_KEYS + ", saves, shots_against, goals_against, saves_season, shots_against_season, gp_season, game_recency_rank"
_TRS_D = "pts_avg_5g, pts_avg_10g, pts_avg_20g, gf_avg_10g, ga_avg_10g, sog_avg_10g, pts_stddev_20g, shooting_pct_game, pts_zscore_5v20"
_TRS_I = "team_abbr, game_id, game_date, season, is_home, opponent_abbr, team_points, wins_last_5, losses_last_5, pts_cumulative, gf_cumulative, ga_cumulative, gp_season, game_recency_rank"


def _columns(df: DataFrame, *lists: str) -> DataFrame:
    return rounded(df.select(*(c.strip() for part in lists for c in part.split(","))))


@query(_pick(_PRS_I, "prs", _PRS, doubles=_PRS_D))
def player_rolling_stats(spark, d):
    return _columns(features.player_rolling_stats(by_player(spark, d)), _PRS_I, _PRS_D)


@query(_pick(_GRS_I, "grs", _GRS, doubles=_GRS_D))
def goalie_rolling_stats(spark, d):
    return _columns(features.goalie_rolling_stats(by_player(spark, d)), _GRS_I, _GRS_D)


@query(_pick(_TRS_I, "trs", _TRS, doubles=_TRS_D))
def team_rolling_stats(spark, d):
    return _columns(features.team_rolling_stats(team_games(spark, d)), _TRS_I, _TRS_D)


_PGS_I = _PLAYER_KEYS + ", goals, assists, points, shots, toi_seconds, hits, plus_minus, pim, is_home"


@query(_pick(_PGS_I, "pgs", _PGS, doubles="save_pct"))
def player_game_stats(spark, d):
    return _columns(player_games(spark, d), _PGS_I, "save_pct")


_TGS_I = "game_id, game_date, season, game_type, status, is_home, team_id, team_abbr, opponent_abbr, goals_for, goals_against, team_points, sog, pp_goals, pp_opps, pim"


@query(_pick(_TGS_I, "tgs", _TGS))
def team_game_stats(spark, d):
    return team_games(spark, d)


@query(f"WITH {cte('games', 'teams')}{_TGS_ONLY} SELECT {', '.join('tgs.' + c.strip() for c in _TGS_I.split(','))}, conference, division FROM tgs LEFT JOIN teams ON abbr = team_abbr")
def team_game_stats_extended(spark, d):
    return gold.team_game_stats_extended(team_games(spark, d), view(spark, d, "teams"))


@query(f"WITH {_CORSI} SELECT game_id, game_date, team_abbr, attempts FROM att")
def shot_attempts(spark, d):
    return gold.shot_attempts(view(spark, d, "game_events"), view(spark, d, "games"))


@query(f"WITH {_CORSI} SELECT * FROM corsi")
def team_corsi(spark, d):
    return corsi(spark, d)


_CUM = ("goals", "assists", "points", "shots", "hits", "plus_minus", "pim", "toi_seconds", "pp_goals", "blocked_shots")
_PST_I = "player_id, game_id, game_date, season, team_abbr, position, gp_cum, season_points_rank, " + ", ".join(f"{c}_cum" for c in _CUM)
_PST_D = "pts_avg_5g, goals_avg_5g, shots_avg_5g, pts_avg_10g, goals_avg_10g, shots_avg_10g, points_per_game_cum"


@query(
    _pick(
        _PST_I,
        "pst",
        f"""{_PGS}, pst AS (SELECT *, round(points_cum / gp_cum, 3) AS points_per_game_cum, rank() OVER (PARTITION BY season, game_date ORDER BY points_cum DESC) AS season_points_rank FROM (
SELECT *, {", ".join(f"CAST(sum({c}) OVER ws AS BIGINT) AS {c}_cum" for c in _CUM)}, count(*) OVER ws AS gp_cum,
  {", ".join(f"round(avg({c}) OVER w{n}, 3) AS {s}_avg_{n}g" for n in (5, 10) for s, c in (("pts", "points"), ("goals", "goals"), ("shots", "shots")))}
FROM pgs WHERE position <> 'G' AND toi_seconds > 0 WINDOW {_windows("player_id")}))""",
        doubles=_PST_D,
    )
)
def player_season_timeline(spark, d):
    return _columns(features.player_season_timeline(by_player(spark, d)), _PST_I, _PST_D)


_GST_I = "player_id, game_id, game_date, season, team_abbr, saves_cum, shots_against_cum, goals_against_cum, toi_seconds_cum, gp_cum, season_sv_pct_rank"
_GST_D = "save_pct_cum, gaa_cum"


@query(
    _pick(
        _GST_I,
        "gst",
        f"""{_PGS}, gst AS (SELECT *, round(goals_against_cum * 3600.0 / nullif(toi_seconds_cum, 0), 4) AS gaa_cum, rank() OVER (PARTITION BY season, game_date ORDER BY save_pct_cum DESC NULLS LAST) AS season_sv_pct_rank FROM (
SELECT *, {", ".join(f"CAST(sum({c}) OVER ws AS BIGINT) AS {c}_cum" for c in ("saves", "shots_against", "goals_against", "toi_seconds"))}, count(*) OVER ws AS gp_cum,
  round(CAST(sum(saves) OVER ws AS DOUBLE) / nullif(sum(shots_against) OVER ws, 0), 4) AS save_pct_cum, round(avg(save_pct) OVER w5, 4) AS sv_pct_avg_5g, round(avg(save_pct) OVER w10, 4) AS sv_pct_avg_10g
FROM pgs WHERE position = 'G' AND toi_seconds > 600 WINDOW {_windows("player_id")}))""",
        doubles=_GST_D,
    )
)
def goalie_season_timeline(spark, d):
    return _columns(features.goalie_season_timeline(by_player(spark, d)), _GST_I, _GST_D)


_TST = (("points", "p"), ("gf", "goals_for"), ("ga", "goals_against"), ("shots", "sog"), ("pp_goals", "pp_goals"), ("pp_opps", "pp_opps"), ("wins", "win"), ("otl", "otl"), ("losses", "loss"))
_TST_I = "team_abbr, game_id, game_date, season, is_home, opponent_abbr, wins_last_5, gp_cum, goal_diff_cum, season_rank, " + ", ".join(f"{s}_cum" for s, _ in _TST)
_TST_D = "pts_avg_5g, gf_avg_5g, ga_avg_5g, pts_avg_10g, gf_avg_10g, ga_avg_10g, pp_pct_cum"


@query(
    _pick(
        _TST_I,
        "tst",
        f"""{_TGS}, tst AS (SELECT *, gf_cum - ga_cum AS goal_diff_cum, round(pp_goals_cum / nullif(pp_opps_cum, 0), 4) AS pp_pct_cum, rank() OVER (PARTITION BY season, game_date ORDER BY points_cum DESC, gf_cum - ga_cum DESC) AS season_rank FROM (
SELECT *, {", ".join(f"CAST(sum({c}) OVER ws AS BIGINT) AS {s}_cum" for s, c in _TST)}, count(*) OVER ws AS gp_cum, CAST(sum(win) OVER w5 AS BIGINT) AS wins_last_5,
  {", ".join(f"round(avg({c}) OVER w{n}, 3) AS {s}_avg_{n}g" for n in (5, 10) for s, c in (("pts", "p"), ("gf", "goals_for"), ("ga", "goals_against")))}
FROM (SELECT *, coalesce(team_points, 0) AS p, CASE WHEN coalesce(team_points, 0) = 2 THEN 1 ELSE 0 END AS win, CASE WHEN coalesce(team_points, 0) = 1 THEN 1 ELSE 0 END AS otl, CASE WHEN coalesce(team_points, 0) = 0 THEN 1 ELSE 0 END AS loss FROM tgs WHERE game_type = 2)
WINDOW {_windows("team_abbr")}))""",
        doubles=_TST_D,
    )
)
def team_season_timeline(spark, d):
    return _columns(features.team_season_timeline(team_games(spark, d)), _TST_I, _TST_D)


_FACT_TEAM = "CAST(CASE WHEN vann = '1' AND overtime = '0' AND shootout = '0' THEN 3 WHEN vann = '1' THEN 2 WHEN overtime = '1' OR shootout = '1' THEN 1 ELSE 0 END AS BIGINT) AS points"


@query(f"WITH {cte('raw_team_games')} SELECT *, {_FACT_TEAM} FROM raw_team_games")
def fact_team_game(spark, d):
    return gold.fact_team_game(view(spark, d, "raw_team_games"))


@query(
    f"""WITH {cte('raw_player_games')} SELECT *, round(CAST(toi_seconds AS DOUBLE) / 60, 4) AS toi_min, CASE WHEN CAST(toi_seconds AS DOUBLE) > 0 THEN round(CAST(poang AS DOUBLE) * 3600 / CAST(toi_seconds AS DOUBLE), 6) END AS points_per_60,
CASE WHEN CAST(toi_seconds AS DOUBLE) > 0 THEN round(CAST(sog AS DOUBLE) * 3600 / CAST(toi_seconds AS DOUBLE), 6) END AS shots_per_60 FROM raw_player_games"""
)
def fact_player_game(spark, d):
    return gold.fact_player_game(view(spark, d, "raw_player_games"))


@query(f"WITH {cte('raw_player_games')} SELECT *, round(CAST(raddningsprocent AS DOUBLE) / 100, 6) AS save_pct, CAST(inslappta_mal AS DOUBLE) AS goals_against_avg FROM raw_player_games")
def fact_goalie_game(spark, d):
    return gold.fact_goalie_game(view(spark, d, "raw_player_games"))


@query(
    f"""WITH {cte('raw_team_games')}, f AS (SELECT *, {_FACT_TEAM} FROM raw_team_games) SELECT season_name, game_type_name, lag, count(DISTINCT game_uuid) AS matcher, CAST(sum(CASE WHEN vann = '1' THEN 1 ELSE 0 END) AS BIGINT) AS vinster, CAST(sum(points) AS BIGINT) AS poang,
CAST(sum(CAST(egna_mal AS BIGINT)) AS BIGINT) AS gjorda_mal, CAST(sum(CAST(f.inslappta_mal AS BIGINT)) AS BIGINT) AS inslappta_mal, CAST(sum(CAST(egna_mal AS BIGINT)) - sum(CAST(f.inslappta_mal AS BIGINT)) AS BIGINT) AS malminus FROM f GROUP BY ALL"""
)
def dim_standings(spark, d):
    return gold.dim_standings(gold.fact_team_game(view(spark, d, "raw_team_games")))


_TREND = cte("games") + _TGS_ONLY


@query(f"WITH {_TREND} SELECT team_abbr, game_id, game_date, round(avg(goals_for) OVER (PARTITION BY team_abbr ORDER BY game_date, game_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS gf_avg FROM tgs")
def trend_rolling10(spark, d):
    return rounded(trends.rolling_average(team_games(spark, d), ["team_abbr"], "goals_for", 10, "gf_avg"))


@query(f"WITH {_TREND} SELECT team_abbr, game_id, game_date, round(avg(goals_for) OVER (PARTITION BY team_abbr ORDER BY game_date, game_id ROWS 4 PRECEDING), 6) AS gf_avg FROM tgs")
def trend_rolling5(spark, d):
    return rounded(trends.rolling_average(team_games(spark, d), ["team_abbr"], "goals_for", 5, "gf_avg"))


@query(f"WITH {_TREND} SELECT team_abbr, is_home, game_id, game_date, round(avg(goals_for) OVER (PARTITION BY team_abbr, is_home ORDER BY game_date, game_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS gf_avg FROM tgs")
def trend_home_away(spark, d):
    return rounded(trends.rolling_average(team_games(spark, d), ["team_abbr", "is_home"], "goals_for", 10, "gf_avg"))


_SPLIT = "count(*) AS games, CAST(sum(CASE WHEN team_points = 2 THEN 1 ELSE 0 END) AS BIGINT) AS wins, CAST(sum(goals_for) AS BIGINT) AS gf, CAST(sum(goals_against) AS BIGINT) AS ga, round(avg(goals_for), 6) AS gf_avg"


@query(f"WITH {_TREND} SELECT season, is_home, {_SPLIT} FROM tgs GROUP BY ALL")
def venue_split(spark, d):
    return rounded(trends.split(team_games(spark, d), ["season", "is_home"]))


@query(f"WITH {_TREND} SELECT team_abbr, season, is_home, {_SPLIT} FROM tgs GROUP BY ALL")
def home_away_split(spark, d):
    return rounded(trends.split(team_games(spark, d), ["team_abbr", "season", "is_home"]))


@query(f"WITH {_TREND} SELECT team_abbr, season, {_SPLIT}, CAST(sum(coalesce(team_points, 0)) AS BIGINT) AS points FROM tgs WHERE game_type = 2 GROUP BY ALL")
def season_table(spark, d):
    return rounded(trends.season_table(team_games(spark, d)))


@query(f"WITH {_PGS} SELECT player_id, season, count(*) AS games, CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(assists) AS BIGINT) AS assists, CAST(sum(points) AS BIGINT) AS points FROM pgs GROUP BY ALL")
def career_by_season(spark, d):
    return trends.player_seasons(player_games(spark, d))


@query(
    f"""WITH {_PGS}, s AS (SELECT player_id, season, count(*) AS games, CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(assists) AS BIGINT) AS assists, CAST(sum(points) AS BIGINT) AS points FROM pgs GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY season ORDER BY points DESC, goals DESC, player_id) AS place FROM s) WHERE place <= 50"""
)
def season_scorers(spark, d):
    return trends.top_scorers(player_games(spark, d), 50)


@query(f"WITH {_TREND}, r AS (SELECT *, row_number() OVER (PARTITION BY team_abbr ORDER BY game_date DESC, game_id DESC) AS r FROM tgs) SELECT team_abbr, {_SPLIT} FROM r WHERE r <= 10 GROUP BY ALL")
def last10_team(spark, d):
    return rounded(trends.split(trends.last_games(team_games(spark, d), "team_abbr", 10), ["team_abbr"]))


@query(f"WITH {_TREND}, r AS (SELECT *, row_number() OVER (PARTITION BY team_abbr ORDER BY game_date DESC, game_id DESC) AS r FROM tgs) SELECT {_TGS_I} FROM r WHERE r = 1")
def latest_per_entity(spark, d):
    return features.latest_per_entity(team_games(spark, d), "team_abbr")


@query(f"WITH {cte('games')} SELECT * FROM games ORDER BY game_date DESC, game_id DESC LIMIT 20")
def latest_games(spark, d):
    return trends.latest(view(spark, d, "games"), 20)


@query(f"WITH {cte('games')} SELECT * FROM games ORDER BY game_id LIMIT 100 OFFSET 200")
def page_rows(spark, d):
    return trends.page(view(spark, d, "games"), ["game_id"], 2, 100)


@query(f"WITH {_PGS} SELECT player_id, game_id, game_date, season, team_abbr, player_first_name, player_last_name, goals, assists, points FROM pgs")
def player_points_per_game(spark, d):
    return player_games(spark, d).select("player_id", "game_id", "game_date", "season", "team_abbr", "player_first_name", "player_last_name", "goals", "assists", "points")


@query(
    f"""WITH {_PGS} SELECT game_id, team_abbr, count(*) AS players, CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(assists) AS BIGINT) AS assists, CAST(sum(shots) AS BIGINT) AS shots, CAST(sum(pim) AS BIGINT) AS pim,
CAST(sum(CASE WHEN position = 'G' THEN saves END) AS BIGINT) AS goalie_saves FROM pgs GROUP BY ALL"""
)
def game_box(spark, d):
    return trends.game_box(player_games(spark, d))


@query(f"WITH {_TREND} SELECT game_id, game_date, team_abbr, opponent_abbr, is_home, goals_for, goals_against, CASE WHEN team_points = 2 THEN 'W' WHEN team_points = 1 THEN 'OTL' WHEN team_points = 0 THEN 'L' ELSE 'T' END AS outcome FROM tgs WHERE team_abbr = 'T3'")
def trend_team(spark, d):
    return trends.team_trend(team_games(spark, d), "T3")


@query(f"WITH {_PGS} SELECT game_id, game_date, points, goals, round(avg(points) OVER (PARTITION BY player_id ORDER BY game_date, game_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS pts_avg FROM pgs WHERE player_id = 17")
def trend_player(spark, d):
    return rounded(trends.player_trend(player_games(spark, d), 17))


@query(f"WITH {_PGS} SELECT player_id, is_home, CASE WHEN shots_against >= 30 THEN 'busy' WHEN shots_against >= 25 THEN 'usual' ELSE 'quiet' END AS load, count(*) AS games, CAST(sum(saves) AS BIGINT) AS saves, CAST(sum(shots_against) AS BIGINT) AS shots, round(sum(saves) / sum(shots_against), 6) AS save_pct FROM pgs WHERE position = 'G' GROUP BY ALL")
def trend_goalie(spark, d):
    return rounded(trends.goalie_situations(player_games(spark, d)))


_P_I = "player_id, player_first_name, player_last_name, team_abbr, position, game_date, season, pts_season, goals_season, gp_season"
_P_D = "pts_avg_5g, pts_avg_20g, pts_zscore_5v20, goals_zscore_5v20"
_CURRENT = "season = (SELECT max(season) FROM games WHERE game_type = 2) AND game_recency_rank = 1"


@query(_pick(_P_I, "prs", _PRS, f"WHERE {_CURRENT} AND gp_season >= 3 AND abs(pts_zscore_5v20) >= 0.5 AND player_first_name IS NOT NULL AND player_last_name IS NOT NULL ORDER BY abs(pts_zscore_5v20) DESC, player_id LIMIT 20", _P_D))
def anomalies_player(spark, d):
    found = insights.player_anomalies(features.player_rolling_stats(by_player(spark, d)), view(spark, d, "games"), min_games=3, threshold=0.5)
    return _columns(found, _P_I, _P_D)


_G_I = "player_id, player_first_name, player_last_name, team_abbr, game_date, season, gp_season"
_G_D = "sv_pct_avg_5g, sv_pct_avg_20g, sv_pct_zscore_5v20"


@query(_pick(_G_I, "grs", _GRS, f"WHERE {_CURRENT} AND gp_season >= 2 AND abs(sv_pct_zscore_5v20) >= 0.5 AND player_first_name IS NOT NULL AND player_last_name IS NOT NULL ORDER BY abs(sv_pct_zscore_5v20) DESC, player_id LIMIT 10", _G_D))
def anomalies_goalie(spark, d):
    found = insights.goalie_anomalies(features.goalie_rolling_stats(by_player(spark, d)), view(spark, d, "games"), min_games=2, threshold=0.5)
    return _columns(found, _G_I, _G_D)


_T_I = "team_abbr, game_date, season, wins_last_5, losses_last_5, pts_cumulative, gp_season"
_T_D = "pts_avg_5g, pts_avg_20g, pts_zscore_5v20, gf_avg_10g, ga_avg_10g"


@query(_pick(_T_I, "trs", _TRS, f"WHERE {_CURRENT} AND gp_season >= 20 AND abs(pts_zscore_5v20) >= 0.5 ORDER BY abs(pts_zscore_5v20) DESC, team_abbr LIMIT 10", _T_D))
def anomalies_team(spark, d):
    found = insights.team_anomalies(features.team_rolling_stats(team_games(spark, d)), view(spark, d, "games"), min_games=20, threshold=0.5)
    return _columns(found, _T_I, _T_D)


_OUT = f"""{_CORSI}, latest AS (SELECT team_abbr, max(game_date) AS latest FROM corsi WHERE game_type = 2 AND corsi_pct IS NOT NULL GROUP BY team_abbr),
out AS (SELECT c.team_abbr, round(avg(corsi_pct), 6) AS corsi_pct_avg, count(*) AS n FROM corsi c JOIN latest USING (team_abbr) WHERE game_type = 2 AND corsi_pct IS NOT NULL AND game_date >= latest - INTERVAL 20 DAY GROUP BY c.team_abbr HAVING count(*) >= 5)"""


@query(f"WITH {_OUT} SELECT * FROM out WHERE corsi_pct_avg < 0.48 OR corsi_pct_avg > 0.52")
def corsi_outliers(spark, d):
    return insights.corsi_outliers(corsi(spark, d), low=0.48, high=0.52)


_SEVERITY = "round(least(abs({z}), 3.0) / 3, 4)"
_AS_OF = "2001-12-31"
# A z-score has three decimals, of which the text has two: rounded as decimals are, half away from 0.
_Z2 = "CAST(round(CAST({z} AS DECIMAL(12, 3)), 2) AS DOUBLE), CASE WHEN {z} > 0 THEN 'above' ELSE 'below' END"
_SAID_P = f"""printf('%s %s (%s, %s) is averaging %.2f pts/game over the last 5 games, vs their 20-game baseline of %.2f pts/game (z-score: %+.2f, %s baseline). Season totals: %d pts in %d games. Most recent game: %s.',
  player_first_name, player_last_name, team_abbr, position, round(pts_avg_5g, 2), round(pts_avg_20g, 2), {_Z2.format(z="pts_zscore_5v20")}, pts_season, gp_season, CAST(game_date AS VARCHAR)) AS prompt_context"""
_SAID_G = f"""printf('Goalie %s %s (%s) has a 5-game save%% of %.3f, vs 20-game baseline of %.3f (z-score: %+.2f, %s baseline). Games played this season: %d. Most recent game: %s.',
  player_first_name, player_last_name, team_abbr, round(sv_pct_avg_5g, 3), round(sv_pct_avg_20g, 3), {_Z2.format(z="sv_pct_zscore_5v20")}, gp_season, CAST(game_date AS VARCHAR))"""
_SAID_T = f"""printf('%s is averaging %.2f pts/game over the last 5 games (%dW-%dL), vs 20-game baseline of %.2f (z-score: %+.2f, %s baseline). Season: %d pts in %d GP. 10-game avg GF/GA: %.2f/%.2f. Last game: %s.',
  team_abbr, round(pts_avg_5g, 2), wins_last_5, losses_last_5, round(pts_avg_20g, 2), {_Z2.format(z="pts_zscore_5v20")}, pts_cumulative, gp_season, round(gf_avg_10g, 2), round(ga_avg_10g, 2), CAST(game_date AS VARCHAR))"""
_INSIGHT = "substr(md5('{t}:' || {e} || ':' || insight_type || ':' || CAST(game_date AS VARCHAR)), 1, 16)"
_INSIGHTS = f"""{_PRS}, {_GRS.removeprefix(_PGS + ", ")}, {_TRS.removeprefix(cte("games")).removeprefix(", ")}, cand AS (
SELECT 'player' AS entity_type, CAST(player_id AS VARCHAR) AS entity_id, player_first_name || ' ' || player_last_name AS entity_name, team_abbr, pts_zscore_5v20 AS z, season, game_date,
  CASE WHEN pts_zscore_5v20 >= 2.5 THEN 'breakout' WHEN pts_zscore_5v20 >= 1 THEN 'hot_streak' WHEN pts_zscore_5v20 <= -2.5 THEN 'slump' ELSE 'cold_spell' END AS insight_type, {_SAID_P}
FROM (SELECT * FROM prs WHERE {_CURRENT} AND gp_season >= 3 AND abs(pts_zscore_5v20) >= 0.5 AND player_first_name IS NOT NULL AND player_last_name IS NOT NULL ORDER BY abs(pts_zscore_5v20) DESC, player_id LIMIT 20)
UNION ALL SELECT 'player', CAST(player_id AS VARCHAR), player_first_name || ' ' || player_last_name, team_abbr, sv_pct_zscore_5v20, season, game_date, CASE WHEN sv_pct_zscore_5v20 > 0 THEN 'goalie_hot' ELSE 'goalie_cold' END, {_SAID_G}
FROM (SELECT * FROM grs WHERE {_CURRENT} AND gp_season >= 2 AND abs(sv_pct_zscore_5v20) >= 0.5 AND player_first_name IS NOT NULL AND player_last_name IS NOT NULL ORDER BY abs(sv_pct_zscore_5v20) DESC, player_id LIMIT 10)
UNION ALL SELECT 'team', team_abbr, team_abbr, team_abbr, pts_zscore_5v20, season, game_date, CASE WHEN pts_zscore_5v20 >= 1.5 THEN 'team_surge' ELSE 'team_collapse' END, {_SAID_T}
FROM (SELECT * FROM trs WHERE {_CURRENT} AND gp_season >= 20 AND abs(pts_zscore_5v20) >= 0.5 ORDER BY abs(pts_zscore_5v20) DESC, team_abbr LIMIT 10)),
ins AS (SELECT {_INSIGHT.format(t="' || entity_type || '", e="entity_id")} AS insight_id, insight_type, entity_type, entity_id, entity_name, team_abbr, {_SEVERITY.format(z="z")} AS severity, round(z, 3) AS zscore, CAST(season AS VARCHAR) AS season, CAST(game_date AS VARCHAR) AS game_date, prompt_context FROM cand
UNION ALL SELECT substr(md5('team:' || team_abbr || ':possession_edge:{_AS_OF}'), 1, 16), 'possession_edge', 'team', team_abbr, team_abbr, team_abbr, {_SEVERITY.format(z="((corsi_pct_avg - 0.5) / 0.04)")}, round((corsi_pct_avg - 0.5) / 0.04, 3), substr('{_AS_OF}', 1, 4), '{_AS_OF}',
  printf('%s has a 10-game Corsi%% of %.3f (%d games analyzed) \u2013 %s. Corsi%% below 0.42 or above 0.58 is a statistically significant outlier.', team_abbr, round(corsi_pct_avg, 3), n, CASE WHEN corsi_pct_avg > 0.5 THEN 'strong possession edge' ELSE 'possession concerns' END)
FROM (WITH {_OUT} SELECT * FROM out WHERE corsi_pct_avg < 0.48 OR corsi_pct_avg > 0.52))"""


def all_insights(spark: SparkSession, d: str) -> DataFrame:
    pg, tg, games = by_player(spark, d), team_games(spark, d), view(spark, d, "games")
    return insights.insights(
        insights.player_anomalies(features.player_rolling_stats(pg), games, 3, 0.5),
        insights.goalie_anomalies(features.goalie_rolling_stats(pg), games, 2, 0.5),
        insights.team_anomalies(features.team_rolling_stats(tg), games, 20, 0.5),
        insights.corsi_outliers(corsi(spark, d), low=0.48, high=0.52),
        _AS_OF,
    )


@query(f"WITH {_INSIGHTS} SELECT * EXCLUDE (prompt_context) FROM ins", name="insights")
def insights_query(spark, d):
    return all_insights(spark, d).drop("prompt_context")


@query(f"WITH {_INSIGHTS} SELECT * EXCLUDE (prompt_context) FROM ins ORDER BY severity DESC, insight_id LIMIT 5")
def insights_top(spark, d):
    return insights.most_severe(all_insights(spark, d), 5).drop("prompt_context")


@query(f"WITH {_INSIGHTS} SELECT insight_id, TIMESTAMP '2002-01-01 06:00:00' AS generated_at, insight_type, entity_type, entity_id, entity_name, team_abbr, severity, zscore, season, CAST(game_date AS DATE) AS game_date, CAST(NULL AS VARCHAR) AS headline, CAST(NULL AS VARCHAR) AS body, prompt_context FROM ins")
def insight_table(spark, d):
    return insights.insight_table(all_insights(spark, d), "2002-01-01 06:00:00").withColumn("generated_at", F.col("generated_at").cast("timestamp_ntz"))


@query(f"WITH {_INSIGHTS} SELECT insight_id, prompt_context FROM ins")
def fn_prompt_text(spark, d):
    return all_insights(spark, d).select("insight_id", "prompt_context")


@query(f"WITH {_TREND}, r AS (SELECT *, count(*) OVER w AS n, avg(coalesce(team_points, 0)) OVER w AS a, row_number() OVER (PARTITION BY team_abbr ORDER BY game_date DESC, game_id DESC) AS r FROM tgs WHERE game_type = 2 AND game_date >= (SELECT max(game_date) FROM tgs) - INTERVAL 90 DAY WINDOW w AS (PARTITION BY team_abbr ORDER BY game_date, game_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) SELECT team_abbr, game_id, game_date, round(a, 6) AS pts_avg_5g, n FROM r WHERE r = 1 AND n >= 3 AND a > 1.6")
def det_team_streak(spark, d):
    return rounded(insights.team_streak(team_games(spark, d)))


@query(f"WITH {_PGS}, r AS (SELECT player_id, game_id, game_date, season, avg(points) OVER (PARTITION BY player_id ORDER BY game_date, game_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS a, avg(points) OVER ws AS b, count(*) OVER ws AS n, row_number() OVER wr AS r FROM pgs WHERE position <> 'G' AND toi_seconds > 0 WINDOW {_windows('player_id')}) SELECT player_id, game_id, game_date, season, round(a, 6) AS pts_avg_5g, round(b, 6) AS season_avg, n FROM r WHERE r = 1 AND n >= 3 AND b > 0 AND a >= 1.2 * b")
def det_player_breakout(spark, d):
    return rounded(insights.player_breakout(player_games(spark, d), times=1.2))


@query(f"WITH {_PGS}, r AS (SELECT player_id, game_id, game_date, avg(save_pct) OVER w AS a, count(*) OVER w AS n, row_number() OVER (PARTITION BY player_id ORDER BY game_date DESC, game_id DESC) AS r FROM pgs WHERE position = 'G' AND toi_seconds > 600 AND game_date >= (SELECT max(game_date) FROM pgs) - INTERVAL 365 DAY WINDOW w AS (PARTITION BY player_id ORDER BY game_date, game_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) SELECT player_id, game_id, game_date, round(a, 6) AS sv_pct_avg_3g FROM r WHERE r = 1 AND n >= 3 AND a > 0.92")
def det_goalie_trend(spark, d):
    return rounded(insights.goalie_trend(player_games(spark, d), days=365))


@query(
    f"""WITH {cte('games')}{_TGS_ONLY}, c AS (SELECT 'team' AS entity_type, team_abbr AS entity_id, CASE WHEN team_points = 2 THEN 'win' ELSE 'other' END AS insight_type, game_date, game_id, CAST(abs(goals_for - goals_against) AS DOUBLE) AS severity FROM tgs),
k AS (SELECT *, lead(game_date) OVER (PARTITION BY entity_type, entity_id, insight_type ORDER BY game_date, game_id) AS nxt FROM c)
SELECT entity_type, entity_id, insight_type, game_date, game_id, severity FROM k WHERE nxt IS NULL OR nxt - game_date > 7"""
)
def insight_rank_dedup(spark, d):
    tg = team_games(spark, d)
    c = tg.select(F.lit("team").alias("entity_type"), F.col("team_abbr").alias("entity_id"), F.when(F.col("team_points") == 2, "win").otherwise("other").alias("insight_type"), "game_date", "game_id", F.abs(F.col("goals_for") - F.col("goals_against")).cast("double").alias("severity"))
    return insights.without_repeats(c, 7)


_CHANCES = """c AS (SELECT 'team' AS entity_type, team_abbr AS entity_id, CASE WHEN team_points = 2 THEN 'win' ELSE 'other' END AS insight_type, game_date, game_id, season, CAST(abs(goals_for - goals_against) AS DOUBLE) AS severity FROM tgs),
b AS (SELECT *, CASE WHEN game_date - lag(game_date) OVER w <= 7 THEN 0 ELSE 1 END AS begins FROM c WINDOW w AS (PARTITION BY entity_id, insight_type ORDER BY game_date, game_id)),
k AS (SELECT *, sum(begins) OVER (PARTITION BY entity_id, insight_type ORDER BY game_date, game_id) AS chain FROM b),
i AS (SELECT entity_type, entity_id, insight_type, max(game_date) AS game_date, max_by(game_id, {'d': game_date, 'g': game_id}) AS game_id, max_by(season, {'d': game_date, 'g': game_id}) AS season, max(severity) AS severity, min(game_date) AS first_date, count(*) - 1 AS n_repeats FROM k GROUP BY entity_type, entity_id, insight_type, chain)"""


def _chances(spark, d):
    kind = F.when(F.col("team_points") == 2, "win").otherwise("other")
    return team_games(spark, d).select(F.lit("team").alias("entity_type"), F.col("team_abbr").alias("entity_id"), kind.alias("insight_type"), "game_date", "game_id", "season", F.abs(F.col("goals_for") - F.col("goals_against")).cast("double").alias("severity"))


@query(f"WITH {cte('games')}{_TGS_ONLY}, {_CHANCES} SELECT entity_type, entity_id, insight_type, game_date, game_id, season, severity, first_date, n_repeats FROM i")
def insight_islands(spark, d):
    return insights.islands(_chances(spark, d), 7)


@query(f"WITH {cte('games')}{_TGS_ONLY}, {_CHANCES} SELECT * FROM (SELECT entity_type, entity_id, insight_type, game_date, game_id, season, severity, first_date, n_repeats, row_number() OVER (PARTITION BY season ORDER BY severity DESC, n_repeats DESC, entity_type, entity_id, insight_type, game_date, game_id) AS rank FROM i) WHERE rank <= 10")
def insight_ranked(spark, d):
    """The ten most significant chains of each season."""
    return insights.ranked(insights.islands(_chances(spark, d), 7), 10, ["season"])


@query(f"WITH {cte('games')}{_TGS_ONLY} SELECT team_abbr, season, row_number() OVER w AS game_no, game_date, game_id, coalesce(team_points, 0) AS points, CAST(sum(coalesce(team_points, 0)) OVER w AS BIGINT) AS total, round(sum(coalesce(team_points, 0)) OVER w * 82.0 / row_number() OVER w, 2) AS pace FROM tgs WINDOW w AS (PARTITION BY team_abbr, season ORDER BY game_date, game_id ROWS UNBOUNDED PRECEDING)")
def points_curve(spark, d):
    return trends.points_curve(team_games(spark, d))


@query(f"""WITH {cte('games')}{_TGS_ONLY}, t AS (SELECT team_abbr, season, CASE WHEN team_abbr < 'T15' THEN 'North' WHEN team_abbr < 'T25' THEN 'South' END AS division, CAST(sum(coalesce(team_points, 0)) AS BIGINT) AS points, count(*) FILTER (team_points = 2) AS wins FROM tgs GROUP BY ALL)
SELECT *, row_number() OVER w AS division_rank, row_number() OVER (PARTITION BY season ORDER BY points DESC, wins DESC, team_abbr) AS league_rank, max(points) OVER (PARTITION BY season, division) - points AS behind FROM t WINDOW w AS (PARTITION BY season, division ORDER BY points DESC, wins DESC, team_abbr)""")
def standings_by_division(spark, d):
    t = team_games(spark, d).withColumn("division", F.when(F.col("team_abbr") < "T15", "North").when(F.col("team_abbr") < "T25", "South"))
    t = t.groupBy("team_abbr", "season", "division").agg(F.sum(F.coalesce("team_points", F.lit(0))).cast("bigint").alias("points"), F.count_if(F.col("team_points") == 2).alias("wins"))
    return trends.division_standings(t)


#: A bracket of eight teams for each year and clerk of the orders; who wins goes by arithmetic, and no final is played in every fifth.
_SERIES = """SELECT CAST(k AS BIGINT) AS season, CAST(r AS BIGINT) AS `round`, CASE r WHEN 1 THEN CASE i WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END WHEN 2 THEN CASE i WHEN 0 THEN 'E' ELSE 'F' END ELSE 'G' END AS series_letter, top_seed_id, bottom_seed_id,
 CASE WHEN r = 3 AND k % 5 = 0 THEN NULL WHEN (k + r + i) % 2 = 0 THEN top_seed_id ELSE bottom_seed_id END AS winning_team_id FROM (
SELECT k, 1 AS r, i, k * 100 + 2 * i AS top_seed_id, k * 100 + 2 * i + 1 AS bottom_seed_id FROM (SELECT DISTINCT year(o_orderdate) * 1000 + o_custkey % 50 AS k FROM {t}) CROSS JOIN (VALUES (0), (1), (2), (3)) v(i)
UNION ALL SELECT k, 2, i, k * 100 + 4 * i + (k + 1 + 2 * i) % 2, k * 100 + 4 * i + 2 + (k + 1 + 2 * i + 1) % 2 FROM (SELECT DISTINCT year(o_orderdate) * 1000 + o_custkey % 50 AS k FROM {t}) CROSS JOIN (VALUES (0), (1)) v(i)
UNION ALL SELECT k, 3, 0, CASE WHEN (k + 2) % 2 = 0 THEN k * 100 + (k + 1) % 2 ELSE k * 100 + 2 + k % 2 END, CASE WHEN (k + 3) % 2 = 0 THEN k * 100 + 4 + (k + 3) % 2 ELSE k * 100 + 6 + (k + 4) % 2 END FROM (SELECT DISTINCT year(o_orderdate) * 1000 + o_custkey % 50 AS k FROM {t}))"""


@query(f"""WITH RECURSIVE s AS ({_SERIES.format(t="orders").replace("`round`", '"round"')}),
linked AS (SELECT a.season, a.series_letter, a."round", a.top_seed_id, a.bottom_seed_id, a.winning_team_id, b.series_letter AS parent FROM s a LEFT JOIN s b ON a.season = b.season AND b."round" = a."round" + 1 AND a.winning_team_id IN (b.top_seed_id, b.bottom_seed_id)),
tree AS (SELECT season, series_letter, parent, series_letter AS path, 0 AS depth FROM linked WHERE parent IS NULL UNION ALL SELECT l.season, l.series_letter, l.parent, t.path || '/' || l.series_letter, t.depth + 1 FROM tree t JOIN linked l ON l.season = t.season AND l.parent = t.series_letter)
SELECT l.*, t.path, CAST(t.depth AS BIGINT) AS depth FROM linked l JOIN tree t ON t.season = l.season AND t.series_letter = l.series_letter""")
def playoff_bracket(spark, d):
    return trends.playoff_bracket(spark.sql(_SERIES.replace("{t}", "{orders}"), orders=table(spark, d, "orders")))
