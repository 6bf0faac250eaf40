"""Report and page extraction over texts that are built from whole tables, and over the pages table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hockeylake.operators import reports
from hockeylake.plans.adapters import GAMES_A_TASK, cte, spread_games, table
from hockeylake.plans.registry import ORACLE_SQL, query

_G = cte("games")
_CLOCK = "lpad(game_id % 20, 2, '0') || ':' || lpad(game_id % 60, 2, '0')"
# Dashes, blanks, cases of headings and goal types vary from game to game.
_DASH = "if(game_id % 3 = 0, ' - ', if(game_id % 3 = 1, '-', ' \u2013  '))"
_REPORT = f"""'Referees Adams, Bo ' || 'Berg, Carl' || '\\nLinesmen: Dahl, Eva\\nHome ' || if(game_id % 2 = 0, 'Club - Away Town', 'Club \u2013 Away Town') || '\\nSpectators: ' || (1 + game_id % 9) || ' 420\\n'
 || 'HOM  2 ' || (20 + game_id % 9) || ' 24 92,31 6 04:00 2 50,00 02:10 1 N/A\\n' || if(game_id % 2 = 0, '1st period', '1ST PERIOD') || '\\nGoal  ' || {_CLOCK} || ' HOM ' || home_score || {_DASH} || away_score || if(game_id % 5 = 0, '', ' PP1') || ' 59 HEDMAN, Per 29 JONSSON, Mats Participation (On ice)\\nHOM: 6 12\\nAWY:  ' || game_id % 40 || '\\n2nd period\\n'
 || 'Penalty 15:02 AWY 2 min. 17 BERG, Karl Roughing' || if(game_id % 4 = 0, ' (double)', '') || '\\nGoalkeeper Out 58:40 AWY 35 LIND, Olle\\n' || if(game_id % 2 = 0, 'Overtime', 'OT period') || '\\nGoal 61:00 AWY 1-2 GWG ' || (1 + game_id % 30) || ' ROE, Ann\\nGoal of the night\\n'"""
_ROSTER = "'1st line\\nCE ' || (1 + game_id % 50) || ' ALM,Ola ' || if(game_id % 2 = 0, 'C ', '') || '1990-01-02 3 LD 7 EK, Bo A 1991-02-03\\nGoalkeepers\\nGK 30 NOR,Ed 1989-05-06\\nTeam Officials\\nKARLIN, Mats Head Coach ' || if(game_id % 3 = 0, '', 'ZACK, Nils Assistant Coach')"
_LINEUP = """'Official Line Up\\nTeam\\nLeksands IF (White)\\n37 HELLSTEN, Jakob\\n1st\\n10 JOHANSSON, Anton (RD) ' || (1 + game_id % 50) || ' MILOSEVIC, Stefan (LD)\\n3rd 26 HEENS, Isac (LD)' || if(game_id % 2 = 0, ' 9 ÖST, Åke (CE)', '') || '\\nExtra players\\n' || if(game_id % 3 = 0, '', '5 EK, Bo (RW)\\n')
 || 'Frölunda HC\\n30 NOR, Ed\\n7 LOOSE, Lee (GK)\\n77 alm, ola\\nSpectators 1 420'"""
_SUMMARY = "'Name No. Pos. G A TP +/- PIM SOG FO+/- FO%\\nHALL, Max ' || '9 CE 1 ' || game_id % 4 || ' ' || (1 + game_id % 4) || ' -1 2 3 4/5 44,44\\nTotal 1 2\\nName No. Pos. SOG GA SVS SVS% MIP GAA\\nDE NOR, Ed 30 GK ' || away_sog || ' 2 23 92,00 60:00 2,00\\nName No. Pos. G A TP +/- PIM SOG FO+/- FO%\\nKAY, Tor 8 LD 0 0 0 0 ' || game_id % 7 || ' 1 0/0 N/A'"
_MEDIA = "'Skaters SOG Goals Assists Points\\n12 HALL Max ' || game_id % 6 || ' 1 0 1 -1 2 4 - 5 50,0' || if(game_id % 2 = 0, ' 20 15:30', '') || '\\nGoalies Saves GA SOG\\n30 NOR Ed ' || (away_sog - away_score) || ' ' || away_score || ' ' || away_sog || ' 91,50 1 - 60:00\\n31 OST Al 0 0 0 N/A - - 0:00'"


#: As everywhere; smaller in tests.
_GAMES_A_TASK = GAMES_A_TASK


def _games(spark, d):
    return spread_games(spark, d, _GAMES_A_TASK)


def _lines(spark, d, text: str, kind: str = "official_game_report"):
    r = _games(spark, d).select(F.col("game_id"), F.lit(kind).alias("report_type"), F.expr(text).alias("text"))
    return reports.report_lines(r)


_SEC = "game_id % 20 * 60 + game_id % 60"


@query(f"WITH {_G} SELECT game_id, CAST(period AS VARCHAR) AS period, CAST(n AS BIGINT) AS n FROM games, (VALUES (NULL, 5), ('1', 4), ('2', 3), ('OT', 3)) v(period, n)")
def txt_sections(spark, d):
    return reports.with_sections(_lines(spark, d, _REPORT)).groupBy("game_id", "period").agg(F.count("*").alias("n"))


@query(f"WITH {_G} SELECT game_id, role, name FROM games, (VALUES ('referee', 'Adams, Bo'), ('referee', 'Berg, Carl'), ('linesman', 'Dahl, Eva')) v(role, name)")
def txt_referees(spark, d):
    return reports.referees(_lines(spark, d, _REPORT)).drop("pos")


@query(f"WITH {_G} SELECT game_id, 'total' AS period, 'HOM' AS team, 2 AS goals, 20 + game_id % 9 AS shots, 24 AS saves, 6 AS pim, 2 AS advantages, 1 AS disadvantages, 92.31 AS save_pct, 50.0 AS pp_pct, CAST(NULL AS DOUBLE) AS sh_pct, 240 AS pp_seconds, 130 AS sh_seconds FROM games")
def txt_period_stats(spark, d):
    return reports.period_stats(_lines(spark, d, _REPORT)).drop("pos")


@query(
    f"""WITH {_G} SELECT game_id, '1' AS period, {_SEC} AS seconds, 'HOM' AS team, home_score, away_score, CASE WHEN game_id % 5 <> 0 THEN 'PP1' END AS goal_type, 59 AS scorer_number, 'HEDMAN, Per' AS scorer, 'JONSSON, Mats' AS assist1 FROM games
UNION ALL SELECT game_id, 'OT', 3660, 'AWY', 1, 2, 'GWG', 1 + game_id % 30, 'ROE, Ann', NULL FROM games"""
)
def txt_goals(spark, d):
    return reports.goals(_lines(spark, d, _REPORT)).drop("pos", "assist2")


@query(f"WITH {_G} SELECT game_id, 'HOM' AS team, 'positive' AS side, unnest([6, 12]) AS number FROM games UNION ALL SELECT game_id, 'AWY', 'negative', game_id % 40 FROM games")
def txt_on_ice(spark, d):
    return reports.on_ice(_lines(spark, d, _REPORT)).drop("pos", "goal_pos", "period", "seconds")


@query(f"WITH {_G} SELECT game_id, '2' AS period, 902 AS seconds, 'AWY' AS team, 2 AS minutes, 17 AS number, 'BERG, Karl' AS player, 'Roughing' || CASE WHEN game_id % 4 = 0 THEN ' (double)' ELSE '' END AS infraction FROM games")
def txt_penalties(spark, d):
    return reports.penalties(_lines(spark, d, _REPORT)).drop("pos")


@query(f"WITH {_G} SELECT game_id, 'out' AS change, 3520 AS seconds, 'AWY' AS team, 35 AS number, 'LIND, Olle' AS player FROM games")
def txt_gk_changes(spark, d):
    return reports.goalkeeper_changes(_lines(spark, d, _REPORT)).drop("pos", "period")


@query(f"WITH {_G} SELECT game_id, CAST((1 + game_id % 9) * 1000 + 420 AS BIGINT) AS spectators FROM games")
def txt_spectators(spark, d):
    return reports.spectators(_lines(spark, d, _REPORT))


@query(f"WITH {_G} SELECT game_id, 'Home Club' AS home_team, 'Away Town' AS away_team FROM games")
def txt_teams(spark, d):
    return reports.team_names(_lines(spark, d, _REPORT))


@query(
    f"""WITH {_G} SELECT game_id, '1st line' AS label, 'home' AS side, 'CE' AS position, 1 + game_id % 50 AS number, 'ALM, Ola' AS player, game_id % 2 = 0 AS captain, FALSE AS alternate, DATE '1990-01-02' AS birthdate FROM games
UNION ALL SELECT game_id, '1st line', 'away', 'LD', 7, 'EK, Bo', FALSE, TRUE, DATE '1991-02-03' FROM games UNION ALL SELECT game_id, 'Goalkeepers', 'home', 'GK', 30, 'NOR, Ed', FALSE, FALSE, DATE '1989-05-06' FROM games"""
)
def txt_roster(spark, d):
    return reports.roster(_lines(spark, d, _ROSTER)).drop("pos")


@query(f"WITH {_G} SELECT game_id, 'home' AS side, 'KARLIN, Mats' AS name, 'Head Coach' AS role FROM games UNION ALL SELECT game_id, 'away', 'ZACK, Nils', 'Assistant Coach' FROM games WHERE game_id % 3 <> 0")
def txt_officials(spark, d):
    return reports.officials(_lines(spark, d, _ROSTER))


@query(f"""WITH {_G} SELECT game_id, team, line_number, number, player, position FROM games, (VALUES ('Leksands IF', 'Goalkeepers', 37, 'HELLSTEN, Jakob', 'GK'), ('Leksands IF', '1st', 10, 'JOHANSSON, Anton', 'RD'), ('Leksands IF', '3rd', 26, 'HEENS, Isac', 'LD'), ('Frölunda HC', 'Goalkeepers', 30, 'NOR, Ed', 'GK'), ('Frölunda HC', NULL, 7, 'LOOSE, Lee', 'GK')) v(team, line_number, number, player, position)
UNION ALL SELECT game_id, 'Leksands IF', '1st', 1 + game_id % 50, 'MILOSEVIC, Stefan', 'LD' FROM games UNION ALL SELECT game_id, 'Leksands IF', '3rd', 9, 'ÖST, Åke', 'CE' FROM games WHERE game_id % 2 = 0 UNION ALL SELECT game_id, 'Leksands IF', 'Extra players', 5, 'EK, Bo', 'RW' FROM games WHERE game_id % 3 <> 0""")
def txt_lineup(spark, d):
    return reports.lineup(_lines(spark, d, _LINEUP)).drop("pos", "i")


@query(
    f"""WITH {_G} SELECT game_id, 'home' AS side, 'HALL, Max' AS player, 9 AS number, 'CE' AS position, 1 AS goals, game_id % 4 AS assists, 1 + game_id % 4 AS points, -1 AS plus_minus, 2 AS pim, 3 AS shots, '4/5' AS faceoffs, 44.44 AS faceoff_pct FROM games
UNION ALL SELECT game_id, 'away', 'KAY, Tor', 8, 'LD', 0, 0, 0, 0, game_id % 7, 1, '0/0', NULL FROM games"""
)
def txt_player_summary(spark, d):
    return reports.player_summary(_lines(spark, d, _SUMMARY)).drop("pos")


@query(f"WITH {_G} SELECT game_id, 'home' AS side, 'DE NOR, Ed' AS player, 30 AS number, 'GK' AS position, away_sog AS shots_against, 2 AS goals_against, 23 AS saves, 92.0 AS save_pct, 3600 AS seconds, 2.0 AS gaa FROM games")
def txt_summary_goalies(spark, d):
    return reports.player_summary_goalies(_lines(spark, d, _SUMMARY)).drop("pos")


@query(
    f"""WITH {_G} SELECT game_id, 'home' AS side, 30 AS number, 'NOR Ed' AS player, away_sog - away_score AS saves, away_score AS goals_against, away_sog AS shots_against, 91.5 AS save_pct, 1 AS pp_saves, CAST(NULL AS BIGINT) AS pp_shots_against, 3600 AS seconds, CAST(away_score AS DOUBLE) AS gaa FROM games
UNION ALL SELECT game_id, 'home', 31, 'OST Al', 0, 0, 0, NULL, NULL, NULL, 0, NULL FROM games"""
)
def txt_media_summary(spark, d):
    return reports.media_summary(_lines(spark, d, _MEDIA)).drop("pos")


@query(
    f"""WITH {_G} SELECT game_id, 'home' AS side, 12 AS number, 'HALL Max' AS player, game_id % 6 AS shots, 1 AS goals, 0 AS assists, 1 AS points, -1 AS plus_minus, 2 AS pim, 4 AS hits, CAST(NULL AS BIGINT) AS blocks, 5 AS faceoffs, 50.0 AS faceoff_pct,
CASE WHEN game_id % 2 = 0 THEN 20 END AS shifts, CASE WHEN game_id % 2 = 0 THEN 930 END AS toi_seconds FROM games"""
)
def txt_media_skaters(spark, d):
    return reports.media_summary_skaters(_lines(spark, d, _MEDIA)).drop("pos")


@query(f"WITH {_G} SELECT 'goals' AS name, CAST(2 * count(*) AS BIGINT) AS n FROM games UNION ALL SELECT 'penalties', count(*) FROM games UNION ALL SELECT 'goalkeeper_changes', count(*) FROM games UNION ALL SELECT 'team_names', count(*) FROM games")
def txt_dispatch(spark, d):
    """Rows by table of the official reports; every third text is of another kind and gives none."""
    r = _games(spark, d).select("game_id", F.lit("official_game_report").alias("report_type"), F.expr(_REPORT).alias("text"))
    other = r.select("game_id", F.lit("cover").alias("report_type"), "text").filter("game_id % 3 = 0")
    return reports.report_sizes(r.unionByName(other), "official_game_report", "goals", "penalties", "goalkeeper_changes", "team_names")


_CELLS = "'<td>{0}</td><td><strong>' || {1} || '</strong></td><td>({2})</td>'"
_ROW = lambda label, home, away, a, b: f"'<tr>' || {_CELLS.format(label, home, a)} || {_CELLS.format(label, away, b)} || '</tr>'"
_PAGE = f"""'<html><head><title>Home ' || home_team_id || ' - Away</title></head><body><table><tr><td style="text-align: center"><h3>' || if(game_id % 2 = 0, 'Hockeyettan &amp; Co', cast(game_date as string)) || '</h3></td></tr></table><h3>Division Hockey</h3><h3><b>Arena ' || game_id % 5 || '</b></h3><div>' || if(game_id % 3 = 0, '9 - 9</div><div style="font-weight: bold">', '') || home_score || ' - ' || away_score || '</div>'
 || '<p>' || game_date || ', 19:00 Spectators: 5 ' || (100 + game_id % 800) || '</p><p>(' || home_score || '-0, 0-' || away_score || ')</p><h2>' || if(game_id % 2 = 0, '1st period', 'Events') || '</h2><table>'
 || '<tr><td>' || {_CLOCK} || '</td><td>1-0 (PP1)</td><td>HOM</td><td>9. Hall, Max<div>31. Berg, Bo</div><div>Pos. Part.: 13 , 9</div><div>Neg. Part.: ' || game_id % 90 || '</div></td></tr><tr><td>05:00</td><td>' || (2 + game_id % 3) || ' min</td><td>AWY</td><td>8. Kay, Tor <br/>Hooking (05:00 - 07:00)</td></tr><tr><td>45:00</td><td>' || case game_id % 4 when 0 then 'Timeout' when 1 then 'GK Out' when 2 then 'Powerbreak' else 'Coffee' end || '</td><td>AWY</td><td></td></tr>'
 || {_ROW("Shots", "home_sog", "away_sog", "11:10:2", "9:8:7")} || {_ROW("Saves", "(away_sog - away_score)", "(home_sog - home_score)", "1:2:3", "4:5:6")} || '<tr><td class="prc">92,00%</td><td class="prc">88,50%</td></tr>' || {_ROW("PIM", "home_pim", "away_pim", "2:0:0", "x")} || {_ROW("PP", "'50,00%'", "'0,00%'", "04:00", "02:30")} || '</table><h3>Goalkeeper Summary</h3><table><tr><td>HOM</td><td>30. Nor, Ed</td><td><strong>92,00%</strong> (23/25)</td></tr><tr><td>' || if(game_id % 3 = 0, 'A long name of a team', 'ÖIK') || '</td><td>' || (1 + game_id % 40) || '. Ek,\\n  Åsa</td><td class="x"><strong>100%</strong>\\n(' || away_sog || '/' || away_sog || ')</td></tr><tr><td>HOM</td><td>31. Ost, Al</td><td></td></tr></table><h3>Best players</h3><table><tr><td>HOM</td><td>30. Nor, Ed</td><td><strong>92,00%</strong> (23/25)</td></tr></table></body></html>'"""
_GAME = lambda k, teams, result: f"""'<tr class="x"><td class="td{k}">19:00</td><td class="td{k}">' || {teams} || '</td><td class="td{k}">' || {result} || '</td><td class="td{k}">Hall &amp; Co</td></tr>'"""
_LINKED = """if(status = 'FUT', '<a href="/Game/Events/' || game_id || '"> </a>', if(game_id % 2 = 0, '<a href="/Game/Events/' || game_id || '">' || home_score || ' - ' || away_score || '</a>', '<a href="javascript:openonlinewindow(&#39;/Game/Events/' || game_id || '&#39;,1)">' || home_score || '-' || away_score || '</a>'))"""
_DAY = "if(game_id % 7 = 0, 'no day', cast(game_date as string))"
_SCHEDULE = f"""'<table class="tblContent"><tr><th colspan="5">' || {_DAY} || '</th></tr>' || if(game_id % 5 = 0, '', '<tr><td colspan="5"><b><a href="/ScheduleAndResults/' || if(game_id % 2 = 0, 'Schedule', 'Overview') || '/' || (100 + game_type) || '" class="y"><i>League</i> ' || game_type || ' &amp; Co</a></b></td></tr>')
 || {_GAME("Odd", "'<b>Home ' || home_team_id || '</b> - Away'", _LINKED)} || '<tr><td colspan="5"><a href="/ScheduleAndResults/Schedule/9">Cup</a></td></tr>' || {_GAME("Normal", "'All Stars'", "'[1 - 2](x)'")} || {_GAME("Normal", "'To be told'", "''")} || '<tr><td class="tdOdd">no game</td></tr></table>'"""


def _pages(spark, d, text: str):
    return _games(spark, d).select(F.col("game_id").alias("page_id"), F.expr(text).alias("html"))


@query(f"""WITH {_G} SELECT game_id AS page_id, CAST(game_date AS VARCHAR) AS date, CASE WHEN game_id % 5 <> 0 THEN 100 + game_type END AS league_id, CASE WHEN game_id % 5 <> 0 THEN 'League ' || game_type || ' & Co' END AS league, game_id, '19:00' AS time, 'Home ' || home_team_id AS home_team, 'Away' AS away_team,
CASE WHEN status <> 'FUT' THEN home_score || CASE WHEN game_id % 2 = 0 THEN ' - ' ELSE '-' END || away_score END AS result, CASE WHEN status <> 'FUT' THEN home_score END AS home_score, CASE WHEN status <> 'FUT' THEN away_score END AS away_score, 'Hall & Co' AS venue FROM games WHERE game_id % 7 <> 0
UNION ALL SELECT game_id, CAST(game_date AS VARCHAR), 9, 'Cup', NULL, '19:00', 'All Stars', NULL, '1 - 2', 1, 2, 'Hall & Co' FROM games WHERE game_id % 7 <> 0""")
def page_games(spark, d):
    return reports.page_games(_pages(spark, d, _SCHEDULE))


@query(f"WITH {_G} SELECT game_id AS page_id, 'Home ' || home_team_id AS home_team, 'Away' AS away_team FROM games")
def page_title_pair(spark, d):
    return reports.page_header(_pages(spark, d, _PAGE)).select("page_id", "home_team", "away_team")


@query(f"WITH {_G} SELECT game_id AS page_id, CAST(game_date AS VARCHAR) AS day, '19:00' AS time, home_score, away_score, CAST(5100 + game_id % 800 AS BIGINT) AS attendance, 'Arena ' || game_id % 5 AS venue, CASE WHEN game_id % 2 = 0 THEN 'Hockeyettan & Co' ELSE CAST(game_date AS VARCHAR) END AS league FROM games")
def page_header(spark, d):
    return reports.page_header(_pages(spark, d, _PAGE)).drop("home_team", "away_team")


@query(f"WITH {_G} SELECT game_id AS page_id, 1 AS period, home_score AS home, 0 AS away FROM games UNION ALL SELECT game_id, 2, 0, away_score FROM games")
def page_period_scores(spark, d):
    return reports.page_period_scores(_pages(spark, d, _PAGE))


@query(
    f"""WITH {_G} SELECT game_id AS page_id, home_sog AS home_shots, '11,10,2' AS home_shots_by_period, away_sog - away_score AS home_saves, '1,2,3' AS home_saves_by_period, home_pim, '2,0,0' AS home_pim_by_period, 92.0 AS home_save_pct, 50.0 AS home_pp_pct, 240 AS home_pp_seconds,
away_sog AS away_shots, '9,8,7' AS away_shots_by_period, home_sog - home_score AS away_saves, '4,5,6' AS away_saves_by_period, away_pim, CAST(NULL AS VARCHAR) AS away_pim_by_period, 88.5 AS away_save_pct, 0.0 AS away_pp_pct, 150 AS away_pp_seconds FROM games"""
)
def page_boxscore(spark, d):
    return reports.page_boxscore(_pages(spark, d, _PAGE))


@query(f"WITH {_G} SELECT game_id AS page_id, 'HOM' AS team, 30 AS number, 'Nor, Ed' AS name, 92.0 AS save_pct, 23 AS saves, 25 AS shots FROM games UNION ALL SELECT game_id, 'ÖIK', 1 + game_id % 40, 'Ek, Åsa', 100.0, away_sog, away_sog FROM games WHERE game_id % 3 <> 0")
def page_goalkeepers(spark, d):
    return reports.page_goalkeepers(_pages(spark, d, _PAGE))


@query(
    f"""WITH {_G} SELECT game_id AS page_id, {_SEC} AS seconds, CASE WHEN game_id % 2 = 0 THEN 1 ELSE 2 END AS period, 'goal' AS event, 'power_play' AS goal_type, 1 AS power_play_number, 1 AS score_home, 0 AS score_away,
CAST(NULL AS BIGINT) AS penalty_minutes, CAST(NULL AS VARCHAR) AS penalty_type, CAST(NULL AS BIGINT) AS penalty_start, CAST(NULL AS BIGINT) AS penalty_end, CAST(NULL AS VARCHAR) AS goalkeeper_action, 'HOM' AS team, 9 AS player_number, 'Hall' AS player, 'Berg' AS assists, '13,9' AS positive_participants, CAST(game_id % 90 AS VARCHAR) AS negative_participants FROM games
UNION ALL SELECT game_id, 300, CASE WHEN game_id % 2 = 0 THEN 1 ELSE 2 END, 'penalty', NULL, NULL, NULL, NULL, 2 + game_id % 3, 'Tor Hooking', 300, 420, NULL, 'AWY', 8, 'Kay', NULL, NULL, NULL FROM games
UNION ALL SELECT game_id, 2700, CASE WHEN game_id % 2 = 0 THEN 1 ELSE 2 END, CASE game_id % 4 WHEN 0 THEN 'timeout' WHEN 1 THEN 'goalkeeper_change' WHEN 2 THEN 'powerbreak' ELSE 'other' END, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN game_id % 4 = 1 THEN 'out' END, 'AWY', NULL, NULL, NULL, NULL, NULL FROM games"""
)
def page_events(spark, d):
    return reports.page_events(_pages(spark, d, _PAGE)).drop("pos")


@query("SELECT l_orderkey AS k, l_linenumber AS n, CASE WHEN l_quantity * 60 >= 2400 THEN 4 WHEN l_quantity * 60 >= 1200 THEN 3 ELSE 2 END AS period FROM lineitem")
def page_period_infer(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), reports.inferred_period(F.col("l_quantity") * 60).alias("period"))


@query(r"SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<li>')) AS items FROM pages")
def page_outline(spark, d):
    """Titles and list lengths of the web pages themselves."""
    rows = reports.page_rows(table(spark, d, "pages")).groupBy("page_id").agg(F.sum((F.col("kind") == "li").cast("bigint")).alias("items"))
    titles = table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))
    return titles.join(rows, "page_id", "left").select("page_id", "title", F.coalesce("items", F.lit(0)).alias("items"))


def _all_reports(spark, d):
    """All kinds of reports: every fifth game lacks the official one, every fourth the player summary, every third the media summary; of every seventh the reports with plain lines are there twice."""
    g = _games(spark, d)
    kinds = (("official_game_report", _REPORT, 5), ("line_up", "'Referees Zed, Al\\nLinesmen: Yan, Bo\\n' || " + _LINEUP, 0), ("team_roster", _ROSTER, 0), ("game_summary", _SUMMARY, 4), ("media_summary", _MEDIA, 3))
    # A branch for each kind: those of kinds that a reader doesn't take are left out of its plan, with their texts.
    each = [(g.filter(f"game_id % {n} != 0") if n else g).select("game_id", F.lit(k).alias("report_type"), F.expr(text).alias("text")) for k, text, n in kinds]
    rows = reduce(DataFrame.unionByName, each)
    return rows.unionByName(rows.filter("game_id % 7 = 0 AND report_type NOT LIKE '%summary'"))


def _bundled(name: str, sql: str) -> None:
    query(sql, f"pdf_{name}")(lambda spark, d: reports.report_bundle(_all_reports(spark, d))[name].drop("pos", "i", "goal_pos"))


def _where(of: str, where: str, columns: str = "*") -> str:
    return f"SELECT {columns} FROM ({ORACLE_SQL[of]}) WHERE {where}"


_bundled("goals", f"WITH {_G} SELECT g.*, a.assist2 FROM ({ORACLE_SQL['txt_goals']}) g, (SELECT CAST(NULL AS VARCHAR) AS assist2) a WHERE game_id % 5 > 0")
_bundled("penalties", _where("txt_penalties", "game_id % 5 > 0"))
_bundled("goalkeeper_changes", _where("txt_gk_changes", "game_id % 5 > 0", "*, '2' AS period"))
_bundled("period_stats", _where("txt_period_stats", "game_id % 5 > 0"))
_bundled("spectators", _where("txt_spectators", "game_id % 5 > 0"))
_bundled("on_ice", f"WITH {_G} SELECT DISTINCT o.*, '1' AS period, {_SEC} AS seconds FROM ({ORACLE_SQL['txt_on_ice']}) o JOIN games USING (game_id) WHERE game_id % 5 > 0")
_bundled("roster", _where("txt_roster", "true"))
_bundled("lineup", f"SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY game_id, team, number ORDER BY CASE line_number WHEN 'Goalkeepers' THEN 0 WHEN '1st' THEN 1 WHEN '3rd' THEN 2 ELSE 3 END, CASE player WHEN 'JOHANSSON, Anton' THEN 0 ELSE 1 END) AS r FROM ({ORACLE_SQL['txt_lineup']})) WHERE r = 1")
_bundled("referees", f"{_where('txt_referees', 'game_id % 5 > 0')} UNION ALL BY NAME SELECT game_id, role, name FROM (WITH {_G} SELECT game_id FROM games WHERE game_id % 5 = 0), (VALUES ('referee', 'Zed, Al'), ('linesman', 'Yan, Bo')) v(role, name)")
for _name, _media_sql, _summary_sql in (("skaters", "txt_media_skaters", "txt_player_summary"), ("goalies", "txt_media_summary", "txt_summary_goalies")):
    _bundled(_name, f"{_where(_media_sql, 'game_id % 3 > 0', '* REPLACE (CAST(faceoffs AS VARCHAR) AS faceoffs)' if _name == 'skaters' else '*')} UNION ALL BY NAME {_where(_summary_sql, 'game_id % 3 = 0 AND game_id % 4 > 0')}")
