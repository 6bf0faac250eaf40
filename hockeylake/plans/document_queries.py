"""Document extraction over documents that are built from whole tables and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from hockeylake.operators import documents as doc
from hockeylake.plans.adapters import cte, spread_games, table, view
from hockeylake.plans.data_queries import scratch
from hockeylake.plans.registry import query

_G = cte("games")
_WRITTEN: dict[tuple[str, str, str], str] = {}


def _written(spark, d, name: str, make):
    """Documents that are written once a session and folder of tables, as a reader of documents finds them, and then read."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _WRITTEN:
        path = scratch(spark, name)
        make().write.parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])


def prepare(spark, d) -> None:
    """Write the documents of games and leagues, so that what follows is extraction alone."""
    _games(spark, d)
    _details(spark, d)


def _games(spark, d):
    """Game documents: every second one in the live-data layout."""
    g = spread_games(spark, d).withColumn("season_id", F.col("season"))
    side = lambda s: f"named_struct('id', {s}_team_id, 'abbrev', 'T' || {s}_team_id, 'score', {s}_score, 'sog', {s}_sog)"
    player = lambda k, pos: f"named_struct('playerId', game_id * 10 + {k}, 'position', '{pos}', 'goals', home_score, 'assists', 1, 'sog', 2, 'toi', '12:' || lpad(game_id % 60, 2, '0'), 'hits', game_id % 3, 'pim', 0, 'powerPlayGoals', home_pp_goals, 'blockedShots', {k}, 'giveaways', 1, 'plusMinus', {k} - 2, 'faceoffWinningPctg', 0.5, 'saves', 20, 'shotsAgainst', 22, 'goalsAgainst', 2, 'savePctg', 0.875)"
    stats = lambda k: f"named_struct('forwards', array({player(k, 'C')}), 'goalies', array({player(k + 1, 'MV')}))"
    play = "named_struct('about', named_struct('eventId', if(game_id % 4 < 2, 7, null), 'period', '1', 'periodTime', '03:20'), 'result', named_struct('eventTypeId', 'goal', 'description', status), 'team', named_struct('triCode', 'T' || home_team_id), 'players', array(named_struct('playerId', 0), named_struct('playerId', game_id), named_struct('playerId', game_id + 1)))"
    a = f"""to_json(named_struct('gameId', cast(game_id as string), 'boxscore', named_struct('id', game_id, 'season', season, 'gameState', status, 'gameType', cast(game_type as string), 'startTimeUTC', game_date || 'T18:00:00Z', 'regPeriods', 3, 'limitedScoring', game_id % 4 = 0, 'venue', named_struct('default', 'Arena'), 'venueLocation', named_struct('default', 'Town'), 'gameOutcome', named_struct('otPeriods', if(last_period_type = 'OT', 1, null), 'lastPeriodType', last_period_type), 'periodDescriptor', named_struct('number', 3, 'periodType', last_period_type),
      'homeTeam', {side('home')}, 'awayTeam', {side('away')}, 'playerByGameStats', named_struct('homeTeam', {stats(1)}, 'awayTeam', {stats(3)})), 'playByPlay', named_struct('plays', array({play})), 'gameStory', named_struct('headline', if(game_id % 6 = 0, '', 'H' || game_id), 'body', '')))"""
    live = lambda k: f"named_struct('person', named_struct('id', game_id * 10 + {k}), 'position', named_struct('abbreviation', 'D'), 'stats', named_struct('skaterStats', named_struct('goals', 1, 'assists', 2, 'shots', 3, 'timeOnIce', '10:00')))"
    team = lambda s: f"named_struct('teamSkaterStats', named_struct('shots', {s}_sog, 'powerPlayGoalCount', {s}_pp_goals, 'powerPlayOpportunities', {s}_pp_opps, 'hits', game_id % 5, 'blocked', 0, 'blockedShots', 8, 'penaltyMinutes', {s}_pim, 'giveaways', 2, 'faceOffWinPercentage', '51.5'), 'teamGoalieStats', named_struct('hits', 1, 'takeaways', 0, 'penaltyMinutes', 0))"
    b = f"""to_json(named_struct('gameData', named_struct('game', named_struct('pk', game_id, 'season', season, 'type', cast(game_type as string)), 'status', named_struct('detailedState', status), 'venue', named_struct('name', 'Arena'), 'teams', named_struct('home', named_struct('id', home_team_id, 'abbreviation', 'T' || home_team_id), 'away', named_struct('id', away_team_id, 'abbreviation', 'T' || away_team_id))),
      'liveData', named_struct('linescore', named_struct('teams', named_struct('home', named_struct('goals', home_score), 'away', named_struct('goals', away_score))), 'plays', named_struct('allPlays', array({play})),
      'boxscore', named_struct('teams', named_struct('home', named_struct('team', named_struct('triCode', 'T' || home_team_id), 'teamStats', {team('home')}, 'players', map('ID1', {live(1)}, 'ID2', {live(2)})), 'away', named_struct('team', named_struct('triCode', 'T' || away_team_id), 'teamStats', {team('away')}, 'players', map('ID3', {live(3)})))))))"""
    docs = lambda: g.select(F.concat(F.lit("k/"), "game_id").alias("key"), F.col("game_date"), F.expr(f"if(game_id % 2 = 0, {a}, {b})").alias("payload"))
    return doc.parse_games(_written(spark, d, "game-documents", docs))


_PTS = "CASE WHEN {o} > {t} THEN 2 WHEN {o} < {t} AND (contains(status, 'OT') OR contains(status, 'SO')) THEN 1 WHEN {o} < {t} THEN 0 END"
_POINTS = f"CAST({_PTS.format(o='home_score', t='away_score')} AS BIGINT) AS home_points, CAST({_PTS.format(o='away_score', t='home_score')} AS BIGINT) AS away_points"


_EVEN = "CASE WHEN game_id % 2 = 0 THEN {} ELSE {} END AS {}"
_BOTH = ", ".join(
    _EVEN.format(even.replace("@", s), odd.replace("@", s), f"{s}_{name}")
    for name, even, odd in (
        ("sog", "@_sog", "@_sog"), ("pp_goals", "nullif(2 * home_pp_goals, 0)", "nullif(@_pp_goals, 0)"), ("pp_opportunities", "CAST(NULL AS BIGINT)", "@_pp_opps"), ("hits", "nullif(2 * (game_id % 3), 0)", "coalesce(nullif(game_id % 5, 0), 1)"),
        ("blocked", "CASE WHEN '@' = 'home' THEN 3 ELSE 7 END", "8"), ("pim", "CAST(NULL AS BIGINT)", "CASE WHEN @_pim = 0 THEN 0 ELSE @_pim END"), ("giveaways", "2", "2"), ("takeaways", "CAST(NULL AS BIGINT)", "0"), ("faceoff_pct", "CAST(NULL AS DOUBLE)", "CAST(51.5 AS DOUBLE)"),
    )
    for s in ("home", "away")
)
_BOX_ONLY = ", ".join(
    f"CASE WHEN game_id % 2 = 0 THEN {value} END AS {name}"
    for name, value in (
        ("last_period_type", "last_period_type"), ("venue_location", "'Town'"), ("start_time_utc", "CAST(game_date AS VARCHAR) || 'T18:00:00Z'"), ("reg_periods", "3"), ("limited_scoring", "game_id % 4 = 0"), ("game_state", "status"),
        ("ot_periods", "CASE WHEN last_period_type = 'OT' THEN 1 END"), ("period_number", "3"), ("period_type", "last_period_type"),
    )
)


@query(
    f"""WITH {_G} SELECT game_id, game_date, season, CAST(game_type AS VARCHAR) AS game_type, status, 'Arena' AS venue, home_team_id, 'T' || home_team_id AS home_team_abbr, away_team_id, 'T' || away_team_id AS away_team_abbr,
home_score, away_score, {_BOTH}, {_BOX_ONLY}, {_POINTS} FROM games"""
)
def trf_games(spark, d):
    return doc.extract_games(_games(spark, d))


@query(f"WITH {_G} SELECT game_id, CASE WHEN game_id % 2 = 0 THEN nullif(2 * (game_id % 3), 0) ELSE coalesce(nullif(game_id % 5, 0), 1) END AS hits, CASE WHEN game_id % 2 = 1 THEN away_pim END AS pim, 2 AS giveaways FROM games")
def trf_team_totals(spark, d):
    return doc.extract_games(_games(spark, d)).select("game_id", F.col("away_hits").alias("hits"), F.col("away_pim").alias("pim"), F.col("away_giveaways").alias("giveaways"))


@query(f"WITH {_G} SELECT game_id, away_sog, CASE WHEN game_id % 2 = 1 THEN away_pp_opps END AS away_pp_opportunities, CASE WHEN game_id % 2 = 1 THEN 0 END AS away_takeaways FROM games")
def trf_team_stat_fallback(spark, d):
    return doc.extract_games(_games(spark, d)).select("game_id", "away_sog", "away_pp_opportunities", "away_takeaways")


_PLAYED = "game_id, game_id * 10 + k AS player_id, k < 3 AS is_home, 'T' || CASE WHEN k < 3 THEN home_team_id ELSE away_team_id END AS team_abbr"
_BOX = f"SELECT {_PLAYED}, CASE WHEN k % 2 = 1 THEN 'C' ELSE 'G' END AS position, home_score AS goals, home_score + 1 AS points, k - 2 AS plus_minus, CAST(k AS BIGINT) AS blocked_shots, 720 + game_id % 60 AS toi_seconds, CASE WHEN k % 2 = 0 THEN 20 END AS saves, CASE WHEN k % 2 = 0 THEN round(7200.0 / (720 + game_id % 60), 4) END AS gaa FROM games, (VALUES (1), (2), (3), (4)) v(k) WHERE game_id % 2 = 0"
_LIVE = f"SELECT {_PLAYED}, 'D' AS position, 1 AS goals, 3 AS points, CAST(NULL AS BIGINT) AS plus_minus, CAST(NULL AS BIGINT) AS blocked_shots, 600 AS toi_seconds, CAST(NULL AS BIGINT) AS saves, CAST(NULL AS DOUBLE) AS gaa FROM games, (VALUES (1), (2), (3)) v(k) WHERE game_id % 2 = 1"
_PLAYER_COLUMNS = ("game_id", "player_id", "is_home", "team_abbr", "position", "goals", "points", "plus_minus", "blocked_shots", "toi_seconds", "saves", "gaa")


@query(f"WITH {_G} {_BOX} UNION ALL {_LIVE}")
def trf_players_boxscore(spark, d):
    return doc.extract_players(_games(spark, d)).select(*_PLAYER_COLUMNS)


@query(f"WITH {_G} SELECT team_abbr, is_home, CAST(count(*) AS BIGINT) AS players, CAST(sum(points) AS BIGINT) AS points, CAST(sum(toi_seconds) AS BIGINT) AS toi_seconds FROM ({_LIVE} UNION ALL {_BOX}) GROUP BY team_abbr, is_home")
def trf_players_livedata(spark, d):
    p = doc.extract_players(_games(spark, d)).groupBy("team_abbr", "is_home")
    return p.agg(F.count("*").alias("players"), F.sum("points").alias("points"), F.sum("toi_seconds").alias("toi_seconds"))


@query(f"WITH {_G} SELECT game_id, CASE WHEN game_id % 4 < 2 THEN 7 ELSE 0 END AS event_id, 'GOAL' AS event_type, '1' AS period, '' AS period_type, '03:20' AS time_remaining, 200 AS period_seconds, 'T' || home_team_id AS team_abbr, CASE WHEN game_id > 0 THEN game_id ELSE 1 END AS player_id, CASE WHEN game_id > 0 THEN game_id + 1 END AS player2_id, status AS description FROM games")
def trf_game_events(spark, d):
    return doc.extract_events(_games(spark, d)).drop("game_date")


@query(f"WITH {_G} SELECT game_id, 'H' || game_id AS headline, '' AS body FROM games WHERE game_id % 2 = 0 AND game_id % 6 <> 0")
def trf_game_stories(spark, d):
    return doc.extract_stories(_games(spark, d))


#: The page of a season's list that a game stands on, so that a document has a thousand games at most, however large the tables are.
_PAGE_OF = "game_id div 1000 AS page"


def _variants(df, *columns):
    """One document a row, from SQL that builds its JSON."""
    return df.select(*columns[:-1], F.try_parse_json(columns[-1]).alias("doc"))


def _json(text: str, name: str = "payload"):
    return F.expr(f"to_json({text})").alias(name)


@query("SELECT n_nationkey AS id, 'T' || n_nationkey AS abbr, n_name AS name, CASE WHEN n_regionkey % 2 = 0 THEN 'R' || n_regionkey END AS conference_abbr, r_name AS conference_name, CASE WHEN n_nationkey % 4 = 1 THEN 'D1' END AS division_abbr, CAST(n_nationkey % 4 AS VARCHAR) AS division_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def trf_teams(spark, d):
    """A document for each region, in turn a list and lists below teams, data and items; each has entries that are no teams."""
    t = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    one = "concat(substr(to_json(named_struct('id', n_nationkey, 'conference', named_struct('abbr', if(n_regionkey % 2 = 0, 'R' || n_regionkey, null), 'name', r_name), 'division', named_struct('abbr', if(n_nationkey % 4 = 1, 'D1', null), 'name', cast(n_nationkey % 4 as string)))), 1, 1), if(n_nationkey % 2 = 0, '\"abbr\"', '\"abbrev\"'), ':\"T', n_nationkey, '\",\"name\":', if(n_nationkey % 3 = 0, to_json(named_struct('default', n_name)), '\"' || n_name || '\"'), ',', substr(to_json(named_struct('id', n_nationkey, 'conference', named_struct('abbr', if(n_regionkey % 2 = 0, 'R' || n_regionkey, null), 'name', r_name), 'division', named_struct('abbr', if(n_nationkey % 4 = 1, 'D1', null), 'name', cast(n_nationkey % 4 as string)))), 2))"
    docs = t.groupBy("n_regionkey").agg(F.concat(F.lit('['), F.array_join(F.collect_list(F.expr(one)), ","), F.lit(',"none",7,null]')).alias("list"))
    shape = "case n_regionkey % 4 when 0 then list when 1 then '{\"teams\":' || list || '}' when 2 then '{\"teams\":{},\"data\":' || list || '}' else '{\"items\":' || list || '}' end"
    return doc.extract_teams(_variants(docs.select(F.expr(shape).alias("payload")), "payload"))


@query("SELECT DISTINCT p_partkey AS id, split_part(p_name, ' ', 1) AS first_name, CASE WHEN p_partkey % 3 = 0 THEN 'G' ELSE 'C' END AS position FROM part")
def trf_players_dim(spark, d):
    p = table(spark, d, "part")
    one = "named_struct('id', p_partkey, 'firstName', named_struct('default', split_part(p_name, ' ', 1)), 'lastName', named_struct('default', p_brand), 'position', if(p_partkey % 3 = 0, 'MV', 'c'))"
    people = lambda rest, shape: p.filter(f"p_partkey % 3 = {rest}").groupBy("p_brand").agg(F.expr(shape).alias("payload"))
    docs = (
        people(0, f"if(p_brand < 'Brand#3', to_json(collect_list({one})), if(p_brand < 'Brand#4', to_json(named_struct('data', collect_list({one}))), to_json(named_struct('items', concat(collect_list({one}), collect_list({one}))))))")
        .unionByName(people(1, f"to_json(array(named_struct('forwards', collect_list({one}))))"))
        .unionByName(people(2, f"to_json(map('7', array(named_struct('goalies', collect_list({one})))))"))
    )
    return doc.extract_players_dim(_variants(docs, "payload")).select("id", "first_name", "position")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name FROM nation")
def trf_countries(spark, d):
    """Maps to names and to localised names, and lists in a document or below countries, data and items."""
    n = table(spark, d, "nation")
    one = "named_struct('code', cast(n_nationkey as string), 'name', n_name)"
    shapes = (f"to_json(map(cast(n_nationkey as string), n_name))", "to_json(map(cast(n_nationkey as string), named_struct('default', n_name)))", f"to_json(array({one}))", f"to_json(named_struct('countries', array({one})))", f"to_json(named_struct('data', array(named_struct('countryCode', cast(n_nationkey as string), 'countryName', named_struct('default', n_name)))))", f"to_json(named_struct('items', array({one})))")
    docs = n.select(F.expr("case n_nationkey % 6 " + " ".join(f"when {i} then {x}" for i, x in enumerate(shapes)) + " end").alias("payload"))
    return doc.extract_countries(_variants(docs, "payload"))


def _roster_docs(spark, d):
    c = table(spark, d, "customer").groupBy("c_nationkey").agg(
        F.expr("""case when c_nationkey % 5 = 0 then to_json(named_struct('rosters', named_struct('teams', named_struct('data', named_struct('items', collect_list(named_struct('team_id', c_nationkey, 'player_id', c_custkey)))))))
        when c_nationkey % 5 = 1 then to_json(named_struct('rosters', named_struct('data', named_struct('items', collect_list(named_struct('teamId', c_nationkey, 'playerId', c_custkey))))))
        when c_nationkey % 5 = 2 then to_json(named_struct('items', collect_list(named_struct('season', '20232024', 'team_id', c_nationkey, 'id', c_custkey))))
        when c_nationkey % 3 = 0 then to_json(map(cast(c_nationkey as string), collect_list(c_custkey), '_meta', array(1L)))
        when c_nationkey % 3 = 1 then to_json(map(cast(c_nationkey as string), collect_list(named_struct('id', c_custkey)))) else to_json(map(cast(c_nationkey as string), named_struct('forwards', collect_list(named_struct('playerId', c_custkey))))) end""").alias("payload")
    )
    return _variants(c.select(F.lit("20232024").alias("season"), "payload"), "season", "payload")


@query("SELECT DISTINCT '20232024' AS season, CAST(c_nationkey AS BIGINT) AS team_id, c_custkey AS player_id FROM customer")
def trf_roster(spark, d):
    return doc.extract_roster(_roster_docs(spark, d))


@query("SELECT DISTINCT '20232024' AS season, CAST(c_nationkey AS BIGINT) AS team_id, c_custkey AS player_id, CASE WHEN c_nationkey < 20 THEN 'T' || c_nationkey END AS team_abbr FROM customer")
def trf_roster_lookup(spark, d):
    return doc.roster_with_teams(doc.extract_roster(_roster_docs(spark, d)), view(spark, d, "teams").filter("team_id < 20"))


@query(
    f"""WITH {_G}, s AS (SELECT *, season // 10000 % 3 AS k, CAST(game_date AS VARCHAR) AS day FROM games) SELECT day AS schedule_date, day AS schedule_source_key, game_id, CASE WHEN k > 0 THEN day || 'T00:00:00Z' END AS game_date, CASE WHEN k > 0 THEN season END AS season, home_team_id, away_team_id,
CASE WHEN k > 0 THEN CAST(game_type AS VARCHAR) END AS game_type, status, CASE WHEN k > 0 THEN day || 'T18:30:00Z' END AS start_time_utc, CASE WHEN k > 0 THEN status END AS game_state, CASE WHEN k > 0 THEN 'Hall' END AS venue FROM s"""
)
def trf_schedule(spark, d):
    g = view(spark, d, "games").withColumn("day", F.col("game_date").cast("string"))
    old = "collect_list(named_struct('gamePk', game_id, 'status', named_struct('detailedState', status), 'teams', named_struct('home', named_struct('id', home_team_id), 'away', named_struct('id', away_team_id))))"
    new = "collect_list(named_struct('id', game_id, 'gameDate', day || 'T00:00:00Z', 'season', season, 'gameType', cast(game_type as string), 'gameState', status, 'startTimeUTC', day || 'T18:30:00Z', 'venue', named_struct('default', 'Hall'), 'homeTeam', named_struct('id', home_team_id), 'awayTeam', named_struct('id', away_team_id)))"
    shape = F.expr(f"case season div 10000 % 3 when 0 then to_json(named_struct('dates', array(named_struct('date', day, 'games', {old})))) when 1 then to_json(named_struct('gameWeek', array(named_struct('date', day, 'games', {new})))) else to_json(named_struct('games', {new})) end")
    return doc.extract_schedule(_variants(g.groupBy("season", "day").agg(shape.alias("payload")).select(F.col("day").alias("key"), "payload"), "key", "payload"))


@query(f"WITH {_G} SELECT DISTINCT CAST(season AS VARCHAR) AS season, game_id FROM games WHERE season // 10000 % 6 < 5 UNION ALL SELECT CAST(season AS VARCHAR), max(game_id) FROM games WHERE season // 10000 % 6 = 5 GROUP BY season")
def trf_game_ids(spark, d):
    """Documents of a season's games by their page, in five shapes of lists; every sixth season has one document with its last id alone."""
    games = view(spark, d, "games")
    g = games.filter("season div 10000 % 6 < 5").groupBy("season", F.expr(_PAGE_OF)).agg(F.expr("case season div 10000 % 6 when 0 then to_json(collect_list(game_id)) when 1 then to_json(named_struct('gameIds', collect_list(game_id))) when 2 then to_json(named_struct('games', collect_list(named_struct('gamePk', game_id)))) when 3 then to_json(named_struct('season', cast(season as string), 'game_ids', collect_list(cast(game_id as string)))) else to_json(named_struct('data', named_struct('items', collect_list(named_struct('id', game_id))))) end").alias("payload")).drop("page")
    g = g.unionByName(games.filter("season div 10000 % 6 = 5").groupBy("season").agg(F.expr("to_json(named_struct('gameIds', max(game_id)))").alias("payload")))
    return doc.extract_game_ids(_variants(g.select(F.when(F.expr("season div 10000 % 6 != 3"), F.col("season").cast("string")).alias("season"), "payload"), "season", "payload"))


@query("SELECT CASE WHEN p_size % 6 < 5 THEN p_name ELSE p_type END AS term, CASE WHEN p_size % 6 < 5 THEN p_type END AS definition FROM part")
def trf_glossary_draft(spark, d):
    """Terms in a list and below each of the keys, and scalar ones."""
    one = "array(named_struct('term', p_name, 'definition', p_type))"
    shapes = (f"to_json({one})", *(f"to_json(named_struct('{k}', {one}))" for k in ("terms", "data", "items", "glossary")), "to_json(named_struct('data', array(p_type)))")
    p = table(spark, d, "part").select(F.expr("case p_size % 6 " + " ".join(f"when {i} then {x}" for i, x in enumerate(shapes)) + " end").alias("payload"))
    return doc.extract_terms(_variants(p, "payload"))


@query("SELECT CASE WHEN p_size % 5 < 4 THEN p_partkey END AS draft_year, CASE WHEN p_size % 5 < 4 THEN p_size END AS rounds, CASE WHEN p_size % 5 = 4 THEN p_type END AS value FROM part")
def trf_draft(spark, d):
    one = "array(named_struct('draftYear', p_partkey, 'rounds', p_size))"
    shapes = (f"to_json({one})", *(f"to_json(named_struct('{k}', {one}))" for k in ("rounds", "years", "items")), "to_json(named_struct('data', array(p_type)))")
    p = table(spark, d, "part").select(F.expr("case p_size % 5 " + " ".join(f"when {i} then {x}" for i, x in enumerate(shapes)) + " end").alias("payload"))
    return doc.extract_draft(_variants(p, "payload"))


@query("SELECT CAST(19950000 + s_nationkey AS BIGINT) AS season, CAST(s_suppkey AS VARCHAR) AS series_letter, s_name AS series_title, 'R1' AS series_abbrev, CAST(1 + s_suppkey % 4 AS BIGINT) AS round, 1 AS top_seed_rank, 'D1' AS top_seed_rank_abbrev, 'T' || s_nationkey AS top_seed, s_nationkey AS top_seed_id, CAST(4 AS BIGINT) AS top_wins, CAST(NULL AS BIGINT) AS bottom_seed_rank, CAST(NULL AS VARCHAR) AS bottom_seed_rank_abbrev, s_suppkey % 4 AS bottom_wins, s_suppkey AS bottom_seed_id, CAST(NULL AS VARCHAR) AS bottom_seed, s_nationkey AS winning_team_id, CAST(NULL AS BIGINT) AS losing_team_id FROM supplier")
def trf_playoffs(spark, d):
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(
        F.expr("if(s_nationkey % 2 = 0, '{\"season\":' || (19950000 + s_nationkey) || ',\"series\":', '{\"season\":' || (19950000 + s_nationkey) || ',\"data\":{\"series\":') || to_json(concat(collect_list(named_struct('seriesLetter', cast(s_suppkey as string), 'playoffRound', 1 + s_suppkey % 4, 'seriesTitle', s_name, 'seriesAbbrev', 'R1', 'topSeedRank', 1, 'topSeedRankAbbrev', 'D1', 'topSeedTeam', named_struct('id', s_nationkey, 'abbrev', 'T' || s_nationkey), 'topSeedWins', 4, 'bottomSeedWins', s_suppkey % 4, 'bottomSeedTeam', named_struct('id', s_suppkey), 'winningTeamId', s_nationkey)), array(named_struct('seriesLetter', cast(min(s_suppkey) as string), 'playoffRound', 99L, 'seriesTitle', 'again', 'seriesAbbrev', 'R1', 'topSeedRank', 1, 'topSeedRankAbbrev', 'D1', 'topSeedTeam', named_struct('id', s_nationkey, 'abbrev', 'T' || s_nationkey), 'topSeedWins', 4, 'bottomSeedWins', 0L, 'bottomSeedTeam', named_struct('id', 0L), 'winningTeamId', s_nationkey)))) || if(s_nationkey % 2 = 0, '}', '}}')").alias("payload")
    )
    return doc.extract_playoffs(_variants(s, "payload"))


@query("SELECT CAST(c_nationkey AS VARCHAR) AS season, c_custkey AS player_id, c_name AS name, CAST(c_custkey % 50 AS BIGINT) AS goals, CAST(c_custkey % 90 AS BIGINT) AS points FROM customer")
def trf_season_stats(spark, d):
    one = "named_struct('playerId', c_custkey, 'skaterFullName', c_name, 'goals', c_custkey % 50, 'points', c_custkey % 90)"
    c = table(spark, d, "customer").groupBy("c_nationkey").agg(F.expr(f"case c_nationkey % 3 when 0 then to_json(collect_list({one})) when 1 then to_json(named_struct('data', collect_list({one}))) else to_json(named_struct('skaters', collect_list({one}))) end").alias("payload"))
    return doc.extract_season_stats(_variants(c.select(F.col("c_nationkey").cast("string").alias("season"), "payload"), "season", "payload")).select("season", "player_id", "name", "goals", "points")


@query("SELECT CAST(s_nationkey AS VARCHAR) AS season, s_suppkey AS team_id, s_name AS name, s_suppkey % 82 AS games, s_suppkey % 100 AS points, s_suppkey % 7 * 0.125 AS points_pct FROM supplier")
def trf_season_team_stats(spark, d):
    one = "named_struct('teamId', s_suppkey, 'teamFullName', s_name, 'gamesPlayed', s_suppkey % 82, 'points', s_suppkey % 100, 'pointPct', s_suppkey % 7 * 0.125D)"
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.expr(f"case s_nationkey % 3 when 0 then to_json(named_struct('data', named_struct('teams', named_struct('items', collect_list({one}))))) when 1 then to_json(named_struct('data', named_struct('items', collect_list({one})))) else to_json(named_struct('teams', collect_list({one}))) end").alias("payload"))
    return doc.extract_season_stats(_variants(s.select(F.col("s_nationkey").cast("string").alias("season"), "payload"), "season", "payload"), "teams").select("season", "team_id", "name", "games", "points", "points_pct")


@query("SELECT '2024' AS season, s_nationkey AS team_id, s_suppkey AS player_id, CASE WHEN s_nationkey % 2 = 1 THEN 'T' || s_nationkey END AS team_abbr FROM supplier")
def trf_roster_fallback(spark, d):
    """Rosters from players by team, since there are none; half the teams keyed by id, half in a list."""
    keyed = "to_json(map(cast(s_nationkey as string), array(named_struct('forwards', collect_list(named_struct('id', s_suppkey))))))"
    listed = "to_json(named_struct('teams', named_struct('data', named_struct('items', array(named_struct('id', s_nationkey, 'triCode', 'T' || s_nationkey, 'goalies', collect_list(s_suppkey)))))))"
    docs = _variants(table(spark, d, "supplier").groupBy("s_nationkey").agg(F.expr(f"if(s_nationkey % 2 = 0, {keyed}, {listed})").alias("payload")), "payload")
    none = doc.extract_roster(_roster_docs(spark, d)).filter("team_id < 0")
    return doc.roster_or_fallback(none, doc.roster_from_players_by_team(docs, "2024"))


@query(
    """SELECT CAST(s_nationkey AS VARCHAR) AS season, 'D' || s_nationkey AS division, CASE WHEN s_nationkey % 2 = 0 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'own' ELSE 'East' END END AS conference, CASE WHEN s_nationkey % 2 = 0 THEN 'regular' END AS standings_type, s_name AS team_abbr, CAST(NULL AS VARCHAR) AS team_name,
CASE WHEN s_nationkey % 2 = 0 THEN s_suppkey END AS team_id, CAST(NULL AS BIGINT) AS franchise_id, CAST(NULL AS BIGINT) AS games, CAST(s_suppkey % 40 AS BIGINT) AS wins, CAST(NULL AS BIGINT) AS losses, CASE WHEN s_nationkey % 2 = 1 THEN s_suppkey % 9 END AS ot_losses,
CAST(s_suppkey % 100 AS BIGINT) AS points, CAST(NULL AS BIGINT) AS goals_for, CAST(NULL AS BIGINT) AS goals_against FROM supplier"""
)
def trf_standings(spark, d):
    one = "named_struct('team', named_struct('id', s_suppkey, 'abbrev', s_name), 'conference', if(s_suppkey % 2 = 0, 'own', null), 'points', s_suppkey % 100, 'leagueRecord', named_struct('wins', s_suppkey % 40))"
    nested = f"to_json(named_struct('records', array(named_struct('standingsType', 'regular', 'division', named_struct('name', 'D' || s_nationkey), 'conference', 'East', 'teamRecords', concat(collect_list({one}), collect_list({one}))))))"
    flat = "to_json(named_struct('standings', collect_list(named_struct('teamAbbrev', named_struct('default', s_name), 'divisionName', 'D' || s_nationkey, 'points', s_suppkey % 100, 'wins', s_suppkey % 40, 'otLosses', s_suppkey % 9))))"
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.expr(f"if(s_nationkey % 2 = 0, {nested}, {flat})").alias("payload"))
    return doc.extract_standings(_variants(s.select(F.col("s_nationkey").cast("string").alias("season"), "payload"), "season", "payload"))


@query("SELECT CAST(s_nationkey AS VARCHAR) AS season, s_name AS category, s_suppkey AS entity_id, 'T' || s_nationkey AS team_abbr, CAST(s_suppkey % 160 AS DOUBLE) AS metric, CASE WHEN s_nationkey % 2 = 0 THEN CAST(s_suppkey % 99 AS DOUBLE) END AS imperial FROM supplier")
def trf_edge_leaders(spark, d):
    a = "named_struct('player', named_struct('id', s_suppkey, 'team', named_struct('abbrev', 'T' || s_nationkey)), 'speed', named_struct('metric', s_suppkey % 160, 'imperial', s_suppkey % 99))"
    b = "named_struct('team', named_struct('id', s_suppkey, 'abbrev', 'T' || s_nationkey), 'distance', s_suppkey % 160)"
    pairs = lambda x: f"to_json(named_struct('leaders', map_from_entries(collect_list(struct(s_name, {x})))))"
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.expr(f"if(s_nationkey % 2 = 0, {pairs(a)}, {pairs(b)})").alias("payload"))
    return doc.extract_edge_leaders(_variants(s.select(F.col("s_nationkey").cast("string").alias("season"), "payload"), "season", "payload"))


def _details(spark, d):
    """League documents, one for each order: every second one with lines as arrays, the others with places by name; every list has entries that don't belong."""
    g = spread_games(spark, d).withColumn("day", F.col("game_date").cast("string"))
    p = lambda number, more="": f"""'{{"number": {number}, "name": "P{number}"{more}}}'"""
    own = """'{"number": "' || (game_id % 30) || '", "name": "G", "position": "mv", "starting": true}'"""
    arrays = f"""'[{{"line": 1, "forwards": [' || {p(11, ', "position": "lw"')} || ', "none"], "defense": [' || {p(12)} || ', null]}}, 7]'"""
    named = f"""'[{{"line_number": "2", "left_wing": ' || {p(13)} || ', "center": ' || {p(14, ', "position": "ce"')} || ', "right_wing": null, "left_defense": ' || {p(15)} || ', "right_defense": "x", "left": ' || {p(1)} || '}}]'"""
    home = f"""'{{"team": " Home  ' || home_team_id || '", "head_coach": "C", "goalies": [' || {own} || ', "none"], "lines": ' || if(game_id % 2 = 0, {arrays}, {named}) || ', "extra_players": [' || {p(99)} || ', {{"number": 99, "name": "again"}}]}}'"""
    away = f"""if(game_id % 3 = 0, '"none"', '{{"team": "Away", "head_coach": null, "assistant_coach": "AC", "goalies": null, "lines": [], "extra_players": [' || {p(0)} || ']}}')"""
    periods = """'{"period": "1", "home": ' || home_score || ', "away": 0}, {"period": 2, "home": "0", "away": ' || away_score || '}' || if(last_period_type = 'REG', '', ', {"period": "' || last_period_type || '", "home": 0, "away": 0}')"""
    text = f"""'{{"game_id": "' || game_id || '", "date": "' || day || '", "home_team": " Home  ' || home_team_id || '\\\\t", "away_team": "Away ' || away_team_id || '", "home_score": ' || if(game_id % 3 = 0, 'null', cast(home_score as string)) || ', "away_score": ' || if(game_id % 3 = 0, 'null', '"' || away_score || '"') || ',
      "result": "' || home_score || ' - ' || away_score || '", "venue": "Hall  A", "league": "' || if(game_type = 3, 'SM-slutspel', 'SHL') || '", "period_scores": [' || {periods} || '],
      "time": "19:00", "league_id": ' || if(game_id % 2 = 0, '"L1"', 'null') || ', "metadata": {{"scraped_at": "' || day || 'T10:00:00.123456789"}}, "home_team_stats": {{"shots": ' || home_sog || ', "saves": ' || (away_sog - away_score) || ', "penalty_minutes": ' || home_pim || '}}, "away_team_stats": {{"shots": ' || away_sog || ', "saves": ' || (home_sog - home_score) || '}},
      "events": [{{"time": "12:34", "period": "1", "team": "Home", "event_type": "goal", "player_name": "P", "player_number": ' || game_id % 90 || ', "score_home": 1, "score_away": "0", "goal_type": "PP1", "powerplay_number": 1, "assists": [{{"number": 5, "name": "P5"}}], "positive_participants": [1, "2"], "negative_participants": [' || game_id % 20 || ']}}, {{"time": "12:34", "period": 1, "event_type": "goal", "player_name": "P"}}, {{"event_type": "penalty", "penalty_minutes": "2", "penalty_type": "Hooking", "penalty_start": "12:34", "assists": []}}],
      "goalkeepers": [{{"team": "Home", "number": 30, "name": "G' || home_team_id || '", "saves": ' || (away_sog - away_score) || ', "shots_against": "' || away_sog || '", "save_percentage": "91.5"}}, {{"number": 0, "team": null}}],
      "player_stats": [{{"player_name": "P", "player_id": 7, "team": "Home", "goals": ' || home_score || ', "assists": "1", "pim": null, "shots": 3, "plusMinus": ' || if(game_id % 2 = 0, '1', '0') || ', "plus_minus": -1}}],
      "referees": ["R' || game_id % 9 || '", {{"name": "O' || game_id % 7 || '", "role": "Head"}}, {{"role": null, "name": "Q"}}, 5], "linesmen": ["L' || game_id % 5 || '", {{"name": "M", "role": "Judge"}}, "R' || game_id % 9 || '"], "home_team_lineup": ' || {home} || ', "away_team_lineup": ' || {away} || '}}'"""
    return doc.parse_details(_written(spark, d, "league-documents", lambda: g.select(F.expr(text).alias("payload"))))


_LEAGUE_TAGS = "CAST(game_id AS VARCHAR) AS game_id, game_date, CAST(year(game_date) AS VARCHAR) AS season, CASE WHEN game_type = 3 THEN 'SM-slutspel' ELSE 'SHL' END AS league"


_LEAGUE_POINTS = ", ".join(f"CAST({_PTS.format(o=o, t=t)} AS BIGINT) AS {n}".replace("(contains(status, 'OT') OR contains(status, 'SO'))", "last_period_type <> 'REG'") for o, t, n in (("home_score", "away_score", "home_points"), ("away_score", "home_score", "away_points")))


@query(
    f"""WITH {_G} SELECT CAST(game_id AS VARCHAR) AS game_id, CAST(game_date AS VARCHAR) AS game_date, CAST(year(game_date) AS VARCHAR) AS season, CASE WHEN game_type = 3 THEN 'SM-slutspel' ELSE 'SHL' END AS league, CASE WHEN game_id % 2 = 0 THEN 'L1' ELSE '' END AS league_id,
CASE WHEN game_type = 3 THEN 'playoff' ELSE 'regular' END AS game_type, 'Home ' || home_team_id AS home_team, 'Away ' || away_team_id AS away_team, 'Hall A' AS venue, '19:00' AS time, home_score, away_score, home_sog AS home_shots, away_sog AS away_shots, away_sog - away_score AS home_saves, home_sog - home_score AS away_saves,
home_pim, CAST(NULL AS BIGINT) AS away_pim, CASE WHEN last_period_type = 'REG' THEN 2 ELSE 3 END AS periods, 'C' AS home_coach, '' AS away_coach, CAST(game_date AS VARCHAR) || 'T10:00:00.123456' AS scraped_at,
last_period_type = 'OT' AS went_to_ot, last_period_type = 'SO' AS went_to_so, round((away_sog - away_score) * 100.0 / away_sog, 2) AS home_save_pct, round((home_sog - home_score) * 100.0 / home_sog, 2) AS away_save_pct, {_LEAGUE_POINTS} FROM games"""
)
def trf_swe_games(spark, d):
    return doc.league_games(_details(spark, d))


def _league(name: str, sql: str) -> None:
    """A table of league documents, without repeats."""
    query(f"WITH {_G} {sql}", f"trf_swe_{name}")(lambda spark, d: doc.league_tables(_details(spark, d))[{"periods": "period_scores"}.get(name, name)])


_league("events", f"""SELECT {_LEAGUE_TAGS}, 1 AS period, '12:34' AS event_time, 754 AS seconds, 'goal' AS event_type, 'Home' AS team, 'P' AS player_name, CASE WHEN game_id % 90 > 0 THEN CAST(game_id % 90 AS VARCHAR) ELSE '' END AS player_number, 'PP1' AS goal_type, CAST(NULL AS BIGINT) AS penalty_minutes, '' AS penalty_start, '' AS penalty_end,
'' AS penalty_type, '' AS goalkeeper_action, 1 AS powerplay_number, 1 AS score_home, 0 AS score_away, '[{{"name":"P5","number":5}}]' AS assists FROM games
UNION ALL SELECT {_LEAGUE_TAGS}, NULL, '', NULL, 'penalty', '', '', '', '', 2, '12:34', '', 'Hooking', '', NULL, NULL, NULL, NULL FROM games""")
_league("goalkeepers", f"SELECT {_LEAGUE_TAGS}, 'Home' AS team, 'G' || home_team_id AS name, '30' AS number, away_sog - away_score AS saves, away_sog AS shots_against, 91.5::DOUBLE AS save_pct FROM games UNION ALL SELECT {_LEAGUE_TAGS}, '', '', '', NULL, NULL, NULL FROM games")
_league("periods", f"SELECT {_LEAGUE_TAGS}, '1' AS period, home_score, 0 AS away_score FROM games UNION ALL SELECT {_LEAGUE_TAGS}, '2', 0, away_score FROM games UNION ALL SELECT {_LEAGUE_TAGS}, last_period_type, 0, 0 FROM games WHERE last_period_type <> 'REG'")
_league("referees", f"SELECT {_LEAGUE_TAGS}, name, role FROM games, (VALUES ('Q', 'Referee'), ('M', 'Linesman')) v(name, role) UNION ALL SELECT {_LEAGUE_TAGS}, 'R' || game_id % 9, 'Referee' FROM games UNION ALL SELECT {_LEAGUE_TAGS}, 'O' || game_id % 7, 'Head' FROM games UNION ALL SELECT {_LEAGUE_TAGS}, 'L' || game_id % 5, 'Linesman' FROM games")
_league("on_ice", f"SELECT {_LEAGUE_TAGS}, 1 AS period, '12:34' AS event_time, 'goal' AS event_type, 'Home' AS event_team, side AS team_side, number AS player_number FROM games, (VALUES ('positive', '1'), ('positive', '2')) v(side, number) UNION ALL SELECT {_LEAGUE_TAGS}, 1, '12:34', 'goal', 'Home', 'negative', CAST(game_id % 20 AS VARCHAR) FROM games")
_league("player_stats", f"SELECT {_LEAGUE_TAGS}, 'Home' AS team, '7' AS player_id, 'P' AS player_name, home_score AS goals, 1 AS assists, CAST(NULL AS BIGINT) AS pim, 3 AS shots, CASE WHEN game_id % 2 = 0 THEN 1 ELSE -1 END AS plus_minus FROM games")
_PLACED = "SELECT {tags}, 'Home ' || home_team_id AS team, true AS is_home, 'C' AS head_coach, '' AS assistant_coach, {line} AS line_number, '{position}' AS position, {name} AS player_name, {number} AS player_number, {starting} AS is_starting FROM games{where}"
_ON_LINES = ((1, "LW", 11, 0), (1, "", 12, 0), (2, "LW", 13, 1), (2, "CE", 14, 1), (2, "LD", 15, 1))
_league("lineups", " UNION ALL ".join((
    _PLACED.format(tags=_LEAGUE_TAGS, line="CAST(NULL AS BIGINT)", position="G", name="'G'", number="CAST(game_id % 30 AS VARCHAR)", starting="true", where=""),
    *(_PLACED.format(tags=_LEAGUE_TAGS, line=line, position=position, name=f"'P{n}'", number=f"'{n}'", starting="false", where=f" WHERE game_id % 2 = {rest}") for line, position, n, rest in _ON_LINES),
    _PLACED.format(tags=_LEAGUE_TAGS, line="NULL", position="EXTRA", name="'P99'", number="'99'", starting="false", where=""),
    f"SELECT {_LEAGUE_TAGS}, 'Away', false, '', 'AC', NULL, 'EXTRA', 'P0', '', false FROM games WHERE game_id % 3 <> 0",
)))


@query("SELECT CAST(c_custkey AS VARCHAR) AS player_id, c_mktsegment AS name FROM customer WHERE c_custkey <> 0 AND c_custkey % 6 > 1")
def trf_drop_totals(spark, d):
    c = table(spark, d, "customer").select(F.when(F.col("c_custkey") % 6 == 0, "None").otherwise(F.col("c_custkey").cast("string")).alias("player_id"), F.when(F.col("c_custkey") % 6 == 1, "Total").otherwise(F.col("c_mktsegment")).alias("name"))
    return doc.drop_totals(c)


@query(
    """WITH a AS (SELECT l_orderkey AS g, l_linenumber AS n, CASE WHEN l_orderkey % 3 > 0 THEN 'A' END AS team FROM lineitem WHERE l_orderkey % 4 > 0), b AS (SELECT l_orderkey AS g, l_linenumber + 100 AS n, CASE WHEN l_orderkey % 5 > 0 THEN 'B' END AS team FROM lineitem)
SELECT * FROM a WHERE g % 3 > 0 OR g % 5 = 0 UNION ALL SELECT * FROM b WHERE g % 4 = 0 OR (g % 3 = 0 AND g % 5 > 0)"""
)
def pdf_source_priority(spark, d):
    li = table(spark, d, "lineitem")
    a = li.filter("l_orderkey % 4 > 0").select(F.col("l_orderkey").alias("g"), F.col("l_linenumber").alias("n"), F.when(F.col("l_orderkey") % 3 > 0, "A").alias("team"))
    b = li.select(F.col("l_orderkey").alias("g"), (F.col("l_linenumber") + 100).alias("n"), F.when(F.col("l_orderkey") % 5 > 0, "B").alias("team"))
    return doc.prefer_source(a, b, "g", "team")


@query(f"WITH {_G} SELECT game_id, 1000 * game_id + k AS event_id, CASE WHEN k < 2 THEN 1 + k ELSE 4 END AS period, 'Home_' || home_team_id AS slug FROM games, (VALUES (0), (1), (2)) v(k)".replace("'Home_' ||", "'home_' ||"))
def trf_nor_tables(spark, d):
    from hockeylake import functions as fn

    g = view(spark, d, "games").select("game_id", fn.folded_slug(F.concat(F.lit("Home "), "home_team_id")).alias("slug"), F.posexplode(F.array(F.lit(200050), F.lit(200051), F.lit(200053))).alias("i", "pid"))
    return g.select("game_id", fn.synthetic_id(F.col("game_id"), F.col("i")).alias("event_id"), fn.period_number(F.col("pid").cast("bigint")).alias("period"), "slug")


_NOR_TEAM = "CASE game_id % 6 WHEN 0 THEN 'Storhamar' WHEN 1 THEN 'storhamar hockey elite' WHEN 2 THEN 'Vålerenga' WHEN 3 THEN 'Ærø Å ' || home_team_id WHEN 4 THEN 'Comet' ELSE 'IF Frisk Asker' END"
_NOR_SLUG = "CASE game_id % 6 WHEN 0 THEN 'storhamar' WHEN 1 THEN 'storhamar' WHEN 2 THEN 'valerenga' WHEN 3 THEN 'aero_a_' || home_team_id WHEN 4 THEN 'comet' ELSE 'friskasker' END"


@query(
    f"""WITH {_G} SELECT game_id AS match_id, {_NOR_SLUG} AS team_slug, CAST(game_date AS VARCHAR) AS match_date, CAST(NULL AS VARCHAR) AS end_time, home_team_id, {_NOR_TEAM} AS home_team_name, away_team_id, 'Away' AS away_team_name, CASE WHEN game_id % 4 = 0 THEN 0 ELSE home_score END AS home_goals, away_score AS away_goals,
CASE WHEN status = 'FUT' THEN 'Upcoming' ELSE 'Finished' END AS status, 3600 AS game_time, status <> 'FUT' AS has_statistics, season AS tournament_id, CASE WHEN season // 10000 % 2 = 0 THEN 'EHL Playoff' ELSE 'EHL' END AS tournament_name, CASE WHEN season // 10000 % 3 > 0 THEN season // 10000 END AS season_year,
CASE WHEN season // 10000 % 2 = 0 THEN 'Playoffs' ELSE 'Regular' END AS season_phase FROM games WHERE game_id % 10 > 0"""
)
def trf_nor_matches(spark, d):
    """Documents of a season's matches, by their page; every tenth match has no result, every fourth doesn't tell the home team's goals."""
    g = view(spark, d, "games")
    match = f"""'{{"matchId": ' || game_id || ', "matchDate": "' || game_date || '", "hometeamId": ' || home_team_id || ', ' || if(game_id % 2 = 0, '"hometeamOrgName"', '"hometeam"') || ': "' || {_NOR_TEAM} || '", "awayteamId": ' || away_team_id || ', "awayteam": "Away", "matchResult": ' ||
      if(game_id % 10 = 0, 'null', '{{"homeGoals": ' || if(game_id % 4 = 0, 'null', cast(home_score as string)) || ', "awayGoals": ' || away_score || ', "matchEndResult": ' || if(status = 'FUT', '""', '"' || home_score || '-' || away_score || '"') || '}}') || '}}'"""
    docs = g.groupBy("season", F.expr(_PAGE_OF)).agg(F.array_join(F.collect_list(F.expr(match)), ",").alias("matches"))
    text = """'{"tournament": {"id": ' || season || ', "name": "' || if(season div 10000 % 2 = 0, 'EHL Playoff', 'EHL') || '", "year": "' || if(season div 10000 % 3 = 0, 0L, season div 10000) || '"}, "matches": [' || matches || ']}'"""
    return doc.norwegian_matches(_variants(docs.select(F.expr(text).alias("payload")), "payload"))


def _of_match(spark, d, entries: str):
    """A list of entries for each match, every ninth empty."""
    text = f"if(game_id % 9 = 0, '[]', '[' || {entries} || ']')"
    return _variants(view(spark, d, "games").select(F.col("game_id").alias("match_id"), F.expr(text).alias("payload")), "match_id", "payload")


@query(
    f"""WITH {_G}, g AS (SELECT * FROM games WHERE game_id % 9 > 0) SELECT game_id * 1000 AS event_id, game_id AS match_id, {_NOR_SLUG} AS team_slug, home_team_id AS team_id, {_NOR_TEAM} AS team_name, CAST(NULL AS TIMESTAMP) AS timestamp, 1234 AS match_time, 2 AS period, CAST(NULL AS BIGINT) AS home_goals, CAST(NULL AS BIGINT) AS away_goals, 'EQ' AS goal_type, game_id AS scorer_id, 'Per Ås' AS scorer_name,
5 AS assist1_id, 'Bo' AS assist1_name, CAST(NULL AS BIGINT) AS assist2_id, CAST(NULL AS VARCHAR) AS assist2_name FROM g UNION ALL SELECT game_id * 1000 + 2, game_id, 'friskasker', NULL, '', NULL, NULL, 0, NULL, NULL, NULL, NULL, '', NULL, NULL, NULL, NULL FROM g"""
)
def trf_nor_goals(spark, d):
    entry = f"""'{{"teamName": "' || {_NOR_TEAM} || '", "orgId": ' || home_team_id || ', "periodTime": "1234", "periodId": 200051, "goalType": "EQ", "personId": ' || game_id || ', "firstName": "Per", "lastName": "Ås", "firstAssistPersonId": 5, "firstAssistFirstName": "Bo"}}, "none", {{"periodTime": 0}}'"""
    return doc.norwegian_goals(_of_match(spark, d, entry))


@query(
    f"""WITH {_G}, g AS (SELECT * FROM games WHERE game_id % 9 > 0) SELECT game_id * 1000 + 500 AS event_id, game_id AS match_id, {_NOR_SLUG} AS team_slug, home_team_id AS team_id, {_NOR_TEAM} AS team_name, CAST(NULL AS TIMESTAMP) AS timestamp, 900 AS match_time, CAST(NULL AS BIGINT) AS period, 2 AS duration_minutes, 'Hooking' AS reason, 'Minor' AS info, false AS is_team_or_official, game_id AS player_id, 'Ås' AS player_name FROM g
UNION ALL SELECT game_id * 1000 + 501, game_id, 'friskasker', NULL, '', NULL, NULL, NULL, 0, NULL, NULL, false, NULL, '' FROM g"""
)
def trf_nor_penalties(spark, d):
    entry = f"""'{{"teamName": "' || {_NOR_TEAM} || '", "orgId": ' || home_team_id || ', "servingStartTime": 900, "severityMinutes": 2, "infractionType": "Hooking", "severityType": "Minor", "personId": ' || game_id || ', "lastName": "Ås"}}, {{}}'"""
    return doc.norwegian_penalties(_of_match(spark, d, entry))


@query(f"WITH {_G} SELECT game_id AS match_id, {_NOR_SLUG} AS team_slug, CAST(NULL AS VARCHAR) AS side, game_id AS player_id, 'Per' AS first_name, '' AS last_name, game_id % 99 AS jersey, CAST(NULL AS VARCHAR) AS role, 0 AS line_number, 0 AS height, 0 AS weight, CAST(NULL AS VARCHAR) AS date_of_birth, CAST(NULL AS VARCHAR) AS handedness FROM games WHERE game_id % 9 > 0")
def trf_nor_lineup(spark, d):
    entry = f"""'{{"teamName": "' || {_NOR_TEAM} || '", "personId": ' || game_id || ', "firstName": "Per", "shirtNo": "' || game_id % 99 || '"}}'"""
    return doc.norwegian_lineup(_of_match(spark, d, entry))
