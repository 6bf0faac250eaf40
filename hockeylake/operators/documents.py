"""Game, dimension, season and league documents flattened to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hockeylake.functions import blank_to_null, clean_text, clock_seconds, cross_save_pct, first_list, game_type, goals_against_average, leading_date, localised, measure, overtime_flags, period_number, phase, points_210, position, season_year, synthetic_id, zero_to_null
from hockeylake.operators.gold import keep_first
from hockeylake.operators.names import slug_among

def _struct(fields: str) -> str:
    return "struct<" + ", ".join(f"{n}: {t}" for n, t in (f.rsplit(" ", 1) for f in fields.split(", "))) + ">"


def _typed(names: str, kind: str) -> str:
    return ", ".join(f"{n} {kind}" for n in names.split())


#: Columns of a player row and the keys that hold them, in the boxscore and in the live data's skater stats.
_SKATER = {
    "goals": ("goals", "goals"), "assists": ("assists", "assists"), "points": ("points", "points"), "plus_minus": ("plusMinus", "plusMinus"), "shots": ("sog", "shots"), "pim": ("pim", "penaltyMinutes"), "hits": ("hits", "hits"),
    "power_play_goals": ("powerPlayGoals", "powerPlayGoals"), "short_handed_goals": ("shortHandedGoals", "shortHandedGoals"), "blocked_shots": ("blockedShots", "blocked"), "shifts": ("shifts", "shift"), "giveaways": ("giveaways", "giveaways"), "takeaways": ("takeaways", "takeaways"),
}
#: The same for goalies alone, in the boxscore and in the live data's goalie stats.
_GOALIE = {
    "saves": ("saves", "saves"), "shots_against": ("shotsAgainst", "shots"), "goals_against": ("goalsAgainst", "goalsAgainst"), "even_strength_goals_against": ("evenStrengthGoalsAgainst", "evenStrengthGoalsAgainst"), "power_play_goals_against": ("powerPlayGoalsAgainst", "powerPlayGoalsAgainst"),
    "shorthanded_goals_against": ("shorthandedGoalsAgainst", "shortHandedGoalsAgainst"), "even_strength_shots_against": ("evenStrengthShotsAgainst", "evenStrengthShotsAgainst"), "power_play_shots_against": ("powerPlayShotsAgainst", "powerPlayShotsAgainst"), "shorthanded_shots_against": ("shorthandedShotsAgainst", "shorthandedShotsAgainst"),
}
#: Columns of a team and the keys that hold them, the first present first; a sum over players has the first name in the boxscore.
_TEAM = {
    "sog": ("sog", "shots", "shotsOnGoal"), "pp_goals": ("powerPlayGoals", "powerPlayGoalCount"), "pp_opportunities": ("powerPlayOpportunities",), "hits": ("hits",), "blocked": ("blocked", "blockedShots"), "pim": ("pim", "penaltyMinutes"),
    "giveaways": ("giveaways",), "takeaways": ("takeaways",),
}
_SUMMED = {"sog": "sog", "pp_goals": "powerPlayGoals", "hits": "hits", "blocked": "blockedShots", "pim": "pim", "giveaways": "giveaways", "takeaways": "takeaways"}

_P = _struct("playerId long, position string, sweaterNumber long, toi string, faceoffWinningPctg double, savePctg double, " + _typed(" ".join(dict.fromkeys(a for a, _ in (_SKATER | _GOALIE).values())), "long"))
_TEAM_KEYS = _typed(" ".join(dict.fromkeys(k for keys in _TEAM.values() for k in keys)), "long")
_S = _struct(f"id long, abbrev string, score long, {_TEAM_KEYS}")
_STATS = f"struct<forwards: array<{_P}>, defense: array<{_P}>, goalies: array<{_P}>>"
_PLAY = """struct<about: struct<eventId: long, period: string, periodType: string, periodTime: string, timeRemaining: string>, result: struct<eventTypeId: string, eventType: string, description: string>, team: struct<triCode: string, abbreviation: string, abbrev: string>,
  players: array<struct<player: struct<id: long>, playerId: long>>, type: string, eventTypeId: string, period: string, periodType: string, periodTime: string, description: string>"""
_SKATER_STATS = _struct("timeOnIce string, faceOffWinPercentage double, " + _typed(" ".join(b for _, b in _SKATER.values()), "long"))
_GOALIE_STATS = _struct("timeOnIce string, savePercentage double, " + _typed(" ".join(b for _, b in _GOALIE.values()), "long"))
_LIVE_PLAYER = f"struct<person: struct<id: long>, jerseyNumber: string, position: struct<abbreviation: string>, stats: struct<skaterStats: {_SKATER_STATS}, goalieStats: {_GOALIE_STATS}>>"
_LIVE_TEAM = f"struct<teamSkaterStats: {_struct('faceOffWinPercentage string, ' + _TEAM_KEYS)}, teamGoalieStats: {_struct(_TEAM_KEYS)}>"
_LIVE_SIDE = f"struct<team: struct<triCode: string>, teamStats: {_LIVE_TEAM}, players: map<string, {_LIVE_PLAYER}>>"
_GAME_TEAM = "struct<id: long, abbreviation: string, triCode: string>"
_GAME_DATA = f"struct<game: struct<pk: long, season: long, type: string>, status: struct<detailedState: string>, venue: struct<name: string>, teams: struct<home: {_GAME_TEAM}, away: {_GAME_TEAM}>>"

#: Both layouts of a game document: the boxscore and the live data.
GAME = f"""gameId string, date string,
boxscore struct<id: long, season: long, gameDate: string, gameState: string, gameType: string, startTimeUTC: string, regPeriods: long, limitedScoring: boolean, venue: struct<default: string>, venueLocation: struct<default: string>,
  gameOutcome: struct<otPeriods: long, lastPeriodType: string>, periodDescriptor: struct<number: long, periodType: string>, gameData: {_GAME_DATA},
  homeTeam: {_S}, awayTeam: {_S}, playerByGameStats: struct<homeTeam: {_STATS}, awayTeam: {_STATS}>>,
playByPlay struct<plays: array<{_PLAY}>, gamePlays: array<{_PLAY}>, allPlays: array<{_PLAY}>>,
gameStory struct<headline: string, title: string, body: string, article: string>,
gameData {_GAME_DATA},
liveData struct<linescore: struct<teams: struct<home: struct<goals: long>, away: struct<goals: long>>>, plays: struct<allPlays: array<{_PLAY}>>, boxscore: struct<teams: struct<home: {_LIVE_SIDE}, away: {_LIVE_SIDE}>>>"""


def parse_games(docs: DataFrame, column: str = "payload") -> DataFrame:
    """Documents ``(key, game_date, payload)`` with their parsed struct ``doc``."""
    return docs.withColumn("doc", F.from_json(column, GAME))


def _all_players(side: str) -> Column:
    stats = F.col(f"doc.boxscore.playerByGameStats.{side}Team")
    none = F.array().cast(f"array<{_P}>")
    return F.concat(*(F.coalesce(stats[g], none) for g in ("forwards", "defense", "goalies")))


def _sums(side: str) -> Column:
    """A side's sums over its players, in one pass over them."""
    zero = F.struct(*(F.lit(0).cast("bigint").alias(n) for n in _SUMMED))
    return F.aggregate(_all_players(side), zero, lambda s, p: F.struct(*((s[n] + F.coalesce(p[k], F.lit(0))).alias(n) for n, k in _SUMMED.items())))


def _team_stat(side: str, keys: tuple[str, ...]) -> Column:
    """A team's number where players have none of their own: of each key the team's, else its skaters', where 0 counts as absent, else its goalies'."""
    team, live = F.col(f"doc.boxscore.{side}Team"), F.col(f"doc.liveData.boxscore.teams.{side}.teamStats")
    return F.coalesce(*(x for k in keys for x in (zero_to_null(team[k]), zero_to_null(live["teamSkaterStats"][k]), live["teamGoalieStats"][k])))


def _game_id() -> Column:
    return F.coalesce(F.col("doc.gameId").try_cast("bigint"), F.col("doc.boxscore.id"), F.col("doc.boxscore.gameData.game.pk"), F.col("doc.gameData.game.pk"))


def _played(*more: str) -> Column:
    return F.coalesce(F.col("game_date").try_cast("date"), *(leading_date(F.col(f"doc.{c}")) for c in ("date", *more)))


def extract_games(parsed: DataFrame, strict: bool = True) -> DataFrame:
    """One row of 41 columns a game from either layout; the boxscore counts where it has a home team.

    Team numbers are sums over the players where the document lists them, 0 being null, but for shots if the team
    has its own; else they are the team's, in the boxscore or the live data. Power-play chances and the share of
    face-offs are in the live data alone.
    """
    box, listed = F.col("doc.boxscore.homeTeam").isNotNull(), F.col("doc.boxscore.playerByGameStats").isNotNull()
    data = lambda path: F.coalesce(F.col(f"doc.boxscore.gameData.{path}"), F.col(f"doc.gameData.{path}"))
    pick = lambda a, b: F.when(box, F.col(f"doc.boxscore.{a}")).otherwise(b)
    parsed = parsed.select("game_date", "doc", F.struct(_sums("home").alias("home"), _sums("away").alias("away")).alias("sums"))

    def stat(side: str, name: str) -> Column:
        own = F.lit(None).cast("bigint")
        if name in _SUMMED:
            own = zero_to_null(F.col(f"sums.{side}.{name}"))
        if name == "sog":
            own = F.coalesce(F.col(f"doc.boxscore.{side}Team.sog"), own)
        return F.when(listed, own).otherwise(_team_stat(side, _TEAM[name]))

    sides = ("home", "away")
    df = parsed.select(
        _game_id().alias("game_id"), _played("boxscore.gameDate").alias("game_date"), pick("season", data("game.season")).alias("season"),
        *(pick(f"{s}Team.abbrev", F.coalesce(data(f"teams.{s}.abbreviation"), data(f"teams.{s}.triCode"))).alias(f"{s}_team_abbr") for s in sides),
        *(pick(f"{s}Team.id", data(f"teams.{s}.id")).alias(f"{s}_team_id") for s in sides),
        *(pick(f"{s}Team.score", F.col(f"doc.liveData.linescore.teams.{s}.goals")).alias(f"{s}_score") for s in sides),
        F.coalesce(data("status.detailedState"), F.col("doc.boxscore.gameState")).alias("status"),
        *(stat(s, n).alias(f"{s}_{n}") for n in _TEAM for s in sides),
        *(F.when(~listed, F.col(f"doc.liveData.boxscore.teams.{s}.teamStats.teamSkaterStats.faceOffWinPercentage").try_cast("double")).alias(f"{s}_faceoff_pct") for s in sides),
        F.coalesce(blank_to_null(F.col("doc.boxscore.venue.default")), data("venue.name")).alias("venue"), F.col("doc.boxscore.venueLocation.default").alias("venue_location"), F.col("doc.boxscore.startTimeUTC").alias("start_time_utc"),
        F.col("doc.boxscore.regPeriods").alias("reg_periods"), F.coalesce(F.col("doc.boxscore.gameType"), data("game.type")).alias("game_type"), F.col("doc.boxscore.limitedScoring").alias("limited_scoring"), F.col("doc.boxscore.gameState").alias("game_state"),
        F.col("doc.boxscore.gameOutcome.otPeriods").alias("ot_periods"), F.col("doc.boxscore.gameOutcome.lastPeriodType").alias("last_period_type"), F.col("doc.boxscore.periodDescriptor.number").alias("period_number"), F.col("doc.boxscore.periodDescriptor.periodType").alias("period_type"),
    )
    extra = F.col("status").rlike("OT|SO|Shootout") if strict else F.col("last_period_type").isin("OT", "SO")
    return df.withColumn("home_points", points_210(F.col("home_score"), F.col("away_score"), extra)).withColumn("away_points", points_210(F.col("away_score"), F.col("home_score"), extra))


def extract_players(parsed: DataFrame) -> DataFrame:
    """One row of 33 columns a player and game, from the boxscore's groups or else the live data's maps; numbers of goalies are null for others.

    Both layouts make one array of equal entries for each document, which is exploded once. Points that a document leaves out are goals and assists.
    """
    def entry(s: str, team: Column, goalie: Column, values: dict[str, Column]) -> Column:
        return F.struct(F.lit(s == "home").alias("is_home"), team.alias("team_abbr"), goalie.alias("is_goalie"), *(v.alias(n) for n, v in values.items()))

    def boxscore(s: str) -> Column:
        of = F.col(f"doc.boxscore.playerByGameStats.{s}Team")
        team = F.col(f"doc.boxscore.{s}Team.abbrev")
        one = lambda keeps: lambda p: entry(
            s, team, F.lit(True) if keeps else F.coalesce(position(p["position"]) == "G", F.lit(False)),
            {"player_id": p["playerId"], "position": p["position"], "sweater_number": p["sweaterNumber"], "toi": p["toi"], "goalie_toi": p["toi"], "faceoff_win_pct": p["faceoffWinningPctg"], "save_pct": p["savePctg"]} | {n: p[k] for n, (k, _) in (_SKATER | _GOALIE).items()},
        )
        empty = F.array().cast(f"array<{_P}>")
        return F.concat(*(F.transform(F.coalesce(of[g], empty), one(g == "goalies")) for g in ("forwards", "defense", "goalies")))

    def live(s: str) -> Column:
        of = F.col(f"doc.liveData.boxscore.teams.{s}")

        def one(p: Column) -> Column:
            sk, go = p["stats"]["skaterStats"], p["stats"]["goalieStats"]
            values = {"player_id": p["person"]["id"], "position": p["position"]["abbreviation"], "sweater_number": p["jerseyNumber"].try_cast("bigint"), "toi": sk["timeOnIce"], "goalie_toi": F.coalesce(go["timeOnIce"], sk["timeOnIce"]), "faceoff_win_pct": sk["faceOffWinPercentage"], "save_pct": go["savePercentage"]}
            return entry(s, of["team"]["triCode"], F.coalesce(position(p["position"]["abbreviation"]) == "G", F.lit(False)), values | {n: sk[k] for n, (_, k) in _SKATER.items()} | {n: go[k] for n, (_, k) in _GOALIE.items()})

        return F.transform(F.coalesce(F.map_values(of["players"]), F.array().cast(f"array<{_LIVE_PLAYER}>")), one)

    both = F.when(F.col("doc.boxscore.playerByGameStats").isNotNull(), F.concat(boxscore("home"), boxscore("away"))).otherwise(F.concat(live("home"), live("away")))
    x = parsed.select(_game_id().alias("game_id"), _played().alias("game_date"), F.explode(both).alias("p"))
    kept = lambda n: F.when(F.col("p.is_goalie"), F.col(f"p.{n}")).alias(n)
    own = {n: F.col(f"p.{n}") for n in _SKATER} | {"points": F.coalesce("p.points", F.col("p.goals") + F.col("p.assists"))}
    return x.select(
        "game_id", "game_date", "p.player_id", "p.team_abbr", "p.is_home", position(F.col("p.position")).alias("position"), "p.sweater_number", *(c.alias(n) for n, c in own.items()), clock_seconds(F.col("p.toi")).alias("toi_seconds"), "p.faceoff_win_pct",
        *map(kept, _GOALIE), kept("save_pct"), F.when(F.col("p.is_goalie"), goals_against_average(F.col("p.goals_against"), clock_seconds(F.col("p.goalie_toi")))).alias("gaa"),
    )


def extract_events(parsed: DataFrame) -> DataFrame:
    """One row a play of the first list that has any: ``plays``, ``gamePlays``, ``allPlays`` or the live data's. The event id is the play's own or its place; players are the first two ids of the first three entries.

    Kind, period, clock, team and text are each taken from the first place that has one. Null entries are left out but count as places.
    """
    some = lambda plays: F.when(F.size(plays) > 0, F.col(plays))
    plays = F.coalesce(*map(some, ("doc.playByPlay.plays", "doc.playByPlay.gamePlays", "doc.playByPlay.allPlays", "doc.liveData.plays.allPlays")))
    df = parsed.select(_game_id().alias("game_id"), "game_date", F.posexplode(plays).alias("pos", "e")).filter("e IS NOT NULL")
    ids = F.filter(F.transform(F.slice("e.players", 1, 3), lambda p: F.coalesce(p["player"]["id"], p["playerId"])), lambda i: i > 0)
    first = lambda *paths: F.coalesce(*(blank_to_null(F.col(f"e.{x}")) for x in paths))
    clock = first("about.periodTime", "about.timeRemaining", "periodTime")
    return df.select(
        "game_id", "game_date", F.coalesce(F.nullif("e.about.eventId", F.lit(0)), F.col("pos").cast("bigint")).alias("event_id"), F.upper(F.coalesce(first("result.eventTypeId", "result.eventType", "type", "eventTypeId"), F.lit(""))).alias("event_type"),
        first("about.period", "period").alias("period"), F.coalesce(first("about.periodType", "periodType"), F.lit("")).alias("period_type"), F.coalesce(clock, F.lit("")).alias("time_remaining"), clock_seconds(clock).alias("period_seconds"),
        first("team.triCode", "team.abbreviation", "team.abbrev").alias("team_abbr"), F.get(ids, F.lit(0)).alias("player_id"), F.get(ids, F.lit(1)).alias("player2_id"), F.substring(F.coalesce(first("result.description", "description"), F.lit("")), 1, 500).alias("description"),
    )


def extract_stories(parsed: DataFrame) -> DataFrame:
    """Headline and body of game stories, 1,000 and 50,000 characters of them; a game without either has no row."""
    s = "doc.gameStory"
    df = parsed.select(_game_id().alias("game_id"), F.substring(F.coalesce(f"{s}.headline", f"{s}.title", F.lit("")), 1, 1000).alias("headline"), F.substring(F.coalesce(f"{s}.body", f"{s}.article", F.lit("")), 1, 50000).alias("body"))
    return df.filter("headline != '' OR body != ''")


def _text(v: Column | str, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _is_object(v: Column | str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def _long(v: Column | str, path: str) -> Column:
    return F.try_variant_get(v, path, "bigint")


def extract_teams(docs: DataFrame) -> DataFrame:
    """Teams from a list, or the list below ``teams``, ``data`` or ``items``, with conference and division; entries that aren't objects are left out."""
    t = docs.select(F.explode(first_list(F.col("doc"), "$.teams", "$.data", "$.items")).alias("t")).filter(_is_object("t"))
    return t.select(
        F.coalesce(_long("t", "$.id"), _long("t", "$.franchiseId")).alias("id"), F.coalesce(_text("t", "$.abbr"), _text("t", "$.abbrev")).alias("abbr"), localised(F.col("t"), "name").alias("name"), _text("t", "$.conference.abbr").alias("conference_abbr"),
        _text("t", "$.conference.name").alias("conference_name"), _text("t", "$.division.abbr").alias("division_abbr"), _text("t", "$.division.name").alias("division_name"),
    )


def extract_players_dim(docs: DataFrame) -> DataFrame:
    """Players from a list of players or of rosters with groups, which may stand below ``players``, ``data`` or ``items``, or a map of such lists, whichever a document is; of an id the first in the document."""
    items = docs.select(F.coalesce(first_list(F.col("doc"), "$.players", "$.data", "$.items"), F.flatten(F.map_values(F.try_variant_get("doc", "$", "map<string,array<variant>>")))).alias("l")).select(F.posexplode("l").alias("i", "x"))
    groups = F.array(*(F.coalesce(F.try_variant_get("x", f"$.{g}", "array<variant>"), F.array().cast("array<variant>")) for g in ("forwards", "defensemen", "goalies")))
    people = items.select("i", F.posexplode(F.when(F.size(F.flatten(groups)) > 0, F.flatten(groups)).otherwise(F.array("x"))).alias("j", "p"))
    rows = people.select(_long("p", "$.id").alias("id"), localised(F.col("p"), "firstName").alias("first_name"), localised(F.col("p"), "lastName").alias("last_name"), position(_text("p", "$.position")).alias("position"), "i", "j").filter("id IS NOT NULL")
    return keep_first(rows, ["id"], ["i", "j", "first_name", "last_name"]).drop("i", "j")


def extract_countries(docs: DataFrame) -> DataFrame:
    """``(code, name)`` from a list, or the list below ``countries``, ``data`` or ``items``, else from a map to names or localised names."""
    listed = first_list(F.col("doc"), "$.countries", "$.data", "$.items")
    c = docs.filter(listed.isNotNull()).select(F.explode(listed).alias("t")).filter(_is_object("t"))
    rows = c.select(F.coalesce(_text("t", "$.code"), _text("t", "$.countryCode"), _text("t", "$.id")).alias("code"), F.coalesce(localised(F.col("t"), "name"), localised(F.col("t"), "countryName")).alias("name"))
    m = docs.filter(listed.isNull()).select(F.explode(F.try_variant_get("doc", "$", "map<string,variant>")).alias("code", "v"))
    return rows.unionByName(m.select("code", F.coalesce(_text("v", "$.default"), F.when(~_is_object("v"), _text("v", "$"))).alias("name")))


def extract_roster(docs: DataFrame) -> DataFrame:
    """``(season, team_id, player_id)``, once each: from a list of entries, which may stand below ``rosters.teams.data.items``, ``rosters.data.items``, ``rosters``, ``teams``, ``data`` or ``items``,
    else from maps of team to players, to bare ids or to groups. An entry's own season counts before the document's; keys that start with _ are left out.
    """
    none = F.array().cast("array<variant>")
    listed = F.coalesce(*(F.try_variant_get("doc", p, "array<variant>") for p in ("$.rosters.teams.data.items", "$.rosters.data.items", "$", "$.rosters", "$.teams", "$.data", "$.items")))
    e = docs.filter(listed.isNotNull()).select("season", F.explode(listed).alias("e")).filter(_is_object("e"))
    entries = e.select(F.coalesce(_text("e", "$.season"), "season").alias("season"), F.coalesce(_long("e", "$.team_id"), _long("e", "$.teamId")).alias("team_id"), F.coalesce(_long("e", "$.player_id"), _long("e", "$.playerId"), _long("e", "$.id")).alias("player_id"))
    m = docs.filter(listed.isNull()).select("season", F.explode(F.try_variant_get("doc", "$", "map<string,variant>")).alias("team_id", "v")).filter(~F.col("team_id").startswith("_"))
    groups = F.concat(*(F.coalesce(F.try_variant_get("v", f"$.{g}", "array<variant>"), none) for g in ("forwards", "defensemen", "goalies")))
    people = m.select("season", "team_id", F.explode(F.coalesce(F.try_variant_get("v", "$", "array<variant>"), groups)).alias("p"))
    keyed = people.select("season", F.col("team_id").try_cast("bigint").alias("team_id"), F.coalesce(_long("p", "$.id"), _long("p", "$.playerId"), _long("p", "$")).alias("player_id"))
    return entries.unionByName(keyed).filter("player_id IS NOT NULL").distinct()


def roster_with_teams(roster: DataFrame, teams: DataFrame) -> DataFrame:
    """Abbreviations by team id; unknown teams leave nulls."""
    return roster.join(teams.select("team_id", F.col("abbr").alias("team_abbr")), "team_id", "left")


def roster_from_players_by_team(docs: DataFrame, season: str) -> DataFrame:
    """``(season, team_id, player_id, team_abbr)`` from players by team, for seasons without rosters: a map of team to a list of groups, or teams with groups below ``players.data.items``, ``teams.data.items``, ``teams``, ``data`` or ``items``."""
    keyed = docs.select(F.explode(F.try_variant_get("doc", "$", "map<string,variant>")).alias("id", "v")).select(F.col("id").try_cast("bigint").alias("team_id"), F.try_variant_get("v", "$[0]", "variant").alias("t")).filter("team_id IS NOT NULL AND t IS NOT NULL")
    keyed = keyed.withColumn("team_abbr", F.lit(None).cast("string"))
    listed = F.coalesce(*(F.try_variant_get("doc", p, "array<variant>") for p in ("$.players.data.items", "$.teams.data.items", "$.teams", "$.data", "$.items", "$")))
    teams = docs.select(F.explode(listed).alias("t")).select(F.coalesce(_long("t", "$.id"), _long("t", "$.franchiseId")).alias("team_id"), "t", F.coalesce(_text("t", "$.abbrev"), _text("t", "$.abbreviation"), _text("t", "$.triCode")).alias("team_abbr"))
    none = F.array().cast("array<variant>")
    groups = F.concat(*(F.coalesce(F.try_variant_get("t", f"$.{g}", "array<variant>"), none) for g in ("forwards", "defensemen", "goalies")))
    people = keyed.unionByName(teams).select("team_id", "team_abbr", F.posexplode(groups).alias("i", "p"))
    rows = people.select(F.lit(season).alias("season"), "team_id", F.coalesce(_long("p", "$.id"), _long("p", "$.playerId"), _long("p", "$")).alias("player_id"), "team_abbr", "i").filter("player_id IS NOT NULL")
    return keep_first(rows, ["team_id", "player_id"], ["i", "team_abbr"]).drop("i")


def roster_or_fallback(roster: DataFrame, fallback: DataFrame) -> DataFrame:
    """The rosters, or what players by team say if there is no roster at all."""
    some = roster.agg((F.count("*") > 0).alias("_some"))  # one row
    return roster.unionByName(fallback.join(F.broadcast(some), ~F.col("_some")).drop("_some"), allowMissingColumns=True)


def extract_schedule(docs: DataFrame) -> DataFrame:
    """Scheduled games, twelve columns, from ``dates[].games[]``, ``gameWeek[].games[]`` or ``games[]``; of a day and game the first by key and place counts."""
    days = F.coalesce(F.try_variant_get("doc", "$.dates", "array<variant>"), F.try_variant_get("doc", "$.gameWeek", "array<variant>"), F.array("doc"))
    g = docs.select("key", F.posexplode(days).alias("i", "d")).select("key", "i", _text("d", "$.date").alias("day"), F.posexplode(F.try_variant_get("d", "$.games", "array<variant>")).alias("j", "g"))
    t, n = (lambda path: _text("g", path)), (lambda path: _long("g", path))
    rows = g.select(
        F.coalesce("day", F.substring(F.coalesce(t("$.gameDate"), t("$.startTimeUTC")), 1, 10)).alias("schedule_date"), F.col("key").alias("schedule_source_key"), F.coalesce(n("$.gamePk"), n("$.id")).alias("game_id"), t("$.gameDate").alias("game_date"), n("$.season").alias("season"),
        F.coalesce(n("$.teams.home.id"), n("$.homeTeam.id")).alias("home_team_id"), F.coalesce(n("$.teams.away.id"), n("$.awayTeam.id")).alias("away_team_id"), t("$.gameType").alias("game_type"), F.coalesce(t("$.status.detailedState"), t("$.gameState"), t("$.status")).alias("status"),
        t("$.startTimeUTC").alias("start_time_utc"), t("$.gameState").alias("game_state"), t("$.venue.default").alias("venue"), "i", "j",
    )
    return keep_first(rows, ["schedule_date", "game_id"], ["schedule_source_key", "i", "j"]).drop("i", "j")


def extract_game_ids(docs: DataFrame) -> DataFrame:
    """``(season, game_id)``, once each, from lists of ids or of objects, in the document or below ``gameIds``, ``game_ids``, ``games`` or ``data.items``, or from a single id there. The season is the row's, else the document's."""
    keys = ("gameIds", "game_ids", "games")
    listed = first_list(F.col("doc"), *(f"$.{k}" for k in keys), "$.data.items")
    single = F.coalesce(*(_long("doc", f"$.{k}") for k in keys))
    x = docs.select(F.coalesce("season", _text("doc", "$.season")).alias("season"), F.explode(F.coalesce(F.transform(listed, lambda g: F.coalesce(_long(g, "$.gamePk"), _long(g, "$.id"), _long(g, "$"))), F.array(single))).alias("game_id"))
    return x.filter("game_id IS NOT NULL").distinct()


def extract_terms(docs: DataFrame) -> DataFrame:
    """Glossary entries from a list, or the list below ``terms``, ``data``, ``items`` or ``glossary``; a scalar is a term without definition."""
    x = docs.select(F.explode(first_list(F.col("doc"), "$.terms", "$.data", "$.items", "$.glossary")).alias("g"))
    return x.select(F.coalesce(_text("g", "$.term"), F.when(~_is_object("g"), _text("g", "$"))).alias("term"), _text("g", "$.definition").alias("definition"))


def extract_draft(docs: DataFrame) -> DataFrame:
    """``(draft_year, rounds, value)`` from a list, or the list below ``rounds``, ``years``, ``data`` or ``items``: of objects the year and its rounds, else the value itself."""
    x = docs.select(F.explode(first_list(F.col("doc"), "$.rounds", "$.years", "$.data", "$.items")).alias("g"))
    return x.select(F.coalesce(_long("g", "$.draftYear"), _long("g", "$.year")).alias("draft_year"), F.coalesce(_long("g", "$.rounds"), _long("g", "$.round")).alias("rounds"), F.when(~_is_object("g"), _text("g", "$")).alias("value"))


def _read(x: str, fields: dict[str, tuple[str, str]]) -> list[Column]:
    """Columns by name from paths of a variant, with their kinds."""
    return [F.try_variant_get(x, path, kind).alias(name) for name, (path, kind) in fields.items()]


_SERIES = {
    "series_letter": ("$.seriesLetter", "string"), "series_title": ("$.seriesTitle", "string"), "series_abbrev": ("$.seriesAbbrev", "string"), "round": ("$.playoffRound", "bigint"),
    "top_seed_rank": ("$.topSeedRank", "bigint"), "top_seed_rank_abbrev": ("$.topSeedRankAbbrev", "string"), "top_wins": ("$.topSeedWins", "bigint"), "top_seed_id": ("$.topSeedTeam.id", "bigint"), "top_seed": ("$.topSeedTeam.abbrev", "string"),
    "bottom_seed_rank": ("$.bottomSeedRank", "bigint"), "bottom_seed_rank_abbrev": ("$.bottomSeedRankAbbrev", "string"), "bottom_wins": ("$.bottomSeedWins", "bigint"), "bottom_seed_id": ("$.bottomSeedTeam.id", "bigint"), "bottom_seed": ("$.bottomSeedTeam.abbrev", "string"),
    "winning_team_id": ("$.winningTeamId", "bigint"), "losing_team_id": ("$.losingTeamId", "bigint"),
}


def extract_playoffs(docs: DataFrame) -> DataFrame:
    """One row of 17 columns a series, from ``data.series`` or ``series``; of a season and letter the first in the document."""
    listed = F.coalesce(F.try_variant_get("doc", "$.data.series", "array<variant>"), F.try_variant_get("doc", "$.series", "array<variant>"))
    s = docs.select(_long("doc", "$.season").alias("season"), F.posexplode(listed).alias("i", "s")).filter(_is_object("s"))
    return keep_first(s.select("season", *_read("s", _SERIES), "i"), ["season", "series_letter"], ["i", "series_title"]).drop("i")


#: Columns of season summaries by entity: name -> (path, kind).
SEASON_STATS: dict[str, dict[str, tuple[str, str]]] = {
    "skaters": {"player_id": ("$.playerId", "bigint"), "name": ("$.skaterFullName", "string"), "team_abbr": ("$.teamAbbrevs", "string"), "position": ("$.positionCode", "string")}
    | {n: (f"$.{k}", "bigint") for n, k in (("games", "gamesPlayed"), ("goals", "goals"), ("assists", "assists"), ("points", "points"), ("plus_minus", "plusMinus"), ("pim", "penaltyMinutes"), ("pp_goals", "ppGoals"), ("pp_points", "ppPoints"), ("sh_goals", "shGoals"), ("shots", "shots"))}
    | {n: (f"$.{k}", "double") for n, k in (("shooting_pct", "shootingPct"), ("faceoff_pct", "faceoffWinPct"), ("toi_per_game", "timeOnIcePerGame"), ("points_per_game", "pointsPerGame"))},
    "goalies": {"player_id": ("$.playerId", "bigint"), "name": ("$.goalieFullName", "string"), "team_abbr": ("$.teamAbbrevs", "string")}
    | {n: (f"$.{k}", "bigint") for n, k in (("games", "gamesPlayed"), ("starts", "gamesStarted"), ("wins", "wins"), ("losses", "losses"), ("ot_losses", "otLosses"), ("shots_against", "shotsAgainst"), ("saves", "saves"), ("goals_against", "goalsAgainst"), ("shutouts", "shutouts"))}
    | {n: (f"$.{k}", "double") for n, k in (("save_pct", "savePct"), ("gaa", "goalsAgainstAverage"))},
    "teams": {"team_id": ("$.teamId", "bigint"), "name": ("$.teamFullName", "string")}
    | {n: (f"$.{k}", "bigint") for n, k in (("games", "gamesPlayed"), ("wins", "wins"), ("losses", "losses"), ("ot_losses", "otLosses"), ("points", "points"), ("goals_for", "goalsFor"), ("goals_against", "goalsAgainst"))}
    | {n: (f"$.{k}", "double") for n, k in (("points_pct", "pointPct"), ("pp_pct", "powerPlayPct"), ("pk_pct", "penaltyKillPct"), ("shots_per_game", "shotsForPerGame"))},
}


def extract_season_stats(docs: DataFrame, entity: str = "skaters") -> DataFrame:
    """Summary rows of a season's skaters, goalies or teams, of an id the first in the document.

    Their list is the first that is there of ``data.<entity>.items``, ``<entity>``, ``data.items``, the document itself and its ``data``.
    """
    fields = SEASON_STATS[entity]
    listed = F.coalesce(*(F.try_variant_get("doc", p, "array<variant>") for p in (f"$.data.{entity}.items", f"$.{entity}", "$.data.items", "$", "$.data")))
    x = docs.select("season", F.posexplode(listed).alias("i", "p"))
    return keep_first(x.select("season", *_read("p", fields), "i"), ["season", next(iter(fields))], ["i", "name"]).drop("i")


def extract_standings(docs: DataFrame) -> DataFrame:
    """Standings from ``records[].teamRecords[]``, with what the record says of its teams where they don't, or from a flat list, whose values may be localised.

    One row a season and team: by team id, else by franchise id, else by abbreviation.
    """
    nested = docs.select("season", F.explode(F.try_variant_get("doc", "$.records", "array<variant>")).alias("r")).select("season", "r", F.posexplode(F.try_variant_get("r", "$.teamRecords", "array<variant>")).alias("i", "t"))
    flat = docs.filter(F.try_variant_get("doc", "$.records", "array<variant>").isNull()).select("season", F.lit(None).cast("string").alias("_r"), F.posexplode(first_list(F.col("doc"), "$.standings", "$.data", "$.items")).alias("i", "t"))
    rows = nested.unionByName(flat.select("season", F.try_parse_json("_r").alias("r"), "i", "t"))
    own = lambda path, kind="string": F.coalesce(F.try_variant_get("t", f"$.{path}", kind), F.try_variant_get("r", f"$.{path}", kind))
    words = lambda *keys: F.coalesce(*(localised(F.col("t"), k) for k in keys))
    n = lambda name, *keys: F.coalesce(*(_long("t", f"$.{k}") for k in keys)).alias(name)
    rows = rows.select(
        "season", F.coalesce(words("divisionName"), own("division.name"), own("division")).alias("division"), F.coalesce(words("conferenceName"), own("conference.name"), own("conference")).alias("conference"), own("standingsType").alias("standings_type"),
        F.coalesce(words("teamAbbrev"), _text("t", "$.team.abbrev"), _text("t", "$.team.abbreviation")).alias("team_abbr"), F.coalesce(words("teamName"), _text("t", "$.team.name")).alias("team_name"), n("team_id", "teamId", "team.id"), n("franchise_id", "franchiseId"),
        n("games", "gamesPlayed"), n("wins", "wins", "leagueRecord.wins"), n("losses", "losses", "leagueRecord.losses"), n("ot_losses", "otLosses", "leagueRecord.ot"), n("points", "points"), n("goals_for", "goalFor", "goalsScored"), n("goals_against", "goalAgainst", "goalsAgainst"), "i",
    )
    key = F.coalesce(F.concat(F.lit("t"), "team_id"), F.concat(F.lit("f"), "franchise_id"), F.concat(F.lit("a"), "team_abbr"))
    return keep_first(rows.withColumn("_key", key), ["season", "_key"], ["i", "division", "team_name"]).drop("_key", "i")


#: Measures that leaders may have, beside those asked for.
MEASURES = ("speed", "distance", "shotSpeed", "skatingSpeed", "zoneTime", "savePctg", "goals", "shots", "count", "value")


def extract_edge_leaders(docs: DataFrame, measures: tuple[str, ...] = ("speed",)) -> DataFrame:
    """One row a season and category: who leads, and the first of the measures that it has, in both units."""
    c = docs.select("season", F.explode(F.try_variant_get("doc", "$.leaders", "map<string,variant>")).alias("category", "v"))
    found = [measure(F.col("v"), m) for m in (*measures, *(m for m in MEASURES if m not in measures))]
    metric, imperial = (F.coalesce(*(pair[i] for pair in found)) for i in (0, 1))
    return c.select("season", "category", F.coalesce(_long("v", "$.player.id"), _long("v", "$.team.id")).alias("entity_id"), F.coalesce(_text("v", "$.player.team.abbrev"), _text("v", "$.team.abbrev")).alias("team_abbr"), metric.alias("metric"), imperial.alias("imperial"))


#: A Swedish game detail document, as far as its game row goes.
DETAIL = """game_id string, date string, time string, league_id string, metadata struct<scraped_at: string>, home_team string, away_team string, home_score string, away_score string, result string, venue string, league string,
period_scores array<struct<period: string, home: long, away: long>>, home_team_stats struct<shots: long, saves: long, penalty_minutes: long>, away_team_stats struct<shots: long, saves: long, penalty_minutes: long>,
events array<struct<period: string>>, home_team_lineup struct<head_coach: string>, away_team_lineup struct<head_coach: string>"""


def parse_details(docs: DataFrame, column: str = "payload") -> DataFrame:
    """The columns of ``DETAIL`` and the whole document as ``raw``; fields that aren't what they should be are null."""
    return docs.select(F.from_json(column, DETAIL).alias("doc"), F.try_parse_json(column).alias("raw")).select("doc.*", "raw")


def league_games(details: DataFrame) -> DataFrame:
    """Game rows of 28 columns: clean text, scores or the result text, extra-time flags, points and save shares from the other side's shots."""
    parts = F.split(F.replace("result", F.lit(" "), F.lit("")), "-")
    both = F.coalesce(F.col("home_score").try_cast("bigint"), F.col("away_score").try_cast("bigint")).isNull() & (F.size(parts) == 2)
    score = lambda c, i: F.when(both, F.get(parts, F.lit(i)).try_cast("bigint")).otherwise(F.col(c).try_cast("bigint"))
    labels = lambda c: F.transform(F.coalesce(c, F.array().cast("array<struct<period:string>>")), lambda p: F.coalesce(p["period"], F.lit("")))
    ot, so = overtime_flags(labels(F.transform("period_scores", lambda p: F.struct(p["period"].alias("period")))), labels(F.transform("events", lambda p: F.struct(p["period"].alias("period")))))
    more = F.coalesce(F.exists("period_scores", lambda p: ~p["period"].isin("1", "2", "3")), F.lit(False))
    df = details.select("game_id", F.col("date").alias("game_date"), season_year(F.col("date")).alias("season"), clean_text(F.col("league")).alias("league"), game_type(F.col("league")).alias("game_type"), clean_text(F.col("home_team")).alias("home_team"), clean_text(F.col("away_team")).alias("away_team"), clean_text(F.col("venue")).alias("venue"),
                        score("home_score", 0).alias("home_score"), score("away_score", 1).alias("away_score"), (ot & ~so).alias("went_to_ot"), so.alias("went_to_so"), more.alias("_more"),
                        F.coalesce("league_id", F.lit("")).alias("league_id"), F.coalesce("time", F.lit("")).alias("time"), *(F.col(f"{s}_team_stats.{k}").alias(f"{s}_{n}") for k, n in (("shots", "shots"), ("saves", "saves"), ("penalty_minutes", "pim")) for s in ("home", "away")),
                        F.coalesce(F.size("period_scores"), F.lit(0)).cast("bigint").alias("periods"), *(clean_text(F.coalesce(f"{s}_team_lineup.head_coach", F.lit(""))).alias(f"{s}_coach") for s in ("home", "away")), F.substring(F.coalesce("metadata.scraped_at", F.lit("")), 1, 26).alias("scraped_at"),
                        cross_save_pct(F.col("home_team_stats.saves"), F.col("away_team_stats.shots")).alias("home_save_pct"), cross_save_pct(F.col("away_team_stats.saves"), F.col("home_team_stats.shots")).alias("away_save_pct"))
    return df.withColumn("home_points", points_210(F.col("home_score"), F.col("away_score"), F.col("_more"))).withColumn("away_points", points_210(F.col("away_score"), F.col("home_score"), F.col("_more"))).drop("_more")


def _tagged(details: DataFrame, entries: Column, name: str) -> DataFrame:
    """``(game_id, game_date, season, league, scraped_at, pos, <name>)`` for each entry that is an object; places count the others too."""
    tags = ("game_id", leading_date(F.col("date")).alias("game_date"), season_year(F.col("date")).alias("season"), F.coalesce(clean_text(F.col("league")), F.lit("")).alias("league"), F.coalesce("metadata.scraped_at", F.lit("")).alias("scraped_at"))
    return details.select(*tags, F.posexplode(entries).alias("pos", name)).filter(_is_object(name))


def _listed(path: str) -> Column:
    return F.try_variant_get("raw", path, "array<variant>")


def _said(v: str, path: str) -> Column:
    """A field as text; absent, null, false and 0 are an empty text."""
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    text = _text(v, path)
    empty = text.isNull() | (kind.isin("BOOLEAN", "BIGINT") & text.isin("0", "false"))
    return F.when(empty, "").otherwise(text)


_TAGS = ("game_id", "game_date", "season", "league")


def league_events(details: DataFrame) -> DataFrame:
    """Event rows of 21 columns and their place; texts that aren't there are empty, numbers null, and so are assists of an empty list. Entries that aren't objects are left out."""
    e = _tagged(details, _listed("$.events"), "e")
    assists = F.try_variant_get("e", "$.assists", "array<variant>")
    return e.select(
        *_TAGS, "pos", _long("e", "$.period").alias("period"), _said("e", "$.time").alias("event_time"), clock_seconds(_text("e", "$.time")).alias("seconds"), *(_said("e", f"$.{k}").alias(k) for k in ("event_type", "team", "player_name", "player_number", "goal_type")),
        _long("e", "$.penalty_minutes").alias("penalty_minutes"), *(_said("e", f"$.{k}").alias(k) for k in ("penalty_start", "penalty_end", "penalty_type", "goalkeeper_action")), *(_long("e", f"$.{k}").alias(k) for k in ("powerplay_number", "score_home", "score_away")),
        F.when(F.size(assists) > 0, F.to_json(F.try_variant_get("e", "$.assists", "variant"))).alias("assists"), "scraped_at",
    )


def league_periods(details: DataFrame) -> DataFrame:
    """``(tags, pos, period, home_score, away_score)`` of the entries of ``period_scores``."""
    p = _tagged(details, _listed("$.period_scores"), "p")
    return p.select(*_TAGS, "pos", F.coalesce(_text("p", "$.period"), F.lit("")).alias("period"), _long("p", "$.home").alias("home_score"), _long("p", "$.away").alias("away_score"), "scraped_at")


def league_goalkeepers(details: DataFrame) -> DataFrame:
    """``(tags, pos, team, name, number, saves, shots_against, save_pct)`` of the entries of ``goalkeepers``; the number is a text."""
    g = _tagged(details, _listed("$.goalkeepers"), "g")
    return g.select(*_TAGS, "pos", *(_said("g", f"$.{k}").alias(k) for k in ("team", "name", "number")), _long("g", "$.saves").alias("saves"), _long("g", "$.shots_against").alias("shots_against"), F.try_variant_get("g", "$.save_percentage", "double").alias("save_pct"), "scraped_at")


def league_player_stats(details: DataFrame) -> DataFrame:
    """``(tags, pos, team, player_id, player_name, goals, assists, pim, shots, plus_minus)``; a ``plusMinus`` of 0 counts as absent beside ``plus_minus``."""
    p = _tagged(details, _listed("$.player_stats"), "p")
    balance = F.coalesce(zero_to_null(_long("p", "$.plusMinus")), _long("p", "$.plus_minus"))
    return p.select(*_TAGS, "pos", *(_said("p", f"$.{k}").alias(k) for k in ("team", "player_id", "player_name")), *(_long("p", f"$.{k}").alias(k) for k in ("goals", "assists", "pim", "shots")), balance.alias("plus_minus"), "scraped_at")


def league_referees(details: DataFrame) -> DataFrame:
    """``(tags, pos, name, role)``: referees, as names or as objects with a name and perhaps a role, then linesmen; anything else is left out."""
    def of(path: str, role: str, own: bool) -> Column:
        named = lambda x: F.when(_is_object(x), _text(x, "$.name")).when(F.schema_of_variant(x) == "STRING", _text(x, "$"))
        said = lambda x: F.coalesce(blank_to_null(_text(x, "$.role")), F.lit(role)) if own else F.lit(role)
        rows = F.transform(F.coalesce(_listed(path), F.array().cast("array<variant>")), lambda x: F.struct(F.coalesce(named(x), F.when(_is_object(x), "")).alias("name"), said(x).alias("role")))
        return F.filter(rows, lambda r: r["name"].isNotNull())

    tags = ("game_id", leading_date(F.col("date")).alias("game_date"), season_year(F.col("date")).alias("season"), F.coalesce(clean_text(F.col("league")), F.lit("")).alias("league"), F.coalesce("metadata.scraped_at", F.lit("")).alias("scraped_at"))
    rows = details.select(*tags, F.posexplode(F.concat(of("$.referees", "Referee", True), of("$.linesmen", "Linesman", False))).alias("pos", "x"))
    return rows.select(*_TAGS, "pos", "x.name", "x.role", "scraped_at")


def league_on_ice(details: DataFrame) -> DataFrame:
    """``(tags, pos, i, period, event_time, event_type, event_team, team_side, player_number)``: players on the ice at events, by side; the positive side is the event's team."""
    e = _tagged(details, _listed("$.events"), "e")
    none = F.array().cast("array<variant>")
    side = lambda s: F.transform(F.coalesce(F.try_variant_get("e", f"$.{s}_participants", "array<variant>"), none), lambda n: F.struct(F.lit(s).alias("side"), _text(n, "$").alias("number")))
    e = e.select(*_TAGS, "pos", _long("e", "$.period").alias("period"), _said("e", "$.time").alias("event_time"), _said("e", "$.event_type").alias("event_type"), _said("e", "$.team").alias("event_team"), "scraped_at", F.posexplode(F.concat(side("positive"), side("negative"))).alias("i", "p"))
    return e.select(*_TAGS, "pos", "i", "period", "event_time", "event_type", "event_team", F.col("p.side").alias("team_side"), F.col("p.number").alias("player_number"), "scraped_at")


#: Places of a line that has them by name, and the positions that they stand for.
_PLACES = {"left_wing": "LW", "center": "C", "right_wing": "RW", "left_defense": "LD", "right_defense": "RD"}


def league_lineups(details: DataFrame) -> DataFrame:
    """``(tags, pos, team, is_home, head_coach, assistant_coach, line_number, position, player_name, player_number, is_starting)`` of both sides: goalies, lines and extras, in order.

    A line has arrays ``forwards`` and ``defense``, or else places by name. A player's own position counts before the place's. Line-ups, lines and players that aren't objects are left out.
    """
    none = F.array().cast("array<variant>")
    listed = lambda v, path: F.coalesce(F.try_variant_get(v, path, "array<variant>"), none)

    def people(xs: Column, line: Column, place: str) -> Column:
        return F.transform(xs, lambda x: F.struct(x.alias("p"), line.alias("line"), F.lit(place).alias("place")))

    def of_line(line: Column) -> Column:
        number = F.coalesce(zero_to_null(_long(line, "$.line")), _long(line, "$.line_number"))
        arrays = F.try_variant_get(line, "$.forwards", "variant").isNotNull() | F.try_variant_get(line, "$.defense", "variant").isNotNull()
        placed = F.concat(*(people(F.array_compact(F.array(F.try_variant_get(line, f"$.{k}", "variant"))), number, v) for k, v in _PLACES.items()))
        return F.when(arrays, people(F.concat(listed(line, "$.forwards"), listed(line, "$.defense")), number, "")).otherwise(placed)

    def head(side: str) -> Column:
        of = f"{side}_lineup"
        return F.struct(F.coalesce(clean_text(_text(of, "$.team")), F.lit("")).alias("team"), F.lit(side == "home").alias("is_home"), _said(of, "$.head_coach").alias("head_coach"), _said(of, "$.assistant_coach").alias("assistant_coach"))

    def one(side: str) -> Column:
        of, no_line = f"{side}_lineup", F.lit(None).cast("bigint")
        lines = F.flatten(F.transform(F.filter(listed(of, "$.lines"), _is_object), of_line))
        every = F.concat(people(listed(of, "$.goalies"), no_line, "G"), lines, people(listed(of, "$.extra_players"), no_line, "EXTRA"))
        return F.transform(F.filter(every, lambda x: _is_object(x["p"])), lambda x: F.struct(F.lit(side == "home").alias("is_home"), x.alias("x")))

    tags = ("game_id", leading_date(F.col("date")).alias("game_date"), season_year(F.col("date")).alias("season"), F.coalesce(clean_text(F.col("league")), F.lit("")).alias("league"), F.coalesce("metadata.scraped_at", F.lit("")).alias("scraped_at"))
    # Line-ups and what a side's players share are taken out of a document once, not for each player.
    sides = details.select(*tags, *(F.try_variant_get("raw", f"$.{s}_team_lineup", "variant").alias(f"{s}_lineup") for s in ("home", "away")))
    heads = [F.col(c) for c in (*_TAGS, "scraped_at")] + [head(s).alias(f"{s}_head") for s in ("home", "away")]
    rows = sides.select(*heads, F.posexplode(F.concat(one("home"), one("away"))).alias("pos", "r"))
    rows = rows.select(*_TAGS, "scraped_at", "pos", F.when(F.col("r.is_home"), F.col("home_head")).otherwise(F.col("away_head")).alias("h"), F.col("r.x.p").alias("p"), F.col("r.x.line").alias("line_number"), F.col("r.x.place").alias("place"))
    starting = F.coalesce(F.try_variant_get("p", "$.starting", "boolean"), F.lit(False))
    return rows.select(*_TAGS, "pos", "h.*", "line_number", position(F.coalesce(blank_to_null(_text("p", "$.position")), "place")).alias("position"), _said("p", "$.name").alias("player_name"), _said("p", "$.number").alias("player_number"), starting.alias("is_starting"), "scraped_at")


#: What the rows of each league table are told apart by.
LEAGUE_KEYS: dict[str, tuple[str, ...]] = {
    "games": ("game_id",),
    "events": ("game_id", "period", "event_time", "event_type", "player_name"),
    "goalkeepers": ("game_id", "team", "name"),
    "lineups": ("game_id", "team", "position", "player_number"),
    "period_scores": ("game_id", "period"),
    "referees": ("game_id", "name"),
    "on_ice": ("game_id", "period", "event_time", "event_type", "team_side", "player_number"),
    "player_stats": ("game_id", "team", "player_name"),
}


def league_tables(details: DataFrame) -> dict[str, DataFrame]:
    """All eight tables of league documents, of each key the first row: by the time the document was fetched, then by its place there. Null keys are equal to each other."""
    readers = {"games": league_games, "events": league_events, "goalkeepers": league_goalkeepers, "lineups": league_lineups, "period_scores": league_periods, "referees": league_referees, "on_ice": league_on_ice, "player_stats": league_player_stats}
    out = {}
    for name, reader in readers.items():
        rows = reader(details)
        out[name] = keep_first(rows, list(LEAGUE_KEYS[name]), [c for c in ("scraped_at", "pos", "i") if c in rows.columns]).drop("pos", "i", *(() if name == "games" else ("scraped_at",)))
    return out


#: Known names of Norwegian teams and their slugs; the first that contains a name or is contained in it counts.
NORWEGIAN_TEAMS = (
    ("IF Frisk Asker Hockey", "friskasker"), ("Frisk Asker", "friskasker"), ("Grüner Hockey", "gruner"), ("Grüner", "gruner"), ("Lillehammer IHK", "lillehammer"), ("Manglerud Star IK", "manglerud"), ("Manglerud Star", "manglerud"),
    ("Ringerike IHK", "ringerike"), ("Sparta Warriors", "sparta"), ("Stavanger Ishockeyklubb", "stavanger"), ("Stjernen Hockey", "stjernen"), ("Storhamar Hockey", "storhamar"), ("Storhamar", "storhamar"), ("Vålerenga Ishockey", "valerenga"), ("Vålerenga", "valerenga"),
    ("Comet Halden", "comet"), ("Comet", "comet"), ("Lørenskog IHK", "lorenskog"), ("Lørenskog", "lorenskog"), ("Narvik Hockey", "narvik"), ("Nidaros Hockey", "nidaros"),
)


def norwegian_matches(docs: DataFrame, known: tuple[tuple[str, str], ...] = NORWEGIAN_TEAMS) -> DataFrame:
    """Match rows of 17 columns from documents ``{tournament: {id, name, year}, matches: [...]}``; matches without a result are left out. The slug is the home team's.

    Goals that a result doesn't tell are 0; a match is finished, and has statistics, if its end result is told. The playing time is 3,600 seconds.
    """
    # What is told of the tournament is read before the matches part: behind that each would carry the whole document.
    told = (_long("doc", "$.tournament.id").alias("tournament_id"), _text("doc", "$.tournament.name").alias("tournament_name"), _long("doc", "$.tournament.year").alias("year"))
    m = docs.select(*told, F.explode(F.try_variant_get("doc", "$.matches", "array<variant>")).alias("m")).filter(_is_object(F.try_variant_get("m", "$.matchResult", "variant")))
    team = lambda side: F.coalesce(_text("m", f"$.{side}teamOrgName"), _text("m", f"$.{side}team"), F.lit(""))
    ended = blank_to_null(_text("m", "$.matchResult.matchEndResult")).isNotNull()
    return m.select(
        _long("m", "$.matchId").alias("match_id"), slug_among(team("home"), known).alias("team_slug"), _text("m", "$.matchDate").alias("match_date"), _text("m", "$.lastChangeDate").alias("end_time"),
        *(c for s in ("home", "away") for c in (_long("m", f"$.{s}teamId").alias(f"{s}_team_id"), team(s).alias(f"{s}_team_name"))), *(F.coalesce(_long("m", f"$.matchResult.{s}Goals"), F.lit(0).cast("bigint")).alias(f"{s}_goals") for s in ("home", "away")),
        F.when(ended, "Finished").otherwise("Upcoming").alias("status"), F.lit(3600).cast("bigint").alias("game_time"), ended.alias("has_statistics"), "tournament_id", "tournament_name",
        zero_to_null(F.col("year")).alias("season_year"), phase(F.coalesce("tournament_name", F.lit(""))).alias("season_phase"),
    )


def _of_match(docs: DataFrame, known: tuple[tuple[str, str], ...]) -> tuple[DataFrame, list[Column]]:
    """Entries of ``(match_id, doc)``, where the document is a list, with their place, and the columns that all three tables begin with."""
    x = docs.select("match_id", F.posexplode(F.try_variant_get("doc", "$", "array<variant>")).alias("i", "x")).filter(_is_object("x"))
    name = F.coalesce(_text("x", "$.teamName"), F.lit(""))
    return x, [F.col("match_id"), slug_among(name, known).alias("team_slug"), _long("x", "$.orgId").alias("team_id"), name.alias("team_name")]


def _person(prefix: str = "") -> Column:
    first, last = (f"$.{prefix}{n}" if prefix else f"$.{n[0].lower()}{n[1:]}" for n in ("FirstName", "LastName"))
    return F.trim(F.concat(F.coalesce(_text("x", first), F.lit("")), F.lit(" "), F.coalesce(_text("x", last), F.lit(""))))


def norwegian_goals(docs: DataFrame, known: tuple[tuple[str, str], ...] = NORWEGIAN_TEAMS) -> DataFrame:
    """Goals of ``(match_id, doc)``; event ids are made of the match and the place, periods of their ids, and a time of 0 is none. An empty list gives no row."""
    x, head = _of_match(docs, known)
    return x.select(
        synthetic_id(F.col("match_id"), F.col("i")).alias("event_id"), *head, F.lit(None).cast("timestamp_ntz").alias("timestamp"), zero_to_null(_long("x", "$.periodTime")).alias("match_time"), period_number(F.coalesce(_long("x", "$.periodId"), F.lit(0).cast("bigint"))).alias("period"),
        *(F.lit(None).cast("bigint").alias(f"{s}_goals") for s in ("home", "away")), _text("x", "$.goalType").alias("goal_type"), _long("x", "$.personId").alias("scorer_id"), _person().alias("scorer_name"),
        *(c for n, k in ((1, "firstAssist"), (2, "secondAssist")) for c in (_long("x", f"$.{k}PersonId").alias(f"assist{n}_id"), blank_to_null(_person(k)).alias(f"assist{n}_name"))),
    )


def norwegian_penalties(docs: DataFrame, known: tuple[tuple[str, str], ...] = NORWEGIAN_TEAMS) -> DataFrame:
    """Penalties of ``(match_id, doc)``; event ids begin 500 after those of goals, minutes that aren't told are 0."""
    x, head = _of_match(docs, known)
    return x.select(
        synthetic_id(F.col("match_id"), F.col("i"), 500).alias("event_id"), *head, F.lit(None).cast("timestamp_ntz").alias("timestamp"), _long("x", "$.servingStartTime").alias("match_time"), F.lit(None).cast("bigint").alias("period"), F.coalesce(_long("x", "$.severityMinutes"), F.lit(0).cast("bigint")).alias("duration_minutes"),
        _text("x", "$.infractionType").alias("reason"), _text("x", "$.severityType").alias("info"), F.lit(False).alias("is_team_or_official"), _long("x", "$.personId").alias("player_id"), _person().alias("player_name"),
    )


def norwegian_lineup(docs: DataFrame, known: tuple[tuple[str, str], ...] = NORWEGIAN_TEAMS) -> DataFrame:
    """Players of ``(match_id, doc)``, 13 columns, of which the source has no side, role, birthdate or hand, and 0 for line, height and weight."""
    x, head = _of_match(docs, known)
    nothing = lambda n: F.lit(None).cast("string").alias(n)
    zero = lambda n: F.lit(0).cast("bigint").alias(n)
    return x.select(
        head[0], head[1], nothing("side"), _long("x", "$.personId").alias("player_id"), F.coalesce(_text("x", "$.firstName"), F.lit("")).alias("first_name"), F.coalesce(_text("x", "$.lastName"), F.lit("")).alias("last_name"),
        F.coalesce(_long("x", "$.shirtNo"), F.lit(0).cast("bigint")).alias("jersey"), nothing("role"), zero("line_number"), zero("height"), zero("weight"), nothing("date_of_birth"), nothing("handedness"),
    )


def drop_totals(df: DataFrame) -> DataFrame:
    """Without rows that stand for sums or nobody."""
    return df.filter(~F.coalesce(F.col("player_id"), F.lit("")).isin("", "0", "None") & (F.lower(F.coalesce("name", F.lit(""))) != "total"))


def prefer_source(first: DataFrame, second: DataFrame, key: str, good: str) -> DataFrame:
    """By key the rows of ``first``, unless none of them has ``good`` and some of ``second`` have."""
    has = lambda df, n: df.groupBy(key).agg(F.max(blank_to_null(F.col(good)).isNotNull()).alias(n))
    chosen = has(first, "_a").join(has(second, "_b"), key, "full").select(key, F.when(F.col("_a").isNull() | (~F.col("_a") & F.coalesce("_b", F.lit(False))), "second").otherwise("first").alias("_use"))
    pick = lambda df, n: df.join(chosen.filter(F.col("_use") == n).select(key), key, "left_semi")
    return pick(first, "first").unionByName(pick(second, "second"))
