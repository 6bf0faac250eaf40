"""Facts by game, standings and shot-attempt shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hockeylake.functions import first_name, per_60, points_210, points_3210, rest_of_name

ATTEMPTS = ("GOAL", "SHOT", "MISSED_SHOT", "BLOCKED_SHOT")


def with_points(games: DataFrame, strict: bool = True) -> DataFrame:
    """Points of both sides. The loser after regulation gets one if the status says OT or SO, or (not strict) if the last period was one."""
    extra = F.col("status").rlike("OT|SO|Shootout") if strict else F.col("last_period_type").isin("OT", "SO")
    home, away = F.col("home_score"), F.col("away_score")
    return games.withColumn("home_points", points_210(home, away, extra)).withColumn("away_points", points_210(away, home, extra))


def name_lookup(players: DataFrame, id_col: str = "id", name_col: str = "name", keep_fanout: bool = False) -> DataFrame:
    """First and last name by id. One row an id, unless every spelling is asked for."""
    names = players.filter(F.col(name_col).isNotNull()).select(F.col(id_col).alias("player_id"), F.col(name_col).alias("_n"))
    names = names.distinct() if keep_fanout else names.groupBy("player_id").agg(F.min("_n").alias("_n"))
    return names.select("player_id", first_name(F.col("_n")).alias("player_first_name"), rest_of_name(F.col("_n")).alias("player_last_name"))


def player_game_stats(game_players: DataFrame, games: DataFrame, players: DataFrame) -> DataFrame:
    """Player rows with date, season, team, opponent and name; names and games that are missing leave nulls, players without a game are left out."""
    g = games.select("game_id", "game_date", "season", "game_type", F.concat(F.lit("T"), F.col("home_team_id")).alias("_h"), F.concat(F.lit("T"), F.col("away_team_id")).alias("_a"))
    df = game_players.join(g, "game_id").join(name_lookup(players), "player_id", "left")
    save = F.when(F.col("shots_against") > 0, F.col("saves").cast("double") / F.col("shots_against"))
    return df.select("*", F.when(F.col("is_home"), F.col("_h")).otherwise(F.col("_a")).alias("team_abbr"), save.alias("save_pct")).drop("_h", "_a")


def team_game_stats(games: DataFrame, strict: bool = True) -> DataFrame:
    """Two rows a game, one for each side, from one scan."""
    g = with_points(games, strict)

    def side(own: str, other: str):
        return F.struct(
            F.lit(own == "home").alias("is_home"),
            F.col(f"{own}_team_id").alias("team_id"),
            F.concat(F.lit("T"), F.col(f"{own}_team_id")).alias("team_abbr"),
            F.concat(F.lit("T"), F.col(f"{other}_team_id")).alias("opponent_abbr"),
            F.col(f"{own}_score").alias("goals_for"),
            F.col(f"{other}_score").alias("goals_against"),
            F.col(f"{own}_points").alias("team_points"),
            *(F.col(f"{own}_{c}").alias(c) for c in ("sog", "pp_goals", "pp_opps", "pim")),
        )

    return g.select("game_id", "game_date", "season", "game_type", "status", F.explode(F.array(side("home", "away"), side("away", "home"))).alias("s")).select(
        "game_id", "game_date", "season", "game_type", "status", "s.*"
    )


def team_game_stats_extended(team_games: DataFrame, teams: DataFrame) -> DataFrame:
    """Conference and division by team; teams that are not listed leave nulls."""
    return team_games.join(teams.select(F.col("abbr").alias("team_abbr"), "conference", "division"), "team_abbr", "left")


def shot_attempts(events: DataFrame, games: DataFrame) -> DataFrame:
    """Attempts by game and team."""
    g = games.select("game_id", "game_date", F.concat(F.lit("T"), F.col("home_team_id")).alias("_h"), F.concat(F.lit("T"), F.col("away_team_id")).alias("_a"))
    df = events.filter(F.col("event_type").isin(*ATTEMPTS)).groupBy("game_id", "by_home").agg(F.count("*").alias("attempts")).join(g, "game_id")
    return df.select("game_id", "game_date", F.when(F.col("by_home"), F.col("_h")).otherwise(F.col("_a")).alias("team_abbr"), "attempts")


def team_corsi(team_games: DataFrame, attempts: DataFrame) -> DataFrame:
    """Attempts for and against and their share. The same aggregate serves both sides, so that Spark shuffles it once."""
    own = attempts.select("game_id", "team_abbr", F.col("attempts").alias("_for"))
    other = attempts.select("game_id", F.col("team_abbr").alias("opponent_abbr"), F.col("attempts").alias("_against"))
    df = team_games.select("game_id", "game_date", "season", "game_type", "status", "team_abbr", "opponent_abbr").join(own, ["game_id", "team_abbr"], "left").join(other, ["game_id", "opponent_abbr"], "left")
    df = df.withColumn("corsi_for", F.coalesce("_for", F.lit(0)).cast("bigint")).withColumn("corsi_against", F.coalesce("_against", F.lit(0)).cast("bigint"))
    total = F.col("corsi_for") + F.col("corsi_against")
    return df.withColumn("corsi_pct", F.when(total > 0, F.round(F.col("corsi_for").cast("double") / total, 4))).drop("_for", "_against")


def fact_team_game(raw: DataFrame) -> DataFrame:
    """Team rows of a league's raw table, with 3/2/1/0 points."""
    one = lambda c: F.col(c).cast("int") == 1
    return raw.withColumn("points", points_3210(one("vann"), one("overtime") | one("shootout")))


def fact_player_game(raw: DataFrame) -> DataFrame:
    """Minutes on the ice, and points and shots in 60 of them; null where the clock is null, not a number or 0."""
    toi = F.col("toi_seconds").cast("double")
    return raw.select("*", F.round(toi / 60, 4).alias("toi_min"), per_60(F.col("poang").cast("double"), toi, 6).alias("points_per_60"), per_60(F.col("sog").cast("double"), toi, 6).alias("shots_per_60"))


def fact_goalie_game(raw: DataFrame) -> DataFrame:
    """The save share as a fraction and the goals against as a number; null texts stay null."""
    return raw.select("*", F.round(F.col("raddningsprocent").cast("double") / 100, 6).alias("save_pct"), F.col("inslappta_mal").cast("double").alias("goals_against_avg"))


def dim_standings(facts: DataFrame) -> DataFrame:
    """Standings by season, game type and team."""
    number = lambda c: F.col(c).cast("bigint")
    df = facts.groupBy("season_name", "game_type_name", "lag").agg(
        F.countDistinct("game_uuid").alias("matcher"),
        F.sum(F.when(number("vann") == 1, 1).otherwise(0)).alias("vinster"),
        F.sum("points").alias("poang"),
        F.sum(number("egna_mal")).alias("gjorda_mal"),
        F.sum(number("inslappta_mal")).alias("inslappta_mal"),
    )
    return df.withColumn("malminus", F.col("gjorda_mal") - F.col("inslappta_mal"))


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row a key: the first in the given order. Null keys are equal to each other; a table that lacks a key column stays as it is."""
    if set(keys) - set(df.columns):
        return df
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")
