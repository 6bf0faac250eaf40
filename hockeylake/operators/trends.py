"""Trends, splits and tables over player and team games."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rolling_average(df: DataFrame, by: list[str], value: str, n: int, name: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy("game_date", "game_id").rowsBetween(-(n - 1), 0)
    return df.select(*by, "game_id", "game_date", F.avg(value).over(w).alias(name))


def split(df: DataFrame, by: list[str]) -> DataFrame:
    """Games, wins and goals by group."""
    return df.groupBy(*by).agg(
        F.count("*").alias("games"), F.sum((F.coalesce("team_points", F.lit(0)) == 2).cast("bigint")).alias("wins"), F.sum("goals_for").alias("gf"), F.sum("goals_against").alias("ga"), F.avg("goals_for").alias("gf_avg")
    )


def season_table(df: DataFrame) -> DataFrame:
    """Standings of the regular season."""
    regular = df.filter(F.col("game_type") == 2)
    points = regular.groupBy("team_abbr", "season").agg(F.sum(F.coalesce("team_points", F.lit(0))).alias("points"))
    return split(regular, ["team_abbr", "season"]).join(points, ["team_abbr", "season"])


def player_seasons(df: DataFrame) -> DataFrame:
    return df.groupBy("player_id", "season").agg(F.count("*").alias("games"), *(F.sum(c).alias(c) for c in ("goals", "assists", "points")))


def top_scorers(df: DataFrame, n: int) -> DataFrame:
    """The n best of each season by points, then goals, then id."""
    w = Window.partitionBy("season").orderBy(F.desc("points"), F.desc("goals"), "player_id")
    return player_seasons(df).withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n).withColumn("place", F.col("place").cast("bigint"))


def last_games(df: DataFrame, entity: str, n: int) -> DataFrame:
    w = Window.partitionBy(entity).orderBy(F.desc("game_date"), F.desc("game_id"))
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def latest(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(F.desc("game_date"), F.desc("game_id")).limit(n)


def page(df: DataFrame, keys: list[str], number: int, size: int) -> DataFrame:
    """A page of the rows in order of their keys, pages counted from 0."""
    return df.orderBy(*keys).offset(number * size).limit(size)


def game_box(df: DataFrame) -> DataFrame:
    """Totals by game and team."""
    return df.groupBy("game_id", "team_abbr").agg(F.count("*").alias("players"), *(F.sum(c).alias(c) for c in ("goals", "assists", "shots", "pim")), F.sum(F.when(F.col("position") == "G", F.col("saves"))).alias("goalie_saves"))


def team_trend(df: DataFrame, team: str) -> DataFrame:
    """One team's games with their outcome."""
    p = F.col("team_points")
    outcome = F.when(p == 2, "W").when(p == 1, "OTL").when(p == 0, "L").otherwise("T")
    return df.filter(F.col("team_abbr") == team).select("game_id", "game_date", "team_abbr", "opponent_abbr", "is_home", "goals_for", "goals_against", outcome.alias("outcome"))


def player_trend(df: DataFrame, player: int) -> DataFrame:
    w = Window.partitionBy("player_id").orderBy("game_date", "game_id").rowsBetween(-9, 0)
    return df.filter(F.col("player_id") == player).select("game_id", "game_date", "points", "goals", F.avg("points").over(w).alias("pts_avg"))


def goalie_situations(df: DataFrame) -> DataFrame:
    """Save share of goalies at home and away, by how much they had to do."""
    load = F.when(F.col("shots_against") >= 30, "busy").when(F.col("shots_against") >= 25, "usual").otherwise("quiet")
    return (
        df.filter(F.col("position") == "G")
        .groupBy("player_id", "is_home", load.alias("load"))
        .agg(F.count("*").alias("games"), F.sum("saves").alias("saves"), F.sum("shots_against").alias("shots"))
        .withColumn("save_pct", F.col("saves").cast("double") / F.nullif(F.col("shots"), F.lit(0)))
    )


def points_curve(team_games: DataFrame, entity: str = "team_abbr", points: str = "team_points") -> DataFrame:
    """``(entity, season, game_no, game_date, game_id, points, total, pace)``: a team's points game by game, their running total and what that comes to in 82 games.

    Games of one date go by id; null points are 0. The pace is rounded as a double: what lies just below a half in binary, as 1.025 does, goes down.
    """
    w = Window.partitionBy(entity, "season").orderBy("game_date", "game_id")
    got = F.coalesce(F.col(points), F.lit(0)).cast("bigint")
    total, n = F.sum(got).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.row_number().over(w).cast("bigint")
    return team_games.select(entity, "season", n.alias("game_no"), "game_date", "game_id", got.alias("points"), total.alias("total"), (F.round(total * 82.0 / n * 100, 0) / 100).alias("pace"))


def division_standings(table: DataFrame, division: str = "division") -> DataFrame:
    """Ranks of a season's table within each division, in the league, and points behind the division's first: by points, then wins, then team.

    ``table`` has ``team_abbr``, ``season``, the division, ``points`` and ``wins``; teams without a division are a division of their own.
    """
    order = (F.desc("points"), F.desc("wins"), "team_abbr")
    within = Window.partitionBy("season", division).orderBy(*order)
    first = F.first("points").over(within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return table.withColumns({
        "division_rank": F.row_number().over(within).cast("bigint"), "league_rank": F.row_number().over(Window.partitionBy("season").orderBy(*order)).cast("bigint"), "behind": first - F.col("points"),
    })


def playoff_bracket(series: DataFrame) -> DataFrame:
    """The bracket as a tree: each series with ``parent``, the letter of the series of the next round that its winner plays in, ``path`` of letters from the last round down, and ``depth``.

    ``series`` has ``season, series_letter, round, top_seed_id, bottom_seed_id, winning_team_id``. Series are linked round by round through their winners, by a recursive
    query from those that have no parent: the final, and series without a winner or whose winner isn't drawn yet. Rows without letter or round are left out.
    """
    spark = series.sparkSession
    return spark.sql(
        """
WITH RECURSIVE s AS (SELECT season, series_letter, `round`, top_seed_id, bottom_seed_id, winning_team_id FROM {series} WHERE series_letter IS NOT NULL AND `round` IS NOT NULL),
linked AS (
  SELECT a.season, a.series_letter, a.`round`, a.top_seed_id, a.bottom_seed_id, a.winning_team_id, min(b.series_letter) AS parent
  FROM s a LEFT JOIN s b ON a.season = b.season AND b.`round` = a.`round` + 1 AND a.winning_team_id IN (b.top_seed_id, b.bottom_seed_id)
  GROUP BY ALL),
tree AS (
  SELECT season, series_letter, parent, series_letter AS path, 0 AS depth FROM linked WHERE parent IS NULL
  UNION ALL
  SELECT l.season, l.series_letter, l.parent, t.path || '/' || l.series_letter, t.depth + 1 FROM tree t JOIN linked l ON l.season = t.season AND l.parent = t.series_letter)
SELECT l.*, t.path, CAST(t.depth AS BIGINT) AS depth FROM linked l JOIN tree t ON t.season = l.season AND t.series_letter = l.series_letter""",
        series=series,
    )
