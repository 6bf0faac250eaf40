"""Rolling and cumulative form of players, goalies and teams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hockeylake.functions import zscore


def last_n(entity: str, n: int, order: tuple[str, ...] = ("game_date", "game_id")):
    """The entity's last n rows in order; the second key breaks ties of the first."""
    return Window.partitionBy(entity).orderBy(*order).rowsBetween(-(n - 1), 0)


def season_so_far(entity: str, season: str = "season", order: tuple[str, ...] = ("game_date", "game_id")):
    return Window.partitionBy(entity, season).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def recency(entity: str) -> Column:
    return F.row_number().over(Window.partitionBy(entity).orderBy(F.desc("game_date"), F.desc("game_id"))).cast("bigint")


def rolling(df: DataFrame, entity: str, averages: dict[str, tuple[str, int]], sums: dict[str, tuple[str, int]] | None = None, seasons: dict[str, str] | None = None, deviations: dict[str, tuple[str, int]] | None = None, digits: int | None = None) -> DataFrame:
    """Adds averages, sums and sample deviations over the last n rows, and running season sums, of an entity.

    All windows share the shuffle by entity: the season windows are partitioned more finely, which
    that distribution satisfies. Nulls count as 0.
    """
    value = lambda c: F.coalesce(F.col(c), F.lit(0))
    rounded = lambda c: F.round(c, digits) if digits is not None else c
    out = {k: rounded(F.avg(value(c)).over(last_n(entity, n))) for k, (c, n) in averages.items()}
    out |= {k: F.sum(value(c)).over(last_n(entity, n)) for k, (c, n) in (sums or {}).items()}
    out |= {k: F.stddev(value(c)).over(last_n(entity, n)) for k, (c, n) in (deviations or {}).items()}
    out |= {k: F.sum(value(c)).over(season_so_far(entity)) for k, c in (seasons or {}).items()}
    return df.withColumns(out)


def player_rolling_stats(player_games: DataFrame) -> DataFrame:
    """Skaters with ice time: form over 5, 10 and 20 games, season totals so far, recency and z-scores of the last 5 against the last 20."""
    df = player_games.filter((F.col("position") != "G") & (F.coalesce("toi_seconds", F.lit(0)) > 0))
    df = rolling(
        df,
        "player_id",
        {"pts_avg_5g": ("points", 5), "pts_avg_10g": ("points", 10), "pts_avg_20g": ("points", 20), "goals_avg_5g": ("goals", 5), "goals_avg_10g": ("goals", 10), "goals_avg_20g": ("goals", 20), "shots_avg_10g": ("shots", 10), "toi_avg_10g": ("toi_seconds", 10)},
        seasons={"pts_season": "points", "goals_season": "goals", "assists_season": "assists"},
        deviations={"pts_stddev_20g": ("points", 20), "goals_stddev_20g": ("goals", 20)},
    )
    df = df.withColumn("gp_season", F.count(F.lit(1)).over(season_so_far("player_id"))).withColumn("game_recency_rank", recency("player_id"))
    return df.withColumn("pts_zscore_5v20", zscore(F.col("pts_avg_5g"), F.col("pts_avg_20g"), F.col("pts_stddev_20g"))).withColumn(
        "goals_zscore_5v20", zscore(F.col("goals_avg_5g"), F.col("goals_avg_20g"), F.col("goals_stddev_20g"))
    )


def goalie_rolling_stats(player_games: DataFrame) -> DataFrame:
    """Goalies with over ten minutes."""
    df = player_games.filter((F.col("position") == "G") & (F.coalesce("toi_seconds", F.lit(0)) > 600))
    df = rolling(
        df,
        "player_id",
        {"sv_pct_avg_5g": ("save_pct", 5), "sv_pct_avg_10g": ("save_pct", 10), "sv_pct_avg_20g": ("save_pct", 20), "ga_avg_5g": ("goals_against", 5), "ga_avg_10g": ("goals_against", 10)},
        seasons={"saves_season": "saves", "shots_against_season": "shots_against"},
        deviations={"sv_pct_stddev_20g": ("save_pct", 20)},
    )
    df = df.withColumn("gp_season", F.count(F.lit(1)).over(season_so_far("player_id"))).withColumn("game_recency_rank", recency("player_id"))
    return df.withColumn("sv_pct_zscore_5v20", zscore(F.col("sv_pct_avg_5g"), F.col("sv_pct_avg_20g"), F.col("sv_pct_stddev_20g")))


def team_rolling_stats(team_games: DataFrame) -> DataFrame:
    """Teams in the regular season, without games that have not been played."""
    df = team_games.filter((F.col("game_type") == 2) & ~F.coalesce(F.col("status"), F.lit("")).isin("FUT", "PRE"))
    df = df.withColumn("win", (F.coalesce("team_points", F.lit(0)) == 2).cast("bigint")).withColumn("loss", (F.coalesce("team_points", F.lit(0)) == 0).cast("bigint"))
    df = rolling(
        df,
        "team_abbr",
        {"pts_avg_5g": ("team_points", 5), "pts_avg_10g": ("team_points", 10), "pts_avg_20g": ("team_points", 20), "gf_avg_10g": ("goals_for", 10), "ga_avg_10g": ("goals_against", 10), "sog_avg_10g": ("sog", 10)},
        sums={"wins_last_5": ("win", 5), "losses_last_5": ("loss", 5)},
        seasons={"pts_cumulative": "team_points", "gf_cumulative": "goals_for", "ga_cumulative": "goals_against"},
        deviations={"pts_stddev_20g": ("team_points", 20)},
    )
    df = df.withColumn("gp_season", F.count(F.lit(1)).over(season_so_far("team_abbr"))).withColumn("game_recency_rank", recency("team_abbr"))
    df = df.withColumn("shooting_pct_game", F.when(F.col("sog") > 0, F.col("goals_for").cast("double") / F.col("sog")))
    return df.withColumn("pts_zscore_5v20", zscore(F.col("pts_avg_5g"), F.col("pts_avg_20g"), F.col("pts_stddev_20g")))


def player_season_timeline(player_games: DataFrame) -> DataFrame:
    """Season totals so far, form, points per game and the rank by points among those who played that day."""
    df = player_games.filter((F.col("position") != "G") & (F.coalesce("toi_seconds", F.lit(0)) > 0))
    sums = ("goals", "assists", "points", "shots", "hits", "plus_minus", "pim", "toi_seconds", "pp_goals", "blocked_shots")
    df = rolling(
        df,
        "player_id",
        {f"{s}_avg_{n}g": (c, n) for n in (5, 10) for s, c in (("pts", "points"), ("goals", "goals"), ("shots", "shots"))},
        seasons={f"{c}_cum": c for c in sums},
        digits=3,
    ).withColumn("gp_cum", F.count(F.lit(1)).over(season_so_far("player_id")))
    day = Window.partitionBy("season", "game_date").orderBy(F.desc("points_cum"))
    return df.withColumn("points_per_game_cum", F.round(F.col("points_cum").cast("double") / F.col("gp_cum"), 3)).withColumn("season_points_rank", F.rank().over(day).cast("bigint"))


def goalie_season_timeline(player_games: DataFrame) -> DataFrame:
    """Season totals so far, with the save share from the totals, and its rank that day."""
    df = player_games.filter((F.col("position") == "G") & (F.coalesce("toi_seconds", F.lit(0)) > 600))
    df = rolling(
        df, "player_id", {"sv_pct_avg_5g": ("save_pct", 5), "sv_pct_avg_10g": ("save_pct", 10)}, seasons={f"{c}_cum": c for c in ("saves", "shots_against", "goals_against", "toi_seconds")}, digits=4
    ).withColumn("gp_cum", F.count(F.lit(1)).over(season_so_far("player_id")))
    df = df.withColumn("save_pct_cum", F.round(F.col("saves_cum").cast("double") / F.nullif(F.col("shots_against_cum"), F.lit(0)), 4))
    df = df.withColumn("gaa_cum", F.round(F.col("goals_against_cum").cast("double") * 3600 / F.nullif(F.col("toi_seconds_cum"), F.lit(0)), 4))
    day = Window.partitionBy("season", "game_date").orderBy(F.desc_nulls_last("save_pct_cum"))
    return df.withColumn("season_sv_pct_rank", F.rank().over(day).cast("bigint"))


def team_season_timeline(team_games: DataFrame) -> DataFrame:
    """Wins, losses, goals and points so far, form, goal difference, power play and the rank that day."""
    points = F.coalesce("team_points", F.lit(0))
    df = team_games.filter(F.col("game_type") == 2).withColumns({k: (points == v).cast("bigint") for k, v in (("win", 2), ("otl", 1), ("loss", 0))})
    df = rolling(
        df,
        "team_abbr",
        {f"{s}_avg_{n}g": (c, n) for n in (5, 10) for s, c in (("pts", "team_points"), ("gf", "goals_for"), ("ga", "goals_against"))},
        sums={"wins_last_5": ("win", 5)},
        seasons={"points_cum": "team_points", "gf_cum": "goals_for", "ga_cum": "goals_against", "shots_cum": "sog", "pp_goals_cum": "pp_goals", "pp_opps_cum": "pp_opps", "wins_cum": "win", "otl_cum": "otl", "losses_cum": "loss"},
        digits=3,
    ).withColumn("gp_cum", F.count(F.lit(1)).over(season_so_far("team_abbr")))
    df = df.withColumn("goal_diff_cum", F.col("gf_cum") - F.col("ga_cum")).withColumn("pp_pct_cum", F.round(F.col("pp_goals_cum").cast("double") / F.nullif(F.col("pp_opps_cum"), F.lit(0)), 4))
    day = Window.partitionBy("season", "game_date").orderBy(F.desc("points_cum"), F.desc("goal_diff_cum"))
    return df.withColumn("season_rank", F.rank().over(day).cast("bigint"))


def latest_per_entity(df: DataFrame, entity: str) -> DataFrame:
    """Each entity's last row by date and game."""
    return df.withColumn("_r", recency(entity)).filter("_r = 1").drop("_r")
