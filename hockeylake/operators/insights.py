"""Anomaly candidates, ranked insights and detectors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hockeylake.functions import goalie_class, insight_id, player_class, severity, team_class
from hockeylake.operators.features import last_n, recency, season_so_far


def _current(df: DataFrame, games: DataFrame) -> DataFrame:
    """Rows of the latest regular season; that season is one row."""
    season = games.filter(F.col("game_type") == 2).agg(F.max("season").alias("_season"))
    return df.join(F.broadcast(season), F.col("season") == F.col("_season")).drop("_season")


def _largest(df: DataFrame, z: str, key: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(F.abs(F.col(z))), key).limit(n)


def player_anomalies(rolling: DataFrame, games: DataFrame, min_games: int = 20, threshold: float = 1.0, n: int = 20) -> DataFrame:
    """Skaters whose last five games lie furthest from their last twenty."""
    z = F.abs("pts_zscore_5v20")
    named = F.col("player_first_name").isNotNull() & F.col("player_last_name").isNotNull()
    return _largest(_current(rolling.filter((F.col("game_recency_rank") == 1) & (F.col("gp_season") >= min_games) & (z >= threshold) & named), games), "pts_zscore_5v20", "player_id", n)


def goalie_anomalies(rolling: DataFrame, games: DataFrame, min_games: int = 10, threshold: float = 1.0, n: int = 10) -> DataFrame:
    z = F.abs("sv_pct_zscore_5v20")
    named = F.col("player_first_name").isNotNull() & F.col("player_last_name").isNotNull()
    return _largest(_current(rolling.filter((F.col("game_recency_rank") == 1) & (F.col("gp_season") >= min_games) & (z >= threshold) & named), games), "sv_pct_zscore_5v20", "player_id", n)


def team_anomalies(rolling: DataFrame, games: DataFrame, min_games: int = 20, threshold: float = 1.0, n: int = 10) -> DataFrame:
    z = F.abs("pts_zscore_5v20")
    return _largest(_current(rolling.filter((F.col("game_recency_rank") == 1) & (F.col("gp_season") >= min_games) & (z >= threshold)), games), "pts_zscore_5v20", "team_abbr", n)


def corsi_outliers(corsi: DataFrame, days: int = 20, least: int = 5, low: float = 0.42, high: float = 0.58) -> DataFrame:
    """Teams whose mean share of shot attempts in the days up to their last game is out of range."""
    played = corsi.filter((F.col("game_type") == 2) & F.col("corsi_pct").isNotNull())
    latest = played.groupBy("team_abbr").agg(F.max("game_date").alias("latest"))
    recent = played.join(latest, "team_abbr").filter(F.col("game_date") >= F.date_sub("latest", days))
    mean = recent.groupBy("team_abbr").agg(F.round(F.avg("corsi_pct"), 6).alias("corsi_pct_avg"), F.count("*").alias("n")).filter(F.col("n") >= least)
    return mean.filter((F.col("corsi_pct_avg") < low) | (F.col("corsi_pct_avg") > high))


def _as_insights(df: DataFrame, kind: str, entity: str, name: Column, z: str, classify, context: Column) -> DataFrame:
    day = F.col("game_date").cast("string")
    what = classify(F.col(z))
    return df.select(
        insight_id(F.lit(kind), F.col(entity).cast("string"), what, day).alias("insight_id"),
        what.alias("insight_type"),
        F.lit(kind).alias("entity_type"),
        F.col(entity).cast("string").alias("entity_id"),
        name.alias("entity_name"),
        "team_abbr",
        severity(F.col(z)).alias("severity"),
        F.round(z, 3).alias("zscore"),
        F.col("season").cast("string").alias("season"),
        day.alias("game_date"),
        context.alias("prompt_context"),
    )


def _side_of(z: str) -> Column:
    return F.when(F.col(z) > 0, "above").otherwise("below")


def possession_insights(corsi: DataFrame, as_of: str) -> DataFrame:
    """Teams of ``corsi_outliers`` as insights dated ``as_of``; their distance from an even share, in steps of 0.04, stands for the z-score."""
    share, day = F.col("corsi_pct_avg"), F.lit(as_of)
    z = (share - 0.5) / 0.04
    edge = F.when(share > 0.5, "strong possession edge").otherwise("possession concerns")
    # Fixed text.
    text = F.format_string("%s has a 10-game Corsi%% of %.3f (%d games analyzed) \u2013 %s. Corsi%% below 0.42 or above 0.58 is a statistically significant outlier.", "team_abbr", F.round(share, 3), "n", edge)
    kind = F.lit("possession_edge")
    return corsi.select(
        insight_id(F.lit("team"), F.col("team_abbr"), kind, day).alias("insight_id"), kind.alias("insight_type"), F.lit("team").alias("entity_type"), F.col("team_abbr").alias("entity_id"), F.col("team_abbr").alias("entity_name"), "team_abbr",
        severity(z).alias("severity"), F.round(z, 3).alias("zscore"), F.substring(day, 1, 4).alias("season"), day.alias("game_date"), text.alias("prompt_context"),
    )


#: The columns of the table of insights.
COLUMNS = ("insight_id", "generated_at", "insight_type", "entity_type", "entity_id", "entity_name", "team_abbr", "severity", "zscore", "season", "game_date", "headline", "body", "prompt_context")


def insight_table(found: DataFrame, generated_at: str) -> DataFrame:
    """Insights as rows of their table; headline and body are null until a writer has made them."""
    none = F.lit(None).cast("string")
    return found.withColumns({"generated_at": F.lit(generated_at).cast("timestamp"), "game_date": F.col("game_date").cast("date"), "headline": none, "body": none}).select(*COLUMNS)


def insights(players: DataFrame, goalies: DataFrame, teams: DataFrame, corsi: DataFrame | None = None, as_of: str | None = None) -> DataFrame:
    """Candidates as insights with class, severity, id and a text for a writer; with ``corsi`` the outliers of possession too, dated ``as_of``.

    The texts are fixed values.
    """
    full = F.concat_ws(" ", "player_first_name", "player_last_name")
    p, s, t = "pts_zscore_5v20", "sv_pct_zscore_5v20", "pts_zscore_5v20"
    player_text = F.format_string(
        "%s (%s, %s) is averaging %.2f pts/game over the last 5 games, vs their 20-game baseline of %.2f pts/game (z-score: %+.2f, %s baseline). Season totals: %d pts in %d games. Most recent game: %s.",
        full, "team_abbr", "position", "pts_avg_5g", "pts_avg_20g", p, _side_of(p), "pts_season", "gp_season", F.col("game_date").cast("string"),
    )
    goalie_text = F.format_string(
        "Goalie %s (%s) has a 5-game save%% of %.3f, vs 20-game baseline of %.3f (z-score: %+.2f, %s baseline). Games played this season: %d. Most recent game: %s.",
        full, "team_abbr", "sv_pct_avg_5g", "sv_pct_avg_20g", s, _side_of(s), "gp_season", F.col("game_date").cast("string"),
    )
    team_text = F.format_string(
        "%s is averaging %.2f pts/game over the last 5 games (%dW-%dL), vs 20-game baseline of %.2f (z-score: %+.2f, %s baseline). Season: %d pts in %d GP. 10-game avg GF/GA: %.2f/%.2f. Last game: %s.",
        "team_abbr", "pts_avg_5g", "wins_last_5", "losses_last_5", "pts_avg_20g", t, _side_of(t), "pts_cumulative", "gp_season", "gf_avg_10g", "ga_avg_10g", F.col("game_date").cast("string"),
    )
    parts = [
        _as_insights(players, "player", "player_id", full, p, player_class, player_text),
        _as_insights(goalies, "player", "player_id", full, s, goalie_class, goalie_text),
        _as_insights(teams, "team", "team_abbr", F.col("team_abbr"), t, team_class, team_text),
    ]
    if corsi is not None:
        if as_of is None:
            raise ValueError("insights on possession need a date")
        parts.append(possession_insights(corsi, as_of))
    return reduce(DataFrame.unionByName, parts)


def most_severe(df: DataFrame, n: int) -> DataFrame:
    """The n insights of greatest severity, in ties by id; null severities come last."""
    return df.orderBy(F.desc("severity"), "insight_id").limit(n)


def without_repeats(df: DataFrame, days: int) -> DataFrame:
    """Drops an insight that the same entity has again, of the same type, within so many days."""
    w = Window.partitionBy("entity_type", "entity_id", "insight_type").orderBy("game_date", "game_id")
    following = F.lead("game_date").over(w)
    return df.withColumn("_next", following).filter(F.col("_next").isNull() | (F.datediff("_next", "game_date") > days)).drop("_next")


def islands(df: DataFrame, days: int) -> DataFrame:
    """Chains of an entity's insights of one type, each within so many days of the one before, as one row: its latest insight with ``first_date``, ``n_repeats`` and the chain's greatest ``severity``.

    Insights of equal date go by game. A null date begins a chain of its own kind, before all others.
    """
    key = ["entity_type", "entity_id", "insight_type"]
    w = Window.partitionBy(*key).orderBy("game_date", "game_id")
    begins = F.coalesce(F.datediff("game_date", F.lag("game_date").over(w)) > days, F.lit(True))
    df = df.withColumn("_begins", begins.cast("int")).withColumn("_chain", F.sum("_begins").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rest = [c for c in df.columns if c not in (*key, "severity", "_begins", "_chain")]
    last = F.max_by(F.struct(*rest), F.struct("game_date", "game_id"))
    chains = df.groupBy(*key, "_chain").agg(last.alias("last"), F.min("game_date").alias("first_date"), (F.count("*") - 1).alias("n_repeats"), F.max("severity").alias("severity"))
    return chains.select(*key, "last.*", "severity", "first_date", "n_repeats")


def ranked(df: DataFrame, n: int, run: list[str]) -> DataFrame:
    """The ``n`` most significant insights of each run, with their ``rank``: by severity, then the longer chain, then entity, type and date."""
    order = (F.desc("severity"), F.desc("n_repeats"), "entity_type", "entity_id", "insight_type", "game_date", "game_id")
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*run).orderBy(*order)).cast("bigint")).filter(F.col("rank") <= n)


def _since(games: DataFrame, days: int, as_of: str | None) -> DataFrame:
    """Games of the days up to a date, that of the last game if none is given; the date is a scalar that reaches the scan."""
    last = F.lit(as_of).cast("date") if as_of else games.agg(F.max("game_date").cast("date")).scalar()
    return games.filter(F.col("game_date").between(F.date_sub(last, days), last))


def team_streak(team_games: DataFrame, n: int = 5, least: float = 1.6, min_games: int = 3, days: int = 90, as_of: str | None = None) -> DataFrame:
    """Teams whose mean points of the last n games, of those of the last ``days``, exceed a bound."""
    w = last_n("team_abbr", n)
    df = _since(team_games, days, as_of).filter(F.col("game_type") == 2).select("team_abbr", "game_id", "game_date", F.avg(F.coalesce("team_points", F.lit(0))).over(w).alias("pts_avg_5g"), F.count("*").over(w).alias("n"), recency("team_abbr").alias("_r"))
    return df.filter((F.col("_r") == 1) & (F.col("n") >= min_games) & (F.col("pts_avg_5g") > least)).drop("_r")


def player_breakout(player_games: DataFrame, times: float = 2.0, min_games: int = 3) -> DataFrame:
    """Skaters whose last five games reach a multiple of their season."""
    s = season_so_far("player_id")
    df = player_games.filter((F.col("position") != "G") & (F.col("toi_seconds") > 0)).select(
        "player_id", "game_id", "game_date", "season", F.avg("points").over(last_n("player_id", 5)).alias("pts_avg_5g"), F.avg("points").over(s).alias("season_avg"), F.count("*").over(s).alias("n"), recency("player_id").alias("_r")
    )
    return df.filter((F.col("_r") == 1) & (F.col("n") >= min_games) & (F.col("season_avg") > 0) & (F.col("pts_avg_5g") >= times * F.col("season_avg"))).drop("_r")


def goalie_trend(player_games: DataFrame, n: int = 3, least: float = 0.92, days: int = 30, as_of: str | None = None) -> DataFrame:
    """Goalies whose mean save share of the last n games, of those of the last ``days``, exceeds a bound."""
    w = last_n("player_id", n)
    df = _since(player_games, days, as_of).filter((F.col("position") == "G") & (F.col("toi_seconds") > 600)).select("player_id", "game_id", "game_date", F.avg("save_pct").over(w).alias("sv_pct_avg_3g"), F.count("*").over(w).alias("_n"), recency("player_id").alias("_r"))
    return df.filter((F.col("_r") == 1) & (F.col("_n") >= n) & (F.col("sv_pct_avg_3g") > least)).drop("_r", "_n")


#: Detectors by name: the function and the columns that it needs.
DETECTORS = {
    "team_streak": (team_streak, {"team_abbr", "game_id", "game_date", "game_type", "team_points"}),
    "player_breakout": (player_breakout, {"player_id", "game_id", "game_date", "season", "position", "toi_seconds", "points"}),
    "goalie_trend": (goalie_trend, {"player_id", "game_id", "game_date", "position", "toi_seconds", "save_pct"}),
}


def detect(name: str, df: DataFrame, league: str | None = None, overrides: dict[str, dict] | None = None) -> DataFrame:
    """Run a detector with a league's own settings; raises if a column is missing."""
    function, columns = DETECTORS[name]
    if missing := columns - set(df.columns):
        raise ValueError(f"{name} needs {sorted(missing)}")
    return function(df, **(overrides or {}).get(league or "", {}))
