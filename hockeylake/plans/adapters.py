"""Hockey-shaped views over the star-schema tables, by whole-number arithmetic that Spark and ANSI SQL share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: View -> SQL over other views and the tables; in an order in which each uses earlier ones alone.
VIEWS = {
    "games": """
SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date, CAST(year(o_orderdate) * 10000 + year(o_orderdate) + 1 AS BIGINT) AS season,
  CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 3 ELSE 2 END AS BIGINT) AS game_type,
  CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 'FUT' WHEN o_orderkey % 8 = 0 THEN 'Final OT' WHEN o_orderkey % 8 = 1 THEN 'Final SO' ELSE 'Final' END AS status,
  CASE WHEN o_orderkey % 8 = 0 THEN 'OT' WHEN o_orderkey % 8 = 1 THEN 'SO' ELSE 'REG' END AS last_period_type,
  CAST(o_custkey % 32 AS BIGINT) AS home_team_id, CAST((o_custkey % 32 + 1 + o_orderkey % 31) % 32 AS BIGINT) AS away_team_id,
  CAST((o_orderkey * 7 + o_custkey) % 6 AS BIGINT) AS home_score, CAST((o_orderkey * 5 + o_custkey * 3) % 6 AS BIGINT) AS away_score,
  CAST(20 + (o_orderkey * 11 + o_custkey) % 20 AS BIGINT) AS home_sog, CAST(20 + (o_orderkey * 13 + o_custkey) % 20 AS BIGINT) AS away_sog,
  CAST((o_orderkey + o_custkey) % 3 AS BIGINT) AS home_pp_goals, CAST((o_orderkey + 2 * o_custkey) % 3 AS BIGINT) AS away_pp_goals,
  CAST(2 + (o_orderkey * 3 + o_custkey) % 4 AS BIGINT) AS home_pp_opps, CAST(2 + (o_orderkey * 5 + o_custkey) % 4 AS BIGINT) AS away_pp_opps,
  CAST((o_orderkey * 3 + o_custkey) % 15 AS BIGINT) AS home_pim, CAST((o_orderkey * 7 + o_custkey * 2) % 15 AS BIGINT) AS away_pim
FROM orders""",
    "game_players": """
SELECT l_orderkey AS game_id, l_partkey AS player_id, CASE WHEN l_partkey % 10 = 0 THEN 'G' WHEN l_partkey % 10 < 4 THEN 'D' ELSE 'F' END AS position,
  CAST(SUM(l_linenumber % 3) AS BIGINT) AS goals, CAST(SUM((l_linenumber + l_partkey) % 3) AS BIGINT) AS assists,
  CAST(SUM(l_linenumber % 3) + SUM((l_linenumber + l_partkey) % 3) AS BIGINT) AS points, CAST(SUM(1 + (l_linenumber + l_suppkey) % 6) AS BIGINT) AS shots,
  CAST(SUM(CAST(l_quantity AS BIGINT)) * 60 AS BIGINT) AS toi_seconds, CAST(SUM((l_suppkey + l_linenumber) % 5) AS BIGINT) AS hits,
  CAST(SUM((l_suppkey + l_partkey) % 5) - 2 AS BIGINT) AS plus_minus, CAST(SUM((l_suppkey * 3 + l_linenumber) % 4) AS BIGINT) AS pim,
  CAST(SUM((l_suppkey + l_linenumber) % 2) AS BIGINT) AS pp_goals, CAST(SUM((l_suppkey + l_linenumber) % 4) AS BIGINT) AS blocked_shots,
  CAST(20 + SUM(CAST(l_quantity AS BIGINT)) % 20 AS BIGINT) AS shots_against, CAST(20 + SUM(CAST(l_quantity AS BIGINT)) % 20 - SUM((l_linenumber + l_suppkey) % 5) AS BIGINT) AS saves,
  CAST(SUM((l_linenumber + l_suppkey) % 5) AS BIGINT) AS goals_against, MIN(l_suppkey) % 2 = 0 AS is_home
FROM lineitem GROUP BY l_orderkey, l_partkey""",
    "players": """
SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END AS name FROM part""",
    "teams": """
SELECT CAST(n_nationkey AS BIGINT) AS team_id, 'T' || CAST(n_nationkey AS VARCHAR(9)) AS abbr, n_name AS team_name, r_name AS conference, CAST(n_nationkey % 4 AS BIGINT) AS division
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "game_events": """
SELECT l_orderkey AS game_id, l_linenumber AS event_no, l_partkey AS player_id, CAST(l_shipdate AS DATE) AS event_date,
  CASE l_linenumber % 7 WHEN 0 THEN 'GOAL' WHEN 1 THEN 'SHOT' WHEN 2 THEN 'MISSED_SHOT' WHEN 3 THEN 'BLOCKED_SHOT' WHEN 4 THEN 'HIT' WHEN 5 THEN 'FACEOFF' ELSE 'PENALTY' END AS event_type,
  l_suppkey % 2 = 0 AS by_home, CAST(1 + l_linenumber % 4 AS BIGINT) AS period
FROM lineitem""",
    "raw_team_games": """
SELECT CAST(o_orderkey AS VARCHAR(20)) AS game_uuid, CAST(year(o_orderdate) AS VARCHAR(4)) AS season_name, CASE WHEN o_orderkey % 5 = 0 THEN 'Playoff' ELSE 'Regular' END AS game_type_name,
  'L' || CAST(o_custkey % 14 AS VARCHAR(9)) AS lag, CAST(o_orderkey % 7 AS VARCHAR(9)) AS egna_mal, CAST((o_orderkey + o_custkey) % 7 AS VARCHAR(9)) AS inslappta_mal,
  CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE '0' END AS vann, CASE WHEN o_orderkey % 6 < 1 THEN '1' ELSE '0' END AS overtime, CASE WHEN o_orderkey % 9 < 1 THEN '1' ELSE '0' END AS shootout
FROM orders""",
    "raw_player_games": """
SELECT CAST(l_orderkey AS VARCHAR(20)) AS game_uuid, CAST(l_linenumber AS BIGINT) AS row_no, CAST(l_partkey AS VARCHAR(20)) AS spelare, CAST(l_linenumber % 4 AS VARCHAR(9)) AS poang,
  CAST(l_suppkey % 6 AS VARCHAR(9)) AS sog, CAST(CASE WHEN l_suppkey % 11 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) * 60 END AS VARCHAR(9)) AS toi_seconds,
  CAST(CAST(l_quantity AS BIGINT) * 2 AS VARCHAR(9)) AS raddningsprocent, CAST(l_linenumber % 5 AS VARCHAR(9)) AS inslappta_mal
FROM lineitem""",
}


def needed(*names: str) -> list[str]:
    """The views and those they use."""
    found: list[str] = []
    for name in VIEWS:
        if name in names:
            found.append(name)
    return found


def cte(*names: str) -> str:
    """The views as common table expressions, for a statement that goes on with a comma or SELECT."""
    return ", ".join(f"{n} AS ({VIEWS[n]})" for n in needed(*names))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_USES = {"games": ["orders"], "game_players": ["lineitem"], "players": ["part"], "teams": ["nation", "region"], "game_events": ["lineitem"], "raw_team_games": ["orders"], "raw_player_games": ["lineitem"]}


def view(spark: SparkSession, sf_dir: str, name: str, **given: DataFrame) -> DataFrame:
    """One of the hockey-shaped views as a DataFrame; tables that are given, all their rows dealt otherwise, are not read again."""
    text = VIEWS[name]
    frames = {t: given[t] if t in given else table(spark, sf_dir, t) for t in _USES[name]}
    for t in frames:
        for word in ("FROM", "JOIN"):
            text = text.replace(f"{word} {t}", f"{word} {{{t}}}")
    return spark.sql(text, **frames)


#: Games whose texts one task makes and sorts at most.
GAMES_A_TASK = 50_000


def spread_games(spark, d, games_a_task: int = GAMES_A_TASK):
    """The games dealt by their id over several tasks a core, and over more where there are many, before texts are made of them: few bytes of games make much text, so that splits of the table by size leave most cores idle. What groups or orders by game needs no further shuffle."""
    n = table(spark, d, "orders").count()  # from the footers of its files
    return view(spark, d, "games").repartition(max(4 * spark.sparkContext.defaultParallelism, -(-n // games_a_task)), "game_id")
