"""Queries over incremental selection, sources, write modes, joins and data quality."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import functions as F

from hockeylake.operators import gold, quality, writes
from hockeylake.plans.adapters import cte, table, view
from hockeylake.plans.gold_queries import player_games
from hockeylake.plans.registry import query
from hockeylake.sources import files, incremental

_G = cte("games")


def scratch(spark, name: str) -> str:
    """A new path in the folder that all executors see, ``spark.checkpoint.dir``; where that is unset a temporary one on a local master, on a cluster this raises."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="hockeylake-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def games(spark, d):
    return view(spark, d, "games")


def _control(spark, d):
    """The last date of the first five years, as a run up to then would have left it."""
    return games(spark, d).filter("game_date < '2000-01-01'").agg(F.max("game_date").cast("string").alias("value"))


_ID = ["game_id", "game_date"]


@query(f"WITH {_G} SELECT game_id, game_date FROM games WHERE game_date > (SELECT max(game_date) FROM games WHERE game_date < '2000-01-01')")
def inc_after_watermark(spark, d):
    return incremental.after_watermark(games(spark, d), _control(spark, d)).select(_ID)


@query(f"WITH {_G} SELECT game_id, game_date FROM games WHERE game_date >= '1998-01-01'")
def inc_start_floor(spark, d):
    return incremental.from_start(games(spark, d), "1998-01-01").select(_ID)


@query(f"WITH {_G} SELECT game_id, game_date FROM games WHERE year(game_date) = 1997 AND game_date > '1997-06-30'")
def inc_year_scope(spark, d):
    return incremental.year_scope(games(spark, d), 1997, "1997-06-30").select(_ID)


@query(f"WITH {_G} SELECT game_id, game_date FROM games WHERE year(game_date) = 1997")
def inc_force_refresh(spark, d):
    return incremental.year_scope(games(spark, d), 1997, "1997-06-30", force=True).select(_ID)


_BATCHES = "SELECT game_date, CAST(floor((dense_rank() OVER (ORDER BY game_date) - 1) / 30) AS BIGINT) AS batch_no FROM (SELECT DISTINCT game_date FROM games)"


@query(f"WITH {_G} {_BATCHES}")
def inc_date_batches(spark, d):
    return incremental.date_batches(games(spark, d), 30)


@query(f"WITH {_G}, b AS ({_BATCHES}) SELECT game_id, game_date FROM games JOIN b USING (game_date) WHERE batch_no = 0")
def inc_first_batch(spark, d):
    return incremental.first_batch(games(spark, d), 30).select(_ID)


@query(f"WITH {_G} SELECT game_id, game_date FROM games WHERE game_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity < 25)")
def inc_unprocessed_ids(spark, d):
    done = table(spark, d, "lineitem").filter("l_quantity < 25").select(F.col("l_orderkey").alias("game_id"))
    return incremental.unprocessed(games(spark, d), done, "game_id").select(_ID)


@query(f"WITH {_G} SELECT game_id, game_date FROM games WHERE status <> 'FUT' AND game_id NOT IN (SELECT l_orderkey FROM lineitem)")
def inc_unknown_matches(spark, d):
    known = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("game_id"))
    return incremental.unknown_matches(games(spark, d).withColumn("result", F.when(F.col("status") != "FUT", "x")), known, "game_id", "result").select(_ID)


@query(f"WITH {_G} SELECT CAST(x AS DATE) AS game_date FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS x) WHERE CAST(x AS DATE) NOT IN (SELECT game_date FROM games WHERE game_type = 3)")
def inc_missing_dates(spark, d):
    return incremental.missing_dates(spark, "1995-01-01", "2001-12-31", games(spark, d).filter("game_type = 3"))


@query(f"WITH {_G} SELECT game_date, count(*) AS found, count(*) FILTER (game_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1)) AS new FROM games WHERE status <> 'FUT' GROUP BY game_date")
def inc_pending_details(spark, d):
    done = table(spark, d, "lineitem").filter("l_linenumber = 1").select(F.col("l_orderkey").alias("game_id"))
    return incremental.pending_details(games(spark, d).withColumn("result", F.when(F.col("status") != "FUT", "x")), done, "game_id", "result")


@query(f"WITH {_G} SELECT year(game_date) AS year, count(*) AS n_rows, count(DISTINCT game_date) AS n_dates, count(*) FILTER (game_date > '1998-05-05') AS rows_after, count(DISTINCT CASE WHEN game_date > '1998-05-05' THEN game_date END) AS dates_after FROM games GROUP BY 1")
def inc_scope_report(spark, d):
    return incremental.scope_report(games(spark, d), "1998-05-05")


_DOCS = "to_json(struct(game_id, game_date, home_score, status))"


def _written_documents(spark, d, payload):
    """One document a game, as text files by the first day of its month."""
    path = scratch(spark, "documents")
    docs = games(spark, d).select(F.trunc("game_date", "month").alias("game_date"), F.expr(_DOCS).alias("doc"), "game_id")
    docs.select("game_date", payload.alias("value")).hint("rebalance", F.col("game_date")).write.partitionBy("game_date").text(path)
    return path


@query(f"WITH {_G} SELECT CAST(date_trunc('month', game_date) AS DATE) AS game_date, count(*) AS n, CAST(sum(home_score) AS BIGINT) AS goals FROM games GROUP BY 1")
def src_game_documents(spark, d):
    path = _written_documents(spark, d, F.col("doc"))
    docs = files.read_documents(spark, path, "*.txt")
    lines = docs.select(F.col("game_date").cast("date").alias("game_date"), F.explode(F.split("payload", "\n")).alias("l")).filter("l != ''")
    return lines.groupBy("game_date").agg(F.count("*").alias("n"), F.sum(F.try_variant_get(F.try_parse_json("l"), "$.home_score", "bigint")).alias("goals"))


@query(f"WITH {_G} SELECT game_id % 7 = 0 AS rejected, count(*) AS n FROM games GROUP BY 1")
def src_json_rejects(spark, d):
    docs = games(spark, d).select(F.col("game_id").cast("string").alias("key"), F.when(F.col("game_id") % 7 == 0, F.expr(f"substr({_DOCS}, 1, 9)")).otherwise(F.expr(_DOCS)).alias("payload"))
    good, bad = files.split_rejects(docs)
    return good.agg(F.count("*").alias("n")).select(F.lit(False).alias("rejected"), "n").unionByName(bad.agg(F.count("*").alias("n")).select(F.lit(True).alias("rejected"), "n"))


@query("SELECT l_orderkey AS game_id, max(l_suppkey) AS details, CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderstatus ELSE o_orderpriority END AS league_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL")
def src_index_detail_join(spark, d):
    index = table(spark, d, "orders").groupBy(F.col("o_orderdate").alias("game_date")).agg(F.collect_list(F.struct(F.col("o_orderkey").alias("game_id"), F.col("o_orderstatus").alias("league_id"))).alias("games"))
    details = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("game_id")).agg(F.max("l_suppkey").alias("details"))
    league = table(spark, d, "orders").select(F.col("o_orderkey").alias("game_id"), F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(F.col("o_orderpriority")).alias("league_id"))
    return files.with_details(files.index_games(index), details.join(league, "game_id")).select("game_id", "details", "league_id")


_REPORT = "'reports/' || CAST(l_orderkey AS VARCHAR(20)) || '/' || CASE l_linenumber % 4 WHEN 0 THEN 'line_up' WHEN 1 THEN 'team_roster' WHEN 2 THEN 'media_summary' ELSE 'cover' END || '_' || CAST(l_suppkey AS VARCHAR(9)) || '.pdf'"


@query(f"SELECT l_orderkey AS game_id, CASE l_linenumber % 4 WHEN 0 THEN 'line_up' WHEN 1 THEN 'team_roster' ELSE 'media_summary' END AS report_type, max({_REPORT}) AS path FROM lineitem WHERE l_linenumber % 4 < 3 GROUP BY ALL")
def src_report_catalog(spark, d):
    return files.report_catalog(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("game_id"), F.expr(_REPORT).alias("path")))


@query("SELECT prefix, CAST(level AS BIGINT) AS level, count(*) AS n FROM (SELECT 'reports' AS prefix, 1 AS level FROM lineitem UNION ALL SELECT 'reports/' || l_orderkey, 2 FROM lineitem) GROUP BY ALL")
def path_prefix_counts(spark, d):
    return files.prefix_counts(table(spark, d, "lineitem").select(F.expr(_REPORT).alias("path")))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus AS s, NULL AS extra FROM orders UNION ALL SELECT c_name, NULL, CAST(c_nationkey AS BIGINT) FROM customer")
def src_union_by_name(spark, d):
    a = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    b = table(spark, d, "customer").select(F.col("c_name").alias("k"), F.col("c_nationkey").cast("bigint").alias("extra"))
    return files.union_by_name([a, b])


@query(f"WITH {_G} SELECT home_team_id, season, game_id, game_date FROM (SELECT *, row_number() OVER (PARTITION BY home_team_id, season ORDER BY game_date, game_id) AS r FROM games) WHERE r = 1")
def src_dedup_scan(spark, d):
    return files.latest_by_key(games(spark, d), ["home_team_id", "season"], "game_date", "game_id").select("home_team_id", "season", "game_id", "game_date")


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS c_mktsegment FROM customer")
def src_csv_strings(spark, d):
    path = scratch(spark, "csv")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    writes.write_csv(c, path)
    return files.read_csv_strings(spark, path)





@query(f"WITH {_G} SELECT game_id, CAST(season AS VARCHAR) AS season, CASE WHEN season >= 19992000 THEN home_score + 100 ELSE home_score END AS home_score FROM games")
def snk_dynamic_overwrite(spark, d):
    path = scratch(spark, "partitions")
    g = games(spark, d).select("game_id", "season", "home_score")
    writes.overwrite_partitions(g, path, "season")
    for _ in range(2):  # a second run changes nothing
        writes.overwrite_partitions(g.filter("season >= 19992000").withColumn("home_score", F.col("home_score") + 100), path, "season")
    return spark.read.option("basePath", path).schema("game_id long, home_score long, season string").parquet(path)


@query(f"WITH {_G} SELECT game_id, season, home_score FROM games WHERE season >= 19992000")
def snk_full_overwrite(spark, d):
    path = scratch(spark, "full")
    g = games(spark, d).select("game_id", "season", "home_score")
    writes.overwrite_table(g, path, "season")
    writes.overwrite_table(g.filter("season >= 19992000"), path, "season")
    return spark.read.schema("game_id long, home_score long, season long").parquet(path)


@query("SELECT c_custkey, CASE WHEN c_nationkey % 5 = 0 THEN 'unknown' ELSE CAST(c_nationkey AS VARCHAR) END AS part FROM customer")
def snk_null_partition(spark, d):
    path = scratch(spark, "nulls")
    writes.overwrite_partitions(table(spark, d, "customer").select("c_custkey", F.when(F.col("c_nationkey") % 5 > 0, F.col("c_nationkey")).alias("part")), path, "part")
    return spark.read.schema("c_custkey long, part string").parquet(path)


@query("""SELECT c_custkey, '{"n":"' || c_name || '","k":' || c_nationkey || '}' AS s, '[' || c_custkey || ',' || c_nationkey || ']' AS a FROM customer""")
def stringify_nested(spark, d):
    return writes.stringify_nested(table(spark, d, "customer").select("c_custkey", F.struct(F.col("c_name").alias("n"), F.col("c_nationkey").alias("k")).alias("s"), F.array(F.col("c_custkey"), F.col("c_nationkey").cast("bigint")).alias("a")))


@query("SELECT c_name, TRY_CAST(c_custkey AS VARCHAR) AS c_custkey, NULL AS missing FROM customer")
def conform_schema(spark, d):
    return writes.conform(table(spark, d, "customer"), "c_name string, c_custkey string, missing bigint")


def _target_source(spark, d):
    """Odd keys up to the middle are known; the source has every third customer with other balances."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", F.floor("c_acctbal").alias("bal"))
    return c.filter("c_custkey % 2 = 1"), c.filter("c_custkey % 3 = 0").withColumn("bal", F.lit(-1).cast("bigint")).withColumn("extra", F.lit(1))


_TARGET = "t AS (SELECT c_custkey, c_nationkey, CAST(floor(c_acctbal) AS BIGINT) AS bal FROM customer WHERE c_custkey % 2 = 1), s AS (SELECT c_custkey, c_nationkey, CAST(-1 AS BIGINT) AS bal FROM customer WHERE c_custkey % 3 = 0)"


@query(f"WITH {_TARGET} SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.c_custkey = s.c_custkey)")
def upsert_insert_only(spark, d):
    return writes.upsert_insert_only(*_target_source(spark, d), ["c_custkey"])


@query(f"WITH {_TARGET} SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE t.c_custkey = s.c_custkey) UNION ALL SELECT * FROM s")
def upsert_delete_insert(spark, d):
    return writes.upsert_delete_insert(*_target_source(spark, d), ["c_custkey"])


@query(f"WITH {_TARGET} SELECT * FROM t WHERE c_nationkey NOT IN (SELECT c_nationkey FROM s WHERE c_nationkey % 4 = 0) UNION ALL SELECT * FROM s WHERE c_nationkey % 4 = 0")
def upsert_by_parent(spark, d):
    t, s = _target_source(spark, d)
    return writes.upsert_by_parent(t, s.filter("c_nationkey % 4 = 0"), "c_nationkey")


_INS = "SELECT md5(CAST(o_custkey % 700 AS VARCHAR(20)) || CAST(o_orderkey % 3 AS VARCHAR(20))) AS insight_id, CAST(o_custkey % 700 AS VARCHAR(20)) AS entity_id, CAST(o_orderdate AS DATE) AS game_date, 'player' AS entity_type, o_orderkey AS k FROM {t}"


@query(
    f"""WITH i AS ({_INS.format(t='orders')}), t AS (SELECT * FROM i WHERE k % 50 = 0), s AS (SELECT * FROM i WHERE k % 50 > 0),
a AS (SELECT *, row_number() OVER (PARTITION BY insight_id ORDER BY k) AS r FROM s), b AS (SELECT *, row_number() OVER (PARTITION BY entity_id, game_date, entity_type ORDER BY insight_id) AS q FROM a WHERE r = 1)
SELECT insight_id, entity_type FROM t UNION ALL SELECT insight_id, entity_type FROM b WHERE q = 1 AND insight_id NOT IN (SELECT insight_id FROM t) AND NOT EXISTS (SELECT 1 FROM t WHERE t.entity_id = b.entity_id AND t.game_date = b.game_date AND t.entity_type = b.entity_type)"""
)
def upsert_insights(spark, d):
    i = spark.sql(_INS.replace("{t}", "{orders}"), orders=table(spark, d, "orders"))
    s = writes.keep_first_by_source(i.filter("k % 50 > 0"), ["insight_id"], "k")
    return writes.upsert_insights(i.filter("k % 50 = 0"), s).select("insight_id", "entity_type")


@query("SELECT l_orderkey, l_partkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber, l_suppkey) AS r FROM lineitem) WHERE r = 1")
def dedup_keep_first(spark, d):
    return gold.keep_first(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"], ["l_linenumber", "l_suppkey"]).select("l_orderkey", "l_partkey", "l_linenumber")


@query("SELECT p_partkey AS player_id, split_part(p_name, ' ', 1) AS player_first_name, substr(p_name, length(split_part(p_name, ' ', 1)) + 2) AS player_last_name FROM part WHERE p_partkey % 7 > 0")
def name_lookup(spark, d):
    return gold.name_lookup(view(spark, d, "players"))


@query(f"WITH {_G} SELECT DISTINCT season FROM games")
def distinct_seasons(spark, d):
    return games(spark, d).select("season").distinct()


@query(f"WITH {cte('games', 'game_players', 'players', 'teams')} SELECT 'games' AS table_name, count(*) AS n FROM games UNION ALL SELECT 'game_players', count(*) FROM game_players UNION ALL SELECT 'teams', count(*) FROM teams")
def table_counts(spark, d):
    return quality.table_counts({n: view(spark, d, n) for n in ("games", "game_players", "teams")})


@query(f"WITH {_G} SELECT count(*) AS n_rows, min(game_date) AS first_day, max(game_date) AS last_day, count(DISTINCT season) AS n_season, count(DISTINCT home_team_id) AS n_home_team_id FROM games")
def profile_games(spark, d):
    return quality.profile(games(spark, d), "game_date", ["season", "home_team_id"])


@query(f"WITH {cte('game_players')} SELECT CAST(sum(CASE WHEN position = 'G' THEN 1 ELSE 0 END) AS BIGINT) AS goalies, CAST(sum(CASE WHEN position = 'D' THEN 1 ELSE 0 END) AS BIGINT) AS defenders, CAST(sum(CASE WHEN position = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS forwards, count(DISTINCT player_id) AS players FROM game_players")
def profile_roles(spark, d):
    return quality.role_counts(view(spark, d, "game_players"))


@query("SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dq_duplicate_keys(spark, d):
    return quality.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"])


@query("SELECT 'lineitem' AS \"check\", count(*) AS repeated, CASE WHEN count(*) = 0 THEN 'OK' ELSE 'FAIL' END AS status FROM (SELECT l_orderkey, l_partkey FROM lineitem GROUP BY ALL HAVING count(*) > 1)")
def dq_unique_status(spark, d):
    return quality.unique_status(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"], "lineitem")


@query("SELECT count(*) AS parents, count(k) AS covered, round(count(k) * 100.0 / count(*), 4) AS pct, CASE WHEN round(count(k) * 100.0 / count(*), 4) >= 99 THEN 'OK' ELSE 'FAIL' END AS status FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) ON k = o_orderkey")
def dq_ref_coverage(spark, d):
    return quality.reference_coverage(table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")), "k")


@query(
    f"""WITH {cte('games', 'game_players', 'players')}, p AS (SELECT gp.*, p.name FROM game_players gp LEFT JOIN players p ON p.id = player_id JOIN games USING (game_id))
SELECT 'name' AS "column", count(name) AS present, count(*) AS total, round(count(name) * 100.0 / count(*), 4) AS pct FROM p UNION ALL SELECT 'points', count(points), count(*), round(count(points) * 100.0 / count(*), 4) FROM p"""
)
def dq_completeness(spark, d):
    df = player_games(spark, d).withColumn("name", F.col("player_first_name"))
    return quality.completeness(df, ["name", "points"])


_TOP = "SELECT player_id, count(*) AS games, CAST(sum(points) AS BIGINT) AS points, round(sum(points) * 1.0 / count(*), 6) AS ppg FROM game_players GROUP BY player_id HAVING count(*) >= 20"


@query(f"WITH {cte('game_players')} {_TOP} ORDER BY round(sum(points) * 1.0 / count(*), 6) DESC, player_id LIMIT 20")
def top_points_per_game(spark, d):
    df = view(spark, d, "game_players").groupBy("player_id").agg(F.count("*").alias("games"), F.sum("points").alias("points")).filter("games >= 20")
    return df.withColumn("ppg", F.round(F.col("points").cast("double") / F.col("games"), 6)).orderBy(F.desc("ppg"), "player_id").limit(20)


_RULES = "SELECT game_id, home_score, away_score, last_period_type, away_sog AS away_shots, away_sog - home_score - game_id % 3 AS home_saves, round((away_sog - home_score - game_id % 3) * 100.0 / away_sog, 2) + CASE WHEN game_id % 11 = 0 THEN 1 ELSE 0 END AS home_save_pct FROM games"


def _rule_games(spark, d):
    return spark.sql(_RULES.replace("FROM games", "FROM {games}"), games=games(spark, d)).withColumn("home_save_pct", F.col("home_save_pct").cast("double"))


@query(
    f"""WITH {_G}, r AS ({_RULES}), f AS (SELECT game_id, concat_ws(',', CASE WHEN abs(away_shots - home_saves - home_score) > 1 THEN 'goals' END, CASE WHEN home_score = away_score AND last_period_type = 'REG' THEN 'tie' END,
CASE WHEN home_saves < 0 THEN 'negative' END, CASE WHEN game_id % 11 = 0 THEN 'save_pct' END) AS failed FROM r) SELECT * FROM f WHERE failed <> ''"""
)
def dq_game_rules(spark, d):
    return quality.game_rules(_rule_games(spark, d))


@query(f"WITH {_G} SELECT game_id, 'no_goal' AS anomaly FROM games WHERE home_score + away_score = 0 AND last_period_type = 'REG'")
def dq_anomalies(spark, d):
    return quality.anomalies(_rule_games(spark, d))


@query(
    f"""WITH {_G}, p AS (SELECT l_orderkey AS game_id, CAST(sum(l_linenumber) AS BIGINT) AS s, bool_or(l_linenumber = 5) AS o, bool_or(l_suppkey % 7 = 0) AS u FROM lineitem GROUP BY 1)
SELECT game_id, 'whitespace' AS warning FROM games WHERE game_id % 6 = 0 UNION ALL SELECT game_id, 'no_league_id' FROM games WHERE game_id % 4 = 0 UNION ALL SELECT game_id, 'period_sum' FROM games JOIN p USING (game_id) WHERE s <> home_score + away_score
UNION ALL SELECT game_id, 'unknown_event' FROM games JOIN p USING (game_id) WHERE o UNION ALL SELECT game_id, 'unknown_goal_type' FROM games JOIN p USING (game_id) WHERE u"""
)
def dq_warnings(spark, d):
    g = games(spark, d).withColumn("venue", F.when(F.col("game_id") % 6 == 0, F.lit("Arena  A\t")).otherwise(F.lit("Arena A"))).withColumn("league_id", F.when(F.col("game_id") % 4 > 0, F.lit("1")))
    li = table(spark, d, "lineitem").withColumn("game_id", F.col("l_orderkey"))
    events = li.select("game_id", F.when(F.col("l_linenumber") == 5, "other").otherwise("goal").alias("event_type"), F.when(F.col("l_suppkey") % 7 == 0, "unknown").alias("goal_type"))
    return quality.warnings(g, li.select("game_id", F.col("l_linenumber").alias("goals")), events)


@query("SELECT l_returnflag AS league, l_linenumber AS event_type, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY l_returnflag), 4) AS pct FROM lineitem GROUP BY 1, 2")
def dq_event_shares(spark, d):
    return quality.share_by(table(spark, d, "lineitem").select(F.col("l_returnflag").alias("league"), F.col("l_linenumber").alias("event_type")), "league", "event_type")


@query("""SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n_files, CAST(sum(length(o_orderpriority)) AS BIGINT) AS n_bytes, count(l) AS covered, round(count(l) * 100.0 / count(*), 4) AS pct
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS l FROM lineitem WHERE l_returnflag = 'R') ON l = o_orderkey GROUP BY 1""")
def dq_layer_coverage(spark, d):
    files_ = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.year("o_orderdate").cast("bigint").alias("year"), F.length("o_orderpriority").alias("bytes"))
    return quality.layer_coverage(files_, table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("key")), "key", "year")


@query("""WITH v AS (SELECT 'p' || l_linenumber AS prefix, count(*) AS n_files FROM lineitem GROUP BY 1), p AS (SELECT 'p' || r_regionkey AS prefix, r_name AS pipeline, 't' || r_regionkey AS table_name FROM region),
c AS (SELECT 't' || n_regionkey AS table_name, count(*) AS n FROM nation WHERE n_regionkey <> 2 GROUP BY 1)
SELECT prefix, coalesce(n_files, 0) AS n_files, pipeline, table_name, n AS n_rows, CASE WHEN pipeline IS NULL THEN 'no pipeline' WHEN coalesce(n_files, 0) = 0 THEN 'no files' WHEN coalesce(n, 0) = 0 THEN 'no rows' ELSE 'ok' END AS status
FROM v FULL JOIN p USING (prefix) LEFT JOIN c USING (table_name)""")
def dq_structure_report(spark, d):
    volumes = table(spark, d, "lineitem").groupBy(F.concat(F.lit("p"), "l_linenumber").alias("prefix")).agg(F.count("*").alias("n_files"))
    pipelines = table(spark, d, "region").select(F.concat(F.lit("p"), "r_regionkey").alias("prefix"), F.col("r_name").alias("pipeline"), F.concat(F.lit("t"), "r_regionkey").alias("table_name"))
    counts = table(spark, d, "nation").filter("n_regionkey != 2").groupBy(F.concat(F.lit("t"), "n_regionkey").alias("table_name")).agg(F.count("*").alias("n"))
    return quality.structure_report(volumes, pipelines, counts)


@query("""SELECT table_name, CASE WHEN e IS NULL THEN 'unexpected' WHEN f IS NULL THEN 'missing' ELSE 'present' END AS status
FROM (SELECT DISTINCT 't' || c_nationkey AS table_name, 1 AS e FROM customer) FULL JOIN (SELECT DISTINCT 't' || s_nationkey * 2 AS table_name, 1 AS f FROM supplier) USING (table_name)""")
def dq_table_presence(spark, d):
    expected = table(spark, d, "customer").select(F.concat(F.lit("t"), "c_nationkey").alias("table_name")).distinct()
    found = table(spark, d, "supplier").select(F.concat(F.lit("t"), F.col("s_nationkey") * 2).alias("table_name")).distinct()
    return quality.table_presence(found, expected)


_PROFILED = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_mktsegment": "string"}


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{k}' AS kind, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS greatest FROM customer"""
        for c, k in _PROFILED.items()
    )
)
def profile_table(spark, d):
    return quality.table_profile(table(spark, d, "customer").select(*_PROFILED))


@query("SELECT DISTINCT l_suppkey AS id, CAST(floor((dense_rank() OVER (ORDER BY l_suppkey) - 1) / 7) AS BIGINT) AS batch_no FROM (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5))")
def inc_id_batches(spark, d):
    done = table(spark, d, "supplier").filter("s_nationkey < 5").select(F.col("s_suppkey").alias("id"))
    return incremental.id_batches(table(spark, d, "lineitem").select(F.col("l_suppkey").alias("id")), done, "id", 7)


@query("SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n, count(CASE WHEN o_orderkey % 5 > 0 THEN 1 END) AS with_id, round(count(CASE WHEN o_orderkey % 5 > 0 THEN 1 END) * 100.0 / count(*), 4) AS pct FROM orders GROUP BY 1")
def dq_id_coverage(spark, d):
    o = table(spark, d, "orders").withColumn("id", F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderkey")))
    return quality.id_coverage(o, F.year("o_orderdate").cast("bigint").alias("year"), "id")


@query("SELECT * FROM (SELECT unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS \"column\", 'unexpected' AS side) WHERE \"column\" NOT IN ('c_custkey', 'c_name') UNION ALL SELECT DISTINCT c_mktsegment, 'missing' FROM customer")
def dq_schema_diff(spark, d):
    c = table(spark, d, "customer")
    expected = c.select(F.col("c_mktsegment").alias("column")).distinct().union(spark.createDataFrame([("c_custkey",), ("c_name",)], "column string"))
    return quality.schema_difference_rows(spark, c, expected)


_DOCUMENT = """'{"id": ' || o_orderkey || ', "who": {"name": "' || o_orderstatus || '"}, "list": [' || o_custkey || if(o_orderkey % 3 = 0, ', {"k": "v", "deep": [[{"x": {"y": {"z": {"w": 1}}}}]]}', '') || ']}'"""
_DEEP = " UNION ALL ".join(f"SELECT '{path}' AS path, '{kind}' AS kind, count(*) AS n FROM o WHERE k % 3 = 0" for path, kind in (("$.list[]", "OBJECT"), ("$.list[].k", "STRING"), ("$.list[].deep", "ARRAY"), ("$.list[].deep[]", "ARRAY"), ("$.list[].deep[][]", "OBJECT"), ("$.list[].deep[][].x", "OBJECT"), ("$.list[].deep[][].x.y", "OBJECT"), ("$.list[].deep[][].x.y.z", "DEEPER")))
_PATHS = f"""SELECT '$.id' AS path, 'BIGINT' AS kind, count(*) AS n FROM o UNION ALL SELECT '$.who', 'OBJECT', count(*) FROM o UNION ALL SELECT '$.who.name', 'STRING', count(*) FROM o UNION ALL SELECT '$.list', 'ARRAY', count(*) FROM o
UNION ALL SELECT '$.list[]', 'BIGINT', count(*) FROM o UNION ALL {_DEEP}"""


def _json_documents(spark, d):
    docs = table(spark, d, "orders").select(F.year("o_orderdate").alias("season"), F.expr(_DOCUMENT).alias("payload"))
    return docs.unionByName(docs.limit(1).select("season", F.lit("{broken").alias("payload")))


@query(f"WITH o AS (SELECT o_orderkey AS k FROM orders) {_PATHS}")
def json_key_paths(spark, d):
    return quality.json_key_paths(_json_documents(spark, d))


@query(f"WITH o AS (SELECT o_orderkey AS k FROM orders WHERE year(o_orderdate) IN (SELECT min(year(o_orderdate)) FROM orders UNION ALL SELECT max(year(o_orderdate)) FROM orders)) {_PATHS}")
def json_key_paths_of_ends(spark, d):
    """Of the first and last season alone."""
    return quality.json_key_paths(_json_documents(spark, d), ends_of="season")


_SKETCHED = ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS n_nulls, CASE WHEN count(DISTINCT {c}) < 60 THEN count(DISTINCT {c}) END AS n_distinct, CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS greatest FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity, CASE WHEN l_linenumber = 4 THEN NULL ELSE l_returnflag END AS l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem)" for c in _SKETCHED))
def profile_sketches(spark, d):
    """Profiles by year, merged: what is exact, and numbers of few distinct values, which the sketch counts as they are."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("l_quantity"), F.when(F.col("l_linenumber") != 4, F.col("l_returnflag")).alias("l_returnflag"), F.col("l_shipdate").cast("date").alias("l_shipdate"))
    parts = quality.profile_parts(lines.withColumn("year", F.year("l_shipdate")), ["year"])
    return quality.merged_profile(parts).select("column", "n_rows", "n_nulls", F.when(F.col("n_distinct") < 60, F.col("n_distinct")).alias("n_distinct"), "least", "greatest")


@query(f"WITH {_G} SELECT game_id, game_date FROM games WHERE season >= 19970000")
def src_catalog_table(spark, d):
    """A catalog table that is replaced by a query on itself, and read by name."""
    name, folder = f"games_{uuid.uuid4().hex}", scratch(spark, "catalog")
    writes.replace_in_catalog(spark, games(spark, d).filter("season < 19980000"), name, folder, partition_by=["season"])
    newer = games(spark, d).filter("season >= 19980000")
    writes.replace_in_catalog(spark, files.read_catalog_table(spark, name).unionByName(newer), name, folder, partition_by=["season"])
    return files.read_catalog_table(spark, name, ["game_id", "game_date"], "season >= 19970000")




