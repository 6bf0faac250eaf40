"""Queries that apply the column functions to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hockeylake import functions as fn
from hockeylake.operators.names import team_slug
from hockeylake.plans.adapters import cte, table, view
from hockeylake.plans.registry import query

#: Text shapes over whole tables, valid in both dialects.
_LINES = """SELECT l_orderkey AS k, l_linenumber AS n, l_suppkey AS s, l_partkey AS p, CAST(l_quantity AS BIGINT) AS q FROM {t}"""
_ORDERS = """SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority AS priority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS day FROM {t}"""


def _lines(spark, d, column: str):
    return spark.sql(_LINES.replace("{t}", "{lineitem}").replace(" FROM", f", {column} AS x FROM (SELECT *, l_orderkey AS k, l_linenumber AS n, l_suppkey AS s, l_partkey AS p, CAST(l_quantity AS BIGINT) AS q FROM") + ")", lineitem=table(spark, d, "lineitem"))


def _lines_sql(column: str, expression: str) -> str:
    return f"SELECT k, n, s, {expression} AS y FROM (SELECT *, {column} AS x FROM (SELECT l_orderkey AS k, l_linenumber AS n, l_suppkey AS s, l_partkey AS p, CAST(l_quantity AS BIGINT) AS q FROM lineitem))"


def _orders(spark, d, column: str):
    return spark.sql(f"SELECT *, {column} AS x FROM ({_ORDERS.replace('{t}', '{orders}')})", orders=table(spark, d, "orders"))


def _orders_sql(column: str, expression: str) -> str:
    return f"SELECT k, {expression} AS y FROM (SELECT *, {column} AS x FROM ({_ORDERS.format(t='orders')}))"


def _of_lines(name: str, column: str, function, expression: str) -> None:
    def run(spark, d):
        return _lines(spark, d, column).select("k", "n", "s", function(F.col("x")).alias("y"))

    query(_lines_sql(column, expression), name)(run)


def _of_orders(name: str, column: str, function, expression: str) -> None:
    def run(spark, d):
        return _orders(spark, d, column).select("k", function(F.col("x")).alias("y"))

    query(_orders_sql(column, expression), name)(run)


_NUMBER_TEXT = "CASE k % 5 WHEN 0 THEN CAST(q AS VARCHAR(9)) WHEN 1 THEN CAST(q AS VARCHAR(9)) || '.5' WHEN 2 THEN 'n/a' WHEN 3 THEN '' ELSE '-' || CAST(n AS VARCHAR(9)) END"
_of_lines("fn_to_int", _NUMBER_TEXT, fn.to_int, r"CASE WHEN regexp_matches(x, '^-?[0-9]+$') THEN CAST(x AS BIGINT) END")
_of_lines("fn_to_float", _NUMBER_TEXT, fn.to_float, r"CASE WHEN regexp_matches(x, '^-?[0-9]+(\.[0-9]+)?$') THEN CAST(x AS DOUBLE) END")
_COMMA = "CASE k % 5 WHEN 0 THEN CAST(q AS VARCHAR(9)) || ',' || CAST(n AS VARCHAR(9)) || '1' WHEN 1 THEN 'N/A' WHEN 2 THEN '-' WHEN 3 THEN '' ELSE CAST(q AS VARCHAR(9)) END"
_of_lines("fn_comma_decimal", _COMMA, fn.comma_decimal, "TRY_CAST(replace(CASE WHEN x NOT IN ('', 'N/A', '-') THEN x END, ',', '.') AS DOUBLE)")
_CLOCK = "CASE WHEN k % 7 = 0 THEN '1:02:03' WHEN k % 7 = 1 THEN NULL WHEN k % 7 = 2 THEN '12' ELSE CAST(q AS VARCHAR(9)) || ':' || lpad(CAST(s % 60 AS VARCHAR(9)), 2, '0') END"
_of_lines("fn_mmss_seconds", _CLOCK, fn.clock_seconds, "CASE WHEN k % 7 > 2 THEN q * 60 + s % 60 END")
_of_orders("fn_parse_date", "CASE k % 4 WHEN 0 THEN day || 'T19:00:00Z' WHEN 1 THEN day WHEN 2 THEN substr(day, 1, 7) ELSE 'not a date' END", fn.leading_date, "CASE WHEN k % 4 < 2 THEN CAST(day AS DATE) END")
_of_orders("fn_season_year", "CASE WHEN k % 9 = 0 THEN '' ELSE day END", fn.season_year, "CASE WHEN length(x) >= 4 THEN substr(x, 1, 4) END")
_of_orders("fn_clean_text", "CASE k % 3 WHEN 0 THEN priority || chr(9) ELSE '  ' || priority || '   x ' END", fn.clean_text, "trim(regexp_replace(replace(x, chr(9), ' '), ' {2,}', ' ', 'g'))")
_of_orders("fn_season_from_game_id", "(1995 + k % 8) * 1000000 + 20000 + c % 1300", fn.season_of_game_id, "CAST((1995 + k % 8) * 10000 + 1995 + k % 8 + 1 AS BIGINT)")
_LEAGUE = "CASE k % 6 WHEN 0 THEN 'SM-Slutspel' WHEN 1 THEN 'Play Out' WHEN 2 THEN 'Kvalserien' WHEN 3 THEN 'CHL' WHEN 4 THEN NULL ELSE 'SHL' END"
_of_orders("fn_game_type", _LEAGUE, fn.game_type, "CASE k % 6 WHEN 0 THEN 'playoff' WHEN 1 THEN 'play_out' WHEN 2 THEN 'qualification' WHEN 3 THEN 'champions_league' ELSE 'regular' END")
_of_orders("fn_position", "CASE k % 4 WHEN 0 THEN 'mv' WHEN 1 THEN ' lw ' WHEN 2 THEN 'MV' ELSE 'c' END", fn.position, "CASE k % 4 WHEN 1 THEN 'LW' WHEN 3 THEN 'C' ELSE 'G' END")
_of_orders("fn_period_map", "CASE k % 5 WHEN 4 THEN k ELSE 200050 + k % 5 END", fn.period_number, "CASE k % 5 WHEN 4 THEN k ELSE 1 + k % 5 END")
_of_orders("fn_phase", "CASE k % 4 WHEN 0 THEN 'Playoff final' WHEN 1 THEN 'Qualifier A' WHEN 2 THEN 'Practice' ELSE 'Serie' END", fn.phase, "CASE k % 4 WHEN 0 THEN 'Playoffs' WHEN 1 THEN 'Qualifiers' WHEN 2 THEN 'Practice' ELSE 'Regular' END")
_of_orders("fn_truncate", "CASE WHEN k % 5 = 0 THEN NULL ELSE priority || day END", lambda x: fn.truncated(x, 6), "substr(coalesce(x, ''), 1, 6)")
_of_orders("fn_html_unescape", "CASE k % 3 WHEN 0 THEN 'a &amp;lt; b' WHEN 1 THEN '&lt;b&gt; &quot;' || day || '&quot;' ELSE 'x&nbsp;&#39;y&#39;' END", fn.html_unescape, """CASE k % 3 WHEN 0 THEN 'a &lt; b' WHEN 1 THEN '<b> "' || day || '"' ELSE 'x ''y''' END""")
_of_lines("fn_zero_to_null", "(k + n) % 3", fn.zero_to_null, "nullif((k + n) % 3, 0)")
_of_lines("fn_synthetic_ids", "k", lambda x: fn.synthetic_id(x, F.col("n"), 500), "k * 1000 + n + 500")
_of_orders("fn_path_keys", "CASE k % 3 WHEN 0 THEN 'raw/by_date/' || day || '/' || CAST(k AS VARCHAR(20)) || '.json' WHEN 1 THEN 'silver/game_date=' || day || '/part.parquet' ELSE 'raw/' || day || 'x/a.json' END", fn.path_date, "CASE WHEN k % 3 < 2 THEN day END")
_of_orders("src_season_from_path", "CASE k % 3 WHEN 0 THEN 'stats/20232024/skaters.json' WHEN 1 THEN 'stats/standings_' || substr(day, 1, 4) || '.json' ELSE 'stats/none.json' END", fn.path_season, "CASE k % 3 WHEN 0 THEN '20232024' WHEN 1 THEN substr(day, 1, 4) END")
_of_lines("fn_insight_class", "(k % 13 - 6) / 2.0", lambda x: fn.player_class(x), "CASE WHEN x >= 2.5 THEN 'breakout' WHEN x >= 1 THEN 'hot_streak' WHEN x <= -2.5 THEN 'slump' ELSE 'cold_spell' END")
_of_lines("fn_severity", "CAST((k % 17 - 8) / 2.0 AS DOUBLE)", fn.severity, "round(least(abs(x), 3.0) / 3, 4)")
_of_orders("fn_insight_id", "CAST(c AS VARCHAR(20))", lambda x: fn.insight_id(F.lit("player"), x, F.lit("slump"), F.col("day")), "substr(md5('player:' || x || ':slump:' || day), 1, 16)")
_of_lines("fn_cross_save_pct", "q", lambda x: fn.cross_save_pct(x, F.col("s") % 40), "CASE WHEN s % 40 > 0 THEN round(CAST(x AS DOUBLE) * 100 / (s % 40), 2) END")
_of_lines("fn_gaa", "n", lambda x: fn.goals_against_average(x, (F.col("s") % 30) * 60), "CASE WHEN s % 30 > 0 THEN round(CAST(x AS DOUBLE) * 3600 / ((s % 30) * 60), 4) END")
_of_lines("fn_per60", "n", lambda x: fn.per_60(x, (F.col("s") % 30) * 60), "CASE WHEN s % 30 > 0 THEN round(CAST(x AS DOUBLE) * 3600 / ((s % 30) * 60), 4) END")
_of_lines("fn_zscore", "CAST(n AS DOUBLE)", lambda x: fn.zscore(x, F.lit(4.0), (F.col("s") % 3).cast("double")), "CASE WHEN s % 3 > 0 THEN round((x - 4.0) / (s % 3), 3) ELSE 0.0 END")
_of_lines("fn_first_present", "CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '0' ELSE 'v' || CAST(n AS VARCHAR(9)) END", lambda x: fn.first_present(x, F.col("n"), F.lit("z")), "CASE WHEN k % 4 = 3 THEN x ELSE CAST(n AS VARCHAR) END")
_of_orders("fn_full_name", "CASE WHEN k % 4 = 0 THEN '' ELSE priority END", lambda x: fn.full_name(x, F.when(F.col("k") % 8 == 0, F.lit(" ")).otherwise(F.col("day"))), "nullif(trim(x || ' ' || CASE WHEN k % 8 = 0 THEN ' ' ELSE day END), '')")


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 < 3 THEN o_orderkey % 7 END AS home, CASE WHEN o_orderkey % 4 < 3 THEN o_custkey % 7 END AS away FROM orders")
def fn_parse_result(spark, d):
    df = _orders(spark, d, "CASE WHEN k % 4 = 0 THEN CAST(k % 7 AS VARCHAR(9)) || ' - ' || CAST(c % 7 AS VARCHAR(9)) WHEN k % 4 < 3 THEN CAST(k % 7 AS VARCHAR(9)) || '-' || CAST(c % 7 AS VARCHAR(9)) ELSE 'x - 1' END")
    home, away = fn.parse_result(F.col("x"))
    return df.select("k", home.alias("home"), away.alias("away"))


_P = "CASE WHEN home_score > away_score THEN 2 WHEN home_score < away_score AND last_period_type <> 'REG' THEN 1 WHEN home_score < away_score THEN 0 END"


@query(f"WITH {cte('games')} SELECT game_id, CAST({_P} AS BIGINT) AS points FROM games")
def fn_points_210(spark, d):
    return view(spark, d, "games").select("game_id", fn.points_210(F.col("home_score"), F.col("away_score"), F.col("last_period_type") != "REG").alias("points"))


@query(f"WITH {cte('games')} SELECT game_id, CAST(CASE WHEN home_score > away_score AND last_period_type = 'REG' THEN 3 WHEN home_score > away_score THEN 2 WHEN last_period_type <> 'REG' THEN 1 ELSE 0 END AS BIGINT) AS points FROM games")
def fn_points_3210(spark, d):
    return view(spark, d, "games").select("game_id", fn.points_3210(F.col("home_score") > F.col("away_score"), F.col("last_period_type") != "REG").alias("points"))


@query("SELECT l_orderkey AS k, bool_or(l_linenumber > 3) AS ot, bool_or(l_linenumber = 7) AS so FROM lineitem GROUP BY l_orderkey")
def fn_ot_so_flags(spark, d):
    label = F.when(F.col("l_linenumber") == 7, "SO").otherwise(F.col("l_linenumber").cast("string"))
    seen = F.when(F.col("l_linenumber") > 3, "OT").otherwise(F.col("l_linenumber").cast("string"))
    df = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set(label).alias("p"), F.collect_set(seen).alias("e"))
    ot, so = fn.overtime_flags(F.col("p"), F.col("e"))
    return df.select(F.col("l_orderkey").alias("k"), ot.alias("ot"), so.alias("so"))


@query("SELECT p_partkey AS k, split_part(p_name, ' ', 1) AS first_name, CASE WHEN contains(p_name, ' ') THEN substr(p_name, length(split_part(p_name, ' ', 1)) + 2) ELSE p_name END AS last_name FROM part")
def fn_name_split(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), fn.first_name(F.col("p_name")).alias("first_name"), fn.rest_of_name(F.col("p_name")).alias("last_name"))


_NAMED = """SELECT c_custkey AS k, CASE c_custkey % 6 WHEN 0 THEN upper(c_name) || ' IHK' WHEN 1 THEN right(c_name, 2) WHEN 2 THEN 'Ælg Å ' || CAST(c_custkey AS VARCHAR(9)) WHEN 3 THEN c_name WHEN 4 THEN right(c_name, 4) ELSE CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '' END END AS name FROM {t}"""
_KNOWN = """SELECT CASE WHEN c_custkey % 20 = 0 THEN c_name ELSE substr(c_name, 10) END AS name, 's' || CAST(c_custkey AS VARCHAR(9)) AS value, c_custkey // 20 AS ord FROM {t} WHERE c_custkey % 10 = 0"""


@query(f"""WITH n AS ({_NAMED.format(t="customer")}), m AS ({_KNOWN.format(t="customer")}),
hit AS (SELECT k, min({{'ord': ord, 'value': value}}) AS first FROM n JOIN m ON contains(lower(n.name), lower(m.name)) OR contains(lower(m.name), lower(n.name)) GROUP BY k)
SELECT k, coalesce(first.value, replace(translate(replace(lower(name), ' ', '_'), 'øå', 'oa'), 'æ', 'ae')) AS slug FROM n LEFT JOIN hit USING (k)""")
def fn_team_slug(spark, d):
    """Names around, within and beside known ones, short and empty and null ones, against known names of which two share each place in the order."""
    c = table(spark, d, "customer")
    names, known = (spark.sql(q.replace("{t}", "{c}").replace("//", "div"), c=c) for q in (_NAMED, _KNOWN))
    return team_slug(names, "name", known).select("k", "slug")


_DOC = "to_json(struct(o_orderkey % 5 AS plain, named_struct('default', o_orderpriority) AS local, named_struct('metric', o_custkey % 90, 'imperial', o_custkey % 60) AS speed, array(named_struct('id', o_custkey), named_struct('id', o_orderkey)) AS plays))"


def _variants(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.try_parse_json(F.expr(_DOC)).alias("v"))


@query("SELECT o_orderkey AS k, unnest([o_custkey, o_orderkey]) AS id FROM orders")
def fn_first_list(spark, d):
    return _variants(spark, d).select("k", F.explode(fn.first_list(F.col("v"), "$.events", "$.plays")).alias("e")).select("k", F.try_variant_get("e", "$.id", "bigint").alias("id"))


@query("SELECT o_orderkey AS k, CAST(o_orderkey % 5 AS VARCHAR) AS plain, o_orderpriority AS local FROM orders")
def fn_localised(spark, d):
    return _variants(spark, d).select("k", fn.localised(F.col("v"), "plain").alias("plain"), fn.localised(F.col("v"), "local").alias("local"))


@query("SELECT o_orderkey AS k, CAST(o_custkey % 90 AS DOUBLE) AS metric, CAST(o_custkey % 60 AS DOUBLE) AS imperial FROM orders")
def fn_measure_flatten(spark, d):
    metric, imperial = fn.measure(F.col("v"), "speed")
    return _variants(spark, d).select("k", metric.alias("metric"), imperial.alias("imperial"))


@query("""SELECT o_orderkey AS k, coalesce(nullif(o_orderpriority, '1-URGENT'), 'top') AS a, CASE WHEN o_totalprice > 1000 THEN 'x' ELSE 'y' END AS b, split_part(o_orderpriority, '-', 2) AS c, o_orderstatus || '/' || o_orderpriority AS e,
abs(o_custkey - 700) AS f, CAST(CAST(o_orderdate AS DATE) - INTERVAL 20 DAY AS DATE) AS g FROM orders""")
def fn_sql_builtins(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("k"), F.coalesce(F.nullif("o_orderpriority", F.lit("1-URGENT")), F.lit("top")).alias("a"), F.when(F.col("o_totalprice") > 1000, "x").otherwise("y").alias("b"), F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("c"),
        F.concat("o_orderstatus", F.lit("/"), "o_orderpriority").alias("e"), F.abs(F.col("o_custkey") - 700).alias("f"), F.date_sub(F.col("o_orderdate").cast("date"), 20).alias("g"),
    )
