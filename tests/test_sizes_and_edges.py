"""Results at edges, and plans and documents that don't grow with the tables."""

import random
import re

from pyspark.sql import functions as F

from hockeylake.operators import names, reports, trends
from hockeylake.plans import catalog, document_queries, gold_queries, report_queries

SMALL = "/root/testdata/sf0.001"


def test_pace_is_rounded_as_a_double(spark):
    games = spark.range(1, 81).select(F.lit("T1").alias("team_abbr"), F.lit(1).alias("season"), F.col("id").alias("game_id"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("game_date"), F.when(F.col("id") < 70, 1).alias("team_points"))
    paces = {r.game_no: r.pace for r in trends.points_curve(games).collect()}
    # 69 * 82 / 80 is just below 70.725 in binary, 70 * 82 / 70 is whole and 69 * 82 / 72 is a plain fraction.
    assert (paces[80], paces[1], paces[72]) == (70.72, 82.0, 78.58)


def test_profile_table_has_its_own_columns(spark):
    found = catalog.QUERIES["profile_table"](spark, SMALL)
    assert {r["column"]: r.n_rows for r in found.collect()} == dict.fromkeys(("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), 150)


def _orders(spark, path, n):
    """Orders of one season as a table on its own."""
    o = spark.range(n).selectExpr("id AS o_orderkey", "id % 99 AS o_custkey", "'O' AS o_orderstatus", "1.0D AS o_totalprice", "TIMESTAMP_NTZ '1996-03-04 00:00:00' AS o_orderdate", "'5-LOW' AS o_orderpriority")
    o.write.parquet(f"{path}/orders.parquet")
    return str(path)


def _largest(seen, path):
    return max(r.n for r in seen[0].select(F.size(F.try_variant_get("doc", path, "array<variant>")).alias("n")).collect())


def test_documents_of_matches_stay_small(spark, tmp_path, monkeypatch):
    folder, seen = _orders(spark, tmp_path, 3000), []
    extract = document_queries.doc.norwegian_matches
    monkeypatch.setattr(document_queries.doc, "norwegian_matches", lambda docs: seen.append(docs) or extract(docs))
    assert catalog.QUERIES["trf_nor_matches"](spark, folder).count() == 2700
    assert _largest(seen, "$.matches") <= 1000


def test_documents_of_game_ids_stay_small(spark, tmp_path, monkeypatch):
    folder, seen = _orders(spark, tmp_path, 3000), []
    extract = document_queries.doc.extract_game_ids
    monkeypatch.setattr(document_queries.doc, "extract_game_ids", lambda docs: seen.append(docs) or extract(docs))
    assert catalog.QUERIES["trf_game_ids"](spark, folder).count() == 3000
    assert _largest(seen, "$.data.items") <= 1000


def test_known_names_are_not_broadcast(spark):
    known = spark.range(50).selectExpr("concat('Customer#', id) AS name", "'v' AS value", "id AS ord")
    found = names.first_containing(known.select("name"), "name", known)
    assert found.count() == 50
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_texts_are_made_by_many_tasks(spark):
    for df in (report_queries._lines(spark, SMALL, report_queries._REPORT), report_queries._pages(spark, SMALL, report_queries._PAGE), report_queries._all_reports(spark, SMALL)):
        assert df.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_events_of_a_page_are_read_once(spark):
    plan = reports.page_events(spark.createDataFrame([(1, "<tr><td>01:00</td></tr>")], "page_id int, html string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan and not [x for x in plan.split("\n") if "Filter" in x and "size(" in x]


def test_team_names_without_any_and_with_tables_alone(spark):
    line = "HOM 2 20 24 92,31 6 04:00 2 50,00 02:10 1 N/A"
    texts = [(1, "r", f"{line}\n{line.replace('HOM', 'AWY')}\n{line}"), (2, "r", "nothing\n \n "), (3, "r", f"{line}\nLeft - Right\nNext - Other")]
    found = reports.team_names(reports.report_lines(spark.createDataFrame(texts, "game_id int, report_type string, text string")))
    assert sorted(map(tuple, found.collect())) == [(1, "HOM", "AWY"), (3, "Left", "Right")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1


def test_tasks_of_texts_grow_with_the_games(spark, monkeypatch):
    monkeypatch.setattr(report_queries, "_GAMES_A_TASK", 15)
    assert report_queries._lines(spark, SMALL, report_queries._REPORT).rdd.getNumPartitions() == 100


def test_tasks_of_windows_by_player_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(gold_queries, "_ROWS_A_TASK", 100)
    rows = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    found = catalog.QUERIES["player_rolling_stats"](spark, SMALL)
    assert found.rdd.getNumPartitions() == -(-rows // 100)
    assert found.count() == found.select("player_id", "game_id").distinct().count() > 5000


def test_a_games_reports_are_each_read_once(spark):
    found = reports.report_bundle(report_queries._all_reports(spark, SMALL))["skaters"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("line_up") == plan.count("team_roster") == 0


def test_dispatch_reads_the_texts_once(spark):
    found = catalog.QUERIES["txt_dispatch"](spark, SMALL)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode") == 1 and plan.count("RepartitionByExpression") == 1
    assert sorted(map(tuple, found.collect())) == [("goalkeeper_changes", 1500), ("goals", 3000), ("penalties", 1500), ("team_names", 1500)]


_ODD_LINES = (
    "", " ", "\u00a0\t", "\r", "Goal 01:00 HOM 1 - 0 9 HALL, Max", "\u00a0Goal\t 01:00  HOM 1-0 PP1", "Goal\x0b01:00\fHOM 2 \u2013 1", "Goal 01:00 HOM", "Goal of the night", "goal 01:00 HOM 1-0", "Penalty 15:02 AWY 2 min. 17 BERG, Karl Roughing", "Penalty 15:02 AWY 2 minutes x", "Penalty 15:02 AWY - min. 17",
    "Goalkeeper Out 58:40 AWY 35 LIND, Olle\r", "Goalkeeper  In 58:40 AWY 35", "Goalkeeper Off 58:40 AWY 35 X", "Left - Right", "Left \t-\u00a0Right", "Left vs. Right", "A - B - C", "A - - B", "A -- B", "Left - Right 2", "Spectators: 1 420", "Spectators:", "Spectators: 99 999 999 999 999 999 999",
    "HOM 2 20 24 92,31 6 04:00 2 50,00 02:10 1 N/A", "Two Words 2 20 24 92,31 6 04:00 2 50,00 02:10 1 -", "2 20 24 92,31 6 04:00 2 50,00 02:10 1 N/A", "Referees Adams, Bo Berg, Carl", "HOM: 6 12", "1st period", "Overtime", "\u00d6 \u2014 \u00c5", "\u00a1", "\u0085", "\x01", "!",
)


def _odd_reports(spark):
    """Texts of some of the odd lines each: several of a game, some of no game, and some of another kind."""
    rng = random.Random(4)
    texts = [rng.choice(("\n", "\r\n", "\r\r\n")).join(rng.choices(_ODD_LINES, k=rng.randint(0, 4))) for _ in range(400)]
    rows = [(rng.choice((None, *range(250))), rng.choice(("official_game_report", "official_game_report", "line_up")), t) for t in texts]
    return spark.createDataFrame([*rows, (999, "official_game_report", None)], "game_id bigint, report_type string, text string")


def test_sizes_are_those_of_the_tables(spark):
    texts = _odd_reports(spark).repartition(5)
    tables = reports.read_report(texts, "official_game_report")
    sizes = {n: t.count() for n, t in tables.items()}
    assert all(sizes.values())
    assert dict(map(tuple, reports.report_sizes(texts, "official_game_report").collect())) == sizes
    assert sorted(map(tuple, reports.report_sizes(texts.limit(0), "official_game_report", "goals", "team_names").collect())) == [("goals", 0), ("team_names", 0)]
    assert reports.report_sizes(texts, "unknown").collect() == []


def test_lines_are_tidied_whatever_their_blanks(spark):
    texts = _odd_reports(spark).withColumn("report_type", F.monotonically_increasing_id().cast("string")).filter("text IS NOT NULL")
    expected = set()
    for r in texts.collect():
        for pos, line in enumerate(re.split("\r?\n", r.text)):
            line = re.sub("[ \t\n\x0b\f\r\u00a0]+", " ", line).strip(" ")
            if line.startswith("Goal "):
                line = re.sub(r"(?<=\d)(?: [-\u2013] |[-\u2013])(?=\d)", "-", line)
            if line:
                expected.add((r.report_type, pos, line, tuple(line.split(" "))))
    got = [(r.report_type, r.pos, r.line, tuple(r.words)) for r in reports.report_lines(texts).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
