"""Write modes, incremental selection, plans and quality rules."""

import pytest
from pyspark.sql import functions as F

from hockeylake.operators import features, gold, insights, quality, writes
from hockeylake.plans import adapters
from hockeylake.sources import files, incremental

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upserts_are_idempotent_and_keep_null_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k long, v string")
    source = spark.createDataFrame([(2, "B", 9), (2, "BB", 9), (3, "c", 9), (None, "m", 9)], "k long, v string, extra int")
    once = writes.upsert_insert_only(target, source, ["k"])
    assert rows(once) == [(1, "a"), (2, "b"), (3, "c"), (None, "m"), (None, "n")]
    replaced = writes.upsert_delete_insert(target, source, ["k"])
    assert rows(replaced) == [(1, "a"), (2, "B"), (2, "BB"), (3, "c"), (None, "m"), (None, "n")]
    solid = source.filter("k is not null")
    again = writes.upsert_delete_insert(writes.upsert_delete_insert(target, solid, ["k"]), solid, ["k"])
    assert rows(again) == rows(writes.upsert_delete_insert(target, solid, ["k"]))
    with pytest.raises(ValueError, match="key"):
        writes.upsert_delete_insert(target, source.drop("k"), ["k"])
    assert rows(writes.upsert_delete_insert(target, source.limit(0), ["k"])) == rows(target)


def test_insights_are_inserted_once(spark):
    schema = "insight_id string, entity_id string, game_date string, entity_type string"
    target = spark.createDataFrame([("a", "1", "d1", "player")], schema)
    source = spark.createDataFrame([("a", "2", "d9", "player"), ("b", "1", "d1", "player"), ("c", "3", "d1", "team"), ("c", "3", "d1", "team"), ("d", "3", "d1", "team")], schema)
    once = writes.upsert_insights(target, source)
    assert [r[0] for r in rows(once)] == ["a", "c"]
    assert rows(writes.upsert_insights(once, source)) == rows(once)


def test_partition_overwrite_keeps_other_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    writes.overwrite_partitions(spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "v long, p string"), path, "p")
    for _ in range(2):
        writes.overwrite_partitions(spark.createDataFrame([(9, "y")], "v long, p string"), path, "p")
    assert rows(spark.read.parquet(path)) == [(1, "x"), (3, "unknown"), (9, "y")]


def test_replace_table_reads_what_it_replaces(spark, tmp_path):
    path = f"{tmp_path}/t"
    for n in (1, 2):
        old = spark.read.parquet(path) if n > 1 else spark.range(0)
        writes.replace_table(spark, old.union(spark.range(n)), path)
    assert spark.read.parquet(path).count() == 3


def test_replacement_that_was_cut_short_is_made_whole(spark, tmp_path):
    import os

    path = f"{tmp_path}/t"
    writes.replace_table(spark, spark.range(3), path)
    spark.range(5).write.parquet(f"{path}.new")
    os.rename(path, f"{path}.old")  # the run ended between the two renames
    assert writes.recover_table(spark, path) and spark.read.parquet(path).count() == 5
    os.rename(path, f"{path}.old")  # and here before the new table was whole
    os.makedirs(f"{path}.new")
    writes.replace_table(spark, spark.range(2), path)
    assert spark.read.parquet(path).count() == 2
    assert not writes.recover_table(spark, f"{tmp_path}/none")


def test_buckets_survive_a_batch_that_ends_early(spark, tmp_path):
    import os

    from hockeylake import streaming

    path, schema = f"{tmp_path}/b", "k long, v string"
    sink = streaming.upsert_to(path, ["k"], schema, buckets=4)
    batch = lambda lo, hi, v: spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    sink(batch(0, 20, "a"), 0)
    sink(batch(20, 21, "b"), 1)  # one bucket of four
    assert len(os.listdir(f"{path}/v=1")) < 5
    os.remove(f"{path}/v=1/_SUCCESS")  # the run ended before the version was whole
    assert writes.read_buckets(spark, path, schema).count() == 20
    for _ in range(2):
        sink(batch(15, 25, "b"), 1)
    got = dict(writes.read_buckets(spark, path, schema).select("k", "v").collect())
    assert got == {k: "a" if k < 20 else "b" for k in range(25)}
    sink(batch(0, 30, "c"), 2)
    assert writes.read_buckets(spark, path, schema).count() == 30
    assert set(writes.current_buckets(spark, path).values()) <= {f"file:{path}/v=2/bucket={k}" for k in range(4)}


def test_report_lines_in_other_shapes(spark):
    from hockeylake.operators import reports

    text = "SO period\nGoal  59:59 AWY 1 \u2013 2 EN 9 \u00c5S,  Bo\tAnn\nAWY: 9  11\nGoal at 12:00\nHOM: 1 2\nNote: x\nHOM: 3\n" + "9 " * 40 + "x\n\nGoal 10:00 HOM 3-2 7 OLE, P 8 PER, Q 9 PAL, R"
    lines = reports.report_lines(spark.createDataFrame([(1, "official_game_report", text), (2, "official_game_report", None)], "game_id long, report_type string, text string"))
    got = [tuple(r) for r in reports.goals(lines).drop("game_id", "pos").orderBy("seconds").collect()]
    assert got == [("SO", 600, "HOM", 3, 2, None, 7, "OLE, P", "PER, Q", "PAL, R"), ("SO", 3599, "AWY", 1, 2, "EN", 9, "\u00c5S, Bo Ann", None, None)]
    assert [(r.team, r.side, r.number) for r in reports.on_ice(lines).orderBy("number").collect()] == [("AWY", "positive", 9), ("AWY", "positive", 11)]
    assert reports.read_report(lines.select("game_id", "report_type", F.lit("x").alias("text")), "unknown") == {}


def test_csv_has_nested_cells_as_json(spark, tmp_path):
    writes.write_csv(spark.sql("SELECT 1 AS a, array(1, 2) AS b, named_struct('x', 'y') AS c"), f"{tmp_path}/csv")
    assert rows(files.read_csv_strings(spark, f"{tmp_path}/csv")) == [("1", "[1,2]", '{"x":"y"}')]


def test_documents_rejects_and_state(spark, tmp_path):
    folder = tmp_path / "by_date" / "2024-01-05"
    folder.mkdir(parents=True)
    (folder / "7.json").write_text('{"a": 1}')
    (folder / "8.json").write_text("{broken")
    (folder / "games_summary.json").write_text("{}")
    docs = files.read_documents(spark, str(tmp_path / "by_date"))
    good, bad = files.split_rejects(docs)
    assert [r.game_date for r in good.collect()] == ["2024-01-05"] and bad.count() == 1
    state = f"{tmp_path}/state"
    assert incremental.read_state(spark, state, "games") is None
    incremental.advance_state(spark, state, "games", "2024-01-05")
    incremental.advance_state(spark, state, "games", "2024-01-09")
    assert incremental.read_state(spark, state, "games") == "2024-01-09"
    with pytest.raises(ValueError, match="state"):
        incremental.check_scope(True, None, None)
    assert incremental.fresh_files(spark, str(tmp_path / "by_date"), hours=1)
    assert files.read_or_empty(spark, f"{tmp_path}/none", "a long").count() == 0


def test_rolling_form_edges(spark):
    games = [(1, g, "2024-01-0%d" % (g + 1), 20232024, "F", p, 600) for g, p in enumerate([2, 2, 2])] + [(2, 9, "2024-01-05", 20232024, "F", None, 60), (3, 9, "2024-01-05", 20232024, "G", 1, 60), (4, 9, "2024-01-05", 20232024, "F", 1, 0)]
    df = spark.createDataFrame(games, "player_id long, game_id long, game_date string, season long, position string, points long, toi_seconds long")
    for c in ("goals", "assists", "shots"):
        df = df.withColumn(c, F.col("points"))
    got = {(r.player_id, r.game_id): r for r in features.player_rolling_stats(df).collect()}
    assert set(got) == {(1, 0), (1, 1), (1, 2), (2, 9)}
    assert got[1, 2].pts_zscore_5v20 == 0 and got[1, 2].pts_season == 6 and got[1, 2].game_recency_rank == 1
    assert got[2, 9].pts_avg_5g == 0 and got[2, 9].pts_stddev_20g is None


def test_rolling_form_shuffles_once(spark):
    games = adapters.view(spark, SMALL, "games")
    plan = features.team_rolling_stats(gold.team_game_stats(games))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_corsi_is_symmetric(spark):
    games = adapters.view(spark, SMALL, "games")
    df = gold.team_corsi(gold.team_game_stats(games), gold.shot_attempts(adapters.view(spark, SMALL, "game_events"), games))
    other = df.select("game_id", F.col("opponent_abbr").alias("team_abbr"), F.col("corsi_for").alias("f"), F.col("corsi_against").alias("a"))
    assert df.join(other, ["game_id", "team_abbr"]).filter("corsi_for != a or corsi_against != f").count() == 0


def test_detectors_check_their_columns(spark):
    with pytest.raises(ValueError, match="needs"):
        insights.detect("team_streak", spark.range(1))
    assert set(insights.DETECTORS) == {"team_streak", "player_breakout", "goalie_trend"}


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, "d1", True), (2, "d2", True), (3, "d3", False)], "k long, day string, failed boolean")
    with pytest.raises(ValueError, match="2 of 3"):
        quality.error_budget(df, "day", F.col("failed"))
    quality.error_budget(df, "day", F.col("failed"), most=70)
    assert quality.schema_difference(df, ["k", "x"]) == (["x"], ["day", "failed"])


def test_table_comments(spark):
    spark.range(2).write.mode("overwrite").saveAsTable("commented")
    writes.comment_table(spark, "commented", "rows", {"id": "it's a key"})
    assert spark.sql("DESCRIBE commented").first()["comment"] == "it's a key"
    spark.sql("DROP TABLE commented")


def test_season_and_dimension_documents(spark, tmp_path):
    for name, text in {
        "seasons/20232024/a.json": '{"a": 1}', "seasons/x_standings.json": "[1]", "seasons/deep/y/z_20222023.json": "{}", "seasons/bad_1.json": "{", "basic/teams/all_teams.json": "[]", "basic/players/all_players.json": "[]",
        "basic/players/players_by_team.json": "{}", "basic/teams/old_roster.json": "[7]", "playoffs/2023_bracket.json": "{}", "playoffs/other.json": "{}",
    }.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    seasons = files.read_season_documents(spark, f"{tmp_path}/seasons")
    assert [r.season for r in seasons.collect()] == ["20232024", "20222023", "standings"]
    assert [r.season for r in files.read_season_documents(spark, f"{tmp_path}/seasons", depth=0).collect()] == ["standings"]
    found = files.read_dimension_documents(spark, str(tmp_path))
    assert {n: df.count() for n, df in found.items()} == {n: int(n in ("teams", "players", "players_by_team", "rosters", "playoffs")) for n in files.DIMENSIONS}
    rosters = tmp_path / "basic" / "teams" / "rosters" / "20242025"
    rosters.mkdir(parents=True)
    (rosters / "T.json").write_text("{broken")
    roster = files.read_dimension_documents(spark, str(tmp_path))["rosters"].collect()
    assert [(r.season, r.doc) for r in roster] == [("20242025", None)]
    with pytest.raises(FileNotFoundError, match="all_teams"):
        files.read_dimension_documents(spark, f"{tmp_path}/none")
    volumes = {r.prefix: (r.n_files, r.n_bytes) for r in quality.file_volumes(spark, f"{tmp_path}/basic").collect()}
    assert volumes == {"teams": (3, 12), "players": (2, 4)}
    spark.range(1).write.parquet(f"{tmp_path}/tables/one.parquet")
    assert files.list_tables(spark, f"{tmp_path}/tables") == ["one"] and files.list_tables(spark, f"{tmp_path}/no") == []


def test_backfill_goes_on_where_it_stopped(spark, tmp_path):
    ran, state = [], f"{tmp_path}/state"

    def job(year):
        ran.append(year)
        if len(ran) == 2:
            raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        incremental.backfill(spark, state, "games", [2012, 2010, 2011], job)
    assert incremental.backfill(spark, state, "games", [2010, 2011, 2012], job) == [2011, 2012]
    assert ran == [2010, 2011, 2011, 2012] and incremental.backfill(spark, state, "games", [2010, 2011], job) == []


def test_id_batches_and_processed_ids(spark):
    ids = spark.createDataFrame([(i,) for i in [5, 3, None, 9, 3, 1, 7]], "id long")
    done = spark.createDataFrame([(9,), (2,)], "id long")
    assert rows(incremental.id_batches(ids, done, "id", 2)) == [(1, 0), (3, 0), (5, 1), (7, 1)]
    first = incremental.id_batches(ids, done, "id", 3, most=1)
    assert rows(first.select("id")) == [(1,), (3,), (5,)]
    assert rows(incremental.processed_after(done, first, "id")) == [(1,), (2,), (3,), (5,), (9,)]


def test_dictionary_profile_and_keys_that_lack(spark):
    df = spark.createDataFrame([(1, "b", None), (2, "a", None), (2, None, None)], "k long, v string, n double")
    text = quality.dictionary_markdown({"t": df, "a": df.select("k")}, {"t": "rows"})
    assert text.index("## a") < text.index("## t") and "| v | string |  |" in text and "rows" in text
    assert {r.column: (r.n_nulls, r.n_distinct, r.least, r.greatest) for r in quality.table_profile(df).collect()} == {"k": (0, 2, "1", "2"), "v": (1, 2, "a", "b"), "n": (3, 0, None, None)}
    assert gold.keep_first(df, ["k", "absent"], ["v"]).count() == 3 and gold.keep_first(df, ["k"], ["v"]).count() == 2
    assert quality.json_key_paths(df.limit(0).select(F.col("v").alias("payload"))).count() == 0


def test_game_documents_without_players_fall_back(spark):
    from hockeylake.operators import documents

    one = '{"gameId": "7", "date": "2024-01-05", "boxscore": {"id": 8, "homeTeam": {"abbrev": "A", "score": 1, "hits": 0, "shots": 9}}, "liveData": {"boxscore": {"teams": {"home": {"teamStats": {"teamSkaterStats": {"hits": 0}, "teamGoalieStats": {"hits": 4}}}}}}}'
    two = '{"boxscore": {"id": 9, "gameDate": "2024-01-06T00:00", "homeTeam": {"abbrev": "B"}, "playerByGameStats": {"homeTeam": {"goalies": [{"playerId": 1, "toi": "30:00", "goalsAgainst": 2, "saves": 5, "hits": 0}]}}}}'
    parsed = documents.parse_games(spark.createDataFrame([("k", None, one), ("l", None, two), ("m", None, "{broken"), ("n", None, None)], "key string, game_date date, payload string"))
    games = {r.game_id: r for r in documents.extract_games(parsed).collect()}
    assert len(documents.extract_games(parsed).columns) == 41
    assert (games[7].home_hits, games[7].home_sog, str(games[7].game_date)) == (4, 9, "2024-01-05")
    assert (games[9].home_hits, games[9].home_sog, str(games[9].game_date)) == (None, None, "2024-01-06")
    players = documents.extract_players(parsed).collect()
    assert len(players) == 1 and len(players[0]) == 33 and (players[0].saves, players[0].gaa, players[0].is_home) == (5, 4.0, True)
