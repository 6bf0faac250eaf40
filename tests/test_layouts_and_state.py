"""Layouts as published, substring joins, sketches, plans of scans, catalog versions, chains of insights and keyed state."""

import json
import random

import pytest
from pyspark.sql import functions as F

from hockeylake.functions import folded_slug
from hockeylake.operators import documents, insights, names, quality, reports, trends, writes
from hockeylake.sources import files, incremental


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def variants(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "payload string").select(F.try_parse_json("payload").alias("doc"))


def test_first_containing_equals_brute_force(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choices("aAbBcÅ ", k=n))
    known = [(word(rng.randint(0, 6)) or "b", f"v{i}", i // 2) for i in range(30)] + [(None, "none", 0)]
    texts = [word(rng.randint(0, 8)) for _ in range(200)] + ["", None, "zzz", "a"]
    found = names.first_containing(spark.createDataFrame([(t,) for t in texts], "x string"), "x", spark.createDataFrame(known, "name string, value string, ord int"))
    wanted = {}
    for t in {t for t in texts if t is not None}:
        hits = [(o, v) for n, v, o in known if n is not None and (n.lower() in t.lower() or t.lower() in n.lower())]
        if hits:
            wanted[t] = min(hits)[1]
    assert {r.x: r.value for r in found.collect()} == wanted


def test_slugs(spark):
    df = spark.createDataFrame([("IF Frisk Asker Hockey Elite",), ("storhamar",), ("Ærlige Å",), ("",), (None,)], "name string")
    known = spark.createDataFrame([(n, s, i) for i, (n, s) in enumerate(documents.NORWEGIAN_TEAMS)], "name string, value string, ord int")
    joined = {r.name: r.slug for r in names.team_slug(df, "name", known).collect()}
    inline = {r.name: r.slug for r in df.select("name", names.slug_among(F.col("name"), documents.NORWEGIAN_TEAMS).alias("slug")).collect()}
    assert joined == inline == {"IF Frisk Asker Hockey Elite": "friskasker", "storhamar": "storhamar", "Ærlige Å": "aerlige_a", "": "friskasker", None: None}
    assert df.select(folded_slug(F.lit("Ø B")).alias("x")).first().x == "o_b"


def test_watermark_reaches_the_scan(spark, tmp_path):
    spark.range(40).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("game_date")).write.partitionBy("game_date").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    control = spark.createDataFrame([("2024-02-05",)], "value string")
    after = incremental.after_watermark(table, control)
    assert sorted(r.id for r in after.collect()) == [36, 37, 38, 39]
    filters = next(line for line in plan(after).splitlines() if "PartitionFilters" in line)
    assert "game_date" in filters and "ubquery" in filters
    assert incremental.after_watermark(table, control.limit(0)).count() == 40


def test_paths_of_documents_in_one_scan(spark, tmp_path):
    docs = [{"a": 1, "b": {"c": [{"d": "x"}, 2, [3]]}}, {"a": "t"}, [1, {"e": None}]]
    spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(8, "{broken"), (9, None)], "season int, payload string").write.parquet(str(tmp_path / "d"))
    df = quality.json_key_paths(spark.read.parquet(str(tmp_path / "d")), depth=6)
    assert plan(df).count("(1) Scan parquet") <= 2 and "(2) Scan parquet" not in plan(df) and "Union" not in plan(df)
    got = {(r.path, r.kind): r.n for r in df.collect()}
    assert got[("$.a", "BIGINT")] == got[("$.a", "STRING")] == 1 and got[("$.b.c[].d", "STRING")] == 1 and got[("$.b.c[][]", "BIGINT")] == 1 and got[("$[]", "BIGINT")] == 1
    assert {r.path for r in quality.json_key_paths(spark.read.parquet(str(tmp_path / "d")).filter("season < 3"), ends_of="season").collect()} == {"$.a", "$.b", "$.b.c", "$.b.c[]", "$.b.c[].d", "$.b.c[][]", "$[]", "$[].e"}
    shallow = {(r.path, r.kind) for r in quality.json_key_paths(spark.read.parquet(str(tmp_path / "d")), depth=1).collect()}
    assert ("$.b", "DEEPER") in shallow and ("$.a", "BIGINT") in shallow


def test_profiles_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 7000).alias("k"), F.when(F.col("id") % 4 > 0, (F.col("id") % 1000).cast("double")).alias("x"), F.concat(F.lit("t"), F.col("id") % 30).alias("s"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("d"), (F.col("id") % 2).alias("day"), F.array("id").alias("nested"))
    parts = quality.profile_parts(df, ["day"])
    assert "Expand" not in plan(parts)
    merged = {r.column: r for r in quality.merged_profile(parts).collect()}
    whole = {r.column: r for r in quality.merged_profile(quality.profile_parts(df.drop("day"))).collect()}
    assert set(merged) == {"k", "x", "s", "d"}
    for name in merged:
        a, b = merged[name], whole[name]
        assert (a.n_rows, a.n_nulls, a.n_distinct, a.least, a.greatest, a.samples) == (b.n_rows, b.n_nulls, b.n_distinct, b.least, b.greatest, b.samples)
    assert abs(merged["k"].n_distinct / 7000 - 1) < 4 * quality.DISTINCT_ERROR and merged["s"].n_distinct == 30
    assert merged["x"].n_nulls == 5000 and (merged["x"].least, merged["k"].greatest, merged["d"].greatest) == ("1.0", "6999", "2024-02-19")
    assert all(abs(got - q * 1000) < 1000 * 3 * quality.RANK_ERROR for got, q in zip(merged["x"].quantiles, (0.25, 0.5, 0.75), strict=True)) and merged["s"].quantiles is None
    assert all(v.startswith("t") for v in merged["s"].samples)
    empty = {r.column: r for r in quality.merged_profile(quality.profile_parts(df.limit(0))).collect()}
    assert empty["k"].n_rows == 0 and empty["k"].least is None and empty["k"].quantiles is None


def test_catalog_versions(spark, tmp_path):
    folder = f"file://{tmp_path}/versions"
    for n in range(1, 4):
        before = spark.table("swapped") if n > 1 else None
        rows = spark.range(n) if before is None else before.union(spark.range(n))
        assert writes.replace_in_catalog(spark, rows, "swapped", folder) == n
        if before is not None:
            assert before.count() > 0  # who began with the old version ends with it
    assert files.read_catalog_table(spark, "swapped", ["id"], "id > 0").count() == 3
    assert sorted(r.tableName for r in spark.sql("SHOW TABLES LIKE 'swapped__v*'").collect()) == ["swapped__v2", "swapped__v3"]
    with pytest.raises(Exception, match="cannot|divide|DIVIDE"):
        writes.replace_in_catalog(spark, spark.range(3).select((F.col("id") / F.lit(0)).alias("id")), "swapped", folder)
    assert files.read_catalog_table(spark, "swapped").count() == 6


def test_chains_of_insights(spark):
    rows = [("p", "1", "hot", f"2024-01-{d:02}", d, s) for d, s in ((1, 0.5), (5, 0.9), (12, 0.2), (20, 0.4), (20, 0.6))] + [("p", "2", "hot", "2024-01-02", 1, 0.7)]
    df = spark.createDataFrame(rows, "entity_type string, entity_id string, insight_type string, game_date string, game_id int, severity double").withColumn("game_date", F.col("game_date").cast("date")).withColumn("run", F.lit(1))
    chains = sorted((r.entity_id, str(r.first_date), str(r.game_date), r.n_repeats, r.severity) for r in insights.islands(df, 7).collect())
    assert chains == [("1", "2024-01-01", "2024-01-12", 2, 0.9), ("1", "2024-01-20", "2024-01-20", 1, 0.6), ("2", "2024-01-02", "2024-01-02", 0, 0.7)]
    assert [(r["rank"], r.severity) for r in insights.ranked(insights.islands(df, 7), 2, ["run"]).orderBy("rank").collect()] == [(1, 0.9), (2, 0.7)]


def test_bracket(spark):
    rows = [(1, "A", 1, 1, 2, 1), (1, "B", 1, 3, 4, 4), (1, "C", 2, 1, 4, None), (2, "A", 1, 5, 6, 5), (2, None, 1, 7, 8, 7)]
    got = {(r.season, r.series_letter): (r.parent, r.path, r.depth) for r in trends.playoff_bracket(spark.createDataFrame(rows, "season int, series_letter string, round int, top_seed_id int, bottom_seed_id int, winning_team_id int")).collect()}
    assert got == {(1, "A"): ("C", "C/A", 1), (1, "B"): ("C", "C/B", 1), (1, "C"): (None, "C", 0), (2, "A"): (None, "A", 0)}


def test_line_up_report(spark):
    text = "Leksands IF (White)\n37 HELLSTEN, Jakob\n1st\n10 JOHANSSON, Anton (RD) 36 MILOSEVIC, Stefan (LD)\nExtra players\n5 EK, Bo (RW)\nFrölunda HC\n30 NOR, Ed\n7 LOOSE, Lee (GK)"
    lines = reports.report_lines(spark.createDataFrame([(1, "line_up", text), (2, "line_up", "7 LOOSE, Lee (GK)\n30 NOR, Ed"), (3, "line_up", None)], "game_id long, report_type string, text string"))
    got = [(r.team, r.line_number, r.number, r.position) for r in reports.lineup(lines).filter("game_id = 1").orderBy("pos", "i").collect()]
    assert got == [("Leksands IF", "Goalkeepers", 37, "GK"), ("Leksands IF", "1st", 10, "RD"), ("Leksands IF", "1st", 36, "LD"), ("Leksands IF", "Extra players", 5, "RW"), ("Frölunda HC", "Goalkeepers", 30, "GK"), ("Frölunda HC", None, 7, "GK")]
    assert [(r.team, r.number) for r in reports.lineup(lines).filter("game_id = 2").collect()] == [(None, 7)]


def test_pages_by_section(spark):
    row = "<tr><td>LIF</td><td>30. Nor, Ed</td><td><strong>92,00%</strong> (23/25)</td></tr>"
    html = f"<h3>Other</h3>{row}<h3>Goalkeeper Summary</h3><table>{row}</table><h3>End</h3>{row}"
    pages = spark.createDataFrame([(1, html), (2, row), (3, None)], "page_id long, html string")
    assert [tuple(r) for r in reports.page_goalkeepers(pages).collect()] == [(1, "LIF", 30, "Nor, Ed", 92.0, 23, 25)]
    event = lambda at: f"<tr><td>{at}</td><td>Timeout</td><td>HOM</td><td></td></tr>"
    head = lambda text: f'<tr><th class="tdSubTitle"><h3>{text}</h3></th></tr>'
    played = spark.createDataFrame([(1, event("45:00") + head("2nd period") + event("21:00") + "<h3>1st period</h3>" + event("22:00") + head("Overtime") + event("61:00")), (2, event("10:00") + event("45:00"))], "page_id long, html string")
    assert [r.period for r in reports.page_events(played).orderBy("page_id", "pos").collect()] == [4, 2, 2, 4, 2, 2]


def test_schedule_page(spark):
    cells = lambda *c: "<tr>" + "".join(f'<td class="tdOdd">{x}</td>' for x in c) + "</tr>"
    html = '<th>2024-01-02</th><tr><td colspan="5"><a href="/ScheduleAndResults/Overview/77">SHL &amp; Co</a></td></tr>' + cells("19:00", "A - B", "<a href=\"javascript:openonlinewindow('/Game/Events/555',1)\">2 - 1</a>", "Hall")
    row = reports.page_games(spark.createDataFrame([(1, html), (2, html.replace("2024-01-02", "soon"))], "page_id long, html string")).collect()
    assert [(r.page_id, r.date, r.league_id, r.league, r.game_id, r.home_team, r.away_team, r.home_score, r.away_score) for r in row] == [(1, "2024-01-02", 77, "SHL & Co", 555, "A", "B", 2, 1)]


def test_lists_below_other_keys(spark):
    assert [r.abbr for r in documents.extract_teams(variants(spark, {"data": [{"abbr": "A"}, "x", None]})).collect()] == ["A"]
    assert sorted((r.code, r.name) for r in documents.extract_countries(variants(spark, {"countries": [{"code": "SE", "name": "Sweden"}]}, {"NO": "Norway", "FI": {"default": "Finland"}})).collect()) == [("FI", "Finland"), ("NO", "Norway"), ("SE", "Sweden")]
    assert [r.term for r in documents.extract_terms(variants(spark, {"items": [{"term": "icing", "definition": "d"}, "offside"]})).collect()] == ["icing", "offside"]
    assert [tuple(r) for r in documents.extract_draft(variants(spark, {"rounds": [{"draftYear": 2024, "rounds": 7}, 5]})).collect()] == [(2024, 7, None), (None, None, "5")]
    assert [r.series_letter for r in documents.extract_playoffs(variants(spark, {"season": 2024, "series": [{"seriesLetter": "A", "seriesTitle": "z"}, {"seriesLetter": "A", "seriesTitle": "a"}]})).collect()] == ["A"]
    assert sorted(r.game_id for r in documents.extract_game_ids(variants(spark, {"game_ids": [1, "2"]}, {"gameIds": 3}, {"data": {"items": [{"id": 4}]}}).withColumn("season", F.lit("s"))).collect()) == [1, 2, 3, 4]


def test_league_line_ups(spark):
    player = lambda n, **more: {"number": n, "name": f"P{n}", **more}
    doc = {"game_id": "1", "date": "2024-01-02", "home_team_lineup": {"team": " A  B ", "goalies": [player(30, starting=True), "x"], "lines": [{"line": 1, "forwards": [player(1, position="lw")], "defense": [player(2)]}, {"line_number": "2", "left_wing": player(3), "right_defense": player(4), "left": player(5)}, 7], "extra_players": [player(9)]}, "away_team_lineup": "none"}
    rows = documents.league_lineups(documents.parse_details(spark.createDataFrame([(json.dumps(doc),), ("{broken",), (None,)], "payload string"))).orderBy("pos").collect()
    assert [(r.team, r.is_home, r.line_number, r.position, r.player_number, r.is_starting) for r in rows] == [("A B", True, None, "G", "30", True), ("A B", True, 1, "LW", "1", False), ("A B", True, 1, "", "2", False), ("A B", True, 2, "LW", "3", False), ("A B", True, 2, "RD", "4", False), ("A B", True, None, "EXTRA", "9", False)]
    referees = documents.league_referees(documents.parse_details(spark.createDataFrame([(json.dumps({"game_id": "1", "referees": [{"name": "R1", "role": "Head"}, "R2", 5], "linesmen": ["L"]}),)], "payload string"))).orderBy("pos").collect()
    assert [(r.name, r.role) for r in referees] == [("R1", "Head"), ("R2", "Referee"), ("L", "Linesman")]


def test_form_with_state(spark, tmp_path):
    """Late, repeated and out-of-order rows; a second run goes on from the checkpoint; a batch emits what it changes alone."""
    from hockeylake import streaming
    from hockeylake.plans.stream_queries import FORM
    from hockeylake.streaming import state

    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "player long, id long, ts timestamp, season string, v double"
    at = lambda minutes: F.timestamp_seconds(F.lit(1_700_000_000 + 60 * minutes))

    def arrive(*rows):
        df = None
        for player, ident, minutes, value in rows:
            one = spark.createDataFrame([(player, ident, value)], "player long, id long, v double").select("player", "id", at(minutes).alias("ts"), F.lit("s").alias("season"), "v")
            df = one if df is None else df.unionByName(one)
        df.coalesce(1).write.mode("append").parquet(source)

    def run():
        form = state.rolling_form(streaming.read_stream(spark, source, schema), "player", "id", "ts", "season", "v", n=2, late_seconds=600)
        streaming.run_available(form, checkpoint, streaming.append_to(out))
        return {r.id: (r.average, r.season_total, r.season_games, r.late) for r in state.latest(spark, out, FORM, ["id"]).collect()}

    arrive((1, 1, 0, 1.0), (1, 3, 2, 3.0), (2, 9, 0, None))
    assert run() == {1: (1.0, 1.0, 1, False), 3: (2.0, 4.0, 2, False), 9: (0.0, 0.0, 1, False)}
    arrive((1, 2, 1, 2.0), (1, 3, 2, 3.0))
    assert run() == {1: (1.0, 1.0, 1, False), 2: (1.5, 3.0, 2, False), 3: (2.5, 6.0, 3, False), 9: (0.0, 0.0, 1, False)}
    last = spark.read.schema(FORM + ", batch long").parquet(out).filter("batch = 1")
    assert sorted(r.id for r in last.collect()) == [2, 3]
    arrive((1, 4, 60, 4.0))
    run()
    arrive((1, 5, 1, 5.0), (1, 6, 3, 6.0))  # the first is too late: what it would come between has been let go
    got = run()
    assert got[5] == (None, None, None, True) and got[6] == (4.5, 12.0, 4, False) and got[4] == (5.0, 16.0, 5, False)
    compacted = str(tmp_path / "compacted")
    state.compact(spark, out, FORM, ["id"], compacted)
    assert state.latest(spark, compacted, FORM, ["id"]).count() == 7


def test_inserts_with_state(spark, tmp_path):
    from hockeylake import streaming
    from hockeylake.streaming import state

    state.use_keyed_state(spark)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    have = spark.createDataFrame([(1, "old")], "k long, v string")
    for rows in ([(1, "a"), (2, "a"), (2, "a"), (None, "a")], [(2, "b"), (3, "b"), (None, "b")]):
        spark.createDataFrame(rows, "k long, v string").coalesce(1).write.mode("append").parquet(source)
        streaming.run_available(state.inserted(streaming.read_stream(spark, source, "k long, v string"), ["k"], have), checkpoint, streaming.append_to(out))
    assert sorted(map(str, (tuple(r) for r in spark.read.schema("k long, v string").parquet(out).select("k", "v").collect()))) == ["(2, 'a')", "(3, 'b')", "(None, 'a')"]


class _Kept:
    """State of one key that notes what is written to it."""

    def __init__(self):
        self.rows, self.put_rows, self.appended = [], [], []

    def getListState(self, *_):
        return self

    def getMapState(self, *_):
        return type("Sums", (), {"iterator": lambda _: iter(()), "updateValue": lambda *_: None})()

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows = list(rows)
        self.put_rows.append(self.rows)

    def appendList(self, rows):
        self.rows = self.rows + list(rows)
        self.appended.append(list(rows))


def test_state_of_a_form_is_not_written_again_while_all_of_it_stays():
    from hockeylake.streaming import state

    kept, form = _Kept(), state._Form(2, 600, None)
    form.init(kept)
    row = lambda at, i: {"at": at, "id": i, "season": "a", "value": float(i)}
    assert [tuple(r)[1:3] for r in form.handleInputRows(("p",), iter([row(10, 1), row(30, 3)]), None)] == [(1, 1.0), (3, 2.0)]
    assert [tuple(r)[1:] for r in form.handleInputRows(("p",), iter([row(20, 2), row(30, 3)]), None)] == [(2, 1.5, 3.0, 2, False), (3, 2.5, 6.0, 3, False)]
    assert [len(x) for x in kept.appended] == [2, 1] and not kept.put_rows
    assert not list(form.handleInputRows(("p",), iter([row(20, 2)]), None)) and len(kept.appended) == 2


def test_documents_of_games_are_written_by_many_tasks(spark):
    from hockeylake.plans import document_queries

    for made in (document_queries._games, document_queries._details):
        assert len(made(spark, "/root/testdata/sf0.001").inputFiles()) > 1


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_columns_of_pages_and_media_summaries_are_made_once(spark):
    pages = spark.createDataFrame([(1, "<th>2024-01-02</th>")], "page_id long, html string").repartition(2)
    plan = _plan(reports.page_games(pages))
    assert plan.count("/Game/Events/") == 1
    lines = reports.report_lines(spark.createDataFrame([(1, "media_summary", "x")], "game_id long, report_type string, text string").repartition(2))
    assert _plan(reports.media_summary(lines)).count("^-?\\d)") == 1


def test_line_ups_are_taken_out_of_a_document_once(spark):
    docs = spark.createDataFrame([(json.dumps({"game_id": "1"}),), (None,)], "payload string").repartition(2)
    assert _plan(documents.league_lineups(documents.parse_details(docs))).count("variant_get(raw") == 2


def test_known_keys_of_an_insert_are_written_once(spark, monkeypatch):
    from hockeylake.plans import stream_queries

    class Seen(Exception):
        pass

    read = []

    def note(stream, keys, have):
        read.extend(have.inputFiles())
        raise Seen

    monkeypatch.setattr(stream_queries.state, "inserted", note)
    with pytest.raises(Seen):
        stream_queries.stream_keyed_insert(spark, "/root/testdata/sf0.001")
    assert read and not any("events.parquet" in f for f in read)
