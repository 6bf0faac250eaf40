"""Column functions on their edge cases."""

from pyspark.sql import functions as F

from hockeylake import functions as fn


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_numbers_and_clocks(spark):
    x = F.col("x")
    rows = [("12",), ("2.7",), ("",), (None,), ("abc",), ("92,31",), ("N/A",), ("0:00",), ("15:30",), ("1:02:03",)]
    got = values(spark, rows, "x string", fn.to_int(x), fn.to_float(x), fn.comma_decimal(x), fn.clock_seconds(x))
    assert [g[0] for g in got] == [12, None, None, None, None, None, None, None, None, None]
    assert got[1][1] == 2.7 and got[5][2] == 92.31 and got[6][2] is None
    assert [g[3] for g in got[7:]] == [0, 930, None]


def test_ratios_are_null_without_a_divisor(spark):
    got = values(spark, [(2, 0), (2, 3600), (None, 60)], "a int, b int", fn.goals_against_average(F.col("a"), F.col("b")), fn.per_60(F.col("a"), F.col("b")))
    assert got == [(None, None), (2.0, 2.0), (None, None)]


def test_text(spark):
    x = F.col("x")
    rows = [("  A \tB   C ",), (None,), ("One",), ("Al Al Smith",), ("J.R. Tol",)]
    got = values(spark, rows, "x string", fn.clean_text(x), fn.first_name(x), fn.rest_of_name(x))
    assert got[0][0] == "A B C" and got[1] == (None, None, None)
    assert [g[2] for g in got[2:]] == ["One", "Al Smith", "Tol"]
    assert values(spark, [("&lt;a&gt; &amp;amp; b",)], "x string", fn.html_unescape(x)) == [("<a> &amp; b",)]


def test_points(spark):
    got = values(spark, [(3, 2, False), (2, 3, True), (2, 3, False), (1, 1, True), (None, 1, True)], "a int, b int, e boolean", fn.points_210(F.col("a"), F.col("b"), F.col("e")))
    assert got == [(2,), (1,), (0,), (None,), (None,)]


def test_classes_and_scores(spark):
    got = values(spark, [(2.5,), (1.0,), (-2.5,), (0.1,), (-9.0,)], "z double", fn.player_class(F.col("z")), fn.severity(F.col("z")))
    assert got == [("breakout", 0.8333), ("hot_streak", 0.3333), ("slump", 0.8333), ("cold_spell", 0.0333), ("slump", 1.0)]
    got = values(spark, [(1.0, 0.0, 0.0), (1.0, 0.0, None), (1.0, 0.0, 2.0)], "a double, b double, s double", fn.zscore(F.col("a"), F.col("b"), F.col("s")))
    assert got == [(0.0,), (0.0,), (0.5,)]


def test_variants(spark):
    df = spark.createDataFrame([('{"a": {"default": "x"}, "b": "y", "l": [1, 2], "s": {"value": {"metric": 3}}}',), ("[7]",), ("{broken",)], "t string").select(F.try_parse_json("t").alias("v"))
    v = F.col("v")
    got = [tuple(r) for r in df.select(fn.localised(v, "a"), fn.localised(v, "b"), F.size(fn.first_list(v, "$.x", "$.l")), fn.measure(v, "s")[0]).collect()]
    assert got[0] == ("x", "y", 2, 3.0)
    assert got[1][2] == 1 and got[2][0] is None
