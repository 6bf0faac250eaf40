"""Data quality rules and table profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that stand in several rows, and in how many; null keys are equal to each other."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def unique_status(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row: OK if no key repeats, else FAIL."""
    found = duplicate_keys(df, keys).agg(F.count("*").alias("repeated"))
    return found.select(F.lit(name).alias("check"), "repeated", F.when(F.col("repeated") == 0, "OK").otherwise("FAIL").alias("status"))


def reference_coverage(parents: DataFrame, children: DataFrame, key: str, least: float = 99.0) -> DataFrame:
    """Share of parents that have a child, in percent."""
    have = parents.select(key).distinct().join(children.select(key, F.lit(1).alias("_c")).distinct(), key, "left")
    out = have.agg(F.count("*").alias("parents"), F.count("_c").alias("covered"))
    share = F.round(F.col("covered") * 100.0 / F.nullif("parents", F.lit(0)), 4)
    return out.select("parents", "covered", share.alias("pct"), F.when(share >= least, "OK").otherwise("FAIL").alias("status"))


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, present, total, pct)`` from one aggregation."""
    one = df.agg(F.count("*").alias("total"), *(F.count(c).alias(f"n_{c}") for c in columns))
    return one.select("total", F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("present")) for c in columns))).alias("s")).select(
        "s.column", "s.present", "total", F.round(F.col("s.present") * 100.0 / F.nullif("total", F.lit(0)), 4).alias("pct")
    )


def profile(df: DataFrame, day: str, distinct: list[str]) -> DataFrame:
    """One row: rows, first and last day and numbers of different values; nulls are no values, an empty table has null days."""
    return df.agg(F.count("*").alias("n_rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day"), *(F.countDistinct(c).alias(f"n_{c}") for c in distinct))


def role_counts(df: DataFrame) -> DataFrame:
    """One row: goalies, defenders, forwards and different players; rows without a position are in none, sums of an empty table are null."""
    p = F.col("position")
    return df.agg(*(F.sum((p == k).cast("bigint")).alias(n) for k, n in (("G", "goalies"), ("D", "defenders"), ("F", "forwards"))), F.countDistinct("player_id").alias("players"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    frames = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def game_rules(games: DataFrame) -> DataFrame:
    """``(game_id, failed)``: ids of the rules a game breaks, joined with commas; games that break none are left out."""
    rules = {
        "goals": F.abs(F.col("away_shots") - F.col("home_saves") - F.col("home_score")) > 1,
        "tie": (F.col("home_score") == F.col("away_score")) & (F.col("last_period_type") == "REG"),
        "negative": (F.col("home_score") < 0) | (F.col("away_score") < 0) | (F.col("home_saves") < 0),
        "save_pct": F.abs(F.round(F.col("home_saves") * 100.0 / F.nullif("away_shots", F.lit(0)), 2) - F.col("home_save_pct")) > 0.01,
    }
    failed = F.array_compact(F.array(*(F.when(v, F.lit(k)) for k, v in rules.items())))
    return games.select("game_id", F.array_join(failed, ",").alias("failed")).filter("failed != ''")


def anomalies(games: DataFrame) -> DataFrame:
    """Over 15 goals, no goal in regulation, or saves above the shots."""
    total = F.col("home_score") + F.col("away_score")
    kind = F.when(total > 15, "many_goals").when((total == 0) & (F.col("last_period_type") == "REG"), "no_goal").when(F.col("home_saves") > F.col("away_shots"), "save_pct_over_100")
    return games.select("game_id", kind.alias("anomaly")).filter("anomaly IS NOT NULL")


def warnings(games: DataFrame, period_scores: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """``(game_id, warning)``: untidy text, missing ids, period goals that don't sum to the score, and of ``events`` unknown events and goal types, once each a game."""
    sums = period_scores.groupBy("game_id").agg(F.sum("goals").alias("_sum"))
    g = games.join(sums, "game_id", "left")
    tests = {
        "whitespace": F.col("venue").rlike(r"\t|\x{00a0}| {2,}|^ | $"),
        "no_league_id": F.col("league_id").isNull(),
        "period_sum": F.col("_sum") != F.col("home_score") + F.col("away_score"),
    }
    if events is not None:
        told = events.groupBy("game_id").agg(F.bool_or(F.col("event_type") == "other").alias("_other"), F.bool_or(F.col("goal_type") == "unknown").alias("_unknown"))
        g = g.join(told, "game_id", "left")
        tests |= {"unknown_event": F.col("_other"), "unknown_goal_type": F.col("_unknown")}
    return g.select("game_id", F.explode(F.array_compact(F.array(*(F.when(test, name) for name, test in tests.items())))).alias("warning"))


def share_by(df: DataFrame, group: str, kind: str) -> DataFrame:
    """``(group, kind, n, pct)``: how the kinds of a group's rows are distributed."""
    n = df.groupBy(group, kind).agg(F.count("*").alias("n"))
    total = df.groupBy(group).agg(F.count("*").alias("_total"))
    return n.join(total, group).select(group, kind, "n", F.round(F.col("n") * 100.0 / F.col("_total"), 4).alias("pct"))


def layer_coverage(files: DataFrame, rows: DataFrame, key: str, by: str) -> DataFrame:
    """``(by, n_files, n_bytes, covered, pct)``: documents of the first layer, with ``(key, by, bytes)``, and how many have a row in the second."""
    have = rows.select(key, F.lit(1).alias("_row")).distinct()
    out = files.join(have, key, "left").groupBy(by).agg(F.count("*").alias("n_files"), F.sum("bytes").alias("n_bytes"), F.count("_row").alias("covered"))
    return out.withColumn("pct", F.round(F.col("covered") * 100.0 / F.col("n_files"), 4))


def file_volumes(spark: SparkSession, path: str, depth: int = 1, pattern: str = "*") -> DataFrame:
    """``(prefix, n_files, n_bytes)`` of what lies below a path, by its first ``depth`` folders; contents are not read."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "length")
    top = path.rstrip("/").rpartition("/")[2]
    parts = F.split(F.regexp_extract("path", rf"/{top}/(.*)$", 1), "/")
    prefix = F.array_join(F.slice(parts, 1, F.least(F.lit(depth), F.size(parts) - 1)), "/")
    return raw.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))


def structure_report(volumes: DataFrame, pipelines: DataFrame, counts: DataFrame) -> DataFrame:
    """Source prefixes beside the pipelines that read them and the rows of the tables that these write.

    ``volumes`` has ``(prefix, n_files)``, ``pipelines`` ``(prefix, pipeline, table_name)`` and ``counts`` ``(table_name, n)``. status is ``ok``,
    ``no pipeline`` for files that nobody reads, ``no files`` for a pipeline without any, or ``no rows`` for a table that is absent or empty.
    """
    all_ = volumes.join(pipelines, "prefix", "full").join(counts, "table_name", "left")
    status = F.when(F.col("pipeline").isNull(), "no pipeline").when(F.coalesce("n_files", F.lit(0)) == 0, "no files").when(F.coalesce("n", F.lit(0)) == 0, "no rows").otherwise("ok")
    return all_.select("prefix", F.coalesce("n_files", F.lit(0)).alias("n_files"), "pipeline", "table_name", F.col("n").alias("n_rows"), status.alias("status"))


def table_presence(found: DataFrame, expected: DataFrame, name: str = "table_name") -> DataFrame:
    """``(table_name, status)``: present, missing or unexpected."""
    both = expected.select(name, F.lit(1).alias("_e")).join(found.select(name, F.lit(1).alias("_f")), name, "full")
    return both.select(name, F.when(F.col("_e").isNull(), "unexpected").when(F.col("_f").isNull(), "missing").otherwise("present").alias("status"))


def table_profile(df: DataFrame) -> DataFrame:
    """``(column, kind, n_rows, n_nulls, n_distinct, least, greatest)`` for each column, from one aggregation; distinct values are counted exactly, least and greatest are texts."""
    plain = [f for f in df.schema.fields if not hasattr(f.dataType, "elementType") and not hasattr(f.dataType, "fields") and not hasattr(f.dataType, "keyType")]
    aggregates = [F.count("*").alias("_n")]
    for i, f in enumerate(plain):
        aggregates += [F.count(f.name).alias(f"c{i}"), F.countDistinct(f.name).alias(f"d{i}"), F.min(f.name).cast("string").alias(f"l{i}"), F.max(f.name).cast("string").alias(f"g{i}")]
    rows = F.array(*(F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("kind"), F.col("_n").alias("n_rows"), (F.col("_n") - F.col(f"c{i}")).alias("n_nulls"), F.col(f"d{i}").alias("n_distinct"), F.col(f"l{i}").alias("least"), F.col(f"g{i}").alias("greatest")) for i, f in enumerate(plain)))
    return df.agg(*aggregates).select(F.explode(rows).alias("r")).select("r.*")


def dictionary_markdown(tables: dict[str, DataFrame], comments: dict[str, str] | None = None) -> str:
    """A data dictionary as markdown, from the tables' schemas and the comments of their columns."""
    out = []
    for name, df in sorted(tables.items()):
        out += [f"## {name}", "", (comments or {}).get(name, ""), "", "| column | type | description |", "|-|-|-|"]
        out += [f"| {f.name} | {f.dataType.simpleString()} | {f.metadata.get('comment', '').replace('|', '/')} |" for f in df.schema.fields]
        out.append("")
    return "\n".join(out)


def id_coverage(df: DataFrame, group, key: str) -> DataFrame:
    """By group the rows, those with an id and their share in percent; a null group is a group."""
    return df.groupBy(group).agg(F.count("*").alias("n"), F.count(key).alias("with_id"), F.round(F.count(key) * 100.0 / F.count("*"), 4).alias("pct"))


def error_budget(df: DataFrame, day: str, failed, most: float = 50.0) -> None:
    """Raise if more than ``most`` percent of the dates failed."""
    row = df.groupBy(day).agg(F.max(failed.cast("int")).alias("f")).agg(F.count("*").alias("n"), F.sum("f").alias("f")).first()
    if row["n"] and row["f"] * 100.0 / row["n"] > most:
        raise ValueError(f"{row['f']} of {row['n']} dates failed")


def schema_difference(df: DataFrame, expected: list[str]) -> tuple[list[str], list[str]]:
    """``(missing, unexpected)`` columns."""
    return sorted(set(expected) - set(df.columns)), sorted(set(df.columns) - set(expected))


def schema_difference_rows(spark: SparkSession, df: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows ``(column, side)`` for columns that only the table or only the dictionary has."""
    have = spark.createDataFrame([(c,) for c in df.columns], "column string")
    return expected.join(have, "column", "left_anti").withColumn("side", F.lit("missing")).unionByName(have.join(expected, "column", "left_anti").withColumn("side", F.lit("unexpected")))


def json_key_paths(docs: DataFrame, column: str = "payload", depth: int = 8, ends_of: str | None = None) -> DataFrame:
    """``(path, kind, n)``: each path of keys in the documents, ``[]`` for elements of lists, with its kind and in how many places it stands.

    Documents are parsed once and walked down in the rows that come of them; one row a path and kind leaves each task. Paths go down ``depth`` levels; what has
    members below that is counted at the last with kind ``DEEPER``. Texts that are no JSON, and nulls, are left out. With ``ends_of`` only documents of the least and greatest
    value of that column, as of the first and last season, are read.
    """
    if ends_of:
        value = F.col(ends_of)
        docs = docs.filter((value == docs.agg(F.min(ends_of)).scalar()) | (value == docs.agg(F.max(ends_of)).scalar()))
    none = F.array().cast("array<struct<path:string,v:variant,open:boolean>>")
    rows = docs.select(F.lit("$").alias("path"), F.try_parse_json(column).alias("v"), F.lit(True).alias("open")).filter("v IS NOT NULL")
    node = lambda path, v, open_: F.struct(path.alias("path"), v.alias("v"), open_.alias("open"))

    def members() -> Column:
        keyed = F.transform(F.map_entries(F.try_variant_get("v", "$", "map<string,variant>")), lambda e: node(F.concat("path", F.lit("."), e["key"]), e["value"], F.lit(True)))
        listed = F.transform(F.try_variant_get("v", "$", "array<variant>"), lambda x: node(F.concat("path", F.lit("[]")), x, F.lit(True)))
        return F.when(F.col("open"), F.coalesce(keyed, listed, none)).otherwise(none)

    for _ in range(depth):
        rows = rows.select(F.explode(F.concat(F.array(node(F.col("path"), F.col("v"), F.lit(False))), members())).alias("x")).select("x.*")
    kind = F.regexp_extract(F.schema_of_variant("v"), r"^[A-Z]+", 0)
    kind = F.when(F.col("open") & (F.size(members()) > 0), "DEEPER").otherwise(kind)
    return rows.filter("path != '$'").groupBy("path", kind.alias("kind")).agg(F.count("*").alias("n"))


#: Standard error of the estimated numbers of distinct values, 1.04 / sqrt(2^12), and of ranks of quantiles, about 1.33 %.
HLL_BITS, DISTINCT_ERROR, RANK_ERROR = 12, 0.01625, 0.0133
_NUMERIC = ("byte", "short", "integer", "long", "float", "double", "decimal", "date", "timestamp", "timestamp_ntz")


def profile_parts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A profile that can be merged, one row for each value of ``by`` and column: ``(*by, column, kind, n_rows, n_nulls, hll, kll, least, greatest, samples)``.

    One aggregation over one scan, without a copy of the rows for each column: distinct values are a HyperLogLog sketch, quantiles a KLL sketch (numbers, dates and
    times as seconds), and samples three values chosen by hash. Nested columns are left out. An empty table gives rows of 0 without ``by``, none with it.
    """
    by = by or []
    plain = [f for f in df.schema.fields if f.name not in by and f.dataType.typeName() not in ("array", "map", "struct", "variant", "binary")]

    def number(f) -> Column:
        kind = f.dataType.typeName().split("(")[0]
        if kind == "date":
            return (F.unix_date(f.name) * 86400).cast("double")
        if kind.startswith("timestamp"):
            return F.col(f.name).cast("timestamp").cast("double")
        return F.col(f.name).cast("double") if kind in _NUMERIC else F.lit(None).cast("double")

    aggregates = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(plain):
        text = F.col(f.name).cast("string")
        aggregates += [
            F.count(f.name).alias(f"c{i}"), F.hll_sketch_agg(text, HLL_BITS).alias(f"h{i}"), F.kll_sketch_agg_double(number(f)).alias(f"k{i}"), F.min(f.name).cast("string").alias(f"l{i}"), F.max(f.name).cast("string").alias(f"g{i}"),
            F.array(*(F.min(F.struct(F.xxhash64(text, F.lit(j)).alias("hash"), text.alias("value"))) for j in range(3))).alias(f"s{i}"),
        ]
    rows = F.array(*(
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("kind"), F.col("_n").alias("n_rows"), (F.col("_n") - F.col(f"c{i}")).alias("n_nulls"), F.col(f"h{i}").alias("hll"), F.col(f"k{i}").alias("kll"), F.col(f"l{i}").alias("least"), F.col(f"g{i}").alias("greatest"), F.col(f"s{i}").alias("samples"))
        for i, f in enumerate(plain)
    ))
    grouped = df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)
    return grouped.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def merged_profile(parts: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``(column, kind, n_rows, n_nulls, n_distinct, quantiles, least, greatest, samples)`` of parts of one or several tables, days or runs, as if profiled at once.

    n_distinct and quantiles are estimates (``DISTINCT_ERROR``, ``RANK_ERROR``), all else is exact. least and greatest are the parts' own as texts,
    of numbers and times the smallest and largest by value.
    """
    value = F.coalesce(F.col("least").try_cast("double"), F.unix_seconds(F.col("least").try_cast("timestamp")).cast("double"))
    top = F.coalesce(F.col("greatest").try_cast("double"), F.unix_seconds(F.col("greatest").try_cast("timestamp")).cast("double"))
    ordered = F.col("kind") != "string"
    merged = parts.groupBy("column", "kind").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"), F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("n_distinct"), F.kll_merge_agg_double("kll").alias("kll"),
        F.min_by("least", F.when(F.col("least").isNotNull(), F.struct(F.when(ordered, value), F.col("least")))).alias("least"), F.max_by("greatest", F.when(F.col("greatest").isNotNull(), F.struct(F.when(ordered, top), F.col("greatest")))).alias("greatest"),
        *(F.min(F.col("samples")[j]).alias(f"s{j}") for j in range(3)),
    )
    some = F.col("least").isNotNull() & (F.kll_sketch_get_n_double("kll") > 0)
    found = F.when(some, F.kll_sketch_get_quantile_double("kll", F.array(*map(F.lit, quantiles))))
    return merged.select("column", "kind", "n_rows", "n_nulls", "n_distinct", found.alias("quantiles"), "least", "greatest", F.array_compact(F.array(*(F.col(f"s{j}")["value"] for j in range(3)))).alias("samples"))
