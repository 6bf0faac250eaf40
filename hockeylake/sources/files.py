"""Readers of documents, reports, tables and text files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hockeylake.functions import path_date, path_season

DOCUMENT = "key string, game_date string, season string, payload string"


def read_documents(spark: SparkSession, path: str, pattern: str = "*.json", skip: tuple[str, ...] = ("games_summary.json",)) -> DataFrame:
    """``(key, game_date, season, payload)``: one row a file below ``path``, with what its path says."""
    raw = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
    key = F.col("_metadata.file_path")
    raw = raw.select(key.alias("key"), F.col("value").alias("payload"))
    return raw.filter(~F.element_at(F.split("key", "/"), -1).isin(*skip)).select("key", path_date(F.col("key")).alias("game_date"), path_season(F.col("key")).alias("season"), "payload")


def read_season_documents(spark: SparkSession, path: str, depth: int | None = None, pattern: str = "*.json") -> DataFrame:
    """``(key, season, payload, doc)`` of the season documents below ``path``, each key once, in order of keys; those that don't parse are left out.

    The season is the first eight digits that begin with 20 in the key, else what follows its last underscore. With ``depth`` only
    files so many folders below ``path`` count, 0 for those in it.
    """
    docs = _texts(spark, path, pattern)
    name = F.regexp_replace(F.element_at(F.split("key", "/"), -1), r"\.json$", "")
    season = F.coalesce(F.nullif(F.regexp_extract("key", r"(20\d{6})", 1), F.lit("")), F.element_at(F.split(name, "_"), -1))
    if depth is not None:
        top = path.rstrip("/").rpartition("/")[2]
        docs = docs.filter(F.size(F.split(F.regexp_extract("key", rf"/{top}/(.*)$", 1), "/")) == depth + 1)
    docs = docs.withColumn("season", season).withColumn("doc", F.try_parse_json("payload")).filter("doc IS NOT NULL")
    return docs.dropDuplicates(["key"]).orderBy("key").select("key", "season", "payload", "doc")


#: Where the files of each dimension lie below the root: pattern of paths, and one that is tried where it finds nothing.
DIMENSIONS = {
    "teams": ("basic/teams/all_teams.json", None), "players": ("basic/players/all_players.json", None), "players_by_team": ("basic/players/players_by_team.json", None), "countries": ("misc/countries.json", None),
    "rosters": ("basic/teams/rosters/*/*.json", "basic/teams/*roster*.json"), "schedule": ("basic/schedule/*.json", None), "game_ids": ("helpers/*.json", None), "glossary": ("misc/glossary.json", None),
    "draft": ("misc/draft_year_and_rounds.json", None), "playoffs": ("playoffs/*_bracket.json", None),
}
REQUIRED = ("teams", "players", "players_by_team")


def _texts(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    raw = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
    return raw.select(F.col("_metadata.file_path").alias("key"), F.col("value").alias("payload"))


def read_dimension_documents(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """``(key, season, payload, doc)`` for each dimension, by name; ``doc`` is null for a document that doesn't parse.

    The season of a roster is its folder's name, of others what the key says. Optional files that are absent give an empty table, and a root
    without teams or players raises.
    """
    jvm = spark.sparkContext._jvm
    at = lambda p: jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{p}")
    fs = at("x").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    for name, patterns in DIMENSIONS.items():
        found = next((p for p in patterns if p and len(fs.globStatus(at(p)) or ())), None)
        if found is None and name in REQUIRED:
            raise FileNotFoundError(f"{root}/{patterns[0]}")
        raw = spark.read.option("wholetext", True).text(at(found).toString()).select(F.col("_metadata.file_path").alias("key"), F.col("value").alias("payload")) if found else spark.createDataFrame([], "key string, payload string")
        folder = F.element_at(F.split("key", "/"), -2)
        out[name] = raw.select("key", (folder if name == "rosters" else path_season(F.col("key"))).alias("season"), "payload", F.try_parse_json("payload").alias("doc"))
    return out


def list_tables(spark: SparkSession, root: str) -> list[str]:
    """Names of the Parquet tables that lie in a folder, files or folders."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(root)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(n.removesuffix(".parquet") for n in names if n.endswith(".parquet"))


def split_rejects(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(documents with their parsed variant, (key, error) of those that don't parse)``."""
    parsed = docs.withColumn("doc", F.try_parse_json("payload"))
    return parsed.filter("doc IS NOT NULL"), parsed.filter("doc IS NULL").select("key", F.lit("not a JSON document").alias("error"))


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one where there is none."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def union_by_name(frames: list[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Tables with other columns and types as one: columns by name, missing ones null, types widened to text where they differ, or cast to ``schema``."""
    if schema is not None:
        frames = [f.select(*(F.col(s.name).try_cast(s.dataType).alias(s.name) if s.name in f.columns else F.lit(None).cast(s.dataType).alias(s.name) for s in schema)) for f in frames]
    else:
        kinds: dict[str, set[str]] = {}
        for f in frames:
            for name, kind in f.dtypes:
                kinds.setdefault(name, set()).add(kind)
        differ = {n for n, k in kinds.items() if len(k) > 1}
        frames = [f.select(*(F.col(c).cast("string").alias(c) if c in differ else F.col(c) for c in f.columns)) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, blanks as null."""
    return spark.read.option("header", True).option("inferSchema", False).option("nullValue", "").csv(path)


def index_games(index: DataFrame) -> DataFrame:
    """Games of a day index ``(game_date, games array)``, without those that have no id."""
    return index.select("game_date", F.explode("games").alias("g")).select("game_date", "g.*").filter("game_id IS NOT NULL")


def with_details(index: DataFrame, details: DataFrame) -> DataFrame:
    """Detail rows of the indexed games; a blank league id comes from the index."""
    i = index.select("game_id", F.col("league_id").alias("_league"))
    return details.join(i, "game_id").withColumn("league_id", F.coalesce(F.nullif("league_id", F.lit("")), F.col("_league"), F.lit(""))).drop("_league")


#: Kinds of reports, as they stand in file names; the first that occurs counts.
REPORT_TYPES = ("game_summary", "official_game_report", "team_roster", "line_up", "media_summary")


def report_type(path):
    out = F.when(F.lit(False), F.lit(""))
    for kind in REPORT_TYPES:
        out = out.when(F.contains(path, F.lit(kind)), kind)
    return out


def report_catalog(paths: DataFrame, path: str = "path", game: str = "game_id") -> DataFrame:
    """The last file by name of each game and report type; files of no known type are left out."""
    return paths.select(game, report_type(F.col(path)).alias("report_type"), F.col(path).alias("path")).filter("report_type IS NOT NULL").groupBy(game, "report_type").agg(F.max("path").alias("path"))


def latest_by_key(df: DataFrame, keys: list[str], day: str, *ties: str) -> DataFrame:
    """The first row by date of each key."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(day, *ties))).filter("_r = 1").drop("_r")


def prefix_counts(paths: DataFrame, path: str = "path", depth: int = 3) -> DataFrame:
    """``(prefix, level, n)``: files below every folder, down to ``depth``."""
    parts = F.split(path, "/")
    levels = F.sequence(F.lit(1), F.least(F.lit(depth), F.size(parts) - 1))
    return (
        paths.filter(F.size(parts) > 1)
        .select(F.explode(F.transform(levels, lambda i: F.struct(F.array_join(F.slice(parts, 1, i), "/").alias("prefix"), i.cast("bigint").alias("level")))).alias("p"))
        .groupBy("p.prefix", "p.level")
        .agg(F.count("*").alias("n"))
    )


def read_catalog_table(spark: SparkSession, name: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """A table or view of the session catalog, as its current version is when it is read; a filter and the columns reach its scan. A name that isn't there raises."""
    df = spark.table(name)
    df = df.filter(where) if where else df
    return df.select(*columns) if columns else df
