"""Write modes: partition overwrite, keyed upserts, conformed schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The columns of ``schema`` in its order and types: missing ones null, others left out."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(*((F.col(s.name).try_cast(s.dataType) if s.name in df.columns else F.lit(None).cast(s.dataType)).alias(s.name) for s in schema))


def stringify_nested(df: DataFrame) -> DataFrame:
    """Structs, arrays and maps as JSON text."""
    nested = lambda t: isinstance(t, T.StructType | T.ArrayType | T.MapType)
    return df.select(*(F.to_json(s.name).alias(s.name) if nested(s.dataType) else F.col(s.name) for s in df.schema))


def overwrite_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace the partitions that ``df`` has rows of and leave the others. Null values go to the partition ``unknown``."""
    df = df.withColumn(by, F.coalesce(F.col(by).cast("string"), F.lit("unknown")))
    # Rows of a partition meet in few tasks, a large partition in several: no file per task and date.
    df.hint("rebalance", F.col(by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def overwrite_table(df: DataFrame, path: str, by: str | None = None) -> None:
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(by) if by else w).parquet(path)


def upsert_insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target and the source rows whose key it lacks. Null keys never match, and the source isn't deduplicated; both as in ``NOT EXISTS``."""
    match = None
    t = target.select(*(F.col(k).alias(f"_t_{k}") for k in keys))
    for k in keys:
        one = source[k] == t[f"_t_{k}"]
        match = one if match is None else match & one
    return target.unionByName(conform(source.join(t, match, "left_anti"), target.schema))


def upsert_delete_insert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows replace target rows of equal keys; of a key that repeats in the source all rows stay. Columns that the target lacks are left out.

    Raises if a key column is missing. A null key replaces nothing.
    """
    if missing := set(keys) - set(source.columns) | set(keys) - set(target.columns):
        raise ValueError(f"no key column {sorted(missing)}")
    return target.join(source.select(*keys).distinct(), keys, "left_anti").select(*target.columns).unionByName(conform(source, target.schema))


def upsert_by_parent(target: DataFrame, source: DataFrame, parent: str) -> DataFrame:
    """All rows of the parents in the source are replaced."""
    return upsert_delete_insert(target, source, [parent])


def upsert_insights(target: DataFrame, source: DataFrame) -> DataFrame:
    """Insights not known by id, nor by entity, type and date; within the batch the first by id stays. Two hash joins in place of an OR."""
    other = ["entity_id", "game_date", "entity_type"]
    first = lambda keys: F.row_number().over(Window.partitionBy(*keys).orderBy("insight_id"))
    new = source.withColumn("_a", first(["insight_id"])).filter("_a = 1").withColumn("_b", first(other)).filter("_b = 1").drop("_a", "_b")
    new = new.join(target.select("insight_id"), "insight_id", "left_anti").join(target.select(*other).distinct(), other, "left_anti")
    return target.unionByName(new.select(*target.columns))


def _files(spark: SparkSession, path: str):
    """The file system of a path, and how it names paths."""
    jvm = spark.sparkContext._jvm
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    return at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def recover_table(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path``; one whose replacement was cut short is made whole first.

    Between the two renames of ``replace_table`` the path is absent: then the new table, which was written in full, takes its place,
    or else the old one is put back.
    """
    fs, at = _files(spark, path)
    if not fs.exists(at(path)):
        if fs.exists(at(f"{path}.new/_SUCCESS")):
            fs.rename(at(f"{path}.new"), at(path))
            fs.delete(at(f"{path}.old"), True)
        elif fs.exists(at(f"{path}.old")):
            fs.rename(at(f"{path}.old"), at(path))
    return fs.exists(at(path))


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Write beside a Parquet table and swap folders, for results that read the table they replace.

    A run that ends anywhere within leaves a table that ``recover_table`` finds, the old or the new one; call it before the table is read.
    """
    recover_table(spark, path)
    new, old = f"{path}.new", f"{path}.old"
    fs, at = _files(spark, path)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(new)
    fs.delete(at(old), True)
    if fs.exists(at(path)):
        fs.rename(at(path), at(old))
    fs.rename(at(new), at(path))
    fs.delete(at(old), True)


def current_buckets(spark: SparkSession, path: str, before: int | None = None) -> dict[str, str]:
    """The folder of each bucket's newest version, of those that were written in full (and before one)."""
    fs, at = _files(spark, path)
    found: dict[str, tuple[int, str]] = {}
    for version in fs.listStatus(at(path)) if fs.exists(at(path)) else ():
        folder, name = version.getPath().toString(), version.getPath().getName()
        number = int(name.removeprefix("v="))
        if fs.exists(at(f"{folder}/_SUCCESS")) and (before is None or number < before):
            for bucket in fs.listStatus(version.getPath()):
                key = bucket.getPath().getName()
                if key.startswith("bucket=") and number >= found.get(key, (-1, ""))[0]:
                    found[key] = (number, bucket.getPath().toString())
    return {key: folder for key, (_, folder) in found.items()}


def read_buckets(spark: SparkSession, path: str, schema: str | T.StructType, before: int | None = None, only: list[int] | None = None) -> DataFrame:
    """The rows of a table that ``write_buckets`` keeps, of some buckets alone if asked; without versions an empty one."""
    folders = [f for key, f in sorted(current_buckets(spark, path, before).items()) if only is None or int(key.removeprefix("bucket=")) in only]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def write_buckets(df: DataFrame, path: str, version: int) -> None:
    """Write the buckets in ``df`` (column ``bucket``) as a version of the table; what is in no version yet, or in an older one, stays.

    A version counts once it is written in full, and a repeated one replaces itself: a run that ends anywhere loses nothing. Folders that
    neither this version nor a repeat of it needs are deleted.
    """
    spark = df.sparkSession
    needed = set(current_buckets(spark, path, version).values())
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{path}/v={version}")
    fs, at = _files(spark, path)
    for other in fs.listStatus(at(path)):
        if int(other.getPath().getName().removeprefix("v=")) < version:
            for bucket in fs.listStatus(other.getPath()):
                if bucket.getPath().getName().startswith("bucket=") and bucket.getPath().toString() not in needed:
                    fs.delete(bucket.getPath(), True)


def write_csv(df: DataFrame, path: str) -> None:
    stringify_nested(df).write.mode("overwrite").option("header", True).csv(path)


def comment_table(spark: SparkSession, table: str, comment: str, columns: dict[str, str]) -> None:
    """Put a dictionary's texts on a catalog table."""
    quoted = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spark.sql(f"COMMENT ON TABLE {table} IS {quoted(comment)}")
    for name, text in columns.items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN {name} COMMENT {quoted(text)}")


def keep_first_by_source(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")


def _versions(spark: SparkSession, name: str) -> list[int]:
    """Numbers of the versions of a table that ``replace_in_catalog`` has written, oldest first."""
    database, _, table = name.rpartition(".")
    where = f" IN {database}" if database else ""
    found = (r["tableName"] for r in spark.sql(f"SHOW TABLES{where} LIKE '{table}__v*'").collect())
    return sorted(int(n.rpartition("__v")[2]) for n in found if n.rpartition("__v")[2].isdigit())


def replace_in_catalog(spark: SparkSession, df: DataFrame, name: str, folder: str | None = None, versions: int = 2, partition_by: list[str] | None = None) -> int:
    """Create or replace a table of the session catalog from a query, which may read the table itself, and return its version.

    The rows are written as a table ``<name>__v<n>``; then the view ``<name>`` is put on it, which is one step of the catalog: who reads at any time sees the old rows or
    the new ones, never none, and a run that ends before that leaves the old. The last ``versions`` stay for readers that have begun; older ones, and what
    a run that failed has left, are dropped with their files by the next. ``folder`` is where versions are kept, else the warehouse.
    """
    done = _versions(spark, name)
    number = (done[-1] if done else 0) + 1
    writer = df.write.format("parquet")
    if folder:
        writer = writer.option("path", f"{folder}/v={number}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(f"{name}__v{number}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}__v{number}")
    for old in done[: max(0, len(done) + 1 - versions)]:
        spark.sql(f"DROP TABLE IF EXISTS {name}__v{old}")
        if folder:
            fs, at = _files(spark, folder)
            fs.delete(at(f"{folder}/v={old}"), True)
    return number
