"""Which input a run takes: watermarks, year scopes, batches and processed ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CONTROL = "pipeline string, scope string, value string"


def after_watermark(df: DataFrame, control: DataFrame, day: str = "game_date") -> DataFrame:
    """Rows after the date in a control table of one row; all rows if it has none. Rows without a date are left out where there is one.

    The date is a scalar subquery, so that it reaches the scan: of a table partitioned by ``day`` only the partitions after it are read.
    """
    mark = control.agg(F.max("value").cast("date")).scalar()
    return df.filter(mark.isNull() | (F.col(day) > mark))


def from_start(df: DataFrame, start: str, day: str = "game_date") -> DataFrame:
    return df.filter(F.col(day) >= F.lit(start).cast("date"))


def year_scope(df: DataFrame, year: int, last: str | None = None, force: bool = False, day: str = "game_date") -> DataFrame:
    """Rows of a year, after ``last`` if that lies in the year and no full refresh is asked for."""
    out = df.filter(F.year(day) == year)
    return out if force or last is None or int(last[:4]) != year else out.filter(F.col(day) > F.lit(last).cast("date"))


def check_scope(scheduled: bool, year: int | None, last: str | None) -> None:
    """A scheduled run without a year needs a state to go on from."""
    if scheduled and year is None and last is None:
        raise ValueError("no year and no state: load the history first")


def date_batches(df: DataFrame, size: int, day: str = "game_date") -> DataFrame:
    """``(date, batch_no)`` for the distinct dates, so many to a batch. One row a date, so that ordering them is small work."""
    days = df.select(day).distinct()
    return days.withColumn("batch_no", F.floor((F.dense_rank().over(Window.orderBy(day)) - 1) / size))


def first_batch(df: DataFrame, size: int, day: str = "game_date") -> DataFrame:
    """Rows of the first so many distinct dates; rows without a date are left out."""
    days = date_batches(df, size, day).filter("batch_no = 0").select(day)
    return df.join(F.broadcast(days), day, "left_semi")


def unprocessed(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among the processed ones; rows with null key are new."""
    return df.join(done.select(key), key, "left_anti")


def id_batches(df: DataFrame, done: DataFrame, key: str, size: int = 50, most: int | None = None) -> DataFrame:
    """``(key, batch_no)`` of the distinct ids that aren't done, so many to a batch in order of ids, and the first ``most`` batches alone if asked.

    Places come from a sort and the counts of its parts, so that no task holds all ids. Null ids are left out.
    """
    ids = df.select(key).filter(F.col(key).isNotNull()).distinct().join(done.select(key), key, "left_anti").orderBy(key).withColumn("_at", F.monotonically_increasing_id()).persist()
    part = F.shiftright("_at", 33)
    before = ids.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part of the sort
    before = before.select("_p", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    out = ids.withColumn("_p", part).join(F.broadcast(before), "_p").select(key, F.floor(place / size).alias("batch_no"))
    return out if most is None else out.filter(F.col("batch_no") < most)


def processed_after(done: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The ids that are done once a batch has been written: all ids that it asked for, those without a document too."""
    return done.select(key).unionByName(batch.select(key)).distinct()


def backfill(spark: SparkSession, state: str, pipeline: str, years: list[int], job: Callable[[int], None]) -> list[int]:
    """Run ``job`` year by year, in order, and return the years that it ran for; years that the control table has as done are skipped.

    A year is done once its job has ended well; the first that fails ends the run with its error, and a later run goes on there.
    """
    ran = []
    for year in sorted(years):
        if read_state(spark, state, pipeline, str(year)) == "done":
            continue
        job(year)
        advance_state(spark, state, pipeline, "done", str(year))
        ran.append(year)
    return ran


def unknown_matches(df: DataFrame, known: DataFrame, key: str, result: str) -> DataFrame:
    """Matches that have ended and aren't known."""
    return df.filter(F.col(result).isNotNull()).join(known.select(key), key, "left_anti")


def missing_dates(spark: SparkSession, first: str, last: str, done: DataFrame, day: str = "game_date") -> DataFrame:
    """Dates from first to last that aren't done."""
    span = spark.sql(f"SELECT explode(sequence(DATE'{first}', DATE'{last}', INTERVAL 1 DAY)) AS {day}")
    return span.join(done.select(day).distinct(), day, "left_anti")


def pending_details(df: DataFrame, done: DataFrame, key: str, result: str, day: str = "game_date") -> DataFrame:
    """By date the games that have an id and a result, and those of them not done yet."""
    df = df.filter(F.col(key).isNotNull() & F.col(result).isNotNull()).join(done.select(key, F.lit(1).alias("_done")).distinct(), key, "left")
    return df.groupBy(day).agg(F.count("*").alias("found"), F.count(F.when(F.col("_done").isNull(), 1)).alias("new"))


def scope_report(df: DataFrame, last: str, day: str = "game_date") -> DataFrame:
    """By year the rows and dates, before and after the watermark."""
    after = F.col(day) > F.lit(last).cast("date")
    return df.groupBy(F.year(day).cast("bigint").alias("year")).agg(
        F.count("*").alias("n_rows"), F.countDistinct(day).alias("n_dates"), F.count(F.when(after, 1)).alias("rows_after"), F.countDistinct(F.when(after, F.col(day))).alias("dates_after")
    )


def read_state(spark: SparkSession, path: str, pipeline: str, scope: str = "") -> str | None:
    """The value that the last run left in the control table, or none."""
    try:
        rows = spark.read.schema(CONTROL + ", at timestamp").parquet(path).filter((F.col("pipeline") == pipeline) & (F.col("scope") == scope)).orderBy(F.desc("at")).limit(1).collect()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return rows[0]["value"] if rows else None


def advance_state(spark: SparkSession, path: str, pipeline: str, value: str, scope: str = "") -> None:
    """Append the new value; call it after the write has succeeded."""
    spark.createDataFrame([(pipeline, scope, value)], CONTROL).withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)


def fresh_files(spark: SparkSession, path: str, hours: float | None = None, since: str | None = None, force: bool = False) -> bool:
    """Whether a run is due: asked for, or the newest file is younger than so many hours or than the last run."""
    if force:
        return True
    newest = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).agg(F.max("modificationTime").alias("t"))
    due = F.lit(False)
    if hours is not None:
        due = due | (F.col("t") > F.current_timestamp() - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(hours * 3600)))
    if since is not None:
        due = due | (F.col("t") > F.lit(since).cast("timestamp"))
    return bool(newest.select(F.coalesce(due, F.lit(False)).alias("due")).first()["due"])
