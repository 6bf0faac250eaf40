"""Structured Streaming jobs: the incremental loads and keyed upserts as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hockeylake.operators.writes import conform, read_buckets, upsert_insert_only, write_buckets


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files below a path, each taken once by the checkpoint of the query that reads it."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Run what is available now, micro-batch by micro-batch."""
    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start().awaitTermination()


def append_to(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch into a folder of its own, so that a batch that is run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={number}")

    return write


def _bucket(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")


def _touched(batch: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """The buckets that a batch has rows of; ``buckets`` at most."""
    return [r["bucket"] for r in batch.select(_bucket(keys, buckets)).distinct().collect()]


def upsert_to(path: str, keys: list[str], schema: str, buckets: int = 16) -> Callable[[DataFrame, int], None]:
    """A sink that inserts the keys it doesn't have; the first row of a key in a batch counts. A repeated batch changes nothing.

    The table is kept in buckets of its keys, and a batch rewrites those alone that it has rows of. Read it with ``read_buckets``.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch = conform(batch, schema).dropDuplicates(keys).persist()
        touched = _touched(batch, keys, buckets)
        if touched:
            old = read_buckets(batch.sparkSession, path, schema, number, touched)
            write_buckets(upsert_insert_only(old, batch, keys).withColumn("bucket", _bucket(keys, buckets)), path, number)
        batch.unpersist()

    return write


def deduplicated(stream: DataFrame, keys: list[str], ts: str, late: str) -> DataFrame:
    """Rows without repeats of a key that come within the lateness; the state is bounded by it."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def window_counts(stream: DataFrame, ts: str, late: str, width: str, by: list[str]) -> DataFrame:
    """Counts in tumbling windows; rows later than ``late`` are dropped in append mode."""
    w = F.window(ts, width)
    return stream.withWatermark(ts, late).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")


def rolling_form_to(path: str, base: str, entity: str, schema: str, features: Callable[[DataFrame], DataFrame], buckets: int = 16) -> Callable[[DataFrame, int], None]:
    """A sink that keeps rolling form, of ``schema``, current: the windows of the entities in a batch are computed again from all their rows.

    ``base`` collects the rows by batch and bucket of entities, of which those that the batch has are read and rewritten alone; late
    games are no matter, since whole histories of the touched entities are read. Read the form with ``read_buckets``.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        touched = _touched(batch, [entity], buckets)
        if touched:
            batch.withColumn("bucket", _bucket([entity], buckets)).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{base}/batch={number}")
            rows = spark.read.option("basePath", base).parquet(base).filter(F.col("bucket").isin(touched)).drop("batch", "bucket")
            entities = batch.select(entity).distinct()
            fresh = conform(features(rows.join(entities, entity, "left_semi")), schema)
            old = read_buckets(spark, path, schema, number, touched).join(entities, entity, "left_anti").select(*fresh.columns)
            write_buckets(old.unionByName(fresh).withColumn("bucket", _bucket([entity], buckets)), path, number)
        batch.unpersist()

    return write
