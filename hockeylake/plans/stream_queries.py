"""Streaming jobs run to the end of their input, beside batch SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hockeylake import streaming
from hockeylake.streaming import state
from hockeylake.operators.writes import read_buckets
from hockeylake.plans.adapters import table
from hockeylake.plans.data_queries import scratch
from hockeylake.plans.registry import query

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
PARTS = 4


def _stream(spark, d):
    """The events as files that come one by one. Watermarks need timestamps with a zone."""
    path = scratch(spark, "events")
    events = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartitionByRange(PARTS, "ts").write.parquet(path)
    return streaming.read_stream(spark, path, EVENTS, files_per_trigger=1)


@query("SELECT event_id, user_id, event_type FROM events")
def stream_ingest(spark, d):
    out = scratch(spark, "ingested")
    streaming.run_available(_stream(spark, d).select("event_id", "user_id", "event_type"), scratch(spark, "checkpoint"), streaming.append_to(out))
    return spark.read.option("basePath", out).parquet(out).drop("batch")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_upsert(spark, d):
    out = scratch(spark, "upserted")
    schema = "user_id long, event_type string"
    streaming.run_available(_stream(spark, d).select("user_id", "event_type"), scratch(spark, "checkpoint"), streaming.upsert_to(out, ["user_id", "event_type"], schema))
    return read_buckets(spark, out, schema)


@query("SELECT event_id FROM events WHERE event_type <> 'view'")
def stream_unprocessed(spark, d):
    out = scratch(spark, "unprocessed")
    stream, checkpoint = _stream(spark, d), scratch(spark, "checkpoint")
    for _ in range(2):  # the second run finds all files in the checkpoint
        streaming.run_available(stream.filter("event_type != 'view'").select("event_id"), checkpoint, streaming.append_to(out))
    return spark.read.option("basePath", out).parquet(out).drop("batch")


@query("SELECT DISTINCT user_id, event_type, ts FROM events")
def stream_dedup(spark, d):
    out = scratch(spark, "distinct")
    stream = streaming.deduplicated(_stream(spark, d), ["user_id", "event_type", "ts"], "ts", "40 days").select("user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))
    streaming.run_available(stream, scratch(spark, "checkpoint"), streaming.append_to(out))
    return spark.read.option("basePath", out).parquet(out).drop("batch")


@query("SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_window_counts(spark, d):
    """Append mode: a window is given once, when the watermark has passed it. Events that come again too late are dropped, and a last one in the far future closes all windows."""
    path, out = scratch(spark, "events"), scratch(spark, "windows")
    events = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first = F.lit(events.agg(F.min("ts")).first()[0])
    day = F.floor((F.unix_timestamp("ts") - F.unix_timestamp(first)) / 86400)
    # Files in order of time, and behind them events of the first days again.
    for rows in [events.filter(F.least(F.floor(day / 8), F.lit(PARTS - 1)) == i) for i in range(PARTS)] + [events.filter(day < 5)]:
        rows.coalesce(1).write.mode("append").parquet(path)
    events.limit(1).withColumn("ts", F.col("ts") + F.expr("INTERVAL 10 YEARS")).write.mode("append").parquet(path)
    counts = streaming.window_counts(streaming.read_stream(spark, path, EVENTS, files_per_trigger=1), "ts", "1 hour", "6 hours", ["event_type"])
    counts = counts.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")
    streaming.run_available(counts, scratch(spark, "checkpoint"), streaming.append_to(out))
    return spark.read.option("basePath", out).parquet(out).drop("batch")


@query("SELECT event_id, user_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS value_avg_5 FROM events")
def stream_rolling_form(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-4, 0)
    features = lambda df: df.select("event_id", "user_id", F.round(F.avg("value").over(w), 6).alias("value_avg_5"))
    out, schema = scratch(spark, "form"), "event_id long, user_id long, value_avg_5 double"
    streaming.run_available(_stream(spark, d), scratch(spark, "checkpoint"), streaming.rolling_form_to(out, scratch(spark, "base"), "user_id", schema, features))
    return read_buckets(spark, out, schema)


@query("SELECT DISTINCT user_id, event_type FROM events WHERE NOT (user_id % 10 = 3 AND event_type = 'view')")
def stream_keyed_insert(spark, d):
    """Keys that neither the table has, here of views of every tenth user, nor an earlier batch."""
    state.use_keyed_state(spark)
    out, schema = scratch(spark, "inserted"), "user_id long, event_type string"
    had = scratch(spark, "had")  # written once, or each batch would read all events for it
    table(spark, d, "events").filter("user_id % 10 = 3 AND event_type = 'view'").select("user_id", "event_type").distinct().write.parquet(had)
    have = spark.read.schema(schema).parquet(had)
    streaming.run_available(state.inserted(_stream(spark, d).select("user_id", "event_type"), ["user_id", "event_type"], have), scratch(spark, "checkpoint"), streaming.append_to(out))
    return spark.read.schema(schema).option("basePath", out).parquet(out).drop("batch")


FORM = "entity long, id long, average double, season_total double, season_games long, late boolean"


@query("""SELECT event_id, user_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 4 PRECEDING), 6) AS value_avg_5,
round(sum(value) OVER s, 6) AS month_total, count(*) OVER s AS month_events FROM events WINDOW s AS (PARTITION BY user_id, date_trunc('month', ts) ORDER BY ts, event_id)""")
def stream_keyed_form(spark, d):
    """Every seventh event comes a file later than it should, and every eleventh comes again with the next file."""
    path, out = scratch(spark, "events"), scratch(spark, "form")
    events = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    nth = F.least(F.floor((F.unix_timestamp("ts") - F.unix_timestamp(F.lit(low))) * PARTS / (F.unix_timestamp(F.lit(high)) - F.unix_timestamp(F.lit(low)) + 1)), F.lit(PARTS - 1)).cast("int")
    late = (F.col("event_id") % 7 == 0).cast("int")
    files = F.when(F.col("event_id") % 11 == 0, F.array(nth + late, nth + late + 1)).otherwise(F.array(nth + late))
    parted = events.withColumn("file", F.explode(files))
    for i in range(PARTS + 2):  # files in order of arrival
        parted.filter(F.col("file") == i).drop("file").repartition(2, "user_id").write.mode("append").parquet(path)
    stream = streaming.read_stream(spark, path, EVENTS, files_per_trigger=2).withColumn("month", F.date_format("ts", "yyyy-MM"))
    form = state.rolling_form(stream, "user_id", "event_id", "ts", "month", "value", n=5, late_seconds=(high - low).total_seconds())
    streaming.run_available(form, scratch(spark, "checkpoint"), streaming.append_to(out))
    rows = state.latest(spark, out, FORM, ["id"]).filter("NOT late")
    return rows.select(F.col("id").alias("event_id"), F.col("entity").alias("user_id"), F.round("average", 6).alias("value_avg_5"), F.round("season_total", 6).alias("month_total"), F.col("season_games").alias("month_events"))
