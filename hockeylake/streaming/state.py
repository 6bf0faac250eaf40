"""Rolling form and keyed inserts with state by key: a micro-batch costs its own rows and the state of their keys."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_keyed_state(spark: SparkSession) -> None:
    """State on disk with changelogs: what a key's state costs doesn't depend on the number of keys."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def inserted(stream: DataFrame, keys: list[str], existing: DataFrame | None = None) -> DataFrame:
    """The rows of a stream whose key neither ``existing`` nor an earlier row of the stream has: an insert-only upsert as an append.

    Null keys are keys like others. Of rows of one key in a batch one counts. The keys stay in the state, as they stay in the table.
    """
    if existing is not None:
        same = [stream[k].eqNullSafe(existing[k]) for k in keys]
        stream = stream.join(existing.select(*keys), same, "left_anti")
    return stream.dropDuplicates(keys)


_OUT = Row("entity", "id", "average", "season_total", "season_games", "late")


class _Form(StatefulProcessor):
    """The rows of one entity that late rows may still come between, and sums by season of those before."""

    def __init__(self, n: int, late_seconds: float, ttl_ms: int | None) -> None:
        self.n, self.late, self.ttl = n, late_seconds, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", "at double, id long, season string, value double", self.ttl)
        self.before = handle.getMapState("before", "season string", "total double, games long", self.ttl)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        old = sorted((r[0], r[1], r[2], r[3]) for r in self.rows.get())
        before = {k[0]: (v[0], v[1]) for k, v in self.before.iterator()}
        known, fresh = {r[:2] for r in old}, {}
        for r in rows:
            at, i, value = float(r["at"]), int(r["id"]), r["value"]
            fresh.setdefault((at, i), (at, i, r["season"], 0.0 if value is None or value != value else float(value)))
        # Once something has been let go, a row needs the first row that is kept before it, and as many as its average takes.
        after = old[max(1, self.n - 1) - 1][:2] if before and len(old) >= max(1, self.n - 1) else None
        fresh = {k: v for k, v in fresh.items() if k not in known}
        too_late = sorted(k for k in fresh if after and k < after)
        for k in too_late:
            del fresh[k]
        every = sorted([*old, *fresh.values()])
        sums, changed, since, out = dict(before), set(), -1, []
        for i, row in enumerate(every):
            at, ident, season, value = row
            if (at, ident) in fresh:
                since = i
                changed.add(season)
            total, games = sums.get(season, (0.0, 0))
            sums[season] = total + value, games + 1
            if (since >= 0 and i - since < self.n) or season in changed:
                last = every[max(0, i - self.n + 1) : i + 1]
                out.append((key[0], ident, sum(r[3] for r in last) / len(last), *sums[season], False))
        out += [(key[0], i, None, None, None, True) for _, i in too_late]
        if fresh:
            first = next(i for i, r in enumerate(every) if r[0] >= every[-1][0] - self.late)
            gone, kept = every[: max(0, first - self.n + 1)], every[max(0, first - self.n + 1) :]
            for *_, season, value in gone:
                total, games = before.get(season, (0.0, 0))
                before[season] = total + value, games + 1
                self.before.updateValue((season,), before[season])
            if gone:
                self.rows.put(kept)
            else:  # what is kept already is not written again
                self.rows.appendList(list(fresh.values()))
        return iter([_OUT(*r) for r in out])

    def close(self) -> None:
        pass


def rolling_form(stream: DataFrame, entity: str, ident: str, ts: str, season: str, value: str, n: int = 5, late_seconds: float = 0.0, ttl_ms: int | None = None) -> DataFrame:
    """``(entity, id, average, season_total, season_games, late)``: of each batch the rows that it brings or changes.

    A row's average is that of its entity's last ``n`` values up to it, by time and id; season sums run up to it too. A row that comes out of order
    re-emits those behind it whose window or sums it enters, and no others. State of an entity: its rows of the last ``late_seconds`` up to its newest,
    ``n - 1`` before them, and sums by season of what was before. A row older than that comes out with ``late`` true and without numbers. Repeated rows,
    by time and id, change nothing as long as the first is kept. Null values count as 0; null times, ids and entities are left out; null seasons are one.
    With ``ttl_ms`` the state of entities that get no rows for so long goes.
    """
    use_keyed_state(stream.sparkSession)
    rows = stream.select(F.col(entity).alias("entity"), F.col(ts).cast("timestamp").cast("double").alias("at"), F.col(ident).cast("long").alias("id"), F.coalesce(F.col(season).cast("string"), F.lit("")).alias("season"), F.col(value).cast("double").alias("value"))
    rows = rows.filter("entity IS NOT NULL AND at IS NOT NULL AND id IS NOT NULL")
    kind = f"entity {stream.schema[entity].dataType.simpleString()}, id long, average double, season_total double, season_games long, late boolean"
    return rows.groupBy("entity").transformWithState(_Form(n, late_seconds, ttl_ms), kind, "Update", "ProcessingTime" if ttl_ms else "None")


def latest(spark: SparkSession, path: str, schema: str, keys: list[str]) -> DataFrame:
    """Of what ``append_to`` has written by batch, the last row of each key."""
    rows = spark.read.schema(f"{schema}, batch long").option("basePath", path).parquet(path)
    w = Window.partitionBy(*keys).orderBy(F.desc("batch"))
    return rows.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth", "batch")


def compact(spark: SparkSession, path: str, schema: str, keys: list[str], to: str) -> None:
    """Write the last row of each key to a new place as batch 0, for readers and writers to go on with."""
    latest(spark, path, schema, keys).write.mode("overwrite").parquet(f"{to}/batch=0")
