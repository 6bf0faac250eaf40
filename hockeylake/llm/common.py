"""What several operators share: the shared folder, cut lineage and bounded sketches."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Translates A-Z to a-z in UTF-8 bytes and leaves every other byte alone.
ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The blocks of ``intermediates`` that are open, innermost last; the first holds what lives as long as the process.
_process: list[tuple[SparkSession, str]] = []
_blocks: contextvars.ContextVar[tuple[list[tuple[SparkSession, str]], ...]] = contextvars.ContextVar("blocks", default=(_process,))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    Where that is unset, a temporary folder is made and set on a local master (tests); on a cluster,
    whose executors would not see it, this raises.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        checkpoint = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = checkpoint.get() if checkpoint.isDefined() else None
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str, up: int = 0) -> str:
    """A path in the shared folder that nobody has used. It belongs to the innermost open block, or with ``up`` to one further out."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    blocks = _blocks.get()
    blocks[max(0, len(blocks) - 1 - up)].append((spark, path))
    return path


def stash(df: DataFrame, name: str, up: int = 0) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again.

    This cuts the lineage: a later stage that loses an executor rereads files instead of
    repeating the work, and both sides of a later join are plain scans, so that adaptive
    execution may split hot keys. The files go with the block that they belong to.
    """
    path = new_path(df.sparkSession, name, up)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep(df: DataFrame, name: str) -> DataFrame:
    """``stash`` a result of the innermost block so that it outlives that block: it belongs to the next one out."""
    return stash(df, name, 1)


@contextlib.contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """A block that owns what is stashed in it: at its end the files are deleted.

    What ``keep`` has written belongs to the block around, at last to the process.
    """
    own: list[tuple[SparkSession, str]] = []
    token = _blocks.set((*_blocks.get(), own))
    try:
        yield
    finally:
        _blocks.reset(token)
        _delete(own)


def _delete(paths: list[tuple[SparkSession, str]]) -> None:
    while paths:
        spark, path = paths.pop()
        try:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # noqa: BLE001  the session is gone, and its cluster cleans the folder
            return


@atexit.register
def _delete_all() -> None:
    _delete(_process)


#: Bits of a bitmap that is broadcast, at most: 2 MiB, whatever the corpus holds.
BITMAP_BITS = 1 << 24


def bitmap(values: DataFrame, column: str, count: int, per_value: int = 16) -> np.ndarray:
    """A bitmap of the long column's low bits, ``per_value`` places a value but ``BITMAP_BITS`` at most.

    Whatever is in ``values`` has its bit set; other values rarely do, or at very large counts often:
    it spares rows a shuffle and decides nothing.
    """
    size = 1 << max(16, min(BITMAP_BITS.bit_length() - 1, (per_value * count).bit_length()))
    bit = values.select(F.col(column).bitwiseAND(F.lit(size - 1)).alias("bit"))
    found = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("bits")).toPandas()
    out = np.zeros(size // 64, dtype=np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def in_bitmap(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For int64 ``values``, whether their bit is set."""
    bit = values.view(np.uint64) & np.uint64(64 * len(words) - 1)
    return ((words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by chunk, row by row: a task holds one array for each of its chunks."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = np.frombuffer(raw.as_buffer(), dtype=np.int64)
            if chunk in totals:
                totals[chunk] += x
            else:
                totals[chunk] = x.copy()
    yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], names=["chunk", "counts"])


def sum_arrays(parts: DataFrame, size: int) -> np.ndarray:
    """Sum rows ``(chunk int, counts binary of int64)`` by chunk in Spark, in two levels; the fixed-size total comes to the driver.

    The first level adds up a chunk's rows in 64 groups of tasks, so that no task reads more than its share of them.
    The result has ``size`` numbers whatever the corpus holds.
    """
    out = np.zeros(size, dtype=np.int64)
    some = parts.repartition("chunk", F.spark_partition_id() % 64).mapInArrow(_summed, "chunk int, counts binary")
    rows = some.repartition("chunk").mapInArrow(_summed, "chunk int, counts binary").collect()
    step = size // CHUNKS
    for row in rows:
        out[row["chunk"] * step : (row["chunk"] + 1) * step] += np.frombuffer(row["counts"], dtype=np.int64)
    return out


def one_per_group(docs: DataFrame, id_col: str, groups: Callable[[DataFrame, str], DataFrame], largest: bool) -> DataFrame:
    """One row of each group of ``docs``: that with the largest or smallest id, null ids last; columns unchanged.

    ``groups(rows, id_col)`` gives ``(id, label)`` for every row. Where ids are unique it is asked about them. Else rows are
    numbered and written first, and it is asked about the numbers: rows that share an id, or have none, are told apart.
    Of rows with equal ids the first written stays.
    """
    counted = docs.select(F.col(id_col).alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    if counted.filter("n > 1 or id is null").isEmpty():
        best = (F.max if largest else F.min)("id")
        told = groups(docs, id_col).toDF("id", "label")
        gone = told.join(told.groupBy("label").agg(best.alias("best"), F.count("*").alias("n")).filter("n > 1"), "label").filter("id != best").select(F.col("id").alias("_gone"))
        return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
    numbered = stash(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    told = groups(numbered, "_row").toDF("_row", "label").join(numbered.select("_row", F.col(id_col).alias("_id")), "_row")
    rank = F.struct(F.col("_id").isNull(), -F.col("_id").cast("long") if largest else F.col("_id").cast("long"), "_row")
    kept = told.groupBy("label").agg(F.min(rank)["_row"].alias("_row"))
    return numbered.join(kept, "_row", "left_semi").drop("_row")


CHUNKS = 32


def array_parts(counts: np.ndarray) -> pa.RecordBatch:
    """A task's counts in the form that ``sum_arrays`` takes."""
    step = len(counts) // CHUNKS
    live = [i for i in range(CHUNKS) if counts[i * step : (i + 1) * step].any()]
    return pa.RecordBatch.from_arrays(
        [pa.array(live, pa.int32()), pa.array([counts[i * step : (i + 1) * step].astype(np.int64).tobytes() for i in live], pa.binary())],
        names=["chunk", "counts"],
    )


def texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    for x in batch.column(column).cast(pa.large_binary()):
        yield x.as_py() or b""


def lower_ascii(col):
    """Lower-case A-Z only, as SQL."""
    return F.translate(col, UPPER, LOWER)
