"""Target-distribution importance resampling over hashed n-gram features, interned in an open-addressed table."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hockeylake.llm.common import ASCII_LOWER, intermediates, keep, stash, texts

#: Bytes of words: all but those up to 0x2F, 0x3A-0x60 and 0x7B-0x7F. What is left of ASCII after lower-casing is 0-9 and a-z.
_WORD = np.array([not (b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F) for b in range(256)])
_SPACE, _END = 0x20, 0x0A
#: The primes of the 64-bit xxHash.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
#: Bytes of text that are interned at once.
_BLOCK = 4 << 20


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64_rows(rows: np.ndarray) -> np.ndarray:
    """xxHash64, seed 0, of each row of a matrix of bytes."""
    n, length = rows.shape
    if length >= 32:
        return np.fromiter((xxhash.xxh64_intdigest(r.tobytes()) for r in rows), dtype=np.uint64, count=n)
    acc = np.full(n, _P5 + np.uint64(length), dtype=np.uint64)
    at = 0
    while at + 8 <= length:
        lane = np.ascontiguousarray(rows[:, at : at + 8]).view("<u8").ravel()
        acc = _rotl(acc ^ (_rotl(lane * _P2, 31) * _P1), 27) * _P1 + _P4
        at += 8
    if at + 4 <= length:
        lane = np.ascontiguousarray(rows[:, at : at + 4]).view("<u4").ravel().astype(np.uint64)
        acc = _rotl(acc ^ (lane * _P1), 23) * _P2 + _P3
        at += 4
    for k in range(at, length):
        acc = _rotl(acc ^ (rows[:, k].astype(np.uint64) * _P5), 11) * _P1
    acc = (acc ^ (acc >> np.uint64(33))) * _P2
    acc = (acc ^ (acc >> np.uint64(29))) * _P3
    return acc ^ (acc >> np.uint64(32))


class NgramTable:
    """An open-addressed table of the distinct n-grams of one buffer: keys, places in the buffer, buckets and counts by slot.

    Slots are found by linear probing from the low bits of the key. Equal keys are not trusted: length and bytes are
    compared with those of the n-gram that took the slot, and what differs probes on.
    """

    def __init__(self, buffer: np.ndarray, occurrences: int, buckets: int) -> None:
        self.buffer, self.buckets = buffer, buckets
        size = 1 << max(4, (2 * occurrences).bit_length())  # half of the slots stay free at least
        self.mask = size - 1
        self.key = np.zeros(size, dtype=np.uint64)
        self.start = np.full(size, -1, dtype=np.int64)
        self.length = np.zeros(size, dtype=np.int64)
        self.bucket = np.zeros(size, dtype=np.int64)
        self.count = np.zeros(size, dtype=np.int64)

    def intern(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The slot of each occurrence; new n-grams take one."""
        slots = np.empty(len(starts), dtype=np.int64)
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = order[a:b]
            length = int(lengths[own[0]])
            windows = np.lib.stride_tricks.sliding_window_view(self.buffer, length)
            step = max(1, _BLOCK // length)
            for part in (own[k : k + step] for k in range(0, len(own), step)):
                slots[part] = self._probe(windows, starts[part], length)
        self.count += np.bincount(slots, minlength=len(self.count))
        return slots

    def _probe(self, windows: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        rows = windows[starts]
        keys = xxh64_rows(rows)
        out = np.empty(len(starts), dtype=np.int64)
        left, at = np.arange(len(starts)), (keys & np.uint64(self.mask)).astype(np.int64)
        while len(left):
            free = self.start[at] < 0
            if free.any():
                # Of several that want a slot one gets it: the last that is written.
                self.start[at[free]], self.key[at[free]], self.length[at[free]] = starts[left[free]], keys[left[free]], length
                new = np.unique(at[free])
                data = self.buffer.data
                self.bucket[new] = [zlib.crc32(data[s : s + length]) % self.buckets for s in self.start[new].tolist()]
            same = (self.key[at] == keys[left]) & (self.length[at] == length)
            hit = np.flatnonzero(same)
            same[hit] = (windows[self.start[at[hit]]] == rows[left[hit]]).all(axis=1)
            out[left[same]] = at[same]
            left, at = left[~same], (at[~same] + 1) & self.mask
        return out


def _normalised(data: bytes) -> np.ndarray:
    """Lower-cased words of the texts in ``data``, which end in a line feed each: one blank between words, a line feed after a text."""
    raw = np.frombuffer(data.translate(ASCII_LOWER), dtype=np.uint8)
    word, end = _WORD[raw], raw == _END
    kept = word | end
    kept[1:] |= word[:-1]
    return np.where(word | end, raw, np.uint8(_SPACE))[kept]


def ngrams(buffer: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, lengths, text, words)``: all runs of ``least`` to ``most`` words, the text that each is of, and the words of each text."""
    word = _WORD[buffer]
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text_ends = np.flatnonzero(buffer == _END)
    text = np.searchsorted(text_ends, begins)
    starts, lengths, of = [], [], []
    for n in range(least, most + 1):
        last = np.arange(len(begins) - n + 1) + n - 1 if len(begins) >= n else np.empty(0, dtype=np.int64)
        last = last[text[last] == text[last - n + 1]]
        starts.append(begins[last - n + 1])
        lengths.append(ends[last] - begins[last - n + 1])
        of.append(text[last])
    return np.concatenate(starts), np.concatenate(lengths), np.concatenate(of), np.bincount(text, minlength=len(text_ends))


def _blocks(values: Iterator[bytes]) -> Iterator[bytes]:
    """Whole texts in blocks of about ``_BLOCK`` bytes, each text ended by a line feed."""
    held, size = [], 0
    for v in values:
        held.append(v.replace(b"\n", b" "))
        size += len(v) + 1
        if size >= _BLOCK:
            yield b"\n".join(held) + b"\n"
            held, size = [], 0
    if held:
        yield b"\n".join(held) + b"\n"


def _interned(values: Iterator[bytes], least: int, most: int, buckets: int) -> Iterator[tuple[NgramTable, np.ndarray, np.ndarray, np.ndarray]]:
    """A table a block, with the slot and the text of each occurrence and the words of each text."""
    for data in _blocks(values):
        buffer = _normalised(data)
        starts, lengths, text, words = ngrams(buffer, least, most)
        table = NgramTable(buffer, len(starts), buckets)
        yield table, table.intern(starts, lengths), text, words


def _counted(batches: Iterator[pa.RecordBatch], least: int, most: int, buckets: int) -> Iterator[pa.RecordBatch]:
    totals = np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        for table, *_ in _interned(texts(batch, 0), least, most, buckets):
            used = np.flatnonzero(table.count)
            np.add.at(totals, table.bucket[used], table.count[used])
    live = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(live), pa.array(totals[live])], names=["bucket", "n"])


def _weighed(batches: Iterator[pa.RecordBatch], least: int, most: int, gains) -> Iterator[pa.RecordBatch]:
    gain = gains.value
    for batch in batches:
        sizes, weights, words = [], [], []
        for table, slots, text, n_words in _interned(texts(batch, 1), least, most, len(gain)):
            n = np.bincount(text, minlength=len(n_words))
            total = np.zeros(len(n_words), dtype=np.int64)
            np.add.at(total, text, gain[table.bucket][slots])
            sizes.append(n)
            weights.append(np.where(n > 0, total // np.maximum(n, 1), 0))
            words.append(n_words)
        join = lambda xs: pa.array(np.concatenate(xs) if xs else np.empty(0, dtype=np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), join(sizes), join(weights), join(words)], names=["doc_id", "row", "n_features", "weight", "n_words"])


def bucket_counts(texts_only: DataFrame, least: int, most: int, buckets: int) -> dict[int, int]:
    """How many features of all texts fall in each bucket; a task sends a number for each bucket at most, and so does Spark to the driver."""
    parts = texts_only.mapInArrow(lambda it: _counted(it, least, most, buckets), "bucket long, n long")
    return {r["bucket"]: r["n"] for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def _gumbel(id_col: str, seed: str) -> Column:
    """floor(-1000 ln(-ln u)) of a number u in (0, 1) that depends on the id alone."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def importance_resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", least: int = 1, most: int = 2, buckets: int = 10_000, min_words: int = 20, percent: int = 10, seed: str = "2024"
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` for every row of ``docs``; rank is null for those that are not drawn.

    Features are all runs of ``least`` to ``most`` words, joined by one blank, repeats counted; each falls in the bucket of
    its CRC-32. A bucket's gain says how much more common it is in ``target`` than in ``docs``, with one feature
    added to each bucket of both; a document's weight is the floored mean gain of its features. A keyed Gumbel number, which depends
    on the seed and the id, is added: the highest scores are a draw without replacement by weight. Of the documents with
    ``min_words`` words or more, ``percent`` in a hundred are drawn, ties to the smaller id.

    Method: a task interns the n-grams of 4 MB of whole texts at once in an open-addressed NumPy table (``NgramTable``):
    64-bit xxHash keys, verified by bytes, with bucket and count by slot. The first pass adds counts by slot to counts
    by bucket, the second gathers gains by the slot ids of occurrences. What is broadcast is a number for each of the
    ``buckets``, whatever the corpus holds. The draw is a table of scores: counts by score (as many as there are whole numbers between
    the least and the highest score) give the score at which the draw ends, only rows from there on are sorted, and
    ranks are places in range partitions, so that no task holds all of them.

    Null and wordless texts have no features and weight 0. A null id is scored as an empty one and comes last in ties; repeated rows are drawn
    each, in the order of the table. Empty tables are counts of 0; an empty ``docs`` gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    with intermediates(spark):
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        have, want = (bucket_counts(df, least, most, buckets) for df in (rows.select("text"), target.select(F.col(target_text).cast("string"))))
        s, t = (np.array([c.get(b, 0) for b in range(buckets)], dtype=np.float64) for c in (have, want))
        gain = np.floor(1000.0 * np.log((t + 1.0) * (s.sum() + buckets) / ((s + 1.0) * (t.sum() + buckets)))).astype(np.int64)
        gains = spark.sparkContext.broadcast(gain)
        weighed = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(lambda it: _weighed(it, least, most, gains), "doc_id long, row long, n_features long, weight long, n_words long")
        scored = stash(weighed.withColumn("score", F.col("weight") + _gumbel("doc_id", seed)), "scored")
        gains.destroy()

        counted = scored.filter(F.col("n_words") >= min_words).groupBy("score").agg(F.count("*").alias("n"))
        above = F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0))  # a row for each whole number that is a score
        told = counted.select("score", above.alias("above"), F.sum("n").over(Window.partitionBy()).alias("all")).withColumn("wanted", F.expr(f"{percent} * all div 100"))
        last = told.filter("above >= wanted and wanted > 0").orderBy("above").select("score", "wanted").first()
        undrawn = scored.withColumn("rank", F.lit(None).cast("long"))
        columns = ("doc_id", "n_features", "weight", "score", "rank")
        if last is None:
            return keep(undrawn.select(*columns), "resampled")
        near = (F.col("n_words") >= min_words) & (F.col("score") >= last["score"])
        ordered = scored.filter(near).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row").withColumn("at", F.monotonically_increasing_id())
        ordered = stash(ordered, "ordered")
        part = F.shiftright("at", 33).cast("int")
        counts = {r["p"]: r["n"] for r in ordered.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}  # a row for each partition of the sort
        before = [0, *np.cumsum([counts.get(p, 0) for p in range(max(counts) + 1)]).tolist()]
        rank = (F.get(F.array(*(F.lit(int(b)) for b in before)), part) + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).cast("long")
        drawn = ordered.select("doc_id", "n_features", "weight", "score", F.when(rank <= last["wanted"], rank).alias("rank"))
        return keep(undrawn.filter(~near).select(*columns).unionByName(drawn), "resampled")
