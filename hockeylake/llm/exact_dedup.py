"""Exact duplicates by content-defined chunk recipes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hockeylake.llm.common import ASCII_LOWER, intermediates, keep, one_per_group, stash, texts

_GEAR = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Bytes that are hashed at once.
_BLOCK = 1 << 20


def chunk_ends(data: bytes, mean: int = 2048, least: int = 256, most: int = 16384) -> list[int]:
    """Ends of the content-defined chunks of ``data``: a boundary depends on the 32 bytes before it alone.

    Empty data has no chunk. Every chunk has at most ``most`` bytes, and all but the last at least ``least``.
    """
    n = len(data)
    if n <= least:
        return [n] if n else []
    cuts = []
    for first in range(0, n, _BLOCK):
        before = min(first, 31)
        h = _GEAR[np.frombuffer(data, dtype=np.uint8, count=min(n - first, _BLOCK) + before, offset=first - before)]
        span = 1
        while span < 32:  # h[i] = sum of g[i - k] << k over the last 2 * span bytes
            shifted = h[:-span] << np.uint64(span)
            h[span:] += shifted
            span *= 2
        cuts += (np.flatnonzero((h[before:] >> np.uint64(20)) % np.uint64(mean) == 0) + first + 1).tolist()
    ends, start = [], 0
    for cut in [*cuts, n]:
        while cut - start > most:
            start += most
            ends.append(start)
        if cut - start >= least or (cut == n and cut > start):
            start = cut
            ends.append(cut)
    return ends


def _recipes(batches: Iterator[pa.RecordBatch], mean: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sizes, shas, recipes, checks = batch.column(0), [], [], [], []
        for text in texts(batch, 1):
            data = text.translate(ASCII_LOWER)
            start, recipe, check = 0, [], []
            for end in chunk_ends(data, mean):
                piece = data[start:end]
                recipe.append(xxhash.xxh3_64_intdigest(piece))
                check.append(hashlib.blake2b(piece, digest_size=16).digest() + (end - start).to_bytes(4, "big"))
                start = end
            sizes.append(len(data))
            shas.append(hashlib.sha256(data).hexdigest())
            recipes.append(np.array(recipe, dtype=np.uint64).astype(">u8").tobytes())
            checks.append(b"".join(check))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes, pa.int64()), pa.array(shas, pa.string()), pa.array(recipes, pa.binary()), pa.array(checks, pa.binary())],
            names=["doc_id", "n_bytes", "text_sha256", "recipe", "checks"],
        )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen = set()
        for recipe, checks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seen.update((recipe[8 * i : 8 * i + 8], checks[20 * i : 20 * i + 20]) for i in range(len(recipe) // 8))
        rows = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], names=["chunk", "check"])


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mean_chunk: int = 2048) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, keep_id, group_size, kept, text_sha256)``.

    Texts are equal when identical after lower-casing A-Z only; the row with the largest id stays.

    Method: each text is cut at content-defined boundaries and becomes a recipe, the ordered list of
    its chunks' short identifiers. Chunks are deduplicated to one row per identifier, where a
    128-bit digest and the length verify that one content alone bears it. Recipes are then compared
    as ordered lists: the shuffles move 8 bytes a chunk, never a text. Documents with a chunk whose
    identifier failed the verification (two contents, one identifier) carry that chunk's verified
    digest in its recipe instead.

    A null text counts as empty, and all empty texts are equal. A row with null id is compared like
    any other and stays only if no row of its group has an id. Repeated rows share their verdict.
    An empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    with intermediates(docs.sparkSession):
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        recipes = stash(
            rows.mapInArrow(lambda it: _recipes(it, mean_chunk), "doc_id long, n_bytes long, text_sha256 string, recipe binary, checks binary"),
            "recipes",
        )
        clashes = stash(
            recipes.filter("n_bytes > 0")
            .select("recipe", "checks")
            .mapInArrow(_chunks, "chunk binary, check binary")
            .groupBy("chunk")
            .agg(F.min("check").alias("low"), F.max("check").alias("high"))
            .filter("low != high")
            .select("chunk"),
            "clashes",
        )
        key = F.col("recipe")
        if not clashes.isEmpty():  # about one run in a million at 10^13 chunks would see any
            at = recipes.select("doc_id", "recipe", F.explode(F.sequence(F.lit(0), F.length("recipe") / 8 - 1)).alias("i")).filter(F.length("recipe") > 0)
            hit = at.select("recipe", F.expr("substring(recipe, 8 * i + 1, 8)").alias("chunk")).join(clashes, "chunk", "left_semi").select("recipe").distinct()
            recipes = stash(recipes.join(hit.withColumn("hit", F.lit(True)), "recipe", "left"), "recipes")
            key = F.when(F.col("hit"), F.concat("recipe", "checks")).otherwise(F.col("recipe"))
        keyed = recipes.select("doc_id", "n_bytes", "text_sha256", key.alias("recipe"))
        groups = stash(keyed.groupBy("n_bytes", "recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1"), "groups")
        # Only rows with a partner join; a group of a third of all rows is split by adaptive execution.
        verdict = keyed.join(groups, ["n_bytes", "recipe"], "left").select(
            "doc_id",
            F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
            "text_sha256",
        )
        return keep(verdict, "verdict")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each text, that with the largest id; columns unchanged.

    Rows are told apart by more than their id: of rows that share id and text one stays, and rows that share an id alone stay or go
    each by its own text. A row with null id stays if no row of its text has an id. Null texts are equal to empty ones.
    """
    return one_per_group(docs, id_col, lambda rows, key: exact_duplicates(rows, key, text_col).select("doc_id", "keep_id"), largest=True)
