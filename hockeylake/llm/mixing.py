"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree over blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hockeylake.llm.common import intermediates, keep, stash

_WORDS = r"[^\x20\x09-\x0D]+"
#: Steps of the draws; the first that doesn't divide their number visits each place once.
_PRIMES = (1_000_003, 1_000_033, 1_000_037, 1_000_039)
#: Levels of the tree that one task goes through at once.
_DEPTH = 6


def split_quotas(quotas: np.ndarray, low: int, high: int, seed: int, depth: int = _DEPTH) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(low, high, quotas)`` of the shards ``low`` to ``high - 1``, down to single shards or ``depth`` levels.

    Each node splits its exact quota vector between two halves of its shards by a multivariate-hypergeometric
    draw, marginal by marginal: all shards get equally many blocks, up to one, and their composition is that of
    a random deal of all blocks. The draw depends on the seed and the node alone.
    """
    if high - low == 1 or not depth:
        yield low, high, quotas
        return
    middle = low + (high - low) // 2
    rng = np.random.default_rng((seed, low, high))
    rest = int(quotas.sum())
    need, left = rest * (middle - low) // (high - low), np.zeros_like(quotas)
    for i, q in enumerate(quotas.tolist()):
        rest -= q
        take = need if rest == 0 else (int(rng.hypergeometric(q, rest, need)) if q and need else 0)
        left[i], need = take, need - take
    yield from split_quotas(left, low, middle, seed, depth - 1)
    yield from split_quotas(quotas - left, middle, high, seed, depth - 1)


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """``docs`` with source, size in words and a keyed hash of each row."""
    text = F.col(text_col).cast("string")
    return docs.withColumns({
        "_mix_source": F.col(source_col).cast("string"),
        "_mix_size": F.coalesce(F.regexp_count(text, F.lit(_WORDS)), F.lit(0)).cast("long"),
        "_mix_u": F.xxhash64(F.lit(seed), F.col(id_col).cast("long"), text),
    })


def _told_apart(rows: DataFrame) -> DataFrame:
    """``_sized`` rows of which those that equal another in source, id and text have hashes of their own: the hash of the first with the number of the copy.

    Where no rows repeat, and that is counted, they are what they were. Else they are written, and copies are numbered within each partition and then
    from one partition to the next, so that no task holds all of a row's copies. Which copy has which number is no matter, as they are equal.
    """
    key = ["_mix_source", "_mix_u"]
    often = rows.groupBy(*key).agg(F.count("*").alias("_mix_n")).filter("_mix_n > 1").drop("_mix_n")
    if often.isEmpty():
        return rows
    rows = stash(rows.withColumn("_mix_at", F.monotonically_increasing_id()), "rows")
    same = F.col("_mix_source").eqNullSafe(F.col("_s")) & (F.col("_mix_u") == F.col("_u"))
    copies = rows.select(*key, "_mix_at", F.shiftright("_mix_at", 33).alias("_p")).join(often.toDF("_s", "_u"), same, "left_semi")
    nth = F.row_number().over(Window.partitionBy(*key, "_p").orderBy("_mix_at"))
    copies = stash(copies.withColumn("_nth", nth), "copies")
    before = F.coalesce(F.sum("_k").over(Window.partitionBy(*key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each partition
    parts = copies.groupBy(*key, "_p").agg(F.count("*").alias("_k")).select(F.col("_mix_source").alias("_s"), F.col("_mix_u").alias("_u"), F.col("_p").alias("_q"), before.alias("_before"))
    numbered = copies.join(parts, same & (F.col("_p") == F.col("_q"))).select("_mix_at", (F.col("_nth") + F.col("_before")).alias("_copy"))
    u = F.when(F.col("_copy") > 1, F.xxhash64("_mix_u", "_copy")).otherwise(F.col("_mix_u"))
    return stash(rows.join(numbered, "_mix_at", "left").withColumn("_mix_u", u).drop("_mix_at", "_copy"), "rows")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), total_share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Of ``(source, words, ...)`` with a row for each source, the same with ``rank`` and ``target``, the words to take of it.

    Sources in order of code points, null last, have the weights in turn, and share ``total_share``
    of all words; no target exceeds ``most`` times its source's size, and what is over is shared
    again by weight among the others until none is above. What no source can take is left out. Sources stay
    a table; the driver sees sums and a row for each of its partitions. An empty table gives an empty result.
    """
    spark = sizes.sparkSession
    with intermediates(spark):
        ordered = stash(sizes.orderBy(F.col("source").isNull(), "source").withColumn("_at", F.monotonically_increasing_id()), "sources")
        part = F.shiftright("_at", 33).cast("int")
        counts = {r["p"]: r["n"] for r in ordered.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
        before = [0, *np.cumsum([counts.get(p, 0) for p in range(max(counts, default=0) + 1)]).tolist()]
        rank = F.get(F.array(*map(F.lit, before)), part) + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
        ordered = ordered.withColumn("rank", rank.cast("long")).drop("_at")
        ordered = ordered.withColumn("_weight", F.get(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights)).cast("int")))
        above, unit, full = F.lit(False), 0.0, -1
        while True:
            told = ordered.agg(F.sum("words").alias("all"), F.sum(F.when(above, most * F.col("words"))).alias("taken"), F.sum(F.when(~above, F.col("_weight"))).alias("free"), F.count_if(above).alias("full")).first()
            if told["full"] == full or not told["free"]:
                break
            full = told["full"]
            unit = (total_share * told["all"] - (told["taken"] or 0.0)) / told["free"]
            above = F.col("_weight") * unit > most * F.col("words")
        return keep(ordered.withColumn("target", F.when(above, most * F.col("words")).otherwise(F.col("_weight") * unit).cast("double")).drop("_weight"), "targets")


def _block_draws(rows: DataFrame, weights: tuple[float, ...], total_share: float, most: float, block_docs: int, shards: int | None, shard_bytes: int, text_col: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """``(sources, draws)``: sources with rank, target and number of blocks, and ``(rank, block, drawn)`` where drawn is an array of (pass, shard, upto).

    A draw takes the rows of the block whose hash is at most upto, or all if that is null.
    """
    spark = rows.sparkSession
    with intermediates(spark):
        sized = rows.select("_mix_source", "_mix_size", "_mix_u", F.octet_length(F.col(text_col).cast("string")).alias("bytes"))
        sized = stash(sized.withColumnsRenamed({"_mix_source": "source", "_mix_size": "size", "_mix_u": "u"}), "sized")
        sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs"), F.sum("bytes").alias("bytes")), weights, total_share, most)
        whole = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0).cast("long")
        sources = sources.withColumn("whole", whole).withColumn("part", F.col("target") - F.col("whole") * F.col("words")).withColumn("n_blocks", F.ceil(F.col("docs") / block_docs).cast("long"))
        sources = stash(sources, "sources", up=1)
        if shards is None:
            taken = sources.agg(F.sum(F.col("bytes") * F.col("target") / F.greatest("words", F.lit(1)))).first()[0] or 0
            shards = max(64, -int(-taken // shard_bytes))
        rows = sized.join(sources.select(F.col("source").alias("_source"), "rank", "n_blocks"), F.col("source").eqNullSafe(F.col("_source"))).withColumn("block", F.pmod("u", "n_blocks"))

        blocks = stash(rows.groupBy("rank", "block").agg(F.sum("size").alias("words")).withColumn("super", F.floor(F.col("block") / 1024)), "blocks")
        before = F.coalesce(F.sum("words").over(Window.partitionBy("rank").orderBy("super").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        supers = blocks.groupBy("rank", "super").agg(F.sum("words").alias("words")).select("rank", "super", before.alias("before"))
        upto = F.sum("words").over(Window.partitionBy("rank", "super").orderBy("block"))
        cum = blocks.withColumn("upto", upto).join(supers, ["rank", "super"]).withColumn("upto", F.col("upto") + F.col("before")).join(sources.select("rank", "part", "whole", "n_blocks"), "rank")
        more = F.when(F.col("upto") <= F.col("part"), "all").when(F.col("upto") - F.col("words") < F.col("part"), "edge")
        cum = stash(cum.select("rank", "block", "whole", "n_blocks", more.alias("more"), (F.col("part") - F.col("upto") + F.col("words")).alias("room")), "cumulated")
        # Within the one block at a source's boundary rows are taken in order of their hash, to within half a row.
        edge = rows.join(cum.filter("more = 'edge'").select("rank", "block", "room"), ["rank", "block"])
        edge = edge.withColumn("upto", F.sum("size").over(Window.partitionBy("rank", "block").orderBy("u"))).filter(F.col("upto") - F.col("size") / 2 <= F.col("room"))
        edge = edge.groupBy("rank").agg(F.max("u").alias("cut"))

        # Draws are numbered pass by pass, block by block, and dealt to places by steps that visit each once.
        quotas = cum.groupBy("rank").agg((F.max(F.col("whole") * F.col("n_blocks")) + F.coalesce(F.max(F.when(F.col("more").isNotNull(), F.col("block") + 1)), F.lit(0))).alias("quota")).filter("quota > 0")
        step = F.coalesce(*(F.when(F.col("quota") % p != 0, p) for p in _PRIMES))
        passes = F.concat(F.when(F.col("whole") > 0, F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).otherwise(F.array().cast("array<bigint>")), F.when(F.col("more").isNotNull(), F.array("whole")).otherwise(F.array().cast("array<bigint>")))
        draws = cum.join(quotas, "rank").join(edge, "rank", "left").select("rank", "block", "n_blocks", "quota", "whole", "more", "cut", step.alias("step"), F.explode(passes).alias("pass"))
        cut = F.when((F.col("pass") == F.col("whole")) & (F.col("more") == "edge"), F.coalesce("cut", F.lit(-(1 << 63))))
        draws = draws.select("rank", "block", "pass", F.pmod((F.col("pass") * F.col("n_blocks") + F.col("block")) * F.col("step"), "quota").alias("place"), cut.alias("upto"))

        def level(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("rank")
            parts = split_quotas(pdf["quota"].to_numpy(), int(pdf["low"].iloc[0]), int(pdf["high"].iloc[0]), seed)
            return pd.concat([pd.DataFrame({"low": low, "high": high, "rank": pdf["rank"].to_numpy(), "quota": q})[q > 0] for low, high, q in parts])

        nodes, span = quotas.select(F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("high"), "rank", "quota"), shards
        while span > 1:  # a task has the quotas of one node: a number for each source
            nodes, span = stash(nodes.groupBy("low").applyInPandas(level, "low long, high long, rank long, quota long"), "quotas"), -(-span // 2**_DEPTH)
        last = F.sum("quota").over(Window.partitionBy("rank").orderBy("low"))
        places = nodes.withColumn("last", last).select("rank", F.col("low").alias("shard"), F.explode(F.sequence(F.col("last") - F.col("quota"), F.col("last") - 1)).alias("place"))
        dealt = draws.join(places, ["rank", "place"]).groupBy("rank", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard", "upto"))).alias("drawn"))
        return sources, stash(dealt, "dealt", up=1)


def _with_draws(rows: DataFrame, sources: DataFrame, dealt: DataFrame) -> DataFrame:
    """``rows`` with ``_mix_drawn``, an array of the (pass, shard, upto) that take them, and their source's words and target."""
    rows = rows.join(sources.select(F.col("source").alias("_mix_s"), F.col("rank").alias("_mix_rank"), F.col("words").alias("_mix_words"), F.col("target").alias("_mix_target"), F.col("n_blocks").alias("_mix_n")), F.col("_mix_source").eqNullSafe(F.col("_mix_s")))
    dealt = dealt.select(F.col("rank").alias("_mix_r"), F.col("block").alias("_mix_b"), F.col("drawn").alias("_mix_all"))
    rows = rows.join(dealt, (F.col("_mix_rank") == F.col("_mix_r")) & (F.pmod("_mix_u", "_mix_n") == F.col("_mix_b")), "left")
    taken: Column = F.filter("_mix_all", lambda d: d["upto"].isNull() | (F.col("_mix_u") <= d["upto"]))
    return rows.withColumn("_mix_drawn", F.coalesce(taken, F.array().cast("array<struct<pass:bigint,shard:bigint,upto:bigint>>")))


def mixing_plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), total_share: float = 1.5, most: float = 2.0, block_docs: int = 256, shards: int | None = None, shard_bytes: int = 128 << 20, seed: int = 3
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken, n_copies, shards)`` for every row of ``docs``.

    size counts the words of the whole text. n_copies is how often the mix takes the document,
    taken = n_copies * size, and shards lists the output shard of each copy.

    Method: documents fall into blocks of about ``block_docs`` by a keyed hash, within their source.
    A source is drawn whole as often as its target holds its size; of one more pass blocks are drawn
    in order until the target is met, the last of them document by document to within half a
    document. The exact block quotas of all sources are split among the shards by a tree of
    multivariate-hypergeometric draws, and every shard draws disjoint blocks of each source's keyed
    permutation. There are 64 shards, or as many as keep one to about ``shard_bytes`` of text, if ``shards`` doesn't say.

    No task holds a source: prefix sums run over blocks in two levels, and only the one block at a
    source's boundary is ordered by document. Sources are a table like others; the driver sees sums.
    All draws depend on the seed and the rows alone, so reruns agree. A source has fewer than 10^9 blocks.

    Null and blank texts have size 0 and are taken with their block, as 0 words; a null source is a
    source of its own; null ids are rows like others; repeated rows are taken each by itself;
    an empty table gives an empty result. Other columns are not read.
    """
    with intermediates(docs.sparkSession):
        rows = _sized(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source")), "doc_id", "text", "source", seed)
        rows = _told_apart(rows)
        sources, dealt = _block_draws(rows, weights, total_share, most, block_docs, shards, shard_bytes, "text", seed)
        n = F.size("_mix_drawn").cast("long")
        plan = _with_draws(rows.drop("text"), sources, dealt).select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("_mix_source").alias("source"), F.col("_mix_size").alias("size"), F.col("_mix_words").alias("source_size"), F.col("_mix_target").alias("target"),
            (n * F.col("_mix_size")).alias("taken"), n.alias("n_copies"), F.col("_mix_drawn")["shard"].alias("shards"),
        )
        return keep(plan, "plan")


def draw_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), total_share: float = 1.5, most: float = 2.0, block_docs: int = 256, shards: int | None = None, shard_bytes: int = 128 << 20, seed: int = 3
) -> DataFrame:
    """The mix itself: rows of ``docs`` once for each copy, with ``shard`` and ``place``, partitioned by shard and in order of place, a keyed shuffle, within it.

    The copies are those that ``mixing_plan`` counts, rows with null id and repeated rows included; a row
    that the mix does not take is not in it. Method, ties and edge cases are those of ``mixing_plan``. Existing columns shard
    and place are replaced. The result reads stashed tables of blocks, which go with the block of ``intermediates`` around.
    """
    rows = _told_apart(_sized(docs, id_col, text_col, source_col, seed))
    sources, dealt = _block_draws(rows, weights, total_share, most, block_docs, shards, shard_bytes, text_col, seed)
    drawn = _with_draws(rows, sources, dealt).select(*(F.col(c) for c in docs.columns if c not in ("shard", "place")), "_mix_u", F.explode("_mix_drawn").alias("_mix_draw"))
    drawn = drawn.withColumns({"shard": F.col("_mix_draw.shard"), "place": F.xxhash64(F.lit(seed), "_mix_u", F.col("_mix_draw.pass"))}).drop("_mix_u", "_mix_draw")
    return drawn.repartition("shard").sortWithinPartitions("shard", "place", id_col)
