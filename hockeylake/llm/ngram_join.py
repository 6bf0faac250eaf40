"""N-gram Jaccard join by grouped prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hockeylake.llm.common import ASCII_LOWER, CHUNKS, array_parts, bitmap, in_bitmap, intermediates, keep, one_per_group, stash, sum_arrays, texts
from hockeylake.llm.components import connected_components

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
#: Buckets of the frequency sketch; its 1 byte a bucket is what every executor gets, whatever the corpus holds.
SKETCH = 1 << 20
_MEMO = 150_000
#: Longs of the narrow parity bitmap of every set.
NARROW = 8
NARROWS = [f"b{i}" for i in range(NARROW)]


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M3
    return x ^ (x >> np.uint64(29))


def shingle_hashes(text: bytes, memo: dict, n: int) -> np.ndarray:
    """64-bit hashes of the word n-grams of a text, repeats included; all words as one if fewer than n."""
    words = text.translate(ASCII_LOWER).split()  # bytes.split() splits at 0x20 and 0x09-0x0D
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(n, len(words))
    out = h[: len(h) - width + 1] + np.uint64(width)
    for k in range(1, width):
        out = _mixed(out * _M1) + h[k : len(h) - width + 1 + k] * _M2
    return _mixed(out)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    memo, counts = _WordHash(), np.zeros(SKETCH, dtype=np.int64)
    for batch in batches:
        held = []
        for text in texts(batch, 0):
            held.append(_bucket(shingle_hashes(text, memo, n)))
            if len(held) == 500:
                counts += np.bincount(np.concatenate(held), minlength=SKETCH)
                held = []
        if held:
            counts += np.bincount(np.concatenate(held), minlength=SKETCH)
    if counts.any():
        yield array_parts(counts)


def shingle_levels(rows: DataFrame, n: int) -> np.ndarray:
    """How common the shingles of each hash bucket are, as the base-2 logarithm of the count over twice the mean.

    It covers every shingle of every text. It only orders shingles (rare first), so that any value
    gives right results, and common passages stay out of the prefixes.
    """
    counts = sum_arrays(rows.select("text").mapInArrow(lambda it: _count(it, n), "chunk int, counts binary"), CHUNKS * (SKETCH // CHUNKS))
    typical = max(2.0 * counts.mean(), 8.0)
    return np.ceil(np.log2(np.maximum(counts, 1) / typical)).clip(0, 60).astype(np.uint8)


def _parity(own: np.ndarray, bits: int) -> np.ndarray:
    """Whether an odd number of shingles falls into each of ``bits`` places (a power of two, 8 at least), packed.

    Two such bitmaps differ in no more places than their sets differ in shingles, and halves of a
    bitmap xor to the bitmap of half the length.
    """
    bits = max(bits, 8)
    return np.packbits((np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8))


def _close(batches: Iterator[pa.RecordBatch], part: int, whole: int) -> Iterator[pa.RecordBatch]:
    """Of (a, b, size, size, bitmap, bitmap) the (a, b) whose bitmaps allow a link."""
    for batch in batches:
        keep = []
        for i, (n, m, x, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(2, 6)), strict=True)):
            x, y = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
            while len(x) != len(y):
                x, y = (x, y) if len(x) > len(y) else (y, x)
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            if np.bitwise_count(x ^ y).sum() <= n + m - 2 * ((part * (n + m) + part + whole - 1) // (part + whole)):
                keep.append(i)
        yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))


def _described(batches: Iterator[pa.RecordBatch], n: int, levels, part: int, whole: int) -> Iterator[pa.RecordBatch]:
    """Set sizes, fingerprints, prefixes and parity bitmaps."""
    memo, level = _WordHash(), levels.value
    for batch in batches:
        sizes, prints, groups, prefixes, maps, wides = [], [], [], [], [], []
        for text in texts(batch, 1):
            own = np.unique(shingle_hashes(text, memo, n))
            size = len(own)
            sizes.append(size)
            lv = level[_bucket(own)]
            # own is sorted: the order is (level, hash). At most this many shingles come before the first shared one.
            prefix = own[np.argsort(lv, kind="stable")[: size - -(-part * size // whole) + 1]] if size else own
            prefixes.append(prefix.view(np.int64))
            maps.append(_parity(own, 64 * NARROW).view(">i8"))
            wides.append(_parity(own, 1 << (2 * size - 1).bit_length()).tobytes() if size else None)
            prints.append(xxhash.xxh3_128_digest(own.tobytes()) if size else None)
            groups.append(xxhash.xxh3_128_digest(prefix.tobytes() + size.to_bytes(8, "big")) if size else None)
        ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
        narrow = np.stack(maps) if maps else np.empty((0, NARROW), dtype=">i8")
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(prints, pa.binary()),
                pa.array(groups, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, dtype=np.int64), *prefixes]))),
                *(pa.array(np.ascontiguousarray(narrow[:, k]).astype(np.int64)) for k in range(NARROW)),
                pa.array(wides, pa.binary()),
            ],
            names=["doc_id", "n_shingles", "print", "grp", "prefix", *NARROWS, "wide"],
        )


def _postings(batches: Iterator[pa.RecordBatch], words) -> Iterator[pa.RecordBatch]:
    """Of (gid, n, prefix) a row for each prefix token that another group may have, with its place and the token before it."""
    for batch in batches:
        lengths = np.diff(batch.column(2).offsets.to_numpy())
        tokens = batch.column(2).flatten().to_numpy()
        first = np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = np.arange(len(tokens)) - first
        hit = np.flatnonzero(in_bitmap(words.value, tokens))
        row = np.repeat(np.arange(batch.num_rows), lengths)[hit]
        prior = pa.array(tokens[hit - 1] if len(hit) else tokens[:0], pa.int64(), mask=at[hit] == 0)
        taken = batch.select([0, 1]).take(pa.array(row))
        yield pa.RecordBatch.from_arrays([pa.array(tokens[hit]), taken.column(0), taken.column(1), pa.array(at[hit].astype(np.int32)), prior], names=["token", "gid", "n", "at", "prior"])


def _sets(batches: Iterator[pa.RecordBatch], n: int, wanted) -> Iterator[pa.RecordBatch]:
    memo = _WordHash()
    for batch in batches:
        part = batch.take(pa.array(np.flatnonzero(in_bitmap(wanted.value, batch.column(2).to_numpy()))))
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array([np.unique(shingle_hashes(t, memo, n)).tobytes() for t in texts(part, 1)], pa.binary())], names=["rep", "shingles"]
        )


def _verified(batches: Iterator[pa.RecordBatch], part: int, whole: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            x, y = np.frombuffer(x.as_py(), dtype=np.uint64), np.frombuffer(y.as_py(), dtype=np.uint64)
            both = len(x) + len(y) - len(np.union1d(x, y))
            if whole * both >= part * (len(x) + len(y) - both):
                keep.append(i)
        yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, part: int = 80, whole: int = 100, connected: bool = False, hot: int = 32
) -> tuple[DataFrame, DataFrame]:
    """Exact Jaccard join of the word n-gram sets of all texts; a pair links if intersection / union >= part / whole.

    Returns ``(members, links)``. ``members`` has a row for each row of ``docs``:
    ``(doc_id, n_shingles, rep)``, where rep is the smallest id with the same set, so that copies
    are one class. ``links`` has ``(a, b)`` with a < b between class representatives, each pair once.

    Method (grouped prefix join): shingles are ordered rare first; two sets that link share a shingle
    among the first ``size - need + 1`` of each. Documents with identical prefixes and size are
    collapsed into one group; groups meet on prefix shingles and a pair of groups is dropped by size or
    by the positions of the shared shingle. What is left is expanded to classes, of which parity
    bitmaps drop those pairs whose difference proves too large a set difference, and verified
    against the whole sets. Most prefix shingles are in one group alone: shingles are counted by
    themselves first, and only those of two groups or more take group and place through a shuffle.

    With ``connected`` the links are as many as the components need. The classes of a group, and in
    lists of over ``hot`` groups the groups, first meet one of theirs; then no pair is made whose
    members are known to be connected, and a hot list is not paired with itself but those of its groups
    that are not of its largest component with all. Every pair of sets that might join two
    components is still verified, so that components are the same, and a large group of near
    copies costs about its size.

    Common passages go to the end of the order by a sketch of fixed size over all texts. Pairs are
    made between classes, never between copies. Sets are 64-bit hashes.

    Null or blank texts have empty sets and no links (rep null). Rows with a null id belong to the
    class of their text. Texts with fewer than n words have one shingle, all their words. Repeated
    rows fall in one class. An empty table gives empty results. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    with intermediates(spark):
        with intermediates(spark):
            levels = spark.sparkContext.broadcast(shingle_levels(rows, n))
            told = stash(
                rows.mapInArrow(
                    lambda it: _described(it, n, levels, part, whole), "doc_id long, n_shingles long, print binary, grp binary, prefix array<long>, " + ", ".join(f"{b} long" for b in NARROWS) + ", wide binary"
                ),
                "described",
            )
            levels.destroy()
            named = told.filter("n_shingles > 0 and doc_id is not null")
            groups = keep(named.groupBy("grp").agg(F.min("doc_id").alias("gid"), F.first("n_shingles").alias("n"), F.first("prefix").alias("prefix"), (F.min("print") != F.max("print")).alias("several")), "groups")
            reps = stash(named.groupBy("print").agg(F.min("doc_id").alias("rep"), *(F.first(c).alias(c) for c in ("n_shingles", "grp", *NARROWS, "wide"))), "representatives")
            classes = keep(reps.join(groups.select("grp", "gid", "several"), "grp").select("rep", "gid", "several", F.col("n_shingles").alias("n"), *NARROWS, "wide"), "classes")
            members = stash(told.join(reps.select("print", "rep"), "print", "left").select("doc_id", "n_shingles", "rep"), "members", up=2)

        # Least intersection of two sets that link.
        need = F.expr(f"((x.n + y.n) * {part} + {part + whole - 1}) div {part + whole}")
        may_link = F.expr(f"{whole} * least(x.n, y.n) >= {part} * greatest(x.n, y.n)") & (F.col("x.at") <= F.col("x.n") - need) & (F.col("y.at") <= F.col("y.n") - need)
        # Where the shingles before are the same too, the pair meets at those: one row a run, not one a shingle.
        begins = F.coalesce(F.col("x.prior") != F.col("y.prior"), F.lit(True))
        once = F.expr("x.n < y.n or (x.n = y.n and x.gid < y.gid)")
        as_pair = (F.least("x.gid", "y.gid").alias("g"), F.greatest("x.gid", "y.gid").alias("h"))
        attributes = F.struct("rep", "n", *NARROWS)
        apart = sum(F.bit_count(F.expr(f"x.{b} ^ y.{b}")) for b in NARROWS) <= F.col("x.n") + F.col("y.n") - 2 * need

        sizes = classes.filter("several").groupBy("gid").agg(F.count("*").alias("c"))

        def expanded(pairs: DataFrame) -> DataFrame:
            """The class pairs of pairs of groups that bitmaps allow. The group of fewer classes is expanded first, so that a group of many is met within the join that the bitmaps filter."""
            counted = pairs.join(sizes.toDF("_g", "cg"), F.col("g") == F.col("_g"), "left").join(sizes.toDF("_h", "ch"), F.col("h") == F.col("_h"), "left")
            fewer = F.coalesce("cg", F.lit(1)) <= F.coalesce("ch", F.lit(1))
            pairs = counted.select(F.when(fewer, F.col("g")).otherwise(F.col("h")).alias("g"), F.when(fewer, F.col("h")).otherwise(F.col("g")).alias("h"))
            side = lambda c: classes.select(F.col("gid").alias(f"_{c}"), attributes.alias(c))
            return pairs.join(side("x"), F.col("g") == F.col("_x")).join(side("y"), (F.col("h") == F.col("_y")) & apart).select("x", "y")

        def verified(candidates: DataFrame) -> DataFrame:
            """Those of the class pairs ``(x, y)`` that link."""
            with intermediates(spark):
                few = stash(candidates.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"), (F.greatest("x.n", "y.n") > 32 * NARROW).alias("big")).distinct(), "candidates")
                # Bitmaps of two to four bits a shingle leave little but links to be verified. Small sets have had that by now.
                wide = classes.select("rep", F.struct("n", "wide").alias("w"))
                few = stash(
                    few.filter("big")
                    .join(wide.select(F.col("rep").alias("a"), F.col("w").alias("x")), "a")
                    .join(wide.select(F.col("rep").alias("b"), F.col("w").alias("y")), "b")
                    .select("a", "b", "x.n", F.col("y.n").alias("m"), "x.wide", F.col("y.wide").alias("z"))
                    .mapInArrow(lambda it: _close(it, part, whole), "a long, b long")
                    .union(few.filter("not big").select("a", "b")),
                    "close",
                )
                if few.isEmpty():
                    return keep(few, "links")
                # Sets of the candidates alone: a bitmap keeps nearly all other texts out, and the joins drop its few false hits.
                wanted = stash(few.select(F.col("a").alias("rep")).union(few.select("b")).distinct().withColumn("mixed", F.xxhash64("rep")), "wanted")
                hits = spark.sparkContext.broadcast(bitmap(wanted, "mixed", wanted.count()))
                sets = stash(rows.filter("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id")).mapInArrow(lambda it: _sets(it, n, hits), "rep long, shingles binary"), "sets")
                hits.destroy()
                links = (
                    few.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a")
                    .join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b")
                    .select("a", "b", "sa", "sb")
                    .mapInArrow(lambda it: _verified(it, part, whole), "a long, b long")
                )
                return keep(links.distinct(), "links")  # rows that repeat an id give their links again

        shared = stash(groups.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("c")).filter("c > 1"), "shared")
        some = spark.sparkContext.broadcast(bitmap(shared, "token", shared.count()))
        postings = stash(groups.select("gid", "n", "prefix").mapInArrow(lambda it: _postings(it, some), "token long, gid long, n long, at int, prior long"), "postings")
        some.destroy()
        x, y = postings.alias("x"), postings.alias("y")
        same = F.col("x.token") == F.col("y.token")
        several = classes.filter("several")
        if not connected:
            within = several.select("gid", attributes.alias("x")).join(several.select("gid", attributes.alias("y")), "gid").filter(F.expr("x.rep < y.rep")).filter(apart)
            pairs = stash(x.join(y, same & may_link & begins & once).select(*as_pair).distinct(), "pairs")
            return members, stash(verified(within.select("x", "y").union(expanded(pairs))), "links", up=1)

        # Stars: each class meets the first of its group, each group of a hot list that one of about its size which has the fewest shingles before the list's: of
        # near copies that is the one nearest to what they are copies of, which links with more of them than one at random. Ties are settled at random, in two ways.
        heat = shared.filter(F.col("c") > hot).select("token")
        band = F.floor(F.log("n") / F.log(F.lit(max(whole / part, 1.05)))).alias("band")
        heated = stash(postings.join(heat, "token").select("*", band), "hot")
        pivots = heated.groupBy("token", "band").agg(F.min_by(F.struct("gid", "n", "at"), F.struct("at", F.xxhash64("gid", F.col("token").bitwiseAND(F.lit(1))))).alias("p")).select("token", F.explode(F.array(*(F.col("band") + i for i in (-1, 0, 1)))).alias("band"), "p.*")
        stars = stash(heated.alias("x").join(pivots.alias("y"), same & (F.col("x.band") == F.col("y.band")) & may_link & (F.col("x.gid") != F.col("y.gid"))).select(*as_pair).distinct(), "stars")
        first = several.filter("rep = gid").select("gid", attributes.alias("y"))
        within = several.filter("rep != gid").select("gid", attributes.alias("x")).join(first, "gid").filter(apart)
        links = verified(within.select("x", "y").union(expanded(stars)))
        found = connected_components(links)
        labelled = several.select("rep", "gid", attributes.alias("m")).join(found, F.col("rep") == F.col("node"), "left").select("gid", "m", F.coalesce("component", "rep").alias("label"))
        # A group's label is null where its classes are not all known to be connected.
        label = classes.select("gid", "rep").join(found, F.col("rep") == F.col("node"), "left").groupBy("gid")
        label = stash(label.agg(F.min(F.coalesce("component", "rep")).alias("label"), F.max(F.coalesce("component", "rep")).alias("last")).select("gid", F.when(F.col("label") == F.col("last"), F.col("label")).alias("label")), "label")
        mixed = labelled.join(label.filter("label is null").select("gid"), "gid", "left_semi")
        within = mixed.select("gid", F.col("m").alias("x"), "label").join(mixed.select("gid", F.col("m").alias("y"), F.col("label").alias("_label")), "gid").filter(F.expr("label != _label and x.rep < y.rep")).filter(apart)
        postings = stash(postings.join(label, "gid"), "labelled")
        cold = postings.join(heat, "token", "left_anti")
        heated = stash(postings.join(heat, "token", "left_semi"), "hot")
        differ = F.coalesce(F.col("x.label") != F.col("y.label"), F.lit(True))
        pairs = cold.alias("x").join(cold.alias("y"), same & may_link & begins & once & differ).select(*as_pair)
        # Of a hot list those that are not of its largest component meet all of it.
        largest = heated.groupBy("token", "label").count().filter("label is not null").groupBy("token").agg(F.max_by("label", F.struct("count", "label")).alias("largest"))
        others = heated.join(largest, "token", "left").filter("label is null or label != largest").drop("largest")
        met = others.alias("x").join(heated.alias("y"), same & may_link & begins & differ & (F.col("x.gid") != F.col("y.gid"))).select(*as_pair)
        pairs = stash(pairs.union(met).distinct(), "pairs")
        return members, stash(links.union(verified(within.select("x", "y").union(expanded(pairs)))).distinct(), "links", up=1)


def near_duplicate_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, part: int = 80, whole: int = 100, count_links: bool = False) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``, and ``n_links`` with ``count_links``.

    component_id is the smallest id reachable by links and equal sets, the row's own included. n_links
    counts the linked classes with other sets; that takes all links of a large group of near copies,
    of which components alone need about as many as it has classes. Rows with an empty set stand alone.
    Edge cases are those of ``similar_documents``; a row with null id and no named copy has a null component.
    """
    with intermediates(docs.sparkSession):
        members, links = similar_documents(docs, id_col, text_col, n, part, whole, connected=not count_links)
        of = connected_components(links).select(F.col("node").alias("rep"), "component")
        counted = []
        if count_links:
            both = links.union(links.select("b", "a")).groupBy(F.col("a").alias("rep")).agg(F.count("*").alias("n_links"))
            of, counted = stash(of.join(both, "rep"), "labels"), [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")]
        return keep(members.join(of, "rep", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"), *counted), "components")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """``docs`` with one document of each component, that with the smallest id; columns unchanged.

    Empty texts stay. Rows are told apart by more than their id: rows that share an id, or have none, stay or go each by its own text.
    """
    return one_per_group(docs, id_col, lambda rows, key: near_duplicate_components(rows, key, text_col, n, part, whole).select("doc_id", "component_id"), largest=False)
