"""Benchmark decontamination by typed templates, in Spark expressions alone.

No pattern here repeats a group: Java matches such loops by recursion, and a text with thousands of
numbers or names in a row would end the JVM's stack. Joiners are marked first by looking at their
neighbours; runs are then plain character classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hockeylake.llm.common import intermediates, keep, stash

NAME, NUMBER, UNIT = "\u0001", "\u0002", "\u0003"
#: Stands for the blank before a capital within and before names.
_JOIN = "\u0004"
#: A capitalised word, or several in a row, not at the start of a sentence.
_NAME = rf"([{_JOIN} ])(?<=\p{{Ll}}{_JOIN}|[\p{{N}},;:] )(\p{{Lu}}[\p{{L}}\p{{M}}{_JOIN}]*)"
#: Stand for separators between digits.
_BETWEEN = {"\\.": "\u0005", ",": "\u0006", ":": "\u0007", "/": "\u0008"}
_NUMBER = r"[\p{N}\x05-\x08]+"
_WORD = rf"[\p{{L}}\p{{M}}]+|{_NUMBER}"
_TOKEN = rf"[\p{{L}}\p{{M}}]+|{NAME}[\p{{L}}\p{{M}}{_JOIN}]*|{NUMBER}{_NUMBER}"
#: Tokens of a text that are taken at once: what is exploded carries so many and no whole text.
SEGMENT = 256
#: Words that are units after a number.
UNITS = tuple(
    "mm cm m km in ft yd mi mile miles meter meters metre metres kilometer kilometers inch inches foot feet yard yards g kg mg t lb lbs oz gram grams "
    "kilogram kilograms pound pounds ounce ounces ton tons l ml liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours "
    "day days week weeks month months year years percent dollar dollars euro euros cent cents usd eur degree degrees c f k v w kw hz khz mhz ghz kb mb gb tb".split()
)




def _numbers_marked(text: Column) -> Column:
    marked = text
    for mark, stand_in in _BETWEEN.items():
        marked = F.regexp_replace(marked, rf"{mark}(?<=\p{{N}}{mark})(?=\p{{N}})", stand_in)
    return F.when(text.rlike(r"\p{N}[.,:/]\p{N}"), marked).otherwise(text)


def _tokens(text: Column) -> Column:
    """Lower-case words; names and numbers with their sign before them."""
    x = F.regexp_replace(text, r" (?<=[\p{L}\p{M}] )(?=\p{Lu})", _JOIN)
    x = F.regexp_replace(x, _NAME, f"$1 {NAME}$2 ")
    x = F.when(text.rlike(r"\p{N}"), F.regexp_replace(_numbers_marked(x), f"({_NUMBER})", f" {NUMBER}$1 ")).otherwise(x)
    return F.regexp_extract_all(F.lower(x), F.lit(_TOKEN), F.lit(0))


def _sign(token: Column) -> Column:
    return F.substring(token, 1, 1)


def _template(tokens: Column) -> Column:
    """Names, numbers, and units after a number as placeholders."""
    turned = F.transform(
        tokens,
        lambda t, i: F.when(_sign(t).isin(NAME, NUMBER), _sign(t)).when(t.isin(*UNITS) & (i > 0) & (_sign(F.get(tokens, i - 1)) == NUMBER), UNIT).otherwise(t),
    )
    return F.when(F.exists(tokens, lambda t: _sign(t).isin(NAME, NUMBER)), turned).otherwise(tokens)


def _folded(text: Column) -> Column:
    """Lower case, in which sharp s is equal to SS, and final sigma to sigma."""
    return F.replace(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def _plain(text: Column) -> Column:
    """Case-folded words and numbers as they stand."""
    return F.regexp_extract_all(_folded(_numbers_marked(text)), F.lit(_WORD), F.lit(0))


def _described(rows: DataFrame, key: str) -> DataFrame:
    """``(key, tokens, template)``."""
    rows = rows.select(key, _tokens(F.coalesce("text", F.lit(""))).alias("tokens"))
    return rows.withColumn("template", _template(F.col("tokens")))


def _segments(rows: DataFrame, arrays: tuple[str, ...], overlap: int, *others: str) -> DataFrame:
    """A row for each ``SEGMENT`` elements of the arrays, with ``overlap`` more of what follows; ``off`` elements come before."""
    some = lambda s: F.struct((s * SEGMENT).alias("off"), *(F.slice(a, s * SEGMENT + 1, F.lit(SEGMENT + overlap)).alias(a) for a in arrays))
    # No filter for empty arrays: it would go below what makes the arrays and have them made twice.
    every = F.when(F.size(arrays[0]) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(arrays[0]) - 1) / SEGMENT).cast("int")), some))
    rows = rows.select(*others, F.explode(every).alias("segment"))
    return rows.select(*others, "segment.*")


def _plain_window(tokens: Column) -> Column:
    """Case-folded words and numbers of tokens, without placeholders."""
    value = lambda t: F.substr(t, F.lit(2), F.length(t))
    return F.flatten(F.transform(tokens, lambda t: F.when(_sign(t) == NAME, F.split(_folded(value(t)), _JOIN)).when(_sign(t) == NUMBER, F.array(value(t))).otherwise(F.array(_folded(t)))))


def _slots(template: Column, tokens: Column) -> Column:
    """``sign + value`` of the placeholders in a window, in order."""
    return F.filter(F.zip_with(template, tokens, lambda t, x: F.when(t == UNIT, F.concat(t, x)).when(t.isin(NAME, NUMBER), x)), lambda x: x.isNotNull())


def _anchored(tokens: Column, n: Column) -> Column:
    """``(l, t, i)``: hash t of the longest three tokens in a row, i tokens after the start."""
    length = lambda i: F.when(F.get(tokens, i).isin(NAME, NUMBER, UNIT), 0).otherwise(F.length(F.get(tokens, i)))
    return F.array_max(F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct((length(i) + length(i + 1) + length(i + 2)).alias("l"), F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)).alias("t"), i.alias("i"))))


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item_id, tokens, template)``; of items that share an id the least text counts."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).filter("item_id is not null")
    return _described(items.groupBy("item_id").agg(F.min("text").alias("text")), "item_id")


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = 8) -> DataFrame:
    """``(item_id, k, hash, n, anchor, ahead, plain_hash, plain_n, plain_anchor, plain_ahead, item_slots, worded, n_windows, n_worded)``: the windows of every item; worded are those that are words by half at least.

    An item with fewer tokens than a window is one window; one with fewer than three tokens has none.
    The anchor of a window is the hash of the longest three tokens in a row, ``ahead`` tokens after its start.
    What is plain is of the window's case-folded words and numbers in place of its template.
    Null texts have no tokens; items with null id are skipped; of items that share an id the least text counts.
    """
    rows = _items(benchmark, id_col, text_col).filter(F.size("template") >= 3).withColumn("n", F.least(F.size("template"), F.lit(window)))
    rows = _segments(rows, ("template", "tokens"), window - 1, "item_id", "n")
    starts = F.least(F.lit(SEGMENT), F.size("template") - F.col("n") + 1)
    rows = rows.filter(starts >= 1).select("*", F.explode(F.sequence(F.lit(1), starts)).alias("at"))
    rows = rows.select("item_id", "n", (F.col("off") + F.col("at")).alias("k"), F.slice("template", F.col("at"), F.col("n")).alias("w"), F.slice("tokens", F.col("at"), F.col("n")).alias("x"))
    words = F.size(F.filter("w", lambda t: ~t.isin(NAME, NUMBER, UNIT)))
    rows = rows.withColumn("worded", 2 * words >= F.col("n")).withColumn("v", _plain_window(F.col("x")))
    rows = rows.withColumn("a", _anchored(F.col("w"), F.col("n"))).withColumn("b", _anchored(F.col("v"), F.size("v")))
    rows = rows.select(
        "item_id", "k", F.col("a.t").alias("anchor"), F.col("a.i").alias("ahead"), F.xxhash64("w").alias("hash"), "n",
        F.col("b.t").alias("plain_anchor"), F.col("b.i").alias("plain_ahead"), F.xxhash64("v").alias("plain_hash"), F.size("v").alias("plain_n"), _slots(F.col("w"), F.col("x")).alias("item_slots"), "worded",
    )
    counts = rows.groupBy("item_id").agg(F.count("*").alias("n_windows"), F.count_if("worded").alias("n_worded"))
    return rows.join(counts, "item_id")


def contaminated_documents(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 8, share: int = 50, broadcast_rows: int = 500_000, any_case: bool = False
) -> DataFrame:
    """``(doc_id, item_id, covered, n_windows)`` of the documents that hold a benchmark item, one row for each such pair.

    Names, numbers and units become typed placeholders, so that a question asked again with other
    values has the same template. All windows of ``window`` template tokens of all texts are
    hash-joined with those of the benchmark, by the longest three tokens of a window and then by the
    window's 64-bit hash, so that windows are built only where such three tokens stand. Where the item has one
    value and the document has several on one alignment of the two, windows that hold this value count
    only if all their values are the item's own; other windows count whatever the slots are elsewhere. A
    pair is reported if the hits that count cover ``share`` percent of the item's windows at least, or
    of those that are words by half. Other windows, which are mostly names, numbers and units, are
    found by their own values in place of templates. An item of one or two tokens has no window: it is
    found where its own words stand in a row, in any case.

    With ``any_case`` a window also counts where its own words, names and numbers stand in any letter
    case; without it a copy in another case, in which other words look like names, may be missed.
    ``covered`` counts templates alone for a pair that is reported by them, else both.

    The benchmark's windows are broadcast if they are at most ``broadcast_rows``, which is counted, else
    shuffled. Only hits are shuffled otherwise. Texts are taken in overlapping segments of tokens, so that cost
    grows with their length.

    Null and empty texts have no window; rows with null id are not reported; rows that share an id
    share a verdict; items with null id are skipped, of items that share an id the least text is used; an empty
    table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    with intermediates(spark):
        items = stash(benchmark_windows(benchmark, window=window), "windows")
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id is not null")
        told = items.agg(F.count("*").alias("n"), F.max("plain_n").alias("longest")).first()
        small = told["n"] <= broadcast_rows
        three = lambda t: F.transform(t, lambda x, i: F.struct(i.alias("p"), F.xxhash64(x, F.get(t, i + 1), F.get(t, i + 2)).alias("anchor")))

        def found(side: DataFrame, slots: Column, *arrays: str) -> DataFrame:
            at, n = F.col("p") + 1 - F.col("ahead"), F.col("n")
            return (
                _segments(_described(rows, "doc_id"), ("template", *arrays), window - 1, "doc_id")
                .select("*", F.explode(three(F.col("template"))).alias("w"))
                .select("*", F.col("w.p").alias("p"), F.col("w.anchor").alias("anchor"))
                .join(F.broadcast(side) if small else side, "anchor")
                .filter((at >= 1) & (at <= SEGMENT) & (at + n - 1 <= F.size("template")))
                .filter(F.xxhash64(F.slice("template", at, n)) == F.col("hash"))
                .select("doc_id", "item_id", "k", "n_windows", "n_worded", (F.col("off") + at - F.col("k")).alias("shift"), slots.alias("slots"))
            )

        def verbatim(side: DataFrame, among: Column) -> DataFrame:
            side = side.select("item_id", "k", "n_windows", "n_worded", "worded", "plain_anchor", "plain_ahead", "plain_hash", "plain_n")
            at, n = F.col("p") + 1 - F.col("plain_ahead"), F.col("plain_n")
            return (
                _segments(rows.filter(among).select("doc_id", _plain(F.col("text")).alias("plain")), ("plain",), told["longest"] - 1, "doc_id")
                .select("*", F.explode(three(F.col("plain"))).alias("w"))
                .select("doc_id", "plain", F.col("w.p").alias("p"), F.col("w.anchor").alias("plain_anchor"))
                .join(F.broadcast(side) if small else side, "plain_anchor")
                .filter((at >= 1) & (at <= SEGMENT) & (at + n - 1 <= F.size("plain")))
                .filter(F.xxhash64(F.slice("plain", at, n)) == F.col("plain_hash"))
                .select("doc_id", "item_id", "n_windows", "n_worded", "k", "worded", F.when(F.col("worded"), "words").otherwise("values").alias("by"))
            )

        at, n = F.col("p") + 1 - F.col("ahead"), F.col("n")
        pairs = F.zip_with("item_slots", _slots(F.slice("template", at, n), F.slice("tokens", at, n)), lambda a, b: F.struct(a.alias("item"), b.alias("doc")))
        # Windows without placeholders keep a plan that is small enough to be compiled; those with some, if the benchmark has any, take a pass of their own.
        hits = found(items.filter("worded").filter(F.size("item_slots") == 0).drop("item_slots"), F.array().cast("array<struct<item:string,doc:string>>"))
        slotted = items.filter(F.size("item_slots") > 0)
        if not slotted.filter("worded").isEmpty():
            hits = hits.unionByName(found(slotted.filter("worded"), pairs, "tokens"))
        # On one alignment there are at most the item's windows, so that what is collected is bounded by the item.
        aligned = hits.groupBy("doc_id", "item_id", "shift").agg(F.collect_set(F.struct("k", "slots")).alias("found"), F.first("n_windows").alias("n_windows"), F.first("n_worded").alias("n_worded"))
        # Item values that meet several document values spoil the windows that hold them, but not those whose values are all the item's own.
        met = F.array_distinct(F.flatten(F.col("found.slots")))
        values = F.transform("met", lambda s: s["item"])
        torn = F.filter(F.array_distinct(values), lambda v: F.size(F.filter("met", lambda s: s["item"] == v)) > 1)
        aligned = aligned.withColumn("met", met).withColumn("torn", F.when(F.size("met") > F.size(F.array_distinct(values)), torn).otherwise(F.array().cast("array<string>")))
        good = F.filter("found", lambda f: ~F.exists(f["slots"], lambda s: F.array_contains("torn", s["item"])) | F.forall(f["slots"], lambda s: s["item"] == s["doc"]))
        counted = aligned.select("doc_id", "item_id", "n_windows", "n_worded", F.explode(F.array_distinct(F.transform(good, lambda f: f["k"]))).alias("k")).withColumn("worded", F.lit(True)).withColumn("by", F.lit("template"))
        if any_case and told["n"]:
            # A text without a name, and without these letters, has the words of its template: there only windows with placeholders can be new.
            counted = counted.unionByName(verbatim(items.filter(F.size("item_slots") == 0), F.col("text").rlike(r"[\p{Ll}\p{N},;:] \p{Lu}|ß|ẞ|SS|Σ")))
        literal = slotted if any_case else slotted.filter(~F.col("worded"))
        if not literal.isEmpty():
            counted = counted.unionByName(verbatim(literal, F.lit(True)))
        n = lambda among, name: F.countDistinct(F.when(among, F.col("k"))).alias(name)
        covered = counted.groupBy("doc_id", "item_id").agg(
            n(F.col("by") != "words", "own"), n((F.col("by") != "words") & F.col("worded"), "own_worded"), n(F.lit(True), "either"), n(F.col("worded"), "either_worded"),
            F.first("n_windows").alias("n_windows"), F.first("n_worded").alias("n_worded"),
        )
        # A question asked again with other values can't meet the windows that are mostly values: the others' share is enough.
        enough = lambda c: (F.col(c) * 100 >= share * F.col("n_windows")) | ((F.col("n_worded") > 0) & (F.col(f"{c}_worded") * 100 >= share * F.col("n_worded")))
        held = covered.filter(enough("either")).select("doc_id", "item_id", F.when(enough("own"), F.col("own")).otherwise(F.col("either")).alias("covered"), "n_windows")
        # Items without a window: their words in a row anywhere in a document, met by the first of them.
        short = _items(benchmark, "item_id", "text").filter(F.size("template").between(1, 2)).select("item_id", _plain_window(F.col("tokens")).alias("own")).filter(F.size("own") > 0)
        short = stash(short.withColumn("first", F.get("own", F.lit(0))), "short")
        n_short, reach = short.agg(F.count("*"), F.coalesce(F.max(F.size("own")), F.lit(1))).first()
        if n_short:
            plain = _segments(rows.select("doc_id", _plain(F.col("text")).alias("plain")), ("plain",), reach - 1, "doc_id")
            words = plain.select("doc_id", "plain", F.explode(F.transform("plain", lambda w, i: F.struct(w.alias("first"), (i + 1).alias("at")))).alias("w")).select("doc_id", "plain", "w.*")
            met = words.join(F.broadcast(short) if n_short <= broadcast_rows else short, "first").filter(F.slice("plain", F.col("at"), F.size("own")) == F.col("own"))
            held = held.unionByName(met.select("doc_id", "item_id", F.lit(1).cast("long").alias("covered"), F.lit(1).cast("long").alias("n_windows")).distinct())
        return keep(held, "contaminated")


def contamination_report(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``(doc_id, contaminated, item_id, covered, n_windows, n_items)`` for every row of ``docs``, with the item that is covered best."""
    id_col = how.get("id_col", "doc_id")
    best = F.struct((F.col("covered") / F.col("n_windows")).alias("share"), (-F.col("item_id")).alias("turned"), "covered", "n_windows")
    found = contaminated_documents(docs, benchmark, **how).groupBy("doc_id").agg(F.max(best).alias("b"), F.count("*").alias("n_items"))
    return (
        docs.select(F.col(id_col).cast("long").alias("doc_id"))
        .join(found, "doc_id", "left")
        .select("doc_id", F.col("b").isNotNull().alias("contaminated"), (-F.col("b.turned")).alias("item_id"), "b.covered", "b.n_windows", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; columns unchanged.

    Rows are told apart by more than their id: rows that share an id, or have none, are numbered, and stay or go each by its own text.
    """
    id_col = how.pop("id_col", "doc_id")
    shared = docs.groupBy(F.col(id_col).alias("_id")).count().filter("count > 1 or _id is null")
    rows, key = (docs, id_col) if shared.isEmpty() else (stash(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered"), "_row")
    gone = contaminated_documents(rows, benchmark, id_col=key, **how).select(F.col("doc_id").alias("_gone")).distinct()
    return rows.join(gone, rows[key] == gone["_gone"], "left_anti").select(*docs.columns)
