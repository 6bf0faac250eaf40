"""Licence scans by canonical digests of entire texts."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hockeylake.llm.common import intermediates, stash

#: Spellings that count as equal: (words, canonical words), in this order.
EQUIVALENT = (
    ("sub licence", "sublicense"),
    ("sub license", "sublicense"),
    ("sublicence", "sublicense"),
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("noninfringement", "non infringement"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("merchantibility", "merchantability"),
    ("per cent", "percent"),
    ("favour", "favor"),
    ("organisation", "organization"),
    ("whilst", "while"),
)
#: A line that says who has the copyright; one that a wrapped text merely begins with the word is none.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(?:(?i:copyright)[ \t]*(?:\([cC]\)|©|\d|[\[<{]|\p{Lu})|\([cC]\)[ \t]*\d|©)[^\n]*$"
#: Where paragraphs part.
BLANK_LINES = r"\n[ \t\r]*\n\s*"

#: Short notices that stand for a licence. Parameter of ``license_scan``; whole licence files can be added as rows.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("reserved", "All rights reserved."),
)


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, words parted by single blanks, equivalent spellings made equal."""
    x = F.lower(F.regexp_replace(text, COPYRIGHT_LINE, " "))
    # Two blanks between words, so that each has its own on either side.
    x = F.concat(F.lit(" "), F.trim(F.regexp_replace(x, r"[^\p{L}\p{N}]+", "  ")), F.lit(" "))
    for said, meant in EQUIVALENT:
        x = F.replace(x, F.lit(f" {said.replace(' ', '  ')} "), F.lit(f" {meant.replace(' ', '  ')} "))
    return F.trim(F.replace(x, F.lit("  "), F.lit(" ")))


def _paragraphs(text: Column) -> Column:
    """The canonical paragraphs of a text that say anything."""
    return F.filter(F.transform(F.split(text, BLANK_LINES), canonical), lambda x: x != "")


def known_digests(texts: DataFrame) -> DataFrame:
    """``(digest, license_id, known, j, k)`` of a table ``(license_id, text)``: a row for each whole text, with null j, and for each of its k paragraphs if it has several.

    Of two licences with one canonical text the first by name counts; null names and texts without a word are skipped.
    """
    rows = texts.filter("license_id is not null and text is not null").select("license_id", canonical(F.col("text")).alias("x"), _paragraphs(F.col("text")).alias("ps")).filter("x != ''")
    rows = rows.withColumn("digest", F.sha2("x", 256)).groupBy("digest").agg(F.min(F.struct("license_id", "ps")).alias("r"))
    whole = rows.select("digest", "r.license_id", F.xxhash64("digest").alias("known"), F.lit(None).cast("int").alias("j"), F.lit(1).alias("k"))
    several = rows.filter(F.size("r.ps") > 1).select("r.license_id", F.xxhash64("digest").alias("known"), F.size("r.ps").alias("k"), F.posexplode("r.ps").alias("j", "p"))
    return whole.unionByName(several.select(F.sha2("p", 256).alias("digest"), "license_id", "known", "j", "k"))


def default_texts(spark: SparkSession) -> DataFrame:
    """The notices, and the licence texts in the folder ``licenses`` beside this file (``name.txt``, or ``name.what.txt`` for another form); about 150 KB."""
    return spark.createDataFrame(list(default_rows()), "license_id string, text string")


def default_rows() -> tuple[tuple[str, str], ...]:
    folder = Path(__file__).with_name("licenses")
    whole = ((f.stem if f.stem.rpartition(".")[2].isdigit() or "." not in f.stem else f.stem.rpartition(".")[0], f.read_text("utf-8")) for f in sorted(folder.glob("*.txt")))
    return (*NOTICES, *whole)


def license_scan(docs: DataFrame, texts: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 100_000) -> DataFrame:
    """``(doc_id, text_license, licenses, n_units)`` for every row of ``docs``.

    Each whole document, and each of its lines and paragraphs (parted by blank lines) as an entire
    text of its own, is normalised (case, punctuation, copyright lines, equivalent spellings) and
    its SHA-256 digest is hash-joined with those of the known texts. A known text of several paragraphs is
    also found within a longer document, where all its paragraphs stand in a row. text_license is the licence that
    the whole document is, or null; licenses is the sorted list, joined with commas, of those of any
    unit, null if none; n_units counts the lines, paragraphs and runs of paragraphs that matched, equal lines or paragraphs once.

    The known digests are broadcast if they are at most ``broadcast_rows`` rows, which is counted, and
    else shuffled. Only matches and one row a document go through the shuffle by row.

    Null and blank texts have no units; a null id is kept and its rows are scanned alike; repeated
    rows are reported each; an empty table gives an empty result, no known texts give null licences.
    Other columns are not read.
    """
    with intermediates(docs.sparkSession):
        known = stash(known_digests(default_texts(docs.sparkSession) if texts is None else texts), "known", up=1)
    side = F.broadcast(known) if known.count() <= broadcast_rows else known
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    unit = lambda kind, x, i=None: F.struct(F.lit(kind).alias("kind"), x.alias("x"), F.lit(None).cast("int").alias("i") if i is None else i.alias("i"))
    none = F.array().cast("array<string>")
    parted = F.col("text").rlike(BLANK_LINES)
    parts = F.array_distinct(F.concat(F.split("text", "\n"), F.when(parted, F.filter(F.split("text", BLANK_LINES), lambda x: F.contains(x, F.lit("\n")))).otherwise(none)))
    run = F.when(parted, _paragraphs(F.col("text"))).otherwise(none)
    units = rows.select(
        "_row",
        "doc_id",
        # The first unit stands for the row itself and keeps it in the result.
        F.explode(
            F.concat(
                F.array(unit("row", F.lit(None).cast("string")), unit("whole", canonical(F.col("text")))),
                F.transform(parts, lambda x: unit("part", canonical(x))),
                F.transform(run, lambda x, i: unit("run", x, i)),
            )
        ).alias("u"),
    )
    units = units.select("_row", "doc_id", "u.kind", "u.i", F.sha2("u.x", 256).alias("digest"))
    found = units.join(side, "digest", "left").filter((F.col("kind") == "row") | (F.col("license_id").isNotNull() & ((F.col("kind") == "run") == F.col("j").isNotNull())))
    # Of a run all paragraphs must be there, one after the other.
    found = found.groupBy("_row", "doc_id", "kind", "license_id", "known", "k", (F.col("i") - F.col("j")).alias("shift")).agg(F.countDistinct("j").alias("paragraphs"), F.count("*").alias("n"))
    found = found.filter((F.col("kind") != "run") | (F.col("paragraphs") == F.col("k")))
    return (
        found.groupBy("_row", "doc_id")
        .agg(
            F.min(F.when(F.col("kind") == "whole", F.col("license_id"))).alias("text_license"),
            F.nullif(F.array_join(F.array_sort(F.collect_set("license_id")), ","), F.lit("")).alias("licenses"),
            F.coalesce(F.sum(F.when(F.col("kind") == "part", F.col("n")).when(F.col("kind") == "run", 1)), F.lit(0)).cast("long").alias("n_units"),
        )
        .drop("_row")
    )
