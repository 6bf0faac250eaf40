"""Names matched by what they contain, in the order of a table of known names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hockeylake.functions import folded_slug


def _parts(text: Column, lengths: Column) -> Column:
    """The different parts of a text that have one of the lengths; the empty one is a part of every text."""
    fitting = F.filter(lengths, lambda n: n <= F.length(text))
    return F.array_distinct(F.flatten(F.transform(fitting, lambda n: F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substr(text, i, n)))))


def _lengths(texts: DataFrame, column: str) -> DataFrame:
    """All lengths of a column's texts, as a list in one row."""
    return texts.agg(F.collect_set(F.length(column)).alias("lengths"))


def first_containing(names: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """``(<column>, value)`` for the different names that contain a name of ``known (name, value, ord)`` or are contained in one, in any case: the value of the first by ``ord``.

    A text that another contains is one of its parts, so that both ways are joins of equal texts: the parts of each name that are as long as some known name, and the parts of each known name
    that are as long as some name. Of equal parts of known names the first by ``ord`` is kept before it is joined, so that no pair is made that isn't a hit, and a part that many known names
    share costs one row. A text of n characters has at most n parts of a length. An empty name is contained in every one. Names without a hit and null names give no row;
    of equal ``ord`` the smallest value counts; an empty table gives an empty result.
    """
    known = known.select(F.lower("name").alias("m"), F.struct("ord", "value").alias("v")).filter("m IS NOT NULL")
    names = names.select(F.col(column).alias("name"), F.lower(column).alias("x")).filter("x IS NOT NULL").distinct()

    def parted(texts: DataFrame, text: str, lengths: DataFrame, *more: str) -> DataFrame:
        return texts.crossJoin(F.broadcast(lengths)).select(*more, F.explode(_parts(F.col(text), F.col("lengths"))).alias("part"))

    whole = known.groupBy(F.col("m").alias("part")).agg(F.min("v").alias("v"))
    inner = parted(known, "m", _lengths(names, "x"), "v").groupBy("part").agg(F.min("v").alias("v"))
    around = parted(names, "x", _lengths(known, "m"), "name").join(whole.hint("merge"), "part")
    within = names.withColumnRenamed("x", "part").join(inner.hint("merge"), "part")
    hits = around.select("name", "v").unionByName(within.select("name", "v"))
    return hits.groupBy(F.col("name").alias(column)).agg(F.min("v").alias("v")).select(column, F.col("v.value").alias("value"))


def team_slug(df: DataFrame, column: str, known: DataFrame, out: str = "slug") -> DataFrame:
    """``df`` with the slug of a team's name: that of the first known name that contains it or is contained in it, else the name itself, folded. Null names have none."""
    found = first_containing(df, column, known).toDF("_name", "_slug")
    return df.join(found, df[column] == found["_name"], "left").withColumn(out, F.coalesce("_slug", folded_slug(F.col(column)))).drop("_name", "_slug")


def slug_among(name: Column, known: tuple[tuple[str, str], ...]) -> Column:
    """The same slug for a short list of ``(name, slug)``, as an expression without a join."""
    low = F.lower(name)
    table = F.array(*(F.struct(F.lit(n.lower()).alias("name"), F.lit(s).alias("slug")) for n, s in known))
    return F.coalesce(F.get(F.filter(table, lambda t: F.contains(low, t["name"]) | F.contains(t["name"], low)), F.lit(0))["slug"], folded_slug(name))
