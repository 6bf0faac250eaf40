"""Column expressions for hockey statistics; all built from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(x: Column) -> Column:
    """Whole number or null. Text with a fraction is null, a number loses its fraction."""
    return x.try_cast("bigint")


def to_float(x: Column) -> Column:
    return x.try_cast("double")


def blank_to_null(x: Column, *also: str) -> Column:
    t = F.trim(x)
    return F.when(~t.isin("", *also), t)


def comma_decimal(x: Column) -> Column:
    """``"92,31"`` as 92.31; ``N/A``, ``-`` and blank are null."""
    return F.replace(blank_to_null(x, "N/A", "-"), F.lit(","), F.lit(".")).try_cast("double")


def comma_int(x: Column) -> Column:
    return F.replace(blank_to_null(x, "N/A", "-"), F.lit(" "), F.lit("")).try_cast("bigint")


def clock_seconds(x: Column) -> Column:
    """``MM:SS`` as seconds; anything without exactly two whole parts is null."""
    p = F.split(x, ":")
    return F.when(F.size(p) == 2, F.get(p, F.lit(0)).try_cast("bigint") * 60 + F.get(p, F.lit(1)).try_cast("bigint"))


def leading_date(x: Column) -> Column:
    """The date in the first ten characters, if there are so many."""
    return F.when(F.length(x) >= 10, F.try_to_timestamp(F.substring(x, 1, 10), F.lit("yyyy-MM-dd")).cast("date"))


def ratio(x: Column, y: Column, digits: int, times: float = 1) -> Column:
    """``x * times / y`` rounded; null where y is not positive."""
    return F.when(y > 0, F.round(x.cast("double") * times / y, digits))


def goals_against_average(goals: Column, seconds: Column, digits: int = 4) -> Column:
    return ratio(goals, seconds, digits, 3600)


def clean_text(x: Column) -> Column:
    """Tabs and no-break spaces as blanks, runs of blanks as one, none at the ends."""
    return F.trim(F.regexp_replace(F.translate(x, "\u00a0\t", "  "), " {2,}", " "))


def season_year(x: Column) -> Column:
    return F.when(F.length(x) >= 4, F.substring(x, 1, 4))


def season_of_game_id(game_id: Column) -> Column:
    """``SSSSTTNNNN`` as ``SSSS`` followed by the next year."""
    year = F.floor(game_id / 1_000_000)
    return (year * 10_000 + year + 1).cast("bigint")


#: Words of league names and the game type they mean; the first that occurs counts.
GAME_TYPES = (("slutspel", "playoff"), ("play out", "play_out"), ("play-out", "play_out"), ("kval", "qualification"), ("chl", "champions_league"), ("champions", "champions_league"))


def game_type(league: Column) -> Column:
    x = F.lower(F.coalesce(league, F.lit("")))
    out = F.when(F.lit(False), F.lit(""))
    for word, kind in GAME_TYPES:
        out = out.when(F.contains(x, F.lit(word)), kind)
    return out.otherwise("regular")


def parse_result(x: Column) -> tuple[Column, Column]:
    """Home and away score of ``"2 - 3"``; both null unless both are whole numbers."""
    p = F.split(F.replace(x, F.lit(" "), F.lit("")), "-")
    home, away = F.get(p, F.lit(0)).try_cast("bigint"), F.get(p, F.lit(1)).try_cast("bigint")
    both = (F.size(p) == 2) & home.isNotNull() & away.isNotNull()
    return F.when(both, home), F.when(both, away)


def points_210(own: Column, other: Column, extra: Column) -> Column:
    """2 for a win, 1 for a loss after regulation, 0 for a loss; null for a tie or an unfinished game."""
    return F.when(own > other, 2).when((own < other) & extra, 1).when(own < other, 0).cast("bigint")


def points_3210(won: Column, extra: Column) -> Column:
    """3 for a win in regulation, 2 for a later one, 1 for a later loss, 0 otherwise."""
    return F.when(won & ~extra, 3).when(won, 2).when(extra, 1).otherwise(0).cast("bigint")


def overtime_flags(periods: Column, event_periods: Column) -> tuple[Column, Column]:
    """Overtime and shootout from period labels, else from those of the events."""
    ot = lambda p: F.upper(p).isin("OT", "OVERTIME") | F.coalesce(p.try_cast("int") > 3, F.lit(False))
    so = lambda p: F.upper(p).isin("SO", "SHOOTOUT")
    return F.exists(periods, ot) | F.exists(event_periods, ot), F.exists(periods, so) | F.exists(event_periods, so)


def cross_save_pct(saves: Column, opponent_shots: Column) -> Column:
    return ratio(saves, opponent_shots, 2, 100)


def first_present(*values: Column) -> Column:
    """The first value that is neither null, blank nor zero, as text."""
    return F.coalesce(*(F.when(~v.cast("string").isin("", "0", "0.0", "false"), v.cast("string")) for v in values))


def first_list(doc: Column, *paths: str) -> Column:
    """Of a variant the root list, else the first list at any of the paths."""
    return F.coalesce(*(F.try_variant_get(doc, p, "array<variant>") for p in ("$", *paths)))


def localised(doc: Column, key: str) -> Column:
    """``{"default": x}`` or plain x."""
    return F.coalesce(F.try_variant_get(doc, f"$.{key}.default", "string"), F.when(~F.schema_of_variant(F.try_variant_get(doc, f"$.{key}", "variant")).startswith("OBJECT"), F.try_variant_get(doc, f"$.{key}", "string")))


def measure(doc: Column, key: str) -> tuple[Column, Column]:
    """A measure in metric and imperial units: a number, or an object with default or metric and imperial, or such an object one level deeper."""
    get = lambda p: F.try_variant_get(doc, p, "double")
    base = f"$.{key}"
    return (
        F.coalesce(get(base), get(f"{base}.default"), get(f"{base}.metric"), get(f"{base}.value.metric"), get(f"{base}.value.default")),
        F.coalesce(get(f"{base}.imperial"), get(f"{base}.value.imperial")),
    )


def position(x: Column) -> Column:
    u = F.upper(F.trim(x))
    return F.when(u == "MV", "G").otherwise(u)


def folded_slug(x: Column) -> Column:
    """Lower case, blanks as underscores, Norwegian letters as Latin ones."""
    return F.replace(F.translate(F.replace(F.lower(x), F.lit(" "), F.lit("_")), "øå", "oa"), F.lit("æ"), F.lit("ae"))


#: Period ids of the Norwegian league.
PERIODS = {200050: 1, 200051: 2, 200052: 3, 200053: 4}


def period_number(x: Column) -> Column:
    out = F.when(F.lit(False), F.lit(0).cast("bigint"))
    for k, v in PERIODS.items():
        out = out.when(x == k, F.lit(v).cast("bigint"))
    return out.otherwise(x)


def phase(x: Column) -> Column:
    return F.when(F.contains(x, F.lit("Playoff")), "Playoffs").when(F.contains(x, F.lit("Qualifier")), "Qualifiers").when(F.contains(x, F.lit("Practice")), "Practice").otherwise("Regular")


def synthetic_id(parent: Column, pos: Column, offset: int = 0) -> Column:
    return parent * 1000 + pos + offset


def full_name(first: Column, last: Column) -> Column:
    return blank_to_null(F.concat_ws(" ", first, last))


def first_name(name: Column) -> Column:
    return F.split_part(name, F.lit(" "), F.lit(1))


def rest_of_name(name: Column) -> Column:
    """What follows the first word; the whole name if there is one word."""
    return F.when(F.contains(name, F.lit(" ")), F.substr(name, F.length(first_name(name)) + 2)).otherwise(name)


def per_60(x: Column, seconds: Column, digits: int = 4) -> Column:
    return ratio(x, seconds, digits, 3600)


def zscore(recent: Column, base: Column, sd: Column, digits: int = 3) -> Column:
    """Distance of recent from base in deviations, 0 without a deviation."""
    return F.when(sd > 0, F.round((recent - base) / sd, digits)).otherwise(F.lit(0.0))


def severity(z: Column) -> Column:
    return F.round(F.least(F.abs(z), F.lit(3.0)) / 3, 4)


def insight_id(kind: Column, entity: Column, insight: Column, day: Column) -> Column:
    return F.substring(F.md5(F.concat_ws(":", kind, entity, insight, day)), 1, 16)


def player_class(z: Column) -> Column:
    return F.when(z >= 2.5, "breakout").when(z >= 1, "hot_streak").when(z <= -2.5, "slump").otherwise("cold_spell")


def team_class(z: Column) -> Column:
    return F.when(z >= 1.5, "team_surge").otherwise("team_collapse")


def goalie_class(z: Column) -> Column:
    return F.when(z > 0, "goalie_hot").otherwise("goalie_cold")


def truncated(x: Column, n: int) -> Column:
    return F.substring(F.coalesce(x, F.lit("")), 1, n)


def path_date(path: Column) -> Column:
    return blank_to_null(F.regexp_extract(path, r"(?:^|[/=])(\d{4}-\d{2}-\d{2})(?:/|$)", 1))


def path_season(path: Column) -> Column:
    """The first ``20dddddd`` of the path, else what follows the last underscore of the file's stem."""
    return F.coalesce(blank_to_null(F.regexp_extract(path, r"(20\d{6})", 1)), blank_to_null(F.regexp_extract(path, r"_([^_/.]+)\.[^./]*$", 1)))


def html_unescape(x: Column) -> Column:
    for said, meant in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(said), F.lit(meant))
    return x


def zero_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(0))
