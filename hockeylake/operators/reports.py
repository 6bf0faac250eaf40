"""Match reports as lines of words, and web pages: markers are carried forward by windows, fields are read by their place in the line."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hockeylake.functions import blank_to_null, clock_seconds, comma_decimal, goals_against_average, html_unescape, position
from hockeylake.operators.gold import keep_first

#: What a word of a field looks like, and how it is read.
KINDS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "whole": (r"^-?\d+$", lambda w: w.try_cast("bigint")),
    "count": (r"^(-?\d+|-)$", lambda w: w.try_cast("bigint")),
    "clock": (r"^\d{1,3}:\d{2}$", clock_seconds),
    "share": (r"^(\d+(,\d+)?|N/A|-)$", comma_decimal),
    "text": (r"^\S+$", lambda w: w),
}
NUMBER = r"^\d{1,3}$"
#: What a line has, of those that can stand in one, where its blanks aren't all single plain ones; a search for each is cheaper than a pattern.
_ODD_BLANKS = ("  ", "\t", "\x0b", "\f", "\r", "\u00a0")


def report_lines(reports: DataFrame) -> DataFrame:
    """``(game_id, report_type, pos, line, words)`` of reports ``(game_id, report_type, text)``.

    Runs of blanks are one, the dash of a goal's score stands without blanks (``2 \u2013 1`` is ``2-1``), blank lines are left out.
    """
    # Java splits by one character without a pattern; a carriage return before it is a blank at the line's end.
    df = reports.select("game_id", "report_type", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    # Of the raw line, so that lines aren't tidied once more for a filter; one that begins with a plain sign needs no pattern.
    df = df.filter(((F.col("line") >= "!") & (F.col("line") < "\u0080")) | F.col("line").rlike(r"[^\s\u00a0]"))
    odd = reduce(Column.__or__, (F.col("line").contains(blank) for blank in _ODD_BLANKS))
    df = df.withColumn("line", F.trim(F.when(odd, F.regexp_replace("line", r"[\s\u00a0]+", " ")).otherwise(F.col("line"))))
    score = F.regexp_replace("line", r"(?<=\d)(?: [-\u2013] |[-\u2013])(?=\d)", "-")
    return df.withColumn("line", F.when(F.col("line").startswith("Goal "), score).otherwise(F.col("line"))).withColumn("words", F.split("line", " "))


def _order():
    return Window.partitionBy("game_id", "report_type").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)


def carried(value: Column) -> Column:
    """The last value that isn't null, from the line itself or above in its report."""
    return F.last(value, ignorenulls=True).over(_order())


def marked(lines: DataFrame, **columns: Column) -> DataFrame:
    """Lines with columns that windows make. Words are made again behind them, so that they don't go through the shuffle and sort."""
    return lines.withColumns(columns).drop("words").withColumn("words", F.split("line", " "))


def group(pattern: str, i: int) -> Column:
    return blank_to_null(F.regexp_extract("line", pattern, i))


def word(i: Column | int) -> Column:
    """The word of that place from 0; null beyond the line."""
    return F.get("words", F.lit(i) if isinstance(i, int) else i)


def joined(start: Column | int, end: Column | int) -> Column:
    """The words from ``start`` to before ``end``, in one text."""
    start, end = (F.lit(x) if isinstance(x, int) else x for x in (start, end))
    return blank_to_null(F.array_join(F.slice("words", start + 1, F.greatest(end - start, F.lit(0))), " "))


def size() -> Column:
    return F.size("words")


def fits(start: Column | int, spec: dict[str, str]) -> Column:
    """Whether the words from ``start`` on look like the fields of ``spec``, name -> kind."""
    test = F.lit(True)
    for i, kind in enumerate(spec.values()):
        test = test & word(start + i).rlike(KINDS[kind][0])
    return F.coalesce(test, F.lit(False))


def headed(first: str, rest: Column) -> Column:
    """Whether a line begins with that word and the rest holds; the rest is looked at only then, where Spark makes what conditions joined by ``&`` share for every line."""
    return F.when(word(0) == first, F.coalesce(rest, F.lit(False))).otherwise(F.lit(False))


def read(start: Column | int, spec: dict[str, str]) -> list[Column]:
    return [KINDS[kind][1](word(start + i)).alias(name) for i, (name, kind) in enumerate(spec.items())]


def places(test: Callable[[Column], Column], words: str = "words") -> Column:
    """The places, from 0, of the words that pass."""
    return F.filter(F.transform(words, lambda w, i: F.when(test(w), i)), lambda i: i.isNotNull())


def pieces(starts: Column, make: Callable[[Column, Column], Column]) -> Column:
    """``make(start, end)`` for each of the starts, the end being the next one or that of the line."""
    told = F.array(F.struct(starts.alias("s"), F.size("words").alias("n")))
    return F.flatten(F.transform(told, lambda t: F.transform(t["s"], lambda p, k: make(p, F.coalesce(F.get(t["s"], k + 1), t["n"])))))


def once(df: DataFrame, *columns: Column) -> DataFrame:
    """The rows with more columns, each made once: filters and columns further on use what was made, where they would make it again behind a plain select."""
    return df.select("*", F.explode(F.array(F.struct(*columns))).alias("_made")).select(*df.columns, "_made.*")


def with_sections(lines: DataFrame) -> DataFrame:
    """Lines with the period whose heading stands above them; ``OT`` and ``SO`` for overtime and shootout, null before the first.

    Headings are ``1st period`` and the like, ``OT period``, ``Overtime``, ``SO period`` and ``Shootout``, in any case.
    """
    low = F.lower("line")
    mark = F.when(low.rlike(r"^\d(st|nd|rd|th) period\b"), F.substring("line", 1, 1)).when(low.rlike(r"^(ot|overtime)( period\b|$)"), "OT").when(low.rlike(r"^(so|shootout)( period\b|$)|^game winning shots$"), "SO")
    return marked(lines, period=carried(mark))


#: What may stand for the type of a goal.
GOAL_TYPES = ("EQ", "PP", "PP1", "PP2", "SH", "SH1", "SH2", "EN", "OT", "OT1", "PS", "GWS", "GWG", "N/A")
_GOAL = {"what": "text", "seconds": "clock", "team": "text"}


def _is_goal() -> Column:
    return headed("Goal", fits(0, _GOAL) & word(3).rlike(r"^\d+-\d+$"))


def goals(lines: DataFrame) -> DataFrame:
    """``(game_id, pos, period, seconds, team, home_score, away_score, goal_type, scorer_number, scorer, assist1, assist2)``.

    A line is ``Goal``, clock, team, score, type, then number and name of the scorer and up to two assistants; what follows ``Participation`` is left out.
    """
    typed = word(4).isin(*GOAL_TYPES)
    start = F.when(typed, 5).otherwise(4)
    end = F.coalesce(F.nullif(F.array_position("words", "Participation"), F.lit(0)) - 1, size()).cast("int")
    score = F.split(word(3), "-")
    df = with_sections(lines).filter(_is_goal()).select("game_id", "pos", "period", "words", start.alias("start"), end.alias("end"), typed.alias("typed"), score.alias("score"))
    numbers = F.filter(places(lambda w: w.rlike(NUMBER)), lambda i: (i >= F.col("start")) & (i < F.col("end")))
    person = lambda p, e: F.struct(word(p).cast("bigint").alias("number"), joined(p + 1, F.least(e, F.col("end"))).alias("name"))
    df = df.withColumn("people", pieces(numbers, person))
    who = lambda i: F.get("people", F.lit(i))
    return df.select(
        "game_id", "pos", "period", *read(1, {"seconds": "clock", "team": "text"}), F.get("score", F.lit(0)).cast("bigint").alias("home_score"), F.get("score", F.lit(1)).cast("bigint").alias("away_score"),
        F.when(F.col("typed"), word(4)).alias("goal_type"), who(0)["number"].alias("scorer_number"), who(0)["name"].alias("scorer"), who(1)["name"].alias("assist1"), who(2)["name"].alias("assist2"),
    )


def on_ice(lines: DataFrame) -> DataFrame:
    """Players on the ice in the lines that follow a goal directly: a team with a colon, then numbers; side is positive for the team that scored."""
    numbers = F.slice("words", 2, F.greatest(size() - 1, F.lit(0)))
    ice = word(0).endswith(":") & (size() > 1) & F.forall(numbers, lambda w: w.rlike(NUMBER))
    goal = lambda value: F.when(_is_goal(), value)
    above = carried(F.when(~ice, F.struct("pos", goal(word(2)).alias("scored"), goal(clock_seconds(word(1))).alias("seconds"))))
    df = marked(with_sections(lines), above=above).filter(ice & F.col("above.scored").isNotNull())
    team = F.regexp_replace(word(0), ":$", "")
    return df.select("game_id", "pos", F.col("above.pos").alias("goal_pos"), "period", "above.seconds", team.alias("team"), F.when(team == F.col("above.scored"), "positive").otherwise("negative").alias("side"), F.explode(numbers).alias("n")).withColumn("number", F.col("n").cast("bigint")).drop("n")


_PENALTY = {"what": "text", "seconds": "clock", "team": "text", "minutes": "whole", "min": "text", "number": "whole"}


def _is_penalty() -> Column:
    return headed("Penalty", fits(0, _PENALTY) & word(4).startswith("min"))


def penalties(lines: DataFrame) -> DataFrame:
    """``Penalty``, clock, team, minutes, ``min.``, number, name up to the word after its comma, and what for."""
    comma = F.get(places(lambda w: w.endswith(",")), F.lit(0))
    end = F.coalesce(comma + 2, F.lit(8))
    df = with_sections(lines).filter(_is_penalty())
    return df.select("game_id", "pos", "period", *(c for c, n in zip(read(0, _PENALTY), _PENALTY, strict=True) if n not in ("what", "min")), joined(6, end).alias("player"), joined(end, size()).alias("infraction"))


_GOALKEEPER = {"what": "text", "change": "text", "seconds": "clock", "team": "text", "number": "whole"}


def _is_goalkeeper_change() -> Column:
    return headed("Goalkeeper", word(1).isin("In", "Out") & fits(0, _GOALKEEPER))


def goalkeeper_changes(lines: DataFrame) -> DataFrame:
    """``Goalkeeper``, ``In`` or ``Out``, clock, team, number and name."""
    return with_sections(lines).filter(_is_goalkeeper_change()).select("game_id", "pos", "period", F.lower(word(1)).alias("change"), *read(0, _GOALKEEPER)[2:], joined(5, size()).alias("player"))


def _spectators() -> Column:
    return F.replace(group(r"^Spectators: ?([\d ]+)", 1), F.lit(" "), F.lit("")).try_cast("bigint")


def spectators(lines: DataFrame) -> DataFrame:
    """The first number of spectators in each game's reports."""
    return lines.select("game_id", "pos", _spectators().alias("n")).filter("n IS NOT NULL").groupBy("game_id").agg(F.min_by("n", "pos").alias("spectators"))


#: The fields of a statistics line after the team's name.
PERIOD_FIELDS = {
    "goals": "whole", "shots": "whole", "saves": "whole", "save_pct": "share", "pim": "whole", "pp_seconds": "clock", "advantages": "whole", "pp_pct": "share", "sh_seconds": "clock", "disadvantages": "whole", "sh_pct": "share",
}


def _is_statistics() -> Column:
    start = size() - len(PERIOD_FIELDS)
    return (start > 0) & fits(start, PERIOD_FIELDS)


def period_stats(lines: DataFrame) -> DataFrame:
    """The statistics table of each period, ``total`` above the first."""
    start = size() - len(PERIOD_FIELDS)
    df = with_sections(lines).filter(_is_statistics())
    return df.select("game_id", "pos", F.coalesce("period", F.lit("total")).alias("period"), joined(0, start).alias("team"), *read(start, PERIOD_FIELDS))


def referees(lines: DataFrame) -> DataFrame:
    """Names after the heading of referees or linesmen, on its line or the ones below, up to the next heading."""
    head = r"^(Referees?|Linesmen|Linesman)\b:?\s*"
    mode = carried(F.when(F.col("line").rlike(head), F.when(F.col("line").startswith("Ref"), "referee").otherwise("linesman")).when(F.lower("line").rlike(r"^[^,]+:|period$|^team( |$)|^\d"), "none"))
    df = lines.withColumn("role", mode).filter("role IN ('referee', 'linesman')")
    return df.select("game_id", "role", F.explode(F.regexp_extract_all(F.regexp_replace("line", head, ""), F.lit(r"([\p{L}'-]+, [\p{L}'-]+)"), F.lit(1))).alias("name"), "pos").groupBy("game_id", "role", "name").agg(F.min("pos").alias("pos"))


#: What stands between the names of two teams.
_DASHES = (" - ", " \u2013 ", " \u2014 ", " vs ", " vs. ")


def _named() -> Column:
    """The two teams of a line ``Home - Away``; null for other lines."""
    parted = reduce(Column.__or__, (F.col("line").contains(dash) for dash in _DASHES))  # splitting compiles its pattern for each line
    parts = F.split("line", r" (?:[-\u2013\u2014]|vs\.?) ")
    return F.when(parted & ~F.col("line").rlike(r"[\d:]") & (F.size(parts) == 2), parts)


def team_names(lines: DataFrame) -> DataFrame:
    """Home and away team from the first line ``Home - Away`` (any dash, or ``vs``) without numbers and colons, else the first two teams of the statistics tables."""
    start, named = size() - len(PERIOD_FIELDS), _named()
    team = F.when(_is_statistics(), F.struct("pos", joined(0, start).alias("team")))
    found = lines.select("game_id", "pos", named.alias("named"), team.alias("team")).groupBy("game_id")
    found = found.agg(F.min_by("named", F.when(F.col("named").isNotNull(), F.col("pos"))).alias("named"), F.array_distinct(F.transform(F.array_sort(F.collect_list("team")), lambda t: t["team"])).alias("listed"))
    both = F.coalesce("named", "listed")
    return found.filter("named IS NOT NULL OR size(listed) > 0").select("game_id", F.trim(F.get(both, F.lit(0))).alias("home_team"), F.trim(F.get(both, F.lit(1))).alias("away_team"))


#: Positions on the ice.
POSITIONS = ("GK", "LD", "RD", "LW", "CE", "RW", "G", "D", "F")
_DAY = r"^\d{4}-\d{2}-\d{2}$"


def _labelled(lines: DataFrame) -> DataFrame:
    """Lines with the line or group, or ``officials``, whose label stands above them."""
    low = F.lower("line")
    return marked(lines, label=carried(F.when(low.rlike("team officials"), "officials").when(low.rlike(r"^(\d+(st|nd|rd|th) line|extra players|goalkeepers?)$"), F.col("line"))))


def _side(i: Column) -> Column:
    return F.when(i == 0, "home").otherwise("away")


def roster(lines: DataFrame) -> DataFrame:
    """Players of roster lines: position, number, name, ``C`` or ``A``, birthdate; up to two a line, the first of the home team; the label above is the line."""
    begins = F.filter(F.transform("words", lambda w, i: F.when(w.isin(*POSITIONS) & word(i + 1).rlike(NUMBER), i)), lambda i: i.isNotNull())

    def player(p: Column, end: Column) -> Column:
        days = F.filter(places(lambda w: w.rlike(_DAY)), lambda i: (i > p) & (i < end))
        day = F.get(days, F.lit(0))
        flagged = word(day - 1).isin("C", "A")
        name = F.regexp_replace(joined(p + 2, day - F.when(flagged, 1).otherwise(0)), r",\s*", ", ")
        return F.struct(position(word(p)).alias("position"), word(p + 1).cast("bigint").alias("number"), name.alias("player"), F.when(flagged, word(day - 1)).alias("flag"), word(day).try_cast("date").alias("birthdate"))

    df = _labelled(lines).filter("label IS NOT NULL AND label != 'officials'").select("game_id", "pos", "label", F.posexplode(pieces(begins, player)).alias("i", "p"))
    return df.filter("p.birthdate IS NOT NULL").select("game_id", "pos", "label", _side(F.col("i")).alias("side"), "p.position", "p.number", "p.player", (F.coalesce("p.flag", F.lit("")) == "C").alias("captain"), (F.coalesce("p.flag", F.lit("")) == "A").alias("alternate"), "p.birthdate")


def officials(lines: DataFrame) -> DataFrame:
    """Coaches and other officials below ``Team Officials``: surname in capitals and a comma, first name, role; up to two a line."""
    begins = places(lambda w: w.rlike(r"^\p{Lu}[\p{Lu}'-]+,$"))
    person = lambda p, end: F.struct(joined(p, p + 2).alias("name"), joined(p + 2, end).alias("role"))
    df = _labelled(lines).filter("label = 'officials'").select("game_id", F.posexplode(pieces(begins, person)).alias("i", "p"))
    return df.select("game_id", _side(F.col("i")).alias("side"), "p.name", "p.role")


#: What heads a line-up and is no team, and what may stand above or before the players of a line.
NO_TEAM = ("Official Line Up", "HockeyAllsvenskan", "J20 Nationell", "Linesman", "SHL", "Team")
_LABEL = r"(?i)^(1st|2nd|3rd|4th|Extra players)"
_NAME_FIRST, _NAME_REST = "[A-ZÄÅÖ]", "A-Za-zäåöüÄÅÖÜ"


def lineup(lines: DataFrame) -> DataFrame:
    """``(game_id, pos, i, team, line_number, number, player, position)`` of line-up reports, in order.

    A line of letters alone, perhaps with a colour in brackets (``Leksands IF (White)``), is a team; it ends the line above it. ``1st`` to ``4th`` and
    ``Extra players`` name a line, on a line of their own or before its first player. Players are ``10 JOHANSSON, Anton (RD)``, several to a line;
    a number and a name without a place are a goalkeeper, if there is a team. Players before any team have none.
    """
    text = F.regexp_replace("line", rf" ?\([{_NAME_REST}]+\)$", "")
    only = F.col("line").rlike(_LABEL + "$")
    team = ~only & text.rlike(rf"^{_NAME_FIRST}[{_NAME_REST} -]+$") & (F.length(text) > 3) & ~text.isin(*NO_TEAM)
    label = F.when(only | F.col("line").rlike(_LABEL + r" \d."), group(_LABEL, 1))
    df = marked(lines, team=carried(F.when(team, F.struct("pos", text.alias("name")))), label=carried(F.when(label.isNotNull(), F.struct("pos", label.alias("name"))))).filter(~team & ~only & F.col("line").rlike(r"\d"))
    unit = F.when(F.col("team").isNull() | (F.col("label.pos") > F.col("team.pos")), F.col("label.name"))
    rest = F.regexp_replace("line", _LABEL + r" (?=\d.)", "")
    form = rf"(\d{{1,3}}) ({_NAME_FIRST}[{_NAME_REST},. -]+?) \((LW|CE|RW|LD|RD|GK|G|D|F)\)"
    placed = F.regexp_extract_all(rest, F.lit(form), F.lit(0))
    of = lambda x, i, pattern=form: F.regexp_extract(x, pattern, i)
    tidy = lambda x: F.regexp_replace(F.trim(x), ",+$", "")
    people = F.transform(placed, lambda x: F.struct(of(x, 1).cast("bigint").alias("number"), tidy(of(x, 2)).alias("player"), of(x, 3).alias("position"), F.lit(False).alias("bare")))
    bare = rf"^(\d{{1,2}}) ({_NAME_FIRST}[{_NAME_REST}, -]+)$"
    goalie = F.when(rest.rlike(bare) & F.col("team").isNotNull(), F.array(F.struct(of(rest, 1, bare).cast("bigint").alias("number"), tidy(of(rest, 2, bare)).alias("player"), F.lit("GK").alias("position"), F.lit(True).alias("bare"))))
    df = df.select("game_id", "pos", F.col("team.name").alias("team"), unit.alias("unit"), F.posexplode(F.when(F.size(placed) > 0, people).otherwise(goalie)).alias("i", "p"))
    return df.select("game_id", "pos", "i", "team", F.when(F.col("p.bare"), "Goalkeepers").otherwise(F.col("unit")).alias("line_number"), "p.number", "p.player", "p.position")


#: The fields of summary rows after the name, or after number and name.
SUMMARY_SKATER = {"number": "whole", "position": "text", "goals": "whole", "assists": "whole", "points": "whole", "plus_minus": "whole", "pim": "whole", "shots": "whole", "faceoffs": "text", "faceoff_pct": "share"}
SUMMARY_GOALIE = {"number": "whole", "position": "text", "shots_against": "whole", "goals_against": "whole", "saves": "whole", "save_pct": "share", "seconds": "clock", "gaa": "share"}
MEDIA_SKATER = {"shots": "whole", "goals": "whole", "assists": "whole", "points": "whole", "plus_minus": "whole", "pim": "whole", "hits": "count", "blocks": "count", "faceoffs": "count", "faceoff_pct": "share"}
MEDIA_GOALIE = {"saves": "whole", "goals_against": "whole", "shots_against": "whole", "save_pct": "share", "pp_saves": "count", "pp_shots_against": "count", "seconds": "clock"}


def _tables(lines: DataFrame, skaters: str, goalies: str) -> DataFrame:
    """Lines with the table that they are in, and its team: the first table of a kind is the home team's, the second the away team's."""
    head = F.when(F.col("line").startswith(skaters), "skaters").when(F.col("line").startswith(goalies), "goalies")
    lines = lines.withColumn("head", head)
    count = {t: F.sum(F.when(F.col("head") == t, 1).otherwise(0)).over(_order()) for t in ("skaters", "goalies")}
    lines = marked(lines, table=carried(F.col("head")), **count)
    nth = F.when(F.col("table") == "skaters", F.col("skaters")).otherwise(F.col("goalies"))
    return lines.withColumn("side", _side(nth - 1)).filter("head IS NULL AND table IS NOT NULL")


def _summary(lines: DataFrame, table: str, spec: dict[str, str]) -> DataFrame:
    start = size() - len(spec)
    df = _tables(lines, "Name No. Pos. G A TP", "Name No. Pos. SOG GA SVS").filter(F.col("table") == table)
    return df.filter((start > 0) & fits(start, spec) & word(start + 1).isin(*POSITIONS)).select("game_id", "pos", "side", joined(0, start).alias("player"), *read(start, spec))


def player_summary(lines: DataFrame) -> DataFrame:
    """Skater rows of the player summary: name, number, position and eight numbers."""
    return _summary(lines, "skaters", SUMMARY_SKATER)


def player_summary_goalies(lines: DataFrame) -> DataFrame:
    """Goalie rows of the player summary: name, number, position, shots, goals against, saves, share, clock and average."""
    return _summary(lines, "goalies", SUMMARY_GOALIE)


def _media(lines: DataFrame, table: str, spec: dict[str, str], *more: Column) -> DataFrame:
    """Rows of number, name and fields: the name ends before the first number after it."""
    df = _tables(lines, "Skaters SOG Goals", "Goalies Saves GA").filter(F.col("table") == table)
    start = F.get(F.filter(places(lambda w: w.rlike(r"^-?\d")), lambda i: i > 1), F.lit(0))
    df = once(df.filter(word(0).rlike(NUMBER)), start.alias("start")).filter("start IS NOT NULL")
    return df.filter(fits(F.col("start"), spec)).select("game_id", "pos", "side", word(0).cast("bigint").alias("number"), joined(1, F.col("start")).alias("player"), *read(F.col("start"), spec), *more)


def media_summary_skaters(lines: DataFrame) -> DataFrame:
    """Skater rows of the media summary; shifts and time on ice where the row goes on with them."""
    at = F.col("start") + len(MEDIA_SKATER)
    return _media(lines, "skaters", MEDIA_SKATER, word(at).try_cast("bigint").alias("shifts"), clock_seconds(word(at + 1)).alias("toi_seconds"))


def media_summary(lines: DataFrame) -> DataFrame:
    """Goalie rows of the media summary, with goals against by 60 minutes."""
    df = _media(lines, "goalies", MEDIA_GOALIE)
    return df.withColumn("gaa", goals_against_average(F.col("goals_against"), F.col("seconds"), 2))


#: The tables of each kind of report.
READERS: dict[str, dict[str, Callable[[DataFrame], DataFrame]]] = {
    "official_game_report": {"goals": goals, "on_ice": on_ice, "penalties": penalties, "goalkeeper_changes": goalkeeper_changes, "period_stats": period_stats, "referees": referees, "spectators": spectators, "team_names": team_names},
    "team_roster": {"roster": roster, "officials": officials},
    "line_up": {"lineup": lineup, "referees": referees},
    "game_summary": {"skaters": player_summary, "goalies": player_summary_goalies},
    "media_summary": {"skaters": media_summary_skaters, "goalies": media_summary},
}


def read_report(reports: DataFrame, kind: str) -> dict[str, DataFrame]:
    """The tables of one kind of report by name; a text whose lines fit no form gives no rows, an unknown kind no tables."""
    lines = report_lines(reports.filter(F.col("report_type") == kind))
    return {name: reader(lines) for name, reader in READERS.get(kind, {}).items()}


#: What tells a table's rows by the line alone: a row for each such line, or for each game that has one.
_ROW_A_LINE: dict[str, Callable[[], Column]] = {"goals": _is_goal, "penalties": _is_penalty, "goalkeeper_changes": _is_goalkeeper_change, "period_stats": _is_statistics}
_ROW_A_GAME: dict[str, Callable[[], Column]] = {"team_names": lambda: _named().isNotNull() | _is_statistics(), "spectators": lambda: _spectators().isNotNull()}


def report_sizes(reports: DataFrame, kind: str, *names: str) -> DataFrame:
    """``(name, n)``: how many rows the named tables of ``read_report`` have, or all of the kind's if none are named.

    Texts are made and their lines tidied once for all tables whose rows are told by the line alone; the other tables are made, each by itself, and counted.
    """
    readers = READERS.get(kind, {})
    readers = {n: readers[n] for n in names or readers}
    lines = report_lines(reports.filter(F.col("report_type") == kind))
    one = lambda test: F.when(test(), 1).otherwise(0)
    told = {n: F.sum(one(_ROW_A_LINE[n])) if n in _ROW_A_LINE else F.max(one(_ROW_A_GAME[n])) for n in readers if n in _ROW_A_LINE or n in _ROW_A_GAME}
    found = [reader(lines).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n, reader in readers.items() if n not in told]
    if told:
        sums = lines.groupBy("game_id").agg(*(c.alias(n) for n, c in told.items())).agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in told))
        found.append(sums.select(F.inline(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("n")) for n in told)))))
    return reduce(DataFrame.unionByName, found) if found else reports.sparkSession.createDataFrame([], "name string, n bigint")


#: What the rows of each table of a game's reports are told apart by.
REPORT_KEYS: dict[str, tuple[str, ...]] = {
    "referees": ("game_id", "name"),
    "period_stats": ("game_id", "team", "period"),
    "roster": ("game_id", "side", "number", "player"),
    "skaters": ("game_id", "side", "number", "player"),
    "goalies": ("game_id", "side", "number"),
    "on_ice": ("game_id", "period", "seconds", "team", "number"),
    "goals": ("game_id", "period", "seconds", "team", "scorer_number"),
    "penalties": ("game_id", "period", "seconds", "team", "number"),
    "goalkeeper_changes": ("game_id", "period", "seconds", "team", "change", "number"),
    "lineup": ("game_id", "team", "number"),
    "spectators": ("game_id",),
}


def report_bundle(reports: DataFrame) -> dict[str, DataFrame]:
    """The eleven tables of all reports ``(game_id, report_type, text)`` of games, of each key the first row by its place.

    Referees are those of the official report, and of the line-up where that names none for the game. Skaters and goalies are, each by itself, those of the media summary where it has any for the
    game, else those of the player summary; columns that only one of them has are null for the other. Reports that aren't there leave their tables without the game's rows; null keys are equal to each other.
    """
    found = {kind: read_report(reports, kind) for kind in READERS}
    official, line_up, media, summary = (found[k] for k in ("official_game_report", "line_up", "media_summary", "game_summary"))

    def else_from(first: DataFrame, second: DataFrame) -> DataFrame:
        # A window in place of an anti-join, so that the first's texts are read once.
        both = first.withColumn("_source", F.lit(0)).unionByName(second.withColumn("_source", F.lit(1)), allowMissingColumns=True)
        least = F.min("_source").over(Window.partitionBy("game_id"))
        return both.withColumn("_least", least).filter("_source = _least OR game_id IS NULL").drop("_source", "_least")

    tables = {name: official[name] for name in ("period_stats", "on_ice", "goals", "penalties", "goalkeeper_changes", "spectators")}
    tables |= {"referees": else_from(official["referees"], line_up["referees"]), "roster": found["team_roster"]["roster"], "lineup": line_up["lineup"]}
    media["skaters"] = media["skaters"].withColumn("faceoffs", F.col("faceoffs").cast("string"))  # won and lost in the other
    tables |= {name: else_from(media[name], summary[name]) for name in ("skaters", "goalies")}
    order = lambda df: [c for c in ("pos", "i", "role") if c in df.columns] or ["game_id"]
    return {name: keep_first(df, list(REPORT_KEYS[name]), order(df)) for name, df in tables.items()}


def page_rows(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``(key, pos, kind, href, text)``: headings, table rows, links and list items of pages in order, without tags; cells are parted by ``|``."""
    part = r"(?s)<(h[1-6]|tr|p|li|title)\b[^>]*>(.*?)</\1>"
    found = F.regexp_extract_all(html, F.lit(part), F.lit(0))
    df = pages.select(key, F.posexplode(found).alias("pos", "x"))
    return df.select(key, "pos", F.lower(F.regexp_extract("x", r"^<(\w+)", 1)).alias("kind"), blank_to_null(F.regexp_extract("x", r'href="([^"]*)"', 1)).alias("href"), _plain(F.col("x")).alias("text"))


def _plain(x: Column) -> Column:
    """Text without tags, cells parted by ``|``, runs of blanks as one."""
    text = F.regexp_replace(F.regexp_replace(x, r"(?s)</t[dh]>\s*<t[dh][^>]*>", "|"), r"(?s)<[^>]*>", " ")
    return html_unescape(F.trim(F.regexp_replace(F.regexp_replace(text, r"\s+", " "), r" ?\| ?", "|")))


def found_in(html: str, pattern: str) -> Column:
    """``(at, text)`` of each place of a page that fits, in order; ``at`` counts from 1."""
    hits = F.regexp_extract_all(html, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<at: int, text: string>>")

    def step(done: Column, hit: Column) -> Column:
        at = F.position(hit, F.col(html), done["end"])
        return F.struct((at + F.length(hit)).alias("end"), F.concat(done["out"], F.array(F.struct(at.alias("at"), hit.alias("text")))).alias("out"))

    return F.aggregate(hits, F.struct(F.lit(1).alias("end"), none.alias("out")), step, lambda done: done["out"])


def last_before(marks: Column, at: Column) -> Column:
    """Of marks in order the last that stands before a place: what a heading says goes for what follows up to the next."""
    before = F.filter(marks, lambda m: m["at"] < at)
    return F.get(before, F.size(before) - 1)


#: Markup of schedule pages.
_ROWS = r"(?s)<tr[^>]*>.*?</tr>"
_LEAGUE_ROW = r"""(?s)<td[^>]*colspan="5"[^>]*>.*?<a[^>]*href="/ScheduleAndResults/(?:Schedule|Overview)/(\d+)"[^>]*>(.*?)</a>"""
_GAME_CELL = r"""(?s)<td[^>]*class="(?:tdOdd|tdNormal)"[^>]*>(.*?)</td>"""
_RESULT = r"\[([^\]]+)\]\(|>([^<]+)</a>"


def page_games(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Games of schedule pages, 12 columns: a row of at least four cells of class ``tdOdd`` or ``tdNormal``: time, teams, result, venue.

    The league and its id are those of the last row with a link across five columns before it, the date is the page's first in a heading cell. The game id
    stands in the result's link, be it an address or a script. Teams that aren't two parts of ``A - B`` are the home team as they stand. Rows without id, result and
    two teams are none, nor are those of a page without a date, or without a team.
    """
    dated = once(pages.select(key, html), blank_to_null(F.regexp_extract(html, r"<th[^>]*>(\d{4}-\d{2}-\d{2})</th>", 1)).alias("date")).filter("date IS NOT NULL")
    marked_rows = F.transform("rows", lambda r: F.struct(r["at"].alias("at"), r["text"].alias("text"), r["text"].rlike(_LEAGUE_ROW).alias("league")))
    rows = once(dated.select(key, "date", found_in(html, _ROWS).alias("rows")), marked_rows.alias("marked"))
    text = lambda c: html_unescape(F.trim(F.regexp_replace(c, r"<[^>]+>", "")))
    leagues = F.transform(F.filter("marked", lambda r: r["league"]), lambda r: F.struct(r["at"].alias("at"), F.regexp_extract(r["text"], _LEAGUE_ROW, 1).try_cast("bigint").alias("id"), text(F.regexp_extract(r["text"], _LEAGUE_ROW, 2)).alias("name")))
    rows = once(rows.select(key, "date", "marked"), leagues.alias("leagues")).select(key, "date", "leagues", F.explode(F.filter("marked", lambda r: ~r["league"])).alias("r"))
    rows = once(rows, F.regexp_extract_all("r.text", F.lit(_GAME_CELL), F.lit(1)).alias("cells")).filter(F.size("cells") >= 4)
    cell = lambda i: F.trim(F.get("cells", F.lit(i)))
    result = html_unescape(blank_to_null(F.trim(F.concat(*(F.regexp_extract(cell(2), _RESULT, i) for i in (1, 2))))))
    rows = once(rows, last_before(F.col("leagues"), F.col("r.at")).alias("of"), text(cell(1)).alias("teams"), result.alias("result"), F.regexp_extract(cell(2), r"/Game/Events/(\d+)", 1).try_cast("bigint").alias("game_id"))
    rows = once(rows, F.split("teams", " - ").alias("parts"))
    both = F.size("parts") == 2
    rows = once(rows, F.when(both, F.trim(F.get("parts", F.lit(0)))).otherwise(blank_to_null(F.col("teams"))).alias("home_team"), F.when(both, F.trim(F.get("parts", F.lit(1)))).alias("away_team"))
    rows = rows.filter("(home_team != '' OR away_team != '') AND (game_id IS NOT NULL OR result IS NOT NULL OR away_team IS NOT NULL)")
    score = r"^(\d+) ?- ?(\d+)"
    return rows.select(
        key, "date", F.col("of.id").alias("league_id"), F.col("of.name").alias("league"), "game_id", html_unescape(cell(0)).alias("time"), "home_team", "away_team",
        "result", F.regexp_extract("result", score, 1).try_cast("bigint").alias("home_score"), F.regexp_extract("result", score, 2).try_cast("bigint").alias("away_score"), html_unescape(cell(3)).alias("venue"),
    )


def page_header(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Teams from the title or a heading ``A - B``, date, time, score, attendance, venue and league of game pages.

    The score is the first block that is two numbers and a dash, a bold one first; the venue is a bold third-level heading; the league is such a
    heading in a centred cell, else the first that is no date or time and says cup, liga, league, serie or hockey.
    """
    title = html_unescape(F.coalesce(blank_to_null(F.regexp_extract(html, r"(?s)<title>([^<]* - [^<]*)</title>", 1)), blank_to_null(F.regexp_extract(html, r"(?s)<h\d>([^<]* - [^<]*)</h\d>", 1))))
    found = lambda pattern, i=1: blank_to_null(F.regexp_extract(html, pattern, i))
    bold, block = r"<div[^>]*bold[^>]*>\s*(\d+)\s*-\s*(\d+)\s*</div>", r"<div[^>]*>\s*(\d+)\s*-\s*(\d+)\s*</div>"
    heads = F.regexp_extract_all(html, F.lit(r"<h3[^>]*>([^<]+)</h3>"), F.lit(1))
    league = F.get(F.filter(heads, lambda h: ~h.rlike(r"^\s*(\d{4}-\d{2}-\d{2}|\d{2}:\d{2})") & F.lower(h).rlike("cup|liga|league|serie|hockey")), F.lit(0))
    return pages.select(
        key, F.trim(F.split_part(title, F.lit(" - "), F.lit(1))).alias("home_team"), F.trim(F.split_part(title, F.lit(" - "), F.lit(2))).alias("away_team"), found(r"(\d{4}-\d{2}-\d{2})").alias("day"), found(r"\b(\d{2}:\d{2})\b").alias("time"),
        *(F.coalesce(found(bold, i), found(block, i)).try_cast("bigint").alias(n) for i, n in ((1, "home_score"), (2, "away_score"))),
        F.replace(found(r"(?i)Spectators:\s*([\d ]+)"), F.lit(" "), F.lit("")).try_cast("bigint").alias("attendance"), F.trim(html_unescape(found(r"<h3[^>]*>\s*<b>([^<]+)</b>"))).alias("venue"),
        F.trim(html_unescape(F.coalesce(found(r"<td[^>]*center[^>]*>\s*<h3[^>]*>([^<]+)</h3>"), league))).alias("league"),
    )


def page_period_scores(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Goals by period from ``(1-0, 2-1, 0-0)``."""
    scores = F.split(F.regexp_extract(html, r"\((\d+-\d+(?:, \d+-\d+)+)\)", 1), ", ")
    df = pages.select(key, F.posexplode(scores).alias("i", "s")).filter("s != ''")
    return df.select(key, (F.col("i") + 1).cast("bigint").alias("period"), F.split_part("s", F.lit("-"), F.lit(1)).cast("bigint").alias("home"), F.split_part("s", F.lit("-"), F.lit(2)).cast("bigint").alias("away"))


def page_boxscore(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Shots, saves and penalty minutes with their periods, save share, power-play share and time of both sides.

    A label's cell is followed by the number and ``(1st:2nd:3rd)``, or for ``PP`` by the share and the time; it stands first for the home team, then
    for the away team. Save shares are the other cells that are a share.
    """
    cells = F.transform(F.regexp_extract_all(html, F.lit(r"(?s)<td[^>]*>(.*?)</td>"), F.lit(1)), _plain)
    df = pages.select(key, cells.alias("words"))
    at = lambda label, i: F.get(places(lambda c: c == label), F.lit(i))
    share = lambda c: comma_decimal(F.regexp_replace(c, "%$", ""))
    shares = F.filter(F.transform("words", lambda c, i: F.when(c.rlike(r"^\d+,\d+%$") & ~F.coalesce(word(i - 1) == "PP", F.lit(False)), c)), lambda c: c.isNotNull())
    out = []
    for i, side in enumerate(("home", "away")):
        for label, name in (("Shots", "shots"), ("Saves", "saves"), ("PIM", "pim")):
            out += [word(at(label, i) + 1).try_cast("bigint").alias(f"{side}_{name}"), F.replace(blank_to_null(F.regexp_extract(word(at(label, i) + 2), r"^\((\d+:\d+:\d+)\)$", 1)), F.lit(":"), F.lit(",")).alias(f"{side}_{name}_by_period")]
        out += [share(F.get(shares, F.lit(i))).alias(f"{side}_save_pct"), share(word(at("PP", i) + 1)).alias(f"{side}_pp_pct"), clock_seconds(blank_to_null(F.regexp_extract(word(at("PP", i) + 2), r"^\((\d+:\d+)\)$", 1))).alias(f"{side}_pp_seconds")]
    return df.select(key, *out)


def page_goalkeepers(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``(key, team, number, name, save_pct, saves, shots)`` of the rows of the section ``Goalkeeper Summary``, which ends at the next third-level heading or with the page.

    A row has a cell ``30. Nor, Ed``, then one with a bold share and ``(23/25)``; the team is the first other cell of 2 to 10 characters of plain text on one line. Rows that lack
    one of these, and rows of other sections, are none.
    """
    section = F.regexp_extract(html, r"(?is)Goalkeeper Summary.*?(?:<h3>|\z)", 0)
    rows = pages.select(key, F.explode(F.regexp_extract_all(section, F.lit(r"(?s)<tr>.*?</tr>"), F.lit(0))).alias("row"))
    share, who = r"<strong>([\d,]+)%</strong>\s*\((\d+)/(\d+)\)", r"(?s)(\d+)\.\s*([^<]+)</td><td[^>]*><strong>"
    cells = F.transform(F.regexp_extract_all("row", F.lit(r"<td[^>]*>([^<]+)</td>"), F.lit(1)), lambda c: F.regexp_replace(c, r"^\s+|\s+$", ""))
    team = F.get(F.filter(cells, lambda c: ~c.contains("\n") & F.length(c).between(2, 10) & ~c.rlike(r"^\d+\.")), F.lit(0))
    rows = rows.filter(F.col("row").rlike(share) & F.col("row").rlike(who)).select(key, "row", team.alias("team")).filter("team IS NOT NULL")
    of = lambda pattern, i: F.regexp_extract("row", pattern, i)
    name = html_unescape(F.trim(F.regexp_replace(of(who, 2), r"\s+", " ")))
    return rows.select(key, "team", of(who, 1).cast("bigint").alias("number"), name.alias("name"), comma_decimal(of(share, 1)).alias("save_pct"), of(share, 2).cast("bigint").alias("saves"), of(share, 3).cast("bigint").alias("shots"))


#: What an event row says, as a pattern on its lower-case text, and the class that it means; the first that fits counts.
EVENT_CLASSES = (
    (r"gk|goalkeeper", "goalkeeper_change"),
    (r"goal|^\d+-\d+", "goal"),
    (r"min|penalty", "penalty"),
    (r"timeout|^to$", "timeout"),
    (r"powerbreak", "powerbreak"),
    (r"shootout|so", "shootout"),
    (r"review|challenge", "video_review"),
    (r"offside|icing", "stoppage"),
    (r"faceoff", "faceoff"),
    (r"hit", "hit"),
    (r"block", "blocked_shot"),
    (r"save", "save"),
)
#: Signs of a goal's type.
GOAL_SIGNS = (("(EQ)", "even_strength"), ("PP", "power_play"), ("SH", "short_handed"), ("ENG", "empty_net"))


def page_events(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Event rows ``12:34|what|team|who`` with their class and period: that of the last heading before them on the page, else by the minute of the page's first event.

    Headings of class ``tdSubTitle`` count, or where none of them names a period any heading that does. Goals have a type, the score and the power play's number; penalties minutes, what for and the clock from and to; who is the first
    number and surname, further ones are assists; participants are lists of numbers, joined by commas.
    """
    def periods(marks: Column) -> Column:
        low = lambda m: F.lower(_plain(m["text"]))
        of = lambda x: F.when(x.rlike(r"1st|1.*period|period.*1"), 1).when(x.rlike("2nd|2.*period|period.*2"), 2).when(x.rlike("3rd|3.*period|period.*3"), 3).when(x.rlike(r"overtime|\bot\b"), 4).when(x.rlike("shootout|^so period"), 5)
        return F.filter(F.transform(marks, lambda m: F.struct(m["at"].alias("at"), of(low(m)).cast("bigint").alias("period"))), lambda m: m["period"].isNotNull())

    told = pages.select(key, periods(found_in(html, r"""(?i)<th[^>]*class="tdSubTitle"[^>]*><h3>[^<]+</h3></th>""")).alias("titled"), periods(found_in(html, r"(?i)<h\d[^>]*>[^<]*(?:period|overtime|shootout)[^<]*</h\d>")).alias("headed"), found_in(html, r"(?s)<tr\b[^>]*>.*?</tr>").alias("rows"))
    timed = F.filter("rows", lambda r: r["text"].rlike(r"(?s)^<tr\b[^>]*>\s*<td[^>]*>(?:\s|<[^>]*>)*\d{1,3}:\d{2}\s*<"))
    told = told.select(key, F.when(F.size("titled") > 0, F.col("titled")).otherwise(F.col("headed")).alias("marks"), timed.alias("events"))
    first = inferred_period(clock_seconds(F.regexp_extract(F.get("events", F.lit(0))["text"], r"(\d{1,3}:\d{2})\s*<", 1)))
    # With explode Spark would first read each page's events for a filter on their number, below any shuffle, and then again.
    rows = told.select(key, "marks", first.alias("first"), F.explode_outer("events").alias("e")).filter("e IS NOT NULL")
    c = F.split(_plain(F.col("e.text")), r"\|")
    rows = rows.select(key, F.col("e.at").alias("pos"), F.coalesce(last_before(F.col("marks"), F.col("e.at"))["period"], F.col("first")).alias("head"), c.alias("cells"))
    rows = rows.select(key, "pos", "head", *(F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(("clock", "what", "team", "who"))))
    seconds, what, who = clock_seconds(F.col("clock")), F.col("what"), F.coalesce("who", F.lit(""))
    kind = None
    for pattern, name in EVENT_CLASSES:
        kind = (F if kind is None else kind).when(F.lower(what).rlike(pattern), name)
    kind = kind.otherwise("other")
    goal_type = None
    for sign, name in GOAL_SIGNS:
        goal_type = (F if goal_type is None else goal_type).when(what.contains(sign), name)
    rows = rows.withColumn("event", kind)
    of = lambda event, value: F.when(F.col("event") == event, value)
    said = lambda text, pattern, i=1: blank_to_null(F.trim(F.regexp_extract(text, pattern, i)))
    people = F.regexp_extract_all(who, F.lit(r"\d{1,3}\. ?[^,|]+"), F.lit(0))
    surname = lambda p: F.trim(F.regexp_replace(p, r"^\d{1,3}\. ?", ""))
    part = lambda sign: blank_to_null(F.array_join(F.regexp_extract_all(F.regexp_extract(who, rf"(?i){sign}\. ?Part\.: ?([\d ,]+)", 1), F.lit(r"\d+"), F.lit(0)), ","))
    first = F.get(people, F.lit(0))
    return rows.select(
        key, "pos", seconds.alias("seconds"), F.col("head").alias("period"), "event", of("goal", goal_type.otherwise("unknown")).alias("goal_type"), of("goal", said(what, r"PP(\d+)").try_cast("bigint")).alias("power_play_number"),
        *(F.when(F.col("event").isin("goal", "shootout"), said(what, r"(\d+)-(\d+)", i).try_cast("bigint")).alias(n) for i, n in ((1, "score_home"), (2, "score_away"))),
        of("penalty", said(what, r"(\d+) ?min").try_cast("bigint")).alias("penalty_minutes"), of("penalty", said(who, r"([A-Za-z ]+) ?\(")).alias("penalty_type"),
        *(of("penalty", clock_seconds(said(who, r"\((\d{2,3}:\d{2}) ?- ?(\d{2,3}:\d{2})\)", i))).alias(n) for i, n in ((1, "penalty_start"), (2, "penalty_end"))),
        of("goalkeeper_change", F.when(F.lower(what).rlike(r"\bin\b"), "in").when(F.lower(what).rlike(r"\bout\b"), "out")).alias("goalkeeper_action"), "team",
        F.regexp_extract(first, r"^(\d+)", 1).try_cast("bigint").alias("player_number"), surname(first).alias("player"), of("goal", blank_to_null(F.array_join(F.transform(F.slice(people, 2, 9), surname), ","))).alias("assists"),
        part("Pos").alias("positive_participants"), part("Neg").alias("negative_participants"),
    )


def inferred_period(seconds: Column) -> Column:
    """Period of a minute where no heading says it: 4 from minute 40, 3 from minute 20, else 2."""
    return F.when(seconds >= 2400, 4).when(seconds >= 1200, 3).otherwise(2).cast("bigint")
