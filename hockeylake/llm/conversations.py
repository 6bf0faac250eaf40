"""Conversation structure repair: turns are aligned to an alternating grammar of roles at least cost."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hockeylake.llm.common import intermediates, keep, stash

#: What edits cost.
REROLE, DELETE, INSERT, CUT_SHORT = 3, 4, 3, 3
_NOT_BLANK = r"[^\x20\x09-\x0D]"
#: What a turn is to the alignment: its role's initial (s, u, a or other), and whether it must go or is cut short.
_INITIALS = "sua."
_FULL, _GONE, _SHORT = 0, 4, 8


def target(length: int) -> str:
    """The grammar ``(s?(ua)+)?`` has one string of each length but 1: with ``s`` where it is odd."""
    return "s" * (length % 2) + "ua" * (length // 2)


def align(codes: bytes, length: int, bound: int) -> tuple[int, str] | None:
    """Wagner-Fischer alignment of turns to the grammar's string of one length: ``(cost, audit)`` if it costs ``bound`` at most.

    Costs are those of what follows a cell, so that the audit, which is least by ASCII among the cheapest, is read off from the front.
    Ukkonen's band: a cell off the diagonals between the two ends takes more deletions or insertions than ``bound`` pays for.
    """
    n, wanted = len(codes), target(length)
    shift = length - n
    # A path through (i, j) inserts and deletes at least |j - i| and |shift - (j - i)| times.
    spare = bound - (INSERT * shift if shift >= 0 else -DELETE * shift)
    if spare < 0:
        return None
    room = spare // (INSERT + DELETE)
    low, high = min(0, shift) - room, max(0, shift) + room
    never = 1 << 30
    width = high - low + 1
    after = [[never] * width for _ in range(n + 1)]
    for i in range(n, -1, -1):
        row, below = after[i], after[i + 1] if i < n else None
        code = codes[i] if i < n else 0
        initial, fault = _INITIALS[code & 3], code & 12
        more = CUT_SHORT if fault == _SHORT else 0
        for d in range(min(high, length - i), low - 1, -1):
            j = i + d
            if j < 0:
                break
            best = 0 if i == n and j == length else never
            if j < length and d < high:
                best = min(best, INSERT + row[d + 1 - low])
            if below is not None:
                if d > low:
                    best = min(best, DELETE + below[d - 1 - low])
                if j < length and fault != _GONE:
                    kind = 0 if initial == wanted[j] else REROLE if wanted[j] != "s" else never
                    best = min(best, kind + more + below[d - low])
            row[d - low] = best
    cost = after[0][-low]
    if cost > bound:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < length:
        d, here = j - i - low, after[i][j - i - low]
        code = codes[i] if i < n else 0
        if i < n and d > 0 and here == DELETE + after[i + 1][d - 1]:
            audit.append("D")
            i += 1
        elif j < length and d + 1 < width and here == INSERT + after[i][d + 1]:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if _INITIALS[code & 3] == wanted[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


def repair(codes: bytes) -> tuple[int, str]:
    """The least cost over all feasible lengths, and of all cheapest audits the least by ASCII.

    The incumbent, to begin with the deletion of all, narrows the bands of the lengths that follow, nearest first.
    """
    n = len(codes)
    cost, audit = DELETE * n, "D" * n
    for length in sorted((m for m in range(3 * n + 4) if m != 1), key=lambda m: (abs(m - n), m)):
        if INSERT * (length - n) > cost:
            break
        found = align(codes, length, cost)
        if found and (found[0] < cost or found[1] < audit):
            cost, audit = found
    return cost, audit


def repair_long(codes: bytes) -> tuple[int, str]:
    """``repair`` in time and memory in proportion to the turns: all lengths at once, by what the grammar may expect next.

    States: nothing yet, after ``s``, after ``u``, after ``a``. The audit is read off from the front as in ``align``.
    """
    n, never = len(codes), 1 << 60
    # Which state the letter leads to from each state: (letter, next).
    steps = (((0, 1), (1, 2)), ((1, 2),), ((2, 3),), ((1, 2),))
    after = np.full((n + 1, 4), never, dtype=np.int64)
    inserts = [[(letter, to) for letter, to in of if letter] for of in steps]  # s is never inserted

    def close(row: list[int]) -> list[int]:
        for _ in range(3):  # at most two insertions in a row pay
            row = [min([row[q], *(INSERT + row[to] for _, to in inserts[q])]) for q in range(4)]
        return row

    row = close([0, never, never, 0])
    after[n] = row
    for i in range(n - 1, -1, -1):
        initial, fault = codes[i] & 3, codes[i] & 12
        more = CUT_SHORT if fault == _SHORT else 0
        here = [DELETE + row[q] for q in range(4)]
        if fault != _GONE:
            for q in range(4):
                for letter, to in steps[q]:
                    if letter == initial or letter:
                        here[q] = min(here[q], (0 if letter == initial else REROLE) + more + row[to])
        row = close(here)
        after[i] = row
    audit, i, q = bytearray(), 0, 0
    while True:
        here = after[i, q]
        if i == n and q in (0, 3) and here == 0:
            break
        code = codes[i] if i < n else 0
        if i < n and here == DELETE + after[i + 1, q]:
            audit += b"D"
            i += 1
            continue
        into = [to for _, to in inserts[q] if here == INSERT + after[i, to]]
        if into:
            audit += b"I"
            q = into[0]
            continue
        initial, more = code & 3, CUT_SHORT if code & 12 == _SHORT else 0
        kept = [to for letter, to in steps[q] if letter == initial and here == more + after[i + 1, to]]
        if kept:
            audit += b"K"
            i, q = i + 1, kept[0]
            continue
        q = next(to for letter, to in steps[q] if letter and letter != initial and here == REROLE + more + after[i + 1, to])
        audit += b"R"
        i += 1
    return int(after[0, 0]), audit.decode()


def damage(rows: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text)``, of which role and text are not null, damaged by the CRC-32 of ``conv_id:turn`` (null: one blank), modulo 20.

    0 drops the row, 1 empties its text, 2 removes ``.``, ``!`` and ``?``, 3 repeats the row, 4 makes the role user. An empty table stays empty.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    how = F.crc32(key) % 20
    text = F.when(how == 1, "").when(how == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(how == 0, F.array().cast("array<int>")).when(how == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(how == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times).alias("_copy")).drop("_copy")


def _code(seen: Column) -> Column:
    """A turn's code: its role's initial and its first fault."""
    blank, last = ~F.col("text").rlike(_NOT_BLANK), F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    initial = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for k, c in enumerate("sua") for x in (c, k))), F.substring("role", 1, 1)), F.lit(3))
    fault = F.when(blank | seen, _GONE).when(~last, _SHORT).otherwise(_FULL)
    return (initial + fault).cast("int")


def _summary(codes: np.ndarray, blank: int, duplicate: int, audit_of: Callable[[bytes], tuple[int, str]]) -> tuple:
    """Counts of faults, adjacent roles that the grammar doesn't know, cost and audit."""
    initial = codes & 3
    illegal = int((~np.isin(initial[:-1] * 4 + initial[1:], (0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1))).sum())
    return blank, duplicate, int((codes & 12 == _SHORT).sum()), illegal, *audit_of(codes.astype(np.uint8).tobytes())


def _gaps(turns: list[int | None]) -> int:
    told = {t for t in turns if t is not None}
    return max(told) - min(told) + 1 - len(told) if told else 0


def _repaired(audit: str, role_text: Iterator[tuple[str, str]], place: int, odd: int) -> Iterator[str]:
    """The repaired turns ``role:text`` that an audit, or a part of it before which ``place`` turns stand, gives; what is put in or given another role takes it from the grammar."""
    for edit in audit:
        name = ("user", "assistant")[(place - odd) % 2]
        if edit == "I":
            yield f"{name}:"
        else:
            role, text = next(role_text)
            if edit == "D":
                continue
            yield f"{role if edit == 'K' else name}:{text}"
        place += 1


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NAMES = [c.split()[0] for c in RESULT.split(", ")]


def _told(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_NAMES)
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_NAMES)


def _short_ones(batches: Iterator[pa.RecordBatch], aligned: int) -> Iterator[pa.RecordBatch]:
    """Conversations one after the other, of rows (conv_id, turn, role, text, code) in order of conversation and turn."""
    memo: dict[bytes, tuple[int, str]] = {}

    def audit_of(codes: bytes) -> tuple[int, str]:
        found = memo.get(codes)
        if found is None:
            if len(memo) > 100_000:
                memo.clear()
            found = memo[codes] = (repair if len(codes) <= aligned else repair_long)(codes)
        return found

    def one(conv: int | None, rows: list[tuple]) -> tuple:
        seen, codes, blank, duplicate = set(), [], 0, 0
        for _, role, text, code in rows:
            if code & 12 == _GONE:
                blank += 1
            elif (role, text) in seen:
                duplicate, code = duplicate + 1, code & 3 | _GONE
            seen.add((role, text))
            codes.append(code)
        told = _summary(np.array(codes, dtype=np.int64), blank, duplicate, audit_of)
        odd = (len(told[-1]) - told[-1].count("D")) % 2
        digest = hashlib.sha256("\n".join(_repaired(told[-1], ((r[1], r[2]) for r in rows), 0, odd)).encode())
        return (conv, _gaps([r[0] for r in rows]), *told, digest.hexdigest())

    held: list[tuple] = []
    conv: int | None = None
    for batch in batches:
        out = []
        for c, *row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if held and c != conv:
                out.append(one(conv, held))
                held = []
            conv = c
            held.append(tuple(row))
        yield _told(out)
    if held:
        yield _told([one(conv, held)])


def _decide(pdf: pd.DataFrame) -> pd.DataFrame:
    """The audit of one conversation, from its blocks' codes, in a piece for each block: what goes in before a turn is in its block."""
    pdf = pdf.sort_values("block", ignore_index=True)
    codes = np.concatenate([np.asarray(c, dtype=np.int64) for c in pdf["codes"]])
    *told, audit = _summary(codes, int(pdf["blank"].sum()), int(pdf["duplicate"].sum()), repair_long)
    edits = np.frombuffer(audit.encode(), dtype=np.uint8)
    turns, made = np.cumsum(edits != ord("I")), np.cumsum(edits != ord("D"))
    ends = np.searchsorted(turns, np.cumsum(pdf["codes"].map(len))) + 1
    ends[-1] = len(audit)
    starts = np.concatenate([[0], ends[:-1]])
    out = pdf[["conv_id", "at"]].assign(piece=[audit[a:b] for a, b in zip(starts, ends, strict=True)], place=[int(made[a - 1]) if a else 0 for a in starts], odd=int(made[-1]) % 2)
    return out.assign(**dict(zip(_NAMES[2:7], told, strict=True)))


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole audits and digests of repaired turns, of rows (conv_id, role, text, begins, piece, place, odd, counts...) in order; texts go by one by one."""
    conv, held, pieces, counts, digest, some = None, None, [], (), hashlib.sha256(), False
    piece, place, odd = "", 0, 0

    def put(role_text: list[tuple[str, str]]) -> None:
        nonlocal some
        for turn in _repaired(piece, iter(role_text), place, odd):
            digest.update((("\n" if some else "") + turn).encode())
            some = True

    def end() -> tuple:
        put(held)
        return (conv, 0, *counts, "".join(pieces), digest.hexdigest())

    for batch in batches:
        out = []
        for c, role, text, begins, p, at, o, *told in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if begins:
                if held is not None and c == conv:
                    put(held)
                elif held is not None:
                    out.append(end())
                if held is None or c != conv:
                    pieces, counts, digest, some = [], tuple(told), hashlib.sha256(), False
                conv, held, piece, place, odd = c, [], p, at, o
                pieces.append(p)
            held.append((role, text))
        yield _told(out)
    if held is not None:
        yield _told([end()])


def _long_ones(rows: DataFrame, block: int) -> DataFrame:
    """The same for conversations of any length: a task holds a block of turns at most, and of a whole conversation a byte a turn."""
    with intermediates(rows.sparkSession):
        ordered = rows.withColumn("_n", F.monotonically_increasing_id()).orderBy(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "_n")
        ordered = stash(ordered.drop("_n").withColumn("at", F.monotonically_increasing_id()), "long-turns")
        same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
        firsts = ordered.groupBy("conv_id", same).agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
        coded = ordered.join(firsts, "at", "left").select("conv_id", "at", F.floor(F.col("at") / block).alias("block"), _code(F.col("new").isNull()).alias("code"), (~F.col("text").rlike(_NOT_BLANK)).alias("blank"))
        gone = F.col("code").bitwiseAND(F.lit(12)) == _GONE
        packed = coded.groupBy("conv_id", "block").agg(  # ``block`` turns at most
            F.min("at").alias("at"), F.transform(F.sort_array(F.collect_list(F.struct("at", "code"))), lambda x: x["code"]).alias("codes"), F.count_if("blank").alias("blank"), F.count_if(gone & ~F.col("blank")).alias("duplicate")
        )
        counts = ", ".join(f"{n} long" for n in _NAMES[2:7])
        pieces = stash(packed.groupBy("conv_id").applyInPandas(_decide, f"conv_id long, at long, piece string, place long, odd int, {counts}"), "pieces")
        joined = ordered.join(pieces.drop("conv_id"), "at", "left").select("at", "conv_id", "role", "text", F.col("piece").isNotNull().alias("begins"), "piece", "place", "odd", *_NAMES[2:7])
        streams = joined.repartition("conv_id").sortWithinPartitions("conv_id", "at").drop("at")
        told = streams.mapInArrow(_streamed, RESULT).drop("gaps")
        gaps = ordered.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")).withColumnRenamed("conv_id", "_c")
        return keep(told.join(gaps, F.col("conv_id").eqNullSafe(F.col("_c"))).select(*_NAMES), "long-conversations")


def repair_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", damaged: Callable[[DataFrame], DataFrame] = lambda df: df, aligned: int = 64, block: int = 4096) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` for every conversation of ``rows``.

    ``damaged`` is applied to the turns first, nulls in role and text being one blank by then. A conversation's turns
    are taken by turn, nulls first, and in ties by role and text. Its first fault counts for each: blank, duplicate (role and text stood before), truncated (ends in none
    of ``.!?``). Kept turns are free, a new role costs 3, a deletion 4 (blank and duplicate turns must go), an empty turn put in 3, a
    truncated turn that stays 3 more. The audit is the initials of the cheapest edits (K, R, D, I) that give roles
    of the form ``(s?(ua)+)?``, the least by ASCII of several.

    Method (Wagner-Fischer target alignment): the grammar has one string of each length. The turns are aligned to each
    feasible length in a band that the cheapest audit so far bounds (Ukkonen), and backtraced audits are compared; equal patterns of roles and faults
    are aligned once a task. Conversations of over ``aligned`` turns are aligned to all lengths at once, by the grammar's four
    states, to the same result in linear time. Those of over ``block`` turns are not gathered: their turns are numbered by a
    range sort, coded to a byte each, in blocks, and the texts go through the digest one by one.

    All null ids are one conversation; without a turn that is left, counts are 0 and the audit and the repaired text empty. Repeated rows are
    duplicates. Very long texts are turns like others; an empty table gives an empty result. Other columns are not read.
    """
    with intermediates(rows.sparkSession):
        text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
        all_rows = rows.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
        left = damaged(all_rows)
        sizes = all_rows.select("conv_id", F.lit(0).alias("n")).union(left.select("conv_id", F.lit(1).alias("n"))).groupBy("conv_id").agg(F.sum("n").alias("n"))
        odd = stash(sizes.filter((F.col("n") == 0) | (F.col("n") > block)), "odd-conversations")
        empty, long = odd.filter("n = 0"), odd.filter("n > 0").select(F.col("conv_id").alias("_long"))
        nothing = empty.select("conv_id", *(F.lit(0).cast("long").alias(n) for n in _NAMES[1:7]), F.lit("").alias("audit"), F.sha2(F.lit(""), 256).alias("repaired_sha256"))
        n_long = long.count()
        if n_long:
            marks = F.broadcast(long) if n_long <= 100_000 else long
            is_long = F.col("conv_id").eqNullSafe(F.col("_long"))
            nothing = nothing.unionByName(_long_ones(left.join(marks, is_long, "left_semi"), block))
            left = left.join(marks, is_long, "left_anti")
        coded = left.withColumn("code", _code(F.lit(False))).repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
        return keep(coded.mapInArrow(lambda it: _short_ones(it, aligned), RESULT).unionByName(nothing), "repaired")
