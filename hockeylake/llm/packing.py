"""Packing documents into training sequences by order-preserving dynamic programming over cut places."""

from __future__ import annotations

import json
import re
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hockeylake.llm.common import texts
from hockeylake.llm.token_counts import drops_space, load_tokenizer

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: A run of characters that ends a sentence.
_STOP, _MAY_STOP = re.compile(rb"""[.!?]["')\]]*$"""), b""".!?"')]"""
#: Bytes of a text that are encoded at once, and tokens whose cuts are chosen at once.
_SEGMENT, _BLOCK = 1 << 20, 1 << 20
_MEMO = 600_000


def padding(length: int, window: int) -> int:
    """What a sequence is filled up with: nothing at a power of two, else what it lacks of ``window``."""
    return 0 if length & (length - 1) == 0 else window - length


def choose_cuts(places: np.ndarray, penalties: np.ndarray, window: int, each: int = 8) -> tuple[int, list[int]]:
    """The cheapest way to end windows at some of ``places``, from 0 to the last place: its cost and the places.

    A window costs its padding, ``each``, and the penalty of the place where it ends. Places grow, and none is more than ``window`` after
    the one before. The best window that is padded begins at the place of least ``cost + place`` within reach, which
    a monotone queue keeps at its front; windows of a power of two are looked up. Of equal costs the earliest beginning counts.
    """
    at = np.concatenate([[0], places]).astype(np.int64)
    exact: dict[int, list[int]] = {}
    for k in range(window.bit_length()):
        size = 1 << k
        if size <= window:
            i = np.searchsorted(at, at - size)
            for j in np.flatnonzero((at >= size) & (at[np.minimum(i, len(at) - 1)] == at - size)).tolist():
                exact.setdefault(j, []).append(int(i[j]))
    at, pen = at.tolist(), [0, *penalties.tolist()]
    cost, came = [0] * len(at), [0] * len(at)
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # cost + place, place, number
    for j in range(1, len(at)):
        here = at[j]
        while queue[0][1] < here - window:
            queue.popleft()
        best, origin = queue[0][0] + window - here, queue[0][2]
        for i in exact.get(j, ()):
            if cost[i] < best or (cost[i] == best and i < origin):
                best, origin = cost[i], i
        cost[j], came[j] = best + each + pen[j], origin
        value = cost[j] + here
        while queue and queue[-1][0] > value:
            queue.pop()
        queue.append((value, here, j))
    ends, j = [], len(at) - 1
    while j:
        ends.append(at[j])
        j = came[j]
    return cost[-1], ends[::-1]


#: Characters of which lower case and normal form are one character each, whatever stands beside them: ASCII without controls, and Latin letters but for the dotted I.
_SIMPLE = regex.compile(r"[!-~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017F]+")
#: The characters that stand for bytes in the vocabulary: printable ones for themselves, all others from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_AS_CHAR = {b: chr(b) if b in _PRINTED else chr(256 + b - sum(p < b for p in _PRINTED)) for b in range(256)}


class Encoder:
    """Ids of texts in segments. Where the tokenizer allows, each distinct run between white space is encoded once, and of simple runs each distinct piece that its pattern cuts."""

    def __init__(self, path: str, end_id: int) -> None:
        from tokenizers import Tokenizer

        self.by_run, self.end_id = drops_space(load_tokenizer(path)[1]), end_id
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.cut, self.special = self.tokenizer.model, None, regex.compile(r"(?!)")
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        steps = [n.get("type") for n in (said.get("normalizer") or {}).get("normalizers", [])]
        cuts = (said.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if steps == ["NFC", "Replace", "Lowercase"] and [c.get("type") for c in cuts] == ["Split", "ByteLevel"] and cuts[0].get("invert") and cuts[0].get("behavior") == "Removed" and not cuts[1].get("add_prefix_space") and not cuts[1].get("use_regex"):
            self.cut = regex.compile(f"(?:{cuts[0]['pattern']['Regex']})|\n").findall
            names = [regex.escape(t["content"]) for t in said.get("added_tokens", [])]
            self.special = regex.compile("|".join(names)) if names else self.special
        self._clear()

    def _clear(self) -> None:
        # What is known by number: runs, of which 0 is the end of a document, and pieces, of which 0 is the end of a run.
        self.memo: dict[bytes | None, int] = {None: 0}
        self.runs, self.stop = _Arena([[self.end_id]]), np.zeros(1, dtype=bool)
        self.known: dict[str, int] = {"\n": 0}
        self.pieces = _Arena([[]])

    def _tokens(self, piece: str) -> list[int]:
        return [t.id for t in self.model.tokenize(piece if piece.isascii() else "".join(map(_AS_CHAR.__getitem__, piece.encode())))]

    def learn(self, words: list[bytes]) -> None:
        """Encode the words that are not known yet."""
        new = {w for w in set(words) if w not in self.memo}
        if len(self.memo) + len(new) > _MEMO:
            self._clear()
            new = set(words)
        if not new:
            return
        said = [w.decode() for w in new]
        simple = [w for w in said if _SIMPLE.fullmatch(w)] if self.cut else []
        if self.special.search("\n".join(simple)):
            simple = [w for w in simple if not self.special.search(w)]
        if simple:
            found = self.cut("\n".join(simple).lower())
            unknown = [p for p in set(found) if p not in self.known]
            self.known.update(zip(unknown, range(len(self.known), len(self.known) + len(unknown)), strict=True))
            self.pieces.add([self._tokens(p) for p in unknown])
            which = np.fromiter(map(self.known.__getitem__, found), dtype=np.int64, count=len(found))
            ids, sizes = self.pieces.take(which)
            self.runs.add_flat(ids, np.bincount(np.cumsum(which == 0), weights=sizes, minlength=len(simple)).astype(np.int64))
        rest = [w for w in said if w not in set(simple)] if len(simple) < len(said) else []
        for at in range(0, len(rest), 20_000):
            self.runs.add([e.ids for e in self.tokenizer.encode_batch_fast(rest[at : at + 20_000], add_special_tokens=False)])
        order = [w.encode() for w in simple + rest]
        self.stop = np.concatenate([self.stop, np.fromiter((w[-1] in _MAY_STOP and bool(_STOP.search(w)) for w in order), dtype=bool, count=len(order))])
        self.memo.update(zip(order, range(len(self.memo), len(self.memo) + len(order)), strict=True))

    def encode(self, parts: list[tuple[bytes, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of parts of documents, each with whether its document ends, in one stream; where the parts end there, where sentences end and where documents end."""
        if not self.by_run:
            return self._encode_whole(parts)
        words = [part.split() for part, _ in parts]
        self.learn(list(chain.from_iterable(words)))
        count = np.cumsum([len(w) + ends for w, (_, ends) in zip(words, parts, strict=True)])
        stream = chain.from_iterable(chain(w, (None,)) if ends else w for w, (_, ends) in zip(words, parts, strict=True))
        which = np.fromiter(map(self.memo.__getitem__, stream), dtype=np.int64, count=int(count[-1]))
        ids, sizes = self.runs.take(which)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return ids, upto[count], upto[1:][self.stop[which]], upto[1:][which == 0]

    def _encode_whole(self, parts: list[tuple[bytes, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        ids, bounds, sentences, ends = [], [], [], []
        for part, last in parts:
            text = part.decode()
            e = self.tokenizer.encode(text, add_special_tokens=False)
            sentences += [len(ids) + k + 1 for k, (_, b) in enumerate(e.offsets) if b and text[b - 1] in ".!?"]
            ids += e.ids
            if last:
                ids.append(self.end_id)
                ends.append(len(ids))
            bounds.append(len(ids))
        return np.array(ids, dtype="<u4"), *(np.array(x, dtype=np.int64) for x in (bounds, sentences, ends))


class _Arena:
    """Lists of ids by number, end to end."""

    def __init__(self, lists: list[list[int]]) -> None:
        self.ids, self.used = np.empty(1 << 12, dtype="<u4"), 0
        self.begin, self.size, self.count = np.empty(1 << 12, dtype=np.int64), np.empty(1 << 12, dtype=np.int64), 0
        self.add(lists)

    def add(self, lists: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        self.add_flat(np.fromiter(chain.from_iterable(lists), dtype="<u4", count=int(sizes.sum())), sizes)

    def add_flat(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        room = lambda x, need: x if need <= len(x) else np.concatenate([x, np.empty(max(need - len(x), len(x)), dtype=x.dtype)])
        used, count = self.used + len(ids), self.count + len(sizes)
        self.ids, self.begin, self.size = room(self.ids, used), room(self.begin, count), room(self.size, count)
        self.ids[self.used : used] = ids
        self.size[self.count : count] = sizes
        self.begin[self.count : count] = self.used + np.cumsum(sizes) - sizes
        self.used, self.count = used, count

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of lists, end to end, and how many each has."""
        sizes = self.size[which]
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(self.begin[which] - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)], sizes


def _segments(text: bytes, size: int) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes that end before white space."""
    start = 0
    while start < len(text):
        found = _SPACE.search(text, start + size) if len(text) - start > size else None
        end = found.start() if found else len(text)
        yield text[start:end]
        start = end


def _grouped(parts: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    """Lists of parts of about ``size`` bytes of text."""
    held, total = [], 0
    for part in parts:
        held.append(part)
        total += len(part[-1])
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


class Packer:
    """A stream of tokens with the places where it may be cut; rows of pieces come out a block at a time."""

    def __init__(self, window: int, sentence: int, inside: int, stride: int, first: int) -> None:
        self.window, self.sentence, self.inside, self.stride, self.next = window, sentence, inside, stride, first
        self.ids: list[np.ndarray] = []
        self.spans: list[tuple[int, int, int]] = []  # document, its ids before, length
        self.size, self.last, self.places, self.penalties = 0, 0, [], []
        self.rows: list[tuple[int, int, int, int, int, int]] = []

    def add(self, ids: np.ndarray, spans: list[tuple[int, int, int]], sentences: np.ndarray, ends: np.ndarray) -> None:
        """The next ids, whose documents are ``spans``; sentences and documents end at places that count from these ids."""
        places = np.union1d(sentences, ends) + self.size
        penalties = np.full(len(places), self.sentence, dtype=np.int64)
        penalties[np.searchsorted(places, ends + self.size)] = 0
        self.size += len(ids)
        marks = np.concatenate([[self.last], places, [self.size]])
        filled = [np.arange(marks[i] + self.stride, marks[i + 1], self.stride) for i in np.flatnonzero(np.diff(marks) > self.stride).tolist()]
        if filled:
            more = np.concatenate(filled)
            order = np.argsort(np.concatenate([places, more]), kind="stable")
            places, penalties = np.concatenate([places, more])[order], np.concatenate([penalties, np.full(len(more), self.inside, dtype=np.int64)])[order]
        self.last = int(places[-1]) if len(places) else self.last
        self.places.append(places.astype(np.int64))
        self.penalties.append(penalties)
        self.ids.append(ids)
        self.spans += [x for x in spans if x[2]]
        if self.size >= _BLOCK:
            self.flush(False)

    def flush(self, last: bool) -> None:
        """Choose cuts of what is held. Unless it is the last of the stream, what follows the last cut but one waits for more."""
        if not self.last:
            return
        places, penalties = np.concatenate(self.places), np.concatenate(self.penalties)
        _, ends = choose_cuts(places, penalties, self.window)
        done = ends[-1] if last else (ends[-2] if len(ends) > 1 else 0)
        if not done:
            return
        ids = np.concatenate(self.ids)
        cuts, start = [], 0
        for end in ends:
            if end <= done:
                cuts += self._parts(start, end)
                start = end
        bounds = np.cumsum([0, *(n for *_, n in self.spans)]).tolist()
        i, start = 0, 0
        for end in cuts:
            at = start
            while at < end:
                while bounds[i + 1] <= at:
                    i += 1
                doc, before, _ = self.spans[i]
                stop = min(end, bounds[i + 1])
                self._piece(doc, before + at - bounds[i], ids[at:stop], at - start)
                at = stop
            self.next += 1
            start = end
        rest = [(doc, before + max(0, done - lo), hi - max(lo, done)) for (doc, before, _), lo, hi in zip(self.spans, bounds[:-1], bounds[1:], strict=True) if hi > done]
        later = places > done
        self.ids, self.spans, self.size, self.last = [ids[done:]], rest, self.size - done, self.last - done
        self.places, self.penalties = [places[later] - done], [penalties[later]]

    def _parts(self, start: int, end: int) -> list[int]:
        """The ends of a window, or of its powers of two where that costs less than its padding."""
        length = end - start
        if padding(length, self.window) <= (length.bit_count() - 1) * (self.inside + 8):
            return [end]
        return [start + ((length >> k) << k) for k in reversed(range(length.bit_length())) if length >> k & 1]

    def _piece(self, doc: int, start: int, ids: np.ndarray, offset: int) -> None:
        """A piece; one that goes on in the same sequence after a segment's end is joined to it."""
        if self.rows and self.rows[-1][0] == doc and self.rows[-1][4] == self.next:
            d, s, n, crc, seq, off = self.rows.pop()
            self.rows.append((d, s, n + len(ids), zlib.crc32(ids, crc), seq, off))
        else:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids), self.next, offset))


def _packed(batches: Iterator[pa.RecordBatch], path: str, end_id: int, window: int, sentence: int, inside: int, stride: int) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(path, end_id)
    context = TaskContext.get()
    packer = Packer(window, sentence, inside, stride, (context.partitionId() if context else 0) << 40)
    names: dict[int, int | None] = {}
    totals: dict[int, int] = {}
    number = before = 0

    def told(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        out = [pa.array([names[d] for d in columns[0]], pa.int64()), *(pa.array(c, pa.int64()) for c in columns[1:4]), pa.array([totals[d] for d in columns[0]], pa.int64()), *(pa.array(c, pa.int64()) for c in columns[4:6])]
        return pa.RecordBatch.from_arrays(out, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    def segments(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bool, bytes]]:
        """``(id, whether the document ends, text)``."""
        for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch, 1), strict=True):
            parts = list(_segments(text, _SEGMENT)) or [b""]
            yield from ((doc_id, k == len(parts) - 1, part) for k, part in enumerate(parts))

    for batch in batches:
        for group in _grouped(segments(batch), 2 * _SEGMENT):
            ids, bounds, sentences, ended = encoder.encode([(part, ends) for _, ends, part in group])
            spans, start = [], 0
            for (doc_id, ends, _), stop in zip(group, bounds.tolist(), strict=True):
                spans.append((number, before, stop - start))
                before, start = before + stop - start, stop
                if ends:
                    names[number], totals[number] = doc_id, before
                    number, before = number + 1, 0
            packer.add(ids, spans, sentences, ended)
        if packer.rows and not before:  # every document so far is whole: its number of tokens is known
            yield told(packer.rows)
            packer.rows = []
            waiting = packer.spans[0][0] if packer.spans else number
            names, totals = ({d: v for d, v in x.items() if d >= waiting} for x in (names, totals))
    packer.flush(True)
    yield told(packer.rows)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = 4096, end_id: int = 2, sentence: int = 2, inside: int = 16, stride: int = 128) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, a row for each piece of a document in a sequence.

    A document is the ids of its whole text by ``tokenizer``, a .json file every executor has, without special
    tokens added, and ``end_id``. Sequences have ``window`` ids at most and are padded to that, unless their length is a power of two.

    Method (order-preserving dynamic programming): documents keep the order in which a task reads them and are one stream
    of ids. It may be cut where a document ends (free), where a sentence ends (penalty ``sentence``, in ids of
    padding) and, in sentences of more than ``stride`` ids, every ``stride`` ids (penalty ``inside``). ``choose_cuts`` finds the windows
    that minimise padding and penalties, with a monotone queue. It works on a million ids at once, of which the last window
    waits for what follows, so that memory is bounded and a document of any length goes through in segments of 1 MB.
    A window that costs less in powers of two than in padding, as the last of a task, is cut into those.

    Where tokens don't cross white space, each distinct run between white space is encoded once, and where the file cuts lower-cased text by a pattern,
    each distinct piece, by the library's model. One pass, no shuffle: a lost
    executor repeats its own splits, to the same result. Sequence ids are the task's number in the high bits and a
    count from 0.

    A null text counts as empty and is ``end_id`` alone; a null id stays null; repeated rows are packed each; an empty table gives an
    empty result. Other columns are not read.
    """
    if not 1 <= stride <= window:
        raise ValueError("stride must be from 1 to window")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _packed(it, tokenizer, end_id, window, sentence, inside, stride), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
