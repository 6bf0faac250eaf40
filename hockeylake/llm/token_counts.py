"""Token counts of whole texts, with overlap resynchronisation for huge documents."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: White space at which the supported tokenizers always break: no token and no special string spans it,
#: and what they do with the text after it doesn't depend on the text before.
_RUN = re.compile(r"[^\x20\x09-\x0D]+")
_MEMO = 300_000

Encode = Callable[[str], list[tuple[int, int, int]]]


def stable_boundaries(text: str, low: int, high: int) -> list[int]:
    """Positions in [low, high] where white space ends and a word begins."""
    return [m.start() for m in _RUN.finditer(text, max(low - 1, 0), high) if m.start() >= low and m.start() and text[m.start() - 1] in "\x20\t\n\x0b\x0c\r"]


def count_by_resync(text: str, encode: Encode, chunk: int = 4096, overlap: int = 256, agree: int = 4) -> int:
    """Tokens of ``text``, encoded in chunks that overlap.

    ``encode`` gives ``(id, start, end)`` for a piece of text. Neighbouring chunks are spliced at a
    boundary in their overlap that is proven stable (white space before it) and at which both
    encodings agree: the ``agree`` tokens on either side have equal ids and places, as far as the
    overlap holds so many. If no boundary in the overlap passes, the overlap is doubled and the
    later chunk encoded again. A chunk without such a boundary is encoded anew with as much text again behind it,
    so that the result is always that of the whole text, at about twice the cost at worst.
    """
    total, start, end = 0, 0, min(len(text), chunk)
    tokens = encode(text[:end])
    while end < len(text):
        cut, width = None, overlap
        while cut is None and end - width > start:
            left, width = end - width, 2 * width
            if not stable_boundaries(text, left + 1, end - 1):
                continue
            reach = min(len(text), left + max(chunk, width))
            later = [(i, a + left, b + left) for i, a, b in encode(text[left:reach])]
            cut = _splice(text, tokens, later, left, end, agree)
        if cut is None:
            reach = min(len(text), 2 * end - start)
            tokens = [(i, a + start, b + start) for i, a, b in encode(text[start:reach])]
        else:
            total += sum(1 for t in tokens if t[1] < cut)
            tokens, start = [t for t in later if t[1] >= cut], cut
        end = reach
    return total + len(tokens)


def _splice(text: str, before: list, after: list, left: int, end: int, agree: int) -> int | None:
    bounds = stable_boundaries(text, left + 1, end - 1)
    middle = (left + end) // 2
    for at in sorted(bounds, key=lambda p: abs(p - middle)):
        x, y = [t for t in before if left <= t[1] < at][-agree:], [t for t in after if t[1] < at][-agree:]
        u, v = [t for t in before if t[1] >= at][:agree], [t for t in after if t[1] >= at][:agree]
        k, m = min(len(x), len(y)), min(len(u), len(v))
        # The first token of the later chunk and the last of the earlier one may be cut short: leave them out.
        k, m = min(k, len(y) - 1) if len(y) < agree else k, min(m, len(u) - 1) if len(u) < agree else m
        if k >= 1 and m >= 1 and x[-k:] == y[-k:] and u[:m] == v[:m]:
            return at
    return None


def load_tokenizer(path: str) -> tuple[Callable[[list[str]], list[int]], Encode]:
    """``(count of each text of a list, encode with offsets)`` for a .json or .model file.

    No begin, end or added special tokens, no truncation or padding; special strings inside texts
    are handled as the library does by default.
    """
    if path.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()

        def encode(text: str) -> list[tuple[int, int, int]]:
            e = t.encode(text, add_special_tokens=False)
            return [(i, a, b) for i, (a, b) in zip(e.ids, e.offsets, strict=True)]

        return lambda xs: [len(e) for e in t.encode_batch_fast(xs, add_special_tokens=False)], encode
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)

        def pieces(text: str) -> list[tuple[int, int, int]]:
            found = sp.encode(text, return_type="offset_mapping")
            return [(i, a, b) for i, (a, b) in zip(found["ids"], found["offsets"], strict=True)]

        return lambda xs: [len(x) for x in sp.encode(xs, num_threads=1)], pieces
    raise ValueError(f"neither .json nor .model: {path}")


def drops_space(encode: Encode) -> bool:
    """Whether a tokenizer's tokens of a text are those of its runs between white space, in order."""
    ids = lambda text: [i for i, *_ in encode(text)]
    probes = ("a b", " a", "a ", "a  b", "a\n\nb", "a\tb", "A, \r\n1 B.", "é \x0bß\x0c ''s")
    return all(ids(p) == [i for w in _RUN.findall(p) for i in ids(w)] for p in probes)


def _counts(batches: Iterator[pa.RecordBatch], path: str, chunk: int, overlap: int, by_run: bool | None) -> Iterator[pa.RecordBatch]:
    count, encode = load_tokenizer(path)
    by_run = drops_space(encode) if by_run is None else by_run
    memo: dict[str, int] = {}
    for batch in batches:
        sizes, tokens = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
        held, rows, chars = [], [], 0

        def flush() -> None:
            if by_run:
                new = list({w for words in held for w in words if w not in memo})
                if len(memo) + len(new) > _MEMO:
                    memo.clear()
                    new = list({w for words in held for w in words})
                for at in range(0, len(new), 20_000):
                    memo.update(zip(new[at : at + 20_000], count(new[at : at + 20_000]), strict=True))
                for i, words in zip(rows, held, strict=True):
                    tokens[i] = sum(map(memo.__getitem__, words))
            else:
                tokens[rows] = count(held)

        for i, x in enumerate(batch.column(1)):
            text = x.as_py() or ""
            sizes[i] = len(text.encode())
            if len(text) > chunk:
                tokens[i] = count_by_resync(text, encode, chunk, overlap)
                continue
            held.append(_RUN.findall(text) if by_run else text)
            rows.append(i)
            chars += len(text)
            if chars > 4_000_000:
                flush()
                held, rows, chars = [], [], 0
        if rows:
            flush()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(tokens)], names=["doc_id", "n_bytes", "n_tokens"])


def token_counts(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, chunk: int = 4096, overlap: int = 256, by_run: bool | None = None
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``; ``tokenizer`` is a file every executor has.

    Method: a text of more than ``chunk`` characters is encoded in overlapping chunks with offsets
    and spliced at proven stable common boundaries (``count_by_resync``), so that a task never
    encodes more than a chunk at once where there is white space. Shorter texts, which are one chunk, are encoded whole or, with ``by_run``, by their
    runs between white space, each distinct run once: the same boundaries prove the sum equal.
    ``by_run`` suits tokenizers that drop white space; unless it is said, that is found by trial.
    One pass, no shuffle: a lost executor repeats its own splits.

    A null text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated rows are counted
    each; an empty table gives an empty result. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(lambda it: _counts(it, tokenizer, chunk, overlap, by_run), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
