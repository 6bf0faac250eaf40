"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hockeylake.llm.common import array_parts, sum_arrays
from hockeylake.llm.learning import Ftrl, shuffled, softmax, temperature

FEATURES = 1 << 15


@dataclass
class LanguageModel:
    """``idf`` by feature, ``weights`` (features x languages), ``bias``, the languages and the temperature."""

    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letters[0]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """``(features, counts)`` of the 1- to 4-grams of the lower-case letters; other characters are one blank each. Nothing without a letter."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _letter_table()[cp]
    if not letter.any():
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    c = np.where(letter, cp, 32).astype(np.uint64)
    c = np.concatenate(([np.uint64(32)], c, [np.uint64(32)]))
    h, grams = c * np.uint64(0x9E3779B97F4A7C15), []
    for n in range(1, 5):
        if n > 1:
            if len(c) < n:
                break
            h = (h[:-1] ^ (h[:-1] >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + c[n - 1 :] * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        grams.append((mixed >> np.uint64(49)).astype(np.int64))
    counts = np.bincount(np.concatenate(grams), minlength=FEATURES)
    at = np.flatnonzero(counts)
    return at, counts[at]


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(2 * FEATURES, dtype=np.int64)  # the second half holds the number of documents
    for batch in batches:
        for x in batch.column(0):
            at, _ = gram_counts(x.as_py() or "")
            df[at] += 1
            df[FEATURES] += 1
    if df.any():
        yield array_parts(df)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [gram_counts(x.as_py() or "") for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([a.astype("<i4").tobytes() for a, _ in rows], pa.binary()), pa.array([c.astype("<f4").tobytes() for _, c in rows], pa.binary())],
            names=["lang", "at", "counts"],
        )


def _vector(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf[at]
    return x / max(np.sqrt((x**2).sum()), 1e-12)


def _fit(found: pa.Table, langs: list[str], idf: np.ndarray, epochs: int, l1: float, l2: float, seed: int) -> pa.Table:
    """The model of a bounded sample, in one task: weights that aren't 0 by place, biases and the temperature."""
    found = found.combine_chunks()
    names, features, counted = (found.column(c).combine_chunks() for c in ("lang", "at", "counts"))
    # The features stay packed where they came in; a row is unpacked when its turn comes.
    places = pc.sort_indices(found, sort_keys=[(c, "ascending") for c in ("lang", "at", "counts")]).to_pylist()
    rows = [(i, langs.index(names[i].as_py())) for i in places if len(features[i].as_buffer() or b"")]
    order = np.random.default_rng(seed).permutation(len(rows))
    held, taught = [rows[i] for i in order[: len(rows) // 5]], [rows[i] for i in order[len(rows) // 5 :]]

    def unpacked(row: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, int]:
        at = np.frombuffer(features[row[0]].as_buffer(), dtype="<i4")
        return at, _vector(at, np.frombuffer(counted[row[0]].as_buffer(), dtype="<f4"), idf), row[1]

    model = Ftrl(FEATURES, len(langs), alpha=1.0, beta=1.0, l1=l1, l2=l2)
    for i in shuffled(len(taught), epochs, seed):
        at, x, y = unpacked(taught[i])
        p = softmax(x @ model.weights(at) + model.bias)
        p[y] -= 1
        model.add(at, x[:, None] * p, p)
    weights = model.weights()
    logits = np.array([x @ weights[at] + model.bias for at, x, _ in map(unpacked, held)]).reshape(len(held), len(langs))
    flat = weights.astype(np.float32).reshape(-1)
    places = np.flatnonzero(flat)
    heat = temperature(logits, np.array([y for *_, y in held], dtype=int))
    said = {"places": [places.astype(np.int64).tobytes()], "weights": [flat[places].tobytes()], "bias": [np.asarray(model.bias, dtype=np.float64).tobytes()], "temperature": [float(heat)]}
    return pa.table(said, schema=pa.schema([("places", pa.binary()), ("weights", pa.binary()), ("bias", pa.binary()), ("temperature", pa.float64())]))


def train_language_model(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = 4000, most_langs: int = 1000, epochs: int = 3, l1: float = 0.002, l2: float = 0.05, seed: int = 7
) -> LanguageModel:
    """Fit on ``docs``: rows with null language or text without a letter teach nothing.

    Document frequencies come from every row. The weights are fitted on a sample of different texts, chosen by
    a hash of the text and used whole: about ``most`` and never more than twice as many, spread evenly over the languages, but a text of
    each at least. All are learned; the model has a column for each, and more than ``most_langs`` raise an error. A fifth of the sample is
    held back to set the temperature. One task fits the sample, whose features are bounded by ``most``; the weights that aren't 0 are what reaches the driver. Copies of a text
    in one language count once, ties in the order of hashes fall together, an empty table gives a model without languages.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("lang is not null and text is not null")
    df = sum_arrays(rows.select("text").mapInArrow(_document_counts, "chunk int, counts binary"), 2 * FEATURES)
    idf = np.log((1 + df[FEATURES]) / (1 + df[:FEATURES])) + 0.1
    rows = rows.withColumn("hash", F.xxhash64("text", F.lit(seed)))
    # Estimated numbers of different texts: they set the share that is sampled, and nothing else.
    sizes = rows.groupBy("lang").agg(F.count("*").alias("rows"), F.approx_count_distinct("hash").alias("n")).limit(most_langs + 1).collect()
    if len(sizes) > most_langs:
        raise ValueError(f"more than {most_langs} languages are labelled; raise most_langs, as the model has a column for each")
    langs = sorted(r["lang"] for r in sizes)
    if not langs:
        return LanguageModel([], idf, np.zeros((FEATURES, 0)), np.zeros(0), 1.0)
    each = most / len(langs)
    bounds = docs.sparkSession.createDataFrame([(r["lang"], int(min(1.0, each / max(r["n"], 1)) * (2**62 - 1))) for r in sizes], "lang string, bound long")
    chosen = rows.join(F.broadcast(bounds), "lang").filter(F.pmod("hash", F.lit(2**62)) <= F.col("bound"))  # at most most_langs rows
    chosen = chosen.groupBy("lang", "hash").agg(F.first("text").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.pmod("hash", F.lit(2**62)), "hash")
    chosen = chosen.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= math.ceil(2 * each)).select("lang", "text")
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    examples = chosen.mapInArrow(_examples, "lang string, at binary, counts binary")
    fitted = examples.groupBy(F.lit("all")).applyInArrow(lambda sample: _fit(sample, langs, shared.value, epochs, l1, l2, seed), "places binary, weights binary, bias binary, temperature double").collect()
    shared.destroy()
    weights = np.zeros((FEATURES, len(langs)), dtype=np.float32)
    if not fitted:
        return LanguageModel(langs, idf, weights, np.zeros(len(langs)), 1.0)
    told = fitted[0]
    weights.reshape(-1)[np.frombuffer(told["places"], dtype=np.int64)] = np.frombuffer(told["weights"], dtype=np.float32)
    return LanguageModel(langs, idf, weights, np.frombuffer(told["bias"], dtype=np.float64), told["temperature"])


def _predict(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    m = LanguageModel(**model.value)
    for batch in batches:
        said, scores = [], []
        for x in batch.column(1):
            at, counts = gram_counts(x.as_py() or "")
            if not len(at) or not m.langs:
                said.append("und"), scores.append(0.0)
                continue
            p = softmax((_vector(at, counts, m.idf) @ m.weights[at] + m.bias) / m.temperature)
            said.append(m.langs[int(p.argmax())]), scores.append(float(p.max()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])


def identify_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row of ``docs``: the likeliest language of the whole text and its calibrated probability.

    Texts that are null or have no letter are ``und`` with score 0, and so is everything if the model
    has no language; of equally likely languages the first by name is given. A null id stays null,
    repeated rows are predicted alike, an empty table gives an empty result. Other columns are not read. One pass, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _predict(it, shared), "doc_id long, lang_pred string, score double")


def fold(id_col: str, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def _identified(batches: Iterator[pa.RecordBatch], model, column: str, least: float) -> Iterator[pa.RecordBatch]:
    m = LanguageModel(**model.value)
    for batch in batches:
        keep = []
        for i, x in enumerate(batch.column(batch.schema.get_field_index(column))):
            at, counts = gram_counts(x.as_py() or "")
            if len(at) and m.langs and softmax((_vector(at, counts, m.idf) @ m.weights[at] + m.bias) / m.temperature).max() >= least:
                keep.append(i)
        yield batch.take(pa.array(keep, pa.int64()))


def drop_unidentified(docs: DataFrame, model: LanguageModel, text_col: str = "text", least: float = 0.4) -> DataFrame:
    """``docs`` without the rows whose text has no letter or whose best calibrated probability is below ``least``; columns unchanged.

    A model that has learned no language identifies nothing. One pass, no shuffle; rows are not matched by id, so null and repeated ids are no matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    return docs.mapInArrow(lambda it: _identified(it, shared, text_col, least), docs.schema)
