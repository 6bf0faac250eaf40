"""Toxicity by a logistic classifier that is regularised with counterfactual identity terms."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hockeylake.llm.learning import Ftrl, shuffled

FEATURES = 1 << 20
_WORD = re.compile(r"[^\W\d_]+")
_MEMO = 300_000

#: Words that name groups of people; within a row one is swapped for another. Parameter of ``train_toxicity_model``.
IDENTITY_TERMS = tuple(
    tuple(row.split())
    for row in """
woman man girl boy female male transgender
women men girls boys females males
muslim christian jew hindu buddhist atheist catholic protestant
muslims christians jews hindus buddhists atheists catholics protestants
black white asian latino african european american arab
gay straight lesbian bisexual queer heterosexual
immigrant refugee native foreigner
old young elderly teenage
blind deaf disabled autistic
femme homme fille garçon
femmes hommes filles garçons
musulman chrétien juif hindou bouddhiste athée
musulmans chrétiens juifs hindous bouddhistes athées
noir blanc asiatique africain européen américain arabe
homosexuel hétérosexuel bisexuel
immigré réfugié étranger
frau mann mädchen junge
frauen männer
muslime christen juden hindus buddhisten atheisten
schwarze weiße asiaten afrikaner europäer amerikaner araber
schwul lesbisch bisexuell heterosexuell
einwanderer flüchtling ausländer
mujer hombre niña niño
mujeres hombres niñas niños
musulmán cristiano judío budista ateo católico
musulmanes cristianos judíos budistas ateos católicos
negro blanco asiático africano europeo americano árabe
homosexual heterosexual bisexual lesbiana
inmigrante refugiado extranjero
""".strip().splitlines()
)


def word_features(word: str) -> tuple[int, ...]:
    """Hashes of a lower-case word and of its first five letters if it is longer."""
    own = zlib.crc32(word.encode()) % FEATURES
    return (own, zlib.crc32(b"^" + word[:5].encode()) % FEATURES) if len(word) > 5 else (own,)


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def _features(words: set[str]) -> np.ndarray:
    return np.array([f for w in sorted(words) for f in word_features(w)], dtype="<i4")


def counterfactual(words: set[str], terms: tuple[tuple[str, ...], ...], turn: int) -> set[str]:
    """The words with each identity term swapped for another of its row, the first that has it."""
    swaps: dict[str, str] = {}
    for row in terms:
        for at, w in enumerate(row if len(row) > 1 else ()):
            if w in words:
                swaps.setdefault(w, row[(at + 1 + turn % (len(row) - 1)) % len(row)])
    return {swaps.get(w, w) for w in words}


def _examples(batches: Iterator[pa.RecordBatch], terms) -> Iterator[pa.RecordBatch]:
    known = {w for row in terms for w in row}
    for batch in batches:
        own, other = [], []
        for x in batch.column(1):
            words = words_of(x.as_py() or "")
            own.append(_features(words).tobytes())
            swapped = counterfactual(words, terms, len(words)) if words & known else words
            other.append(_features(swapped).tobytes() if swapped != words else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary()), pa.array(other, pa.binary())], names=["label", "own", "other"])


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float


def train_toxicity_model(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    most: int = 12_000,
    penalty: float = 1.0,
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    epochs: int = 4,
    l1: float = 0.6,
    l2: float = 0.2,
    seed: int = 11,
) -> ToxicityModel:
    """Fit on the texts of ``docs`` that ``labels`` has a 0 or 1 for; null texts or labels teach nothing, of repeated labels the largest counts, of texts that share an id the least.

    About ``most`` labelled ids, never more than twice as many, chosen by a hash of the id, are used with their whole texts: their
    distinct words and five-letter beginnings. That sample's ids are broadcast and its features come to
    the driver; both are bounded by ``most``. Each row with identity terms also has a counterfactual in
    which they are swapped, and ``penalty * (logit - counterfactual logit)^2`` is added to the loss, so
    that a neutral mention of a group doesn't move the score. Without rows every score is 0.5.
    """
    known = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("label")).filter("_id is not null and label in (0, 1)").groupBy("_id").agg(F.max("label").alias("label"))
    n = known.count()
    place = F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(2**62))
    chosen = known.filter(place <= int(min(1.0, most / max(n, 1)) * (2**62 - 1))).orderBy(place, "_id").limit(2 * most)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    rows = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "label").agg(F.min("text").alias("text")).select("label", "text")  # at most 2 * most ids
    found = rows.mapInArrow(lambda it: _examples(it, terms), "label int, own binary, other binary").toPandas().sort_values(["own", "label"], ignore_index=True)
    data = []
    for label, own, other in zip(found["label"], found["own"], found["other"], strict=True):
        at, count = np.unique(np.frombuffer(own, dtype="<i4"), return_counts=True)
        turned = None
        if other is not None:
            both = np.concatenate((np.frombuffer(own, dtype="<i4"), np.frombuffer(other, dtype="<i4")))
            sign = np.repeat([1.0, -1.0], [len(own) // 4, len(other) // 4])
            places, back = np.unique(both, return_inverse=True)
            change = np.bincount(back, weights=sign)
            turned = places[change != 0].astype(np.int64), change[change != 0]
        data.append((at.astype(np.int64), count.astype(float), label, turned))
    model = Ftrl(FEATURES, 1, alpha=0.3, l1=l1, l2=l2)
    for i in shuffled(len(data), epochs, seed):
        at, x, y, turned = data[i]
        logit = float(x @ model.weights(at)[:, 0] + model.bias[0])
        error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y
        model.add(at, (x * error)[:, None], np.array([error]))
        if turned is not None:
            places, change = turned
            gap = float(change @ model.weights(places)[:, 0])
            model.add(places, (2 * penalty * gap * change)[:, None])
    return ToxicityModel(model.weights()[:, 0].astype(np.float32), float(model.bias[0]))


def _scores(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    m = ToxicityModel(**model.value)
    memo: dict[str, float] = {}

    def weight(word: str) -> float:
        w = memo.get(word)
        if w is None:
            if len(memo) >= _MEMO:
                memo.clear()
            w = memo[word] = float(sum(m.weights[f] for f in word_features(word)))
        return w

    for batch in batches:
        logits = np.array([m.bias + sum(map(weight, words_of(x.as_py() or ""))) for x in batch.column(1)], dtype=float)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(logits, -30, 30))), pa.float64())], names=["doc_id", "score"])


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` for every row of ``docs``, from its whole text alone.

    Null and empty texts have the score of no words. A null id stays null, repeated rows are scored
    alike, an empty table gives an empty result. Other columns are not read. One pass, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(lambda it: _scores(it, shared), "doc_id long, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
