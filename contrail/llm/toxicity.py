"""Toxicity scores from positive and unlabelled documents.

The classifier is trained with the non-negative positive-unlabelled risk: with the
share ``prior`` of toxic documents in unlabelled text,

    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)]),

so confirmed toxic examples and plain text are enough; labelled clean documents
only help to estimate the prior. Features are the presence of words and of word
beginnings, so inflected forms share evidence and a long text does not dilute it;
those not clearly more frequent in toxic examples than in plain text are left out.

Training uses bounded samples (``MAX_POSITIVE``, ``MAX_UNLABELLED`` documents in a
seeded order of ids), feature hashes are taken where the texts are. Scoring reads
every text in its partition; the model is at most ``MAX_FEATURES`` numbers.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_POSITIVE = 3_000
MAX_UNLABELLED = 9_000
MAX_FEATURES = 50_000
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3
SEED = 17
_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> set[int]:
    """Hashes of a word and of its beginnings."""
    return {zlib.crc32(("=" + word).encode("utf-8", "surrogatepass")),
            *(zlib.crc32(word[:k].encode("utf-8", "surrogatepass")) for k in PREFIXES if len(word) >= k)}


def text_features(text: str | None) -> np.ndarray:
    found: set[int] = set()
    for word in set(_WORD.findall(text.lower())) if text else ():
        found |= word_features(word)
    return np.fromiter(found, np.uint32, len(found))


@dataclass(frozen=True)
class Model:
    """Weights by feature hash; without positive examples only the bias counts."""

    weights: dict[int, float]
    bias: float
    prior: float

    def scorer(self):
        """A function of a text; remembers the features of the words it has seen."""
        known: dict[str, tuple[int, ...]] = {}

        def score(text: str | None) -> float:
            found: set[int] = set()
            for word in set(_WORD.findall(text.lower())) if text else ():
                hits = known.get(word)
                if hits is None:
                    if len(known) >= 300_000:
                        known.clear()
                    hits = known[word] = tuple(f for f in word_features(word) if f in self.weights)
                if hits:
                    found.update(hits)
            z = self.bias + sum(self.weights[f] for f in sorted(found))
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return score


def held_out(doc_id: str = "doc_id") -> Column:
    """The documents whose labels are not learned from; a null id is learned from."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


def _sampled(ids: DataFrame, size: int) -> DataFrame:
    """``size`` ids in a seeded order: eight bytes each, so the list has a fixed bound."""
    return ids.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(size)


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"positive": batch["positive"], "features": [
            text_features(t).tobytes() for t in batch["text"]]})


def train(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> Model:
    """A model from documents that are not held out.

    ``prior`` is estimated from the labelled documents unless given. Labels of one
    document that disagree count as toxic; null labels and ids are not used.
    """
    ids = docs.where("doc_id is not null").where(~held_out()).select("doc_id").distinct()
    known = (labels.where("doc_id is not null and toxic is not null").where(~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(ids, "doc_id"))
    counts = known.agg(F.count("*"), F.sum("toxic")).first()
    if not counts[1]:
        return Model({}, -30.0, 0.0)
    if prior is None:
        prior = min(max(counts[1] / counts[0], 0.001), 0.999)
    sample = (_sampled(known.where("toxic = 1").select("doc_id"), MAX_POSITIVE)
              .withColumn("positive", F.lit(True))
              .unionByName(_sampled(ids, MAX_UNLABELLED).withColumn("positive", F.lit(False))))
    # one text per sampled id, however often its row is repeated
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id", "positive").agg(F.min("text").alias("text"))
            .select("positive", "text").mapInPandas(_features, "positive boolean, features binary")
            .toPandas())
    sets = [np.frombuffer(x, np.uint32) for x in rows["features"]]
    positive = rows["positive"].to_numpy(bool)
    return fit([s for s, p in zip(sets, positive) if p], [s for s, p in zip(sets, positive) if not p],
               prior)


def _places(columns: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Places in the sorted ``columns`` of those features that are there."""
    at = np.minimum(np.searchsorted(columns, found), len(columns) - 1)
    return at[columns[at] == found]


def _selected(toxic: list[np.ndarray], plain: list[np.ndarray]) -> np.ndarray:
    """Features of at least three toxic examples that are clearly rarer in plain text."""
    ids, counts = np.unique(np.concatenate(toxic), return_counts=True)
    ids, counts = ids[counts >= 3], counts[counts >= 3]
    if not len(ids):
        return ids
    other = np.zeros(len(ids), np.int64)
    for s in plain:
        other[_places(ids, s)] += 1
    p, q = counts / len(toxic), (other + 0.5) / (len(plain) + 1)
    surplus = (p - q) / np.sqrt(p * (1 - p) / len(toxic) + q * (1 - q) / (len(plain) + 1) + 1e-12)
    good = (p >= 2 * q) & (surplus >= 3)
    best = np.argsort(-surplus[good], kind="stable")[:MAX_FEATURES]
    return np.sort(ids[good][best])


def fit(toxic: list[np.ndarray], plain: list[np.ndarray], prior: float, *, steps: int = 400,
        rate: float = 0.05, decay: float = 1e-4) -> Model:
    """Minimise the non-negative risk of a linear model with the logistic loss."""
    columns = _selected(toxic, plain)
    if not len(columns):
        return Model({}, float(np.log(prior / (1 - prior))), prior)

    def matrix(sets: list[np.ndarray]):
        # text by text: most features are not selected
        places = [_places(columns, s) for s in sets]
        return np.repeat(np.arange(len(sets)), [len(p) for p in places]), np.concatenate(places)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    parts = (*matrix(toxic), len(toxic)), (*matrix(plain), len(plain))
    w, b = np.zeros(len(columns)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        (pr, pc, pn), (ur, uc, un) = parts
        zp = np.bincount(pr, w[pc], pn) + b
        zu = np.bincount(ur, w[uc], un) + b
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        # derivative by each score: of the positive part, and of the negative part
        gp, gu = -prior * (1 - sigmoid(zp)) / pn, sigmoid(zu) / un
        gn = -prior * sigmoid(zp) / pn
        if negative >= 0:
            gp, slope = gp + gn, 1.0
        else:
            # the corrected risk is at its floor: step back from overfitted weights
            gp, gu, slope = -gn, -gu, 0.0
        grad = np.r_[np.bincount(pc, gp[pr], len(w)) + np.bincount(uc, gu[ur], len(w)) + decay * w,
                     slope * (gp.sum() + gu.sum())]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad ** 2
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
        # selected features speak for toxicity only
        w, b = np.maximum(w - move[:-1], 0), float(b - move[-1])
    return Model(dict(zip(columns.tolist(), w.tolist())), b, prior)


def score_column(model: Model, text: str = "text") -> Column:
    """The score of a text, from 0 to 1; null and empty texts get the model's bias."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = model.scorer()
        for texts in batches:
            yield pd.Series([of(t) for t in texts], dtype="float64")
    return score(text)


def toxicity_scores(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts are scored like a text without known words; repeated rows
    each get their row; an empty table gives an empty result; other columns are
    ignored. Without toxic examples every score is (almost) 0.
    """
    model = train(docs, labels, prior)
    return (docs.select("doc_id", held_out().alias("held_out"), score_column(model).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def drop_toxic(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, with their own columns."""
    model = train(docs, labels, prior)
    return docs.where(score_column(model) < THRESHOLD)
