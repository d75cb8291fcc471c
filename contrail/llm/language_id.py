"""Language identification with bit-sliced Bloom filters over character n-grams.

Every language has the set of its frequent n-grams. The sets share one table of
slots, and a slot holds one bit per language: looking an n-gram up at its hash
places and taking the bits they have in common gives all languages that (seem to)
contain it. A text is judged by the number of its n-grams per language, corrected
for what the language's filter would answer by chance.

The sets are fitted on a bounded sample (``MAX_PER_LANGUAGE`` documents of each
language in a seeded order), counted in Spark; every text is read in its partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIZES = (2, 3, 4)
MAX_PER_LANGUAGE = 2_000
# frequent n-grams of a language, and how rare it may be against its best language
MAX_GRAMS = 6_000
SHARE_OF_BEST = 0.3
SLOT_BITS = 18
HASHES = 2
SEED = 29
UNDETERMINED = "und"
# sampled ids up to this number are broadcast (about 40 bytes each)
BROADCAST_IDS = 500_000
# characters of a text that are looked at together
PIECE = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class Letters:
    """Texts as arrays of lower-case letters; anything else is 0."""

    def __init__(self) -> None:
        self.table = np.array([chr(c).isalpha() for c in range(0x10000)])

    def codes(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        low = codes < 0x10000
        if low.all():
            letter = self.table[codes]
        else:
            letter = np.zeros(len(codes), bool)
            letter[low] = self.table[codes[low]]
            letter[~low] = [chr(c).isalpha() for c in codes[~low].tolist()]
        return np.where(letter, codes, 0).astype(np.uint64)


def grams(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the n-grams of each size; a gram may begin or end, not pass, between words."""
    yield from _grams_from(np.concatenate([[np.uint64(0)], codes, [np.uint64(0)]]), None)


def grams_of(text: str, letters: Letters) -> Iterator[tuple[np.ndarray, bool]]:
    """``grams`` of a whole text, piece by piece, and whether the piece has letters.

    What begins near the end of a piece is looked at together with the next one.
    """
    if len(text) <= PIECE:
        codes = letters.codes(text)
        yield from ((h, bool(codes.any())) for h in grams(codes))
        return
    end = np.zeros(1, np.uint64)
    open_ = end
    for i in range(0, len(text), PIECE):
        open_ = np.concatenate([open_, letters.codes(text[i:i + PIECE])])
        starts = max(0, len(open_) - max(SIZES) + 1)
        some = bool(open_.any())
        yield from ((h, some) for h in _grams_from(open_, starts))
        open_ = open_[starts:]
    open_ = np.concatenate([open_, end])
    yield from ((h, bool(open_.any())) for h in _grams_from(open_, None))


def _grams_from(padded: np.ndarray, starts: int | None) -> Iterator[np.ndarray]:
    """The n-grams that begin at the first ``starts`` places, or at any."""
    for n in SIZES:
        count = len(padded) - n + 1 if starts is None else starts
        if count < 1:
            continue
        inner = np.ones(count, bool)
        for k in range(1, n - 1):
            inner &= padded[k:k + count] > 0
        if n == 2:
            inner &= (padded[:count] > 0) | (padded[1:1 + count] > 0)
        at = np.flatnonzero(inner)
        h = np.full(len(at), np.uint64(n))
        for k in range(n):
            h = (h ^ padded[at + k]) * _ODD
            h ^= h >> np.uint64(29)
        yield h * _MIX


def places(h: np.ndarray) -> list[np.ndarray]:
    """The slots of a hash."""
    mask = np.uint64((1 << SLOT_BITS) - 1)
    return [((h >> np.uint64(40 - 20 * k)) & mask).astype(np.int64) for k in range(HASHES)]


@dataclass(frozen=True)
class Filters:
    """The shared table: one plane of 64-bit words for every 64 languages."""

    languages: list[str]
    slots: np.ndarray
    chance: np.ndarray

    @staticmethod
    def build(sets: dict[str, np.ndarray]) -> Filters:
        languages = sorted(sets)
        slots = np.zeros((max(1, -(-len(languages) // 64)), 1 << SLOT_BITS), np.uint64)
        chance = np.zeros(len(languages))
        for i, language in enumerate(languages):
            bit = np.uint64(1 << (i % 64))
            for at in places(sets[language]):
                slots[i // 64][at] |= bit
            chance[i] = np.mean((slots[i // 64] & bit) > 0) ** HASHES
        return Filters(languages, slots, chance)

    def counts(self, h: np.ndarray) -> np.ndarray:
        """How many of the n-grams each language has."""
        at = places(h)
        found = np.zeros(len(self.languages), np.int64)
        for p, plane in enumerate(self.slots):
            masks = plane[at[0]]
            for a in at[1:]:
                masks = masks & plane[a]
            for i in range(p * 64, min(len(self.languages), p * 64 + 64)):
                found[i] = np.count_nonzero(masks & np.uint64(1 << (i % 64)))
        return found

    def decide(self, text: str | None, letters: Letters) -> tuple[str, float]:
        if not text or not self.languages:
            return UNDETERMINED, 0.0
        found, total, any_letter = np.zeros(len(self.languages), np.int64), 0, False
        for h, some in grams_of(text, letters):
            any_letter = any_letter or some
            found += self.counts(h)
            total += len(h)
        if not any_letter:
            return UNDETERMINED, 0.0
        corrected = np.maximum((found - total * self.chance) / (1 - np.minimum(self.chance, 0.999)), 0)
        best = int(np.argmax(corrected))
        return self.languages[best], float(corrected[best] / corrected.sum()) if corrected[best] else 0.0


def held_out(doc_id: str = "doc_id") -> Column:
    """The documents whose language is not learned from; a null id is learned from."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3 == 1


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    letters = Letters()
    for batch in batches:
        for language, texts in batch.groupby("lang")["text"]:
            parts = [h for t in texts if t for h, _ in grams_of(t, letters)]
            if parts:
                keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                yield pd.DataFrame({"lang": language, "gram": keys.view(np.int64), "n": counts})


def fit(docs: DataFrame) -> Filters:
    """Filters of every language that documents outside the held-out part name."""
    known = docs.where("lang is not null and text is not null").where(~held_out()).select("doc_id", "lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id")
    sample = (known.withColumn("r", F.row_number().over(order)).where(F.col("r") <= MAX_PER_LANGUAGE)
              .select(F.col("doc_id").alias("sample_id")).distinct())
    if sample.count() <= BROADCAST_IDS:
        sample = F.broadcast(sample)
    counts = (docs.select("doc_id", "lang", "text").where("lang is not null and text is not null")
              .where(~held_out())
              .join(sample, F.col("doc_id").eqNullSafe(F.col("sample_id")), "left_semi")
              .select("lang", "text").mapInPandas(_counted, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    language, gram = Window.partitionBy("lang"), Window.partitionBy("gram")
    rated = (counts.withColumn("rate", F.col("n") / F.sum("n").over(language))
             .withColumn("best", F.max("rate").over(gram))
             .where(F.col("rate") >= SHARE_OF_BEST * F.col("best")))
    top = Window.partitionBy("lang").orderBy(F.desc("rate"), "gram")
    rows = (rated.withColumn("r", F.row_number().over(top)).where(F.col("r") <= MAX_GRAMS)
            .select("lang", "gram").toPandas())
    return Filters.build({k: g.to_numpy(np.int64).view(np.uint64) for k, g in rows.groupby("lang")["gram"]})


def predicted(filters: Filters, text: str = "text") -> Column:
    """A struct (lang_pred, score) for a text."""
    @F.pandas_udf("lang_pred string, score double")
    def decide(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = Letters()
        for texts in batches:
            yield pd.DataFrame([filters.decide(t, letters) for t in texts], columns=["lang_pred", "score"])
    return decide(text)


def languages(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Null texts and texts without a letter are ``und`` with score 0, as is every text
    when no language is known. Ties go to the language that sorts first. Repeated
    rows each get their row; an empty table gives an empty result; other columns
    are ignored.
    """
    filters = fit(docs)
    return (docs.select("doc_id", held_out().alias("held_out"), predicted(filters).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))
