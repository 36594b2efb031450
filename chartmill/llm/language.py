"""Language identification by rank-order n-gram profiles.

A language is described by its most frequent n-grams, most frequent first.  A document's own ranked
list is compared with each by the out-of-place distance: the sum of rank differences, where an n-gram
that a language does not list costs as much as the list is long.  The nearest language wins, the
alphabetically first of equals.

Null text and text without a letter get ``und`` and score 0.  Documents of any length count whole.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from chartmill.llm.base import shielded

UNDETERMINED = "und"
PROFILE = 400
# Learned from per language; up to a thousand, tasks keep their own best rows before any is sent on.
TRAIN_DOCS = 1000
_BITS = 21  # of a code point
_BLANK = 1  # no letter, and not 0: an n-gram that begins with a blank is not the shorter one behind it

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _letters


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the 1- to 3-grams of the lower-cased words; a word is padded by one blank.

    An n-gram is one integer with 21 bits a character.  N-grams of blanks alone are left out.
    """
    if not isinstance(text, str) or not text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    points = np.where(_letter_table()[points], points, _BLANK)
    points = np.concatenate(([_BLANK], points, [_BLANK]))
    points = points[(points > _BLANK) | np.concatenate(([True], points[:-1] > _BLANK))]  # runs of blanks become one
    if len(points) == 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    one = points[points > _BLANK]
    two = points[:-1] << _BITS | points[1:]
    three = points[:-2] << 2 * _BITS | two[1:]
    return np.unique(np.concatenate((one, two, three)), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, most frequent first, smaller codes first among equals."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        likely = counts >= least
        codes, counts = codes[likely], counts[likely]
    return codes[np.argsort(-counts, kind="stable")[:size]]


@dataclass(frozen=True)
class Profiles:
    """Ranks of all listed n-grams in each language; ``size`` where a language does not list one."""

    languages: tuple[str, ...]
    codes: np.ndarray
    ranks: np.ndarray
    size: int

    def nearest(self, text: str | None) -> tuple[str, float]:
        own = ranked(*ngrams(text), self.size)
        if not len(own) or not self.languages:
            return UNDETERMINED, 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        known = self.codes[at] == own
        places = np.nonzero(known)[0][:, None]
        listed = self.ranks[at[known]]
        apart = np.where(listed < self.size, np.abs(listed - places), self.size)
        distance = apart.sum(0) + self.size * (len(own) - len(places))
        best = int(distance.argmin())
        return self.languages[best], 1.0 - float(distance[best]) / (self.size * len(own))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", train_docs: int = TRAIN_DOCS, size: int = PROFILE) -> Profiles:
    """Learn one profile per language from labelled rows.

    For each language the ``train_docs`` rows with the smallest text hash are used, whole; that bound
    holds at every input size.  Rows without text or language are left out.  What reaches the driver
    are ``size`` counts per language.
    """
    hashed = F.xxhash64("_text").alias("_hash")
    rows = labelled.select(F.col(text).alias("_text"), F.col(lang).alias("_lang")).where("_text is not null and _lang is not null")
    order = Window.partitionBy("_lang").orderBy("_hash")
    # Hashes are ranked without their texts; each chosen text is then fetched once, with the number of its copies.
    first = rows.select("_lang", hashed).withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= train_docs)
    wanted = first.groupBy("_lang", "_hash").agg(F.count(F.lit(1)).alias("_copies"))
    chosen = rows.withColumn("_hash", hashed).join(wanted, ["_lang", "_hash"]).groupBy("_lang", "_hash", "_copies").agg(F.first("_text").alias("_text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for language, some in batch.groupby("_lang"):
                parts = [ngrams(t) for t in some["_text"]]
                weights = np.concatenate([n * times for (_, n), times in zip(parts, some["_copies"])])
                codes, back = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                counts = np.bincount(back, weights, len(codes)).astype(np.int64)
                yield pd.DataFrame({"lang": language, "code": codes, "n": counts})

    spread = chosen.repartition("_hash").select("_lang", "_text", "_copies")
    sums = spread.mapInPandas(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top = sums.withColumn("rank", place - 1).where(F.col("rank") < size).select("lang", "code", "rank").toPandas()
    languages = tuple(sorted(top["lang"].unique()))
    codes = np.unique(top["code"].to_numpy(np.int64))
    ranks = np.full((len(codes), len(languages)), size, np.int64)
    ranks[np.searchsorted(codes, top["code"]), [languages.index(x) for x in top["lang"]]] = top["rank"]
    return Profiles(languages, codes, ranks, size)


@shielded("text", adds=("out",))
def predict(docs: DataFrame, profiles: Profiles, text: str = "text", out: str = "language") -> DataFrame:
    """Add ``out``: a struct of ``lang`` and ``score``, 1 for the language's own order, 0 for nothing shared.

    Only the text is looked at.  All other columns pass unchanged.
    """

    @F.pandas_udf("lang string, score double")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([profiles.nearest(t) for t in batch], columns=["lang", "score"])

    return docs.withColumn(out, nearest(F.col(text)))


def held_out(doc_id: Column | str) -> Column:
    """Rows kept from learning: the checksum of the id as text leaves 2 when divided by 4."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))
