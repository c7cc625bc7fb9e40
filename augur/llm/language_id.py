"""Language identification by rank-order n-gram profiles.

A profile is a language's ``size`` most frequent n-grams of 1 to 3 characters,
ranked by count over all training documents. A document's own most frequent n-grams
are ranked the same way, and its distance to a profile is the sum of rank
differences (out-of-place distance); an n-gram that the profile lacks costs
``size``. The nearest profile's language wins, and the score is 1 - distance /
(the greatest possible distance).

N-grams come from lower-cased words: runs of letters and marks, with a blank
at both ends; an n-gram may start or end with the blank but not contain it
inside. Up to three code points of 21 bits each fit one integer, so n-grams
are counted exactly, by sorting, in whole texts.

Null and empty texts and texts without a letter give ``und`` and score 0. Only text
and a non-null language are learned from. Ties go to the more frequent n-gram, then to
the lesser code points; equal distances to the language first in order. With nothing learned every text
is ``und``. Repeated rows are judged one by one. Columns of the input are kept;
one with the name of an added column is replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from augur.llm.words import slices

SIZE = 300
MAX_LANGUAGES = 10_000  # a bound for the driver: more than that aren't languages
BLANK = 1
ADDED = ("lang_pred", "score")


def word_characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: is it a letter or mark, is it a letter."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    letter = np.array([k == "L" for k in kinds])
    return letter | np.array([k == "M" for k in kinds]), letter


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)


def n_grams(points: np.ndarray, in_word: np.ndarray) -> np.ndarray:
    """All n-grams of a lower-cased text as integers, in no particular order."""
    inside = in_word[points]
    if not inside.any():
        return np.zeros(0, dtype=np.int64)
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # one blank after each word
    codes = np.empty(int(keep.sum()) + 2, dtype=np.int64)
    codes[0] = codes[-1] = BLANK
    codes[1:-1] = np.where(inside, points, BLANK)[keep]
    letter = codes != BLANK
    two = codes[:-1] | codes[1:] << 21
    three = two[:-1] | codes[2:] << 42
    return np.concatenate([codes[letter], two[letter[:-1] | letter[1:]], three[letter[1:-1]]])


def ranked(grams: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first."""
    grams = np.sort(grams)
    first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else grams
    counts = np.diff(np.r_[first, len(grams)])
    if len(first) > size:  # drop what can't be among them before the stable sort
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        high = counts >= least
        first, counts = first[high], counts[high]
    return grams[first[np.argsort(-counts, kind="stable")[:size]]]


def _count():
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_word, _ = word_characters()
        for part in slices(batches, "text"):
            langs = part["lang"].to_pylist()
            found: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(langs, part["text"].to_pylist(), strict=True):
                if text:
                    found.setdefault(lang, []).append(n_grams(code_points(text), in_word))
            for lang, grams in found.items():
                keys, counts = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], names=["lang", "gram", "n"]
                )

    return count


def learn(texts: DataFrame, size: int = SIZE) -> dict[str, list[int]]:
    """``texts`` (lang, text) -> each language's ranked n-grams. All rows are
    counted; the driver gets at most ``size`` n-grams for a language."""
    usable = texts.filter("lang is not null and text is not null").select("lang", "text")
    counts = usable.mapInArrow(_count(), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = counts.withColumn("rank", rank).filter(F.col("rank") <= size).limit(size * MAX_LANGUAGES + 1).collect()
    if len(rows) > size * MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    profiles: dict[str, list[int]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


def nearest(own: np.ndarray, grams: np.ndarray, ranks: np.ndarray, size: int) -> tuple[int, float]:
    """Index of the nearest profile, and its score. ``grams`` are all profiles' n-grams in
    order, ``ranks`` (profiles x grams) their ranks, -1 if lacking."""
    at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
    rank = np.where(grams[at] == own, ranks[:, at], -1)
    apart = np.where(rank >= 0, np.abs(rank - np.arange(len(own))), size).sum(axis=1)
    best = int(apart.argmin())
    return best, 1.0 - float(apart[best]) / (size * len(own))


def _predict(profiles: dict[str, list[int]], size: int):
    langs = sorted(profiles)
    grams = np.array(sorted({g for p in profiles.values() for g in p}), dtype=np.int64)
    ranks = np.full((len(langs), len(grams)), -1, dtype=np.int64)
    for i, lang in enumerate(langs):
        ranks[i, np.searchsorted(grams, np.array(profiles[lang], dtype=np.int64))] = np.arange(len(profiles[lang]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_word, letter = word_characters()
        for part in slices(batches, "text"):
            names, scores = [], []
            for text in part["text"].to_pylist():
                points = code_points(text or "")
                if not langs or not letter[points].any():
                    names.append("und")
                    scores.append(0.0)
                else:
                    best, score = nearest(ranked(n_grams(points, in_word), size), grams, ranks, size)
                    names.append(langs[best])
                    scores.append(score)
            carried = [c for c in part.schema.names if c not in ADDED]
            yield pa.RecordBatch.from_arrays(
                [*(part[c] for c in carried), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*carried, *ADDED]
            )

    return predict


def identify(docs: DataFrame, profiles: dict[str, list[int]], size: int = SIZE) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) with ``lang_pred`` and ``score``."""
    rest = docs.select([c for c in docs.columns if c not in ADDED])
    fields = ", ".join(f"`{c}` {rest.schema[c].dataType.simpleString()}" for c in rest.columns)
    return rest.mapInArrow(_predict(profiles, size), f"{fields}, lang_pred string, score double")


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """Contract query over whole ``documents``; a null doc_id is neither
    learned from nor held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = learn(docs.filter(fold(F.col("doc_id")) != 0))
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    return identify(docs.select("doc_id", held_out, "text"), profiles).drop("text")
