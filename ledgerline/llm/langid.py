"""Language identification by rank-order n-gram profiles.

A profile is the ranking of the ``PROFILE`` most frequent letter n-grams
(1 to 3 letters; words are bounded by one space).  A document is compared
to each language's profile by the out-of-place distance: for each of its
ranked n-grams the difference of the two ranks, or ``PROFILE`` if the
language's profile lacks it.  The nearest language wins.

Training reads about ``SAMPLE`` different texts a language at most (chosen
by a hash of the text, so the sample depends neither on the layout nor on
repeated ids and copies, and has one text at least of each language),
never the held-out fold.  The ``MOST_LANGS`` labels with the most rows are
learned.  n-grams are counted in the tasks and summed by key; only the
profiles (``PROFILE`` rows a language) reach the driver.  Prediction is narrow: each batch is ranked against
the profiles, with no shuffle, and reads nothing but the text.

Defined results.  ``und`` with score 0 if the text is null, empty or has
no letter, or if nothing could be learned (empty table, no labels).
Equal distances: the language that sorts first.  Equal n-gram counts:
the n-gram with the smaller code points first.  Very long texts are read
whole.  A null id: not held out, as its fold is undefined.  Repeated rows
give repeated results.  Other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import id_and_text

PROFILE = 400
SAMPLE = 4000
MOST_LANGS = 1000
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's n-grams as integers (21 bits a letter, left-aligned by
    order) and how often each occurs."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    # One space (0) before, after and between words.
    codes = np.where(letter, codes, 0).astype(np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes = np.concatenate([[0], codes[keep], [0]])
    one = codes[codes > 0]
    a, b = codes[:-1], codes[1:]
    two = ((a << 21) | b)[(a > 0) | (b > 0)]
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    three = ((a << 42) | (b << 21) | c)[b > 0]
    # A mark in the top bits keeps bigrams and trigrams that begin with a space apart.
    grams = np.concatenate([one, two | (1 << 62), three])
    return np.unique(grams, return_counts=True)


def ranked(keys: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent keys in rank order."""
    return keys[np.lexsort((keys, -counts))[:size]]


class Profiles:
    def __init__(self, profiles: dict[str, list[int]]):
        self.langs = sorted(profiles)
        self.size = PROFILE
        self.tables = []
        for lang in self.langs:
            keys = np.array(profiles[lang], np.int64)
            order = np.argsort(keys)
            self.tables.append((keys[order], order))

    def predict(self, text: str) -> tuple[str, float]:
        keys = ranked(*ngram_counts(text))
        if not len(keys) or not self.langs:
            return UNKNOWN, 0.0
        place = np.arange(len(keys))
        distances = []
        for known, rank in self.tables:
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            out = np.where(known[at] == keys, np.abs(rank[at] - place), self.size)
            distances.append(int(out.sum()))
        best = int(np.argmin(distances))
        return self.langs[best], 1.0 - distances[best] / (self.size * len(keys))


def held_out(id_col: str = "doc_id"):
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
    return F.coalesce(fold == 2, F.lit(False))


def train_profiles(docs: DataFrame, sample: int = SAMPLE) -> dict[str, list[int]]:
    """Profile (n-grams by rank) of each language."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang"))
    known = known.where("lang IS NOT NULL AND text IS NOT NULL").where(~held_out())
    spot = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    # Copies of a text count once; the text of the least hash is always in, so that no language goes missing.
    sizes = known.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n"), F.min(spot).alias("least"),
                                      F.count("*").alias("rows")).orderBy(F.col("rows").desc(), "lang").limit(MOST_LANGS).collect()
    if not sizes:
        return {}
    limit = F.lit(-1).cast("long")
    for r in sorted(sizes, key=lambda r: r["lang"]):
        share = min(1 << 40, (1 << 40) * sample // max(r["n"], 1))
        limit = F.when(F.col("lang") == r["lang"], F.lit(max(share, r["least"]))).otherwise(limit)
    chosen = known.where(spot <= limit).groupBy("lang", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"))
    chosen = chosen.select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                keys, counts = ngram_counts("\n".join(texts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.int64()),
                     pa.array(counts, pa.int64())], ["lang", "gram", "n"])

    summed = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    top = summed.withColumn("rank", rank).where(F.col("rank") <= PROFILE)
    profiles: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "rank").collect():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


def identify(docs: DataFrame, profiles: dict[str, list[int]]) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(profiles)
        for batch in batches:
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return id_and_text(docs).mapInArrow(predict, "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Train on the open folds, predict every row."""
    found = identify(docs, train_profiles(docs, sample))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = 0.0, sample: int = SAMPLE) -> DataFrame:
    """The documents (all their columns) whose language is identified
    with a score of at least ``min_score``.  If nothing could be learned
    (no labels, or all held out) languages can't be told apart, and the
    documents with a letter stay."""
    model = train_profiles(docs, sample)
    names = docs.columns

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        if not model:
            return pd.Series([math.inf if t and any(map(str.isalpha, t)) else -math.inf for t in texts], dtype="float64")
        profiles = Profiles(model)
        found = (profiles.predict(t) if t else (UNKNOWN, 0.0) for t in texts)
        return pd.Series([s if lang != UNKNOWN else -1.0 for lang, s in found], dtype="float64")

    return docs.where(score(F.col("text").cast("string")) >= min_score).select(*[docs[n] for n in names])
