"""A corpus pipeline of five stages: language ID, line dedup, SimHash
near-dedup, PII, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import langid, lines, packing, pii, simhash
from ledgerline.llm.common import table
from ledgerline.session import scratch_path

# Documents of a known language score about 0.4 or more.
MIN_LANGUAGE_SCORE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without an identified language."""
    return langid.keep_identified(docs, MIN_LANGUAGE_SCORE)


def boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines that stand on many sites out of all but one document."""
    return lines.drop_boilerplate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return simhash.keep_first(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data within its format."""
    return pii.pseudonymize(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts into training sequences."""
    return packing.pack_documents(docs)


STAGES = [("language_id", language), ("line_dedup", boilerplate), ("simhash_near_dedup", near_copies),
          ("pii", pseudonyms), ("packing", sequences)]

# Models, hashes and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each through Parquet in the
    cluster's shared folder."""
    docs = table(spark, sf_dir, "documents")
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for n, (name, stage) in enumerate(STAGES):
        path = f"{base}/{n}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
