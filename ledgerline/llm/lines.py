"""Line deduplication by distinct-site spread.

A line is boilerplate if it stands on ``MIN_SITES`` or more different
sites.  For each line (by 96 bits of hash of its text without outer
spaces) a HyperLogLog sketch of its sites is built where the rows are,
merged in the shuffle, and estimated.  Lines whose estimate lies near the
threshold, by three standard errors and at least one site, get an exact
distinct count; the others are decided by the estimate.  A boilerplate
line goes from every document but the one with the smallest id, so that
no text is lost to the corpus.

Sketches are combined before the shuffle, so a line that stands in a
third of all documents is one row for each task.  Only hashes are
shuffled until the end, where the positions to drop (bounded by a
document's own lines) meet their document.  Sites with very many
documents weigh no more than others.

Defined results.  Null text: stays null, 0 lines.  Empty lines and lines
of spaces are kept and not counted.  A null site counts as no site.  Rows
with a null id: their lines count, their text stays.  Repeated rows, also
of one id with other texts, are handled one by one.  A text whose every
line goes becomes empty; the row stays.  Empty table: no rows.  Other
columns are passed through (``drop_boilerplate``) or not read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import cut_lineage
from ledgerline.operators.joins import unused

MIN_SITES = 8
SKETCH_LOG2 = 12
STANDARD_ERROR = 1.04 / 2 ** (SKETCH_LOG2 / 2)
_KEY = ["h1", "h2"]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("source").cast("string").alias("site"))


def _lines(rows: DataFrame) -> DataFrame:
    """(doc_id, text hash, site, position, line hash) of every line that
    isn't blank."""
    lines = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "site",
                        F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.withColumn("line", F.trim("line")).where("line <> ''")
    return lines.select("doc_id", "text_hash", "site", "pos", F.xxhash64("line").alias("h1"),
                        F.crc32(F.col("line").cast("binary")).cast("long").alias("h2"))


def spread_lines(rows: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(h1, h2, first_id) of the lines on ``min_sites`` or more sites."""
    lines = _lines(rows).select("doc_id", "site", *_KEY)
    sketched = lines.groupBy(*_KEY).agg(F.hll_sketch_agg("site", F.lit(SKETCH_LOG2)).alias("sites"),
                                        F.min("doc_id").alias("first_id"))
    margin = max(1.0, 3 * STANDARD_ERROR * min_sites)
    estimated = sketched.select(*_KEY, "first_id", F.hll_sketch_estimate("sites").alias("estimate"))
    wide = cut_lineage(estimated.where(F.col("estimate") >= min_sites - margin))
    near = wide.where(F.col("estimate") <= min_sites + margin)
    exact = lines.where(F.col("site").isNotNull()).join(near.select(*_KEY), _KEY, "left_semi")
    exact = exact.select("site", *_KEY).distinct().groupBy(*_KEY).agg(F.count("*").alias("n"))
    exact = exact.where(F.col("n") >= min_sites)
    return wide.where(F.col("estimate") > min_sites + margin).select(*_KEY, "first_id").unionByName(
        near.join(exact, _KEY, "left_semi").select(*_KEY, "first_id"))


def _without(texts: pd.Series, positions: pd.Series) -> pd.Series:
    def cut(text, drop):
        if text is None:
            return None
        gone = set(drop)
        return "\n".join(line for n, line in enumerate(text.split("\n")) if n not in gone)

    return pd.Series([cut(t, p) for t, p in zip(texts, positions)], dtype=object)


def _with_cleaned(docs: DataFrame, min_sites: int) -> tuple[DataFrame, str, str]:
    """All columns of ``docs``, the cleaned text and the number of lines
    dropped, and these two columns' names."""
    rows = _rows(docs)
    spread = cut_lineage(spread_lines(rows, min_sites))
    lines = _lines(rows).select("doc_id", "text_hash", "pos", *_KEY)
    hits = lines.join(spread, _KEY).where(F.col("doc_id") != F.col("first_id"))
    own, hashed, drop, clean, dropped = unused(["own_id", "text_hash", "drop", "clean", "dropped"], docs.columns)
    hits = hits.groupBy(F.col("doc_id").alias(own), F.col("text_hash").alias(hashed)).agg(F.collect_set("pos").alias(drop))
    joined = docs.join(hits, (docs["doc_id"].cast("long") == hits[own])
                       & (F.xxhash64(docs["text"].cast("string")) == hits[hashed]), "left")
    text = F.col("text").cast("string")
    without = F.pandas_udf(_without, "string")
    cleaned = without(F.when(F.col(drop).isNotNull(), text), F.col(drop))
    return joined.withColumn(clean, F.coalesce(cleaned, text)).withColumn(
        dropped, F.coalesce(F.array_size(drop), F.lit(0)).cast("long")), clean, dropped


def drop_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The documents with cleaned texts, and ``n_chars`` to fit if there
    is such a column."""
    cleaned, clean, _ = _with_cleaned(docs, min_sites)
    new = {"text": F.col(clean), "n_chars": F.length(clean).cast("long")}
    return cleaned.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def line_report(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(doc_id, text, n_lines, n_removed) of every row."""
    cleaned, clean, dropped = _with_cleaned(docs.select("doc_id", "text", "source"), min_sites)
    n_lines = F.coalesce(F.size(F.split("text", "\n")).cast("long"), F.lit(0))
    return cleaned.select("doc_id", F.col(clean).alias("text"),
                          F.when(F.col("text").isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
                          F.col(dropped).alias("n_removed"))


ORACLE = f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL),
spread AS (
  SELECT trim(line, ' ') AS k, min(doc_id) AS first_id FROM l WHERE trim(line, ' ') <> ''
  GROUP BY 1 HAVING count(DISTINCT source) >= {MIN_SITES}),
marked AS (
  SELECT l.doc_id, l.line, l.pos, coalesce(l.doc_id <> s.first_id, false) AS gone
  FROM l LEFT JOIN spread s ON trim(l.line, ' ') = s.k)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
       count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_removed
FROM marked GROUP BY doc_id
UNION ALL
SELECT doc_id, NULL, 0::BIGINT, 0::BIGINT FROM documents WHERE text IS NULL
"""
