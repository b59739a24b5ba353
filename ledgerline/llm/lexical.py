"""Exact top-k lexical search for a set of queries: hybrid TAAT-DAAT.

Three passes, none of which shuffles a text or a posting:

1. The queries' distinct terms are numbered, and one narrow pass over the
   documents writes, for every ``SEGMENT_CHARS`` bytes of text, one
   segment: the documents' ids and lengths, and the postings (document,
   tf) of the queries' terms, sorted by term.
2. The number of documents N, of terms L, and each term's document
   frequency are summed over the segments.
3. Each segment answers every query; a task carries a query's best k from
   one segment to the next, and what tasks found is merged exactly.

Within a segment the lists of a query are short (at most one document in
``SHORT``) or long.  Short lists are taken term at a time: they are summed
into accumulators.  These accumulators are then one more iterator, with
its own upper bound, beside the long lists in a document-at-a-time loop
in the order of documents, ``WINDOW`` documents a step.  Iterators whose
bounds together stay below the k-th best score so far cannot make a
result; only the others propose documents.  The proposed ones are looked
up in the rest, greatest bound first, which skips all other postings of
long lists, and a document is left as soon as what remains cannot lift it
to the k-th score.  No document that could enter the top k is left out.

Queries are taken in blocks of about ``BLOCK`` (query, term) pairs, each
a pass over the documents, so that what the driver and the tasks hold of
the queries and their statistics is bounded at any number of queries.

Score: see ``weights`` and ``impacts``; all integers.  Terms: maximal
runs of ASCII digits and letters and of all characters above ASCII; only
A-Z are lower-cased.

Defined results.  Null or empty text and text without a term: such a
document counts in no statistic and is never found; such a query finds
nothing.  Equal scores: the smaller id first, null ids last.  Repeated
rows are documents of their own.  Rows that repeat an item id are one
query with the terms of all of them; a null item id is an id like any
other.  Fewer than k matches: fewer rows.  Very long texts are read
whole.  Empty tables: no rows.  Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import id_and_text, written

K = 10
SEGMENT_CHARS = 16_000_000
SHORT = 16
WINDOW = 2048
BLOCK = 500_000

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
SEGMENT = ("n_docs long, n_terms long, ids binary, no_id binary, lengths binary, terms binary, sizes binary, "
           "docs binary, tfs binary")
NO_LIMIT = np.iinfo(np.int64).max


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order; lower() changes A-Z only."""
    return _TERM.findall(text.lower())


def weights(df: np.ndarray, total: int) -> np.ndarray:
    """A term's weight by its document frequency."""
    return np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def impacts(tf: np.ndarray, length: np.ndarray, total: int, terms: int) -> np.ndarray:
    """What an occurrence count is worth in a document of that length."""
    wide = 90 * int(length.max(initial=0)) * total >= 1 << 63
    share = (length.astype(object) * (90 * total) // terms).astype(np.int64) if wide else 90 * length * total // terms
    return 1_000_000_000 * tf // (1000 * tf + 8 * (100 - 90 + share))


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), a row for each distinct term of an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.binary()))],
                                             ["item_id", "terms"])

    found = id_and_text(items, "item_id").mapInArrow(run, "item_id long, terms array<binary>")
    return found.select("item_id", F.explode("terms").alias("term")).distinct()


class _Filing:
    """The documents of a segment that is being written."""

    def __init__(self):
        self.ids: list = []
        self.lengths: list[int] = []
        self.terms: list[int] = []
        self.docs: list[int] = []
        self.tfs: list[int] = []
        self.chars = 0

    def add(self, doc_id, text: bytes, number: dict[bytes, int]) -> None:
        counts = Counter(terms_of(text))
        if not counts:
            return
        known = counts.keys() & number.keys()
        self.docs += [len(self.ids)] * len(known)
        self.terms += map(number.__getitem__, known)
        self.tfs += map(counts.__getitem__, known)
        self.ids.append(doc_id)
        self.lengths.append(counts.total())
        self.chars += len(text)

    def batch(self) -> pa.RecordBatch:
        terms, docs = np.array(self.terms, np.int32), np.array(self.docs, np.int32)
        order = np.lexsort((docs, terms))
        kinds, sizes = np.unique(terms, return_counts=True)
        columns = {"n_docs": len(self.ids), "n_terms": sum(self.lengths),
                   "ids": np.array([0 if d is None else d for d in self.ids], np.int64),
                   "no_id": np.array([d is None for d in self.ids], bool), "lengths": np.array(self.lengths, np.int64),
                   "terms": kinds, "sizes": sizes.astype(np.int32), "docs": docs[order],
                   "tfs": np.array(self.tfs, np.int32)[order]}
        return pa.RecordBatch.from_arrays(
            [pa.array([v.tobytes()], pa.binary()) if isinstance(v, np.ndarray) else pa.array([v], pa.int64())
             for v in columns.values()], list(columns))


def segments(docs: DataFrame, number: dict[bytes, int], segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """One row for each segment, see ``SEGMENT``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filing = _Filing()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                filing.add(doc_id, text.as_py(), number)
                if filing.chars >= segment_chars:
                    yield filing.batch()
                    filing = _Filing()
        if filing.ids:
            yield filing.batch()

    return id_and_text(docs).mapInArrow(run, SEGMENT)


class Segment:
    """Postings of one segment with what each is worth."""

    def __init__(self, row: dict, weight: np.ndarray, total: int, terms: int):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids, self.no_id = read("ids", np.int64), read("no_id", bool)
        self.n = len(self.ids)
        self.terms, self.sizes = read("terms", np.int32), read("sizes", np.int32)
        self.docs = read("docs", np.int32)
        self.start = np.cumsum(self.sizes) - self.sizes
        value = impacts(read("tfs", np.int32).astype(np.int64), read("lengths", np.int64)[self.docs], total, terms)
        self.value = value * np.repeat(weight[self.terms], self.sizes)
        self.bound = np.maximum.reduceat(self.value, self.start) if len(self.start) else self.value

    def lists(self, query: np.ndarray) -> np.ndarray:
        """Positions (in ``terms``) of the query's terms that occur here."""
        if not len(self.terms):
            return self.terms
        at = np.minimum(np.searchsorted(self.terms, query), len(self.terms) - 1)
        return at[self.terms[at] == query]

    def postings(self, at: int) -> slice:
        return slice(self.start[at], self.start[at] + self.sizes[at])


class Best:
    """The k best documents of one query so far."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.no_id = np.zeros(0, bool)

    @property
    def floor(self) -> int:
        """The least score that can still enter."""
        return max(1, int(self.score[-1])) if len(self.score) == self.k else 1

    def offer(self, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        no_id = np.concatenate([self.no_id, no_id])
        top = np.lexsort((ids, no_id, -score))[: self.k]
        self.score, self.ids, self.no_id = score[top], ids[top], no_id[top]


def search(segment: Segment, query: np.ndarray, best: Best) -> int:
    """Adds the segment's results to ``best``; the number of documents
    that were scored."""
    at = segment.lists(query)
    if not len(at):
        return 0
    short = segment.sizes[at] * SHORT <= segment.n
    # Term at a time: the accumulators of the short lists.  Sums stay far
    # below 2^53, so that the doubles are exact.
    own = [segment.postings(a) for a in at[short]]
    accumulators = np.zeros(segment.n, np.int64)
    if own:
        accumulators = np.bincount(np.concatenate([segment.docs[s] for s in own]),
                                   np.concatenate([segment.value[s] for s in own]), segment.n).astype(np.int64)
    filled = np.flatnonzero(accumulators)
    # Iterators by ascending bound: (documents, values), the accumulators among them.
    iterators = [(int(accumulators.max(initial=0)), filled, accumulators[filled])]
    iterators += [(int(segment.bound[a]), segment.docs[s := segment.postings(a)], segment.value[s]) for a in at[~short]]
    iterators = sorted((x for x in iterators if x[0]), key=lambda x: x[0])
    reach = np.cumsum([x[0] for x in iterators])  # of an iterator with all below it
    scored = 0
    for first in range(0, segment.n, WINDOW):
        floor = best.floor
        essential = int(np.searchsorted(reach, floor))  # those below cannot reach the floor together
        if essential == len(iterators):
            break
        partial = np.zeros(min(WINDOW, segment.n - first), np.int64)
        for _, docs, values in iterators[essential:]:
            a, b = np.searchsorted(docs, (first, first + WINDOW))
            partial[docs[a:b] - first] += values[a:b]
        docs = np.flatnonzero(partial)
        score = partial[docs]
        docs += first
        for i in range(essential - 1, -1, -1):
            alive = score + reach[i] >= floor
            docs, score = docs[alive], score[alive]
            if not len(docs):
                break
            _, there, values = iterators[i]
            place = np.minimum(np.searchsorted(there, docs), len(there) - 1)
            score = score + np.where(there[place] == docs, values[place], 0)
        scored += len(docs)
        good = score >= floor
        if good.any():
            docs = docs[good]
            best.offer(score[good], segment.ids[docs], segment.no_id[docs])
    return scored


def _answer(filed: DataFrame, queries: list[tuple], weight: np.ndarray, total: int, terms: int, k: int) -> DataFrame:
    names = ["query", "doc_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for batch in batches:
            for n in range(batch.num_rows):
                segment = Segment(batch.slice(n, 1).to_pylist()[0], weight, total, terms)
                for found, (_, query) in zip(best, queries):
                    search(segment, query, found)
        for number, found in enumerate(best):
            if len(found.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found.score), number, np.int32)), pa.array(found.ids, mask=found.no_id),
                     pa.array(found.score)], names)

    return filed.mapInArrow(run, "query int, doc_id long, score long")


def _in_block(docs: DataFrame, pairs: list, k: int) -> DataFrame | None:
    """Results of one block of queries, given as (item_id, term) rows."""
    number = {t: n for n, t in enumerate(sorted({bytes(r["term"]) for r in pairs}))}
    by_item: dict = {}
    for r in pairs:
        by_item.setdefault(r["item_id"], []).append(number[bytes(r["term"])])
    queries = [(item, np.array(sorted(by_item[item]), np.int32)) for item in sorted(by_item, key=lambda i: (i is None, i))]
    filed = written(segments(docs, number), "segments")
    sums = filed.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    if not sums["n"]:
        return None

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(number), np.int64)
        for batch in batches:
            for t, s in zip(batch.column("terms").to_pylist(), batch.column("sizes").to_pylist()):
                df[np.frombuffer(t, np.int32)] += np.frombuffer(s, np.int32)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "df"])

    # A row for each term of the block: bounded by the block.
    known = filed.select("terms", "sizes").mapInArrow(sizes, "term long, df long").groupBy("term").agg(
        F.sum("df").alias("df")).collect()
    df = np.zeros(len(number), np.int64)
    for r in known:
        df[r["term"]] = r["df"]
    found = _answer(filed, queries, weights(df, sums["n"]), sums["n"], sums["l"], k)
    items = docs.sparkSession.createDataFrame([(n, item) for n, (item, _) in enumerate(queries)], "query int, item_id long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(items, "query").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item."""
    pairs = written(query_terms(items), "query-terms")
    n = pairs.count()
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    blocks = -(-n // block)
    for b in range(blocks):
        found = _in_block(docs, pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect(), k)
        if found is not None:
            out = found if blocks == 1 else out.unionByName(found)
    return out


# N, L, document frequencies and scores by their definition.
ORACLE = """
WITH found AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
sized AS (SELECT row_no, doc_id, words, len(words) AS n FROM found WHERE len(words) > 0),
total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_words FROM sized),
occurring AS (SELECT row_no, unnest(words) AS term FROM sized),
counted AS (SELECT row_no, term, count(*) AS tf FROM occurring GROUP BY row_no, term),
spread AS (SELECT term, count(*) AS df FROM counted GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark),
weighed AS (
  SELECT item_id, term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM asked JOIN spread USING (term), total),
scored AS (
  SELECT w.item_id, s.row_no, s.doc_id,
         sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (100 - 90 + (90 * s.n * t.n_docs) // t.n_words))))::BIGINT AS score
  FROM weighed w JOIN counted c ON w.term = c.term JOIN sized s ON s.row_no = c.row_no, total t
  GROUP BY w.item_id, s.row_no, s.doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank,
         doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
