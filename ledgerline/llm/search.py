"""Exact top-k BM25 search: inverted index with block-max pruning, run
per shard and merged with global statistics.

1. One narrow pass tokenises the documents and writes, for about every
   ``SHARD_CHARS`` characters, one shard: ids, lengths and the postings
   (document, tf) by term hash.  No text is shuffled.  Within a shard
   documents of like vocabulary (say, of one language) form a group, and
   in it those with the same commonest word and of like length lie
   together, which makes the maxima of a run of documents tight.
2. Document frequencies, their number and mean length are summed over the
   shards, so a document's score does not depend on its shard.
3. Queries are taken in blocks of ``QUERY_BLOCK``, which bounds what the
   driver and a task hold of them.  Each shard answers the block; a task
   carries a query's best k from shard to shard; what tasks found is
   merged exactly.

Postings of a term in groups where it is rare are added up for all
documents.  Where it is frequent (in more than one document in
``FREQUENT`` of a group) they are not: for each run of
``RUN`` documents only the greatest impact of each term is added, which
bounds the score of every document of the run.  Documents whose bounds
stay below the query's k-th best score so far, from this shard or those
before it, are skipped.  This is term-at-a-time scoring with a block-max
filter and stands in for WAND: pivots found by the summed block maxima of
all lists were built and measured too, and cost about five times as much
here, as queries of hundreds of terms have more blocks than they skip
(README).  What is left for any query of a batch is scored in one matrix
product for each group, in single precision; documents that the proven
rounding error still lets into the top k are scored again in double
precision, from the document's own terms.  No
document that could enter the top k is skipped.

score = sum over the query's distinct terms of idf * tf * (k1 + 1) /
(tf + k1 * (1 - b + b * length / mean length)), idf = ln(1 + (N - df +
0.5) / (df + 0.5)); terms are runs of word characters in lower case.
Scores are rounded to ``DIGITS`` digits.

Defined results.  Null, empty or wordless text: no term, so it is neither
found nor finds.  Equal scores: the smaller id first.  Repeated rows are
documents of their own; queries that repeat id and text are one query.
A null id can't be named and is neither document nor query, though it
counts in no statistic either.  Fewer than k matches: fewer rows.  Very
long texts are read whole.  Empty table: no rows.  Other columns are not
read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import id_and_text, written

K = 10
K1, B = 1.2, 0.75
SHARD_CHARS = 16_000_000
QUERY_BLOCK = 8_192
TASKS_A_CORE = 2
BATCH = 64
BATCH_CELLS = 2_000_000  # queries x documents at once
FREQUENT = 8
RUN = 8
GROUPS = 8
SIGNS = 128
ROUNDS = 4
DIGITS = 9
SLACK = 1e-6  # above any rounding in double precision

_WORD = re.compile(r"\w+")
SHARD = ("n_docs long, n_words long, ids binary, lengths binary, groups binary, terms binary, sizes binary, docs binary, "
         "tfs binary")


def terms_of(text: str) -> Counter:
    return Counter(_WORD.findall(text.lower()))


def _hashed(words) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words)).view(np.int64)


def _commonest(numbers: np.ndarray) -> int:
    if not len(numbers):
        return -1
    values, counts = np.unique(numbers, return_counts=True)
    return int(values[np.argmax(counts)])


def _groups(found: list[np.ndarray], lengths: np.ndarray, common: np.ndarray, vocabulary: int) -> np.ndarray:
    """Each document's group: at most ``GROUPS``, begun from the words
    that are commonest most often and improved by a few rounds of k-means
    on the shares of the ``SIGNS`` most frequent words."""
    n = len(found)
    if not vocabulary:
        return np.zeros(n, np.int64)
    word = np.concatenate(found)
    signs = np.argsort(-np.bincount(word, minlength=vocabulary), kind="stable")[:SIGNS]
    column = np.full(vocabulary, -1)
    column[signs] = np.arange(len(signs))
    column = column[word]
    doc = np.repeat(np.arange(n), lengths)[column >= 0]
    shares = np.bincount(doc * len(signs) + column[column >= 0], minlength=n * len(signs)).reshape(n, -1)
    shares = np.sqrt(shares / np.maximum(shares.sum(axis=1, keepdims=True), 1)).astype(np.float32)
    words, which, times = np.unique(common, return_inverse=True, return_counts=True)
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(-times, kind="stable")] = np.arange(len(words))
    group = np.minimum(rank[which], GROUPS - 1)
    for _ in range(ROUNDS):
        centre = np.zeros((GROUPS, len(signs)), np.float32)
        np.add.at(centre, group, shares)
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-9)
        group = np.argmax(shares @ centre.T, axis=1)
    return group


class _Filing:
    """The documents of a shard that is being written."""

    def __init__(self):
        self.vocabulary: defaultdict[str, int] = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__  # the next number
        self.ids: list[int] = []
        self.found: list[np.ndarray] = []
        self.chars = 0

    def add(self, doc_id: int, text: str) -> None:
        self.ids.append(doc_id)
        self.found.append(np.fromiter(map(self.vocabulary.__getitem__, _WORD.findall(text.lower())), np.int32))
        self.chars += len(text)

    def batch(self) -> pa.RecordBatch:
        ids, n = np.array(self.ids, np.int64), len(self.ids)
        lengths = np.fromiter(map(len, self.found), np.int64, n)
        common = np.fromiter(map(_commonest, self.found), np.int64, n)
        group = _groups(self.found, lengths, common, len(self.vocabulary))
        order = np.lexsort((ids, lengths, common, group))
        found, lengths, ids = [self.found[i] for i in order], lengths[order], ids[order]
        hashes = _hashed(self.vocabulary)
        by_hash = np.argsort(hashes)
        place = np.empty(len(hashes), np.int64)
        place[by_hash] = np.arange(len(hashes))
        # One number for each word's (term, document); equal ones make tf.
        word = place[np.concatenate(found)] if n else np.zeros(0, np.int64)
        word *= n
        word += np.repeat(np.arange(n, dtype=np.int32), lengths)
        word.sort()
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]][: len(word)])
        tfs = np.diff(np.r_[first, len(word)])
        word = word[first]
        columns = {"n_docs": n, "n_words": int(lengths.sum()), "ids": ids, "lengths": lengths,
                   "groups": np.unique(group, return_counts=True)[1].astype(np.int64), "terms": hashes[by_hash],
                   "sizes": np.bincount(word // max(n, 1), minlength=len(hashes)).astype(np.int32),
                   "docs": (word % max(n, 1)).astype(np.int32), "tfs": tfs.astype(np.int32)}
        return pa.RecordBatch.from_arrays(
            [pa.array([v.tobytes()], pa.binary()) if isinstance(v, np.ndarray) else pa.array([v], pa.int64())
             for v in columns.values()], list(columns))


def shards_of(rows: DataFrame, shard_chars: int) -> DataFrame:
    """One row for each shard, see ``SHARD``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filing = _Filing()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                filing.add(doc_id, text.as_py())
                if filing.chars >= shard_chars:
                    yield filing.batch()
                    filing = _Filing()
        if filing.ids:
            yield filing.batch()

    return rows.mapInArrow(run, SHARD)


def document_frequencies(shards: DataFrame) -> DataFrame:
    """(term, df)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, sizes in zip(batch.column("terms"), batch.column("sizes")):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(terms.as_py(), np.int64)), pa.array(np.frombuffer(sizes.as_py(), np.int32))],
                    ["term", "n"])

    return shards.select("terms", "sizes").mapInArrow(run, "term long, n int").groupBy("term").agg(F.sum("n").alias("df"))


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, query_hash, term), a row for each distinct term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [_hashed(set(_WORD.findall(t.lower()))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("query_hash"),
                                              pa.array(terms, pa.list_(pa.int64()))],
                                             ["query_id", "query_hash", "terms"])

    found = queries.select("doc_id", F.xxhash64("text").alias("query_hash"), "text").mapInArrow(
        run, "query_id long, query_hash long, terms array<long>")
    return found.dropDuplicates(["query_id", "query_hash"]).select(
        "query_id", "query_hash", F.explode("terms").alias("term"))


class Block:
    """The queries of a block: their distinct terms, rarest first, and
    each query's as places among them, in the same order."""

    def __init__(self, terms: np.ndarray, dfs: np.ndarray, sizes: np.ndarray, total: int):
        self.hashes, first, number = np.unique(terms, return_index=True, return_inverse=True)
        df = dfs[first].astype(float)
        order = np.argsort(df, kind="stable")
        self.place = np.empty(len(order), np.int32)  # of a hash among the terms
        self.place[order] = np.arange(len(order), dtype=np.int32)
        df = df[order]
        self.idf = np.log(1 + (total - df + 0.5) / (df + 0.5))
        self.often = int(np.searchsorted(df * FREQUENT, total, "right"))  # the frequent terms begin here
        self.number, self.ends = self.place[number], np.cumsum(sizes)
        self.starts = self.ends - sizes

    def __len__(self) -> int:
        return len(self.ends)

    def terms_of(self, q: int) -> np.ndarray:
        return self.number[self.starts[q]:self.ends[q]]


class Best:
    """The k best documents of each query of a block so far."""

    def __init__(self, queries: int, k: int):
        self.score, self.ids = np.full((queries, k), -np.inf), np.zeros((queries, k), np.int64)

    def offer(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(score) or score.max() < self.score[q, -1]:
            return
        score, ids = np.concatenate([self.score[q], score]), np.concatenate([self.ids[q], ids])
        top = np.lexsort((ids, -score))[: self.score.shape[1]]
        self.score[q], self.ids[q] = score[top], ids[top]


class Group:
    """Documents of a shard that lie together, and the impacts of the
    terms frequent among them."""

    def __init__(self, first: int, size: int, columns: int, docs: np.ndarray, column: np.ndarray, impact: np.ndarray):
        self.at, self.columns = slice(first, first + size), columns
        self.dense = np.zeros((-(-size // RUN) * RUN, columns), np.float32)  # a document's impacts lie together
        self.dense[docs - first, column] = impact
        self.most = self.dense.reshape(len(self.dense) // RUN, RUN, columns).max(axis=1)
        self.top = self.most.max(axis=0)


class Shard:
    """Inverted index of some documents, as far as a block asks for it.
    An impact has its term's idf in it."""

    def __init__(self, row: dict, mean_length: float, block: Block):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids, hashes, self.block = read("ids", np.int64), read("terms", np.int64), block
        self.n, self.scored, self.groups = len(self.ids), 0, []
        if not len(hashes) or not len(block.hashes):
            return
        found = np.minimum(np.searchsorted(hashes, block.hashes), len(hashes) - 1)
        at = np.full(len(found), -1)
        at[block.place] = np.where(hashes[found] == block.hashes, found, -1)
        here = np.flatnonzero(at >= 0)
        self.place = np.full(len(at), -1, np.int32)  # a block's term here
        self.place[here] = np.arange(len(here))
        self.often = int(np.searchsorted(here, block.often))
        sizes, at = read("sizes", np.int32).astype(np.int64), at[here]
        size = sizes[at]
        posting = _ranges(np.stack([np.cumsum(sizes) - sizes, sizes], axis=1)[at])
        docs, tf = read("docs", np.int32)[posting], read("tfs", np.int32)[posting].astype(float)
        norm = K1 * (1 - B + B * read("lengths", np.int64) / mean_length)
        impact = tf * (K1 + 1) / (tf + norm[docs]) * np.repeat(block.idf[here], size)
        if len(here):
            self._file(np.repeat(np.arange(len(here), dtype=np.int32), size), docs, impact, read("groups", np.int64), len(here))

    def _file(self, term: np.ndarray, docs: np.ndarray, impact: np.ndarray, groups: np.ndarray, terms: int) -> None:
        """Tables of the terms frequent in a group, postings of the rest,
        and each document's own terms."""
        group = np.repeat(np.arange(len(groups)), groups)[docs]
        cell = term * np.int64(len(groups)) + group
        often = np.bincount(cell, minlength=terms * len(groups)).reshape(terms, -1) * FREQUENT > groups
        # A term's column in each group's table.
        self.column = np.where(often, np.cumsum(often, axis=0, dtype=np.int32) - 1, np.int32(-1)).T.copy()
        tabled = often.ravel()[cell]
        first = np.cumsum(groups) - groups
        for g, size in enumerate(groups.tolist()):
            mine = np.flatnonzero(tabled & (group == g))
            self.groups.append(Group(int(first[g]), size, int(often[:, g].sum()), docs[mine], self.column[g, term[mine]],
                                     impact[mine]))
        rest = np.flatnonzero(~tabled)
        small = docs.astype(np.uint16) if self.n <= 1 << 16 else docs  # what all cores read at once should stay in cache
        self.docs, self.impact = small[rest], impact[rest].astype(np.float32)
        size = np.bincount(term[rest], minlength=terms)
        self.lists = np.stack([np.cumsum(size) - size, size], axis=1)
        by_doc = np.argsort(small, kind="stable")
        self.own_terms, self.own_impact = term[by_doc], impact[by_doc]
        size = np.bincount(docs, minlength=self.n)
        self.own = np.stack([np.cumsum(size) - size, size], axis=1)
        self.asked = np.zeros(terms, bool)

    def search(self, best: Best) -> None:
        """Adds the shard's results for the block's queries."""
        if not self.groups:
            return
        step = max(1, min(BATCH, BATCH_CELLS // self.n))
        # Queries that share most terms with the same group go together.
        terms = self.place[self.block.number]
        shared = np.stack([np.add.reduceat(column[terms] >= 0, self.block.starts, dtype=np.int32) for column in self.column])
        order = np.argsort(np.argmax(shared, axis=0), kind="stable")
        for s in range(0, len(order), step):
            self._batch(order[s:s + step], best)

    def _batch(self, asking: np.ndarray, best: Best) -> None:
        k, number = best.score.shape[1], len(asking)
        found = [self.place[self.block.terms_of(q)] for q in asking.tolist()]
        found = [terms[terms >= 0] for terms in found]
        score = np.empty((number, self.n), np.float32)
        for q, terms in enumerate(found):
            posting = _ranges(self.lists.take(terms, axis=0))
            score[q] = np.bincount(self.docs.take(posting), self.impact.take(posting), self.n)
        # Twice the rounding error of sums in single precision.
        eps, asked = np.finfo(np.float32).eps, []
        slack = SLACK + 4 * eps * score.max(axis=1).astype(float)
        bound = score + slack.astype(np.float32)[:, None]
        query, terms = np.repeat(np.arange(number), list(map(len, found))), np.concatenate(found)
        for g, group in enumerate(self.groups):
            column = self.column[g].take(terms)
            at = np.flatnonzero(column >= 0)
            weights = np.zeros((number, group.columns), np.float32)
            weights[query[at], column[at]] = 1
            asked.append(weights)
            if len(at):
                error = (weights.sum(axis=1) + 4.0) * eps * (weights @ group.top)
                most = weights @ group.most.T + error[:, None]
                bound[:, group.at] += np.repeat(most, RUN, axis=1)[:, : group.at.stop - group.at.start]
                slack += error
        floor = np.maximum(best.score[asking, -1], 0.0)
        if self.n > 4 * k:
            for q in np.flatnonzero(floor == 0):  # no k documents yet: the highest bounds give a first floor
                near = np.sort(self._exact(found[q], np.argpartition(-bound[q], 4 * k)[: 4 * k]))
                floor[q] = max(0, near[-k] - SLACK)
        alive = bound >= np.nextafter(floor.astype(np.float32), np.float32(-1))[:, None]
        self.scored += int(np.count_nonzero(alive))
        least = np.nextafter((floor - slack).astype(np.float32), np.float32(-np.inf))[:, None]
        docs, near = [[] for _ in found], [[] for _ in found]
        for weights, group in zip(asked, self.groups):
            some, size = np.flatnonzero(alive[:, group.at].any(axis=0)), group.at.stop - group.at.start
            if not len(some):
                continue
            if 2 * len(some) > size:  # all of them, without a copy
                some, scored = np.arange(size), weights @ group.dense[:size].T + score[:, group.at]
            else:
                scored = weights @ group.dense[some].T + score[:, some + group.at.start]
            query, at = np.nonzero(scored >= least)
            value, at, end = scored[query, at], some[at] + group.at.start, np.searchsorted(query, np.arange(number + 1))
            for q in np.flatnonzero(np.diff(end)).tolist():
                docs[q].append(at[end[q]:end[q + 1]])
                near[q].append(value[end[q]:end[q + 1]])
        for q in range(number):
            if not docs[q]:
                continue
            at, value = np.concatenate(docs[q]), np.concatenate(near[q])
            if len(at) > k:
                at = at[value >= np.partition(value, len(value) - k)[-k] - 2 * slack[q]]
            exact = np.round(self._exact(found[q], at), DIGITS)
            best.offer(asking[q], exact[exact > 0], self.ids[at[exact > 0]])

    def _exact(self, terms: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Double-precision scores of the documents, summed in an order
        that depends on the terms alone, so that copies score the same."""
        own = self.own.take(docs, axis=0)
        at = _ranges(own)
        self.asked[terms] = True
        hit = np.flatnonzero(self.asked.take(self.own_terms.take(at)))
        self.asked[terms] = False
        row, at = np.repeat(np.arange(len(docs)), own[:, 1]).take(hit), at.take(hit)
        term, impact = self.own_terms.take(at), self.own_impact.take(at)
        rare, often = term < self.often, terms[terms >= self.often]
        table = np.zeros((len(docs), len(often)))
        table[row[~rare], np.searchsorted(often, term[~rare])] = impact[~rare]
        return np.bincount(row[rare], impact[rare], len(docs)) + table.sum(axis=1)


def _ranges(lists: np.ndarray) -> np.ndarray:
    """The numbers of all ranges (start, size), one after another."""
    start, size = lists[:, 0], lists[:, 1]
    end = np.cumsum(size)
    out = np.repeat(start - (end - size), size)
    out += np.arange(len(out))
    return out


def _answer(shards: DataFrame, block: pa.Table, total: int, mean: float, k: int) -> DataFrame:
    """(query_id, query_hash, doc_id, score): the best k of each task."""
    ids, keys = block.column("query_id").to_numpy(), block.column("query_hash").to_numpy()
    terms, dfs = (np.concatenate([c.flatten().to_numpy() for c in block.column(n).chunks] or [np.zeros(0, np.int64)])
                  for n in ("terms", "dfs"))
    queries = Block(terms, dfs, block.column("n").to_numpy(), total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(queries), k)
        for batch in batches:
            for n in range(batch.num_rows):
                Shard(batch.slice(n, 1).to_pylist()[0], mean, queries).search(best)
        query, rank = np.nonzero(best.score > -np.inf)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[query]), pa.array(keys[query]), pa.array(best.ids[query, rank]), pa.array(best.score[query, rank])],
            ["query_id", "query_hash", "doc_id", "score"])

    # As many tasks as the cluster runs at once, not as there are shards: each returns k rows a query.
    tasks = TASKS_A_CORE * shards.sparkSession.sparkContext.defaultParallelism
    return shards.coalesce(tasks).mapInArrow(run, "query_id long, query_hash long, doc_id long, score double")


def top_k(docs: DataFrame, is_query: Column, k: int = K, shard_chars: int = SHARD_CHARS,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents of each row
    of ``docs`` for which ``is_query`` (of doc_id) holds."""
    rows = id_and_text(docs).where("doc_id IS NOT NULL")
    shards = written(shards_of(rows, shard_chars), "shards")
    sums = shards.agg(F.sum("n_docs").alias("n"), F.sum("n_words").alias("words")).first()
    total = sums["n"] or 0
    mean = max(sums["words"] or 0, 1) / max(total, 1)
    known = query_terms(rows.where(is_query)).join(document_frequencies(shards), "term")
    queries = known.groupBy("query_id", "query_hash").agg(F.sort_array(F.collect_list(F.struct("df", "term"))).alias("t"))
    queries = written(queries.select("query_id", "query_hash", F.col("t.term").alias("terms"), F.col("t.df").alias("dfs"),
                                     F.size("t").alias("n")), "queries")
    blocks = -(-queries.count() // query_block)
    found = docs.sparkSession.createDataFrame([], "query_id long, query_hash long, doc_id long, score double")
    for b in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("query_id", "query_hash", F.lit("block")), F.lit(blocks)) == b).toArrow()
        if mine.num_rows:
            found = found.unionByName(_answer(shards, mine, total, mean, k))
    best = Window.partitionBy("query_id", "query_hash").orderBy(F.col("score").desc(), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "score")


def search_self(docs: DataFrame) -> DataFrame:
    """Every document whose id is divisible by 50, against all."""
    return top_k(docs, F.col("doc_id") % 50 == 0)
