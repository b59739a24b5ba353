"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints.  64 bits over the text's 3-word shingles (XXH64, seed 42).

Index.  Two fingerprints within ``DISTANCE`` bits agree on at least one
of ``DISTANCE + 1`` blocks of bits.  Each distinct fingerprint is filed
once for each block, its bits turned so that the block leads; the shared
leading bits are the top node.  A top node with more than ``NODE_ROWS``
fingerprints is split in the same way on its other bits, again and again,
so no node is ever too large for one task and no link is lost.

A task sorts the nodes it has of one filing by Gray rank, in which the
members of a node, and nodes that share leading bits, stand together.
Groups of ``FAN`` fingerprints form the lowest level of the hierarchy,
groups of those the next, up to the root; every group keeps as a mask and
pattern the bits that all below it share and that no group above has
factored out.  A search goes down from the root, adds up the differing
bits group by group, and drops a whole group once the sum exceeds
``DISTANCE``, or once the group lies outside the fingerprint's own node
(links between nodes are found in another filing).  Links found are
merged at once into stars (a member and its root), so a dense group gives
one row for each member, never pairs.

Components of the stars are found in Spark (``components``).

Defined results.  Null or empty text, or none but white space: the zero
fingerprint, linked like any other.  One or two words: the whole
sequence is the shingle.  Equal texts share a fingerprint and a class.
A null id takes part in linking, but a component is named by its
smallest id that is not null (null if it has none).  Repeated rows are
kept.  Very long texts are read whole.  Empty table: no rows.  Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import cut_lineage, id_and_text, map_batches
from ledgerline.llm.components import connected_components, merge_labels
from ledgerline.operators.joins import unused

SHINGLE_WORDS = 3
DISTANCE = 2
SEED = 42
NODE_ROWS = 20_000
FAN = 16
TASK_ROWS = 60_000
QUERIES_AT_ONCE = 2048

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLANES = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the word shingles, as a signed integer."""
    parts = text.encode().lower().split()  # bytes: only A-Z and ASCII white space
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        if not parts:
            return 0
        hashes = [digest(b" ".join(parts), SEED)]
    elif words == 3:
        spaced = [p + b" " for p in parts]
        hashes = [digest(a + b + c, SEED) for a, b, c in zip(spaced, spaced[1:], parts[2:])]
    else:
        hashes = [digest(b" ".join(parts[i:i + words]), SEED) for i in range(len(parts) - words + 1)]
    h = np.array(hashes, "<u8")
    # Occurrences of each byte value at each of the 8 places, then of each bit.
    at = (h.view(np.uint8).reshape(-1, 8) + _PLANES).ravel()
    ones = (np.bincount(at, minlength=2048).reshape(8, 256) @ _BITS).ravel()
    value = int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp) of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [fingerprint(t, words) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(fps, pa.int64())],
                                          ["doc_id", "text_hash", "fp"])

    rows = id_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    return map_batches(rows, run, "doc_id long, text_hash long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchical index over distinct codes in Gray order."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.pruned = self.compared = 0  # groups dropped and codes compared by all searches
        every = ~np.uint64(0)
        levels = []
        low_and, low_or = codes, codes
        while True:
            starts = np.arange(0, len(low_and), FAN)
            low_and = np.bitwise_and.reduceat(low_and, starts)
            low_or = np.bitwise_or.reduceat(low_or, starts)
            levels.append((low_and, ~(low_and ^ low_or) & every))  # shared pattern, mask
            if len(starts) == 1:
                break
        # From the root down; a mask holds what no node above has factored out.
        self.levels = []
        above = np.zeros(1, np.uint64)
        for pattern, mask in reversed(levels):
            upper = above if len(above) == len(mask) else np.repeat(above, FAN)[: len(mask)]
            self.levels.append((pattern, mask & ~upper))
            above = mask

    def search(self, queries: np.ndarray, distance: int, lead: np.uint64 = np.uint64(0)) -> tuple[np.ndarray, np.ndarray]:
        """(query, code) positions within ``distance`` bits; pairs that
        differ in a bit of ``lead`` need not be found."""
        q = np.arange(len(queries))
        node = np.zeros(len(queries), np.int64)
        total = np.zeros(len(queries), np.int64)
        below = [len(p) for p, _ in self.levels[1:]] + [len(self.codes)]
        for (pattern, mask), size in zip(self.levels, below):
            differing = (queries[q] ^ pattern[node]) & mask[node]
            total = total + np.bitwise_count(differing)
            stay = (total <= distance) & (differing & lead == 0)
            q, node, total = q[stay], node[stay], total[stay]
            self.pruned += len(stay) - len(q)
            node = (node[:, None] * FAN + np.arange(FAN)).ravel()
            q, total = np.repeat(q, FAN), np.repeat(total, FAN)
            there = node < size
            q, node, total = q[there], node[there], total[there]
        self.compared += len(q)
        near = np.bitwise_count(queries[q] ^ self.codes[node]) <= distance
        return q[near], node[near]


def _stars(path: np.ndarray, fixed: np.ndarray, codes: np.ndarray, distance: int) -> np.ndarray:
    """Labels (smallest position of the linked set) of rows sorted by
    path and Gray rank; links are looked for within the nodes, the codes
    of a path that share the first ``fixed`` bits."""
    labels = np.arange(len(codes))
    bounds = np.flatnonzero(np.r_[True, path[1:] != path[:-1], True])
    for a, b in zip(bounds, bounds[1:]):
        index = GrayIndex(codes[a:b])
        lead = ~np.uint64((1 << (64 - int(fixed[a]))) - 1)
        for s in range(a, b, QUERIES_AT_ONCE):
            i, j = index.search(codes[s:min(b, s + QUERIES_AT_ONCE)], distance, lead)
            later = i + s < j + a
            merge_labels(labels, i[later] + s, j[later] + a)
    return labels


def _stars_of_partition(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def stars(columns: list[np.ndarray]) -> pa.RecordBatch | None:
            path, _, fixed, code, fp = columns
            order = np.lexsort((gray_rank(code), path))
            path, fixed, code, fp = path[order], fixed[order], code[order], fp[order]
            labels = _stars(path, fixed, code, distance)
            linked = np.flatnonzero(labels != np.arange(len(labels)))
            if not len(linked):
                return None
            return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[labels[linked]])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            path, node, fixed, code, fp = (batch.column(i).to_numpy() for i in range(5))
            held.append((path, node, fixed, code.astype(np.int64).view(np.uint64), fp))
            rows += batch.num_rows
            if rows < TASK_ROWS:
                continue
            columns = [np.concatenate(c) for c in zip(*held)]
            # The last node may go on in the next batch.
            last = np.flatnonzero((columns[0] != columns[0][-1]) | (columns[1] != columns[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            held, rows = [tuple(c[cut:] for c in columns)], rows - cut
            if cut and (found := stars([c[:cut] for c in columns])) is not None:
                yield found
        if rows:
            found = stars([np.concatenate(c) for c in zip(*held)])
            if found is not None:
                yield found

    return run


def _file_by_block(rows: DataFrame, blocks: int) -> DataFrame:
    """Each row (path, fixed, code, fp) once for each block of its bits
    that are not fixed yet, turned so that the block follows the fixed
    ones.  ``node`` is what leads."""
    rows = rows.withColumn("free", 64 - F.col("fixed"))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = rows.withColumn("first", F.expr(f"cast(floor(free * block / {blocks}) AS int)"))
    rows = rows.withColumn("width", F.expr(f"cast(floor(free * (block + 1) / {blocks}) AS int) - first"))
    # The free bits as the top of a 64-bit value; turned left within their own number.
    top = "shiftleft(code, fixed)"
    turned = (f"CASE WHEN first = 0 THEN {top} ELSE shiftleft({top}, first) "
              f"| shiftleft(shiftrightunsigned({top}, 64 - first), fixed) END")
    rows = rows.withColumn("turned", F.expr(turned))
    kept = "CASE WHEN fixed = 0 THEN 0L ELSE shiftleft(shiftrightunsigned(code, 64 - fixed), 64 - fixed) END"
    rows = rows.withColumn("code", F.expr(f"({kept}) | shiftrightunsigned(turned, fixed)"))
    rows = rows.withColumn("path", F.expr(f"path * {blocks + 1} + block + 1"))
    rows = rows.withColumn("fixed", F.expr("fixed + width"))
    return rows.select("path", F.expr("shiftrightunsigned(code, 64 - fixed)").alias("node"), "fixed", "code", "fp")


def star_links(fps: DataFrame, distance: int = DISTANCE, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints of ``fps``
    (distinct values ``fp``) that differ in at most ``distance`` bits."""
    if node_rows < 64:
        raise ValueError("node_rows must be 64 or more")  # all values of six free bits
    start = fps.select(F.lit(0).cast("long").alias("path"), F.lit(0).alias("fixed"), F.col("fp").alias("code"), "fp")
    rows, links = _file_by_block(start, distance + 1), None
    stars = _stars_of_partition(distance)
    while True:
        large = cut_lineage(rows.groupBy("path", "node").agg(F.count("*").alias("n")).where(F.col("n") > node_rows)
                            .select("path", "node"))
        split = not large.isEmpty()
        small = rows.join(large, ["path", "node"], "left_anti") if split else rows
        found = (small.select("path", "node", "fixed", "code", "fp").repartition("path", "node")
                 .sortWithinPartitions("path", "node").mapInArrow(stars, "a long, b long"))
        links = found if links is None else links.unionByName(found)
        if not split:
            return links
        rows = cut_lineage(_file_by_block(rows.join(large, ["path", "node"], "left_semi"), distance + 1))


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row; the root
    tells components apart that the same id names."""
    marked = cut_lineage(fingerprints(docs, words))
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = connected_components(star_links(classes.select("fp"), distance))
    classes = cut_lineage(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left"))
    named = cut_lineage(classes.where("root IS NOT NULL").groupBy("root").agg(F.min("first_id").alias("component_id")))
    # Fingerprints without a link have no root: they skip the join, where their null key would be one task.
    alone = classes.where("root IS NULL").select("fp", F.col("fp").alias("root"), F.col("first_id").alias("component_id"))
    classes = classes.where("root IS NOT NULL").join(named, "root").select("fp", "root", "component_id").unionByName(alone)
    return marked.join(classes, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def simhash_classes(docs: DataFrame) -> DataFrame:
    """The query's columns: the fingerprint as 16 hex digits."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents (all columns) that name their component: of each
    group one row stays, that with the smallest id.  Several rows of that
    id in the group: the one whose text sorts first.  An id with unrelated
    texts may name several groups and keeps a row in each.  Rows with a
    null id have no identity and stay."""
    names = docs.columns
    own, hashed, group, turn = unused(["own_id", "text_hash", "group", "turn"], names)
    kept = near_duplicates(docs).where(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id").alias(own), F.col("text_hash").alias(hashed), F.col("root").alias(group)).distinct()
    known = docs.where(F.col("doc_id").isNotNull())
    text_hash = F.xxhash64(F.coalesce(known["text"].cast("string"), F.lit("")))
    known = known.join(kept, (known["doc_id"].cast("long") == kept[own]) & (text_hash == kept[hashed]))
    order = Window.partitionBy(own, group).orderBy(F.col("text").asc_nulls_first())
    known = known.withColumn(turn, F.row_number().over(order)).where(F.col(turn) == 1).select(*names)
    return known.unionByName(docs.where(F.col("doc_id").isNull()))
