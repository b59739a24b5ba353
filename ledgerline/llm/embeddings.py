"""Embedding near-duplicates through a pivot-permutation index.

Pivots are distinct vectors, ``MOST_PIVOTS`` at most, spread over the
space: of a bounded sample (those with the smallest hashes) each is taken
whose cosine with all taken before is below ``APART``.  So a dense group,
however large, has few pivots of its own and its members share them.
Retrieval is approximate; README gives the measured recall.  Every distinct vector is
described by its ``NEAREST`` pivots in order of closeness.  Inverted
lists hold the vectors of each pivot; pairs with ``SHARED`` or more
pivots in common are retrieved and verified by their cosine in double
precision.

With all descriptions in one order of pivots (rare ones first), two that
share ``SHARED`` of ``NEAREST`` pivots have their first ``m`` common ones
among the first ``NEAREST - SHARED + m`` of both.  So a vector is filed
under the sets of ``m`` of these only, and a pair counts only in the list
of its first ``m`` common pivots.  ``m`` is 1, and 2 where lists of one
pivot would be longer than ``LONG`` on average: the same pairs are
retrieved, from lists that are shorter by the number of pivots.

Equal vectors are one row from the start, with their number.  Crowds of
near-identical vectors are one entry of the index too.  A crowd is what
lies within half the linking angle of the mean of a cell, a cell being
the vectors with the same first ``CELL`` pivots in the same order, if
there are ``CROWD`` or more.  By the triangle inequality all its vectors
link with one another, so these pairs are counted and never formed; and
two entries whose centres are near (or far) enough for their radii link
as a whole (or not at all).  Only entries in between are opened, and
their vectors compared.  The angles keep a margin above any rounding, so
no pair below the threshold is counted.

A long list is cut into blocks of about ``BLOCK`` rows and compared block
by block, so no task holds a list, and opened crowds likewise; tasks
return link counts and stars (a member and its root), never pairs of
vectors.  Components of entries are found in Spark.

Defined results.  A vector that is null, empty, zero, or holds a null or
a non-finite component, and one with a null id, links with nothing: 0
links, its own component (null for a null id, which isn't kept).  Vectors
of different lengths don't link.  Repeated rows link with each other.
Empty table: no rows.  Other columns, labels too, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import cut_lineage
from ledgerline.llm.components import component_members, merge_labels

COSINE = 0.9
NEAREST = 8
SHARED = 3
MOST_PIVOTS = 1024
VECTORS_A_PIVOT = 64
APART = 0.8
SAMPLED_A_PIVOT = 4
BLOCK = 1024
LONG = 1024
CELL = 4
CROWD = 32
CENTRE = 4096  # vectors of a cell that its centre is the mean of
MARGIN = 1e-6  # of angles
ENTRY = "e string, first_id long, n long, size long, radius double, unit binary, near binary, pivots array<int>"


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """(cid, vec, first_id, many) of the vectors that can link."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("vec"))
    finite = "forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    rows = rows.where(f"vec_id IS NOT NULL AND size(vec) > 0 AND {finite} AND exists(vec, x -> x <> 0)")
    classes = rows.groupBy("vec").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("many"))
    return cut_lineage(classes.select(F.monotonically_increasing_id().alias("cid"), "vec", "first_id", "many"))


def _unit(rows: list) -> np.ndarray:
    v = np.array(rows, float)
    v /= np.abs(v).max(axis=1, keepdims=True)  # keeps the squares finite and above zero
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _spread(units: np.ndarray, want: int) -> np.ndarray:
    """The first ``want`` of the unit vectors that lie apart from all
    taken before them."""
    taken: list[int] = []
    closest = np.full(len(units), -np.inf)
    for n in range(len(units)):
        if len(taken) < want and closest[n] < APART:
            taken.append(n)
            closest = np.maximum(closest, units @ units[n])
    return units[taken]


def choose_pivots(classes: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """(number of the first pivot, pivots) for each vector length."""
    sizes = {r["d"]: r["n"] for r in classes.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).collect()}
    pivots: dict[int, tuple[int, np.ndarray]] = {}
    first = 0
    for d, n in sorted(sizes.items()):
        want = int(min(MOST_PIVOTS, max(16, n // VECTORS_A_PIVOT)))
        sampled = classes.where(F.size("vec") == d).orderBy(F.xxhash64("vec"), "cid").limit(want * SAMPLED_A_PIVOT)
        points = _spread(_unit([r["vec"] for r in sampled.select("vec").collect()]), want)
        pivots[d] = (first, points)
        first += len(points)
    return pivots


def _nearest(units: np.ndarray, pivots: dict[int, tuple[int, np.ndarray]]) -> np.ndarray:
    offset, points = pivots[units.shape[1]]
    near = np.argsort(-(units @ points.T), axis=1, kind="stable")[:, :NEAREST] + offset
    return near.astype(np.int32)


def describe(classes: DataFrame, pivots: dict[int, tuple[int, np.ndarray]]) -> DataFrame:
    """(cid, first_id, many, unit, near): unit vector and ordered nearest
    pivots, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = batch.column("vec").to_pylist()
            units, nears = [b""] * len(vecs), [b""] * len(vecs)
            by_length: dict[int, list[int]] = {}
            for n, v in enumerate(vecs):
                by_length.setdefault(len(v), []).append(n)
            for at in by_length.values():
                unit = _unit([vecs[n] for n in at])
                for n, u, p in zip(at, unit, _nearest(unit, pivots)):
                    units[n], nears[n] = u.tobytes(), p.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("cid", "first_id", "many")), pa.array(units, pa.binary()),
                 pa.array(nears, pa.binary())], ["cid", "first_id", "many", "unit", "near"])

    return cut_lineage(classes.select("cid", "first_id", "many", "vec").mapInArrow(
        run, "cid long, first_id long, many long, unit binary, near binary"))


def _angles(unit: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ other.T, -1, 1))


def crowded(described: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Members (cid, first_id, many, unit, near, e, angle) with the entry
    that each belongs to, and the centres (e, centre) of the crowds."""
    cells = described.withColumn("cell", F.hex(F.substring("near", 1, 4 * CELL)))
    many = cells.groupBy("cell").agg(F.count("*").alias("of")).where(F.col("of") >= CROWD)
    # Drawn by hash, so that a centre is the mean of about CENTRE vectors whatever the size of its cell.
    drawn = cells.join(many, "cell").where(f"pmod(xxhash64(cid), CAST(ceil(of / {CENTRE}) AS BIGINT)) = 0")

    def mean(rows: pd.DataFrame) -> pd.DataFrame:
        centre = np.frombuffer(b"".join(rows["unit"]), float).reshape(len(rows), -1).mean(axis=0)
        centre /= np.linalg.norm(centre)
        return pd.DataFrame({"cell": rows["cell"].iloc[:1], "centre": [centre.tobytes()]})

    centres = cut_lineage(drawn.select("cell", "unit").groupBy("cell").applyInPandas(mean, "cell string, centre binary"))
    reach = np.arccos(cosine) / 2 - MARGIN

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries, angles = [], []
            for cid, cell, unit, centre in zip(*(batch.column(c).to_pylist() for c in ("cid", "cell", "unit", "centre"))):
                angle = reach + 1 if centre is None else float(_angles(np.frombuffer(unit), np.frombuffer(centre)))
                entries.append(f"crowd {cell}" if angle <= reach else f"{cid}")
                angles.append(angle if angle <= reach else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("cid", "first_id", "many", "unit", "near")), pa.array(entries, pa.string()),
                 pa.array(angles, pa.float64())], ["cid", "first_id", "many", "unit", "near", "e", "angle"])

    members = cut_lineage(cells.join(centres, "cell", "left").mapInArrow(
        place, "cid long, first_id long, many long, unit binary, near binary, e string, angle double"))
    return members, centres.select(F.concat(F.lit("crowd "), "cell").alias("e"), "centre")


def entries_of(members: DataFrame, centres: DataFrame, pivots: dict[int, tuple[int, np.ndarray]]) -> DataFrame:
    """The index's entries, see ``ENTRY``: crowds, and the other vectors."""
    names = [c.split()[0] for c in ENTRY.split(", ")]
    is_crowd = F.col("e").startswith("crowd ")
    crowds = members.where(is_crowd).groupBy("e").agg(
        F.min("first_id").alias("first_id"), F.count("*").alias("n"), F.sum("many").alias("size"),
        (F.max("angle") + MARGIN).alias("radius")).join(centres, "e")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [_nearest(np.frombuffer(c, float)[None], pivots)[0].tobytes() for c in batch.column("unit").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.binary())], [*batch.schema.names, "near"])

    crowds = crowds.select("e", "first_id", "n", "size", "radius", F.col("centre").alias("unit")).mapInArrow(
        run, ENTRY.rsplit(", ", 1)[0])
    alone = members.where(~is_crowd).select(
        "e", "first_id", F.lit(1).cast("long").alias("n"), F.col("many").alias("size"), F.lit(0.0).alias("radius"), "unit", "near")
    every = crowds.unionByName(alone)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [np.frombuffer(x, np.int32) for x in batch.column("near").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.list_(pa.int32()))], names)

    return cut_lineage(every.mapInArrow(listed, ENTRY))


def _stars(rows: pd.DataFrame, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(links, root's position) of each row, for linked positions."""
    size = rows["size"].to_numpy()
    links = np.bincount(x, size[y], len(rows)) + np.bincount(y, size[x], len(rows))
    labels = np.arange(len(rows))
    merge_labels(labels, x, y)
    return links.astype(np.int64), labels


def _compare(order: dict[int, int], cosine: float):
    """Links between two blocks of one list (or within one), and the pairs
    of entries that have to be opened."""
    limit = np.arccos(cosine)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own, (i, j) = [int(p) for p in key[0].split()], (int(k) for k in key[1:])
        rows = rows.reset_index(drop=True)
        unit = np.frombuffer(b"".join(rows["unit"]), float).reshape(len(rows), -1)
        near = np.frombuffer(b"".join(rows["near"]), np.int32).reshape(len(rows), -1)
        place = np.vectorize(order.__getitem__)(near)
        used, column = np.unique(place, return_inverse=True)
        has = np.zeros((len(rows), len(used)), np.float32)
        np.put_along_axis(has, column.reshape(near.shape), 1.0, axis=1)
        block = rows["block"].to_numpy()
        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        shared = min(SHARED, near.shape[1])
        last = max(order[p] for p in own)  # the list's pivots are the first common ones
        until = used <= last
        retrieved = (has[a] @ has[b].T >= shared) & (has[a][:, until] @ has[b][:, until].T == len(own))
        if i == j:
            retrieved = np.triu(retrieved, 1)
        close = unit[a] @ unit[b].T
        reach = rows["radius"].to_numpy()
        reach = reach[a][:, None] + reach[b]
        angle = np.arccos(np.clip(close, -1, 1))
        linked = retrieved & np.where(reach == 0, close >= cosine, angle + reach <= limit - MARGIN)
        between = retrieved & ~linked & (reach > 0) & (angle - reach <= limit + MARGIN)
        x, y = np.nonzero(linked)
        links, root = _stars(rows, a[x], b[y])
        some = np.flatnonzero(links)
        x, y = np.nonzero(between)
        x, y = np.concatenate([some, a[x]]), np.concatenate([root[some], b[y]])
        of = lambda c, at: rows[c].to_numpy()[at]
        return pd.DataFrame({"a": of("e", x), "a_first": of("first_id", x), "a_n": of("n", x),
                             "b": of("e", y), "b_first": of("first_id", y), "b_n": of("n", y),
                             "links": np.concatenate([links[some], np.zeros(len(x) - len(some), np.int64)])})

    return run


FOUND = "a string, a_first long, a_n long, b string, b_first long, b_n long, links long"


def links(entries: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``FOUND``: a's links (as a whole) found in one comparison, and its
    star's root b there; or with 0 links a pair that has to be opened."""
    counts = {r["p"]: r["n"] for r in entries.select(F.explode("pivots").alias("p")).groupBy("p").agg(
        F.count("*").alias("n")).collect()}  # MOST_PIVOTS for each vector length
    order = {p: n for n, (_, p) in enumerate(sorted((n, p) for p, n in counts.items()))}
    m = 1 if sum(counts.values()) <= LONG * len(counts) else 2

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for near in batch.column("pivots").to_pylist():
                rare = sorted(near, key=order.__getitem__)
                depth = min(m, len(rare), SHARED)
                rare = rare[:len(rare) - min(SHARED, len(rare)) + depth]
                keys.append([" ".join(map(str, k)) for k in combinations(rare, depth)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.string()))],
                                             [*batch.schema.names, "lists"])

    names = ["e", "first_id", "n", "size", "radius", "unit", "near"]
    filed = entries.mapInArrow(file, ENTRY + ", lists array<string>").select(F.explode("lists").alias("list"), *names)
    lengths = filed.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    long = cut_lineage(lengths.where("blocks > 1"))
    filed = filed.join(long, "list", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    filed = filed.withColumn("block", F.expr("CAST(pmod(xxhash64(e), blocks) AS INT)"))
    filed = filed.withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
    filed = filed.select("list", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                         "block", *names)
    return filed.groupBy("list", "i", "j").applyInPandas(_compare(order, cosine), FOUND)


def opened(pairs: DataFrame, members: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(cid, links, a, a_first, b, b_first): links of single vectors
    between the entries a and b.  The larger entry's blocks are compared
    with all its partners' vectors, dealt out in parts."""
    ends = [F.struct(*[F.col(f"{c}{x}").alias(x or "e") for x in ("", "_first", "_n")]) for c in "ab"]
    pairs = pairs.select(F.when(F.col("a_n") >= F.col("b_n"), F.array(*ends)).otherwise(F.array(*ends[::-1])).alias("p"))
    pairs = cut_lineage(pairs.select(*[F.col("p")[n][x or "e"].alias(f"{c}{x}") for n, c in enumerate("ab")
                                       for x in ("", "_first", "_n")]).distinct())
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    large = cut_lineage(pairs.groupBy("a", "a_first").agg(
        blocks(F.max("a_n")).alias("blocks"), blocks(F.sum("b_n")).alias("parts")))
    vectors = members.select("e", "cid", F.col("many").alias("size"), "unit")
    dealt = lambda c: F.expr(f"CAST(pmod(xxhash64(e, cid), {c}) AS INT)")
    to_all = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = large.join(vectors, F.col("a") == F.col("e")).withColumn("i", dealt("blocks")).withColumn("j", to_all("parts"))
    own = own.withColumn("b_first", F.col("a_first"))
    partners = pairs.join(large.drop("a_first"), "a").join(vectors, F.col("b") == F.col("e"))
    partners = partners.withColumn("j", dealt("parts")).withColumn("i", to_all("blocks"))
    names = ["a", "a_first", F.col("e").alias("b"), "b_first", "i", "j", "cid", "size", "unit"]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.reset_index(drop=True)
        unit = np.frombuffer(b"".join(rows["unit"]), float).reshape(len(rows), -1)
        mine = (rows["a"] == rows["b"]).to_numpy()
        a, b = np.flatnonzero(mine), np.flatnonzero(~mine)
        linked = unit[a] @ unit[b].T >= cosine
        size = rows["size"].to_numpy()
        links = np.zeros(len(rows), np.int64)
        links[a], links[b] = linked @ size[b], size[a] @ linked
        rows["links"] = links
        return rows.loc[links > 0, ["cid", "links", "a", "a_first", "b", "b_first"]]

    return own.select(*names).unionByName(partners.select(*names)).groupBy("a", "i", "j").applyInPandas(
        run, "cid long, links long, a string, a_first long, b string, b_first long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    classes = distinct_vectors(vectors)
    pivots = choose_pivots(classes)
    members, centres = crowded(describe(classes, pivots), cosine)
    entries = entries_of(members, centres, pivots)
    found = cut_lineage(links(entries, cosine))
    inside = cut_lineage(opened(found.where("links = 0"), members, cosine))

    # Nodes order by their first id, so a component's root names it.
    node = lambda c: F.struct(F.col(f"{c}_first").alias("first_id"), F.col(c).alias("e"))
    ends = ["a", "a_first", "b", "b_first"]
    edges = found.where("links > 0").select(*ends).unionByName(inside.select(*ends)).where("a <> b")
    roots = component_members(edges.select(node("a").alias("a"), node("b").alias("b")))
    roots = roots.select(F.col("node.e").alias("e"), F.col("root.first_id").alias("root"))
    whole = found.where("links > 0").groupBy(F.col("a").alias("e")).agg(F.sum("links").alias("links"))
    known = entries.select("e", "first_id", "size").join(whole, "e", "left").join(roots, "e", "left").select(
        "e", (F.col("size") + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("root", "first_id").alias("component"))
    alone = inside.groupBy("cid").agg(F.sum("links").alias("more"))
    members = members.select("cid", "e").join(known, "e").join(alone, "cid", "left").select(
        "cid", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n"), "component")
    classes = classes.join(members, "cid").select("vec", "n", "component")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("row_vec"))
    own = F.col("vec_id").isNotNull()
    joined = rows.join(classes, (F.col("row_vec") == F.col("vec")) & own, "left")
    component = F.coalesce("component", "vec_id")
    return joined.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
