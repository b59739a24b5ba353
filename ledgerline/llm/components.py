"""Connected components of a link table, and links within one block."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import cut_lineage


def merge_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the linked positions ``i`` and ``j`` in place: afterwards
    each label is the smallest position of its set so far."""
    while len(i):
        a, b = labels[i], labels[j]
        differ = a != b
        if not differ.any():
            return
        a, b, i, j = a[differ], b[differ], i[differ], j[differ]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels[:] = jumped


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b); the root is the
    smallest node of the component."""
    members = component_members(edges)
    roots = members.select(F.col("root").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return members.unionByName(roots)


def component_members(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b) that is not itself
    the smallest node of its component, the root.

    Alternates the large-star and small-star steps (every node's larger,
    then smaller, neighbours are linked to its smallest one) until the
    edges stay as they are: a logarithmic number of rounds, each linear
    in the edges.  Minima are aggregated before the shuffle, and written
    to the shared checkpoint folder before the join, so that Spark can
    split a hub's partition.  Rows with a null end are no links.
    """

    def to_minimum(edges: DataFrame) -> DataFrame:
        """Edges (u, v) with the smallest of v and u for each u."""
        least = cut_lineage(edges.groupBy("u").agg(F.min("v").alias("m")))
        return edges.join(least, "u").withColumn("m", F.least("m", "u"))

    def state(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()

    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = cut_lineage(pairs.where(F.col("u") > F.col("v")).distinct())
    before = state(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = to_minimum(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut_lineage(large.where(F.col("u") > F.col("v")).distinct())
        small = to_minimum(large)
        small = small.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        small = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
        pairs = cut_lineage(small.where(F.col("u") > F.col("v")).distinct())
        after = state(pairs)
        if after == before:
            break
        before = after
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
