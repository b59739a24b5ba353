"""Join helpers with explicit semantics.

Join strategy is left to Spark: a side is broadcast only when its
estimated or AQE-measured size is under ``autoBroadcastJoinThreshold``;
beyond it Spark shuffles both sides (sort-merge), and AQE splits skewed
partitions of the large side.  Nothing here is hinted, apart from
``dimension``: Spark's estimate of a table is the bytes of its files,
which hold many times as much in memory.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType


def merge_left_suffix(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                      suffixes: tuple[str, str] = ("_x", "_y"), null_safe: bool = False) -> DataFrame:
    """Left join that names columns like a dataframe ``merge``.

    Columns present on both sides get ``suffixes``; when ``left_on`` and
    ``right_on`` are the same name the key appears once (the left one,
    which a left join always keeps).  ``null_safe`` makes a null key
    match a null key (``<=>``), the way an in-memory dataframe merge
    pairs missing keys: n and m null keys give n x m rows, as there.  The
    join is skew-safe on the right side (see :func:`left_join_skew_safe`).
    """
    same_key = left_on == right_on
    shared = set(left.columns) & set(right.columns)
    if same_key:
        shared.discard(left_on)
    lsel = [F.col(c).alias(c + suffixes[0] if c in shared else c) for c in left.columns]
    rsel = [F.col(c).alias(c + suffixes[1] if c in shared else c)
            for c in right.columns if not (same_key and c == right_on)]
    lkey, rkey = unused(["__lk", "__rk"], [*left.columns, *right.columns])
    l2 = left.select(*lsel, F.col(left_on).alias(lkey))
    r2 = right.select(*rsel, F.col(right_on).alias(rkey))
    return left_join_skew_safe(l2, r2, lkey, rkey, null_safe=null_safe).drop(lkey, rkey)


def lookup_last_wins(names: DataFrame, name_col: str, value_col: str, order_col: str) -> DataFrame:
    """Name -> value table where a repeated name keeps its *last* value
    (largest ``order_col``), like building a dict from a list.

    The dedupe is an aggregate (``max_by``), combined map-side before
    the shuffle; the result has one row per name and is safe to join.
    """
    return (names.groupBy(name_col)
            .agg(F.max_by(F.col(value_col), F.col(order_col)).alias(value_col)))


def semi_reduce(big: DataFrame, big_key: str, small: DataFrame, small_key: str) -> DataFrame:
    """Keep only rows of ``big`` whose key occurs in ``small``.

    Used before a left outer join whose preserved (left) side is small:
    such a join cannot broadcast its left side, so without this the whole
    big side is shuffled.  Spark chooses the semi join's strategy by the
    size of the keys, from its estimate or at run time.  Rows of ``big``
    without a match could not have joined, so the outer join's result is
    unchanged.
    """
    keys = (small.select(F.col(small_key).alias("__semi_key")).where(F.col("__semi_key").isNotNull())
            .distinct())
    return big.join(keys, big[big_key] == keys["__semi_key"], "left_semi")


# A table with more rows than this is no small side, however small its files.
MOST_BROADCAST_ROWS = 250_000


def dimension(df: DataFrame, most_rows: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """A table as read, to be joined whole to another one.

    Spark estimates it by its compressed files: 30 MB of keys and few
    different texts are seven million rows, and more than half a gigabyte
    on the driver that broadcasts them.  So its rows are counted (parquet
    keeps the number beside the data), and a table of many is joined by
    sorting both sides, which AQE can split where a key is hot.
    """
    return df if df.count() <= most_rows else df.hint("merge")


# Sizes of the frequent-items sketch: keys it reports, keys it tracks.
MOST_HOT, TRACKED = 100, 10_000
# A key is hot above this many fair shares of a shuffle partition.
HOT_SHARES = 2
# Below this many rows a partition needs no help.
HOT_ROWS = 100_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> tuple[list, int]:
    """(values, parts): the keys of ``df`` with more rows than
    ``HOT_SHARES`` shuffle partitions should hold (null is a key), and
    into how many parts the hottest is to be cut.

    A frequent-items sketch: mergeable, one pass over the key column, at
    most ``MOST_HOT`` values back.  A key that holds more than about
    1/3,000 of the rows cannot escape it.
    """
    kind = df.schema[key].dataType
    if not isinstance(kind, (NumericType, StringType, BooleanType, DateType, TimestampType, TimestampNTZType)):
        return [], 1
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = df.select(F.col(key).alias("k")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(k, {MOST_HOT}, {TRACKED})").alias("top")).first()
    fair = max(found["n"] / partitions, 1)
    hot = [r for r in found["top"] or [] if r["count"] > max(HOT_SHARES * fair, hot_rows)]
    return [r["item"] for r in hot], min(partitions, max([1, *(math.ceil(r["count"] / fair) for r in hot)]))


def left_join_skew_safe(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                        null_safe: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``left LEFT JOIN right`` that stays balanced when one right-side
    key holds a large share of the rows.

    A left outer join can only split skewed partitions of its left side.
    Here the hot keys of the right side are found by a sketch of its key
    column (:func:`hot_keys`).  Their right rows are dealt into parts and
    their left rows, of which a lookup side has few, are copied to each
    part; all other rows stay as they are.  It is one join, in which the
    right side is read once.  A hot key has right rows, so copies of a
    left row that meet none in their part are dropped, not null-extended.
    """
    hot, parts = hot_keys(right, right_key, hot_rows)
    hot = [k for k in hot if null_safe or k is not None]

    def same(lk, rk):
        return lk.eqNullSafe(rk) if null_safe else lk == rk

    if not hot:
        return left.join(right, same(left[left_key], right[right_key]), "left")
    part, met, copied = unused(["__part", "__met", "__copied"], left.columns + right.columns)
    rpart = unused([part + "_r"], left.columns + right.columns)[0]

    def is_hot(key):
        known = [k for k in hot if k is not None]
        found = F.coalesce(key.isin(known), F.lit(False)) if known else F.lit(False)
        return found | key.isNull() if None in hot else found

    dealt = right.withColumn(rpart, F.when(is_hot(F.col(right_key)), F.monotonically_increasing_id() % parts).otherwise(0)) \
        .withColumn(met, F.lit(True))
    copies = left.withColumn(copied, is_hot(F.col(left_key))).withColumn(
        part, F.explode(F.sequence(F.lit(0), F.when(F.col(copied), parts - 1).otherwise(0))))
    joined = copies.join(dealt, same(copies[left_key], dealt[right_key]) & (copies[part] == dealt[rpart]), "left")
    return joined.where(F.col(met).isNotNull() | ~F.col(copied)).drop(part, rpart, met, copied)


def unused(names: list[str], taken: list[str]) -> list[str]:
    """Names like ``names`` that no column has."""
    used = {t.lower() for t in taken}
    out = []
    for n in names:
        while n in used:
            n += "_"
        used.add(n)
        out.append(n)
    return out
