"""Ranking operators.

``latest_per_key`` answers "the newest row per key" with an aggregate
(``max_by`` over the ordering columns) instead of
``row_number() ... = 1``.  The aggregate is combined map-side, so a key
holding a third of all rows is reduced before the shuffle and never
lands whole in one task.  The result equals ``row_number() = 1`` with
the same ordering whenever the ordering is total (add a unique column
as the last tie-breaker, as the callers here do).

``with_row_number`` is the plain window function for callers that need
every row's rank.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, ShortType, TimestampNTZType, TimestampType)


def _as_list(x) -> list:
    return list(x) if isinstance(x, (list, tuple)) else [x]


# Digits that an ordering column takes in a packed ordering.
DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20, BooleanType: 1, DateType: 7,
          TimestampType: 18, TimestampNTZType: 18}
MOST_DIGITS = 38
# Types whose aggregation buffer has a fixed width.
FIXED = (*DIGITS, FloatType, DoubleType, DecimalType)


def _from_one(column: str, kind: DataType) -> Column:
    """An integer from 1 that orders like the column; null is 0."""
    c = F.col(f"`{column}`")
    if isinstance(kind, BooleanType):
        number = c.cast("int") + 1
    elif isinstance(kind, DateType):
        number = F.unix_date(c) + 719_163       # days since 0001-01-01, from 1
    elif isinstance(kind, (TimestampType, TimestampNTZType)):
        # By its parts where it has no zone: the session's zone must not bend the order.
        micros = F.unix_micros(c) if isinstance(kind, TimestampType) else (
            (F.unix_date(c.cast("date")).cast("long") * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60) * 1_000_000
            + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long"))
        number = micros + 62_135_683_200_000_000   # since the day before 0001-01-01, whatever the zone
    else:
        least = {ByteType: -(1 << 7), ShortType: -(1 << 15), IntegerType: -(1 << 31), LongType: -(1 << 63)}[type(kind)]
        number = c.cast("decimal(20,0)") + F.lit(Decimal(1 - least)).cast("decimal(20,0)")
    return F.coalesce(number.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))


def packed_ordering(df: DataFrame, order_by: list[str]) -> Column | None:
    """One decimal that orders like the tuple of columns (nulls least), or
    None if their types or number don't allow it."""
    kinds = [df.schema[c].dataType for c in order_by]
    if not all(type(k) in DIGITS for k in kinds) or sum(DIGITS[type(k)] for k in kinds) > MOST_DIGITS:
        return None
    packed = None
    for c, kind in zip(order_by, kinds):
        part = _from_one(c, kind)
        scale = F.lit(Decimal(10 ** DIGITS[type(kind)])).cast(f"decimal({DIGITS[type(kind)] + 1},0)")
        packed = part if packed is None else (packed * scale).cast("decimal(38,0)") + part
    return packed.cast("decimal(38,0)")


def latest_per_key(df: DataFrame, keys, order_by, descending: bool = True) -> DataFrame:
    """One row per ``keys``: the row with the greatest (or least when
    ``descending=False``) ``order_by`` tuple.

    Rows whose ordering columns are all null lose to any non-null row,
    as a descending ``ROW_NUMBER`` with nulls last would have it.

    The ordering must be total among different rows of a key.  Ordering
    columns of integer, date or timestamp type are packed into one decimal
    (:func:`packed_ordering`); with payload of fixed width every buffer is
    fixed too, and Spark aggregates by hash instead of by sort.  Other
    orderings and payloads are compared as structs.
    """
    keys = _as_list(keys)
    order_by = _as_list(order_by)
    payload = [c for c in df.columns if c not in keys]
    pick = F.max_by if descending else F.min_by
    packed = packed_ordering(df, order_by)
    if packed is not None and all(isinstance(df.schema[c].dataType, FIXED) for c in payload):
        return df.groupBy(*keys).agg(*[pick(F.col(f"`{c}`"), packed).alias(c) for c in payload])
    ordering = F.struct(*[F.col(c) for c in order_by])
    row = F.struct(*[F.col(c) for c in payload])
    return (df.groupBy(*keys).agg(pick(row, ordering).alias("__row"))
            .select(*keys, *[F.col("__row")[c].alias(c) for c in payload]))


def with_row_number(df: DataFrame, partition_by, order_by: list[Column], name: str = "rn") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY .. ORDER BY ..)`` as a column."""
    w = Window.partitionBy(*_as_list(partition_by)).orderBy(*order_by)
    return df.withColumn(name, F.row_number().over(w))


def top1_by_window(df: DataFrame, partition_by, order_by: list[Column]) -> DataFrame:
    """``row_number`` then ``rn = 1`` (Spark inserts a partial
    ``WindowGroupLimit`` below the shuffle for this shape)."""
    return with_row_number(df, partition_by, order_by, "__rn").where(F.col("__rn") == 1).drop("__rn")


def row_number_skew_safe(df: DataFrame, partition_by, order_by: list[Column], name: str = "rn",
                         num_partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ..)`` that stays
    balanced when one key holds a large share of the rows.

    A plain window sends each key to one task.  Here the rows are
    range-partitioned on (keys, ordering, random tie-breaker), so the
    sampler cuts a hot key's rows into several partitions; each row gets
    its partition and its place there.  Rows are numbered within
    (partition, key), which is never more than one partition's rows, and
    a key that goes on from earlier partitions adds its rows there.  Such
    continuations are at most one per partition boundary, so their table
    is broadcast (a proven bound).  The placed rows are checkpointed to
    the shared folder, as both passes must see the same partitioning.

    All of it is Spark's own operators: payloads of any type pass
    through unchanged, and null and NaN keys are keys as in the plain
    window.  Select the columns you need first; all of ``df`` is
    shuffled.
    """
    from ledgerline.session import checkpoint_dir

    keys = _as_list(partition_by)
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(k).asc_nulls_first() for k in keys] + list(order_by) + [F.col("__t").asc()]
    placed = (df.withColumn("__t", F.rand(11))
              .repartitionByRange(n, *sort).sortWithinPartitions(*sort)
              .select(*df.columns, F.spark_partition_id().alias("__pid"),
                      F.monotonically_increasing_id().alias("__place"))
              .checkpoint(eager=True))

    earlier = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    before = (placed.groupBy("__pid", *keys).agg(F.count("*").alias("n"))
              .withColumn("__before", F.sum("n").over(earlier)).where(F.col("__before").isNotNull())
              .select(F.col("__pid").alias("__at"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                      "__before"))
    same = F.col("__pid") == F.col("__at")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    here = F.row_number().over(Window.partitionBy("__pid", *keys).orderBy("__place"))
    numbered = placed.withColumn("__here", here).join(F.broadcast(before), same, "left")
    rn = (F.col("__here") + F.coalesce("__before", F.lit(0))).cast("long").alias(name)
    return numbered.select(*df.columns, rn)
