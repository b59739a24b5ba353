"""Aggregates with explicit semantics.

All of these are algebraic (sum/count/min/max/avg/stddev), so Spark
runs a partial aggregate before the shuffle and a hot key is combined
map-side.  The one order statistic, exact quantiles for
``describe_numeric``, is narrowed down by counting passes of the same
kind, never by sorting a column or gathering it into one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

QUANTILES = (0.25, 0.5, 0.75)
ACCURACY = 100_000  # of the sketches that narrow down exact quantiles
GATHERED = 10_000   # values at most that their last step sorts in one buffer


def slice_totals(invoices: DataFrame, by: list[str], value: str | tuple[str, ...] = "total",
                 customer_name: str | None = None, keep_null_keys: bool = False,
                 name_col: str = "customer_name") -> DataFrame:
    """Sum of ``value`` (or of each of several) per ``customer_name`` plus
    caller-chosen columns.

    ``customer_name`` given as a string adds it as a constant column
    (one customer's invoices); otherwise the frame must carry
    ``name_col``.  Rows with a null grouping key are dropped, as a
    dataframe ``groupby`` does, unless ``keep_null_keys``.  Output is
    sorted by the keys.
    """
    df = invoices
    if customer_name is not None:
        df = df.withColumn(name_col, F.lit(customer_name))
    keys = [name_col] + [c for c in by if c != name_col]
    if not keep_null_keys:
        df = df.dropna(subset=keys)
    values = [value] if isinstance(value, str) else value
    return (df.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
            .orderBy(*[F.col(k).asc_nulls_last() for k in keys]))


def count_unique_with_null(df: DataFrame, column: str, alias: str = "n_unique") -> DataFrame:
    """Distinct values of ``column`` where null counts as one value."""
    c = F.col(column)
    has_null = F.coalesce(F.max(F.when(c.isNull(), 1).otherwise(0)), F.lit(0))
    return df.agg((F.countDistinct(c) + has_null).cast("bigint").alias(alias))



def _exact_quantiles(df: DataFrame, counts: dict[str, int], probs) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles of all columns together.

    Each wanted rank lies in an open interval of values, at first all of
    them.  A round takes two cut points around every rank from a mergeable
    sketch, then counts exactly what lies below and at them: the rank is
    at a cut point, or in one of the intervals these leave, which hold a
    small share of the rows.  Intervals of ``GATHERED`` rows or fewer are
    sorted in one buffer.  All of it is partial aggregates: no row is
    shuffled, a value that holds a large share of the rows costs no more
    than others, and the driver gets a few numbers for each rank.
    """
    found: dict[tuple[str, int], float] = {}
    # (column, rank) -> lower and upper bound (None: open), rows below, rows inside
    open_ranks: dict[tuple[str, int], tuple] = {}
    for c, n in counts.items():
        for q in probs if n else ():
            for rank in (math.floor(q * (n - 1)), math.ceil(q * (n - 1))):
                open_ranks[c, rank] = (None, None, 0, n)
    while open_ranks:
        tasks = list(open_ranks.items())
        aggs = []
        for k, ((c, rank), (lo, hi, below, inside)) in enumerate(tasks):
            x = F.col(f"`{c}`").cast("double")
            within = x.isNotNull()
            if lo is not None:
                within = within & (x > lo)
            if hi is not None:
                within = within & (x < hi)
            x = F.when(within, x)
            if inside <= GATHERED:
                aggs.append(F.get(F.sort_array(F.collect_list(x)), rank - below).alias(f"v{k}"))
            else:
                p = (rank - below + 0.5) / inside
                aggs.append(F.percentile_approx(x, [max(p - 2 / ACCURACY, 0.0), min(p + 2 / ACCURACY, 1.0)],
                                                ACCURACY).alias(f"v{k}"))
        values = df.agg(*aggs).first()
        cuts = {}
        for k, (key, state) in enumerate(tasks):
            if state[3] <= GATHERED:
                found[key] = values[k]
                del open_ranks[key]
            else:
                cuts[key] = values[k]
        if not cuts:
            continue
        aggs = []
        for (c, _), points in cuts.items():
            x = F.col(f"`{c}`").cast("double")
            aggs += [F.count_if(test) for v in points for test in (x < v, x <= v)]
        seen = list(df.agg(*aggs).first())
        for k, ((c, rank), (a, b)) in enumerate(cuts.items()):
            under_a, upto_a, under_b, upto_b = seen[4 * k:4 * k + 4]
            lo, hi, below, inside = open_ranks.pop((c, rank))
            if under_a <= rank < upto_a:
                found[c, rank] = a
            elif under_b <= rank < upto_b:
                found[c, rank] = b
            elif rank < under_a:
                open_ranks[c, rank] = (lo, a, below, under_a - below)
            elif rank < under_b:
                open_ranks[c, rank] = (a, b, upto_a, under_b - upto_a)
            else:
                open_ranks[c, rank] = (b, hi, upto_b, below + inside - upto_b)

    def at(c: str, n: int, q: float) -> float | None:
        if not n:
            return None
        pos = q * (n - 1)
        a, b = found[c, math.floor(pos)], found[c, math.ceil(pos)]
        return a + (b - a) * (pos - math.floor(pos)) if a != b else a

    return {c: [at(c, n, q) for q in probs] for c, n in counts.items()}


def describe_numeric(df: DataFrame, columns: list[str],
                     exact: bool = True, accuracy: int = ACCURACY) -> DataFrame:
    """count, mean, std, min, 25/50/75 % and max per column, one row per
    column.

    Quantiles interpolate linearly between the two nearest ranks.
    ``exact=False`` uses ``percentile_approx`` (one pass, bounded memory
    per task) for callers who accept an approximation.  The last bits of
    ``mean`` and ``std`` depend on summation order.
    """
    spark: SparkSession = df.sparkSession
    aggs = []
    for c in columns:
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
        if not exact:
            aggs.append(F.percentile_approx(x, list(QUANTILES), accuracy).alias(f"{c}__q"))
    row = df.agg(*aggs).collect()[0]
    quantiles = _exact_quantiles(df, {c: row[f"{c}__count"] for c in columns}, QUANTILES) if exact else {}
    rows = []
    for c in columns:
        qs = quantiles[c] if exact else list(row[f"{c}__q"] or [None] * 3)
        rows.append((c, row[f"{c}__count"], row[f"{c}__mean"], row[f"{c}__std"], row[f"{c}__min"],
                     qs[0], qs[1], qs[2], row[f"{c}__max"]))
    schema = StructType([StructField("column", StringType()), StructField("count", LongType())] +
                        [StructField(n, DoubleType()) for n in
                         ("mean", "std", "min", "p25", "p50", "p75", "max")])
    return spark.createDataFrame(rows, schema)


# Size parameter of the quantile sketches.
SKETCH_K = 2_000


def sketch_rank_error(k: int = SKETCH_K) -> float:
    """By how much (as a share of the rows) the rank of a sketch's
    quantile can be off, with 99 % confidence, merged or not."""
    return 2.296 / k ** 0.9021


def quantile_sketches(df: DataFrame, columns: list[str], by: list[str] | None = None, k: int = SKETCH_K) -> DataFrame:
    """(``by``, column, n, min, max, sketch): one pass that can be stored
    for each landed part and merged at report time.  Nulls are left out."""
    by = by or []
    x = {c: F.col(f"`{c}`").cast("double") for c in columns}
    found = df.groupBy(*by).agg(*[F.struct(
        F.lit(c).alias("column"), F.count(x[c]).alias("n"), F.min(x[c]).alias("min"), F.max(x[c]).alias("max"),
        F.kll_sketch_agg_double(x[c], k).alias("sketch")).alias(f"s{i}") for i, c in enumerate(columns)])
    return found.select(*by, F.explode(F.array(*[f"s{i}" for i in range(len(columns))])).alias("s")).select(*by, "s.*")


def merge_sketches(sketches: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One row a column from the sketches of any number of parts."""
    return sketches.where("n > 0").groupBy("column").agg(
        F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketched_quantiles(merged: DataFrame, probs: tuple[float, ...] = QUANTILES) -> DataFrame:
    """(column, n, min, max, p, quantile): a value of the column whose rank
    is within :func:`sketch_rank_error` of ``p``."""
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias("quantile"))
                               for p in probs])).alias("q")
    return merged.select("column", "n", "min", "max", each).select("column", "n", "min", "max", "q.p", "q.quantile")
