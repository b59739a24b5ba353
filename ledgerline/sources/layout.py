"""Co-located billing tables: invoices, lines and sub lines bucketed and
sorted by invoice, so that the line reports join them where they lie.

``land_colocated`` writes each table in the same number of buckets of the
invoice's id, one sorted file a bucket.  A join on the invoice, or on the
invoice and the line, then reads matching buckets side by side: no
exchange and no sort, and a group-by that contains the invoice has none
either.

A bucket cannot be split at run time, so invoices with very many rows
(found by the frequent-items sketch of ``operators.joins``) are kept out
of the buckets, as are rows without an invoice.  Such rows lie in plain
tables beside them and take the ordinary join, which AQE can split;
``invoice_chain`` adds both results.

The number of buckets grows with the rows, so that a task can sort one in
memory.  A table that is grouped from another by the invoice, as lines
are from sub lines, is made from the other's written buckets: grouped
where they lie, without an exchange.

Two session settings are needed that would change other plans.  They are
set in a session of the reader's own (same application, same catalog), so
the caller's stay as they are.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.joins import HOT_ROWS, hot_keys
from ledgerline.session import apply_defaults
from ledgerline.sources import driver_tables as dt
from ledgerline.sources.api_records import landing_path
from ledgerline.sources.sinks import publish

# Of each table: the invoice's id, then the further sort columns.
CLUSTERED_BY = {"invoice": ("id",), "line_item": ("invoice_id", "id"), "sub_line_item": ("invoice_id", "line_item_id")}
ROWS_IN_BUCKET = 1_000_000
# Tables partitioned by the invoice alone may be joined on (invoice, line);
# a bucket of one file is read in its order.
CO_LOCATION = {"spark.sql.requireAllClusterKeysForCoPartition": "false",
               "spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}


@dataclass
class CoLocated:
    """The bucketed tables, and the rows kept out of them (None where
    there are none)."""
    tables: dict[str, DataFrame]
    rest: dict[str, DataFrame] | None


def colocated_session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings and those of co-location."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    apply_defaults(own)
    for key, value in CO_LOCATION.items():
        own.conf.set(key, value)
    return own


def write_colocated(spark: SparkSession, to: str, tables: dict[str, DataFrame], buckets: int,
                    hot_rows: int = HOT_ROWS, counted: dict[str, DataFrame] | None = None,
                    derived: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] | None = None) -> None:
    """Writes the tables of ``CLUSTERED_BY`` under the folder ``to``.

    ``counted``: for a table that is costly to make, one with at least its
    ids, to look for hot ones in.  ``derived``: a table as (the name of
    the one it is grouped from by the invoice, how); a key that is hot in
    it is hot in that one."""
    # At most joins.MOST_HOT ids a table.
    hot = sorted({k for name, df in {**tables, **(counted or {})}.items()
                  for k in hot_keys(df, CLUSTERED_BY[name][0], hot_rows)[0] if k is not None})
    entries = {name: f"ledgerline_build_{name}_{uuid.uuid4().hex}" for name in CLUSTERED_BY}
    left_out = False

    def write(name: str, in_buckets: DataFrame, kept_out: DataFrame) -> None:
        nonlocal left_out
        key, *further = CLUSTERED_BY[name]
        (in_buckets.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key, *further)
         .option("path", f"{to}/{name}").format("parquet").saveAsTable(entries[name]))
        kept_out.write.parquet(f"{to}/rest_{name}")
        left_out = left_out or not spark.read.parquet(f"{to}/rest_{name}").isEmpty()

    for name, df in tables.items():
        key = CLUSTERED_BY[name][0]
        kept_out = F.col(key).isNull() | F.col(key).isin(hot)
        write(name, df.where(~kept_out), df.where(kept_out))
    for name, (source, make) in (derived or {}).items():
        write(name, make(spark.table(entries[source])), make(spark.read.parquet(f"{to}/rest_{source}")))
    for name in {**tables, **(derived or {})}:
        spark.sql(f"DROP TABLE {entries[name]}")  # the catalog's entry; the files stay
    spark.createDataFrame([(buckets, left_out)], "buckets int, rest boolean").coalesce(1).write.parquet(f"{to}/layout")


def read_colocated(spark: SparkSession, folder: str) -> CoLocated:
    """The tables that ``write_colocated`` wrote, in a session of their own."""
    own = colocated_session(spark)
    layout = own.read.parquet(f"{folder}/layout").first()
    mark = hashlib.sha1(folder.encode()).hexdigest()[:16]
    tables, rest = {}, {}
    for name, columns in CLUSTERED_BY.items():
        rest[name] = own.read.parquet(f"{folder}/rest_{name}")
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest[name].schema)
        place = f"{folder}/{name}".replace("'", "\\'")
        own.sql(f"CREATE TABLE IF NOT EXISTS ledgerline_{name}_{mark} ({fields}) USING parquet "
                f"CLUSTERED BY ({columns[0]}) SORTED BY ({', '.join(columns)}) INTO {layout['buckets']} BUCKETS "
                f"LOCATION '{place}'")
        tables[name] = own.table(f"ledgerline_{name}_{mark}")
    return CoLocated(tables, rest if layout["rest"] else None)


def landed_billing(spark: SparkSession, sf_dir: str) -> CoLocated:
    """The billing tables of ``sf_dir``, landed once."""
    def build(to: str) -> None:
        rows = dt.read(spark, sf_dir, "lineitem")
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / ROWS_IN_BUCKET))
        tables = {"invoice": dt.invoices(spark, sf_dir), "sub_line_item": dt.sub_line_items(spark, sf_dir)}
        write_colocated(spark, to, tables, buckets, derived={"line_item": ("sub_line_item", dt.lines_of)},
                        counted={"sub_line_item": rows.select(F.col("l_orderkey").alias("invoice_id"))})
    return read_colocated(spark, publish(spark, landing_path(spark, sf_dir, "colocated"), build))


def _everywhere(landed: CoLocated, join: Callable[[dict[str, DataFrame]], DataFrame]) -> DataFrame:
    joined = join(landed.tables)
    return joined if landed.rest is None else joined.unionByName(join(landed.rest))


def lines_with_subs(landed: CoLocated, how: str = "left") -> DataFrame:
    """Lines beside their sub lines, as columns ``line`` and ``sub``."""
    def join(t):
        l, s = t["line_item"], t["sub_line_item"]
        on = (l["invoice_id"] == s["invoice_id"]) & (l["id"] == s["line_item_id"])
        return l.join(s, on, how).select(F.struct(l["*"]).alias("line"), F.struct(s["*"]).alias("sub"))
    return _everywhere(landed, join)


def invoice_chain(landed: CoLocated) -> DataFrame:
    """Every invoice with its lines and their sub lines (left joins):
    invoice_id, customer_id, line_item_id, line_item_name,
    billable_metric_name, quantity, subtotal.

    Lines and sub lines are joined first: their order, by invoice and
    line, is then also the one in which the invoices are read.
    """
    def join(t):
        i = t["invoice"].select(F.col("id").alias("invoice_id"), "customer_id")
        l = t["line_item"].select(F.col("invoice_id").alias("l_invoice_id"), F.col("id").alias("line_item_id"),
                                  F.col("name").alias("line_item_name"))
        s = t["sub_line_item"].select(F.col("invoice_id").alias("s_invoice_id"), F.col("line_item_id").alias("s_line_item_id"),
                                      "billable_metric_name", "quantity", "subtotal")
        both = l.join(s, (F.col("l_invoice_id") == F.col("s_invoice_id")) & (F.col("line_item_id") == F.col("s_line_item_id")),
                      "left")
        return i.join(both, F.col("invoice_id") == F.col("l_invoice_id"), "left").select(
            "invoice_id", "customer_id", "line_item_id", "line_item_name", "billable_metric_name", "quantity", "subtotal")
    return _everywhere(landed, join)


def lines_of_invoices(landed: CoLocated) -> DataFrame:
    """The line report of every invoice: per invoice, line and metric the
    quantity and the largest and summed money, in cents."""
    return (invoice_chain(landed).groupBy("invoice_id", "line_item_name", "billable_metric_name")
            .agg(F.sum("quantity").alias("quantity"), F.max("subtotal").alias("max_cents"), F.sum("subtotal").alias("sum_cents")))
