"""Billing tables derived from the driver's parquet tables.

The driver ships TPC-H-like tables; billing reports need customers,
plans, invoices, line items, sub-line items, usage events and nested API
records.  Each view below is a lazy DataFrame over the parquet scan, so
Catalyst still prunes columns and pushes filters into the reader.

Mapping (fixed values, the same in the DuckDB oracle SQL):

* customer:  id = c_custkey, name = c_name
* plan:      id = first character of o_orderpriority, name = text after
             the first ``-``
* invoice:   id = o_orderkey, customer_id = o_custkey, plan_id/plan_name
             from o_orderpriority, status F -> FINALIZED, O -> DRAFT,
             P -> VOID, issued_at = start_timestamp = end_timestamp =
             o_orderdate, total = o_totalprice in cents
* sub_line_item: one per lineitem row joined to its part: name and
             line_item name = p_type, billable_metric_name = p_brand,
             quantity = l_quantity, subtotal = l_extendedprice in cents,
             line_item_id = "<l_orderkey>:<p_type>"
* line_item: one per (l_orderkey, p_type), id as above, total = sum of
             subtotals, quantity = sum of quantities
* events:    customer_id = user_id, timestamp = ts, properties =
             ``{size=<event_type>, num=<k of props>}``
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.money import to_cents
from ledgerline.operators.joins import dimension

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the mapping.
STATUS_BY_CODE = {"F": "FINALIZED", "O": "DRAFT", "P": "VOID"}
PLAN_NAME_PATTERN = r"^[^-]*-(.*)$"
USD = ("USD", "USD (cents)")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def plan_id(priority: Column) -> Column:
    return F.substring(priority, 1, 1)


def plan_name(priority: Column) -> Column:
    return F.regexp_extract(priority, PLAN_NAME_PATTERN, 1)


def status_name(code: Column) -> Column:
    expr = None
    for k, v in STATUS_BY_CODE.items():
        expr = (F.when(code == k, v) if expr is None else expr.when(code == k, v))
    return expr


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


def plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct plans seen on orders (partial aggregate before the shuffle)."""
    o = read(spark, sf_dir, "orders")
    return (o.select(plan_id(F.col("o_orderpriority")).alias("id"),
                     plan_name(F.col("o_orderpriority")).alias("name"))
            .distinct())


def invoices(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """One per order; ``status`` keeps those of one status, by a predicate
    on the stored code, which reaches the parquet scan."""
    o = read(spark, sf_dir, "orders")
    if status is not None:
        o = o.where(F.col("o_orderstatus").isin([code for code, name in STATUS_BY_CODE.items() if name == status]))
    pr = F.col("o_orderpriority")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        plan_id(pr).alias("plan_id"),
        plan_name(pr).alias("plan_name"),
        status_name(F.col("o_orderstatus")).alias("status"),
        F.col("o_orderdate").alias("issued_at"),
        F.col("o_orderdate").alias("start_timestamp"),
        F.col("o_orderdate").alias("end_timestamp"),
        to_cents(F.col("o_totalprice")).alias("total"),
    )


def line_item_key(order_key: Column, line_name: Column) -> Column:
    return F.concat_ws(":", order_key.cast("string"), line_name)


def sub_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to part, a dimension whose size grows with the data:
    it is broadcast only while it has few rows."""
    li = read(spark, sf_dir, "lineitem")
    p = dimension(read(spark, sf_dir, "part"))
    j = li.join(p, li.l_partkey == p.p_partkey, "inner")
    return j.select(
        line_item_key(F.col("l_orderkey"), F.col("p_type")).alias("line_item_id"),
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").cast("string").alias("charge_id"),
        F.col("p_brand").alias("billable_metric_id"),
        F.col("p_brand").alias("billable_metric_name"),
        F.col("p_type").alias("line_item_name"),
        F.col("l_quantity").alias("quantity"),
        to_cents(F.col("l_extendedprice")).alias("subtotal"),
    )


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(sub_line_items(spark, sf_dir))


def lines_of(subs: DataFrame) -> DataFrame:
    """One line per (invoice, product type); sums are partial-aggregated."""
    return (subs.groupBy("invoice_id", F.col("line_item_name").alias("name"))
            .agg(F.sum("subtotal").alias("total"), F.sum("quantity").alias("quantity"))
            .select(line_item_key(F.col("invoice_id"), F.col("name")).alias("id"),
                    "invoice_id", F.col("name").alias("product_id"), "name", "total", "quantity"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    props = F.concat(F.lit("{size="), F.col("event_type"), F.lit(", num="),
                     F.get_json_object(F.col("props"), "$.k"), F.lit("}"))
    return e.select(
        F.col("event_id"),
        F.col("event_type"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("timestamp"),
        F.col("value"),
        props.alias("properties"),
    )


def billing_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customer": customers(spark, sf_dir),
        "plan": plans(spark, sf_dir),
        "invoice": invoices(spark, sf_dir),
        "line_item": line_items(spark, sf_dir),
        "sub_line_item": sub_line_items(spark, sf_dir),
        "events": events(spark, sf_dir),
    }


VIEW_BUILDERS = {"customer": customers, "plan": plans, "invoice": invoices, "line_item": line_items,
                 "sub_line_item": sub_line_items, "events": events}


def register_billing_views(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> list[str]:
    """Register billing views (all, or ``names``) as temp views for SQL
    users, together with the SQL functions (``kv_get``, ...)."""
    from ledgerline.functions.sql_functions import register_sql_functions
    register_sql_functions(spark)
    wanted = names or list(VIEW_BUILDERS)
    for name in wanted:
        VIEW_BUILDERS[name](spark, sf_dir).createOrReplaceTempView(name)
    return sorted(wanted)
