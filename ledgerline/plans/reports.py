"""Billing reports as DataFrame plans.

Every report is lazy: it returns a DataFrame and leaves the action to
the caller.  Aggregation happens before joins wherever the join key is
part of the grouping (usage per customer, billings per customer and
plan, credits per customer), so joins see one row per key instead of
one row per event or invoice, and every aggregate is algebraic (partial
aggregation before the shuffle, safe under key skew).

Money stays integer cents until the display column; each display
string has a numeric column beside it (``*_cents``, or ``*_amount`` =
cents / 100 where the value can be missing).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.common import ts_literal
from ledgerline.functions.money import (cents_to_units, divide_safe, format_money, round_2,
                                        to_cents)
from ledgerline.functions.parsing import json_array_first, kv_get
from ledgerline.operators.aggregates import slice_totals  # noqa: F401  (re-exported)
from ledgerline.operators.filters import finalized_positive, ts_range
from ledgerline.operators.joins import left_join_skew_safe, semi_reduce
from ledgerline.operators.nested import Shape, flat_columns, flatten_shape
from ledgerline.operators.windows import latest_per_key


def customer_statement(customers: DataFrame, invoices: DataFrame, grants: DataFrame,
                       status: str = "FINALIZED", suffix: str = " USD",
                       legacy_null_concat: bool = False) -> DataFrame:
    """Current invoice balance and credit balance per customer.

    * current invoice: the newest ``status`` invoice by ``end_timestamp``
      (ties broken by the larger invoice ``id``), its total in cents;
    * credit balance: over grants with a balance, the ``running_balance``
      of each grant's *first* deduction, summed per customer;
    * every customer is kept (left joins); sorted by name, nulls last.
    """
    fin = invoices.where(F.col("status") == status).select("customer_id", "id", "end_timestamp", "total")
    latest = latest_per_key(fin, "customer_id", ["end_timestamp", "id"])
    inv = latest.select(F.col("customer_id").alias("inv_customer_id"), F.lit(1).cast("bigint").alias("total_invoices"),
                        F.col("total").cast("bigint").alias("current_invoice_cents"))
    first_running = json_array_first("deductions", "running_balance")
    credits = (grants.where(F.col("balance").isNotNull())
               .select(F.col("customer_id").alias("cr_customer_id"), first_running.alias("running_balance"))
               .groupBy("cr_customer_id")
               # Decimal cents: a sum of doubles would depend on the order of the grants.
               .agg(F.sum(F.col("running_balance").cast("decimal(28,6)")).alias("credit_sum")))
    credits = credits.select("cr_customer_id", F.round("credit_sum", 0).cast("bigint").alias("credit_balance_cents"))
    j = (customers.select(F.col("id"), F.col("name"))
         .join(inv, F.col("id") == F.col("inv_customer_id"), "left")
         .join(credits, F.col("id") == F.col("cr_customer_id"), "left"))
    # The customer id breaks ties between equal names, so a name shared
    # by many customers can still be split across sort partitions.
    return (j.orderBy(F.col("name").asc_nulls_last(), F.col("id").asc_nulls_last())
            .select(
                "name",
                format_money(F.col("current_invoice_cents"), suffix=suffix,
                             legacy_null_concat=legacy_null_concat).alias("current_invoice_balance"),
                format_money(F.col("credit_balance_cents"), suffix=suffix,
                             legacy_null_concat=legacy_null_concat).alias("credit_balance"),
                cents_to_units(F.col("current_invoice_cents")).alias("current_invoice_amount"),
                cents_to_units(F.col("credit_balance_cents")).alias("credit_balance_amount")))


def usage_by_attribute(events: DataFrame, customers: DataFrame, start: str, end: str,
                       event_types: list[str], key: str, measure: str,
                       attribute_alias: str | None = None, total_alias: str | None = None,
                       whole_last_day: bool = False) -> DataFrame:
    """Sum of an integer property per customer and attribute value.

    Events in ``[start, end]`` of the given types with non-null
    properties; ``key`` and ``measure`` are read from the ``{k=v, ..}``
    text (first occurrence wins); events whose ``key`` is missing are
    dropped; the measure is cast strictly to int.  Unmatched customers
    keep a null name.  Sorted by the total.
    """
    attribute_alias = attribute_alias or key
    total_alias = total_alias or f"total_{measure}"
    e = (events.where(ts_range("timestamp", start, end, whole_last_day))
         .where(F.col("event_type").isin(*event_types))
         .where(F.col("properties").isNotNull())
         .select("customer_id", kv_get(F.col("properties"), key).alias("attr"),
                 kv_get(F.col("properties"), measure).cast("int").alias("m"))
         .where(F.col("attr").isNotNull()))
    # Pre-aggregate per (customer, attribute) before the join.
    pre = e.groupBy("customer_id", "attr").agg(F.sum("m").alias("s"))
    c = customers.select(F.col("id").alias("c_id"), F.col("name"))
    j = pre.join(c, pre.customer_id == c.c_id, "left")
    return (j.groupBy("name", "customer_id", "attr").agg(F.sum("s").cast("bigint").alias(total_alias))
            .select("name", "customer_id", F.col("attr").alias(attribute_alias), total_alias)
            .orderBy(F.col(total_alias).asc_nulls_last(), F.col("customer_id").asc_nulls_last(),
                     F.col(attribute_alias).asc_nulls_last(), F.col("name").asc_nulls_last()))


def invoice_lines(customer: DataFrame, invoice: DataFrame, line_item: DataFrame,
                  sub_line_item: DataFrame, customer_name: str, start: str, end: str,
                  total_agg: str = "max", status: str | None = None) -> DataFrame:
    """One customer's invoice, line by line.

    customer -> invoice -> line_item -> sub_line_item (left joins), kept
    where the customer name matches and the invoice lies in
    ``[start, end]`` (start on ``start_timestamp``, end on
    ``end_timestamp``).  Per line name and metric: quantity summed;
    money is the ``max`` sub-line subtotal (``total_agg="sum"`` adds
    them instead); unit price is the rounded total over the quantity.
    ``status`` optionally keeps only invoices in that status.
    """
    c = customer.where(F.col("name") == customer_name).select(F.col("id").alias("c_id"), "name")
    i = invoice.where((F.col("start_timestamp") >= ts_literal(start)) &
                      (F.col("end_timestamp") <= ts_literal(end)))
    if status is not None:
        i = i.where(F.col("status") == status)
    i = i.select(F.col("id").alias("i_id"), F.col("customer_id").alias("i_customer_id"))
    li = line_item.select(F.col("id").alias("l_id"), F.col("invoice_id").alias("l_invoice_id"),
                          F.col("name").alias("line_item_name"))
    by_invoice = "invoice_id" in sub_line_item.columns
    sl = sub_line_item.select(F.col("line_item_id").alias("sl_line_item_id"), "billable_metric_name",
                              "quantity", "subtotal", *[F.col("invoice_id").alias("sl_invoice_id")] * by_invoice)
    ci = c.join(i, F.col("c_id") == F.col("i_customer_id"), "inner")
    # One customer's invoices are few; cut the line tables down to them
    # before the outer joins (see joins.semi_reduce).
    li = semi_reduce(li, "l_invoice_id", ci, "i_id")
    cil = ci.join(li, F.col("i_id") == F.col("l_invoice_id"), "left")
    # Sub lines that name their invoice need no second look at the lines.
    sl = semi_reduce(sl, "sl_invoice_id", ci, "i_id") if by_invoice else semi_reduce(sl, "sl_line_item_id", cil, "l_id")
    j = cil.join(sl, F.col("l_id") == F.col("sl_line_item_id"), "left")
    money = F.max("subtotal") if total_agg == "max" else F.sum("subtotal")
    g = (j.groupBy("line_item_name", "billable_metric_name")
         .agg(F.sum("quantity").alias("Quantity"), money.cast("bigint").alias("total_cents")))
    total = cents_to_units(F.col("total_cents"))
    unit = round_2(divide_safe(total, F.col("Quantity")))
    return (g.select(
        "line_item_name",
        F.col("billable_metric_name").alias("Description"),
        "Quantity",
        format_money(to_cents(unit)).alias("Unit Price"),
        format_money(F.col("total_cents"), suffix="").alias("Total"),
        "total_cents")
        .orderBy(F.col("line_item_name").asc_nulls_last(), F.col("Description").asc_nulls_last(),
                 F.col("Quantity").asc_nulls_last()))


def billings_by_plan(invoice: DataFrame, plan: DataFrame, customer: DataFrame, start: str, end: str,
                     customer_name: str | None = None, suffix: str = "USD",
                     legacy_string_order: bool = False) -> DataFrame:
    """Billed total per plan and customer for invoices issued in
    ``[start, end]`` (inner joins).

    Sorted by the amount, largest first.  ``legacy_string_order=True``
    sorts on the display string instead (so ``$9.0`` comes before
    ``$100.0``).
    """
    i = invoice.where(F.col("issued_at").between(ts_literal(start), ts_literal(end)))
    c = customer.select(F.col("id").alias("c_id"), F.col("name").alias("customer_name"))
    if customer_name is not None:
        c = c.where(F.col("customer_name") == customer_name)
    # Pre-aggregate per (plan, customer) id before joining the dimensions.
    pre = i.groupBy("plan_id", "customer_id").agg(F.sum("total").alias("s"))
    p = plan.select(F.col("id").alias("p_id"), F.col("name").alias("plan_name"))
    j = (pre.join(p, pre.plan_id == p.p_id, "inner")
         .join(c, pre.customer_id == c.c_id, "inner"))
    g = j.groupBy("plan_name", "customer_name").agg(F.sum("s").cast("bigint").alias("total_billed_cents"))
    out = g.select("plan_name", "customer_name",
                   format_money(F.col("total_billed_cents"), suffix=suffix).alias("total_billed"),
                   "total_billed_cents")
    order = F.col("total_billed").desc() if legacy_string_order else F.col("total_billed_cents").desc()
    return out.orderBy(order, F.col("plan_name").asc_nulls_last(), F.col("customer_name").asc_nulls_last())


def invoice_slices(invoices: DataFrame, by: list[str], customer_name: str | None = None,
                   name_col: str = "customer_name", keep_null_keys: bool = False,
                   customers: DataFrame | None = None, values: tuple[str, ...] = ("total",)) -> DataFrame:
    """Interactive summary: finalized invoices with a positive total,
    ``adjusted_totals = total - invoice_adjustments_0_total`` (null when
    there is no adjustment), then sums of ``values`` per customer and
    ``by``.

    The customer's name comes from ``customer_name`` (one customer's
    invoices), from a column ``name_col`` of the invoices, or from
    ``customers`` (id, name): then the sums are taken per customer id
    before the join with the names.
    """
    f = invoices.where(finalized_positive())
    adj = "invoice_adjustments_0_total"
    f = f.withColumn("adjusted_totals", F.col("total") - (F.col(adj) if adj in f.columns else F.lit(None)))
    if customers is not None:
        sums = f.groupBy("customer_id", *by).agg(*[F.sum(v).alias(v) for v in values])
        names = customers.select(F.col("id").alias("c_id"), F.col("name").alias(name_col))
        f = sums.join(names, sums.customer_id == names.c_id, "inner")
    return slice_totals(f, by, value=values, customer_name=customer_name, keep_null_keys=keep_null_keys, name_col=name_col)


def customer_summary(invoices: DataFrame, key: str = "customer_id",
                     columns: tuple[str, ...] = ("total", "subtotal")) -> DataFrame:
    """Per-customer sums of invoice amounts."""
    return invoices.groupBy(key).agg(*[F.sum(c).alias(c) for c in columns])


def customer_invoice_join(customers: DataFrame, invoices: DataFrame, customer_shape: Shape | None = None,
                          invoice_shape: Shape | None = None, suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Every flattened customer beside its flattened invoices, names that
    both have with suffixes.  Records are joined nested, on text keys, and
    flattened after the join: a shuffle carries a record once, not as
    hundreds of mostly null columns, and invoices are read once."""
    left = flat_columns(customers.schema, customer_shape or flatten_shape(customers), root=F.col("left_record"))
    right = flat_columns(invoices.schema, invoice_shape or flatten_shape(invoices), root=F.col("right_record"))
    whole = lambda df: F.struct(*[F.col(f"`{c}`") for c in df.columns])
    joined = left_join_skew_safe(
        customers.select(whole(customers).alias("left_record"), F.col("id").cast("string").alias("left_key")),
        invoices.select(whole(invoices).alias("right_record"), F.col("customer_id").cast("string").alias("right_key")),
        "left_key", "right_key")
    shared = left.keys() & right.keys()
    return joined.select(*[c.alias(n + suffixes[0] if n in shared else n) for n, c in left.items()],
                         *[c.alias(n + suffixes[1] if n in shared else n) for n, c in right.items()])
