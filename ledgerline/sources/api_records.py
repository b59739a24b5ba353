"""Nested API-shaped records derived from the driver tables.

The billing API returns customers, invoices and credit grants as nested
JSON.  These builders produce the same shapes (see ``schemas.py``) from
the driver tables so the nested operators (explode, flatten, first
array element, validated read) run on data that grows with the input.

Arrays are built per API record, the way the API nests them: an
invoice's line items, a grant's deductions.  A record must fit in one
row in any engine, so these groups are bounded by the record itself
(an order's lines); nothing is grouped by customer or by any other
open-ended key.  Arrays are sorted
so element order is deterministic.

What is shuffled and grouped are the plain columns of the tables; the
nested structs and the JSON text, many times their size, are made after
the last exchange.  Rows are dealt out by key before they are grouped, so
no task groups what it happens to read.  Landed text is compressed, in
files of a bounded number of records, as compressed text isn't split.

Fixed values of the derivation (mirrored by the oracle SQL):

* customer record: id = text of c_custkey, ingest_aliases = [c_name],
  custom_fields = {segment: c_mktsegment}, customer_config =
  {nation: text of c_nationkey}; API page number = c_custkey div 100
* invoice record: one per order; type USAGE, billable_status billable,
  total = subtotal = o_totalprice in cents; an adjustment of 2 % of the
  total price (in cents, negative) on 1-URGENT and 2-HIGH orders, none
  otherwise; one line item per lineitem row, ordered by
  (l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount),
  each with two sub-line items: ``base`` (p_brand, extended price in
  cents) and ``discount`` (negative discount amount in cents)
* credit grant: one per order that has lines; deductions = one per
  line, effective_at = l_shipdate text, amount = discount amount in
  cents, running_balance = net amount in cents, sorted ascending by
  (effective_at, amount, reason, running_balance); balance is null for
  status P, otherwise included/excluded sums of gross/net cents
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ledgerline import schemas
from ledgerline.functions.money import to_cents
from ledgerline.operators import nested
from ledgerline.operators.joins import dimension
from ledgerline.session import shared_path
from ledgerline.sources.sinks import build_once, publish
from ledgerline.sources.driver_tables import USD, plan_id, plan_name, read, status_name

PAGE_SIZE = 100
LANDING = "landed-4"  # another number where what lands changes
ADJUSTED_PRIORITIES = ("1-URGENT", "2-HIGH")
ADJUSTMENT_RATE = 0.02
# Landed text: the codec, and the most invoices in a file.
TEXT_CODEC, INVOICES_PER_FILE = "snappy", 50_000


def _usd():
    return F.struct(F.lit(USD[0]).alias("id"), F.lit(USD[1]).alias("name"))


def _empty_map():
    return F.create_map().cast("map<string,string>")


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("external_id"),
        F.array(F.col("c_name")).alias("ingest_aliases"),
        F.create_map(F.lit("segment"), F.col("c_mktsegment")).alias("custom_fields"),
        F.create_map(F.lit("nation"), F.col("c_nationkey").cast("string")).alias("customer_config"),
    )


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API pages of at most ``PAGE_SIZE`` customers each.

    Page membership comes from the unique customer key, so a page can
    never grow past ``PAGE_SIZE`` records however large the table is.
    """
    recs = customer_records(spark, sf_dir)
    page_no = F.floor(F.col("id").cast("bigint") / PAGE_SIZE)
    return (recs.withColumn("page_no", page_no)
            .groupBy("page_no")
            .agg(F.array_sort(F.collect_list(F.struct(*[F.col(f.name) for f in schemas.CUSTOMER.fields])),
                              lambda a, b: F.when(a.id.cast("bigint") < b.id.cast("bigint"), -1)
                              .when(a.id.cast("bigint") > b.id.cast("bigint"), 1).otherwise(0)).alias("data"))
            .select("page_no", F.struct(F.col("data"), F.lit(None).cast("string").alias("next_page"),
                                        F.lit(None).cast("string").alias("error")).alias("page")))


# What the lines of a nested invoice are made of, in the order they are sorted by.
_LINE_PARTS = ("l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "p_type", "p_brand")


def _line_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, parts): the lines of each order, as plain columns."""
    li = read(spark, sf_dir, "lineitem")
    p = dimension(read(spark, sf_dir, "part"))
    return (li.join(p, li.l_partkey == p.p_partkey, "inner").select("l_orderkey", *_LINE_PARTS).repartition("l_orderkey")
            .groupBy("l_orderkey").agg(F.collect_list(F.struct(*_LINE_PARTS)).alias("parts")))


def _line_struct(part, product_id):
    ext_cents = to_cents(part["l_extendedprice"]).cast("double")
    disc_cents = to_cents(part["l_extendedprice"] * part["l_discount"]).cast("double")
    base = F.struct(
        F.lit("base").alias("charge_id"), part["p_brand"].alias("name"), ext_cents.alias("subtotal"),
        part["l_extendedprice"].alias("price"), part["l_quantity"].alias("quantity"),
        _empty_map().alias("custom_fields"))
    discount = F.struct(
        F.lit("discount").alias("charge_id"), F.lit("discount").alias("name"), (-disc_cents).alias("subtotal"),
        part["l_discount"].alias("price"), F.lit(1.0).alias("quantity"),
        _empty_map().alias("custom_fields"))
    return F.struct(
        ext_cents.alias("total"), _usd().alias("credit_type"), part["p_type"].alias("name"),
        product_id.alias("product_id"), part["l_quantity"].alias("quantity"),
        F.create_map(F.lit("line_number"), part["l_linenumber"].cast("string")).alias("custom_fields"),
        F.array(base, discount).alias("sub_line_items"))


def _line_items(parts, without_product=None):
    """The nested lines; empty without any."""
    def line(part):
        product_id = part["l_partkey"].cast("string")
        return _line_struct(part, product_id if without_product is None else F.when(
            without_product, F.lit(None).cast("string")).otherwise(product_id))
    return F.coalesce(F.transform(F.sort_array(parts), line).cast(ArrayType(schemas.LINE_ITEM)),
                      F.array().cast(ArrayType(schemas.LINE_ITEM)))


def _adjustments(total_price, priority):
    adj = F.struct((-to_cents(total_price * F.lit(ADJUSTMENT_RATE))).cast("double").alias("total"),
                   _usd().alias("credit_type"))
    return (F.when(priority.isin(*ADJUSTED_PRIORITIES), F.array(adj))
            .otherwise(F.array().cast(ArrayType(schemas.INVOICE_ADJUSTMENT))).cast(ArrayType(schemas.INVOICE_ADJUSTMENT)))


def invoice_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested invoices, one per order (orders without lines get ``[]``)."""
    o = read(spark, sf_dir, "orders")
    lines = _line_parts(spark, sf_dir)
    total_cents = to_cents(F.col("o_totalprice")).cast("double")
    j = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    return j.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").cast("string").alias("start_timestamp"),
        F.col("o_orderdate").cast("string").alias("end_timestamp"),
        F.lit("USAGE").alias("type"),
        status_name(F.col("o_orderstatus")).alias("status"),
        F.lit("billable").alias("billable_status"),
        plan_id(F.col("o_orderpriority")).alias("plan_id"),
        plan_name(F.col("o_orderpriority")).alias("plan_name"),
        total_cents.alias("total"),
        total_cents.alias("subtotal"),
        F.lit(None).cast("string").alias("external_invoice"),
        _usd().alias("credit_type"),
        _empty_map().alias("customer_custom_fields"),
        _empty_map().alias("plan_custom_fields"),
        _empty_map().alias("custom_fields"),
        _line_items(F.col("parts")).alias("line_items"),
        _adjustments(F.col("o_totalprice"), F.col("o_orderpriority")).alias("invoice_adjustments"),
    )


def grant_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested credit grants, one per order with lines."""
    li = read(spark, sf_dir, "lineitem")
    o = read(spark, sf_dir, "orders")
    gross = to_cents(F.col("l_extendedprice"))
    net = lambda line: to_cents(line["l_extendedprice"] * (F.lit(1.0) - line["l_discount"]))

    def deduction(line):
        return F.struct(
            line["l_shipdate"].cast("string").alias("effective_at"),
            to_cents(line["l_extendedprice"] * line["l_discount"]).cast("double").alias("amount"),
            F.lit("usage").alias("reason"),
            net(line).cast("double").alias("running_balance"),
            F.lit("billing").alias("created_by"),
            F.col("l_orderkey").cast("string").alias("credit_grant_id"),
            F.col("l_orderkey").cast("string").alias("invoice_id"))

    parts = ("l_shipdate", "l_extendedprice", "l_discount")
    per_order = (li.select("l_orderkey", *parts).repartition("l_orderkey").groupBy("l_orderkey")
                 .agg(F.collect_list(F.struct(*parts)).alias("parts"), F.sum(gross).alias("gross"),
                      F.sum(net({c: F.col(c) for c in parts})).alias("net")))
    j = per_order.join(o, per_order.l_orderkey == o.o_orderkey, "inner")
    amount = F.struct(to_cents(F.col("o_totalprice")).cast("double").alias("amount"), _usd().alias("credit_type"))
    paid = F.struct(F.lit(0.0).alias("amount"), _usd().alias("credit_type"))
    balance = F.when(F.col("o_orderstatus") != "P", F.struct(
        F.col("gross").cast("bigint").alias("including_pending"),
        F.col("net").cast("bigint").alias("excluding_pending"),
        F.col("o_orderdate").cast("string").alias("effective_at")))
    return j.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("grant "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.lit(None).cast("string").alias("uniqueness_key"),
        F.lit(None).cast("string").alias("reason"),
        F.col("o_orderdate").cast("string").alias("effective_at"),
        F.date_add(F.col("o_orderdate"), 365).cast("string").alias("expires_at"),
        plan_id(F.col("o_orderpriority")).cast("double").alias("priority"),
        amount.alias("grant_amount"),
        paid.alias("paid_amount"),
        balance.alias("balance"),
        F.array_sort(F.transform("parts", deduction)).alias("deductions"),
        F.array().cast(ArrayType(schemas.DEDUCTION)).alias("pending_deductions"),
        F.struct(F.lit(None).cast("string").alias("x_account_id")).alias("custom_fields"),
        F.lit("PAID").alias("credit_grant_type"),
    )


# Fixed corruption rules of the landed-record fixture: a total that is
# not a number, a missing required field, and one missing in line items.
BAD_TOTAL_WHEN = ("P", "1-URGENT")      # (o_orderstatus, o_orderpriority) -> total "n/a"
MISSING_PLAN_WHEN = ("O", "5-LOW")      # (o_orderstatus, o_orderpriority) -> no plan_id
MISSING_PRODUCT_WHEN = ("F", "2-HIGH")  # (o_orderstatus, o_orderpriority) -> line items without product_id


_JSON_PARTS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
               "adjusted_price", "adjusted_priority", "parts")


def _json_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each landed invoice is made of: an order, beside each nested
    invoice of its key."""
    o = read(spark, sf_dir, "orders")
    same = dimension(o.select(F.col("o_orderkey").alias("same_key"), F.col("o_totalprice").alias("adjusted_price"),
                              F.col("o_orderpriority").alias("adjusted_priority")))
    lines = _line_parts(spark, sf_dir)
    return (o.join(same, F.col("o_orderkey") == F.col("same_key"), "left")
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(*_JSON_PARTS))


def _json_text(part):
    """One invoice as JSON text."""
    st, pr = part["o_orderstatus"], part["o_orderpriority"]
    cents = to_cents(part["o_totalprice"])

    def text(total):
        return F.to_json(F.struct(
            part["o_orderkey"].cast("string").alias("id"),
            part["o_custkey"].cast("string").alias("customer_id"),
            part["o_orderdate"].cast("string").alias("start_timestamp"),
            part["o_orderdate"].cast("string").alias("end_timestamp"),
            F.lit("USAGE").alias("type"),
            status_name(st).alias("status"),
            F.lit("billable").alias("billable_status"),
            F.when(~((st == MISSING_PLAN_WHEN[0]) & (pr == MISSING_PLAN_WHEN[1])), plan_id(pr)).alias("plan_id"),
            plan_name(pr).alias("plan_name"),
            total.alias("total"),
            cents.alias("subtotal"),
            _usd().alias("credit_type"),
            *[_empty_map().alias(n) for n in ("customer_custom_fields", "plan_custom_fields", "custom_fields")],
            _line_items(part["parts"], (st == MISSING_PRODUCT_WHEN[0]) & (pr == MISSING_PRODUCT_WHEN[1])).alias("line_items"),
            _adjustments(part["adjusted_price"], part["adjusted_priority"]).alias("invoice_adjustments")))
    return F.when((st == BAD_TOTAL_WHEN[0]) & (pr == BAD_TOTAL_WHEN[1]), text(F.lit("n/a"))).otherwise(text(cents))


def invoice_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices as landed JSON text, one record per line, paged by
    customer (``page_id``), with a few records broken on purpose."""
    return _json_parts(spark, sf_dir).select(F.col("o_custkey").alias("page_id"), F.col("o_orderkey").alias("order_key"),
                                             _json_text({c: F.col(c) for c in _JSON_PARTS}).alias("json"))


# Fixed rule of the landed invoice pages: of every so many order keys one
# has a text where an object belongs.
MALFORMED = (997, 5)


def invoice_page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice pages as landed text, one envelope per line: broken records
    as in ``invoice_json_lines``, odd ones as in ``MALFORMED``, and failed
    and cut-off pages as among the customer pages.  A page holds the
    invoices of ``PAGE_SIZE`` order keys, which are unique."""
    def record(part):
        text = F.concat(F.lit('{"external_invoice":null,'), F.substring(_json_text(part), 2, 1 << 30))
        odd = F.regexp_replace(text, r'"credit_type":\{"id":"USD","name":"USD \(cents\)"\},"customer_custom',
                               '"credit_type":"USD","customer_custom')
        return F.when(part["o_orderkey"] % MALFORMED[0] == MALFORMED[1], odd).otherwise(text)

    # Invoices of failed and cut-off pages have no text to be made.
    lost = F.col("page_no") % FAILED_PAGE[0]
    lost = (lost == FAILED_PAGE[1]) | (lost == CUT_OFF_PAGE[1])
    rows = (_json_parts(spark, sf_dir).withColumn("page_no", F.floor(F.col("o_orderkey") / PAGE_SIZE))
            .select("page_no", F.when(lost, F.lit(None)).otherwise(F.struct(*_JSON_PARTS)).alias("r")))
    pages = (rows.repartition("page_no").groupBy("page_no").agg(F.collect_list("r").alias("parts"))
             .withColumn("records", F.transform(F.array_sort(F.transform("parts", lambda x: F.struct(
                 x["o_orderkey"].alias("order_key"), record(x).alias("record")))), lambda x: x["record"])))
    n, kind = F.col("page_no").cast("string"), F.col("page_no") % FAILED_PAGE[0]
    whole = F.concat(F.lit('{"data":['), F.array_join("records", ","), F.lit('],"next_page":null,"error":null}'))
    return pages.select(F.when(kind == FAILED_PAGE[1], F.concat(F.lit('{"error":"page '), n, F.lit(': no answer"}')))
                        .when(kind == CUT_OFF_PAGE[1], F.concat(F.lit('{"page":'), n, F.lit(',"data":[{"id":')))
                        .otherwise(whole).alias("value"))


SOURCES = {"invoice_records": ("orders", "lineitem", "part"), "grant_records": ("orders", "lineitem"),
           "invoice_json": ("orders", "lineitem", "part"), "invoice_pages": ("orders", "lineitem", "part"),
           "customer_pages": ("customer",), "colocated": ("orders", "lineitem", "part")}


def landing_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where the records derived from ``sf_dir`` land, in the shared
    folder that ``spark.checkpoint.dir`` names (not in the part of it that
    belongs to one application, so a later application reuses them).

    The folder name carries a fingerprint of the inputs: path, length and
    modification time of every file, listed and summed up by Spark at
    each call, so a rewritten table lands afresh.
    """
    tables = [os.path.join(sf_dir, f"{t}.parquet") for t in SOURCES[name]]
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(tables).select(F.xxhash64("path", "length", "modificationTime").alias("h")))
    seen = files.agg(F.count("*"), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    mark = hashlib.sha1("|".join([os.path.abspath(sf_dir), name, *map(str, seen)]).encode()).hexdigest()[:16]
    return shared_path(spark, f"{LANDING}/{mark}/{name}")


def landed_invoice_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested invoices as landed by the ingest (typed parquet), built
    once from the driver tables and then read like any landed table."""
    def build():
        return invoice_records(spark, sf_dir)
    return build_once(spark, landing_path(spark, sf_dir, "invoice_records"), build)


def landed_invoice_shape(spark: SparkSession, sf_dir: str) -> nested.Shape:
    """The shape of the landed invoices, kept beside them."""
    path = landing_path(spark, sf_dir, "invoice_records") + "-shape"
    return nested.read_shape(build_once(spark, path, lambda: nested.shape_table(landed_invoice_records(spark, sf_dir))))


def landed_grant_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build():
        return grant_records(spark, sf_dir)
    return build_once(spark, landing_path(spark, sf_dir, "grant_records"), build)


def _write_text(lines: DataFrame, to: str, per_file: int) -> None:
    lines.write.option("compression", TEXT_CODEC).option("maxRecordsPerFile", per_file).text(to)


def landed_invoice_json(spark: SparkSession, sf_dir: str) -> str:
    """Land the raw invoice records as JSON lines ``{"page_id": .., "record": {..}}``
    and return the folder; readers parse them in the scan."""
    lines = lambda: invoice_json_lines(spark, sf_dir).select(
        F.concat(F.lit('{"page_id":'), F.col("page_id").cast("string"), F.lit(',"record":'), F.col("json"),
                 F.lit("}")).alias("value"))
    return publish(spark, landing_path(spark, sf_dir, "invoice_json"), lambda to: _write_text(lines(), to, INVOICES_PER_FILE))


# Fixed rules of the landed page fixture: which pages the API answered
# with an error, and which are cut off.
FAILED_PAGE = (7, 3)      # page number mod 7 = 3: an error envelope
CUT_OFF_PAGE = (7, 5)     # page number mod 7 = 5: text that ends too early


def customer_page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer pages as landed text, one envelope per line."""
    n = F.col("page_no").cast("string")
    failed = F.to_json(F.struct(F.lit(None).cast("string").alias("data"), F.lit(None).cast("string").alias("next_page"),
                                F.concat(F.lit("page "), n, F.lit(": no answer")).alias("error")),
                       {"ignoreNullFields": "false"})
    cut_off = F.concat(F.lit('{"page":'), n, F.lit(',"data":[{"id":'))
    whole = F.to_json("page", {"ignoreNullFields": "false"})
    kind = F.col("page_no") % FAILED_PAGE[0]
    line = F.when(kind == FAILED_PAGE[1], failed).when(kind == CUT_OFF_PAGE[1], cut_off).otherwise(whole)
    return customer_pages(spark, sf_dir).select(line.alias("value"))


def landed_customer_pages(spark: SparkSession, sf_dir: str) -> str:
    """Lands the customer pages and returns their folder."""
    return publish(spark, landing_path(spark, sf_dir, "customer_pages"),
                   lambda to: customer_page_lines(spark, sf_dir).write.text(to))


def landed_invoice_pages(spark: SparkSession, sf_dir: str) -> str:
    """Lands the invoice pages and returns their folder."""
    return publish(spark, landing_path(spark, sf_dir, "invoice_pages"),
                   lambda to: _write_text(invoice_page_lines(spark, sf_dir), to, INVOICES_PER_FILE // PAGE_SIZE))


LANDINGS = {"invoice_records": landed_invoice_records, "invoice_shape": landed_invoice_shape, "grant_records": landed_grant_records,
            "invoice_json": landed_invoice_json, "invoice_pages": landed_invoice_pages, "customer_pages": landed_customer_pages}
