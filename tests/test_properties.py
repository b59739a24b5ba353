"""Whole-table properties on data derived from the driver tables."""
from pyspark.sql import functions as F

from conftest import SF001

from ledgerline.catalog import _validated
from ledgerline.operators import nested
from ledgerline.sources import api_records, driver_tables as dt


def test_validation_partitions_the_input(spark):
    valid, rejects = _validated(spark, SF001)
    v = {r.id for r in valid.select("id").collect()}
    rj = {r.id for r in rejects.select(F.get_json_object("record", "$.id").alias("id")).collect()}
    all_ids = {str(r.o_orderkey) for r in dt.read(spark, SF001, "orders").select("o_orderkey").collect()}
    assert v.isdisjoint(rj)
    assert v | rj == all_ids


def test_flatten_then_rebuild_gives_the_records_back(spark):
    recs = api_records.landed_invoice_records(spark, SF001)
    flat = nested.flatten_wide(recs)
    n = max(int(c.split("_")[2]) for c in flat.columns if c.startswith("line_items_")) + 1
    sub_fields = ["charge_id", "name", "subtotal", "price", "quantity"]

    def line(i):
        p = f"line_items_{i}_"
        subs = F.array(*[F.struct(*[F.col(f"{p}sub_line_items_{j}_{f}").alias(f) for f in sub_fields])
                         for j in range(2)])
        return F.when(F.col(f"{p}name").isNotNull(), F.struct(
            F.col(f"{p}total").alias("total"), F.col(f"{p}name").alias("name"),
            F.col(f"{p}product_id").alias("product_id"), F.col(f"{p}quantity").alias("quantity"),
            F.col(f"{p}custom_fields_line_number").alias("line_number"), subs.alias("subs")))
    rebuilt = flat.select("id", F.filter(F.array(*[line(i) for i in range(n)]), lambda x: x.isNotNull())
                          .alias("lines"))
    original = recs.select("id", F.transform("line_items", lambda x: F.struct(
        x["total"].alias("total"), x["name"].alias("name"), x["product_id"].alias("product_id"),
        x["quantity"].alias("quantity"), x["custom_fields"]["line_number"].alias("line_number"),
        F.transform(x["sub_line_items"], lambda s: F.struct(*[s[f].alias(f) for f in sub_fields]))
        .alias("subs"))).alias("lines"))
    diff = rebuilt.exceptAll(original).count() + original.exceptAll(rebuilt).count()
    assert diff == 0
    assert flat.count() == recs.count()
