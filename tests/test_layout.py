"""Co-located billing tables: joins and group-bys without exchange, hot
invoices and rows without an invoice beside the buckets."""
from conftest import SF001
from pyspark.sql import functions as F
from test_plans import plan_text

import __spark_entry__ as E
from ledgerline.sources import driver_tables as dt
from ledgerline.sources import layout


def rows(df):
    return sorted(map(repr, df.collect()))


def plain_chain(invoice, line, sub):
    l = line.select(F.col("invoice_id").alias("li"), F.col("id").alias("line_item_id"), F.col("name").alias("line_item_name"))
    s = sub.select(F.col("line_item_id").alias("sl"), "billable_metric_name", "quantity", "subtotal")
    return (invoice.join(l, F.col("id") == F.col("li"), "left").join(s, F.col("line_item_id") == F.col("sl"), "left")
            .select(F.col("id").alias("invoice_id"), "customer_id", "line_item_id", "line_item_name",
                    "billable_metric_name", "quantity", "subtotal"))


def test_joins_and_reports_read_buckets_side_by_side(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        landed = layout.landed_billing(spark, SF001)
        assert landed.rest is None
        for df in (layout.invoice_chain(landed), layout.lines_with_subs(landed), layout.lines_of_invoices(landed)):
            text = plan_text(df)
            assert "SortMergeJoin" in text and "Bucketed: true" in text
            assert "Exchange" not in text and "Sort [" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for key in layout.CO_LOCATION:  # the caller's session is as it was
        assert spark.conf.get(key, None) != layout.CO_LOCATION[key]
    want = plain_chain(dt.invoices(spark, SF001), dt.line_items(spark, SF001), dt.sub_line_items(spark, SF001))
    assert rows(layout.invoice_chain(landed)) == rows(want)
    assert rows(E.queries()["project_star_colocated"](spark, SF001)) == rows(E.queries()["project_star"](spark, SF001))


def test_hot_and_missing_invoices_lie_beside_the_buckets(spark, tmp_path):
    invoice = spark.range(50).select(F.col("id"), (F.col("id") % 5).alias("customer_id"))
    invoice = invoice.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS id, 9L AS customer_id"))
    # Invoice 7 has a third of the lines; some lines have no invoice.
    n = spark.range(900).withColumn("invoice_id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None)
                                    .otherwise(F.col("id") % 40).cast("bigint"))
    line = n.select(F.concat(F.lit("L"), "id").alias("id"), "invoice_id", F.lit("seat").alias("name"))
    sub = n.select(F.concat(F.lit("L"), "id").alias("line_item_id"), "invoice_id", F.lit("m").alias("billable_metric_name"),
                   F.lit(1.5).alias("quantity"), F.col("id").alias("subtotal"))
    tables = {"invoice": invoice, "line_item": line, "sub_line_item": sub}
    layout.write_colocated(spark, str(tmp_path / "hot"), tables, 4, hot_rows=100)
    landed = layout.read_colocated(spark, str(tmp_path / "hot"))
    assert {r[0] for r in landed.rest["line_item"].select("invoice_id").distinct().collect()} == {7, None}
    assert landed.tables["line_item"].where("invoice_id = 7").isEmpty()
    got = layout.invoice_chain(landed)
    assert rows(got) == rows(plain_chain(invoice, line, sub))
    assert got.where("invoice_id = 7").count() == 300 + n.where("id % 3 <> 0 AND invoice_id = 7").count()
    again = layout.read_colocated(spark, str(tmp_path / "hot"))
    assert rows(again.tables["invoice"]) == rows(landed.tables["invoice"])


def test_empty_tables(spark, tmp_path):
    tables = {"invoice": dt.invoices(spark, SF001).where("false"), "line_item": dt.line_items(spark, SF001).where("false"),
              "sub_line_item": dt.sub_line_items(spark, SF001).where("false")}
    layout.write_colocated(spark, str(tmp_path / "none"), tables, 4)
    landed = layout.read_colocated(spark, str(tmp_path / "none"))
    assert landed.rest is None and layout.lines_of_invoices(landed).isEmpty()


def test_lines_are_grouped_where_the_sub_lines_lie(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "ROWS_IN_BUCKET", 500)
    for name in ("orders", "lineitem", "part"):
        spark.read.parquet(f"{SF001}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    landed = layout.landed_billing(spark, str(tmp_path))
    n = spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    subs = landed.tables["sub_line_item"]
    assert f"SelectedBucketsCount: {-(-n // 500)} out of {-(-n // 500)}" in plan_text(dt.lines_of(subs))
    assert "Exchange" not in plan_text(dt.lines_of(subs))
    assert rows(landed.tables["line_item"]) == rows(dt.line_items(spark, SF001))
    # A hot invoice and lines without one, grouped from the rows beside the buckets.
    sub = spark.range(900).select(F.lit("x").alias("line_item_id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None)
                                  .otherwise(F.col("id") % 40).cast("bigint").alias("invoice_id"), F.lit("m").alias("billable_metric_name"),
                                  F.concat(F.lit("n"), F.col("id") % 2).alias("line_item_name"), F.lit(1.5).alias("quantity"),
                                  F.col("id").alias("subtotal"))
    tables = {"invoice": spark.range(50).select("id", F.col("id").alias("customer_id")), "sub_line_item": sub}
    layout.write_colocated(spark, f"{tmp_path}/hot", tables, 4, hot_rows=100, counted={"sub_line_item": sub.select("invoice_id")},
                           derived={"line_item": ("sub_line_item", dt.lines_of)})
    landed = layout.read_colocated(spark, f"{tmp_path}/hot")
    assert {r[0] for r in landed.rest["line_item"].select("invoice_id").distinct().collect()} == {7, None}
    assert rows(landed.tables["line_item"].unionByName(landed.rest["line_item"])) == rows(dt.lines_of(sub))
