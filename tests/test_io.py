"""Sources and sinks on files under a temp folder."""
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import SF001

from ledgerline import schemas
from ledgerline.plans.ingest import load_and_process
from ledgerline.sources import api_records, egress, pages, sinks
from ledgerline.streaming.landed_pages import start_ingest

INV_OK = {"id": "i1", "customer_id": "c1", "start_timestamp": "2024-03-01", "end_timestamp": "2024-03-31",
          "type": "USAGE", "status": "FINALIZED", "billable_status": "billable", "plan_id": "p1",
          "plan_name": "Paygo", "total": 7163, "subtotal": 7163.0, "external_invoice": None,
          "credit_type": {"id": "USD", "name": "USD (cents)"}, "customer_custom_fields": {},
          "plan_custom_fields": {}, "custom_fields": {}, "invoice_adjustments": [],
          "line_items": [{"total": 25.0, "credit_type": {"id": "USD", "name": "USD"}, "name": "CPU Hours",
                          "product_id": "cpu", "quantity": 25.5, "custom_fields": {},
                          "sub_line_items": [{"charge_id": "ch", "name": "c5", "subtotal": 25.0, "price": 0.01,
                                              "quantity": 25.5, "custom_fields": {}}]}]}


def _write_lines(path, objs):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for o in objs:
            f.write(json.dumps(o) + "\n")


def test_pages_error_routing_and_per_record_rejects(spark, tmp_path):
    bad_ts = dict(INV_OK, id="i5", end_timestamp="31/03/2024")
    bad_qty = json.loads(json.dumps(INV_OK))
    bad_qty["id"] = "i2"
    bad_qty["line_items"][0]["quantity"] = "12.5x"
    missing = dict(INV_OK, id="i3")
    del missing["plan_id"]
    pages_path = str(tmp_path / "landing" / "p1.json")
    _write_lines(pages_path, [{"data": [INV_OK, bad_qty, missing, bad_ts]}, {"error": "Endpoint not found."},
                              {"next_page": None}])
    _write_lines(str(tmp_path / "landing" / "p2.json"), [{"data": [dict(INV_OK, id="i4")]}])

    raw = pages.read_pages(spark, str(tmp_path / "landing"), schemas.as_text_leaves(schemas.INVOICE))
    errs = pages.page_errors(raw).collect()
    assert [e.error for e in errs] == ["Endpoint not found."]
    recs = pages.explode_pages(raw)
    assert recs.count() == 5                       # missing data gives no record
    parsed = recs.select("source_file", F.struct(*[c for c in recs.columns if c != "source_file"]).alias("r"))
    valid, rejects = pages.validate_records(parsed, schemas.INVOICE, schemas.REQUIRED["invoice"],
                                            keep=["source_file"], timestamp_fields=schemas.TIMESTAMPS["invoice"])
    assert sorted(r.id for r in valid.collect()) == ["i1", "i4"]
    got = {json.loads(r.record)["id"]: list(r.reasons) for r in rejects.collect()}
    assert got == {"i2": ["line_items: not a number"], "i3": ["plan_id: missing"],
                   "i5": ["end_timestamp: not a timestamp"]}
    assert dict(valid.dtypes)["start_timestamp"] == "timestamp_ntz"
    typed = valid.where(F.col("id") == "i1").collect()[0]
    assert typed.total == 7163.0 and typed.line_items[0].quantity == 25.5   # fractional quantity kept
    strict, _ = pages.validate_records(parsed, schemas.INVOICE, schemas.REQUIRED["invoice"],
                                       keep=["source_file"], all_or_nothing_by="source_file")
    assert sorted(r.id for r in strict.collect()) == ["i4"]


def test_nested_requirements_and_strict_numbers(spark, tmp_path):
    def broken(key, change):
        record = json.loads(json.dumps(dict(INV_OK, id=key)))
        change(record)
        return record

    line = {"total": 25.0}
    records = [
        INV_OK, broken("empty", lambda r: r.update(line_items=[])), broken("exp", lambda r: r.update(total=7.5e9)),
        broken("suffix", lambda r: r.update(total="12d")), broken("nan", lambda r: r.update(total="NaN")),
        broken("credit", lambda r: r.update(credit_type={"id": None, "name": "USD"})),
        broken("map", lambda r: r.pop("custom_fields")), broken("none", lambda r: r.update(line_items=[None])),
        broken("sub", lambda r: r["line_items"][0]["sub_line_items"][0].pop("charge_id")),
        broken("line", lambda r: r["line_items"].append(line)),
        broken("adjust", lambda r: r.update(invoice_adjustments=[{"total": 1.0, "credit_type": {"id": "USD"}}]))]
    _write_lines(str(tmp_path / "in" / "p.json"), [{"data": records}])
    raw = pages.read_pages(spark, str(tmp_path / "in"), schemas.as_text_leaves(schemas.INVOICE))
    recs = pages.explode_pages(raw)
    parsed = recs.select("source_file", F.struct(*[c for c in recs.columns if c != "source_file"]).alias("r"))
    valid, rejects = pages.validate_records(parsed, schemas.INVOICE, schemas.REQUIRED["invoice"], keep=["source_file"])
    assert sorted(r.id for r in valid.collect()) == ["empty", "exp", "i1"]
    got = {json.loads(r.record)["id"]: list(r.reasons) for r in rejects.collect()}
    assert got.pop("line") == [f"line_items[].{n}: missing" for n in (
        "credit_type", "name", "product_id", "quantity", "custom_fields", "sub_line_items")]
    assert got == {
        "suffix": ["total: not a number"], "nan": ["total: not a number"], "credit": ["credit_type.id: missing"],
        "map": ["custom_fields: missing"], "none": ["line_items[]: missing"],
        "sub": ["line_items[].sub_line_items[].charge_id: missing"],
        "adjust": ["invoice_adjustments[].credit_type.name: missing"]}


def test_raw_passthrough(spark, tmp_path):
    p = str(tmp_path / "raw" / "b.json")
    _write_lines(p, [{"balance": 5, "anything": [1, 2]}, {"other": True}])
    df = pages.read_raw_json(spark, p)
    got = sorted(r.b for r in df.select(F.get_json_object("json", "$.balance").alias("b")).collect()
                 if r.b is not None)
    assert got == ["5"]


def test_csv_quotes_round_trip_and_single_file(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", ok', "a\nb"), (2, "", None)], "id int, t string, u string")
    out = str(tmp_path / "report")
    sinks.write_csv(df, out, single_file=True)
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1
    back = egress.read_csv(spark, out, schema="id int, t string, u string", multi_line=True)
    assert sorted(tuple(r) for r in back.collect() if r.id == 1) == [(1, 'say "hi", ok', "a\nb")]


def test_load_egress_tree_and_catalog(spark, tmp_path):
    root = tmp_path / "Sample Egress Data"
    (root / "sub").mkdir(parents=True)
    (root / "Export - customer.csv").write_text("id,name\nc1,A1 Company\nc2,B1 Company\n")
    (root / "sub" / "Export - invoice.csv").write_text("id,customer_id,total\ni1,c1,7163\n")
    tables = egress.load_egress_dir(spark, str(root))
    assert sorted(tables) == ["customer", "invoice"]
    assert spark.sql("SELECT sum(total) AS s FROM invoice").collect()[0].s == 7163
    desc = {(r.table, r.column) for r in egress.describe_tables(spark, ["customer", "invoice"]).collect()}
    assert ("customer", "name") in desc and ("invoice", "total") in desc
    assert egress.table_name_of("/x/Sample - line_item.csv") == "line_item"


def test_save_table_fails_when_exists(spark):
    df = spark.createDataFrame([(1,)], "a int")
    egress.save_table(df, "ll_test_tbl", mode="overwrite")
    with pytest.raises(Exception):
        egress.save_table(df, "ll_test_tbl")


def test_json_per_customer_and_build_once(spark, tmp_path):
    df = spark.createDataFrame([("c1", "i1"), ("c2", "i2"), ("c1", "i3")], "customer_id string, id string")
    out = str(tmp_path / "inv")
    sinks.write_json(df, out, partition_by=["customer_id"])
    assert sorted(f for f in os.listdir(out) if f.startswith("customer_id=")) == ["customer_id=c1",
                                                                                  "customer_id=c2"]
    calls = []

    def build():
        calls.append(1)
        return df
    p = str(tmp_path / "once")
    a = sinks.build_once(spark, p, build)
    b = sinks.build_once(spark, p, lambda: df.limit(0))
    assert a.count() == 3 and b.count() == 3


def test_load_and_process(spark, tmp_path):
    recs = spark.createDataFrame([json.dumps(INV_OK)], "string").select(
        F.from_json("value", schemas.INVOICE).alias("r")).select("r.*")
    flat = load_and_process(recs, str(tmp_path / "raw"), str(tmp_path / "flat"), str(tmp_path / "csv"))
    assert "line_items_0_sub_line_items_0_price" in flat.columns
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.count() == 1 and "line_items_0_name" in back.columns


def test_load_and_process_reads_its_input_once(spark, tmp_path):
    # A new random id at each evaluation: the outputs agree only if there is one.
    recs = spark.range(20, numPartitions=3).select(
        F.expr("uuid()").alias("id"), F.array(F.struct(F.col("id").alias("n"))).alias("parts"))
    flat = load_and_process(recs, str(tmp_path / "raw"), str(tmp_path / "flat"), str(tmp_path / "csv"))
    ids = sorted(r["id"] for r in flat.collect())
    assert flat.columns == ["id", "parts_0_n"] and len(set(ids)) == 20
    for df in (spark.read.json(str(tmp_path / "raw")), spark.read.json(str(tmp_path / "flat")),
               spark.read.option("header", True).csv(str(tmp_path / "csv"))):
        assert sorted(r["id"] for r in df.collect()) == ids


def test_egress_tables_are_found_by_pattern(spark, tmp_path):
    files = {"a/X - plan.csv": "id\n1\n", "b/Y - plan.csv": "id\n2\n", "plan.csv": "id\n3\n", "c/Z - other - plan.csv": "key\n4\n",
             "X - odd [a], {b}*.csv": "id\n5\n", "d/X - odd.csv": "id\n6\n"}
    for name, text in files.items():
        path = tmp_path / "tree" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    tables = egress.load_egress_dir(spark, str(tmp_path / "tree"), multi_line=False, register=False)
    got = {n: sorted(r[0] for r in df.collect()) for n, df in tables.items()}
    assert got == {"plan": ["1", "2", "3"], "other - plan": ["4"], "odd [a], {b}*": ["5"], "odd": ["6"]}


def test_streaming_ingest(spark, tmp_path):
    landing = str(tmp_path / "landing")
    bad = dict(INV_OK, id="i2", total="n/a")
    _write_lines(os.path.join(landing, "a.json"), [{"data": [INV_OK, bad]}])
    _write_lines(os.path.join(landing, "b.json"), [{"data": [dict(INV_OK, id="i3")]}])
    q = start_ingest(spark, landing, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    valid = spark.read.parquet(str(tmp_path / "out" / "valid"))
    rejects = spark.read.parquet(str(tmp_path / "out" / "rejects"))
    assert sorted(r.id for r in valid.collect()) == ["i1", "i3"]
    assert [list(r.reasons) for r in rejects.collect()] == [["total: not a number"]]


def test_single_object_envelope(spark, tmp_path):
    p = str(tmp_path / "one" / "c.json")
    _write_lines(p, [{"data": {"id": "c1", "name": "A1 Company", "external_id": None, "ingest_aliases": [],
                               "custom_fields": {}, "customer_config": {}}},
                     {"error": "Unauthorized access, please check your API key."}])
    df = pages.read_pages(spark, p, schemas.CUSTOMER, single=True)
    ok = df.where(F.col("error").isNull()).select("data.*").collect()
    assert [(r.id, r.name) for r in ok] == [("c1", "A1 Company")]


def test_report_job_writes_one_csv_per_report(spark, tmp_path):
    from ledgerline.plans import jobs
    paths = jobs.run(spark, SF001, str(tmp_path / "reports"))
    assert sorted(os.path.basename(p) for p in paths) == ["billings_by_plan", "customer_statement",
                                                          "invoice_lines", "usage_by_attribute"]
    stmt = spark.read.option("header", True).csv(paths[0])
    assert stmt.count() == 150
    assert len([f for f in os.listdir(paths[0]) if f.endswith(".csv")]) == 1


def test_streaming_restart_processes_only_new_files(spark, tmp_path):
    landing, out, ckpt = str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    _write_lines(os.path.join(landing, "a.json"), [{"data": [INV_OK, dict(INV_OK, id="i2", total="x")]}])
    start_ingest(spark, landing, out, ckpt, all_or_nothing=True).awaitTermination(120)
    # the page of a.json has a reject: none of its records is valid
    assert spark.read.parquet(os.path.join(out, "valid")).count() == 0
    _write_lines(os.path.join(landing, "b.json"), [{"data": [dict(INV_OK, id="i5")]}])
    start_ingest(spark, landing, out, ckpt, all_or_nothing=True).awaitTermination(120)
    valid = spark.read.parquet(os.path.join(out, "valid"))
    assert sorted(r.id for r in valid.collect()) == ["i5"]
    assert spark.read.parquet(os.path.join(out, "rejects")).count() == 1


def test_month_partitioned_layout_prunes_and_matches(spark, tmp_path):
    import contextlib
    import io as _io

    from ledgerline.sources import driver_tables as dt
    inv = dt.invoices(spark, SF001)
    path = str(tmp_path / "invoice_by_month")
    sinks.write_by_month(inv, path, "issued_at")
    got = sinks.read_time_range(spark, path, "issued_at", "1998-03-01", "1998-03-31")
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain("formatted")
    assert "PartitionFilters: [isnotnull(issued_at_month" in buf.getvalue()
    want = inv.where(F.col("issued_at").between(F.to_timestamp_ntz(F.lit("1998-03-01")),
                                                F.to_timestamp_ntz(F.lit("1998-03-31"))))
    assert sorted(tuple(r) for r in got.select(*inv.columns).collect()) == sorted(tuple(r) for r in want.collect())


def test_unreadable_page_is_an_error_page(spark, tmp_path):
    path = tmp_path / "pages.json"
    path.write_text('{"data": [{"id": "a"}], "error": null}\n{"data": [{"id": "b"\n{"error": "down"}\n')
    read = pages.read_pages(spark, str(path), StructType().add("id", "string"))
    assert [r["id"] for r in pages.explode_pages(read).collect()] == ["a"]
    errors = sorted(r["error"] for r in pages.page_errors(read).collect())
    assert errors == ["down", 'unreadable page: {"data": [{"id": "b"']


def test_json_keeps_null_fields(spark, tmp_path):
    out = str(tmp_path / "json")
    sinks.write_json(spark.createDataFrame([("a", None)], "id string, external_id string"), out)
    assert [r["value"] for r in spark.read.text(out).collect()] == ['{"id":"a","external_id":null}']


def test_quoted_newline_is_one_row_by_default(spark, tmp_path):
    out = str(tmp_path / "csv")
    sinks.write_csv(spark.createDataFrame([(1, "a\nb")], "id int, t string"), out)
    assert [tuple(r) for r in egress.read_csv(spark, out, schema="id int, t string").collect()] == [(1, "a\nb")]


def test_landed_records_follow_a_rewritten_input(spark, tmp_path):
    for t in ("orders", "lineitem", "part"):
        spark.read.parquet(f"{SF001}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    first = api_records.landed_invoice_records(spark, str(tmp_path))
    assert first.inputFiles() == api_records.landed_invoice_records(spark, str(tmp_path)).inputFiles()
    before = {r["id"]: r["total"] for r in first.select("id", "total").collect()}
    # As many rows, other totals.
    orders = spark.read.parquet(f"{SF001}/orders.parquet").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    orders.write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    after = {r["id"]: r["total"] for r in
             api_records.landed_invoice_records(spark, str(tmp_path)).select("id", "total").collect()}
    assert after == {k: v + 100 for k, v in before.items()}
