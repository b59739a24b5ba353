"""What landing the nested records shuffles, sorts and writes."""
import datetime
import json
import os

from conftest import SF001

from ledgerline import schemas
from ledgerline.operators import joins
from ledgerline.sources import api_records, driver_tables, intake, pages


def plan_tree(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def below_first_exchange(df) -> str:
    return plan_tree(df).split("Exchange", 1)[1]


def dealt_out_before_grouped(df) -> bool:
    """Whether each first step of a collect_list reads dealt out rows."""
    lines = plan_tree(df).splitlines()
    first = [i for i, line in enumerate(lines) if "partial_collect_list" in line]
    return bool(first) and all("Exchange hashpartitioning" in next(
        x for x in lines[i + 1:] if "Sort [" not in x and "AQEShuffleRead" not in x) for i in first)


def small_tables(spark, folder) -> str:
    """Two orders of key 1, one of key 2 without lines, one without a key."""
    day = datetime.datetime(1998, 3, 1)
    orders = [(1, 7, "F", 10.0, day, "1-URGENT"), (1, 8, "O", 20.0, day, "3-MEDIUM"), (2, 7, "P", 5.0, day, "1-URGENT"),
              (None, 9, "F", 1.0, day, "2-HIGH")]
    lines = [(1, 5, 2, 2.0, 4.0, 0.5, day), (1, 5, 1, 1.0, 3.0, 0.0, day), (None, 5, 1, 1.0, 3.0, 0.0, day), (1, 6, 3, 1.0, 3.0, 0.0, day)]
    tables = {"orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                                      "o_orderdate timestamp_ntz, o_orderpriority string"),
              "lineitem": spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, "
                                                       "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz"),
              "part": spark.createDataFrame([(5, "LARGE", "Brand#1")], "p_partkey long, p_type string, p_brand string")}
    for name, df in tables.items():
        df.write.parquet(os.path.join(folder, f"{name}.parquet"))
    return folder


def test_invoices_are_nested_after_the_last_exchange(spark, tmp_path):
    df = api_records.invoice_records(spark, SF001)
    assert dealt_out_before_grouped(df)
    assert "sub_line_items" not in below_first_exchange(df) and "USD (cents)" not in below_first_exchange(df)
    got = {(r["id"], r["customer_id"]): r for r in api_records.invoice_records(spark, small_tables(spark, str(tmp_path))).collect()}
    assert sorted(got, key=str) == [("1", "7"), ("1", "8"), ("2", "7"), (None, "9")]
    assert [x["custom_fields"]["line_number"] for x in got["1", "8"]["line_items"]] == ["1", "2"]
    assert [s["subtotal"] for s in got["1", "7"]["line_items"][1]["sub_line_items"]] == [400.0, -200.0]
    assert got["2", "7"]["line_items"] == [] and [a["total"] for a in got["2", "7"]["invoice_adjustments"]] == [-10.0]


def test_landed_text_is_made_after_the_last_exchange_and_compressed(spark, tmp_path, monkeypatch):
    df = api_records.invoice_json_lines(spark, SF001)
    assert dealt_out_before_grouped(df) and "USAGE" not in below_first_exchange(df)
    monkeypatch.setattr(api_records, "INVOICES_PER_FILE", 2)
    folder = small_tables(spark, str(tmp_path))
    landed = api_records.landed_invoice_json(spark, folder)
    files = [f for f in os.listdir(landed) if f.startswith("part-")]
    assert len(files) >= 3 and all(f.endswith(".txt.snappy") for f in files)
    # Each order beside each nested invoice of its key: the adjustment is that one's.
    got = sorted((x["page_id"], x["record"].get("id"), x["record"]["total"], [a["total"] for a in x["record"]["invoice_adjustments"]],
                  [n.get("product_id") for n in x["record"]["line_items"]])
                 for x in map(json.loads, (r["value"] for r in spark.read.text(landed).collect())))
    assert got == [(7, "1", 1000, [], ["5", "5"]), (7, "1", 1000, [-20.0], ["5", "5"]), (7, "2", "n/a", [-10.0], []),
                   (8, "1", 2000, [], ["5", "5"]), (8, "1", 2000, [-20.0], ["5", "5"]), (9, None, 100, [], [])]


def test_landed_pages_shuffle_no_text(spark, tmp_path, monkeypatch):
    df = api_records.invoice_page_lines(spark, SF001)
    assert dealt_out_before_grouped(df) and "external_invoice" not in below_first_exchange(df)
    monkeypatch.setattr(api_records, "PAGE_SIZE", 1)
    folder = small_tables(spark, str(tmp_path))
    spark.read.parquet(f"{folder}/orders.parquet").unionByName(
        spark.read.parquet(f"{folder}/orders.parquet").where("o_orderkey = 2").selectExpr(
            "explode(array(3L, 5L)) AS o_orderkey", *["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    ).write.parquet(f"{tmp_path}/more/orders.parquet")
    for name in ("lineitem", "part"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/more/{name}.parquet")
    landed = api_records.landed_invoice_pages(spark, f"{tmp_path}/more")
    assert all(f.endswith(".txt.snappy") for f in os.listdir(landed) if f.startswith("part-"))
    texts = [r["value"] for r in spark.read.text(landed).collect()]
    whole = [json.loads(t)["data"] for t in texts if t.startswith('{"data"')]
    assert sorted(t for t in texts if not t.startswith('{"data"')) == ['{"error":"page 3: no answer"}', '{"page":5,"data":[{"id":']
    assert sorted((str(r.get("id")), r["total"]) for page in whole for r in page) == [
        ("1", 1000), ("1", 1000), ("1", 2000), ("1", 2000), ("2", "n/a"), ("None", 100)]
    assert all(r["external_invoice"] is None for page in whole for r in page)


def test_staged_outcomes_are_written_without_a_sort(spark, tmp_path):
    taken = intake.take_in(spark, api_records.landed_invoice_pages(spark, SF001), "invoice", str(tmp_path / "staged"))
    # Folders by outcome would mean that whole records are sorted first.
    assert [f for f in os.listdir(tmp_path / "staged") if "=" in f] == []
    assert taken.valid.count() + taken.rejects.count() + taken.pages.count() == spark.read.parquet(str(tmp_path / "staged")).count()


def test_grants_are_nested_after_the_last_exchange(spark, tmp_path):
    df = api_records.grant_records(spark, SF001)
    assert dealt_out_before_grouped(df) and "billing" not in below_first_exchange(df)
    got = {r["customer_id"]: r for r in api_records.grant_records(spark, small_tables(spark, str(tmp_path))).collect()}
    assert sorted(got) == ["7", "8"]
    # Sorted by time, then by amount; a line counts whether its part is known or not.
    assert [(d["amount"], d["running_balance"], d["invoice_id"]) for d in got["7"]["deductions"]] == [
        (0.0, 300.0, "1"), (0.0, 300.0, "1"), (200.0, 200.0, "1")]
    assert (got["8"]["balance"]["including_pending"], got["8"]["balance"]["excluding_pending"]) == (1000, 800)


def test_all_or_nothing_parses_once(spark, tmp_path):
    landed = api_records.landed_invoice_json(spark, small_tables(spark, str(tmp_path)))
    text = schemas.as_text_leaves(schemas.INVOICE)
    parsed = spark.read.schema(f"page_id long, record {text.simpleString()}").json(landed)
    valid, rejects = pages.validate_records(
        parsed, schemas.INVOICE, schemas.REQUIRED["invoice"], record_col="record", keep=["page_id"],
        all_or_nothing_by="page_id", timestamp_fields=schemas.TIMESTAMPS["invoice"], fields=["id", "total"])
    # Neither the bad pages nor the valid records read the text again.
    assert "FileScan json" not in plan_tree(valid) and valid.columns == ["page_id", "id", "total"]
    # Page 7 has a total that is no number, page 9 a record without an id.
    assert sorted(map(tuple, valid.collect())) == [(8, "1", 2000.0), (8, "1", 2000.0)]
    assert sorted((r["page_id"], *r["reasons"]) for r in rejects.collect()) == [(7, "total: not a number"), (9, "id: missing")]
    plain, _ = pages.validate_records(parsed, schemas.INVOICE, schemas.REQUIRED["invoice"], record_col="record", keep=["page_id"])
    assert plain.columns == ["page_id", *schemas.INVOICE.names] and plain.count() == 4


def test_a_table_of_many_rows_is_not_broadcast_however_small_its_files(spark, tmp_path):
    few, many, n = small_tables(spark, str(tmp_path / "few")), str(tmp_path / "many"), joins.MOST_BROADCAST_ROWS + 1
    rows = spark.range(n)
    rows.selectExpr("id AS p_partkey", "'LARGE' AS p_type", "'Brand#1' AS p_brand").write.parquet(f"{many}/part.parquet")
    rows.selectExpr("id AS o_orderkey", "1L AS o_custkey", "'F' AS o_orderstatus", "10D AS o_totalprice",
                    "timestamp_ntz'1998-03-01' AS o_orderdate", "'3-MEDIUM' AS o_orderpriority").write.parquet(f"{many}/orders.parquet")
    # Two lines of each known part, and two of a part that there is not.
    spark.range(2 * n + 2).selectExpr(
        "id AS l_orderkey", "id div 2 AS l_partkey", "1 AS l_linenumber", "1D AS l_quantity", "2D AS l_extendedprice", "0D AS l_discount",
        "timestamp_ntz'1998-03-01' AS l_shipdate").write.parquet(f"{many}/lineitem.parquet")
    files = [f for t in ("part", "orders") for f in (tmp_path / "many" / f"{t}.parquet").iterdir()]
    assert sum(f.stat().st_size for f in files) < 8_000_000  # under the threshold, as Spark counts them
    for make in (driver_tables.sub_line_items, api_records.invoice_records, api_records.invoice_json_lines, api_records.invoice_page_lines):
        assert "SortMergeJoin" in plan_tree(make(spark, many)) and "Broadcast" not in plan_tree(make(spark, many))
    assert driver_tables.sub_line_items(spark, many).count() == 2 * n
    assert "BroadcastHashJoin" in plan_tree(driver_tables.sub_line_items(spark, few))
