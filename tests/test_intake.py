"""Pages taken in: one parse, three outcomes, nothing lost."""
import json
import os

from conftest import SF01
from test_io import INV_OK, _write_lines

from ledgerline import schemas
from ledgerline.sources import api_records, intake, pages
from ledgerline.streaming.landed_pages import start_ingest

USD = {"id": "USD", "name": "USD"}
GRANT = {"id": "g", "name": "n", "customer_id": "c", "reason": None, "effective_at": "2024-01-01", "expires_at": "2025-01-01",
         "priority": 1, "grant_amount": {"amount": 5, "credit_type": USD}, "paid_amount": {"amount": 5, "credit_type": USD},
         "balance": {"effective_at": "2024-01-01"},
         "deductions": [{"amount": 1, "reason": "r", "running_balance": 2, "effective_at": "t", "created_by": "me",
                         "credit_grant_id": "g", "invoice_id": None}]}


def invoice(key, drop=(), **change):
    return {k: v for k, v in dict(INV_OK, id=key, **change).items() if k not in drop}


def grant(key, change=lambda g: None):
    copy = json.loads(json.dumps(dict(GRANT, id=key)))
    change(copy)
    return copy


def write(path, lines):
    path.parent.mkdir(exist_ok=True, parents=True)
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    return str(path)


PAGES = [{"data": [invoice("ok1"), invoice("bad", total="n/a"), None, invoice("odd", credit_type=5), invoice("ok2")]},
         {"error": "down"}, '{"data":[{"id":"z"', '{"data":{"id":"q"}}', "[1,2]", '"text"', {"data": []}, {"next_page": None},
         {"data": [invoice("null", external_invoice=None), invoice("missing", drop=["external_invoice"])]}]
VALID = ["null", "ok1", "ok2"]
REJECTS = {"bad": ["total: not a number"], "odd": ["record: does not fit the schema"], None: ["record: missing"],
           "missing": ["external_invoice: missing"]}
LOST = ['"text"', "[1,2]", "down", '{"data":[{"id":"z"', '{"data":{"id":"q"}}']


def told(taken):
    rejects = {(json.loads(r["record"]) or {}).get("id"): list(r["reasons"]) for r in taken.rejects.collect()}
    return (sorted(r["id"] for r in taken.valid.collect()), rejects,
            sorted(r["message"].removeprefix("unreadable page: ") for r in taken.pages.collect()))


def test_every_page_and_record_has_one_outcome(spark, tmp_path):
    path = write(tmp_path / "in" / "p.json", PAGES)
    taken = intake.take_in(spark, path, "invoice", str(tmp_path / "staged"))
    assert told(taken) == (VALID, REJECTS, sorted(LOST))
    # 7 records and 5 pages without readable records went in.
    assert spark.read.parquet(str(tmp_path / "staged")).count() == 12
    row = taken.valid.where("id = 'ok1'").first()
    assert row["total"] == 7163.0 and row["line_items"][0]["quantity"] == 25.5 and str(row["end_timestamp"]) == "2024-03-31 00:00:00"
    whole = intake.take_in(spark, path, "invoice", all_or_nothing=True)
    assert whole.valid.count() == 0 and whole.rejects.count() == 4
    write(tmp_path / "in" / "q.json", [{"data": [invoice("alone")]}])
    whole = intake.take_in(spark, str(tmp_path / "in"), "invoice", all_or_nothing=True)
    assert [r["id"] for r in whole.valid.collect()] == ["alone"]


def test_envelopes_that_span_lines(spark, tmp_path):
    write(tmp_path / "in" / "a.json", [json.dumps({"data": [invoice("a"), invoice("b", credit_type="x")]}, indent=2)])
    write(tmp_path / "in" / "b.json", ['{"data": [\n {"id": '])
    taken = intake.take_in(spark, str(tmp_path / "in"), "invoice", multi_line=True)
    valid, rejects, lost = told(taken)
    assert valid == ["a"] and rejects == {"b": ["record: does not fit the schema"]} and len(lost) == 1


def test_missing_null_and_defaults(spark, tmp_path):
    def pending(value):
        return lambda g: g["balance"].update(including_pending=value)

    records = [grant("default"), grant("five", pending(5.0)), grant("text", pending(" 7 ")), grant("null", pending(None)),
               grant("half", pending(5.5)), grant("word", pending("5x")), grant("no reason", lambda g: g.pop("reason")),
               grant("no invoice", lambda g: g["deductions"][0].pop("invoice_id")),
               grant("pending", lambda g: g.update(pending_deductions=[dict(GRANT["deductions"][0], invoice_id="i")])),
               grant("no balance", lambda g: g.pop("balance")), grant("big", pending(2 ** 62))]
    taken = intake.take_in(spark, write(tmp_path / "g.json", [{"data": records}]), "credit_grant")
    valid = {r["id"]: r for r in taken.valid.collect()}
    assert {k: (r["balance"]["including_pending"], r["balance"]["excluding_pending"]) for k, r in valid.items()} == {
        "default": (0, 0), "five": (5, 0), "text": (7, 0), "null": (None, 0), "pending": (0, 0), "big": (2 ** 62, 0)}
    assert valid["default"]["pending_deductions"] == [] and valid["pending"]["pending_deductions"][0]["invoice_id"] == "i"
    assert told(taken)[1] == {
        "half": ["balance.including_pending: not a number"], "word": ["balance.including_pending: not a number"],
        "no reason": ["reason: missing"], "no invoice": ["deductions[].invoice_id: missing"],
        "no balance": ["balance: missing"]}


def test_reasons_name_each_nested_path_once(spark, tmp_path):
    record = json.loads(json.dumps(INV_OK))
    line = record["line_items"][0]
    line["quantity"] = "x"
    line["sub_line_items"] = [dict(line["sub_line_items"][0], price="y") for _ in range(2)]
    record["line_items"] = [line, line]
    taken = intake.take_in(spark, write(tmp_path / "p.json", [{"data": [record]}]), "invoice")
    assert taken.rejects.first()["reasons"] == [
        "line_items[].quantity: not a number; line_items[].sub_line_items[].price: not a number"]


def test_stream_loses_nothing(spark, tmp_path):
    landing, out, marks = str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "marks")
    write(tmp_path / "landing" / "a.json", PAGES)
    start_ingest(spark, landing, out, marks).awaitTermination(180)
    _write_lines(os.path.join(landing, "b.json"), [{"data": [invoice("later")]}, {"error": "again"}])
    start_ingest(spark, landing, out, marks).awaitTermination(180)
    read = lambda name: spark.read.parquet(os.path.join(out, name))
    valid, rejects, lost = told(intake.Intake(read("valid"), read("rejects"), read("pages")))
    assert (valid, rejects, lost) == (sorted([*VALID, "later"]), REJECTS, sorted([*LOST, "again"]))


def test_typed_pages_are_records_or_errors(spark, tmp_path):
    path = write(tmp_path / "p.json", PAGES)
    read = pages.read_pages(spark, path, schemas.INVOICE)
    for columns in (["id"], ["id", "total"], ["status"]):
        assert pages.explode_pages(read).select(*columns).count() == 2
    errors = [r["error"] for r in pages.page_errors(read).collect()]
    assert len(errors) == 6 and pages.page_errors(read).select("source_file").count() == 6
    # A bad number alone, in a page that is whole otherwise.
    path = write(tmp_path / "q.json", [{"data": [invoice("a"), invoice("b", total="n/a"), invoice("c", subtotal="5.0")]}])
    read = pages.read_pages(spark, path, schemas.INVOICE)
    assert pages.explode_pages(read).count() == 0
    assert [r["error"] for r in pages.page_errors(read).collect()] == ["data: not a number"]


def test_outcomes_add_up_to_the_input(spark):
    path = api_records.landed_invoice_pages(spark, SF01)
    taken = intake.take_in(spark, path, "invoice")
    n = spark.read.parquet(f"{SF01}/orders.parquet").selectExpr("floor(o_orderkey / 100) AS p").groupBy("p").count().collect()
    lost = {r["p"] for r in n if r["p"] % 7 in (3, 5)}
    assert taken.pages.count() == len(lost) > 0
    assert taken.valid.count() + taken.rejects.count() == sum(r["count"] for r in n if r["p"] not in lost)


def test_intake_reads_its_input_once(spark, tmp_path):
    found = intake.classify(intake.read_envelopes(spark, write(tmp_path / "p.json", PAGES), "invoice"), "invoice")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1 and "Exchange" not in plan
