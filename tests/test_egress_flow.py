"""Egress flow end to end: billing tables exported as CSV files named
``<prefix> - <table>.csv`` in a folder tree, loaded back with declared
schemas, and the reports compared with the same reports over parquet."""
import glob
import os
import shutil

from conftest import SF001

from ledgerline.plans import reports
from ledgerline.sources import driver_tables as dt
from ledgerline.sources import egress
from ledgerline.sources.sinks import write_csv

SCHEMAS = {
    "customer": "id bigint, name string",
    "plan": "id string, name string",
    "invoice": ("id bigint, customer_id bigint, plan_id string, plan_name string, status string, "
                "issued_at timestamp_ntz, start_timestamp timestamp_ntz, end_timestamp timestamp_ntz, total bigint"),
    "line_item": "id string, invoice_id bigint, product_id string, name string, total bigint, quantity double",
    "sub_line_item": ("line_item_id string, invoice_id bigint, line_number int, charge_id string, "
                      "billable_metric_id string, billable_metric_name string, line_item_name string, "
                      "quantity double, subtotal bigint"),
    "events": "event_id bigint, event_type string, customer_id bigint, timestamp timestamp_ntz, value double, "
              "properties string",
}


def _export(spark, views, root):
    for name, df in views.items():
        tmp = os.path.join(root, "_tmp_" + name)
        write_csv(df, tmp, single_file=True)
        part = glob.glob(os.path.join(tmp, "part-*.csv"))[0]
        sub = os.path.join(root, "facts" if name in ("invoice", "line_item", "sub_line_item") else "dims")
        os.makedirs(sub, exist_ok=True)
        shutil.copy(part, os.path.join(sub, f"Sample Egress Data - {name}.csv"))
        shutil.rmtree(tmp)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_reports_over_csv_equal_reports_over_parquet(spark, tmp_path):
    views = dt.billing_views(spark, SF001)
    root = str(tmp_path / "egress")
    _export(spark, views, root)
    tables = egress.load_egress_dir(spark, root, schemas=SCHEMAS)
    declared = {n: spark.createDataFrame([], s).schema for n, s in SCHEMAS.items()}
    assert sorted(tables) == sorted(SCHEMAS)
    for name, df in tables.items():
        assert df.schema == declared[name]

    def billings(t):
        return reports.billings_by_plan(t["invoice"], t["plan"], t["customer"], "1998-01-01", "1998-12-31")

    def usage(t):
        return reports.usage_by_attribute(t["events"], t["customer"], "2024-01-10", "2024-01-25",
                                          ["click", "view"], "size", "num")

    def lines(t):
        return reports.invoice_lines(t["customer"], t["invoice"], t["line_item"], t["sub_line_item"],
                                     "Customer#000000014", "1995-01-01", "2001-12-31")

    for build in (billings, usage, lines):
        a, b = _rows(build(tables)), _rows(build(views))
        assert a == b and len(a) > 0


def test_statement_from_grants_exported_with_dict_text(spark, tmp_path):
    import pandas as pd
    from pyspark.sql.types import ArrayType

    from ledgerline import schemas
    grants = [
        {"id": "g1", "customer_id": "c1", "reason": None,
         "balance": {"including_pending": 5, "excluding_pending": None, "effective_at": "2024-03-01"},
         "deductions": [{"amount": 1.0, "reason": "it's usage", "running_balance": 82630.0,
                         "effective_at": "2024-03-02", "created_by": "x", "credit_grant_id": "g1",
                         "invoice_id": None}],
         "grant_amount": {"amount": 100.0, "credit_type": {"id": "USD", "name": "USD"}}},
        {"id": "g2", "customer_id": "c2", "reason": None, "balance": None, "deductions": [],
         "grant_amount": {"amount": 5.0, "credit_type": {"id": "USD", "name": "USD"}}},
    ]
    path = str(tmp_path / "credit_balances.csv")
    pd.DataFrame(grants).to_csv(path, index=False)       # nested values become Python repr text
    raw = egress.read_csv(spark, path, schema="id string, customer_id string, reason string, balance string, "
                                              "deductions string, grant_amount string")
    typed = egress.parse_dict_text_columns(raw, {"balance": schemas.BALANCE,
                                                 "deductions": ArrayType(schemas.DEDUCTION),
                                                 "grant_amount": schemas.AMOUNT})
    row = typed.where("id = 'g1'").collect()[0]
    assert row.balance.excluding_pending is None and row.deductions[0].reason == "it's usage"
    customers = spark.createDataFrame([("c1", "A1 Company"), ("c2", "B1 Company")], "id string, name string")
    invoices = spark.createDataFrame([], "id string, customer_id string, status string, "
                                         "end_timestamp timestamp_ntz, total bigint")
    out = reports.customer_statement(customers, invoices, typed)
    assert [(r.name, r.credit_balance) for r in out.collect()] == [("A1 Company", "$826.3 USD"),
                                                                    ("B1 Company", None)]
