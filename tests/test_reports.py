"""Reports on hand-made billing tables (edge cases of the source)."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerline.plans import reports

D = dt.datetime


def test_customer_statement_edges(spark):
    customers = spark.createDataFrame([("c1", "Beta"), ("c2", "Acme"), ("c3", None), ("c4", "Zed")],
                                      "id string, name string")
    invoices = spark.createDataFrame([
        ("i1", "c1", "FINALIZED", D(2024, 2, 1), 50000),
        ("i2", "c1", "FINALIZED", D(2024, 3, 1), 162904),
        ("i3", "c1", "DRAFT", D(2024, 4, 1), 999),
        ("i4", "c2", "FINALIZED", D(2024, 3, 1), 0),      # tied end_timestamp: larger id wins
        ("i5", "c2", "FINALIZED", D(2024, 3, 1), 1_000_000_000),
    ], "id string, customer_id string, status string, end_timestamp timestamp_ntz, total bigint")
    grants = spark.createDataFrame([
        ("c1", {"including_pending": 1}, [{"running_balance": 82630.0}, {"running_balance": 5.0}]),
        ("c1", None, [{"running_balance": 7.0}]),                  # no balance: ignored
        ("c2", {"including_pending": 0}, [{"running_balance": 0.0}]),
        ("c4", {"including_pending": 0}, []),                       # no deduction: null sum
    ], "customer_id string, balance struct<including_pending:bigint>, "
       "deductions array<struct<running_balance:double>>")
    out = reports.customer_statement(customers, invoices, grants)
    rows = [(r.name, r.current_invoice_balance, r.credit_balance) for r in out.collect()]
    assert rows == [("Acme", "$10000000.0 USD", "$0.0 USD"), ("Beta", "$1629.04 USD", "$826.3 USD"),
                    ("Zed", None, None), (None, None, None)]


def test_usage_by_attribute_edges(spark):
    events = spark.createDataFrame([
        ("e1", "b1", D(2024, 3, 10), "image_modeler", "{image_size=1024x1024, num_images=3}"),
        ("e2", "b1", D(2024, 3, 25), "image_modeler", "{image_size=512×512, num_images=4}"),
        ("e3", "b1", D(2024, 3, 25, 0, 0, 1), "image_modeler", "{image_size=512×512, num_images=5}"),
        ("e4", "b1", D(2024, 3, 12), "image_modeler", "{num_images=5}"),
        ("e5", "a1", D(2024, 3, 12), "other", "{image_size=1024x1024, num_images=9}"),
        ("e6", "a1", D(2024, 3, 12), "image_modeler", None),
    ], "event_id string, customer_id string, timestamp timestamp_ntz, event_type string, properties string")
    customers = spark.createDataFrame([("a1", "A1 Company")], "id string, name string")
    out = reports.usage_by_attribute(events, customers, "2024-03-10", "2024-03-25", ["image_modeler"],
                                     "image_size", "num_images", total_alias="total_images")
    rows = [(r.name, r.customer_id, r.image_size, r.total_images) for r in out.collect()]
    assert rows == [(None, "b1", "1024x1024", 3), (None, "b1", "512×512", 4)]
    whole = reports.usage_by_attribute(events, customers, "2024-03-10", "2024-03-25", ["image_modeler"],
                                       "image_size", "num_images", whole_last_day=True)
    assert sorted(r["total_num_images"] for r in whole.collect()) == [3, 9]


def _egress(spark):
    customer = spark.createDataFrame([("a1", "A1 Company"), ("b1", "B1 Company")], "id string, name string")
    invoice = spark.createDataFrame([
        ("i1", "a1", "p1", "FINALIZED", D(2024, 3, 1), D(2024, 3, 1), D(2024, 3, 31), 7163),
        ("i2", "b1", "p2", "FINALIZED", D(2024, 3, 5), D(2024, 3, 1), D(2024, 3, 31), 922),
        ("i3", "b1", "p2", "FINALIZED", D(2024, 3, 6), D(2024, 3, 1), D(2024, 3, 31), 2000),
        ("i4", "a1", "p1", "DRAFT", D(2024, 4, 1), D(2024, 4, 1), D(2024, 4, 30), 5),
    ], "id string, customer_id string, plan_id string, status string, issued_at timestamp_ntz, "
       "start_timestamp timestamp_ntz, end_timestamp timestamp_ntz, total bigint")
    plan = spark.createDataFrame([("p1", "Infra SaaS Paygo"), ("p2", "Free Plan")], "id string, name string")
    line_item = spark.createDataFrame([("l1", "i1", "CPU Hours"), ("l2", "i1", "Storage")],
                                      "id string, invoice_id string, name string")
    sub = spark.createDataFrame([
        ("l1", "CPU hours (c5.4xlarge)", 25.0, 25),
        ("l1", "CPU hours (c5.4xlarge)", 0.0, 10),
        ("l2", "Storage GB-Hours (us-east-1)", 6347.25, 635),
        ("l2", "Free tier", 0.0, 0),
    ], "line_item_id string, billable_metric_name string, quantity double, subtotal bigint")
    return customer, invoice, plan, line_item, sub


def test_invoice_lines_rounding_zero_quantity_and_modes(spark):
    customer, invoice, _, line_item, sub = _egress(spark)
    out = reports.invoice_lines(customer, invoice, line_item, sub, "A1 Company", "2024-02-29", "2024-03-31")
    rows = [(r.line_item_name, r.Description, r.Quantity, r["Unit Price"], r.Total) for r in out.collect()]
    assert rows == [("CPU Hours", "CPU hours (c5.4xlarge)", 25.0, "$0.01 USD", "$0.25"),
                    ("Storage", "Free tier", 0.0, None, "$0.0"),
                    ("Storage", "Storage GB-Hours (us-east-1)", 6347.25, "$0.0 USD", "$6.35")]
    summed = reports.invoice_lines(customer, invoice, line_item, sub, "A1 Company", "2024-02-29", "2024-03-31",
                                   total_agg="sum")
    assert summed.collect()[0].Total == "$0.35"
    none = reports.invoice_lines(customer, invoice, line_item, sub, "A1 Company", "2024-02-29", "2024-03-31",
                                 status="VOID")
    assert none.count() == 0


def test_billings_by_plan_orders(spark):
    customer, invoice, plan, _, _ = _egress(spark)
    out = reports.billings_by_plan(invoice, plan, customer, "2024-03-01", "2024-03-31")
    assert [(r.plan_name, r.customer_name, r.total_billed) for r in out.collect()] == [
        ("Infra SaaS Paygo", "A1 Company", "$71.63USD"), ("Free Plan", "B1 Company", "$29.22USD")]
    legacy = reports.billings_by_plan(invoice, plan, customer, "2024-03-01", "2024-03-31",
                                      legacy_string_order=True)
    assert [r.total_billed for r in legacy.collect()] == ["$71.63USD", "$29.22USD"]
    one = reports.billings_by_plan(invoice, plan, customer, "2024-03-01", "2024-03-31", customer_name="A1 Company")
    assert one.count() == 1


def test_invoice_slices_and_summary(spark):
    inv = spark.createDataFrame([
        ("FINALIZED", 100.0, -2.0, "p1"), ("FINALIZED", 0.0, None, "p1"), ("DRAFT", 50.0, None, "p2"),
        ("FINALIZED", 30.0, None, "p2")], "status string, total double, invoice_adjustments_0_total double, plan string")
    out = reports.invoice_slices(inv, ["plan"], customer_name="A1 Company")
    assert [(r.plan, r.total) for r in out.collect()] == [("p1", 100.0), ("p2", 30.0)]
    s = reports.customer_summary(inv.withColumn("customer_id", F.lit("c")).withColumn("subtotal", F.lit(1.0)))
    assert s.collect()[0].total == 180.0


def test_billings_by_plan_duplicate_customer_names_merge(spark):
    customer = spark.createDataFrame([("a1", "Same Name"), ("a2", "Same Name")], "id string, name string")
    plan = spark.createDataFrame([("p1", "Paygo")], "id string, name string")
    invoice = spark.createDataFrame([
        ("i1", "a1", "p1", D(2024, 3, 2), 100), ("i2", "a2", "p1", D(2024, 3, 3), 250),
    ], "id string, customer_id string, plan_id string, issued_at timestamp_ntz, total bigint")
    out = reports.billings_by_plan(invoice, plan, customer, "2024-03-01", "2024-03-31").collect()
    # grouped by the names, as the report's GROUP BY plan name, customer name does
    assert [(r.plan_name, r.customer_name, r.total_billed) for r in out] == [("Paygo", "Same Name", "$3.5USD")]
