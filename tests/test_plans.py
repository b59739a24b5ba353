"""Physical-plan shape checks for the scale properties the reports rely on."""
import contextlib
import io

from conftest import SF01

import __spark_entry__ as E


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_invoice_lines_filters_line_tables_at_the_scan(spark):
    text = plan_text(E.queries()["invoice_lines"](spark, SF01))
    # the semi-join reduction is a broadcast join, not a shuffle of lineitem
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    assert "PushedFilters: [IsNotNull(c_name), EqualTo(c_name,Customer#000000058)" in text


def test_validation_parses_json_in_the_scan(spark):
    text = plan_text(E.queries()["validate_records"](spark, SF01))
    assert "Scan json" in text
    assert "from_json" not in text


def test_reports_aggregate_before_joining(spark):
    text = plan_text(E.queries()["billings_by_plan"](spark, SF01))
    first_join = text.index("Join")
    assert "partial_sum" in text[first_join:]           # pre-aggregate below the joins
    usage = plan_text(E.queries()["usage_by_attribute"](spark, SF01))
    assert usage.count("HashAggregate") >= 4


def test_filters_and_columns_reach_the_parquet_scan(spark):
    text = plan_text(E.queries()["filter_between"](spark, SF01))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_latest_per_key_is_an_aggregate_not_a_window(spark):
    text = plan_text(E.queries()["latest_per_key"](spark, SF01))
    assert "partial_max_by" in text and "Window" not in text


def test_status_filter_reaches_the_scan(spark):
    for name in ("filter_eq", "filter_mask", "slice_totals", "latest_per_key"):
        assert "EqualTo(o_orderstatus,F)" in plan_text(E.queries()[name](spark, SF01))


def test_line_reports_scan_the_lines_twice_at_most(spark):
    for name in ("invoice_lines", "join_left_chain"):
        text = plan_text(E.queries()[name](spark, SF01))
        assert text.count("lineitem.parquet]") <= 2
