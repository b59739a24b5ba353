"""DuckDB SQL for the billing views, used by the oracle queries.

These restate the mapping of ``sources/driver_tables.py`` and
``sources/api_records.py`` in plain SQL over the driver tables, written
independently of the Spark code so the oracle checks the Spark plans
rather than sharing their logic.
"""

from __future__ import annotations

VIEWS = {
    "bcustomer": "SELECT c_custkey AS id, c_name AS name FROM customer",
    "bplan": ("SELECT DISTINCT substr(o_orderpriority, 1, 1) AS id, "
              "regexp_extract(o_orderpriority, '^[^-]*-(.*)$', 1) AS name FROM orders"),
    "binvoice": (
        "SELECT o_orderkey AS id, o_custkey AS customer_id, substr(o_orderpriority, 1, 1) AS plan_id, "
        "regexp_extract(o_orderpriority, '^[^-]*-(.*)$', 1) AS plan_name, "
        "CASE o_orderstatus WHEN 'F' THEN 'FINALIZED' WHEN 'O' THEN 'DRAFT' WHEN 'P' THEN 'VOID' END AS status, "
        "o_orderdate AS issued_at, o_orderdate AS start_timestamp, o_orderdate AS end_timestamp, "
        "CAST(round(o_totalprice * 100) AS BIGINT) AS total, o_orderpriority FROM orders"),
    "bsub": (
        "SELECT CAST(l_orderkey AS VARCHAR) || ':' || p_type AS line_item_id, l_orderkey AS invoice_id, "
        "l_linenumber AS line_number, CAST(l_partkey AS VARCHAR) AS charge_id, "
        "p_brand AS billable_metric_id, p_brand AS billable_metric_name, p_type AS line_item_name, "
        "l_quantity AS quantity, CAST(round(l_extendedprice * 100) AS BIGINT) AS subtotal "
        "FROM lineitem JOIN part ON l_partkey = p_partkey"),
    "bline": (
        "SELECT line_item_id AS id, invoice_id, line_item_name AS product_id, line_item_name AS name, "
        "CAST(sum(subtotal) AS BIGINT) AS total, sum(quantity) AS quantity "
        "FROM bsub GROUP BY line_item_id, invoice_id, line_item_name"),
    "bevents": (
        "SELECT event_id, event_type, user_id AS customer_id, ts AS \"timestamp\", value, "
        "'{size=' || event_type || ', num=' || json_extract_string(props, '$.k') || '}' AS properties "
        "FROM events"),
    # One credit grant per order with lines.
    "bgrant": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_totalprice, o_orderpriority, "
        "CAST(sum(round(l_extendedprice * 100)) AS BIGINT) AS gross, "
        "CAST(sum(round(l_extendedprice * (1.0 - l_discount) * 100)) AS BIGINT) AS net "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
        "GROUP BY o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_totalprice, o_orderpriority"),
    # Deductions ranked in the grant's array order.
    "bded": (
        "SELECT l_orderkey, effective_at, amount, running_balance, "
        "row_number() OVER (PARTITION BY l_orderkey ORDER BY effective_at, amount, running_balance) - 1 AS pos "
        "FROM (SELECT l_orderkey, CAST(l_shipdate AS VARCHAR) AS effective_at, "
        "CAST(round(l_extendedprice * l_discount * 100) AS DOUBLE) AS amount, "
        "CAST(round(l_extendedprice * (1.0 - l_discount) * 100) AS DOUBLE) AS running_balance FROM lineitem)"),
    # Invoice lines in the nested record's order.
    "blines_ranked": (
        "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_discount, p_type, p_brand, "
        "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, "
        "l_extendedprice, l_discount) - 1 AS pos FROM lineitem JOIN part ON l_partkey = p_partkey"),
}

ORDER = list(VIEWS)


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs, in dependency order.

    ``body`` may start with ``, name AS (...)`` to add its own CTEs after
    the views."""
    needed = set(names)
    if "bline" in needed:
        needed.add("bsub")
    ctes = [f"{n} AS ({VIEWS[n]})" for n in ORDER if n in needed]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body


def money_sql(cents_expr: str, suffix: str = " USD") -> str:
    """The oracle's display string: a double rounded to 2 places."""
    return f"'$' || CAST(round(({cents_expr}) / 100, 2) AS VARCHAR) || '{suffix}'"
