"""The expression helpers as Spark SQL functions.

SQL users (the reports were SQL strings in the source) register these
once per session and call them like built-ins.  They are SQL functions
(``CREATE TEMPORARY FUNCTION ... RETURN <expression>``): Catalyst inlines
the body into the plan, so there is no Python in the execution path,
unlike a registered Python UDF.  Each one has the same semantics as the
Column function of the same name (``tests/test_sql_functions.py``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_KV_BODY = "regexp_replace(p, '^[{]|[}]$', '')"
_KV_HIT = f"get(filter(split({_KV_BODY}, ', '), x -> instr(x, '=') > 0 AND substring_index(x, '=', 1) = k), 0)"

# name -> (parameters, return type, body); bodies may use earlier names.
SQL_FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "kv_get": ("p STRING, k STRING", "STRING", f"substr({_KV_HIT}, instr({_KV_HIT}, '=') + 1)"),
    "kv_map": ("p STRING", "MAP<STRING, STRING>",
               f"CASE WHEN p IS NOT NULL THEN str_to_map({_KV_BODY}, ', ', '=') END"),
    "to_cents": ("x DOUBLE", "BIGINT", "CAST(round(x * 100.0D, 0) AS BIGINT)"),
    "round_2": ("x DOUBLE", "DOUBLE", "round(x * 100.0D, 0) / 100.0D"),
    "divide_safe": ("a DOUBLE, b DOUBLE", "DOUBLE", "try_divide(a, b)"),
    "money_text": ("cents BIGINT", "STRING",
                   "regexp_replace(CAST(CAST(CAST(cents AS DECIMAL(38,0)) / 100 AS DECIMAL(38,2)) AS STRING), "
                   "'0$', '')"),
    "format_money": ("cents BIGINT, prefix STRING, suffix STRING", "STRING",
                     "concat(prefix, money_text(cents), suffix)"),
    "pydict_to_json": ("t STRING", "STRING",
                       "regexp_replace(regexp_replace(regexp_replace(t, "
                       "'(?<=[:\\\\[,]\\\\s?)None(?=\\\\s*[,}\\\\]])', 'null'), "
                       "'(?<=[:\\\\[,]\\\\s?)True(?=\\\\s*[,}\\\\]])', 'true'), "
                       "'(?<=[:\\\\[,]\\\\s?)False(?=\\\\s*[,}\\\\]])', 'false')"),
}


def register_sql_functions(spark: SparkSession, force: bool = False) -> list[str]:
    """Create the temporary SQL functions in this session (once; ``force``
    replaces existing definitions)."""
    for name, (params, returns, body) in SQL_FUNCTIONS.items():
        if force or not spark.catalog.functionExists(name):
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
    return list(SQL_FUNCTIONS)
