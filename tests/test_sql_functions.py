"""SQL functions agree with the Column functions of the same name."""
from pyspark.sql import functions as F

from ledgerline.functions import money, parsing
from ledgerline.functions.sql_functions import register_sql_functions


def test_sql_functions_match_column_functions(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([
        ("{image_size=1024x1024, num_images=3}", 82630, 1.005, 2.0, 0.0,
         "{'a': None, 'b': True, 'c': 'None here', 'd': [False]}"),
        ("{a=b=c, a=2, note=x, y}", 1_000_000_000, 0.285, 1.0, 3.0, "{'x': 1}"),
        (None, None, None, None, None, None),
    ], "p string, cents bigint, x double, a double, b double, t string")
    df.createOrReplaceTempView("fn_input")
    sql = spark.sql("""
        SELECT kv_get(p, 'image_size') AS s, kv_get(p, 'a') AS a1, kv_get(p, 'y') AS y,
               to_cents(x) AS c, round_2(x) AS r, divide_safe(a, b) AS d, money_text(cents) AS mt,
               format_money(cents, '$', ' USD') AS fm, pydict_to_json(t) AS j
        FROM fn_input""").collect()
    cols = df.select(
        parsing.kv_get(F.col("p"), "image_size").alias("s"), parsing.kv_get(F.col("p"), "a").alias("a1"),
        parsing.kv_get(F.col("p"), "y").alias("y"),
        money.to_cents("x").alias("c"), money.round_2("x").alias("r"), money.divide_safe("a", "b").alias("d"),
        money.amount_text("cents").alias("mt"), money.format_money("cents").alias("fm"),
        parsing.pydict_text_to_json(F.col("t")).alias("j")).collect()
    assert [r.asDict() for r in sql] == [r.asDict() for r in cols]
    assert sql[0].j == "{'a': null, 'b': true, 'c': 'None here', 'd': [false]}"
    # the map form (str_to_map raises on a repeated key, in both forms)
    m_sql = spark.sql("SELECT kv_map(p) AS m FROM fn_input WHERE p IS NULL OR p NOT LIKE '%a=%'").collect()
    m_col = df.where("p IS NULL OR p NOT LIKE '%a=%'").select(parsing.kv_to_map(F.col("p")).alias("m")).collect()
    assert m_sql == m_col and m_sql[0].m == {"image_size": "1024x1024", "num_images": "3"}


def test_reference_style_sql_over_views(spark):
    from conftest import SF001

    from ledgerline.plans import reports
    from ledgerline.sources import driver_tables as dt
    dt.register_billing_views(spark, SF001)
    got = spark.sql("""
        SELECT name, customer_id, kv_get(properties, 'size') AS size,
               CAST(SUM(CAST(kv_get(properties, 'num') AS INT)) AS BIGINT) AS total_num
        FROM events e LEFT JOIN customer c ON e.customer_id = c.id
        WHERE timestamp >= TIMESTAMP_NTZ '2024-01-10' AND timestamp <= TIMESTAMP_NTZ '2024-01-25'
          AND event_type IN ('click') AND properties IS NOT NULL AND kv_get(properties, 'size') IS NOT NULL
        GROUP BY 1, 2, 3""")
    want = reports.usage_by_attribute(dt.events(spark, SF001), dt.customers(spark, SF001), "2024-01-10",
                                      "2024-01-25", ["click"], "size", "num")
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())
