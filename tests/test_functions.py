"""Money formatting and text parsing on hand-made edge inputs."""
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import money, parsing


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_format_money_shapes(spark):
    data = [(82630,), (0,), (162904,), (1_000_000_000,), (1_234_567_890,), (None,), (-5,)]
    got = one(spark, money.format_money(F.col("c")), data, "c bigint")
    # no scientific notation from 10,000,000 up; one trailing zero dropped
    assert got == ["$826.3 USD", "$0.0 USD", "$1629.04 USD", "$10000000.0 USD", "$12345678.9 USD", None,
                   "$-0.05 USD"]


def test_format_money_layouts(spark):
    data = [(7163,), (None,)]
    assert one(spark, money.format_money(F.col("c"), suffix="USD"), data, "c bigint") == ["$71.63USD", None]
    assert one(spark, money.format_money(F.col("c"), suffix=""), data, "c bigint") == ["$71.63", None]
    legacy = one(spark, money.format_money(F.col("c"), legacy_null_concat=True), data, "c bigint")
    assert legacy == ["$71.63 USD", "$ USD"]


def test_round_2_half_cases(spark):
    got = one(spark, money.round_2(F.col("v")), [(1.005,), (2.675,), (0.125,), (-0.125,), (None,)], "v double")
    # rounding is on the double value times 100: 1.005 * 100 = 100.49999...
    assert got == [1.0, 2.68, 0.13, -0.13, None]


def test_divide_safe_zero_and_null(spark):
    got = one(spark, money.divide_safe(F.col("a"), F.col("b")), [(1.0, 0.0), (1.0, None), (3.0, 2.0)],
              "a double, b double")
    assert got == [None, None, 1.5]


def test_to_cents(spark):
    got = one(spark, money.to_cents(F.col("v")), [(1629.04,), (0.285,), (None,)], "v double")
    # 0.285 * 100 is 28.4999... as a double, so it rounds down (as SQL round does)
    assert got == [162904, 28, None]


def test_kv_get_first_occurrence_and_equals_in_value(spark):
    data = [("{image_size=1024x1024, num_images=3}",), ("{a=1, a=2}",), ("{a=b=c}",), ("{x=1}",), (None,),
            ("{image_size=512×512, num_images=4}",)]
    df = spark.createDataFrame(data, "p string")
    rows = df.select(parsing.kv_get(F.col("p"), "image_size").alias("s"),
                     parsing.kv_get(F.col("p"), "a").alias("a"),
                     parsing.kv_get(F.col("p"), "num_images").alias("n")).collect()
    assert [r.s for r in rows] == ["1024x1024", None, None, None, None, "512×512"]
    assert [r.a for r in rows] == [None, "1", "b=c", None, None, None]
    assert [r.n for r in rows] == ["3", None, None, None, None, "4"]


def test_kv_to_map(spark):
    df = spark.createDataFrame([("{size=big, num=3}",), (None,)], "p string")
    rows = df.select(parsing.kv_to_map(F.col("p")).alias("m")).collect()
    assert rows[0].m == {"size": "big", "num": "3"}
    assert rows[1].m is None


def test_pydict_apostrophe_none_bool(spark):
    text = [("{'including_pending': 5, 'excluding_pending': None, 'effective_at': '2024-03-01'}",),
            ("{'name': \"it's\", 'flag': True, 'other': False}",),
            ("{'name': 'None of it', 'flag': None}",)]
    df = spark.createDataFrame(text, "t string")
    b = df.select(parsing.pydict_to_struct(F.col("t"), schemas.BALANCE).alias("b")).collect()[0].b
    assert (b.including_pending, b.excluding_pending, b.effective_at) == (5, None, "2024-03-01")
    rows = df.select(parsing.pydict_to_struct(F.col("t"), "name string, flag boolean, other boolean")
                     .alias("s")).collect()
    assert (rows[1].s.name, rows[1].s.flag, rows[1].s.other) == ("it's", True, False)
    assert (rows[2].s.name, rows[2].s.flag) == ("None of it", None)


def test_json_path_null_and_missing(spark):
    df = spark.createDataFrame([('{"k": null}',), ('{"j": 1}',), ('{"k": "v"}',), ('{"k": 7}',)], "t string")
    got = [r.x for r in df.select(parsing.json_path("t", "$.k").alias("x")).collect()]
    assert got == [None, None, "v", "7"]


def test_json_array_first(spark):
    df = spark.createDataFrame([([{"a": 1.0}, {"a": 2.0}],), ([],), (None,)], "arr array<struct<a:double>>")
    got = [r.x for r in df.select(parsing.json_array_first("arr", "a").alias("x")).collect()]
    assert got == [1.0, None, None]
    t = spark.createDataFrame([('[{"running_balance": 5}]',), ("[]",)], "t string")
    got = [r.x for r in t.select(parsing.json_text_array_first("t", "running_balance").alias("x")).collect()]
    assert got == ["5", None]


def test_casts(spark):
    df = spark.createDataFrame([(2.7, "12"), (-2.5, "x")], "v double, s string")
    rows = df.select(parsing.to_int_rounded("v").alias("r"), parsing.cast_lenient("s", "int").alias("i")).collect()
    assert [r.r for r in rows] == [3, -3]
    assert [r.i for r in rows] == [12, None]


def test_kv_value_with_separator_is_cut(spark):
    # The pair separator is ", ": a value holding it is cut there (stated rule).
    df = spark.createDataFrame([("{note=a, b, num=2}",)], "p string")
    r = df.select(parsing.kv_get(F.col("p"), "note").alias("note"), parsing.kv_get(F.col("p"), "num").alias("num"),
                  parsing.kv_get(F.col("p"), "b").alias("b")).collect()[0]
    assert (r.note, r.num, r.b) == ("a", "2", None)
