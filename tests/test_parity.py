"""Randomised parity of the display rules with DuckDB, and of key-value
parsing with a plain-Python statement of its rule."""
import random

import duckdb
from pyspark.sql import functions as F

from ledgerline.functions import money, parsing


def test_round_2_matches_duckdb_on_random_doubles(spark):
    rnd = random.Random(1)
    vals = [rnd.uniform(-1e6, 1e6) for _ in range(3000)] + [k / 1000 for k in range(-3000, 3000, 7)] + \
           [k + 0.005 for k in range(200)] + [k + 0.015 for k in range(200)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = {r.i: r.r for r in df.select("i", money.round_2("v").alias("r")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INTEGER, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    want = dict(con.execute("SELECT i, round(v, 2) FROM t").fetchall())
    assert got == want


def test_money_text_matches_duckdb_double_printing(spark):
    rnd = random.Random(2)
    cents = [rnd.randint(-10**11, 10**11) for _ in range(3000)] + [0, 5, 50, 500, 10**9, 10**9 + 10, 123456789]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cents)], "i int, c bigint")
    got = {r.i: r.s for r in df.select("i", money.format_money("c").alias("s")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INTEGER, c BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(cents)))
    want = dict(con.execute("SELECT i, '$' || CAST(round(c / 100, 2) AS VARCHAR) || ' USD' FROM t").fetchall())
    assert got == want


def _kv_rule(text, key):
    """The stated rule: strip the braces, split on ', ', pieces without
    '=' are not pairs, key = text before the first '=', first pair wins."""
    if text is None:
        return None
    body = text[1:] if text.startswith("{") else text
    body = body[:-1] if body.endswith("}") else body
    for piece in body.split(", "):
        if "=" in piece and piece.split("=", 1)[0] == key:
            return piece.split("=", 1)[1]
    return None


def test_kv_get_matches_the_stated_rule(spark):
    rnd = random.Random(3)
    alphabet = ["a", "b", "size", "num", "x=y", "1", "×", " ", ",", "=", "{", "}"]
    texts = []
    for _ in range(2000):
        pairs = []
        for _ in range(rnd.randint(0, 4)):
            k = rnd.choice(["a", "b", "size", "num"])
            v = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 4)))
            pairs.append(f"{k}={v}" if rnd.random() > 0.1 else k)
        texts.append("{" + ", ".join(pairs) + "}")
    texts.append(None)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for key in ("a", "size", "num"):
        got = {r.i: r.v for r in df.select("i", parsing.kv_get(F.col("t"), key).alias("v")).collect()}
        assert got == {i: _kv_rule(t, key) for i, t in enumerate(texts)}, key


def test_unit_price_text_matches_duckdb(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.randint(0, 10**7), rnd.choice([0.0, 1.0, 3.0, 7.0, rnd.uniform(0.1, 20000.0)]))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, c bigint, q double")
    total = money.cents_to_units(F.col("c"))
    unit = money.round_2(money.divide_safe(total, F.col("q")))
    got = {r.i: r.s for r in df.select("i", money.format_money(money.to_cents(unit)).alias("s")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INTEGER, c BIGINT, q DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    want = dict(con.execute("SELECT i, '$' || CAST(round(round(c / 100, 2) / nullif(q, 0), 2) AS VARCHAR) "
                            "|| ' USD' FROM t").fetchall())
    assert got == want
