"""Operators against brute-force Python on small frames."""
import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import aggregates, filters, joins, nested, windows


def test_ts_range_end_day(spark):
    ts = [dt.datetime(2024, 3, 25, 0, 0, 0), dt.datetime(2024, 3, 25, 0, 0, 1), dt.datetime(2024, 3, 10),
          dt.datetime(2024, 3, 9, 23, 59, 59)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "i int, ts timestamp_ntz")
    plain = sorted(r.i for r in filters.filter_ts_range(df, "ts", "2024-03-10", "2024-03-25").collect())
    whole = sorted(r.i for r in filters.filter_ts_range(df, "ts", "2024-03-10", "2024-03-25",
                                                        whole_last_day=True).collect())
    assert plain == [0, 2]          # midnight starting the last day only
    assert whole == [0, 1, 2]
    between = sorted(r.i for r in df.where(filters.ts_between("ts", "2024-03-10", "2024-03-25")).collect())
    assert between == [0, 2]


def test_merge_left_suffix_names_and_nulls(spark):
    left = spark.createDataFrame([(1, "a", "x"), (None, "b", "y"), (3, "c", "z")], "id int, name string, tag string")
    right = spark.createDataFrame([(10, 1, "t1"), (11, None, "t2"), (12, 1, "t3")],
                                  "id int, customer_id int, tag string")
    out = joins.merge_left_suffix(left, right, "id", "customer_id")
    assert out.columns == ["id_x", "name", "tag_x", "id_y", "customer_id", "tag_y"]
    rows = sorted((r.name, r.id_y) for r in out.collect())
    assert rows == [("a", 10), ("a", 12), ("b", None), ("c", None)]
    ns = joins.merge_left_suffix(left, right, "id", "customer_id", null_safe=True)
    rows = sorted((r.name, r.id_y) for r in ns.collect())
    assert rows == [("a", 10), ("a", 12), ("b", 11), ("c", None)]
    same = joins.merge_left_suffix(left, right.withColumnRenamed("customer_id", "cid")
                                   .withColumnRenamed("id", "iid").withColumnRenamed("cid", "id"), "id", "id")
    assert same.columns == ["id", "name", "tag_x", "iid", "tag_y"]


def test_lookup_last_wins(spark):
    df = spark.createDataFrame([("Acme", "id1", 1), ("Beta", "id2", 2), ("Acme", "id3", 3)],
                               "name string, id string, pos int")
    got = {r.name: r.id for r in joins.lookup_last_wins(df, "name", "id", "pos").collect()}
    assert got == {"Acme": "id3", "Beta": "id2"}


def test_latest_per_key_matches_row_number_with_hot_key(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rnd.randint(1, 50)       # key 0 holds a third of rows
        rows.append((key, i, rnd.randint(0, 20), float(rnd.randint(0, 1000))))
    df = spark.createDataFrame(rows, "k int, id int, ts int, total double")
    got = {r.k: (r.id, r.total) for r in windows.latest_per_key(df, "k", ["ts", "id"]).collect()}
    w = Window.partitionBy("k").orderBy(F.col("ts").desc(), F.col("id").desc())
    ref = {r.k: (r.id, r.total) for r in df.withColumn("rn", F.row_number().over(w)).where("rn = 1").collect()}
    assert got == ref
    top = {r.k: r.id for r in windows.top1_by_window(df, "k", [F.col("ts").desc(), F.col("id").desc()]).collect()}
    assert top == {k: v[0] for k, v in ref.items()}


def test_row_number_skew_safe_matches_window(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(6000):
        k = 0 if i % 3 == 0 else (None if i % 89 == 0 else rnd.randint(1, 30))   # hot key and null key
        rows.append((k, "a" if i % 2 else "b", i, rnd.randint(0, 9)))
    df = spark.createDataFrame(rows, "k int, g string, id int, ts int")
    order = [F.col("ts").desc(), F.col("id").desc()]
    for keys in (["k"], ["k", "g"]):
        got = sorted((r.id, r.rn) for r in windows.row_number_skew_safe(df, keys, order, num_partitions=7).collect())
        ref = sorted((r.id, r.rn) for r in windows.with_row_number(df, keys, order).collect())
        assert got == ref



def test_row_number_keeps_payload_and_odd_keys(spark):
    df = spark.sql("""
        SELECT * FROM VALUES
          (CAST('NaN' AS DOUBLE), 1, 9007199254740993L, TIMESTAMP_NTZ'9999-12-31 00:00:00', named_struct('a', array(1, 2))),
          (CAST(NULL AS DOUBLE), 2, CAST(NULL AS BIGINT), TIMESTAMP_NTZ'0001-01-01 00:00:00', NULL),
          (CAST('NaN' AS DOUBLE), 3, 9007199254740995L, NULL, named_struct('a', array())),
          (CAST(NULL AS DOUBLE), 4, -1L, TIMESTAMP_NTZ'2024-02-29 12:00:00', named_struct('a', NULL)),
          (0.0D, 5, 7L, NULL, NULL), (-0.0D, 6, 8L, NULL, NULL)
        AS t(k, id, big, ts, nested)""")
    for parts in (1, 3, 6):
        ranked = windows.row_number_skew_safe(df, "k", [F.col("id").asc()], num_partitions=parts)
        assert {r["id"]: r["rn"] for r in ranked.select("id", "rn").collect()} == {1: 1, 3: 2, 2: 1, 4: 2, 5: 1, 6: 2}
        text = F.to_json(F.struct("id", "big", "ts", "nested"), {"ignoreNullFields": "false"})
        assert sorted(ranked.select(text).collect()) == sorted(df.select(text).collect())


def test_semi_reduce_and_skew_safe_left_join(spark):
    big = spark.createDataFrame([(i % 5, i) for i in range(100)] + [(None, 999)], "k int, v int")
    small = spark.createDataFrame([(1,), (3,), (None,), (42,)], "k int")
    assert sorted({r.k for r in joins.semi_reduce(big, "k", small, "k").collect()}) == [1, 3]
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, name string")
    right = spark.createDataFrame([(1, 10)] * 50 + [(None, 7)], "cid int, x int")
    plain = sorted((r.name, r.x) for r in left.join(right, left.id == right.cid, "left").collect())
    safe = sorted((r.name, r.x) for r in joins.left_join_skew_safe(left, right, "id", "cid").collect())
    assert safe == plain
    ns = joins.left_join_skew_safe(left, right, "id", "cid", null_safe=True).collect()
    assert sorted((r.name, r.x) for r in ns if r.name == "n") == [("n", 7)]


def test_slice_totals_drops_null_keys_and_sorts(spark):
    df = spark.createDataFrame([("p1", 10), (None, 5), ("p0", 7), ("p1", 1)], "plan string, total long")
    out = aggregates.slice_totals(df, ["plan"], customer_name="A1 Company")
    assert [tuple(r) for r in out.collect()] == [("A1 Company", "p0", 7), ("A1 Company", "p1", 11)]
    keep = aggregates.slice_totals(df, ["plan"], customer_name="A1 Company", keep_null_keys=True)
    assert len(keep.collect()) == 3


def test_count_unique_with_null(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "v int")
    assert aggregates.count_unique_with_null(df, "v").collect()[0][0] == 3
    df2 = spark.createDataFrame([(1,), (2,)], "v int")
    assert aggregates.count_unique_with_null(df2, "v").collect()[0][0] == 2


def test_describe_matches_pandas_with_hot_value(spark):
    rnd = random.Random(3)
    vals = [5.0] * 400 + [float(rnd.randint(-1000, 1000)) for _ in range(801)] + [None] * 10
    df = spark.createDataFrame([(v, v) for v in vals], "a double, b double")
    out = {r["column"]: r for r in aggregates.describe_numeric(df, ["a"]).collect()}["a"]
    ref = pd.Series([v for v in vals if v is not None]).describe()
    assert out["count"] == ref["count"]
    assert abs(out["mean"] - ref["mean"]) < 1e-6
    assert abs(out["std"] - ref["std"]) < 1e-6
    assert (out["min"], out["p25"], out["p50"], out["p75"], out["max"]) == (
        ref["min"], ref["25%"], ref["50%"], ref["75%"], ref["max"])
    approx = {r["column"]: r for r in aggregates.describe_numeric(df, ["a"], exact=False).collect()}["a"]
    assert approx["min"] == ref["min"]


def test_exact_quantiles_in_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "ACCURACY", 20)
    monkeypatch.setattr(aggregates, "GATHERED", 4)
    rnd = random.Random(5)
    cols = {"hot": [7.0] * 700 + [rnd.uniform(-9, 9) for _ in range(1300)],
            "near": [1.0] * 501 + [float(n) for n in range(2, 1501)],
            "same": [2.5] * 2000, "odd": [float("inf"), float("-inf")] + [rnd.gauss(0, 1e300) for _ in range(1998)]}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols)).repartition(5)
    got = {r["column"]: r for r in aggregates.describe_numeric(df, list(cols)).collect()}
    for c, vals in cols.items():
        want = pd.Series(vals).quantile([0.25, 0.5, 0.75]).tolist()
        assert [got[c][q] for q in ("p25", "p50", "p75")] == pytest.approx(want, rel=1e-12)


def test_flatten_wide_columns_and_values(spark):
    schema = ("id string, meta map<string,string>, info struct<a:int, b:struct<c:string>>, "
              "lines array<struct<n:string, q:double, subs:array<struct<p:double>>, tags:map<string,string>>>, "
              "grid array<array<int>>, empty_map map<string,string>")
    data = [
        ("r1", {"x": "1"}, {"a": 1, "b": {"c": "u"}},
         [{"n": "l0", "q": 1.0, "subs": [{"p": 0.5}, {"p": 0.7}], "tags": {"t": "a"}},
          {"n": "l1", "q": 2.0, "subs": [{"p": 0.1}, {"p": 0.2}], "tags": {"t": "b"}}], [[1, 2], [3]], {}),
        ("r2", {"x": "2", "y": "3"}, {"a": 2, "b": {"c": "v"}},
         [{"n": "m0", "q": 3.0, "subs": [{"p": 9.0}, {"p": 8.0}], "tags": {"t": "c"}}], [[4]], {}),
    ]
    df = spark.createDataFrame(data, schema)
    flat = nested.flatten_wide(df)
    got = {r["id"]: r.asDict() for r in flat.collect()}
    assert got["r1"] == {
        "id": "r1", "meta_x": "1", "meta_y": None, "info_a": 1, "info_b_c": "u",
        "lines_0_n": "l0", "lines_0_q": 1.0, "lines_0_subs_0_p": 0.5, "lines_0_subs_1_p": 0.7, "lines_0_tags_t": "a",
        "lines_1_n": "l1", "lines_1_q": 2.0, "lines_1_subs_0_p": 0.1, "lines_1_subs_1_p": 0.2, "lines_1_tags_t": "b",
        "grid_0": [1, 2], "grid_1": [3]}
    assert got["r2"] == {
        "id": "r2", "meta_x": "2", "meta_y": "3", "info_a": 2, "info_b_c": "v",
        "lines_0_n": "m0", "lines_0_q": 3.0, "lines_0_subs_0_p": 9.0, "lines_0_subs_1_p": 8.0, "lines_0_tags_t": "c",
        "lines_1_n": None, "lines_1_q": None, "lines_1_subs_0_p": None, "lines_1_subs_1_p": None,
        "lines_1_tags_t": None, "grid_0": [4], "grid_1": None}


def test_flatten_ragged_positions(spark):
    schema = ("id string, l array<struct<n:string, s array<struct<p:int>>>>, m map<string,array<int>>, "
              "r map<string,struct<a:int, tags:map<string,string>>>, g array<array<int>>")
    data = [("r1", [{"n": "x", "s": [{"p": 1}, {"p": 2}]}, {"n": "y", "s": [{"p": 3}]}], {"k": [7, 8]},
             {"one": {"a": 1, "tags": {"t": "u"}}, "two": {"a": 2, "tags": {}}}, [[1], [2, 3]]),
            ("r2", [{"n": "z", "s": None}, None], {"k": [9], "j": [], "q": None}, {"two": None}, None),
            ("r3", None, None, None, [])]
    df = spark.createDataFrame(data, schema.replace(" array<struct<p:int>>", ":array<struct<p:int>>"))
    flat = nested.flatten_wide(df)
    # No second sub line at line 1, no element under "j" and "q", no tag under "two".
    assert flat.columns == ["id", "l_0_n", "l_0_s_0_p", "l_0_s_1_p", "l_1_n", "l_1_s_0_p", "m_k_0", "m_k_1",
                            "r_one_a", "r_one_tags_t", "r_two_a", "g_0", "g_1"]
    got = {r["id"]: list(r)[1:] for r in flat.collect()}
    assert got == {"r1": ["x", 1, 2, "y", 3, 7, 8, 1, "u", 2, [1], [2, 3]],
                   "r2": ["z", None, None, None, None, 9] + [None] * 6, "r3": [None] * 12}
    long = {(r["id"], r["name"]): r["value"] for r in nested.flatten_long(df, ["id"]).collect()}
    assert long == {("r1", "l_0_n"): "x", ("r1", "l_0_s_0_p"): "1", ("r1", "l_0_s_1_p"): "2", ("r1", "l_1_n"): "y",
                    ("r1", "l_1_s_0_p"): "3", ("r1", "m_k_0"): "7", ("r1", "m_k_1"): "8", ("r1", "r_one_a"): "1",
                    ("r1", "r_one_tags_t"): "u", ("r1", "r_two_a"): "2", ("r1", "g_0"): "[1]", ("r1", "g_1"): "[2,3]",
                    ("r2", "l_0_n"): "z", ("r2", "m_k_0"): "9"}


def test_flatten_later_name_wins(spark):
    df = spark.createDataFrame([(1, {"b": 2})], "a_b int, a struct<b:int>")
    flat = nested.flatten_wide(df)
    assert flat.columns == ["a_b"]
    assert flat.collect()[0][0] == 2


def test_flatten_has_no_width_limit(spark):
    df = spark.createDataFrame([([1] * 500,)], "xs array<int>")
    assert len(nested.flatten_wide(df).columns) == 500


def test_explode_lines_keeps_empty(spark):
    schema = ("id string, customer_id string, status string, end_timestamp string, "
              "line_items array<struct<name:string, product_id:string, quantity:double, total:double, "
              "sub_line_items:array<struct<charge_id:string, name:string, quantity:double, subtotal:double, "
              "price:double>>>>")
    data = [("i1", "c1", "FINALIZED", "t", [{"name": "L", "product_id": "p", "quantity": 1.0, "total": 2.0,
                                              "sub_line_items": []}]),
            ("i2", "c1", "DRAFT", "t", [])]
    rows = nested.explode_lines(spark.createDataFrame(data, schema)).collect()
    assert sorted((r.id, r.line_index, r.sub_index) for r in rows) == [("i1", 0, None), ("i2", None, None)]


def test_multi_pass_operators_on_empty_input(spark):
    empty = spark.createDataFrame([], "k int, id int, ts int, v double")
    assert windows.row_number_skew_safe(empty, "k", [F.col("ts").desc()]).count() == 0
    d = aggregates.describe_numeric(empty, ["v"]).collect()[0]
    assert d["count"] == 0 and d["p50"] is None and d["min"] is None
    nested_empty = spark.createDataFrame([], "id string, xs array<struct<a:int>>, m map<string,string>")
    assert nested.flatten_wide(nested_empty).columns == ["id"]
    assert aggregates.count_unique_with_null(empty, "v").collect()[0][0] == 0
