"""Skew-safe left join by a sketch; shapes that merge and stay bounded."""
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001

from ledgerline.operators import joins, nested
from ledgerline.plans import reports
from ledgerline.sources import api_records


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("kind", ["int", "string", "double", "date", "timestamp_ntz", "boolean", "decimal(10,2)"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_join_equals_plain_join(spark, kind, null_safe):
    rng = random.Random(5)
    left = spark.createDataFrame([(n % 60 if n % 7 else None, n) for n in range(130)], "k int, __part int")
    keys = [3] * 600 + [None] * 500 + [rng.randrange(80) for _ in range(400)] + [3] * 2
    right = spark.createDataFrame([(k, n, n % 5) for n, k in enumerate(keys)], "r int, x int, __met int")
    cast = {"date": lambda c: F.date_add(F.lit("2024-01-01").cast("date"), F.col(c)),
            "timestamp_ntz": lambda c: F.date_add(F.lit("2024-01-01").cast("date"), F.col(c)).cast("timestamp_ntz"),
            "boolean": lambda c: F.col(c) == 3}.get(kind, lambda c: F.col(c).cast(kind))
    left, right = left.withColumn("k", cast("k")), right.withColumn("r", cast("r")).repartition(5)
    hot, parts = joins.hot_keys(right, "r", hot_rows=10)
    assert None in hot and len(hot) == (3 if kind == "boolean" else 2) and 1 < parts <= 8
    same = left["k"].eqNullSafe(right["r"]) if null_safe else left["k"] == right["r"]
    found = joins.left_join_skew_safe(left, right, "k", "r", null_safe=null_safe, hot_rows=10)
    assert found.columns == ["k", "__part", "r", "x", "__met"]
    assert rows(found) == rows(left.join(right, same, "left"))


def test_nested_keys_join_plainly(spark):
    left = spark.createDataFrame([((1,), "a"), ((2,), "b")], "k struct<n:int>, v string")
    right = spark.createDataFrame([((1,), 5)], "r struct<n:int>, x int")
    assert rows(joins.left_join_skew_safe(left, right, "k", "r", hot_rows=0).select("v", "x")) == {("a", 5): 1, ("b", None): 1}


def test_hot_key_is_dealt_out_and_right_is_read_once(spark, tmp_path):
    spark.range(40_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("cid"),
                               F.col("id").alias("x")).write.parquet(str(tmp_path / "right"))
    right = spark.read.parquet(str(tmp_path / "right"))
    left = spark.range(5000).select(F.col("id").alias("k"))
    found = joins.left_join_skew_safe(left, right, "k", "cid", hot_rows=1000)
    assert plan(found).count("FileScan parquet") == 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = joins.left_join_skew_safe(left, right, "k", "cid", hot_rows=1000)
        most = found.where("cid = 7").groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    hot = right.where("cid = 7").count()
    assert most <= 0.75 * hot      # 13,341 rows in 3 parts
    assert found.count() == left.join(right, left.k == right.cid, "left").count()


def test_no_hot_key_is_a_plain_join(spark):
    left, right = spark.range(100).select(F.col("id").alias("k")), spark.range(100).select(F.col("id").alias("r"))
    text = plan(joins.left_join_skew_safe(left, right, "k", "r"))
    assert text.count("Join") == 1 and "__part" not in text


def test_merge_joins_records_nested(spark):
    invoices = api_records.landed_invoice_records(spark, SF001)
    found = reports.customer_invoice_join(api_records.customer_records(spark, SF001), invoices,
                                          invoice_shape=api_records.landed_invoice_shape(spark, SF001))
    text = plan(found)
    assert text.count("invoice_records") <= 2      # the path in one scan, its location beside it
    assert text.count("Join") == 1
    merged = joins.merge_left_suffix(nested.flatten_wide(api_records.customer_records(spark, SF001)),
                                     nested.flatten_wide(invoices), "id", "customer_id")
    assert found.columns == merged.columns and rows(found) == rows(merged)


SCHEMA = "id string, xs array<struct<a:int, m:map<string,int>>>, m map<string,array<int>>"
PARTS = [[("1", [(1, {"k": 1}), (2, {})], {"p": [1]}), ("2", None, {"p": [1, 2], "q": []})],
         [("3", [(1, {"z": 5})] * 3, {"r": None})], []]


def test_shapes_of_parts_merge(spark, tmp_path):
    path = str(tmp_path / "landed")
    frames = [spark.createDataFrame(p, SCHEMA) for p in PARTS]
    for n, df in enumerate(frames):
        nested.land_part(df, path, str(n))
    whole = frames[0].unionByName(frames[1])
    assert nested.landed_shape(spark, path) == nested.flatten_shape(whole) == nested.Shape(
        {("xs",): 3, ("m", "p"): 2, ("m", "q"): 0, ("m", "r"): 0},
        {("xs", "0", "m"): ["k", "z"], ("xs", "1", "m"): ["z"], ("xs", "2", "m"): ["z"], ("m",): ["p", "q", "r"]})
    # A part that lands again counts once, with its new shape.
    nested.land_part(spark.createDataFrame([("3", [(1, {})], {})], SCHEMA), path, "1")
    assert nested.landed_shape(spark, path).sizes[("xs",)] == 2


@pytest.mark.parametrize("limits", [(9, 1000), (3, 1000), (1000, 2), (20, 1)])
def test_a_cut_shape_and_the_rest_are_whole(spark, limits):
    rng = random.Random(2)
    data = [(str(n), [(n, {f"k{rng.randrange(30)}": n})] * rng.randrange(4), {"common": [1, 2, 3], f"rare{n}": [n]}) for n in range(40)]
    df = spark.createDataFrame(data, SCHEMA)
    shape = nested.flatten_shape(df, *limits)
    assert shape.cut and len(shape.sizes) + sum(map(len, shape.keys.values())) <= limits[0]
    with pytest.raises(ValueError):
        nested.flatten_wide(df, shape=shape)
    wide = nested.flatten_wide(df, shape=shape, allow_cut=True)
    leaves = {(r["id"], n, str(v)) for r in wide.collect() for n, v in r.asDict().items() if n != "id" and v is not None}
    rest = [(r["id"], r["name"], r["value"]) for r in nested.flatten_rest(df, ["id"], shape).collect()]
    every = [(r["id"], r["name"], r["value"]) for r in nested.flatten_long(df, ["id"]).collect()]
    assert not leaves & set(rest) and sorted([*leaves, *rest]) == sorted(every)
