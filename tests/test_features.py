"""Packed top-1, exact money, sketches, widening, publishing, variants."""
import datetime
import os
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF01

import __spark_entry__ as E
from ledgerline.operators import aggregates, widening, windows
from ledgerline.plans import reports
from ledgerline.sources import pages, sinks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- packed top-1

@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("descending", [True, False])
def test_packed_top1_equals_the_struct_order(spark, zone, kind, descending):
    rng = random.Random(4)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = [None, "0001-01-03 00:00:00", "1969-12-31 23:59:59.999999", "2024-03-31 02:30:00", "2024-03-31 03:15:00",
                 "2024-10-27 02:30:00", "2024-11-03 01:30:00", "2024-03-10 02:59:59.5", "2024-03-10 03:00:00", "9999-12-29 23:59:59.999999"]
        ids = [None, -(1 << 63), (1 << 63) - 1, 0, -1, 7]
        data = [(rng.randrange(5), rng.choice(times), i, n, rng.random()) for n, i in enumerate(ids * 12)]
        df = spark.createDataFrame(data, "k int, t string, id long, n int, x double").withColumn("t", F.col("t").cast(kind)) \
            .dropDuplicates(["k", "t", "id"])
        found = windows.latest_per_key(df, "k", ["t", "id"], descending)
        pick = F.max_by if descending else F.min_by
        want = df.groupBy("k").agg(pick(F.struct("t", "id", "n", "x"), F.struct("t", "id")).alias("r")).select("k", "r.*")
        assert sorted(found.collect()) == sorted(want.collect())
        assert "HashAggregate" in plan(found) and "SortAggregate" not in plan(found)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_packed_ordering_by_type(spark):
    rows = [(None, None, None, None, None), (-128, -5, datetime.date(1, 1, 1), False, "a"), (127, 5, datetime.date(9999, 12, 31), True, "b")]
    df = spark.createDataFrame(rows, "b byte, i int, d date, f boolean, s string")
    packed = df.select(windows.packed_ordering(df, ["b", "i", "d", "f"]).alias("p")).collect()
    assert [r["p"] for r in packed] == sorted(r["p"] for r in packed) and packed[0]["p"] == 0
    assert windows.packed_ordering(df, ["s"]) is None
    # A text payload is picked by the struct comparison.
    assert [r["s"] for r in windows.latest_per_key(df.withColumn("k", F.lit(1)), "k", ["i"]).collect()] == ["b"]


def test_top1_queries_aggregate_by_hash(spark):
    for name in ("latest_per_key", "customer_statement"):
        text = plan(E.queries()[name](spark, SF01))
        assert "HashAggregate" in text and "SortAggregate" not in text


# ---- exact money

def test_credits_add_up_to_the_cent(spark):
    n = 3_000
    grants = spark.createDataFrame([(1, {"including_pending": 1}, [{"running_balance": 0.1}])] * n
                                   + [(1, {"including_pending": 1}, [{"running_balance": 2.0 ** 53}])]
                                   + [(1, {"including_pending": 1}, [{"running_balance": 1.0}])] * 3,
                                   "customer_id int, balance struct<including_pending:bigint>, "
                                   "deductions array<struct<running_balance:double>>")
    customers = spark.createDataFrame([(1, "A")], "id int, name string")
    invoices = spark.createDataFrame([], "id int, customer_id int, status string, end_timestamp timestamp_ntz, total bigint")
    row = reports.customer_statement(customers, invoices, grants.repartition(7)).first()
    cents = 2 ** 53 + 3 + n // 10
    assert row["credit_balance"] == f"${Decimal(cents) / 100} USD"     # doubles would lose the single cents


def test_slices_with_adjustments(spark):
    inv = spark.createDataFrame([("c", "p", "FINALIZED", 10.0, -2.0), ("c", "p", "FINALIZED", 5.0, None), ("c", "p", "DRAFT", 9.0, 1.0),
                                 ("d", None, "FINALIZED", 4.0, None), ("e", "p", "FINALIZED", -4.0, None)],
                                "customer_id string, plan string, status string, total double, invoice_adjustments_0_total double")
    names = spark.createDataFrame([("c", "A"), ("d", "A"), ("e", "B")], "id string, name string")
    out = reports.invoice_slices(inv, ["plan"], customers=names, values=("total", "adjusted_totals"))
    assert [tuple(r) for r in out.collect()] == [("A", "p", 15.0, 12.0)]
    out = reports.invoice_slices(inv, ["plan"], customers=names, keep_null_keys=True)
    assert [tuple(r) for r in out.collect()] == [("A", "p", 15.0), ("A", None, 4.0)]


# ---- quantile sketches

def test_merged_sketches_keep_the_stated_error(spark):
    rng = random.Random(8)
    values = [rng.lognormvariate(0, 2) for _ in range(30_000)] + [1.0] * 15_000 + [None] * 500
    df = spark.createDataFrame([(n % 40, v) for n, v in enumerate(values)], "part int, v double")
    merged = aggregates.merge_sketches(aggregates.quantile_sketches(df, ["v"], by=["part"]))
    real = sorted(v for v in values if v is not None)
    for r in aggregates.sketched_quantiles(merged, (0.0, 0.1, 0.5, 0.9, 1.0)).collect():
        low, high = (sum(v < r["quantile"] for v in real) / len(real), sum(v <= r["quantile"] for v in real) / len(real))
        near = 3 * aggregates.sketch_rank_error()
        assert low - near <= r["p"] <= high + near and (r["n"], r["min"], r["max"]) == (len(real), real[0], real[-1])
    assert aggregates.sketch_rank_error() < 0.003
    none = aggregates.quantile_sketches(df.where("v IS NULL"), ["v"], by=["part"])
    assert aggregates.sketched_quantiles(aggregates.merge_sketches(none)).count() == 0


# ---- widening union

def test_widening_of_many_sources(spark):
    a = spark.createDataFrame([(1, Decimal("1.50"), {"x": 1}, [1], {"k": 1}, datetime.date(2024, 1, 2), "t")],
                              "id int, amount decimal(5,2), s struct<x:int>, xs array<int>, m map<string,int>, d date, v string")
    b = spark.createDataFrame([(2 ** 40, 7, {"x": 2.5, "y": "q"}, [Decimal("0.125")], {"k": None}, datetime.datetime(2024, 1, 2, 3), 5)],
                              "id bigint, amount int, s struct<x:double,y:string>, xs array<decimal(6,3)>, m map<string,bigint>, "
                              "d timestamp_ntz, v int")
    c = spark.sql("SELECT NULL AS id, NULL AS amount, named_struct('z', 1) AS v, true AS extra")
    out = widening.union_widened([a, b, c])
    assert out.schema.simpleString() == (
        "struct<id:bigint,amount:decimal(12,2),s:struct<x:double,y:string>,xs:array<decimal(13,3)>,m:map<string,bigint>,"
        "d:timestamp_ntz,v:string,extra:boolean>")
    rows = out.collect()
    assert rows[0][:2] == (1, Decimal("1.50")) and rows[0]["s"] == (1.0, None) and rows[0]["xs"] == [Decimal("1.000")]
    assert rows[1][:2] == (2 ** 40, Decimal("7.00")) and rows[1]["v"] == "5" and rows[1]["d"] == datetime.datetime(2024, 1, 2, 3)
    assert rows[2]["v"] == '{"z":1}' and rows[2]["extra"] and rows[2]["id"] is None and rows[2]["s"] is None
    assert "Exchange" not in plan(out)
    assert widening.merge_schemas([a.schema, b.schema, c.schema]) == widening.merge_schemas([widening.merge_schemas([a.schema, b.schema]), c.schema])
    assert widening.widest(a.schema["amount"].dataType, b.schema["s"].dataType).simpleString() == "string"


# ---- files by key, publishing

def test_files_by_key_are_few(spark, tmp_path):
    rng = random.Random(6)
    df = spark.createDataFrame([(f"c{0 if rng.random() < .4 else rng.randrange(60):02d}", n, None) for n in range(6_000)],
                               "customer_id string, id int, note string").repartition(16)
    out, naive = str(tmp_path / "few"), str(tmp_path / "naive")
    sinks.write_json_by_key(df, out, "customer_id", files=8, max_records=500)
    sinks.write_json(df, naive, partition_by=["customer_id"])
    files = Counter(d.rsplit("=", 1)[1] for d, _, names in os.walk(out) for f in names if f.endswith(".json"))
    assert len(files) == 60 and sum(files.values()) <= 60 + 8 + files["c00"] < 100
    assert sum(f.endswith(".json") for _, _, names in os.walk(naive) for f in names) > 500
    assert files["c00"] >= 4      # a hot key is cut over tasks and files
    back = spark.read.json(out)
    assert back.count() == 6_000 and "note" in back.columns
    assert sorted(r["id"] for r in back.collect()) == list(range(6_000))


def test_two_builds_at_once_agree(spark, tmp_path):
    path = str(tmp_path / "once")
    df = spark.createDataFrame([(1,), (2,)], "a int")

    def second(to):
        df.write.parquet(to)

    def first(to):
        df.limit(1).write.parquet(to)
        other.append(sinks.publish(spark, path, second))      # overtaken while it builds

    other = []
    mine = sinks.publish(spark, path, first)
    assert mine == other[0] and spark.read.parquet(mine).count() == 2
    assert sinks.publish(spark, path, lambda to: pytest.fail("built again")) == mine
    assert len([d for d in os.listdir(path) if d.startswith("build-")]) == 2


def test_a_failed_build_is_never_read(spark, tmp_path):
    path = str(tmp_path / "once")

    def half(to):
        spark.range(5).write.parquet(to)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        sinks.publish(spark, path, half)
    assert sinks.committed(spark, path) is None
    assert sinks.build_once(spark, path, lambda: spark.range(3)).count() == 3


# ---- variants

def test_raw_records_as_variants(spark, tmp_path):
    path = tmp_path / "raw.json"
    path.write_text('{"data":[{"id":1,"tags":["a"]},{"id":"x","more":{"deep":null}}]}\n{"error":"down"}\n{"data":[\n')
    raw = pages.read_raw_variant(spark, str(path))
    assert sorted(r["unreadable"] for r in raw.where("unreadable IS NOT NULL").collect()) == ['{"data":[']
    records = pages.variant_elements(raw, "$.data")
    got = records.select(F.variant_get("record", "$.id", "string").alias("id"), F.try_variant_get("record", "$.id", "int").alias("n"),
                         F.is_variant_null(F.variant_get("record", "$.more.deep", "variant")).alias("null")).collect()
    assert sorted(map(tuple, got)) == [("1", 1, False), ("x", None, True)]
    assert pages.discover_schema(records) == "OBJECT<id: VARIANT, more: OBJECT<deep: VOID>, tags: ARRAY<STRING>>"
