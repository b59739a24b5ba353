"""Per-stage task balance from Spark's event log.

    python tools/stage_report.py [--sf DIR]

Runs the plain window ``row_number`` and ``row_number_skew_safe`` on
invoices where one customer holds a third of the rows (derived from the
driver's orders table), with the event log written to a scratch folder,
and prints for every stage: tasks, max and median records per task, and
max and median task time.  A balanced plan has max close to median.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stage_stats(log_dir: str) -> dict[int, dict]:
    stats: dict[int, dict] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or "appstatus" in os.path.basename(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                sid = ev["Stage ID"]
                info, metrics = ev["Task Info"], ev.get("Task Metrics") or {}
                recs = (metrics.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                        or metrics.get("Input Metrics", {}).get("Records Read", 0))
                dur = info["Finish Time"] - info["Launch Time"]
                s = stats.setdefault(sid, {"records": [], "ms": []})
                s["records"].append(recs)
                s["ms"].append(dur)
    return stats


def summarize(stats: dict[int, dict]) -> list[str]:
    out = []
    for sid in sorted(stats):
        r, ms = stats[sid]["records"], stats[sid]["ms"]
        out.append(f"stage {sid:3d}: tasks={len(r):3d} records max={max(r):8d} median={int(statistics.median(r)):8d}"
                   f"  ms max={max(ms):6d} median={int(statistics.median(ms)):6d}")
    return out


def run_case(label: str, build, extra: dict | None = None) -> None:
    from ledgerline.session import build_session, checkpoint_dir
    from pyspark.sql import SparkSession
    log_dir = tempfile.mkdtemp(prefix=f"ledgerline-events-{label}-")
    conf = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false", "spark.ui.showConsoleProgress": "false",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    conf.update(extra or {})
    spark = build_session("local[8]", shuffle_partitions=8, extra=conf)
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    build(spark).write.format("noop").mode("overwrite").save()
    spark.stop()
    SparkSession._instantiatedSession = None
    print(f"== {label}")
    for line in summarize(stage_stats(log_dir)):
        print(line)


def merge_cases(sf: str) -> None:
    """customers LEFT JOIN invoices with one customer holding a third of
    the invoices; AQE skew thresholds scaled down to this data size and
    broadcast off, as it would be for tables of real size."""
    from pyspark.sql import functions as F

    from ledgerline.operators import joins
    from ledgerline.sources import driver_tables as dt
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}

    def sides(spark):
        c = dt.customers(spark, sf)
        inv = dt.invoices(spark, sf).select(F.col("id").alias("invoice_id"), "customer_id", "total")
        hot = inv.withColumn("customer_id", F.when(F.col("invoice_id") % 3 == 0, F.lit(0))
                             .otherwise(F.col("customer_id")))
        return c, hot

    def plain(spark):
        c, hot = sides(spark)
        return c.join(hot, c.id == hot.customer_id, "left")

    def safe(spark):
        c, hot = sides(spark)
        return joins.left_join_skew_safe(c, hot, "id", "customer_id")
    run_case("left_join_plain", plain, small)
    run_case("left_join_skew_safe", safe, small)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--case", choices=["row_number", "merge"], default="row_number")
    args = ap.parse_args()
    if args.case == "merge":
        merge_cases(args.sf)
        return
    from pyspark.sql import functions as F

    from ledgerline.operators import windows
    from ledgerline.session import build_session, checkpoint_dir
    from ledgerline.sources import driver_tables as dt

    for label in ("plain", "skew_safe"):
        log_dir = tempfile.mkdtemp(prefix=f"ledgerline-events-{label}-")
        spark = build_session("local[8]", shuffle_partitions=8, extra={
            "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            "spark.ui.showConsoleProgress": "false",
            # show the window's own balance, not AQE's coalescing
            "spark.sql.adaptive.coalescePartitions.enabled": "false"})
        spark.sparkContext.setLogLevel("ERROR")
        checkpoint_dir(spark)
        inv = dt.invoices(spark, args.sf)
        # one customer holds a third of all invoices
        hot = inv.withColumn("customer_id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("customer_id")))
        order = [F.col("end_timestamp").desc(), F.col("id").desc()]
        if label == "plain":
            out = windows.with_row_number(hot, "customer_id", order)
        else:
            out = windows.row_number_skew_safe(hot, "customer_id", order)
        out.write.format("noop").mode("overwrite").save()
        spark.stop()
        print(f"== {label}")
        for line in summarize(stage_stats(log_dir)):
            print(line)
        from pyspark.sql import SparkSession
        SparkSession._instantiatedSession = None


if __name__ == "__main__":
    main()
