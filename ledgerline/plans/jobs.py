"""Batch report job: the billing reports written as CSV files.

The scheduled form of the reports: read the billing tables, run each
report and write it as CSV with a header, one file per task; one single
file, and with it one writing task, only with ``--single-file``.

    python -m ledgerline.plans.jobs --sf /path/to/tables --out /shared/reports
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog import (MARCH, STATEMENT_CUSTOMER, STATEMENT_PERIOD, USAGE_PERIOD, USAGE_TYPES)
from ledgerline.plans import reports
from ledgerline.sources import api_records
from ledgerline.sources import driver_tables as dt
from ledgerline.sources.sinks import write_csv


def billing_reports(spark: SparkSession, sf_dir: str, usage_period: tuple[str, str] = USAGE_PERIOD,
                    statement_customer: str = STATEMENT_CUSTOMER,
                    statement_period: tuple[str, str] = STATEMENT_PERIOD,
                    billing_period: tuple[str, str] = MARCH) -> dict[str, DataFrame]:
    customers = dt.customers(spark, sf_dir)
    invoices = dt.invoices(spark, sf_dir)
    grants = api_records.landed_grant_records(spark, sf_dir).withColumn(
        "customer_id", F.col("customer_id").cast("bigint"))
    return {
        "customer_statement": reports.customer_statement(customers, invoices, grants),
        "usage_by_attribute": reports.usage_by_attribute(
            dt.events(spark, sf_dir), customers, *usage_period, list(USAGE_TYPES), "size", "num"),
        "invoice_lines": reports.invoice_lines(
            customers, invoices, dt.line_items(spark, sf_dir), dt.sub_line_items(spark, sf_dir),
            statement_customer, *statement_period),
        "billings_by_plan": reports.billings_by_plan(invoices, dt.plans(spark, sf_dir), customers, *billing_period),
    }


def run(spark: SparkSession, sf_dir: str, out_dir: str, single_file: bool = False, **options) -> list[str]:
    """Writes each report; ``options`` are those of ``billing_reports``."""
    written = []
    for name, df in billing_reports(spark, sf_dir, **options).items():
        path = os.path.join(out_dir, name)
        write_csv(df, path, single_file=single_file)
        written.append(path)
    return written


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--sf", required=True, help="folder with the input parquet tables")
    ap.add_argument("--out", required=True, help="shared output folder")
    ap.add_argument("--single-file", action="store_true", help="one CSV file each, through one task")
    ap.add_argument("--customer", default=STATEMENT_CUSTOMER, help="customer of the invoice lines")
    for name, default in (("usage", USAGE_PERIOD), ("statement", STATEMENT_PERIOD), ("billing", MARCH)):
        ap.add_argument(f"--{name}-period", nargs=2, metavar=("FROM", "TO"), default=default)
    args = ap.parse_args()
    from ledgerline.session import build_session, checkpoint_dir
    spark = build_session()
    checkpoint_dir(spark)
    for p in run(spark, args.sf, args.out, single_file=args.single_file, statement_customer=args.customer,
                 usage_period=tuple(args.usage_period), statement_period=tuple(args.statement_period),
                 billing_period=tuple(args.billing_period)):
        print(p)


if __name__ == "__main__":
    main()
