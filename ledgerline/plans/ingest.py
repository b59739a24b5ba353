"""Ingest job: landed API records to raw JSON, flat JSON and CSV.

``load_and_process`` reads its input once: the records are staged in the
shared folder as columns, with their flatten shape beside them, and all
outputs are written from there.  So the outputs agree also where the
input does not give the same rows twice, and a lost executor repeats the
staged read, not the plan before it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ledgerline.operators.nested import flatten_wide, land_part, landed_shape
from ledgerline.session import scratch_path
from ledgerline.sources.sinks import write_csv, write_json


def load_and_process(records: DataFrame, raw_json_path: str, flat_json_path: str, csv_path: str,
                     partition_by: list[str] | None = None) -> DataFrame:
    """Records -> raw JSON, flat JSON, CSV; returns the flat DataFrame,
    which reads the staged records."""
    spark = records.sparkSession
    base = scratch_path(spark, f"ingest-{uuid.uuid4().hex}")
    land_part(records, base, "all")
    staged = spark.read.schema(records.schema).parquet(f"{base}/part=all")
    write_json(staged, raw_json_path, partition_by=partition_by)
    flat = flatten_wide(staged, shape=landed_shape(spark, base))
    write_json(flat, flat_json_path)
    write_csv(flat, csv_path)
    return flat
