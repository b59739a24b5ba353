"""Incremental intake of API pages as they land.

The batch intake reads a folder of landed pages once; this is the same
job as a Structured Streaming query over the landing folder.  Each
micro-batch is classified by :func:`ledgerline.sources.intake.classify`
in one pass into a staged folder, from which valid rows, rejects and
lost pages go to tables of their own.  Nothing of a file is left out:
error envelopes and pages that end too early are rows of ``pages``.

Exactly-once output: every micro-batch writes into its own
``batch_id=<n>`` folders with overwrite, so a batch replayed after a
failure replaces its earlier partial output instead of duplicating it;
the file source's checkpoint in ``checkpoint_location`` records which
files were consumed.  A page lives in one file and a file in one
micro-batch, so the all-or-nothing rule of a page file holds within a
batch.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.sources import intake


def landed_envelopes(spark: SparkSession, landing_dir: str, entity: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of page envelopes with their file."""
    reader = spark.readStream.schema(intake.envelope_schema(entity)).option("columnNameOfCorruptRecord", "_unreadable")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing_dir).select("*", F.col("_metadata.file_path").alias("source_file"))


def start_ingest(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint_location: str,
                 entity: str = "invoice", all_or_nothing: bool = False,
                 available_now: bool = True) -> StreamingQuery:
    """Start the streaming intake; ``available_now`` processes what has
    landed and stops (scheduled runs), otherwise it keeps running.  Writes
    ``valid``, ``rejects`` and ``pages`` under ``out_dir``."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        folder = lambda name: os.path.join(out_dir, name, f"batch_id={batch_id}")
        found = intake.classify(batch, entity)
        found.write.mode("overwrite").parquet(folder("_staged"))
        staged = batch.sparkSession.read.schema(found.schema).parquet(folder("_staged"))
        taken = intake.outcomes(staged, entity, all_or_nothing=all_or_nothing)
        for name, rows in taken._asdict().items():
            rows.write.mode("overwrite").parquet(folder(name))

    writer = (landed_envelopes(spark, landing_dir, entity).writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
