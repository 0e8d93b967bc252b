"""Incremental validate-and-route with Structured Streaming.

New ``;``-delimited text files arrive in a folder, each with its own heading;
every micro-batch makes records of the files it got (``sources.text``: a record
may span lines and input splits), numbers them from 1 in each file, applies the
same Column-expression rules as the batch job, and writes valid rows, quarantine
and a totals row.  A file is in one batch as a whole, so headings, record numbers
and quoted fields need no state between batches.  ``availableNow`` drains what is
there and stops (the batch-pipeline equivalent); the checkpoint folder makes a
restarted query resume exactly where it stopped.  Each micro-batch writes into
its own ``batch_id=<n>`` folder with overwrite, so a batch that is replayed after
a failure replaces its partial output instead of appending it twice (exactly-once
output on top of the replayable file source).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.operators import validate as V
from salescope.sources.text import data_records, located, numbered_records


def validate_stream(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Run the stream to completion (availableNow) and return the per-batch totals."""
    reader = spark.readStream.option("lineSep", "\n")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.text(source_dir).select("_metadata.file_path", "_metadata.file_block_start", "value")

    def route(batch: DataFrame, batch_id: int) -> None:
        # The batch's splits are fixed, so it is read from its files twice (splits, records) and not stored in between.
        records = data_records(numbered_records(located(batch)), header_per_file=True, numbers_per_file=True)
        part = f"batch_id={batch_id}"

        def store(df: DataFrame, name: str) -> None:
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{out_dir}/{name}/{part}")

        # Written first: valid rows, quarantine and totals are three readers of one validation pass.
        store(V.first_failure(records, keep=("file",)), "checked")
        checked = batch.sparkSession.read.parquet(f"{out_dir}/checked/{part}")
        store(V.valid_rows(checked), "valid")
        store(V.quarantine_lines(checked, keep=("file",)), "quarantine")
        store(V.validation_totals(checked), "totals")

    q = (lines.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    totals = spark.read.parquet(f"{out_dir}/totals")
    return totals.select("read", "valid", "discarded", "discarded_age", F.col("batch_id").cast("bigint"))
