"""Incremental claims load: CSV files landing in a folder → validated staging.

The batch load (read → validate → split → write staging / rejects) run as a
Structured Streaming query over a file source, so new files are picked up
exactly once (the file source tracks them in the checkpoint).  Each
micro-batch is written by ``foreachBatch`` into a per-batch directory with
``overwrite``: a batch replayed after a failure rewrites the same directory,
so the sink is idempotent.  ``trigger(availableNow=True)`` processes what is
there and stops — the same job serves as a scheduled batch load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.validate import split, validate
from ..schema import EXPECTED_COLUMNS
from ..sources.files import CORRUPT, whole_rows


def stream_raw_claims(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None
                      ) -> DataFrame:
    """Streaming DataFrame of raw claims (15 string columns + ``source_file``), read as the batch
    load reads them; every file's header is compared with the expected one."""
    fields = ", ".join(f"`{c}` string" for c in [*EXPECTED_COLUMNS, CORRUPT])
    r = (spark.readStream.schema(fields).option("header", True)
              .option("escape", '"').option("enforceSchema", False).option("columnNameOfCorruptRecord", CORRUPT)
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.csv(landing_dir)
    return whole_rows(df.withColumn("source_file", F.col("_metadata.file_name"))).select(
        "source_file", *[F.col(f"`{c}`") for c in EXPECTED_COLUMNS])


def run_ingest(spark: SparkSession, landing_dir: str, staging_dir: str, rejects_dir: str,
               checkpoint_dir: str, available_now: bool = True, max_files_per_trigger: int | None = None):
    """Validate every new file; accepted rows → ``staging_dir/batch=<id>``, rejected rows with
    their messages → ``rejects_dir/batch=<id>``.  Returns the finished (or running) query."""
    validated = validate(stream_raw_claims(spark, landing_dir, max_files_per_trigger),
                         record_col="source_file")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        ok, bad = split(batch)
        ok.write.mode("overwrite").parquet(f"{staging_dir}/batch={batch_id}")
        bad.select("source_file", F.array_join("errors", "; ").alias("errors"),
                   F.size("errors").alias("error_count")) \
           .write.mode("overwrite").parquet(f"{rejects_dir}/batch={batch_id}")

    w = validated.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def ingest_summary(spark: SparkSession, staging_dir: str, rejects_dir: str) -> DataFrame:
    """rows_read, valid, rejected, error_count over everything ingested so far (one union, one agg)."""
    ok = spark.read.parquet(staging_dir).select(F.lit(True).alias("_ok"), F.lit(0).alias("_e"))
    bad = spark.read.parquet(rejects_dir).select(F.lit(False).alias("_ok"),
                                                 F.col("error_count").alias("_e"))
    return ok.unionByName(bad).agg(
        F.count(F.lit(1)).alias("rows_read"), F.count_if("_ok").alias("valid"),
        F.count_if(~F.col("_ok")).alias("rejected"),
        F.coalesce(F.sum("_e"), F.lit(0)).cast("bigint").alias("error_count"))
