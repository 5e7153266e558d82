"""Incremental loading of raw record files.

`load_new_files` keeps a table of its own; `stream_into_bronze` feeds the table that batch
loads feed, each micro-batch as a run with its ledger rows.

A streaming query lists the files it has not seen; every micro-batch goes
through the same validation and insert-if-absent as a batch load. Identity is
(source_name, source_job_id) against the stored table, so no state or watermark
is kept. A batch writes its own folder and a retried batch overwrites it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.operators.bronze import (
    KEY,
    fresh_positions,
    source_names,
    with_content_hash,
    with_reject_reason,
)
from hirelens.plans.incremental import load_records
from hirelens.session import stage
from hirelens.sources.buckets import BUCKETS
from hirelens.sources.raw_records import json_records, with_position

SEVERAL_SOURCES = "(several)"

STORED = "source_name STRING, source_job_id STRING, source_url STRING, scraped_at STRING, " \
         "raw_payload STRING, content_hash STRING, batch_id BIGINT"
REJECTED = "source_name STRING, source_url STRING, raw_payload STRING, reject_reason STRING, " \
           "batch_id BIGINT"


def _folder_table(spark: SparkSession, path: str, ddl: str, before: int) -> DataFrame:
    """Rows of earlier batches; an empty frame while nothing has been written."""
    try:
        rows = spark.read.schema(ddl).parquet(path)
    except Exception as error:  # the folder does not exist before the first batch
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], ddl)
    return rows.filter(F.col("batch_id") < before)


def stored(spark: SparkSession, root: str) -> DataFrame:
    return _folder_table(spark, f"{root}/raw_job_postings", STORED, 1 << 62)


def rejected(spark: SparkSession, root: str) -> DataFrame:
    return _folder_table(spark, f"{root}/rejected", REJECTED, 1 << 62)


def load_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    spark = batch.sparkSession
    records = stage(with_reject_reason(with_position(batch)), "batch")
    existing = _folder_table(spark, f"{root}/raw_job_postings", STORED, batch_id)
    fresh = fresh_positions(records, existing)
    inserted = with_content_hash(records.join(fresh, "position")).select(
        *KEY, "source_url", "scraped_at", "raw_payload", "content_hash"
    )
    inserted.write.mode("overwrite").parquet(f"{root}/raw_job_postings/batch_id={batch_id}")
    failed = records.filter(F.col("reject_reason").isNotNull()).select(
        "source_name", "source_url", "raw_payload", "reject_reason"
    )
    failed.write.mode("overwrite").parquet(f"{root}/rejected/batch_id={batch_id}")


def load_new_files(
    spark: SparkSession,
    input_dir: str,
    root: str,
    layout: str = "array",
    files_per_batch: int = 1000,
) -> None:
    """Load every file that arrived since the last call, then stop."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    stream = json_records(reader, input_dir, layout)
    query = (
        stream.writeStream.foreachBatch(lambda df, n: load_batch(df, n, root))
        .option("checkpointLocation", f"{root}/_progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def load_bronze_batch(
    batch: DataFrame, batch_id: int, root: str, stream: str = "stream", buckets: int = BUCKETS
) -> int:
    """Load a micro-batch into bronze as one run; returns the run's number.

    The run's number and its first raw id are reserved under the batch's name before any row
    is written, and the ledger's closing row is written last. A batch that failed halfway
    takes the same number and ids when it is repeated and overwrites its folders; one that was
    closed is not loaded again. Lines that are no JSON, and other bad records, are rejects of
    the run. An empty batch is a run without records.
    """
    records = stage(with_reject_reason(with_position(batch)), "batch")
    names = [row[0] for row in source_names(records).limit(2).collect()]
    source = names[0] if len(names) == 1 else SEVERAL_SOURCES
    return load_records(
        records, root, f"{stream} {batch_id}", source, f"{stream}:{batch_id}", buckets)


def stream_into_bronze(
    spark: SparkSession,
    input_dir: str,
    root: str,
    stream: str = "stream",
    layout: str = "lines",
    files_per_batch: int = 1000,
    buckets: int = BUCKETS,
) -> None:
    """Load every file that arrived since the last call into bronze, then stop.
    `plans.incremental.apply_changes` carries it on to the marts."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    query = (
        json_records(reader, input_dir, layout).writeStream
        .foreachBatch(lambda df, n: load_bronze_batch(df, n, root, stream, buckets) and None)
        .option("checkpointLocation", f"{root}/_progress_{stream}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
