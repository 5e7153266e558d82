"""Raw record validation, insert-if-absent, and load accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.functions import payload
from hirelens.functions.once import with_computed
from hirelens.operators.keyed import assign_ids, largest_id

KEY = ["source_name", "source_job_id"]
SKIPPED, INSERTED, FAILED = "skipped_duplicate", "inserted", "failed"

UNREADABLE = "record is not valid JSON"
MISSING_SOURCE = "missing source_name"
MISSING_PAYLOAD = "missing raw_payload dictionary"
MISSING_JOB_ID = "missing raw_payload.job_id"


def with_keys(records: DataFrame) -> DataFrame:
    """Add source_job_id: the payload's job_id as text, NULL without one."""
    parsed = records.withColumn("_payload", payload.parse(F.col("raw_payload")))
    return parsed.withColumn("source_job_id", payload.field(F.col("_payload"), "job_id")).drop(
        "_payload"
    )


def with_reject_reason(records: DataFrame) -> DataFrame:
    """Add source_job_id and the first validation message, NULL for a good record.

    Text that could not be read as a record, in ``unreadable``, becomes the payload of a
    rejected one.
    """
    readable = F.lit(True)
    if "unreadable" in records.columns:
        text = F.coalesce("unreadable", "raw_payload")
        records = records.withColumns(
            {"raw_payload": text, "_readable": F.col("unreadable").isNull()}
        ).drop("unreadable")
        readable = F.col("_readable")
    parsed = with_computed(records, {"_payload": payload.parse(F.col("raw_payload"))})
    is_object = F.col("raw_payload").rlike(r"^[ \t\r\n]*\{") & F.col("_payload").isNotNull()
    keyed = with_computed(
        parsed,
        {
            "source_job_id": payload.field(F.col("_payload"), "job_id"),
            "_is_object": F.coalesce(is_object, F.lit(False)),
        },
    )
    reason = (
        F.when(~readable, UNREADABLE)
        .when(F.coalesce("source_name", F.lit("")) == "", MISSING_SOURCE)
        .when(~F.col("_is_object"), MISSING_PAYLOAD)
        .when(F.coalesce("source_job_id", F.lit("")) == "", MISSING_JOB_ID)
    )
    return keyed.withColumn("reject_reason", reason).drop(
        "_payload", "_is_object", "_readable"
    )


def with_content_hash(records: DataFrame) -> DataFrame:
    return records.withColumn("content_hash", payload.content_hash(F.col("raw_payload")))


def fresh_positions(validated: DataFrame, existing: DataFrame) -> DataFrame:
    """Positions of the records to insert: the first good one of each new key.

    Only key columns are shuffled, and only one row per key and map task.
    """
    good = validated.filter(F.col("reject_reason").isNull())
    first = good.groupBy(*KEY).agg(F.min("position").alias("position"))
    return first.join(existing.select(*KEY), KEY, "left_anti").select("position")


def with_outcome(validated: DataFrame, existing: DataFrame) -> DataFrame:
    """Add the load outcome of every record: inserted, skipped_duplicate or failed.

    Whole records meet the fresh positions on the position, which is unique:
    records of a hot key spread over all tasks.
    """
    fresh = fresh_positions(validated, existing).withColumn("_fresh", F.lit(True))
    outcome = (
        F.when(F.col("reject_reason").isNotNull(), FAILED)
        .when(F.col("_fresh"), INSERTED)
        .otherwise(SKIPPED)
    )
    marked = validated.join(fresh, "position", "left")
    return marked.withColumn("outcome", outcome).drop("_fresh")


def inserted_rows(
    records: DataFrame, fresh: DataFrame, existing: DataFrame | None, run_id: int,
    after: int | None = None,
) -> DataFrame:
    """Bronze rows for the fresh positions, ids in arrival order after the stored ones, or
    after a given id.

    Ids are given to the positions alone; payloads are hashed once, after the join.
    """
    if after is None:
        after = largest_id(existing, "raw_job_id")
    ids = assign_ids(fresh.select("position"), "raw_job_id", ["position"], after)
    rows = with_content_hash(records.join(ids, "position"))
    return rows.select(
        "raw_job_id",
        F.lit(run_id).cast("bigint").alias("pipeline_run_id"),
        *KEY,
        "source_url",
        F.try_to_timestamp("scraped_at").alias("scraped_at"),
        F.current_timestamp().alias("ingested_at"),
        "raw_payload",
        "content_hash",
    )


def load_report(outcomes: DataFrame) -> DataFrame:
    """Records per outcome."""
    return outcomes.groupBy("outcome").agg(F.count("*").alias("records"))


def final_status(
    inserted: Column, skipped: Column, failed: Column, total: Column
) -> Column:
    return (
        F.when(failed == 0, "success")
        .when(inserted + skipped > 0, "partial_success")
        .when((total > 0) & (failed == total), "failed")
        .otherwise("partial_success")
    )


def load_counts(outcomes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals per outcome and the final status, over all records or per group."""
    counts = outcomes.groupBy(*(by or [])).agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("outcome") == INSERTED).alias("inserted_count"),
        F.count_if(F.col("outcome") == SKIPPED).alias("skipped_count"),
        F.count_if(F.col("outcome") == FAILED).alias("failed_count"),
    )
    status = final_status(
        F.col("inserted_count"), F.col("skipped_count"), F.col("failed_count"),
        F.col("total_records"),
    )
    return counts.withColumn("status", status)


def source_names(records: DataFrame) -> DataFrame:
    """Distinct non-empty source names; a valid input has exactly one."""
    named = records.filter(F.coalesce("source_name", F.lit("")) != "")
    return named.select("source_name").distinct()


def single_source(records: DataFrame) -> str:
    """The one source name of the input; an error when there are none or several."""
    names = [row[0] for row in source_names(records).limit(2).collect()]
    if not names:
        raise ValueError("no source_name found in the input")
    if len(names) > 1:
        raise ValueError(f"the input has several source names, such as {sorted(names)}")
    return names[0]


def duplicate_profile(records: DataFrame) -> DataFrame:
    """Records against distinct keys and distinct payload fingerprints.

    Payloads are parsed and hashed in one pass. Every record gives its key and its hash as two
    short rows, merged per task before they meet; a missing key counts as one key.
    """
    keyed = with_content_hash(with_keys(records)).select("source_job_id", "content_hash")
    values = F.array(
        F.struct(F.lit("key").alias("kind"), F.col("source_job_id").alias("value")),
        F.struct(F.lit("hash").alias("kind"), F.col("content_hash").alias("value")),
    )
    merged = (
        keyed.select(F.inline(values)).groupBy("kind", "value")
        .agg(F.count("*").alias("n")).agg(
            F.coalesce(F.sum(F.when(F.col("kind") == "key", F.col("n"))), F.lit(0))
            .alias("total_records"),
            F.count_if(F.col("kind") == "key").alias("distinct_job_ids"),
            F.count_if(F.col("kind") == "hash").alias("distinct_hashes"),
        )
    )
    return merged.withColumns(
        {
            "duplicate_job_ids": F.col("total_records") != F.col("distinct_job_ids"),
            "duplicate_hashes": F.col("total_records") != F.col("distinct_hashes"),
        }
    )


# --- run ledger: an append-only table, the latest row of a run counts -------


def open_run(spark: SparkSession, run_id: int, name: str, source: str, total: int) -> DataFrame:
    row = (run_id, name, source, "running", None, None, total, 0, 0, 0, 0, None)
    frame = spark.createDataFrame([row], schemas.PIPELINE_RUNS)
    return frame.withColumn("started_at", F.current_timestamp())


def close_run(opened: DataFrame, status: str, inserted: int, failed: int, cleaned: int = 0,
              enriched: int = 0, error: str | None = None) -> DataFrame:
    """The closing row of a run."""
    return opened.withColumns(
        {
            "status": F.lit(status),
            "finished_at": F.current_timestamp(),
            "inserted_raw_count": F.lit(inserted),
            "cleaned_records_count": F.lit(cleaned),
            "enriched_records_count": F.lit(enriched),
            "failed_records_count": F.lit(failed),
            "error_message": F.lit(error).cast("string"),
        }
    )


def fail_run(opened: DataFrame, total: int, error: str) -> DataFrame:
    """A run that broke: every record failed, none inserted."""
    return close_run(opened, "failed", 0, total, error=error)


def latest_runs(ledger: DataFrame) -> DataFrame:
    """One row per run: the closing row once there is one."""
    rest = [c for c in ledger.columns if c != "pipeline_run_id"]
    order = F.struct(F.col("finished_at").isNotNull(), F.col("finished_at"))
    picked = ledger.groupBy("pipeline_run_id").agg(
        F.max_by(F.struct(*rest), order).alias("_row")
    )
    return picked.select("pipeline_run_id", *[F.col("_row")[c].alias(c) for c in rest])
