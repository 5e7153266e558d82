"""Raw payloads to cleaned job postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions import payload
from hirelens.functions.once import with_computed
from hirelens.functions.location import parse_country, remote_text, remote_type
from hirelens.functions.text import clean_text
from hirelens.operators.keyed import assign_ids, largest_id, upsert

KEY = ["source_name", "source_job_id"]
CLEANED = {
    "job_title": "title",
    "company_name": "company",
    "location_text": "location",
    "employment_type": "employment_type",
    "seniority_level": "seniority_level",
    "job_function": "job_function",
    "industries": "industries",
    "posted_time_text": "posted_time_text",
    "applicants_text": "applicants_text",
    "description_text": "description_text",
}
CRITERIA = ["employment_type", "seniority_level", "job_function", "industries"]
SILVER_COLUMNS = [
    "raw_job_id", "pipeline_run_id", "source_name", "source_job_id", "source_url", "job_title",
    "company_name", "location_text", "country", "remote_type", "employment_type",
    "seniority_level", "job_function", "industries", "posted_time_text", "applicants_text",
    "description_text", "description_html", "scraped_at",
]
UPDATED = [c for c in SILVER_COLUMNS if c not in KEY]


def project_payload(bronze: DataFrame, criteria_fallback: bool = False) -> DataFrame:
    """Cleaned payload columns beside the bronze columns.

    The payload is parsed once per row, in a select of its own. With
    ``criteria_fallback`` the four criteria columns fall back to the nested
    criteria object, where scraped pages keep them.
    """
    parsed = with_computed(bronze, {"_payload": payload.parse(F.col("raw_payload"))})
    source = F.col("_payload")

    def value(column: str, key: str) -> Column:
        text = clean_text(payload.field(source, key))
        if criteria_fallback and column in CRITERIA:
            text = F.coalesce(text, clean_text(payload.field(source, f"criteria.{key}")))
        return text

    cleaned = {column: value(column, key) for column, key in CLEANED.items()}
    is_object = F.col("raw_payload").rlike(r"^[ \t\r\n]*\{") & source.isNotNull()
    kept = [c for c in ("raw_job_id", "pipeline_run_id", "scraped_at") if c in bronze.columns]
    keys = {c: clean_text(F.col(c)) for c in ("source_name", "source_job_id", "source_url")}
    computed = {
        **keys,
        **cleaned,
        "description_html": payload.field(source, "description_html"),
        "_is_object": F.coalesce(is_object, F.lit(False)),
    }
    return with_computed(parsed, computed).select(*kept, *computed)


def silver_candidates(bronze: DataFrame, criteria_fallback: bool = False) -> DataFrame:
    """Every bronze row as a silver row with its reject_reason, NULL when it is good."""
    projected = project_payload(bronze, criteria_fallback)
    prepared = projected.withColumn(
        "_remote_text", remote_text(F.col("location_text"), F.col("description_text"))
    )
    reason = (
        F.when(~F.col("_is_object"), "invalid raw_payload")
        .when(F.col("job_title").isNull(), "missing job title")
        .when(F.col("description_text").isNull(), "missing description_text")
        .when(F.col("source_name").isNull(), "missing source_name")
        .when(F.col("source_job_id").isNull(), "missing source_job_id")
    )
    return prepared.select(
        *[
            parse_country(F.col("location_text"), is_clean=True).alias(c) if c == "country"
            else remote_type(F.col("_remote_text")).alias(c) if c == "remote_type"
            else F.col(c)
            for c in SILVER_COLUMNS
        ],
        reason.alias("reject_reason"),
    )


def good_rows(candidates: DataFrame) -> DataFrame:
    return candidates.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def silver_report(candidates: DataFrame) -> DataFrame:
    """Rows per reject reason; 'ok' counts the good ones."""
    reason = F.coalesce("reject_reason", F.lit("ok"))
    return candidates.groupBy(reason.alias("result")).agg(F.count("*").alias("records"))


def upsert_postings(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """Postings after the refresh: ids and creation times of known jobs are kept,
    the bronze row with the largest id wins a shared key.

    Winners and new ids are found on the keys alone and joined back on the
    bronze id, which is unique. ``rows`` is read twice: pass a frozen frame.
    """
    now = F.current_timestamp()
    winners = rows.groupBy(*KEY).agg(F.max("raw_job_id").alias("raw_job_id"))
    fresh = winners.join(existing.select(*KEY), KEY, "left_anti").select("raw_job_id")
    ids = assign_ids(fresh, "job_id", ["raw_job_id"], largest_id(existing, "job_id"))
    numbered = winners.select("raw_job_id").join(ids, "raw_job_id", "left")
    return upsert(
        existing,
        rows.join(numbered, "raw_job_id"),
        KEY,
        UPDATED,
        None,
        on_update={"updated_at": now},
        on_insert={"cleaned_at": now, "created_at": now, "updated_at": now},
    )


# --- completeness of raw records --------------------------------------------


def with_missing_fields(
    records: DataFrame, raw: str = "raw_payload", fields: list[str] | None = None
) -> DataFrame:
    """Add missing_fields: required payload fields that are absent, null or empty. The
    payload is parsed once."""
    parsed = with_computed(records, {"_payload": payload.parse(F.col(raw))})
    tests = [
        F.when(_falsy(payload.field(F.col("_payload"), name)), F.lit(name))
        for name in (fields or V.REQUIRED_PAYLOAD_FIELDS)
    ]
    missing = {"missing_fields": F.array_compact(F.array(*tests))}
    return with_computed(parsed, missing).drop("_payload")


def _falsy(text: Column) -> Column:
    return F.coalesce(text.isin("", "0", "false", "[]", "{}"), F.lit(True))


def split_by_completeness(records: DataFrame, keep_partial: bool = False) -> DataFrame:
    """Add missing_fields, status and whether the record is saved."""
    checked = with_missing_fields(records)
    complete = F.size("missing_fields") == 0
    return checked.withColumns(
        {
            "status": F.when(complete, "success").otherwise("partial_success"),
            "is_saved": complete | F.lit(keep_partial),
        }
    )


def collection_failures(checked: DataFrame, fetch_errors: DataFrame | None = None) -> DataFrame:
    """Failure table: partial records with their missing fields, and fetch errors."""
    partial = checked.filter(F.size("missing_fields") > 0).select(
        F.col("source_url").alias("url"),
        "status",
        "missing_fields",
        F.lit(None).cast("string").alias("error"),
        F.col("raw_payload").alias("raw_payload_preview"),
    )
    if fetch_errors is None:
        return partial
    failed = fetch_errors.select(
        "url",
        F.lit("failed").alias("status"),
        F.lit(None).cast("array<string>").alias("missing_fields"),
        "error",
        F.lit(None).cast("string").alias("raw_payload_preview"),
    )
    return partial.unionByName(failed)


def saved_rate(checked: DataFrame) -> DataFrame:
    """Saved records and their share of all, in percent."""
    counts = checked.agg(
        F.count("*").alias("total_records"), F.count_if("is_saved").alias("saved_records")
    )
    rate = F.col("saved_records") * 100.0 / F.nullif(F.col("total_records"), F.lit(0))
    return counts.withColumn("saved_rate", F.round(rate, 2))
