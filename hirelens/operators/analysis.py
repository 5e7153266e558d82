"""Role and eligibility of each posting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.functions.once import with_computed
from hirelens.functions.roles import (
    SENIORITY_INDEX,
    exclusion_reason,
    role_texts,
    seniority,
    with_detected_role,
)
from hirelens.operators.keyed import upsert

ANALYSIS_COLUMNS = [
    "job_id", "detected_role", "analysis_method", "confidence_score", "role_reason",
    "is_excluded_from_analysis", "exclusion_reason",
]


def analyze(jobs: DataFrame) -> DataFrame:
    """One analysis row per job.

    The normalised texts are computed in a select of their own, so the rules
    read them as columns instead of normalising once per rule.
    """
    columns = ["job_id", "job_title", "description_text", "job_function", "industries"]
    title, context = role_texts("job_title", "description_text", "job_function", "industries")
    texts = with_computed(jobs.select(*columns), {"_title": title, "_context": context}).select(
        "job_id", "_title", "_context")
    judged = with_detected_role(texts).withColumn(
        "exclusion_reason", exclusion_reason(F.col("_title"))
    )
    return judged.select(
        "job_id",
        "detected_role",
        F.lit("rule_based").alias("analysis_method"),
        F.col("role_confidence").alias("confidence_score"),
        "role_reason",
        F.col("exclusion_reason").isNotNull().alias("is_excluded_from_analysis"),
        "exclusion_reason",
    )


def analysis_report(analysis: DataFrame) -> DataFrame:
    return analysis.agg(
        F.count("*").alias("analyzed_count"),
        F.count_if("is_excluded_from_analysis").alias("excluded_count"),
        F.count_if(F.col("detected_role").isNull()).alias("failed_count"),
    )


def upsert_analysis(existing: DataFrame, rows: DataFrame) -> DataFrame:
    now = F.current_timestamp()
    return upsert(
        existing,
        rows,
        ["job_id"],
        [c for c in ANALYSIS_COLUMNS if c != "job_id"],
        None,  # one row per job
        on_update={"updated_at": now},
        on_insert={"analyzed_at": now, "updated_at": now},
    )


def with_seniority(jobs: DataFrame) -> DataFrame:
    """Add the documented seniority class from title and description."""
    nothing = F.lit(None).cast("string")
    _, context = role_texts("job_title", "description_text", nothing, nothing)
    found = with_computed(jobs, {"_found": SENIORITY_INDEX.found(context)})
    return found.withColumn("seniority", seniority(F.col("_found"))).drop("_found")
