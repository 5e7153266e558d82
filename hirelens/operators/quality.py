"""Data-quality checks: each returns the failing rows, none when it passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens import fixed_values as V


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Repeated keys with their row count; keys with a NULL are not compared."""
    counted = df.na.drop(subset=list(columns)).groupBy(*columns)
    return counted.agg(F.count("*").alias("row_count")).filter("row_count > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list with their row count; NULL passes."""
    wrong = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return wrong.groupBy(column).agg(F.count("*").alias("row_count"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row count.

    Keys are counted before the join, so a key shared by many child rows
    crosses the join once.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column)
    counted = keys.agg(F.count("*").alias("row_count"))
    return counted.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")


def in_range(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter((F.col(column) < F.lit(low)) | (F.col(column) > F.lit(high)))


def one_row(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows")).filter("total_rows <> 1")


def case_variants(
    df: DataFrame, column: str, trim: bool = False, repeats: bool = False
) -> DataFrame:
    """Names equal but for case, with row count and the list of spellings, largest first.

    Equal spellings are counted before the names meet, so that a common one is one row.
    Each is listed once, or with `repeats` as often as it occurs.
    """
    spelled = df.filter(F.col(column).isNotNull()).groupBy(column)
    counted = spelled.agg(F.count("*").alias("_rows"))
    key = F.lower(F.trim(column)) if trim else F.lower(column)
    spellings = F.array_sort(F.collect_list(F.struct(F.col(column).alias("name"), "_rows")))
    listed = F.flatten(
        F.transform(
            spellings,
            lambda s: F.array_repeat(s["name"], s["_rows"].cast("int") if repeats else F.lit(1)),
        )
    )
    return (
        counted.groupBy(key.alias("normalized_skill_name"))
        .agg(
            F.sum("_rows").alias("row_count"),
            F.array_join(listed, ", ").alias("variants"),
        )
        .filter("row_count > 1")
        .orderBy(F.col("row_count").desc(), "normalized_skill_name")
    )


def invalid_demand(mart: DataFrame) -> DataFrame:
    return mart.filter(
        (F.col("demand_percentage") < 0)
        | (F.col("demand_percentage") > 100)
        | (F.col("jobs_with_skill") < 0)
        | (F.col("total_jobs_for_role") <= 0)
        | (F.col("jobs_with_skill") > F.col("total_jobs_for_role"))
    ).select(
        "detected_role",
        "skill_id",
        "skill_name",
        "jobs_with_skill",
        "total_jobs_for_role",
        "demand_percentage",
    )


NOT_NULL = {
    "stg_job_postings": [
        "job_id", "raw_job_id", "source_name", "source_job_id", "job_title", "description_text",
    ],
    "stg_job_analysis": [
        "job_id", "detected_role", "analysis_method", "is_excluded_from_analysis",
    ],
    "stg_skills": ["skill_id", "skill_name", "skill_category"],
    "stg_job_skills": ["job_id", "skill_id", "extraction_method"],
    "mart_market_overview": [
        "total_jobs", "total_companies", "total_sources", "total_detected_roles",
        "analyzable_jobs", "excluded_jobs", "total_skills", "total_job_skill_links", "built_at",
    ],
    "mart_top_skills_by_role": [
        "detected_role", "skill_id", "skill_name", "skill_category", "jobs_with_skill",
        "total_jobs_for_role", "demand_percentage", "skill_rank",
    ],
    "mart_skills_by_category": [
        "skill_category", "distinct_skills_count", "jobs_with_category", "job_skill_links",
    ],
    "mart_job_explorer": ["job_id", "job_title", "detected_role", "is_excluded_from_analysis"],
}
UNIQUE = {
    "stg_job_postings": [["job_id"]],
    "stg_job_analysis": [["job_id"]],
    "stg_skills": [["skill_id"], ["skill_name"]],
    "stg_job_skills": [["job_id", "skill_id"]],
    "mart_skills_by_category": [["skill_category"]],
    "mart_job_explorer": [["job_id"]],
    "mart_top_skills_by_role": [["detected_role", "skill_id"]],
}
ACCEPTED = {
    ("stg_job_analysis", "detected_role"): V.ROLES,
    ("stg_job_analysis", "analysis_method"): V.ANALYSIS_METHODS,
    ("stg_skills", "skill_category"): V.SKILL_CATEGORIES,
    ("stg_job_skills", "extraction_method"): V.EXTRACTION_METHODS,
    ("mart_top_skills_by_role", "detected_role"): V.TARGET_ROLES,
    ("mart_top_skills_by_role", "skill_category"): V.SKILL_CATEGORIES,
    ("mart_skills_by_category", "skill_category"): V.SKILL_CATEGORIES,
    ("mart_job_explorer", "detected_role"): V.ROLES,
}
RELATIONSHIPS = [
    ("stg_job_analysis", "job_id", "stg_job_postings", "job_id"),
    ("stg_job_skills", "job_id", "stg_job_postings", "job_id"),
    ("stg_job_skills", "skill_id", "stg_skills", "skill_id"),
    ("mart_top_skills_by_role", "skill_id", "stg_skills", "skill_id"),
    ("mart_job_explorer", "job_id", "stg_job_postings", "job_id"),
]


def not_null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL counts of several columns in one scan, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in columns])
    return counts.select(F.explode(pairs).alias("p")).select(
        F.col("p.c").alias("column_name"), F.col("p.n").alias("failures")
    )


def run_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared check over the staging views and marts: one row per check."""
    reports: list[DataFrame] = []

    def record(check: str, table: str, column: str, failing: DataFrame) -> None:
        reports.append(
            failing.agg(F.count("*").alias("failures")).select(
                F.lit(check).alias("check_name"),
                F.lit(table).alias("table_name"),
                F.lit(column).alias("column_name"),
                "failures",
            )
        )

    for table, columns in NOT_NULL.items():
        if table in tables:
            reports.append(
                not_null_report(tables[table], columns).select(
                    F.lit("not_null").alias("check_name"),
                    F.lit(table).alias("table_name"),
                    "column_name",
                    "failures",
                )
            )
    for table, keys in UNIQUE.items():
        for columns in keys:
            if table in tables:
                record("unique", table, ",".join(columns), unique(tables[table], columns))
    for (table, column), values in ACCEPTED.items():
        if table in tables:
            record("accepted_values", table, column,
                   accepted_values(tables[table], column, values))
    for child, column, parent, key in RELATIONSHIPS:
        if child in tables and parent in tables:
            record("relationships", child, column,
                   relationships(tables[child], column, tables[parent], key))
    if "stg_job_skills" in tables:
        record("range", "stg_job_skills", "confidence_score",
               in_range(tables["stg_job_skills"], "confidence_score", 0, 1))
    if "mart_market_overview" in tables:
        record("one_row", "mart_market_overview", "*", one_row(tables["mart_market_overview"]))
    if "stg_skills" in tables:
        record("case_variants", "stg_skills", "skill_name",
               case_variants(tables["stg_skills"], "skill_name", trim=True))
    if "mart_top_skills_by_role" in tables:
        record("demand", "mart_top_skills_by_role", "demand_percentage",
               invalid_demand(tables["mart_top_skills_by_role"]))
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result
