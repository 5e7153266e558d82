"""Staging projections and the four marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.operators.keyed import with_global_index

STAGING_COLUMNS = {
    "stg_job_postings": [
        "job_id", "raw_job_id", "pipeline_run_id", "source_name", "source_job_id", "source_url",
        "job_title", "company_name", "location_text", "country", "remote_type",
        "employment_type", "seniority_level", "job_function", "industries",
        "posted_time_text", "applicants_text", "description_text", "scraped_at", "cleaned_at",
    ],
    "stg_job_analysis": [
        "job_id", "detected_role", "analysis_method", "confidence_score", "role_reason",
        "is_excluded_from_analysis", "exclusion_reason", "analyzed_at",
    ],
    "stg_job_skills": [
        "job_id", "skill_id", "extraction_method", "raw_mention", "confidence_score",
        "created_at",
    ],
    "stg_skills": ["skill_id", "skill_name", "skill_category", "created_at", "updated_at"],
}
STAGING_SOURCES = {
    "stg_job_postings": "job_postings",
    "stg_job_analysis": "job_analysis",
    "stg_job_skills": "job_skills",
    "stg_skills": "skills",
}


def staging(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The staging projections; the raw HTML column is left behind."""
    return {
        view: tables[STAGING_SOURCES[view]].select(*columns)
        for view, columns in STAGING_COLUMNS.items()
        if STAGING_SOURCES[view] in tables
    }


def register_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def eligible_jobs(jobs: DataFrame, analysis: DataFrame) -> DataFrame:
    kept = analysis.filter(
        (F.col("is_excluded_from_analysis") == F.lit(False))
        & ~F.col("detected_role").isin(V.NON_TARGET_ROLES)
    ).select("job_id", "detected_role")
    return jobs.select("job_id").join(kept, "job_id")


def role_totals(jobs: DataFrame, analysis: DataFrame) -> DataFrame:
    """Eligible jobs per role, with or without skills."""
    return eligible_jobs(jobs, analysis).groupBy("detected_role").agg(
        F.countDistinct("job_id").alias("total_jobs_for_role")
    )


def skill_counts(jobs: DataFrame, analysis: DataFrame, links: DataFrame) -> DataFrame:
    """Eligible jobs per role and skill.

    The distinct count is planned as a partial distinct on (role, skill, job)
    and a partial count, so a skill that most jobs ask for is reduced before
    its rows meet.
    """
    return (
        eligible_jobs(jobs, analysis)
        .join(links.select("job_id", "skill_id"), "job_id")
        .groupBy("detected_role", "skill_id")
        .agg(F.countDistinct("job_id").alias("jobs_with_skill"))
    )


def demand_percentage(part: Column, total: Column) -> Column:
    """Share in percent, two decimals, halves away from zero; NULL without a total."""
    return F.round(
        part.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
        / F.nullif(total, F.lit(0)).cast("decimal(20,0)"),
        2,
    ).cast("decimal(27,2)")


def skill_demand(
    jobs: DataFrame, analysis: DataFrame, links: DataFrame, skills: DataFrame
) -> DataFrame:
    """Demand per role and skill, not yet ranked."""
    return demand_of(
        skill_counts(jobs, analysis, links), role_totals(jobs, analysis), skills
    )


def demand_of(counts: DataFrame, totals: DataFrame, skills: DataFrame) -> DataFrame:
    """Demand from the jobs per role and skill and the jobs per role."""
    return (
        counts.join(totals, "detected_role")
        .join(skills.select("skill_id", "skill_name", "skill_category"), "skill_id")
        .select(
            "detected_role",
            "skill_id",
            "skill_name",
            "skill_category",
            "jobs_with_skill",
            "total_jobs_for_role",
            demand_percentage(F.col("jobs_with_skill"), F.col("total_jobs_for_role")).alias(
                "demand_percentage"
            ),
        )
    )


def sliced_rank(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], ties: Sequence[str], name: str
) -> DataFrame:
    """RANK() without one sort per group: 1 + first index of the tie - first of the group."""
    by = [F.col(c) for c in group]
    unique = [F.col(c) for c in df.columns if c not in group and c not in ties]
    indexed = with_global_index(df, [*by, *order, *unique])
    group_start = indexed.groupBy(*group).agg(F.min("_index").alias("_first"))
    tie_start = indexed.groupBy(*group, *ties).agg(F.min("_index").alias("_tie"))
    return (
        indexed.join(tie_start, [*group, *ties])
        .join(group_start, list(group))
        .withColumn(name, (F.col("_tie") - F.col("_first") + 1).cast("int"))
        .drop("_index", "_tie", "_first")
    )


def top_skills_by_role(
    jobs: DataFrame,
    analysis: DataFrame,
    links: DataFrame,
    skills: DataFrame,
    collation: str | None = None,
) -> DataFrame:
    """Skill demand and rank within each role."""
    return rank_demand(skill_demand(jobs, analysis, links, skills), collation)


def rank_demand(demand: DataFrame, collation: str | None = None) -> DataFrame:
    by_name = F.collate("skill_name", collation) if collation else F.col("skill_name")
    order = [F.col("jobs_with_skill").desc(), by_name]
    ranked = sliced_rank(
        demand, ["detected_role"], order, ["jobs_with_skill", "skill_name"], "skill_rank"
    )
    return ranked.select(
        "detected_role",
        "skill_id",
        "skill_name",
        "skill_category",
        "jobs_with_skill",
        "total_jobs_for_role",
        "demand_percentage",
        "skill_rank",
    )


def market_overview(
    jobs: DataFrame, analysis: DataFrame, links: DataFrame, skills: DataFrame
) -> DataFrame:
    """One row of market totals.

    Jobs meet their analysis on job_id once, and everything about them is counted in that one
    pass: a job's flags and its distinct names stay with the job, then each job gives a row of
    its flags and one per name, merged per task before the names meet. Skills and links are
    read once each.
    """
    joined = jobs.select("job_id", "company_name", "source_name").join(
        analysis.select("job_id", "detected_role", "is_excluded_from_analysis"), "job_id", "left"
    )
    flag = F.col("is_excluded_from_analysis")
    names = {"company": "company_name", "source": "source_name", "role": "detected_role"}
    per_job = joined.groupBy("job_id").agg(
        F.coalesce(F.max((flag == F.lit(False)).cast("int")), F.lit(0)).alias("_in"),
        F.coalesce(F.max((flag == F.lit(True)).cast("int")), F.lit(0)).alias("_out"),
        *[F.collect_set(column).alias(kind) for kind, column in names.items()],
    )

    def entry(kind: str, name: Column, inside, outside) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), name.alias("name"), inside.alias("inside"),
            outside.alias("outside"))

    none, zero = F.lit(None).cast("string"), F.lit(0)
    own = F.array(F.when(
        F.col("job_id").isNotNull(), entry("job", none, F.col("_in"), F.col("_out"))))

    def named(kind: str) -> Column:
        return F.transform(kind, lambda name: entry(kind, name, zero, zero))

    rows = F.concat(F.array_compact(own), *map(named, names))
    counted = per_job.select(F.inline(rows)).groupBy("kind", "name").agg(
        F.count("*").alias("n"), F.sum("inside").alias("inside"), F.sum("outside").alias("outside")
    )

    def number(kind: str, column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(column))), zero)

    totals = counted.agg(
        number("job", "n").alias("total_jobs"),
        F.count_if(F.col("kind") == "company").alias("total_companies"),
        F.count_if(F.col("kind") == "source").alias("total_sources"),
        F.count_if(F.col("kind") == "role").alias("total_detected_roles"),
        number("job", "inside").alias("analyzable_jobs"),
        number("job", "outside").alias("excluded_jobs"),
    )
    pair = links.select("job_id", "skill_id").distinct().agg(
        F.count("*").alias("total_job_skill_links")
    )
    ids = skills.select("skill_id").distinct().agg(F.count("*").alias("total_skills"))
    rows = totals
    for frame in (ids, pair):
        rows = rows.unionByName(frame, allowMissingColumns=True)
    return rows.agg(
        *[
            F.max(c).cast("bigint").alias(c)
            for c in (
                "total_jobs", "total_companies", "total_sources", "total_detected_roles",
                "analyzable_jobs", "excluded_jobs", "total_skills", "total_job_skill_links",
            )
        ]
    )


def skills_by_category(skills: DataFrame, links: DataFrame) -> DataFrame:
    """Skills, jobs and links per category; a skill without links counts as one link.

    Links are counted per skill before they meet the skills, and distinct jobs
    per (category, job), so neither a hot skill nor a hot category is one task.
    """
    per_skill = links.groupBy("skill_id").agg(F.count("*").alias("_links"))
    jobs = (
        links.select("skill_id", "job_id")
        .join(skills.select("skill_id", "skill_category"), "skill_id")
        .select("skill_category", "job_id")
        .distinct()
        .groupBy("skill_category")
        .agg(F.count("job_id").alias("jobs_with_category"))
    )
    return category_totals(skills, per_skill, jobs)


def category_totals(skills: DataFrame, per_skill: DataFrame, jobs: DataFrame) -> DataFrame:
    """Category rows from the links per skill (`_links`) and the jobs per category."""
    counted = skills.select("skill_id", "skill_category").join(per_skill, "skill_id", "left")
    totals = counted.groupBy("skill_category").agg(
        F.countDistinct("skill_id").alias("distinct_skills_count"),
        F.sum(F.coalesce("_links", F.lit(1))).alias("job_skill_links"),
    )
    result = totals.alias("t").join(
        jobs.alias("j"), F.col("t.skill_category").eqNullSafe(F.col("j.skill_category")), "left"
    )
    return result.select(
        F.col("t.skill_category").alias("skill_category"),
        "distinct_skills_count",
        F.coalesce("jobs_with_category", F.lit(0)).cast("bigint").alias("jobs_with_category"),
        F.col("job_skill_links").cast("bigint").alias("job_skill_links"),
    )


def joined_set(column: str, collation: str | None = None) -> Column:
    """Distinct values in order, comma-joined; NULL when there are none."""
    values = F.collect_set(column)
    if collation:
        keyed = F.transform(
            values, lambda v: F.struct(F.collate(v, collation).alias("key"), v.alias("value"))
        )
        ordered = F.transform(F.array_sort(keyed), lambda pair: pair["value"])
    else:
        ordered = F.array_sort(values)
    return F.when(F.size(values) > 0, F.array_join(ordered, ", "))


def skills_per_job(
    links: DataFrame, skills: DataFrame, collation: str | None = None
) -> DataFrame:
    """One narrow row per job with its distinct skill names and categories."""
    return (
        links.select("job_id", "skill_id")
        .join(skills.select("skill_id", "skill_name", "skill_category"), "skill_id")
        .groupBy("job_id")
        .agg(
            joined_set("skill_name", collation).alias("skill_names"),
            joined_set("skill_category", collation).alias("skill_categories"),
        )
    )


def job_explorer(
    jobs: DataFrame,
    analysis: DataFrame,
    links: DataFrame,
    skills: DataFrame,
    collation: str | None = None,
) -> DataFrame:
    """One row per job with its role, exclusion and skills.

    Skills are folded to one row per job before they meet the wide job rows.
    """
    posted = jobs.select(
        "job_id", "job_title", "company_name", "location_text", "country", "remote_type",
        "employment_type", "seniority_level", "source_name", "source_url",
    )
    judged = analysis.select(
        "job_id",
        "detected_role",
        F.col("confidence_score").alias("role_confidence_score"),
        "is_excluded_from_analysis",
        "exclusion_reason",
    )
    return (
        posted.join(judged, "job_id", "left")
        .join(skills_per_job(links, skills, collation), "job_id", "left")
        .select(
            "job_id", "job_title", "company_name", "location_text", "country", "remote_type",
            "employment_type", "seniority_level", "detected_role", "role_confidence_score",
            "is_excluded_from_analysis", "exclusion_reason", "source_name", "source_url",
            "skill_names", "skill_categories",
        )
    )


def build_marts(views: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All four marts with their build time."""
    jobs, analysis = views["stg_job_postings"], views["stg_job_analysis"]
    links, skills = views["stg_job_skills"], views["stg_skills"]
    marts = {
        "mart_market_overview": market_overview(jobs, analysis, links, skills),
        "mart_top_skills_by_role": top_skills_by_role(jobs, analysis, links, skills),
        "mart_skills_by_category": skills_by_category(skills, links),
        "mart_job_explorer": job_explorer(jobs, analysis, links, skills),
    }
    return {name: df.withColumn("built_at", F.current_timestamp()) for name, df in marts.items()}
