"""Reports over the marts and the vocabulary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions.roles import role_label
from hirelens.operators.analysis import with_seniority


def category_distribution(skills: DataFrame) -> DataFrame:
    return (
        skills.groupBy("skill_category")
        .agg(F.count("*").alias("skill_count"))
        .orderBy(F.col("skill_count").desc(), "skill_category")
    )


def invalid_categories(
    skills: DataFrame, known: Sequence[str] = V.SKILL_CATEGORIES
) -> DataFrame:
    """Skills whose category is not one of the known ones; a missing category is not known."""
    valid = F.coalesce(F.col("skill_category").isin(list(known)), F.lit(False))
    return skills.filter(~valid).select("skill_id", "skill_name", "skill_category")


def skill_listing(skills: DataFrame) -> DataFrame:
    return skills.select("skill_category", "skill_name").orderBy("skill_category", "skill_name")


def top_skills(skills: DataFrame, links: DataFrame) -> DataFrame:
    """Skills by number of jobs. Names shared by several ids are counted together,
    each job once."""
    pairs = links.select("skill_id", "job_id").join(
        skills.select("skill_id", "skill_name", "skill_category"), "skill_id"
    )
    return (
        pairs.groupBy("skill_name", "skill_category")
        .agg(F.countDistinct("job_id").alias("job_count"))
        .orderBy(F.col("job_count").desc(), "skill_name")
    )


def long_mentions(
    links: DataFrame,
    skills: DataFrame,
    longer_than: int = V.LONG_MENTION_LENGTH,
    rows: int = V.LONG_MENTION_ROWS,
) -> DataFrame:
    """The longest mentions, counted per skill before they meet its name."""
    counted = (
        links.filter(F.length("raw_mention") > longer_than)
        .groupBy("raw_mention", "skill_id")
        .agg(F.count("*").alias("_links"))
    )
    named = counted.join(skills.select("skill_id", "skill_name"), "skill_id")
    return (
        named.groupBy("raw_mention", "skill_name")
        .agg(F.sum("_links").alias("mention_count"))
        .orderBy(F.length("raw_mention").desc(), "raw_mention", "skill_name")
        .limit(rows)
    )


def jobs_by_role(explorer: DataFrame) -> DataFrame:
    """Analyzable jobs per role with a readable label."""
    kept = explorer.filter(
        (F.col("is_excluded_from_analysis") == F.lit(False)) & F.col("detected_role").isNotNull()
    )
    return (
        kept.groupBy("detected_role")
        .agg(F.count("*").alias("job_count"))
        .withColumn("role_label", role_label(F.col("detected_role")))
        .orderBy(F.col("job_count").desc(), "role_label")
    )


def role_skill_table(
    mart: DataFrame, role: str, top: int = 15, min_demand: float = 0
) -> DataFrame:
    """The top skills of one role above a demand threshold."""
    kept = mart.filter(
        (F.col("detected_role") == role) & (F.col("demand_percentage") >= F.lit(min_demand))
    )
    return (
        kept.orderBy("skill_rank", "skill_name", "skill_id")
        .limit(top)
        .select(
            F.col("skill_rank").alias("Rank"),
            F.col("skill_name").alias("Skill"),
            F.col("skill_category").alias("Category"),
            F.col("jobs_with_skill").alias("Jobs with skill"),
            F.col("total_jobs_for_role").alias("Total role jobs"),
            F.col("demand_percentage").alias("Demand %"),
        )
    )


def category_skills(mart: DataFrame, category: str | None = None) -> DataFrame:
    """Mentions and mean demand of the skills of one category, or of all."""
    rows = mart if category is None else mart.filter(F.col("skill_category") == category)
    return (
        rows.groupBy("skill_name", "skill_category")
        .agg(
            F.sum("jobs_with_skill").alias("total_role_skill_mentions"),
            F.avg(F.col("demand_percentage").cast("double")).alias("avg_demand_percentage"),
        )
        .orderBy(F.col("total_role_skill_mentions").desc(), "skill_name")
    )


def category_listing(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.col("job_skill_links").desc(), "skill_category")


def options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values, NULL dropped."""
    return df.select(column).na.drop().distinct().orderBy(column)


def skill_options(mart: DataFrame) -> DataFrame:
    """One readable spelling per skill name: one with a capital wins over an
    all-lowercase one, then the alphabetically first; sorted without case."""
    spelled = mart.select(F.trim("skill_name").alias("skill_name")).filter(
        F.col("skill_name") != ""
    )
    key = F.lower("skill_name")
    plain = (F.col("skill_name") == key) & (F.upper("skill_name") != key)
    return (
        spelled.groupBy(key.alias("skill_key"))
        .agg(F.min_by("skill_name", F.struct(plain.cast("int"), "skill_name")).alias("skill_name"))
        .orderBy("skill_key")
    )


def explore_jobs(
    explorer: DataFrame,
    only_analyzable: bool = True,
    roles: Sequence[str] | None = None,
    search: str = "",
    as_pattern: bool = False,
) -> DataFrame:
    """Filtered job list for display.

    An empty role selection does not filter. The search looks at title,
    company, location and skills without case, as plain text unless
    ``as_pattern`` asks for a regular expression.
    """
    rows = explorer
    if only_analyzable:
        rows = rows.filter(F.col("is_excluded_from_analysis") == F.lit(False))
    if roles:
        rows = rows.filter(F.col("detected_role").isin(list(roles)))
    wanted = search.strip().lower()
    if wanted:
        test = F.lit(False)
        for column in ("job_title", "company_name", "location_text", "skill_names"):
            text = F.lower(F.coalesce(column, F.lit("")))
            test = test | (text.rlike(wanted) if as_pattern else text.contains(wanted))
        rows = rows.filter(test)
    status = F.when(F.col("is_excluded_from_analysis"), "Excluded").when(
        ~F.col("is_excluded_from_analysis"), "Included"
    )
    return rows.select(
        "job_id",
        F.col("job_title").alias("Job title"),
        F.col("company_name").alias("Company"),
        F.col("location_text").alias("Location"),
        F.col("detected_role").alias("Detected role"),
        status.alias("Analysis status"),
        F.coalesce("skill_names", F.lit(V.NO_SKILLS_TEXT)).alias("Skills"),
        F.col("source_url").alias("Source"),
    ).na.fill("")


def seniority_distribution(jobs: DataFrame) -> DataFrame:
    """Jobs and share per documented seniority class."""
    counts = with_seniority(jobs).groupBy("seniority").agg(F.count("*").alias("jobs"))
    everything = Window.partitionBy(F.lit(1))  # at most five class rows
    share = F.col("jobs") * 100.0 / F.sum("jobs").over(everything)
    return counts.withColumn("percentage", F.round(share, 2))


def seniority_by_role(jobs: DataFrame, analysis: DataFrame) -> DataFrame:
    """Jobs per role and documented seniority class, and the class's share of its role.
    Jobs without a role, or left out of the analysis, do not count."""
    classed = with_seniority(jobs).select("job_id", "seniority")
    roles = analysis.filter(
        F.col("detected_role").isNotNull() & ~F.col("is_excluded_from_analysis")
    ).select("job_id", "detected_role")
    counts = (
        classed.join(roles, "job_id")
        .groupBy("detected_role", "seniority")
        .agg(F.count("*").alias("jobs"))
    )
    role = Window.partitionBy("detected_role")  # at most five class rows a role
    share = F.col("jobs") * 100.0 / F.sum("jobs").over(role)
    return counts.withColumn("percentage", F.round(share, 2))


def skill_counts_by_seniority(jobs: DataFrame, links: DataFrame, skills: DataFrame) -> DataFrame:
    classed = with_seniority(jobs).select("job_id", "seniority")
    counted = (
        links.select("job_id", "skill_id")
        .join(classed, "job_id")
        .groupBy("seniority", "skill_id")
        .agg(F.countDistinct("job_id").alias("jobs_with_skill"))
    )
    return counted.join(skills.select("skill_id", "skill_name"), "skill_id")


def top_locations(jobs: DataFrame, top: int = 20) -> DataFrame:
    return (
        jobs.filter(F.col("location_text").isNotNull())
        .groupBy("location_text")
        .agg(F.count("*").alias("job_count"))
        .orderBy(F.col("job_count").desc(), "location_text")
        .limit(top)
    )
