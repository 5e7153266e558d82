"""Skill gaps of any number of people against market demand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.operators.keyed import with_global_index
from hirelens.session import freeze


def skill_key(name: Column) -> Column:
    return F.lower(F.trim(name))


def top_role_skills(demand: DataFrame, top: int = V.GAP_SKILLS) -> DataFrame:
    """The most demanded skills of every role.

    Works on unranked demand: the row_number filter is pushed below the
    shuffle, so each task hands over at most ``top`` rows per role.
    """
    order = Window.partitionBy("detected_role").orderBy(
        F.col("jobs_with_skill").desc(), "skill_name", "skill_id"
    )
    return (
        demand.withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= top)
    )


def required_skills(demand: DataFrame, top: int = V.GAP_SKILLS) -> DataFrame:
    """Required skills per role, once per name; of equal names the last row's values count."""
    kept = top_role_skills(demand, top).filter(F.col("skill_name").isNotNull())
    rest = ["skill_name", "skill_category", "demand_percentage", "jobs_with_skill",
            "total_jobs_for_role", "position"]
    last = kept.withColumn("skill_name", F.trim("skill_name")).groupBy(
        "detected_role", skill_key(F.col("skill_name")).alias("skill_key")
    ).agg(F.max_by(F.struct(*rest), "position").alias("_row"))
    return last.select(
        "detected_role", "skill_key", *[F.col("_row")[c].alias(c) for c in rest]
    )


def prepare_required(demand: DataFrame, top: int = V.GAP_SKILLS) -> DataFrame:
    """The required skills computed once; the join strategy is left to adaptive execution."""
    return freeze(required_skills(demand, top))


def role_skills(demand: DataFrame) -> DataFrame:
    """Every skill of every role, once per name; of equal names the least demanded row counts.

    The whole demand, without a limit: what a match score is taken from.
    """
    last = F.struct(-F.col("jobs_with_skill"), F.col("skill_name"), F.col("skill_id"))
    rest = ["skill_category", "demand_percentage", "jobs_with_skill", "total_jobs_for_role"]
    one = (
        demand.filter(F.col("skill_name").isNotNull())
        .groupBy("detected_role", skill_key(F.col("skill_name")).alias("skill_key"))
        .agg(F.max_by(F.struct(F.trim("skill_name").alias("skill_name"), *rest), last).alias("_r"))
    )
    return one.select("detected_role", "skill_key", "_r.*")


def ranked_role_skills(demand: DataFrame) -> DataFrame:
    """Every skill of every role with its position from 1, most demanded first. Positions
    come from range slices, so no task sorts a whole role."""
    indexed = with_global_index(
        role_skills(demand),
        ["detected_role", F.col("jobs_with_skill").desc(), "skill_name", "skill_key"],
    )
    first = indexed.groupBy("detected_role").agg(F.min("_index").alias("_first"))
    return indexed.join(first, "detected_role").withColumn(
        "position", (F.col("_index") - F.col("_first") + 1).cast("int")
    ).drop("_index", "_first")


def matched_skills(
    targets: DataFrame, student_skills: DataFrame, required: DataFrame
) -> DataFrame:
    """Required skills each student has, per target role.

    ``targets`` is (student_id, detected_role), ``student_skills`` is
    (student_id, skill). Skills no role asks for are dropped first, by the
    short required list, so that only matches are joined with the students.
    ``required`` is used several times: pass a prepared frame.
    """
    owned = student_skills.select("student_id", skill_key(F.col("skill")).alias("skill_key"))
    useful = owned.join(required.select("skill_key"), "skill_key", "left_semi").distinct()
    return (
        useful.join(targets.select("student_id", "detected_role").distinct(), "student_id")
        .join(required, ["detected_role", "skill_key"])
    )


def gap_summary(
    targets: DataFrame, student_skills: DataFrame, required: DataFrame
) -> DataFrame:
    """Checked and covered skills and coverage percent per student and target role."""
    per_role = required.groupBy("detected_role").agg(F.count("*").alias("required_count"))
    matched = matched_skills(targets, student_skills, required).groupBy(
        "student_id", "detected_role"
    ).agg(F.count("*").alias("matched_count"))
    rows = (
        targets.select("student_id", "detected_role").distinct()
        .join(matched, ["student_id", "detected_role"], "left")
        .join(per_role, "detected_role", "left")
        .na.fill(0, ["matched_count", "required_count"])
    )
    share = F.col("matched_count") * 100.0 / F.nullif(F.col("required_count"), F.lit(0))
    return rows.select(
        "student_id",
        "detected_role",
        "required_count",
        "matched_count",
        F.coalesce(F.round(share.cast("double"), 2), F.lit(0.0)).alias("coverage"),
    )


def missing_skills(
    targets: DataFrame, student_skills: DataFrame, required: DataFrame
) -> DataFrame:
    """Required skills each student lacks, most demanded first.

    Each role's requirement is one short array joined to the target rows; what
    a student has is one short array too, and the difference is taken inside
    the row.
    """
    fields = ["position", "skill_key", "skill_name", "skill_category", "demand_percentage",
              "jobs_with_skill", "total_jobs_for_role"]
    per_role = required.groupBy("detected_role").agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("_required")
    )
    have = matched_skills(targets, student_skills, required).groupBy(
        "student_id", "detected_role"
    ).agg(F.collect_set("skill_key").alias("_have"))
    rows = (
        targets.select("student_id", "detected_role").distinct()
        .join(have, ["student_id", "detected_role"], "left")
        .join(per_role, "detected_role")
    )
    lacking = F.filter(
        "_required",
        lambda r: ~F.coalesce(F.array_contains("_have", r["skill_key"]), F.lit(False)),
    )
    return (
        rows.select(
            "student_id", "detected_role", F.posexplode(lacking).alias("_index", "_skill")
        )
        .select(
            "student_id",
            "detected_role",
            (F.col("_index") + 1).alias("learning_rank"),
            *[F.col("_skill")[c].alias(c) for c in fields if c not in ("position", "skill_key")],
        )
    )


def first_missing_skills(
    targets: DataFrame, student_skills: DataFrame, ranked: DataFrame, top: int = V.GAP_SKILLS
) -> DataFrame:
    """The first ``top`` skills each student lacks, of all skills the role asks for.

    ``ranked`` is `ranked_role_skills`, stored. Who owns n of a role's skills finds the first
    missing ones among its first top + n: only these positions are joined.
    """
    matched = matched_skills(targets, student_skills, ranked).select(
        "student_id", "detected_role", "skill_key"
    )
    counts = matched.groupBy("student_id", "detected_role").agg(F.count("*").alias("_n"))
    asked = (
        targets.select("student_id", "detected_role").distinct()
        .join(counts, ["student_id", "detected_role"], "left")
        .withColumn(
            "position", F.explode(F.sequence(F.lit(1), F.coalesce("_n", F.lit(0)) + top))
        )
        .withColumn("position", F.col("position").cast("int"))
        .drop("_n")
    )
    lacking = asked.join(ranked, ["detected_role", "position"]).join(
        matched, ["student_id", "detected_role", "skill_key"], "left_anti"
    )
    order = Window.partitionBy("student_id", "detected_role").orderBy("position")
    return (
        lacking.withColumn("learning_rank", F.row_number().over(order))
        .filter(F.col("learning_rank") <= top)
        .drop("position", "skill_key")
    )


def match_score(
    targets: DataFrame, student_skills: DataFrame, required: DataFrame
) -> DataFrame:
    """Share of the role's demand that the student's skills cover, in percent.

    ``required`` is the role's whole demand, `role_skills`, stored.
    """
    total = required.groupBy("detected_role").agg(
        F.sum("demand_percentage").alias("_total")
    )
    owned = matched_skills(targets, student_skills, required).groupBy(
        "student_id", "detected_role"
    ).agg(F.sum("demand_percentage").alias("_owned"))
    rows = (
        targets.select("student_id", "detected_role").distinct()
        .join(owned, ["student_id", "detected_role"], "left")
        .join(total, "detected_role")
    )
    score = F.coalesce("_owned", F.lit(0)).cast("double") * 100.0 / F.nullif(
        F.col("_total").cast("double"), F.lit(0.0)
    )
    return rows.select("student_id", "detected_role", F.round(score, 2).alias("match_score"))


def skill_combinations(
    eligible: DataFrame, links: DataFrame, demand: DataFrame
) -> DataFrame:
    """How many jobs of a role ask for exactly which skills together, all skills of a job."""
    wanted = demand.select("detected_role", "skill_id", "skill_name")
    asked = (
        links.select("job_id", "skill_id")
        .join(eligible.select("job_id", "detected_role"), "job_id")
        .join(wanted, ["detected_role", "skill_id"])
    )
    per_job = asked.groupBy("detected_role", "job_id").agg(
        F.array_sort(F.collect_set("skill_name")).alias("_names")
    )
    several = per_job.filter(F.size("_names") > 1)
    return several.groupBy(
        "detected_role", F.array_join("_names", ", ").alias("combination")
    ).agg(F.count("*").alias("jobs"))
