"""Skills that are asked for together: frequent sets of a role's skills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.session import stage


def skill_sets(
    eligible: DataFrame, links: DataFrame, support: int, largest: int | None = None
) -> DataFrame:
    """Sets of two or more skills that at least `support` jobs of a role ask for together:
    detected_role, skill_ids (ascending), skills (how many), jobs (how many ask for all).

    Sets grow level by level. A job's frequent sets of one size are stored as rows; two of them
    that differ in their last skill only make one of the next size, so a set is counted only
    where all but its last or second-last skill is frequent. Counting is a grouped aggregate:
    neither the skills nor the sets pass through the driver. With `largest` only sets of up to
    so many skills are returned. Jobs without a role or skill have no part; repeated links
    count once; without jobs there are no sets.
    """
    if support < 1:
        raise ValueError("support is a number of jobs")
    own = eligible.filter("detected_role is not null").select("job_id", "detected_role").distinct()
    asked = links.select("job_id", F.col("skill_id").cast("bigint").alias("last")).filter(
        "last is not null").distinct()
    held = own.join(asked, "job_id").select(
        "detected_role", "job_id", F.array().cast("array<bigint>").alias("start"), "last")
    sets, size = [], 1
    while True:
        held = stage(held, f"sets-held-{size}")
        key = ["detected_role", "start", "last"]
        frequent = stage(
            held.groupBy(*key).agg(F.count("*").alias("jobs")).filter(F.col("jobs") >= support),
            f"sets-{size}")
        if size > 1:
            ids = F.concat("start", F.array("last"))
            sets.append(frequent.select(
                "detected_role", ids.alias("skill_ids"), F.lit(size).alias("skills"), "jobs"))
        if size == largest or frequent.isEmpty():
            break
        kept = held.join(frequent.select(*key), key, "left_semi")
        one, other = kept.alias("one"), kept.select(
            "detected_role", "job_id", "start", F.col("last").alias("next")).alias("other")
        held = one.join(other, ["detected_role", "job_id", "start"]).filter("last < next").select(
            "detected_role", "job_id",
            F.concat("start", F.array("last")).alias("start"), F.col("next").alias("last"))
        size += 1
    if not sets:
        return own.sparkSession.createDataFrame(
            [], "detected_role string, skill_ids array<bigint>, skills int, jobs bigint")
    out = sets[0]
    for more in sets[1:]:
        out = out.unionByName(more)
    return out


def named_sets(sets: DataFrame, skills: DataFrame) -> DataFrame:
    """Sets with their skills' names in order, comma-joined."""
    members = sets.select("detected_role", "skill_ids", "skills", "jobs",
                          F.explode("skill_ids").alias("skill_id"))
    named = members.join(skills.select("skill_id", "skill_name"), "skill_id")
    return (
        named.groupBy("detected_role", "skill_ids", "skills", "jobs")
        .agg(F.array_join(F.array_sort(F.collect_list("skill_name")), ", ").alias("skill_names"))
        .select("detected_role", "skill_names", "skills", "jobs")
    )
