"""The full refresh: raw files to bronze, silver, analysis, skills and marts.

Layout under a root folder::

    raw_job_postings/pipeline_run_id=N/   new raw rows of run N, append only
    pipeline_runs/pipeline_run_id=N/      ledger rows of run N
    snapshots/N/<table>                   the other tables after run N

A run reads the latest good snapshot and writes a new one, so no folder is
overwritten while it is read and a broken run leaves the last snapshot intact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.operators import analysis as A
from hirelens.operators import bronze as B
from hirelens.operators import quality as Q
from hirelens.operators import silver as S
from hirelens.operators import skills as K
from hirelens.operators.keyed import largest_id
from hirelens.plans import marts as M
from hirelens.session import freeze, stage
from hirelens.sources.raw_records import read_raw_records, require_records
from hirelens.sources.tables import empty_table, read_table, write_table


@dataclass
class RefreshResult:
    run_id: int
    status: str
    tables: dict[str, DataFrame]
    marts: dict[str, DataFrame]
    checks: DataFrame


def _append_only(spark: SparkSession, root: str, name: str) -> DataFrame:
    try:
        return spark.read.schema(schemas.TABLES[name]).parquet(f"{root}/{name}")
    except Exception as error:  # nothing written yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return empty_table(spark, name)


def _append(df: DataFrame, root: str, name: str, run_id: int) -> None:
    columns = [
        df[f.name].cast(f.dataType).alias(f.name)
        for f in schemas.TABLES[name].fields
        if f.name != "pipeline_run_id"
    ]
    df.select(*columns).write.mode("append").parquet(f"{root}/{name}/pipeline_run_id={run_id}")


def runs(spark: SparkSession, root: str) -> DataFrame:
    return B.latest_runs(_append_only(spark, root, "pipeline_runs"))


def bronze(spark: SparkSession, root: str) -> DataFrame:
    return _append_only(spark, root, "raw_job_postings")


def latest_snapshot(spark: SparkSession, root: str) -> str | None:
    good = runs(spark, root).filter(F.col("status").isin("success", "partial_success"))
    run_id = good.agg(F.max("pipeline_run_id")).first()[0]
    return None if run_id is None else f"{root}/snapshots/{run_id}"


def known_aliases(spark: SparkSession, skills: DataFrame, aliases: DataFrame) -> DataFrame:
    """Stored aliases with their skill's name, and the fixed vocabulary where it is not stored."""
    stored = aliases.join(skills, "skill_id").select("alias_name", "skill_name")
    seeds = K.seed_aliases(spark).join(stored, "alias_name", "left_anti")
    return stored.unionByName(seeds.select("alias_name", "skill_name"))


def extract_from_responses(responses: DataFrame):
    """Extractor reading stored response texts (job_id, response_text)."""

    def extract(todo: DataFrame, aliases: DataFrame) -> tuple[DataFrame, str]:
        parsed = K.parse_responses(responses.join(todo.select("job_id"), "job_id", "left_semi"))
        return K.deduplicate(stage(K.response_lists(parsed), "lists")), "ai"

    return extract


def extract_from_dictionary(todo: DataFrame, aliases: DataFrame) -> tuple[DataFrame, str]:
    texts = todo.select(
        "job_id", F.concat_ws(" ", "job_title", "description_text").alias("text")
    )
    return K.dictionary_candidates(texts, aliases), "rule_based"


def refresh(
    spark: SparkSession,
    raw_path: str,
    root: str,
    run_name: str = "manual_load",
    layout: str = "array",
    extractor=extract_from_dictionary,
    skip_skills: bool = False,
    force_skills: bool = False,
    replace_links: bool = False,
    criteria_fallback: bool = False,
) -> RefreshResult:
    """Load one input and rebuild everything that depends on it.

    Each layer is written once and read back from Parquet, so a lost executor
    costs at most the layer at hand. Bad records become reject rows; an error
    closes the run as failed and is raised.
    """
    # positions must not change between the passes over the input
    records = stage(
        B.with_reject_reason(require_records(read_raw_records(spark, raw_path, layout))),
        "records",
    )
    source = B.single_source(records)
    total = records.count()
    snapshot = latest_snapshot(spark, root)
    run_id = largest_id(runs(spark, root), "pipeline_run_id") + 1
    opened = freeze(B.open_run(spark, run_id, run_name, source, total))
    _append(opened, root, "pipeline_runs", run_id)
    try:
        stored = bronze(spark, root)
        outcomes = freeze(
            B.with_outcome(records, stored).select("position", "outcome")
        )
        counts = B.load_counts(outcomes).first()
        fresh = outcomes.filter(F.col("outcome") == B.INSERTED)
        _append(
            B.inserted_rows(records, fresh, stored, run_id), root, "raw_job_postings", run_id
        )
        raw = bronze(spark, root)

        target = f"{root}/snapshots/{run_id}"
        old = {
            name: read_table(spark, snapshot, name)
            for name in ("job_postings", "job_analysis", "skills", "skill_aliases", "job_skills")
        }
        tables = {"raw_job_postings": raw}
        candidates = S.silver_candidates(raw, criteria_fallback)
        tables["job_postings"] = write_table(
            S.upsert_postings(old["job_postings"], stage(S.good_rows(candidates), "silver")),
            target, "job_postings",
        )
        tables["job_analysis"] = write_table(
            A.upsert_analysis(old["job_analysis"], A.analyze(tables["job_postings"])),
            target, "job_analysis",
        )
        enriched = 0
        if skip_skills:
            for name in ("skills", "skill_aliases", "job_skills"):
                tables[name] = write_table(old[name], target, name)
        else:
            todo = K.worklist(
                tables["job_postings"], tables["job_analysis"], old["job_skills"], force_skills
            )
            aliases = known_aliases(spark, old["skills"], old["skill_aliases"])
            extracted, method = extractor(todo, aliases)
            found = stage(extracted, "skills")
            enriched = found.select("job_id").distinct().count()
            tables["skills"] = write_table(
                K.upsert_skills(old["skills"], found), target, "skills"
            )
            linked = stage(K.with_skill_ids(found, tables["skills"]), "links")
            tables["skill_aliases"] = write_table(
                K.insert_aliases(old["skill_aliases"], linked), target, "skill_aliases"
            )
            tables["job_skills"] = write_table(
                K.upsert_links(old["job_skills"], linked, method, replace_links),
                target, "job_skills",
            )
        views = M.staging(tables)
        marts = {
            name: write_table(df, target, name) for name, df in M.build_marts(views).items()
        }
        checks = write_table(Q.run_checks({**views, **marts}), target, "check_results")
        cleaned = tables["job_postings"].count()
        closed = B.close_run(
            opened, counts["status"], counts["inserted_count"], counts["failed_count"],
            cleaned, enriched,
        )
        _append(closed, root, "pipeline_runs", run_id)
    except Exception as error:
        _append(B.fail_run(opened, total, str(error)), root, "pipeline_runs", run_id)
        raise
    return RefreshResult(run_id, counts["status"], tables, marts, checks)
