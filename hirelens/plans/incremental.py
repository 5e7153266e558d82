"""Loads and refreshes whose work follows what changed.

`load` appends the new records of an input to bronze, as a run of its own. `apply_changes`
takes the runs that have not been applied yet through silver, analysis, skills and marts: it
parses their raw rows only, gives the changed jobs to the tables by key, and moves the marts
by the difference that the changed jobs make. `refresh_incremental` does both.

Layout under a root folder, besides that of `sources.buckets`::

    raw_job_postings/pipeline_run_id=N/   new raw rows of run N
    rejected/pipeline_run_id=N/           records of run N that were not taken
    pipeline_runs/pipeline_run_id=N/      ledger rows of run N
    raw_ids/pipeline_run_id=N/            the first id that run N may give, reserved at its start

A run counts once the ledger has closed it. A run that broke, or a micro-batch that is
repeated, takes the number and the ids that were reserved for it and writes its folders again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens import schemas
from hirelens.operators import analysis as A
from hirelens.operators import bronze as B
from hirelens.operators import quality as Q
from hirelens.operators import silver as S
from hirelens.operators import skills as K
from hirelens.operators.keyed import assign_ids
from hirelens.plans import marts as M
from hirelens.plans.refresh import extract_from_dictionary, known_aliases
from hirelens.schemas import _struct
from hirelens.session import freeze, stage
from hirelens.sources.buckets import BUCKETS, BucketStore, read_or_empty
from hirelens.sources.raw_records import read_raw_records, require_records

RAW_IDS = "pipeline_run_id bigint, batch string, first_raw_job_id bigint"
REJECTED = "source_name string, source_url string, raw_payload string, reject_reason string, " \
           "pipeline_run_id bigint"
CLOSED = ("success", "partial_success")
EXPLORER = _struct(
    """job_id BIGINT, job_title STRING, company_name STRING, location_text STRING,
       country STRING, remote_type STRING, employment_type STRING, seniority_level STRING,
       detected_role STRING, role_confidence_score DECIMAL(5,2),
       is_excluded_from_analysis BOOLEAN, exclusion_reason STRING, source_name STRING,
       source_url STRING, skill_names STRING, skill_categories STRING, built_at TIMESTAMP"""
)
STORED = {
    **{k: schemas.TABLES[k] for k in
       ("job_postings", "job_analysis", "job_skills", "skills", "skill_aliases")},
    # narrow tables beside them: known raw keys, ids by cleaned key, jobs still without skills,
    # and how many jobs or links stand behind each number of the marts
    "raw_keys": _struct("source_name STRING, source_job_id STRING"),
    "job_keys": _struct("source_name STRING, source_job_id STRING, job_id BIGINT"),
    "pending_jobs": _struct("job_id BIGINT"),
    "mart_counts": _struct(
        "measure STRING, name STRING, skill_id BIGINT, place STRING, n BIGINT"),
    "mart_job_explorer": EXPLORER,
}


@dataclass
class ChangeResult:
    """What a change did. `checks` are those over the changed jobs and the marts, lazily."""

    version: int
    changed_jobs: int
    tables: dict[str, DataFrame]
    marts: dict[str, DataFrame]
    checks: DataFrame | None


def store_of(spark: SparkSession, root: str, buckets: int = BUCKETS) -> BucketStore:
    return BucketStore(spark, root, STORED, buckets)


# --- bronze ------------------------------------------------------------------


def ledger(spark: SparkSession, root: str) -> DataFrame:
    return B.latest_runs(read_or_empty(spark, f"{root}/pipeline_runs", schemas.PIPELINE_RUNS))


def closed_runs(spark: SparkSession, root: str, after: int = 0) -> list[int]:
    """Numbers of the runs that count, those after a number."""
    runs = ledger(spark, root).filter(
        F.col("status").isin(*CLOSED) & (F.col("pipeline_run_id") > after))
    return sorted(r[0] for r in runs.select("pipeline_run_id").collect())


def raw_rows(spark: SparkSession, root: str, after: int = 0) -> DataFrame:
    """Raw rows of the runs that count; folders of other runs are neither listed nor read."""
    folder = f"{root}/raw_job_postings"
    paths = [f"{folder}/pipeline_run_id={n}" for n in closed_runs(spark, root, after)]
    if not paths:
        return spark.createDataFrame([], schemas.RAW_JOB_POSTINGS)
    reader = spark.read.schema(schemas.RAW_JOB_POSTINGS).option("basePath", folder)
    return reader.parquet(*paths)


def rejected_rows(spark: SparkSession, root: str) -> DataFrame:
    rows = read_or_empty(spark, f"{root}/rejected", REJECTED)
    return rows.filter(F.col("pipeline_run_id").isin(*closed_runs(spark, root)))


def _append(df: DataFrame, root: str, name: str, run_id: int, schema, mode: str) -> None:
    columns = [
        df[f.name].cast(f.dataType).alias(f.name)
        for f in schema.fields if f.name != "pipeline_run_id"
    ]
    df.select(*columns).write.mode(mode).parquet(f"{root}/{name}/pipeline_run_id={run_id}")


def reserve(spark: SparkSession, root: str, batch: str | None = None) -> tuple[int, int]:
    """A run's number and the last raw id before its own. A batch that has reserved before
    gets the same ones again, unless a later run has taken the ids in the meantime; a new run
    follows all runs that have reserved or opened."""
    reserved = read_or_empty(spark, f"{root}/raw_ids", RAW_IDS)
    if batch is not None:
        own = reserved.filter(F.col("batch") == batch).orderBy(F.desc("pipeline_run_id")).first()
        if own is not None and not closed_runs(spark, root, own["pipeline_run_id"]):
            return own["pipeline_run_id"], own["first_raw_job_id"] - 1
    runs = ledger(spark, root)
    ends = reserved.join(runs.filter(F.col("status").isin(*CLOSED)), "pipeline_run_id").agg(
        F.max(F.col("first_raw_job_id") + F.col("inserted_raw_count"))).first()[0]
    numbers = reserved.select("pipeline_run_id").unionByName(runs.select("pipeline_run_id"))
    run_id = (numbers.agg(F.max("pipeline_run_id")).first()[0] or 0) + 1
    first = ends or 1
    row = spark.createDataFrame([(batch, first)], "batch string, first_raw_job_id bigint")
    row.coalesce(1).write.parquet(f"{root}/raw_ids/pipeline_run_id={run_id}")
    return run_id, first - 1


def load_records(
    records: DataFrame, root: str, run_name: str, source: str, batch: str | None = None,
    buckets: int = BUCKETS,
) -> int:
    """Load validated records, a stored frame, as one run; returns its number.

    Known keys are looked up among the narrow keys of the records' buckets and of the runs
    that have not been applied yet.
    """
    spark = records.sparkSession
    if batch is not None:
        loaded = read_or_empty(spark, f"{root}/raw_ids", RAW_IDS).filter(
            (F.col("batch") == batch) & F.col("pipeline_run_id").isin(*closed_runs(spark, root)))
        if not loaded.isEmpty():
            return loaded.first()["pipeline_run_id"]
    run_id, last_id = reserve(spark, root, batch)
    total = records.count()
    opened = freeze(B.open_run(spark, run_id, run_name, source, total))
    _append(opened, root, "pipeline_runs", run_id, schemas.PIPELINE_RUNS, "append")
    try:
        store = store_of(spark, root, buckets)
        good = records.filter(F.col("reject_reason").isNull())
        known = store.read("raw_keys", store.buckets_of(good, B.KEY)).unionByName(
            raw_rows(spark, root, store.counters.get("run", 0)).select(*B.KEY))
        outcomes = freeze(B.with_outcome(records, known).select("position", "outcome"))
        counts = B.load_counts(outcomes).first()
        fresh = outcomes.filter(F.col("outcome") == B.INSERTED)
        rows = B.inserted_rows(records, fresh, None, run_id, last_id)
        _append(rows, root, "raw_job_postings", run_id, schemas.RAW_JOB_POSTINGS, "overwrite")
        failed = records.filter(F.col("reject_reason").isNotNull()).select(
            "source_name", "source_url", "raw_payload", "reject_reason")
        failed.write.mode("overwrite").parquet(f"{root}/rejected/pipeline_run_id={run_id}")
        closed = B.close_run(
            opened, counts["status"], counts["inserted_count"], counts["failed_count"])
        _append(closed, root, "pipeline_runs", run_id, schemas.PIPELINE_RUNS, "append")
    except Exception as error:
        _append(B.fail_run(opened, total, str(error)), root, "pipeline_runs", run_id,
                schemas.PIPELINE_RUNS, "append")
        raise
    return run_id


def load(
    spark: SparkSession, raw_path: str, root: str, run_name: str = "manual_load",
    layout: str = "array", buckets: int = BUCKETS,
) -> int:
    """Append an input's new records to bronze; returns the run's number."""
    records = stage(
        B.with_reject_reason(require_records(read_raw_records(spark, raw_path, layout))),
        "records",
    )
    return load_records(records, root, run_name, B.single_source(records), buckets=buckets)


# --- silver to marts ---------------------------------------------------------


def job_measures(
    jobs: DataFrame, analysis: DataFrame, links: DataFrame, skills: DataFrame
) -> DataFrame:
    """How many jobs or links stand behind each number of the marts: (measure, name, skill_id,
    n). Sums over any split of the jobs add up."""
    none, no_id = F.lit(None).cast("string"), F.lit(None).cast("bigint")

    def entry(measure: str, name=none, skill_id=no_id) -> F.Column:
        return F.struct(
            F.lit(measure).alias("measure"), name.alias("name"), skill_id.alias("skill_id"))

    def counted(df: DataFrame, *entries) -> DataFrame:
        """How often each entry occurs; a row gives those that are not null."""
        rows = df.select(F.inline(F.array_compact(F.array(*entries))))
        return rows.groupBy("measure", "name", "skill_id").agg(F.count("*").alias("n"))

    flag, role = F.col("is_excluded_from_analysis"), F.col("detected_role")
    target = (flag == F.lit(False)) & ~role.isin(V.NON_TARGET_ROLES)
    judged = jobs.select("job_id", "company_name", "source_name").join(
        analysis.select("job_id", "detected_role", "is_excluded_from_analysis"), "job_id", "left")
    company, source = F.col("company_name"), F.col("source_name")
    per_job = counted(
        judged,
        entry("jobs"),
        F.when(company.isNotNull(), entry("company", company)),
        F.when(source.isNotNull(), entry("source", source)),
        F.when(role.isNotNull(), entry("role", role)),
        F.when(flag == F.lit(False), entry("analyzable")),
        F.when(flag == F.lit(True), entry("excluded")),
        F.when(target, entry("role_total", role)),
    )
    pairs = links.select("job_id", "skill_id").distinct()
    skill = F.col("skill_id")
    per_link = counted(
        pairs.join(judged.select("job_id", "detected_role", "is_excluded_from_analysis"),
                   "job_id", "left"),
        entry("links"), entry("skill", skill_id=skill),
        F.when(target, entry("role_skill", role, skill)),
    )
    categories = pairs.join(skills.select("skill_id", "skill_category"), "skill_id").select(
        "job_id", "skill_category").distinct()
    per_category = counted(categories, entry("category", F.col("skill_category")))
    return per_job.unionByName(per_link).unionByName(per_category)


def move_counts(store: BucketStore, less: DataFrame, more: DataFrame) -> None:
    """Take measures off the stored ones and add others; only what moves is written."""
    place = F.concat_ws(
        "\x1f", "measure", F.coalesce("name", F.lit("\x00")),
        F.coalesce(F.col("skill_id").cast("string"), F.lit("")))
    signed = less.withColumn("n", -F.col("n")).unionByName(more)
    moves = signed.groupBy("measure", "name", "skill_id").agg(F.sum("n").alias("n"))
    moves = stage(moves.filter("n <> 0").withColumn("place", place), "moves")
    stored = store.read("mart_counts", store.buckets_of(moves, ["place"])).select(
        "place", F.col("n").alias("_n"))
    rows = moves.join(stored, "place", "left").withColumn(
        "n", F.col("n") + F.coalesce("_n", F.lit(0)))
    store.upsert("mart_counts", stage(rows, "counts"), ["place"], ["place"], ["n"])


def marts_of(counts: DataFrame, skills: DataFrame) -> dict[str, DataFrame]:
    """The three summary marts from the measures."""
    counts = counts.filter("n <> 0")

    def total(measure: str, value) -> F.Column:
        return F.coalesce(
            F.sum(F.when(F.col("measure") == measure, value)), F.lit(0)).cast("bigint")

    n, one = F.col("n"), F.lit(1)
    ids = skills.select("skill_id").distinct().agg(F.count("*").alias("total_skills"))
    numbers = counts.agg(
        total("jobs", n).alias("total_jobs"), total("company", one).alias("total_companies"),
        total("source", one).alias("total_sources"),
        total("role", one).alias("total_detected_roles"),
        total("analyzable", n).alias("analyzable_jobs"),
        total("excluded", n).alias("excluded_jobs"),
        total("links", n).alias("total_job_skill_links"),
    )
    rows = numbers.unionByName(ids, allowMissingColumns=True)
    overview = rows.agg(*[F.max(c).cast("bigint").alias(c) for c in (
        "total_jobs", "total_companies", "total_sources", "total_detected_roles",
        "analyzable_jobs", "excluded_jobs", "total_skills", "total_job_skill_links")])

    def named(measure: str, **columns: str) -> DataFrame:
        return counts.filter(F.col("measure") == measure).select(
            *[F.col(old).alias(new) for new, old in columns.items()])

    demand = M.demand_of(
        named("role_skill", detected_role="name", skill_id="skill_id", jobs_with_skill="n"),
        named("role_total", detected_role="name", total_jobs_for_role="n"), skills)
    categories = M.category_totals(
        skills, named("skill", skill_id="skill_id", _links="n"),
        named("category", skill_category="name", jobs_with_category="n"))
    return {
        "mart_market_overview": overview,
        "mart_top_skills_by_role": M.rank_demand(demand),
        "mart_skills_by_category": categories,
    }


def _of_jobs(store: BucketStore, ids: DataFrame, name: str, before: bool) -> DataFrame:
    """A job table's rows of the given jobs, from their buckets."""
    own = store.read(name, store.buckets_of(ids, ["job_id"]), before)
    return own.join(ids, "job_id", "left_semi")


def apply_changes(
    spark: SparkSession, root: str, extractor=extract_from_dictionary, skip_skills: bool = False,
    criteria_fallback: bool = False, buckets: int = BUCKETS,
) -> ChangeResult:
    """Take the runs loaded since the last time through silver, analysis, skills and marts.

    Jobs without any skill are looked at again, as in a full refresh; jobs that have links
    keep them. Nothing is read of other jobs but their narrow keys in the touched buckets, and
    their rows where a bucket is written anew; small tables (skills, aliases, measures) are
    written whole. Without a new run and without pending jobs nothing is written.
    """
    store = store_of(spark, root, buckets)
    done = store.counters.get("run", 0)
    runs = closed_runs(spark, root, done)
    now = F.current_timestamp()
    if not runs and store.read("pending_jobs").isEmpty():
        return _result(spark, root, store, 0, None)

    # silver of the new raw rows; the last raw row of a key counts
    raw = raw_rows(spark, root, done)
    silver = stage(S.good_rows(S.silver_candidates(raw, criteria_fallback)), "silver")
    winners = freeze(silver.groupBy(*S.KEY).agg(F.max("raw_job_id").alias("raw_job_id")))
    keys = store.read("job_keys", store.buckets_of(winners, S.KEY))
    last_id = store.counters.get("job_id", 0)
    fresh = freeze(assign_ids(
        winners.join(keys, S.KEY, "left_anti"), "job_id", ["raw_job_id"], last_id))
    numbered = winners.join(keys, S.KEY).select("raw_job_id", "job_id").unionByName(
        fresh.select("raw_job_id", "job_id"))
    changed = stage(silver.join(numbered, "raw_job_id"), "changed")
    changed_ids = changed.select("job_id")
    store.append("raw_keys", raw.select(*B.KEY), B.KEY)
    store.append("job_keys", fresh, S.KEY)
    store.upsert(
        "job_postings", changed, ["job_id"], ["job_id"], S.UPDATED,
        on_update={"updated_at": now},
        on_insert={"cleaned_at": now, "created_at": now, "updated_at": now},
    )
    analysis = stage(A.analyze(changed), "analysis")
    store.upsert(
        "job_analysis", analysis, ["job_id"], ["job_id"],
        [c for c in A.ANALYSIS_COLUMNS if c != "job_id"],
        on_update={"updated_at": now}, on_insert={"analyzed_at": now, "updated_at": now},
    )

    # skills of the changed jobs and of those that had none
    old_skills = store.read("skills")
    affected = changed_ids
    enriched = 0
    candidates = stage(store.read("pending_jobs").unionByName(changed_ids).distinct(), "candidates")
    todo = K.worklist(
        _of_jobs(store, candidates, "job_postings", False),
        _of_jobs(store, candidates, "job_analysis", False),
        _of_jobs(store, candidates, "job_skills", False),
    )
    if skip_skills:
        store.replace("pending_jobs", todo.select("job_id"), ["job_id"])
    else:
        todo = stage(todo, "todo")
        aliases = known_aliases(spark, old_skills, store.read("skill_aliases"))
        extracted, method = extractor(todo, aliases)
        found = stage(extracted, "skills")
        found_ids = found.select("job_id").distinct()
        enriched = found_ids.count()
        store.replace("skills", K.upsert_skills(old_skills, found), ["skill_id"])
        linked = stage(K.with_skill_ids(found, store.read("skills")), "links")
        store.replace(
            "skill_aliases", K.insert_aliases(store.read("skill_aliases"), linked),
            ["skill_alias_id"])
        store.upsert(
            "job_skills", K.link_rows(linked, method), K.LINK_KEY, ["job_id"], K.LINK_UPDATED,
            K.LINK_ORDER, on_insert={"created_at": now},
        )
        store.replace(
            "pending_jobs", todo.select("job_id").join(found_ids, "job_id", "left_anti"),
            ["job_id"])
        affected = affected.unionByName(found_ids)
        moved = freeze(
            store.read("skills").select("skill_id", F.col("skill_category").alias("new"))
            .join(old_skills, "skill_id")
            .filter(~F.col("new").eqNullSafe(F.col("skill_category"))).select("skill_id"))
        if not moved.isEmpty():  # a category that was empty: its jobs show another one
            affected = affected.unionByName(
                store.read("job_skills").join(moved, "skill_id", "left_semi").select("job_id"))
    affected = stage(affected.distinct(), "affected")

    # marts: what the affected jobs were is taken off, what they are is added
    skills = store.read("skills")
    tables = ("job_postings", "job_analysis", "job_skills")
    old = [_of_jobs(store, affected, name, True) for name in tables]
    new = [_of_jobs(store, affected, name, False) for name in tables]
    move_counts(store, job_measures(*old, old_skills), job_measures(*new, skills))
    explorer = stage(M.job_explorer(*new, skills).withColumn("built_at", now), "explorer")
    store.upsert(
        "mart_job_explorer", explorer, ["job_id"], ["job_id"],
        [c for c in EXPLORER.names if c != "job_id"],
    )
    marts = {
        name: df.withColumn("built_at", now)
        for name, df in marts_of(store.read("mart_counts"), skills).items()
    }
    views = M.staging(dict(zip(tables, new, strict=True)) | {"skills": skills})
    checks = Q.run_checks({**views, **marts, "mart_job_explorer": explorer})

    given = fresh.agg(F.max("job_id")).first()[0]
    store.commit({"run": max(runs, default=done), "job_id": given or last_id})
    if runs:
        _enrich_ledger(spark, root, runs, silver, enriched)
    return _result(spark, root, store, changed.count(), checks)


def _result(spark, root: str, store: BucketStore, changed: int, checks) -> ChangeResult:
    store = store_of(spark, root, store.buckets)
    tables = {name: store.read(name) for name in STORED}
    marts = {"mart_job_explorer": tables["mart_job_explorer"]}
    marts |= marts_of(tables["mart_counts"], tables["skills"])
    return ChangeResult(store.version - 1, changed, tables, marts, checks)


def _enrich_ledger(spark, root, runs, silver: DataFrame, enriched: int) -> None:
    """Cleaned rows of each applied run; the enriched jobs count for the last one."""
    cleaned = silver.groupBy("pipeline_run_id").agg(F.count("*").alias("_cleaned"))
    rows = (
        ledger(spark, root).filter(F.col("pipeline_run_id").isin(*runs))
        .join(cleaned, "pipeline_run_id", "left")
        .withColumns({
            "finished_at": F.current_timestamp(),
            "cleaned_records_count": F.coalesce("_cleaned", F.lit(0)),
            "enriched_records_count": F.when(
                F.col("pipeline_run_id") == max(runs), enriched).otherwise(F.lit(0)),
        })
    )
    frozen = freeze(rows)
    shaped = frozen.select(*[
        frozen[f.name].cast(f.dataType).alias(f.name) for f in schemas.PIPELINE_RUNS.fields])
    shaped.write.mode("append").partitionBy("pipeline_run_id").parquet(f"{root}/pipeline_runs")


def refresh_incremental(
    spark: SparkSession, raw_path: str, root: str, run_name: str = "manual_load",
    layout: str = "array", extractor=extract_from_dictionary, skip_skills: bool = False,
    criteria_fallback: bool = False, buckets: int = BUCKETS,
) -> ChangeResult:
    """Load one input and carry what is new through all tables."""
    load(spark, raw_path, root, run_name, layout, buckets)
    return apply_changes(spark, root, extractor, skip_skills, criteria_fallback, buckets)
