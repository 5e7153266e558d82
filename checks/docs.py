"""Bronze, silver, classification and seniority over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens import schemas
from hirelens.functions import roles as R
from hirelens.functions import text as T
from hirelens.functions.location import parse_country, remote_text, remote_type
from hirelens.functions.markup import strip_html
from hirelens.operators import analysis as A
from hirelens.operators import bronze as B
from hirelens.operators import silver as S
from hirelens.plans import explore
from hirelens.session import scratch_path, stage
from hirelens.sources import raw_records as raw_files
from hirelens.sources.tables import BRONZE_SCAN, SILVER_SCAN, scan

from checks import bridge as b
from checks.bridge import quote, sql, sql_clean, sql_collapse

QUERIES, SQL = {}, {}


def query(statement: str | None, *views: str):
    def register(function):
        name = function.__name__
        QUERIES[name] = function
        if statement is not None:
            SQL[name] = sql(statement, *views)
        return function

    return register


# --- raw record files ------------------------------------------------------------


def _written(spark, d, name):
    path = scratch_path(spark, name)
    raw_files.write_records(b.raw_records(spark, d), path)
    return path


@query("""SELECT source_name, source_url, '2026-06-18T08:00:00+00:00' AS scraped_at,
       sha256(canonical) AS payload_hash FROM raw_records""", "raw_records")
def src_raw_json(spark, d):
    records = raw_files.read_raw_records(spark, _written(spark, d, "src_raw_json"), "lines")
    hashed = B.with_content_hash(raw_files.require_records(records))
    return hashed.select("source_name", "source_url", "scraped_at",
                         F.col("content_hash").alias("payload_hash"))


@query("""SELECT '{"source_name":' || CAST(to_json(source_name) AS VARCHAR) || ',"source_url":'
       || CAST(to_json(source_url) AS VARCHAR)
       || ',"scraped_at":"2026-06-18T08:00:00+00:00","raw_payload":' || canonical || '}'
       AS json_line FROM raw_records""", "raw_records")
def sink_json(spark, d):
    lines = spark.read.text(_written(spark, d, "sink_json"))
    return lines.select(F.col("value").alias("json_line"))


# --- bronze ------------------------------------------------------------------------


@query("SELECT position, source_job_id FROM raw_records", "raw_records")
def bronze_keys(spark, d):
    return B.with_keys(b.raw_records(spark, d)).select("position", "source_job_id")


@query("SELECT position, reject_reason FROM raw_records", "raw_records")
def bronze_validate(spark, d):
    return B.with_reject_reason(b.raw_records(spark, d)).select("position", "reject_reason")


@query("SELECT position, sha256(canonical) AS content_hash FROM raw_records", "raw_records")
def content_hash(spark, d):
    return B.with_content_hash(b.raw_records(spark, d)).select("position", "content_hash")


def _outcomes(spark, d):
    validated = B.with_reject_reason(b.raw_records(spark, d))
    return B.with_outcome(validated, b.stored_records(spark, d))


@query("""SELECT CAST((SELECT max(raw_job_id) FROM stored_records)
            + row_number() OVER (ORDER BY position) AS BIGINT) AS raw_job_id,
       source_name, source_job_id, source_url, sha256(canonical) AS content_hash
FROM outcomes WHERE outcome = 'inserted'""", "outcomes", "stored_records")
def bronze_insert_new(spark, d):
    validated = B.with_reject_reason(b.raw_records(spark, d))
    stored = b.stored_records(spark, d)
    fresh = B.fresh_positions(validated, stored)
    rows = B.inserted_rows(validated, fresh, stored, 1)
    return rows.select("raw_job_id", "source_name", "source_job_id", "source_url",
                       "content_hash")


@query("SELECT outcome, count(*) AS records FROM outcomes GROUP BY 1", "outcomes")
def load_report(spark, d):
    return B.load_report(_outcomes(spark, d))


@query("""SELECT source_name, count(*) AS total_records,
       count(*) FILTER (outcome = 'inserted') AS inserted_count,
       count(*) FILTER (outcome = 'skipped_duplicate') AS skipped_count,
       count(*) FILTER (outcome = 'failed') AS failed_count,
       CASE WHEN count(*) FILTER (outcome = 'failed') = 0 THEN 'success'
            WHEN count(*) FILTER (outcome <> 'failed') > 0 THEN 'partial_success'
            ELSE 'failed' END AS status
FROM outcomes GROUP BY 1""", "outcomes")
def run_status(spark, d):
    return B.load_counts(_outcomes(spark, d), ["source_name"])


@query("SELECT DISTINCT source_name FROM raw_records WHERE source_name <> ''", "raw_records")
def single_source_check(spark, d):
    return B.source_names(b.raw_records(spark, d))


@query("""SELECT *, total_records <> distinct_job_ids AS duplicate_job_ids,
       total_records <> distinct_hashes AS duplicate_hashes FROM (
  SELECT count(*) AS total_records,
         count(DISTINCT coalesce(source_job_id, '(none)')) AS distinct_job_ids,
         count(DISTINCT canonical) AS distinct_hashes FROM raw_records)""", "raw_records")
def dup_profile(spark, d):
    return B.duplicate_profile(b.raw_records(spark, d))


@query("""SELECT o_orderkey AS pipeline_run_id, o_orderpriority AS run_name,
       CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'partial_success'
            ELSE 'running' END AS status,
       CASE WHEN o_orderstatus IN ('F', 'O') THEN o_custkey ELSE 0 END AS inserted_raw_count
FROM orders""")
def run_ledger(spark, d):
    """Every order is a run that opened; orders no longer pending have closed."""
    orders = b.table(spark, d, "orders")
    none = F.lit(0)

    def rows(source, status, finished, inserted):
        return source.select(
            F.col("o_orderkey").alias("pipeline_run_id"),
            F.col("o_orderpriority").alias("run_name"),
            F.lit("orders").alias("source_name"),
            status.alias("status"),
            F.col("o_orderdate").alias("started_at"),
            finished.alias("finished_at"),
            none.alias("raw_records_count"),
            inserted.alias("inserted_raw_count"),
        )

    opened = rows(orders, F.lit("running"), F.lit(None).cast("timestamp"),
                  F.lit(0).cast("bigint"))
    closed = rows(
        orders.filter(F.col("o_orderstatus").isin("F", "O")),
        F.when(F.col("o_orderstatus") == "F", "success").otherwise("partial_success"),
        F.col("o_orderdate"),
        F.col("o_custkey"),
    )
    return B.latest_runs(opened.unionByName(closed)).select(
        "pipeline_run_id", "run_name", "status", "inserted_raw_count"
    )


def _bronze(spark, d):
    return B.with_keys(b.raw_records(spark, d)).select(
        F.col("position").alias("raw_job_id"),
        F.lit(1).cast("bigint").alias("pipeline_run_id"),
        "source_name",
        "source_job_id",
        "source_url",
        F.try_to_timestamp("scraped_at").alias("scraped_at"),
        "raw_payload",
    )


@query("""SELECT position AS raw_job_id, source_name, source_job_id, source_url,
       sha256(canonical) AS payload_hash FROM raw_records ORDER BY 1""", "raw_records")
def scan_bronze(spark, d):
    rows = B.with_content_hash(scan(_bronze(spark, d), BRONZE_SCAN, "raw_job_id"))
    return rows.select("raw_job_id", "source_name", "source_job_id", "source_url",
                       F.col("content_hash").alias("payload_hash"))


# --- text and silver ---------------------------------------------------------------


@query(f"""SELECT doc_id, {sql_clean('text')} AS cleaned,
       {sql_clean(b.sql_pick(b.TITLES, 'doc_id'))} AS title FROM documents""")
def clean_text(spark, d):
    return b.texts(spark, d, "documents", "doc_id", "text").select(
        "doc_id",
        T.clean_text(F.col("text")).alias("cleaned"),
        T.clean_text(b.pick(b.TITLES, F.col("doc_id"))).alias("title"),
    )


CLEANED = f"""SELECT position AS raw_job_id, is_object,
       {sql_clean('source_name')} AS source_name, {sql_clean('source_job_id')} AS source_job_id,
       {sql_clean('source_url')} AS source_url,
       CASE WHEN is_object THEN {sql_clean('title')} END AS job_title,
       CASE WHEN is_object THEN {sql_clean('company')} END AS company_name,
       CASE WHEN is_object THEN {sql_clean('location')} END AS location_text,
       CASE WHEN is_object THEN {sql_clean('description_text')} END AS description_text
FROM raw_records"""
SILVER = f"""SELECT *, {b.sql_country('location_text')} AS country,
       {b.sql_remote('location_text', 'description_text')} AS remote_type,
       CASE WHEN NOT is_object THEN 'invalid raw_payload'
            WHEN job_title IS NULL THEN 'missing job title'
            WHEN description_text IS NULL THEN 'missing description_text'
            WHEN source_name IS NULL THEN 'missing source_name'
            WHEN source_job_id IS NULL THEN 'missing source_job_id' END AS reject_reason
FROM ({CLEANED})"""
b.VIEWS["silver"] = SILVER.replace("FROM raw_records", "FROM {raw_records}")


@query("""SELECT raw_job_id, source_name, source_job_id, source_url, job_title, company_name,
       location_text, description_text FROM silver""", "silver")
def payload_project(spark, d):
    return S.project_payload(_bronze(spark, d)).select(
        "raw_job_id", "source_name", "source_job_id", "source_url", "job_title",
        "company_name", "location_text", "description_text",
    )


SILVER_OUT = ["raw_job_id", "source_name", "source_job_id", "source_url", "job_title",
              "company_name", "location_text", "country", "remote_type", "description_text"]


def _good(spark, d):
    return S.good_rows(S.silver_candidates(_bronze(spark, d)))


@query(f"SELECT {', '.join(SILVER_OUT)} FROM silver WHERE reject_reason IS NULL", "silver")
def silver_jobs(spark, d):
    return _good(spark, d).select(*SILVER_OUT)


@query("""SELECT coalesce(reject_reason, 'ok') AS result, count(*) AS records FROM silver
GROUP BY 1""", "silver")
def silver_report(spark, d):
    return S.silver_report(S.silver_candidates(_bronze(spark, d)))


def _old_postings(spark, d):
    """Stored postings: the keys already loaded, with an old title and company."""
    stored = b.stored_records(spark, d)
    columns = {
        "job_id": F.col("raw_job_id"),
        "raw_job_id": F.col("raw_job_id"),
        "source_name": F.col("source_name"),
        "source_job_id": F.col("source_job_id"),
        "job_title": F.lit("old title"),
        "company_name": F.lit("old company"),
    }
    return stored.select(
        *[
            columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.JOB_POSTINGS.fields
        ]
    )


@query("""SELECT * FROM (WITH latest AS (SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY source_name, source_job_id ORDER BY raw_job_id DESC) AS nth
    FROM silver WHERE reject_reason IS NULL) WHERE nth = 1),
fresh AS (SELECT l.raw_job_id, row_number() OVER (ORDER BY l.raw_job_id) AS nth FROM latest l
  LEFT JOIN stored_records s ON l.source_name = s.source_name
    AND l.source_job_id = s.source_job_id WHERE s.raw_job_id IS NULL)
SELECT CAST(coalesce(s.raw_job_id, (SELECT max(raw_job_id) FROM stored_records) + f.nth)
         AS BIGINT) AS job_id,
       coalesce(l.raw_job_id, s.raw_job_id) AS raw_job_id,
       coalesce(l.source_name, s.source_name) AS source_name,
       coalesce(l.source_job_id, s.source_job_id) AS source_job_id,
       CASE WHEN l.raw_job_id IS NULL THEN 'old title' ELSE l.job_title END AS job_title,
       CASE WHEN l.raw_job_id IS NULL THEN 'old company' ELSE l.company_name END AS company_name
FROM latest l FULL JOIN stored_records s
  ON l.source_name = s.source_name AND l.source_job_id = s.source_job_id
LEFT JOIN fresh f ON f.raw_job_id = l.raw_job_id)""", "silver", "stored_records")
def upsert_update(spark, d):
    merged = S.upsert_postings(_old_postings(spark, d), stage(_good(spark, d), "silver"))
    return merged.select("job_id", "raw_job_id", "source_name", "source_job_id", "job_title",
                         "company_name")


REQUIRED = {
    "job_id": "payload_id IS NULL", "title": "coalesce(title, '') = ''",
    "company": "coalesce(company, '') = ''", "location": "coalesce(location, '') = ''",
    "description_text": "coalesce(description_text, '') = ''",
}
MISSING = "array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN NOT is_object OR {test} THEN '{name}' END" for name, test in REQUIRED.items()
) + "], lambda x: x IS NOT NULL), ',')"


@query(f"SELECT position, {MISSING} AS missing FROM raw_records", "raw_records")
def missing_fields(spark, d):
    return S.with_missing_fields(b.raw_records(spark, d)).select(
        "position", F.array_join("missing_fields", ",").alias("missing")
    )


@query(f"""SELECT count(*) AS total_records, count(*) FILTER (missing = '') AS saved_records,
       round(CAST(count(*) FILTER (missing = '') * 100.0 / nullif(count(*), 0) AS DOUBLE), 2)
           AS saved_rate,
       count(*) FILTER (missing <> '') AS partial_records
FROM (SELECT {MISSING} AS missing FROM raw_records)""", "raw_records")
def partial_records(spark, d):
    checked = S.split_by_completeness(b.raw_records(spark, d))
    failures = S.collection_failures(checked).agg(F.count("*").alias("partial_records"))
    rows = S.saved_rate(checked).unionByName(failures, allowMissingColumns=True)
    names = ["total_records", "saved_records", "saved_rate", "partial_records"]
    merged = rows.agg(*[F.max(c).alias(c) for c in names])
    return merged.withColumn("saved_rate", F.col("saved_rate").cast("double"))


@query(f"""SELECT job_id, location_text, {b.sql_country('location_text')} AS country
FROM doc_jobs""", "doc_jobs")
def parse_country_rule(spark, d):
    return b.doc_jobs(spark, d).select(
        "job_id", "location_text", parse_country(F.col("location_text")).alias("country")
    )


QUERIES["parse_country"] = QUERIES.pop("parse_country_rule")
SQL["parse_country"] = SQL.pop("parse_country_rule")


@query(f"""SELECT job_id, {b.sql_remote('location_text', 'description_text')} AS remote_type
FROM doc_jobs""", "doc_jobs")
def remote_type_rule(spark, d):
    texts = b.doc_jobs(spark, d).select(
        "job_id", remote_text(F.col("location_text"), F.col("description_text")).alias("_text")
    )
    return texts.select("job_id", remote_type(F.col("_text")).alias("remote_type"))


QUERIES["remote_type"] = QUERIES.pop("remote_type_rule")
SQL["remote_type"] = SQL.pop("remote_type_rule")


@query("""SELECT job_id, job_title, description_text, job_function, industries FROM doc_jobs
ORDER BY job_id""", "doc_jobs")
def scan_silver(spark, d):
    return scan(b.doc_jobs(spark, d), SILVER_SCAN, "job_id")


# --- roles ---------------------------------------------------------------------------


@query("SELECT job_id, title_text, context_text FROM role_texts", "role_texts")
def role_text(spark, d):
    return R.with_role_texts(b.doc_jobs(spark, d)).select(
        "job_id", F.col("_title").alias("title_text"), F.col("_context").alias("context_text")
    )


@query(f"""SELECT job_id, {b.sql_phrase('context_text', 'data')} AS has_data,
       {b.sql_phrase('context_text', 'a/b testing')} AS has_ab_testing,
       {b.sql_phrase('context_text', 'la')} AS has_la FROM role_texts""", "role_texts")
def phrase_match(spark, d):
    context = F.col("_context")
    return R.with_role_texts(b.doc_jobs(spark, d)).select(
        "job_id",
        T.contains_phrase(context, "data").alias("has_data"),
        T.contains_phrase(context, "a/b testing").alias("has_ab_testing"),
        T.contains_phrase(context, "la").alias("has_la"),
    )


COMMON = ["de la", "in the", "und", "la", "the", "data analyst"]


@query(f"""SELECT job_id, {b.sql_first_phrase('context_text', COMMON)} AS first_common,
       {b.sql_first_phrase('title_text', V.DATA_ANALYST_TITLES)} AS first_title
FROM role_texts""", "role_texts")
def first_phrase(spark, d):
    return R.with_role_texts(b.doc_jobs(spark, d)).select(
        "job_id",
        T.first_phrase(F.col("_context"), COMMON).alias("first_common"),
        T.first_phrase(F.col("_title"), V.DATA_ANALYST_TITLES).alias("first_title"),
    )


def _role_sql() -> str:
    """The rules as one CASE per output, phrase by phrase."""
    arms = []

    def rule_arms(rule):
        text = "title_text" if rule.on_title else "context_text"
        for phrase in rule.phrases:
            guard = b.sql_phrase(text, phrase)
            reason = quote(rule.reason + phrase)
            if rule.also_in_context:
                guard += " AND " + b.sql_phrase("context_text", rule.also_in_context)
            if rule.second_reason:
                second = b.sql_first_phrase("context_text", rule.second_phrases)
                guard += f" AND ({second}) IS NOT NULL"
                reason = f"{reason} || {quote(rule.second_reason)} || ({second})"
            arms.append((guard, rule.role, rule.confidence, reason))

    for rule in R.ROLE_RULES:
        rule_arms(rule)
    arms.append(("title_text = '' AND context_text = ''", R.NO_TEXT[0], R.NO_TEXT[1],
                 quote(R.NO_TEXT[2])))
    for rule in R.TAIL_RULES:
        rule_arms(rule)
    arms.append(("true", R.NO_SIGNAL[0], R.NO_SIGNAL[1], quote(R.NO_SIGNAL[2])))

    packed = " ".join(
        f"WHEN {guard} THEN {quote(role + '|' + score + '|')} || {reason}"
        for guard, role, score, reason in arms
    )
    return f"""SELECT job_id, string_split(hit, '|')[1] AS detected_role,
       CAST(string_split(hit, '|')[2] AS DOUBLE) AS confidence_score,
       string_split(hit, '|')[3] AS role_reason,
       {b.sql_first_phrase('title_text', V.EXCLUSION_WORDS)} AS exclusion_word
FROM (SELECT job_id, title_text, CASE {packed} END AS hit FROM {{role_texts}})"""


b.VIEWS["judged"] = _role_sql()


@query("SELECT job_id, detected_role, confidence_score, role_reason FROM judged", "judged")
def detect_role(spark, d):
    return _analysis(spark, d).select("job_id", "detected_role", "confidence_score",
                                      "role_reason")


EXCLUDED = f"{quote(V.EXCLUSION_REASON)} || exclusion_word"


@query(f"""SELECT job_id, exclusion_word IS NOT NULL AS is_excluded_from_analysis,
       {EXCLUDED} AS exclusion_reason FROM judged""", "judged")
def exclusion(spark, d):
    titles = b.doc_jobs(spark, d).select(
        "job_id", T.match_text(F.col("job_title")).alias("_title")
    )
    reason = R.exclusion_reason(F.col("_title"))
    return titles.select("job_id", reason.isNotNull().alias("is_excluded_from_analysis"),
                         reason.alias("exclusion_reason"))


def _analysis(spark, d):
    rows = A.analyze(b.doc_jobs(spark, d))
    return rows.withColumn("confidence_score", F.col("confidence_score").cast("double"))


@query(f"""SELECT job_id, detected_role, 'rule_based' AS analysis_method, confidence_score,
       role_reason, exclusion_word IS NOT NULL AS is_excluded_from_analysis,
       {EXCLUDED} AS exclusion_reason FROM judged""", "judged")
def job_analysis(spark, d):
    return _analysis(spark, d)


@query("""SELECT count(*) AS analyzed_count, count(exclusion_word) AS excluded_count,
       count(*) FILTER (detected_role IS NULL) AS failed_count FROM judged""", "judged")
def analysis_report(spark, d):
    return A.analysis_report(_analysis(spark, d))


# --- documented seniority classes, HTML text ------------------------------------------


def _seniority_sql() -> str:
    arms = []
    for name, words in V.SENIORITY_KEYWORDS.items():
        tests = []
        for word in words:
            tests.append(b.sql_phrase("senior_text", word))
        arms.append(f"WHEN {' OR '.join(tests)} THEN {quote(name)}")
    return f"""SELECT job_id, CASE {' '.join(arms)} ELSE 'Unknown' END AS seniority
FROM (SELECT job_id, concat_ws(' ', nullif({b.sql_match_text('job_title')}, ''),
        nullif({b.sql_match_text('description_text')}, '')) AS senior_text FROM {{doc_jobs}})"""


b.VIEWS["classed"] = _seniority_sql()


@query("SELECT job_id, seniority FROM classed", "classed")
def seniority(spark, d):
    return A.with_seniority(b.doc_jobs(spark, d)).select("job_id", "seniority")


@query("""SELECT seniority, count(*) AS jobs,
       round(CAST(count(*) * 100.0 / sum(count(*)) OVER () AS DOUBLE), 2) AS percentage
FROM classed GROUP BY 1""", "classed")
def seniority_dist(spark, d):
    rows = explore.seniority_distribution(b.doc_jobs(spark, d))
    return rows.withColumn("percentage", F.col("percentage").cast("double"))


@query("""SELECT j.detected_role, c.seniority, count(*) AS jobs, round(CAST(count(*) * 100.0
         / sum(count(*)) OVER (PARTITION BY j.detected_role) AS DOUBLE), 2) AS percentage
FROM classed c JOIN judged j ON c.job_id = j.job_id
WHERE j.detected_role IS NOT NULL AND j.exclusion_word IS NULL GROUP BY 1, 2""",
       "classed", "judged")
def seniority_by_role(spark, d):
    analysis = stage(_analysis(spark, d), "analysis")  # a stored table, as in a refresh
    rows = explore.seniority_by_role(b.doc_jobs(spark, d), analysis)
    return rows.withColumn("percentage", F.col("percentage").cast("double"))


@query("""SELECT c.seniority, l.skill_id, count(DISTINCT c.job_id) AS jobs_with_skill, s.skill_name
FROM classed c JOIN links l ON c.job_id = l.job_id JOIN skills s ON s.skill_id = l.skill_id
GROUP BY 1, 2, 4""", "classed", "links", "skills")
def seniority_skills(spark, d):
    return explore.skill_counts_by_seniority(
        b.doc_jobs(spark, d), b.link_pairs(spark, d), b.skills(spark, d)
    )


@query(f"""SELECT page_id, {sql_collapse('''replace(replace(replace(replace(replace(replace(
  replace(regexp_replace(regexp_replace(regexp_replace(html,
    '(?is)<(?:script|style)\\b[^>]*>.*?</(?:script|style)>', ' ', 'g'),
    '(?s)<!--.*?-->', ' ', 'g'), '</?[A-Za-z!][^>]*>', '', 'g'),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&apos;', chr(39)),
  '&nbsp;', ' '), '&amp;', '&')''')} AS page_text FROM pages""")
def strip_html_text(spark, d):
    return b.texts(spark, d, "pages", "page_id", "html").select(
        "page_id", strip_html(F.col("html")).alias("page_text")
    )


QUERIES["strip_html"] = QUERIES.pop("strip_html_text")
SQL["strip_html"] = SQL.pop("strip_html_text")
