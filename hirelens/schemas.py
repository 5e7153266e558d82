"""Column types of the raw file and of every stored table."""

from pyspark.sql import types as T


TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "DECIMAL(5,4)": T.DecimalType(5, 4),
    "DECIMAL(5,2)": T.DecimalType(5, 2),
    "MAP<STRING,STRING>": T.MapType(T.StringType(), T.StringType()),
}


def _struct(spec: str) -> T.StructType:
    """A row type from "name TYPE, ..."; needs no running session."""
    columns = [part.split() for part in spec.replace("\n", " ").split(", ")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in columns])


RAW_RECORD = _struct(
    "source_name STRING, source_url STRING, scraped_at STRING, raw_payload STRING"
)

PIPELINE_RUNS = _struct(
    """pipeline_run_id BIGINT, run_name STRING, source_name STRING, status STRING,
       started_at TIMESTAMP, finished_at TIMESTAMP, raw_records_count INT,
       inserted_raw_count INT, cleaned_records_count INT, enriched_records_count INT,
       failed_records_count INT, error_message STRING"""
)

RAW_JOB_POSTINGS = _struct(
    """raw_job_id BIGINT, pipeline_run_id BIGINT, source_name STRING, source_job_id STRING,
       source_url STRING, scraped_at TIMESTAMP, ingested_at TIMESTAMP, raw_payload STRING,
       content_hash STRING"""
)

JOB_POSTINGS = _struct(
    """job_id BIGINT, raw_job_id BIGINT, pipeline_run_id BIGINT, source_name STRING,
       source_job_id STRING, source_url STRING, job_title STRING, company_name STRING,
       location_text STRING, country STRING, remote_type STRING, employment_type STRING,
       seniority_level STRING, job_function STRING, industries STRING,
       posted_time_text STRING, applicants_text STRING, description_text STRING,
       description_html STRING, scraped_at TIMESTAMP, cleaned_at TIMESTAMP,
       created_at TIMESTAMP, updated_at TIMESTAMP"""
)

SKILLS = _struct(
    """skill_id BIGINT, skill_name STRING, skill_category STRING, created_at TIMESTAMP,
       updated_at TIMESTAMP"""
)

SKILL_ALIASES = _struct(
    "skill_alias_id BIGINT, skill_id BIGINT, alias_name STRING, created_at TIMESTAMP"
)

JOB_SKILLS = _struct(
    """job_id BIGINT, skill_id BIGINT, extraction_method STRING, raw_mention STRING,
       confidence_score DECIMAL(5,4), created_at TIMESTAMP"""
)

JOB_ANALYSIS = _struct(
    """job_id BIGINT, detected_role STRING, analysis_method STRING,
       confidence_score DECIMAL(5,2), role_reason STRING, is_excluded_from_analysis BOOLEAN,
       exclusion_reason STRING, analyzed_at TIMESTAMP, updated_at TIMESTAMP"""
)

SEARCH = _struct("name STRING, keywords STRING, max_urls INT")
SEARCH_CONFIG = _struct(
    """location STRING, max_urls_per_search INT, offset_step INT, max_pages INT,
       delay_seconds INT, max_consecutive_no_new INT, output_dir STRING"""
).add("searches", T.ArrayType(SEARCH))

PAGE_PAYLOAD = _struct(
    """job_id STRING, title STRING, company STRING, location STRING,
       posted_time_text STRING, applicants_text STRING, description_html STRING,
       description_text STRING, criteria MAP<STRING,STRING>, canonical_url STRING,
       linkedin_url STRING, og_title STRING, og_description STRING, title_id STRING,
       company_id STRING, html_size INT"""
)

TABLES = {
    "pipeline_runs": PIPELINE_RUNS,
    "raw_job_postings": RAW_JOB_POSTINGS,
    "job_postings": JOB_POSTINGS,
    "skills": SKILLS,
    "skill_aliases": SKILL_ALIASES,
    "job_skills": JOB_SKILLS,
    "job_analysis": JOB_ANALYSIS,
}
