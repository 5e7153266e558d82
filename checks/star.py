"""Marts, reports, gaps and quality checks over orders, parts and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.operators import keyed, quality, skills as skill_ops
from hirelens.plans import explore, gap, marts
from hirelens.session import freeze
from hirelens.sources.tables import scan

from checks import bridge as b
from checks.bridge import sql

QUERIES, SQL = {}, {}


def query(statement: str | None, *views: str):
    def register(function):
        name = function.__name__
        QUERIES[name] = function
        if statement is not None:
            SQL[name] = sql(statement, *views)
        return function

    return register


def _inputs(spark, d):
    return b.jobs(spark, d), b.part_analysis(spark, d), b.link_pairs(spark, d), b.skills(spark, d)


def _demand_inputs(spark, d):
    return b.job_ids(spark, d), b.analysis(spark, d), b.link_pairs(spark, d), b.skills(spark, d)


def _mart(spark, d):
    return marts.top_skills_by_role(*_demand_inputs(spark, d))


def _demand(spark, d):
    return marts.skill_demand(*_demand_inputs(spark, d))


def _required(spark, d):
    return gap.prepare_required(_demand(spark, d))


def _as_double(df, *columns):
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# --- staging and scans ---------------------------------------------------------


def _staged(spark, d, view):
    source = {
        "stg_job_postings": b.jobs, "stg_job_analysis": b.analysis, "stg_job_skills": b.links,
        "stg_skills": b.skills,
    }[view](spark, d)
    columns = [c for c in marts.STAGING_COLUMNS[view] if c in source.columns]
    return source.select(*columns)


@query("SELECT * FROM jobs", "jobs")
def stg_job_postings(spark, d):
    views = {"job_postings": b.jobs(spark, d)}
    return marts.staging(views)["stg_job_postings"]


@query("SELECT * REPLACE (CAST(confidence_score AS DOUBLE) AS confidence_score) FROM analysis",
       "analysis")
def stg_job_analysis(spark, d):
    views = {"job_analysis": b.analysis(spark, d)}
    return _as_double(marts.staging(views)["stg_job_analysis"], "confidence_score")


@query("SELECT * REPLACE (CAST(confidence_score AS DOUBLE) AS confidence_score) FROM links",
       "links")
def stg_job_skills(spark, d):
    return _as_double(_staged(spark, d, "stg_job_skills"), "confidence_score")


@query("SELECT * FROM skills", "skills")
def stg_skills(spark, d):
    return _staged(spark, d, "stg_skills")


# --- marts -----------------------------------------------------------------------


@query("SELECT * REPLACE (CAST(demand_percentage AS DOUBLE) AS demand_percentage) FROM demand",
       "demand")
def mart_top_skills(spark, d):
    return _as_double(_mart(spark, d), "demand_percentage")


@query(f"""SELECT * FROM
  (SELECT count(*) AS total_jobs, count(DISTINCT o_custkey) AS total_companies FROM orders),
  (SELECT count(*) AS total_sources FROM nation WHERE n_nationkey IN
     (SELECT c_nationkey FROM customer SEMI JOIN orders ON c_custkey = o_custkey)),
  (SELECT count(DISTINCT o_orderpriority) AS total_detected_roles,
          count(*) FILTER (o_orderstatus <> 'P') AS analyzable_jobs,
          count(*) FILTER (o_orderstatus = 'P') AS excluded_jobs
   FROM orders WHERE o_orderdate < TIMESTAMP '{b.ANALYZED_UNTIL} 00:00:00'),
  (SELECT count(*) AS total_skills FROM part),
  (SELECT count(*) AS total_job_skill_links
   FROM (SELECT l_orderkey, l_partkey FROM lineitem GROUP BY ALL))""")
def mart_market_overview(spark, d):
    return marts.market_overview(*_inputs(spark, d))


@query("""SELECT s.skill_category, count(DISTINCT s.skill_id) AS distinct_skills_count,
       count(DISTINCT l.job_id) AS jobs_with_category, count(*) AS job_skill_links
FROM skills s LEFT JOIN links l ON s.skill_id = l.skill_id GROUP BY s.skill_category""",
       "skills", "links")
def mart_skills_by_category(spark, d):
    return marts.skills_by_category(b.skills(spark, d), b.link_pairs(spark, d))


def _explorer(spark, d):
    return marts.job_explorer(*_inputs(spark, d))


@query("""SELECT * REPLACE (CAST(role_confidence_score AS DOUBLE) AS role_confidence_score)
FROM explorer""", "explorer")
def mart_job_explorer(spark, d):
    return _as_double(_explorer(spark, d), "role_confidence_score")


@query("""SELECT detected_role, count(DISTINCT job_id) AS total_jobs_for_role
FROM eligible GROUP BY 1""", "eligible")
def role_totals(spark, d):
    return marts.role_totals(b.job_ids(spark, d), b.analysis(spark, d))


@query("""SELECT e.detected_role, l.skill_id, count(DISTINCT e.job_id) AS jobs_with_skill
FROM eligible e JOIN links l ON e.job_id = l.job_id GROUP BY 1, 2""", "eligible", "links")
def skill_counts(spark, d):
    return marts.skill_counts(b.job_ids(spark, d), b.analysis(spark, d), b.link_pairs(spark, d))


# --- reports ----------------------------------------------------------------------


@query("""SELECT skill_category, count(*) AS skill_count FROM skills GROUP BY 1
ORDER BY 2 DESC, 1""", "skills")
def category_distribution(spark, d):
    return explore.category_distribution(b.skills(spark, d))


@query("""SELECT skill_id, skill_name, skill_category FROM skills
WHERE skill_category IS NULL OR skill_category NOT IN ('ECONOMY', 'STANDARD', 'LARGE')""",
       "skills")
def invalid_categories(spark, d):
    return explore.invalid_categories(b.skills(spark, d), ["ECONOMY", "STANDARD", "LARGE"])


@query("""SELECT s.skill_name, s.skill_category, count(DISTINCT l.job_id) AS job_count
FROM skills s JOIN links l ON s.skill_id = l.skill_id GROUP BY 1, 2 ORDER BY 3 DESC, 1""",
       "skills", "links")
def top_skills(spark, d):
    return explore.top_skills(b.skills(spark, d), b.link_pairs(spark, d))


def _mentions(spark, d):
    """Each document's first sentence as the mention of the part with its number."""
    return b.table(spark, d, "documents").select(
        F.col("doc_id").alias("job_id"),
        F.col("doc_id").alias("skill_id"),
        F.regexp_extract("text", r"^[^.\n]*", 0).alias("raw_mention"),
    )


@query(f"""SELECT raw_mention, skill_name, mention_count FROM (
  SELECT regexp_extract(text, '^[^.\\n]*', 0) AS raw_mention, s.skill_name,
         count(*) AS mention_count
  FROM documents JOIN skills s ON doc_id = s.skill_id
  WHERE length(regexp_extract(text, '^[^.\\n]*', 0)) > {V.LONG_MENTION_LENGTH}
  GROUP BY 1, 2) ORDER BY length(raw_mention) DESC, raw_mention, skill_name
LIMIT {V.LONG_MENTION_ROWS}""", "skills")
def long_mentions(spark, d):
    return explore.long_mentions(_mentions(spark, d), b.skills(spark, d))


@query("""SELECT lower(skill_name) AS normalized_skill_name, count(*) AS row_count,
       string_agg(skill_name, ', ' ORDER BY skill_name) AS variants
FROM skills GROUP BY 1 HAVING count(*) > 1""", "skills")
def case_duplicates(spark, d):
    return quality.case_variants(b.skills(spark, d), "skill_name", repeats=True)


@query("""SELECT skill_category, skill_name FROM skills ORDER BY 1, 2""", "skills")
def skills_by_category_list(spark, d):
    return explore.skill_listing(b.skills(spark, d))


ROLE_LABELS = {
    "data_engineer": "Data Engineer", "data_analyst": "Data Analyst",
    "data_scientist": "Data Scientist", "unknown": "Unknown", "other": "Other",
}


@query(f"""SELECT detected_role, count(*) AS job_count,
       {b.sql_case('detected_role', ROLE_LABELS)} AS role_label
FROM explorer WHERE is_excluded_from_analysis = false AND detected_role IS NOT NULL
GROUP BY detected_role""", "explorer")
def jobs_by_role(spark, d):
    return explore.jobs_by_role(_explorer(spark, d))


@query("""SELECT skill_rank AS "Rank", skill_name AS "Skill", skill_category AS "Category",
       jobs_with_skill AS "Jobs with skill", total_jobs_for_role AS "Total role jobs",
       CAST(demand_percentage AS DOUBLE) AS "Demand %"
FROM demand WHERE detected_role = 'data_engineer' AND demand_percentage >= 0.01
ORDER BY skill_rank, skill_name, skill_id LIMIT 15""", "demand")
def top_n_role_skills(spark, d):
    table = explore.role_skill_table(_mart(spark, d), "data_engineer", 15, 0.01)
    return _as_double(table, "Demand %")


@query("""SELECT skill_name, skill_category,
       CAST(sum(jobs_with_skill) AS BIGINT) AS total_role_skill_mentions,
       round(avg(CAST(demand_percentage AS DOUBLE)), 6) AS avg_demand_percentage
FROM demand GROUP BY 1, 2""", "demand")
def category_skills(spark, d):
    rolled = explore.category_skills(_demand(spark, d))
    return rolled.withColumn("avg_demand_percentage", F.round("avg_demand_percentage", 6))


@query("""SELECT 'role' AS option_list, detected_role AS option_value FROM demand
WHERE detected_role IS NOT NULL GROUP BY 2
UNION ALL SELECT 'category', skill_category FROM demand WHERE skill_category IS NOT NULL
GROUP BY 2""", "demand")
def option_lists(spark, d):
    mart = _demand(spark, d)

    def listed(kind, column):
        values = explore.options(mart, column)
        return values.select(F.lit(kind).alias("option_list"),
                             F.col(column).alias("option_value"))

    return listed("role", "detected_role").unionByName(listed("category", "skill_category"))


@query("""SELECT skill_key, min(skill_name) FILTER (WHERE plain = best) AS skill_name FROM (
  SELECT *, min(plain) OVER (PARTITION BY skill_key) AS best FROM (
    SELECT lower(trim(skill_name)) AS skill_key, trim(skill_name) AS skill_name,
           CASE WHEN trim(skill_name) = lower(trim(skill_name))
                 AND upper(trim(skill_name)) <> lower(trim(skill_name)) THEN 1 ELSE 0 END AS plain
    FROM demand WHERE trim(skill_name) <> '')) GROUP BY 1""", "demand")
def skill_options(spark, d):
    return explore.skill_options(_demand(spark, d))


@query("""SELECT job_id, coalesce(job_title, '') AS "Job title",
       coalesce(company_name, '') AS "Company", coalesce(location_text, '') AS "Location",
       coalesce(detected_role, '') AS "Detected role", 'Included' AS "Analysis status",
       coalesce(skill_names, 'No skills extracted') AS "Skills",
       coalesce(source_url, '') AS "Source"
FROM explorer WHERE is_excluded_from_analysis = false
  AND detected_role IN ('data_engineer', 'data_analyst')
  AND (contains(lower(coalesce(job_title, '')), 'red w')
    OR contains(lower(coalesce(company_name, '')), 'red w')
    OR contains(lower(coalesce(location_text, '')), 'red w')
    OR contains(lower(coalesce(skill_names, '')), 'red w'))""", "explorer")
def explorer_filter(spark, d):
    return explore.explore_jobs(
        _explorer(spark, d), True, ["data_engineer", "data_analyst"], " Red W"
    )


@query("""SELECT location_text, count(*) AS job_count FROM jobs WHERE location_text IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""", "jobs")
def top_locations(spark, d):
    return explore.top_locations(b.jobs(spark, d))


# --- gaps --------------------------------------------------------------------------


@query("SELECT * REPLACE (CAST(demand_percentage AS DOUBLE) AS demand_percentage, "
       "CAST(position AS INTEGER) AS position) FROM required", "required")
def gap_required(spark, d):
    return _as_double(_required(spark, d), "demand_percentage")


@query("SELECT student_id, detected_role, skill_key FROM matched", "matched")
def gap_matched(spark, d):
    return gap.matched_skills(
        b.targets(spark, d), b.student_skills(spark, d), _required(spark, d)
    ).select("student_id", "detected_role", "skill_key")


MISSING = """SELECT t.student_id, t.detected_role,
       row_number() OVER (PARTITION BY t.student_id, t.detected_role ORDER BY r.position)
           AS learning_rank,
       r.skill_name, r.skill_category, CAST(r.demand_percentage AS DOUBLE) AS demand_percentage,
       r.jobs_with_skill, r.total_jobs_for_role
FROM targets t JOIN required r ON t.detected_role = r.detected_role
LEFT JOIN matched m ON m.student_id = t.student_id AND m.detected_role = t.detected_role
     AND m.skill_key = r.skill_key
WHERE m.skill_key IS NULL"""


def _missing(spark, d):
    missing = gap.missing_skills(
        b.targets(spark, d), b.student_skills(spark, d), _required(spark, d)
    )
    return _as_double(missing, "demand_percentage")


@query("SELECT * EXCLUDE (learning_rank) FROM (" + MISSING + ")", "targets", "required",
       "matched")
def gap_missing(spark, d):
    return _missing(spark, d).drop("learning_rank")


@query("""SELECT * FROM (
  SELECT t.student_id, t.detected_role, CAST(row_number() OVER (
             PARTITION BY t.student_id, t.detected_role ORDER BY r.position) AS INTEGER)
             AS learning_rank, r.skill_name
  FROM targets t JOIN role_skills r ON t.detected_role = r.detected_role
  LEFT JOIN owned m ON m.student_id = t.student_id AND m.detected_role = t.detected_role
       AND m.skill_key = r.skill_key
  WHERE m.skill_key IS NULL) WHERE learning_rank <= 15""", "targets", "role_skills", "owned")
def missing_ranked(spark, d):
    ranked = freeze(gap.ranked_role_skills(_demand(spark, d)))
    missing = gap.first_missing_skills(b.targets(spark, d), b.student_skills(spark, d), ranked)
    return missing.select("student_id", "detected_role", "learning_rank", "skill_name")


@query("""SELECT t.student_id, t.detected_role, coalesce(r.n, 0) AS required_count,
       coalesce(m.n, 0) AS matched_count,
       CASE WHEN coalesce(r.n, 0) = 0 THEN 0.0
            ELSE round(CAST(coalesce(m.n, 0) * 100.0 / r.n AS DOUBLE), 2) END AS coverage
FROM targets t
LEFT JOIN (SELECT detected_role, count(*) AS n FROM required GROUP BY 1) r
  ON t.detected_role = r.detected_role
LEFT JOIN (SELECT student_id, detected_role, count(*) AS n FROM matched GROUP BY 1, 2) m
  ON m.student_id = t.student_id AND m.detected_role = t.detected_role""",
       "targets", "required", "matched")
def gap_summary(spark, d):
    return gap.gap_summary(
        b.targets(spark, d), b.student_skills(spark, d), _required(spark, d)
    )


@query("""SELECT t.student_id, t.detected_role,
       round(CAST(coalesce(m.owned, 0) AS DOUBLE) * 100.0 / CAST(r.total AS DOUBLE), 2)
           AS match_score
FROM targets t
JOIN (SELECT detected_role, sum(CAST(demand_percentage AS DECIMAL(27,2))) AS total
      FROM role_skills GROUP BY 1) r ON t.detected_role = r.detected_role
LEFT JOIN (SELECT student_id, detected_role,
                  sum(CAST(demand_percentage AS DECIMAL(27,2))) AS owned
           FROM owned GROUP BY 1, 2) m
  ON m.student_id = t.student_id AND m.detected_role = t.detected_role""",
       "targets", "role_skills", "owned")
def match_score(spark, d):
    demand = freeze(gap.role_skills(_demand(spark, d)))
    return gap.match_score(b.targets(spark, d), b.student_skills(spark, d), demand)


@query("""SELECT detected_role, combination, count(*) AS jobs FROM (
  SELECT w.detected_role, l.job_id, count(DISTINCT w.skill_name) AS n,
         string_agg(DISTINCT w.skill_name, ', ' ORDER BY w.skill_name) AS combination
  FROM demand w
  JOIN links l ON l.skill_id = w.skill_id
  JOIN eligible e ON e.job_id = l.job_id AND e.detected_role = w.detected_role
  GROUP BY 1, 2) WHERE n > 1 GROUP BY 1, 2""", "demand", "links", "eligible")
def skill_combinations(spark, d):
    eligible = marts.eligible_jobs(b.job_ids(spark, d), b.analysis(spark, d))
    return gap.skill_combinations(eligible, b.link_pairs(spark, d), _demand(spark, d))


# --- work list and table maintenance -----------------------------------------------


@query("""SELECT j.job_id, j.job_title, j.description_text FROM jobs j
LEFT JOIN part_analysis a ON j.job_id = a.job_id
WHERE j.description_text IS NOT NULL AND coalesce(a.is_excluded_from_analysis, false) = false
  AND NOT EXISTS (SELECT 1 FROM links l WHERE l.job_id = j.job_id)""",
       "jobs", "part_analysis", "links")
def skill_worklist(spark, d):
    return skill_ops.worklist(b.jobs(spark, d), b.part_analysis(spark, d), b.link_pairs(spark, d))


@query("""SELECT 'link' AS kept, job_id, skill_id FROM links
WHERE skill_id NOT IN (SELECT skill_id FROM skills WHERE skill_category = 'PROMO')
UNION ALL
SELECT 'job', job_id, CASE WHEN raw_job_id NOT IN
    (SELECT job_id FROM analysis WHERE is_excluded_from_analysis) THEN raw_job_id END
FROM jobs""", "links", "skills", "jobs", "analysis")
def cascade_delete(spark, d):
    promo = b.skills(spark, d).filter(F.col("skill_category") == "PROMO")
    kept = keyed.delete_rows(b.link_pairs(spark, d), promo, "skill_id", "skill_id")
    gone = b.analysis(spark, d).filter("is_excluded_from_analysis")
    jobs = keyed.clear_reference(
        b.jobs(spark, d).select("job_id", "raw_job_id"), gone, "raw_job_id", "job_id"
    )
    return kept.select(F.lit("link").alias("kept"), "job_id", "skill_id").unionByName(
        jobs.select(F.lit("job").alias("kept"), "job_id", F.col("raw_job_id").alias("skill_id"))
    )


# --- quality -------------------------------------------------------------------------


@query("""SELECT 'country' AS column_name, count(*) FILTER (country IS NULL) AS failures FROM jobs
UNION ALL SELECT 'job_title', count(*) FILTER (job_title IS NULL) FROM jobs
UNION ALL SELECT 'seniority_level', count(*) FILTER (seniority_level IS NULL) FROM jobs""",
       "jobs")
def dq_not_null(spark, d):
    return quality.not_null_report(
        b.jobs(spark, d), ["country", "job_title", "seniority_level"]
    )


@query("""SELECT skill_name, count(*) AS row_count FROM skills WHERE skill_name IS NOT NULL
GROUP BY 1 HAVING count(*) > 1""", "skills")
def dq_unique(spark, d):
    return quality.unique(b.skills(spark, d), ["skill_name"])


@query(f"""SELECT skill_category, count(*) AS row_count FROM skills
WHERE skill_category IS NOT NULL AND skill_category NOT IN {b.sql_in(V.SKILL_CATEGORIES)}
GROUP BY 1""", "skills")
def dq_accepted_values(spark, d):
    return quality.accepted_values(b.skills(spark, d), "skill_category", V.SKILL_CATEGORIES)


@query("""SELECT job_id, count(*) AS row_count FROM links
WHERE job_id NOT IN (SELECT job_id FROM part_analysis) GROUP BY 1""", "links", "part_analysis")
def dq_relationships(spark, d):
    return quality.relationships(
        b.link_pairs(spark, d), "job_id", b.part_analysis(spark, d), "job_id"
    )


@query("""SELECT job_id, skill_id, CAST(confidence_score AS DOUBLE) AS confidence_score
FROM links WHERE confidence_score < 0 OR confidence_score > 0.05""", "links")
def dq_range(spark, d):
    low_high = quality.in_range(b.links(spark, d), "confidence_score", 0, 0.05)
    return _as_double(low_high.select("job_id", "skill_id", "confidence_score"),
                      "confidence_score")


@query("SELECT count(*) AS total_rows FROM demand HAVING count(*) <> 1", "demand")
def dq_one_row(spark, d):
    return quality.one_row(_demand(spark, d))


@query("""SELECT lower(trim(skill_name)) AS normalized_skill_name, count(*) AS row_count,
       string_agg(DISTINCT skill_name, ', ' ORDER BY skill_name) AS variants
FROM skills GROUP BY 1 HAVING count(*) > 1""", "skills")
def dq_skill_case(spark, d):
    return quality.case_variants(b.skills(spark, d), "skill_name", trim=True)


@query("""SELECT l_orderkey, l_partkey, count(*) AS row_count FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_pair_unique(spark, d):
    return quality.unique(b.table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"])


@query("""SELECT detected_role, skill_id, skill_name, jobs_with_skill, 5 AS total_jobs_for_role,
       CAST(demand_percentage * 2000 AS DOUBLE) AS demand_percentage
FROM demand WHERE demand_percentage * 2000 > 100 OR jobs_with_skill > 5""", "demand")
def dq_demand(spark, d):
    broken = _demand(spark, d).withColumns(
        {
            "demand_percentage": F.col("demand_percentage") * 2000,
            "total_jobs_for_role": F.lit(5),
        }
    )
    return _as_double(quality.invalid_demand(broken), "demand_percentage")
