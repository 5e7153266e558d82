"""The given tables seen as the tables of the job-market model.

Each view exists twice: as a DataFrame and as SQL text for a CTE. The SQL is
written on its own, not generated from the DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions.literals import sql_text

VIEWS: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A table of long texts, cut to the columns at hand."""
    return table(spark, folder, name).select(*columns)


def sql(body: str, *views: str) -> str:
    """A statement with the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def need(name: str) -> None:
        text = VIEWS[name]
        for other in VIEWS:
            if other != name and f"{{{other}}}" in text and other not in ordered:
                need(other)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        need(view)

    def plain(text: str) -> str:
        for name in VIEWS:
            text = text.replace(f"{{{name}}}", name)
        return text

    if not ordered:
        return body
    ctes = ",\n".join(f"{name} AS ({plain(VIEWS[name])})" for name in ordered)
    return f"WITH {ctes}\n{body}"


def quote(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(quote(v) for v in values) + "]"


def sql_in(values) -> str:
    return "(" + ", ".join(quote(v) for v in values) + ")"


def pick(values, index) -> F.Column:
    """values[index % n], the same rule as sql_pick."""
    texts = ", ".join("CAST(NULL AS STRING)" if v is None else sql_text(v) for v in values)
    return F.element_at(F.expr(f"array({texts})"), (index % len(values) + 1).cast("int"))


def sql_pick(values, index: str) -> str:
    return f"{sql_list(values)}[CAST(({index}) % {len(values)} AS INTEGER) + 1]"


# --- A. orders as jobs, parts as skills, line items as links -----------------

ROLE_OF_PRIORITY = {
    "1-URGENT": "data_engineer",
    "2-HIGH": "data_analyst",
    "3-MEDIUM": "data_scientist",
    "4-NOT SPECIFIED": "unknown",
    "5-LOW": "other",
}
ROLE_OF_SEGMENT = {
    "AUTOMOBILE": "data_engineer",
    "BUILDING": "data_analyst",
    "FURNITURE": "bi_analyst",
}
OTHER_SEGMENT_ROLE = "data_scientist"
ANALYZED_UNTIL = "1999-01-01"  # later orders have not been analysed yet


def case(column, mapping: dict[str, str], otherwise=None):
    expression = F
    for key, value in mapping.items():
        expression = expression.when(F.col(column) == key, F.lit(value))
    return expression if otherwise is None else expression.otherwise(otherwise)


def sql_case(column: str, mapping: dict[str, str], otherwise: str | None = None) -> str:
    arms = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in mapping.items())
    tail = "" if otherwise is None else f" ELSE {quote(otherwise)}"
    return f"CASE {column} {arms}{tail} END"


def jobs(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    nothing = F.lit(None).cast("string")
    return joined.select(
        F.col("o_orderkey").alias("job_id"),
        F.col("o_orderkey").alias("raw_job_id"),
        F.col("o_custkey").alias("pipeline_run_id"),
        F.col("n_name").alias("source_name"),
        F.col("o_orderkey").cast("string").alias("source_job_id"),
        F.concat(F.lit("https://jobs.example.com/"), "o_orderkey").alias("source_url"),
        F.concat_ws(" ", "c_mktsegment", "o_orderpriority").alias("job_title"),
        F.col("c_name").alias("company_name"),
        F.col("n_name").alias("location_text"),
        F.when(F.col("c_acctbal") > 0, F.col("n_name")).alias("country"),
        F.lit("unknown").alias("remote_type"),
        F.col("c_mktsegment").alias("employment_type"),
        nothing.alias("seniority_level"),
        nothing.alias("job_function"),
        nothing.alias("industries"),
        nothing.alias("posted_time_text"),
        nothing.alias("applicants_text"),
        F.concat_ws(" ", "c_name", "c_mktsegment").alias("description_text"),
        F.lit("<p>not staged</p>").alias("description_html"),
        F.col("o_orderdate").alias("scraped_at"),
        F.col("o_orderdate").alias("cleaned_at"),
    )


VIEWS["jobs"] = """
SELECT o_orderkey AS job_id, o_orderkey AS raw_job_id, o_custkey AS pipeline_run_id,
       n_name AS source_name, CAST(o_orderkey AS VARCHAR) AS source_job_id,
       'https://jobs.example.com/' || o_orderkey AS source_url,
       c_mktsegment || ' ' || o_orderpriority AS job_title, c_name AS company_name,
       n_name AS location_text, CASE WHEN c_acctbal > 0 THEN n_name END AS country,
       'unknown' AS remote_type, c_mktsegment AS employment_type,
       CAST(NULL AS VARCHAR) AS seniority_level, CAST(NULL AS VARCHAR) AS job_function,
       CAST(NULL AS VARCHAR) AS industries, CAST(NULL AS VARCHAR) AS posted_time_text,
       CAST(NULL AS VARCHAR) AS applicants_text, c_name || ' ' || c_mktsegment AS description_text,
       o_orderdate AS scraped_at, o_orderdate AS cleaned_at
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def job_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The keys of the jobs: every order has its customer and nation."""
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("job_id"))


def analysis(spark: SparkSession, folder: str) -> DataFrame:
    """Every order's analysis."""
    return _analysis_of(table(spark, folder, "orders"))


def part_analysis(spark: SparkSession, folder: str) -> DataFrame:
    """Without the later orders, for the queries whose feature is a job without analysis."""
    orders = table(spark, folder, "orders")
    return _analysis_of(
        orders.filter(F.col("o_orderdate") < F.lit(ANALYZED_UNTIL).cast("timestamp"))
    )


def _analysis_of(orders: DataFrame) -> DataFrame:
    excluded = F.col("o_orderstatus") == "P"
    return orders.select(
        F.col("o_orderkey").alias("job_id"),
        case("o_orderpriority", ROLE_OF_PRIORITY).alias("detected_role"),
        F.lit("rule_based").alias("analysis_method"),
        F.when(F.col("o_orderstatus") == "F", F.lit("0.95")).otherwise(F.lit("0.70"))
        .cast("decimal(5,2)").alias("confidence_score"),
        F.concat(F.lit("priority "), "o_orderpriority").alias("role_reason"),
        excluded.alias("is_excluded_from_analysis"),
        F.when(excluded, F.lit("pending")).alias("exclusion_reason"),
        F.col("o_orderdate").alias("analyzed_at"),
    )


VIEWS["analysis"] = f"""
SELECT o_orderkey AS job_id, {sql_case('o_orderpriority', ROLE_OF_PRIORITY)} AS detected_role,
       'rule_based' AS analysis_method,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 0.95 ELSE 0.70 END AS DECIMAL(5,2))
           AS confidence_score,
       'priority ' || o_orderpriority AS role_reason,
       o_orderstatus = 'P' AS is_excluded_from_analysis,
       CASE WHEN o_orderstatus = 'P' THEN 'pending' END AS exclusion_reason,
       o_orderdate AS analyzed_at
FROM orders"""
VIEWS["part_analysis"] = f"""
SELECT * FROM {{analysis}} WHERE analyzed_at < TIMESTAMP '{ANALYZED_UNTIL} 00:00:00'"""


def skills(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return part.select(
        F.col("p_partkey").alias("skill_id"),
        F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.col("p_name")).alias(
            "skill_name"
        ),
        F.col("p_type").alias("skill_category"),
    )


VIEWS["skills"] = """
SELECT p_partkey AS skill_id,
       CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS skill_name,
       p_type AS skill_category
FROM part"""


def links(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    grouped = lineitem.groupBy(
        F.col("l_orderkey").alias("job_id"), F.col("l_partkey").alias("skill_id")
    ).agg(F.max("l_returnflag").alias("_flag"), F.max("l_discount").alias("_discount"))
    return grouped.select(
        "job_id",
        "skill_id",
        F.when(F.col("_flag") == "R", "manual").when(F.col("_flag") == "A", "ai")
        .otherwise("rule_based").alias("extraction_method"),
        F.col("_discount").cast("decimal(5,4)").alias("confidence_score"),
    )


def link_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Only the keys of the links, for operators that need no more."""
    lineitem = table(spark, folder, "lineitem")
    return lineitem.select(
        F.col("l_orderkey").alias("job_id"), F.col("l_partkey").alias("skill_id")
    ).distinct()


VIEWS["links"] = """
SELECT l_orderkey AS job_id, l_partkey AS skill_id,
       CASE max(l_returnflag) WHEN 'R' THEN 'manual' WHEN 'A' THEN 'ai' ELSE 'rule_based' END
           AS extraction_method,
       CAST(max(l_discount) AS DECIMAL(5,4)) AS confidence_score
FROM lineitem GROUP BY l_orderkey, l_partkey"""

VIEWS["demand"] = """
SELECT c.detected_role, c.skill_id, s.skill_name, s.skill_category, c.jobs_with_skill,
       t.total_jobs_for_role,
       round(c.jobs_with_skill * 100.0 / nullif(t.total_jobs_for_role, 0), 2)
           AS demand_percentage,
       CAST(rank() OVER (PARTITION BY c.detected_role
                         ORDER BY c.jobs_with_skill DESC, s.skill_name) AS INTEGER) AS skill_rank
FROM (SELECT e.detected_role, l.skill_id, count(DISTINCT e.job_id) AS jobs_with_skill
      FROM {eligible} e JOIN {links} l ON e.job_id = l.job_id GROUP BY 1, 2) c
JOIN (SELECT detected_role, count(DISTINCT job_id) AS total_jobs_for_role
      FROM {eligible} GROUP BY 1) t ON c.detected_role = t.detected_role
JOIN {skills} s ON s.skill_id = c.skill_id"""

VIEWS["eligible"] = """
SELECT j.job_id, a.detected_role FROM {jobs} j JOIN {analysis} a ON j.job_id = a.job_id
WHERE a.is_excluded_from_analysis = false AND a.detected_role NOT IN ('unknown', 'other')"""

VIEWS["explorer"] = """
SELECT j.job_id, j.job_title, j.company_name, j.location_text, j.country, j.remote_type,
       j.employment_type, j.seniority_level, a.detected_role,
       a.confidence_score AS role_confidence_score, a.is_excluded_from_analysis,
       a.exclusion_reason, j.source_name, j.source_url,
       string_agg(DISTINCT s.skill_name, ', ' ORDER BY s.skill_name) AS skill_names,
       string_agg(DISTINCT s.skill_category, ', ' ORDER BY s.skill_category) AS skill_categories
FROM {jobs} j LEFT JOIN {part_analysis} a ON j.job_id = a.job_id
LEFT JOIN {links} l ON j.job_id = l.job_id LEFT JOIN {skills} s ON l.skill_id = s.skill_id
GROUP BY ALL"""

VIEWS["required"] = """
SELECT detected_role, lower(trim(skill_name)) AS skill_key,
       arg_max(trim(skill_name), position) AS skill_name,
       arg_max(skill_category, position) AS skill_category,
       arg_max(demand_percentage, position) AS demand_percentage,
       arg_max(jobs_with_skill, position) AS jobs_with_skill,
       arg_max(total_jobs_for_role, position) AS total_jobs_for_role, max(position) AS position
FROM (SELECT *, row_number() OVER (PARTITION BY detected_role
              ORDER BY skill_rank, skill_name, skill_id) AS position FROM {demand})
WHERE position <= 15 GROUP BY 1, 2"""


VIEWS["role_skills"] = """
SELECT *, row_number() OVER (PARTITION BY detected_role
              ORDER BY jobs_with_skill DESC, skill_name, skill_key) AS position FROM (
SELECT detected_role, skill_key, skill_name, skill_category, demand_percentage,
       jobs_with_skill, total_jobs_for_role
FROM (SELECT detected_role, lower(trim(skill_name)) AS skill_key, trim(skill_name) AS skill_name,
             skill_category, demand_percentage, jobs_with_skill, total_jobs_for_role,
             row_number() OVER (PARTITION BY detected_role, lower(trim(skill_name))
                 ORDER BY jobs_with_skill, {demand}.skill_name DESC, skill_id DESC) AS n
      FROM {demand} WHERE skill_name IS NOT NULL) WHERE n = 1)"""


def targets(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("student_id"),
        case("c_mktsegment", ROLE_OF_SEGMENT, OTHER_SEGMENT_ROLE).alias("detected_role"),
    )


VIEWS["targets"] = f"""
SELECT c_custkey AS student_id,
       {sql_case('c_mktsegment', ROLE_OF_SEGMENT, OTHER_SEGMENT_ROLE)} AS detected_role
FROM customer"""


def student_skills(spark: SparkSession, folder: str) -> DataFrame:
    orders, lineitem = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    part = table(spark, folder, "part")
    return (
        orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey)
        .join(part, lineitem.l_partkey == part.p_partkey)
        .select(F.col("o_custkey").alias("student_id"), F.col("p_name").alias("skill"))
        .distinct()
    )


VIEWS["student_skills"] = """
SELECT DISTINCT o_custkey AS student_id, p_name AS skill
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey"""

VIEWS["matched"] = """
SELECT DISTINCT t.student_id, t.detected_role, r.skill_key, r.skill_name, r.demand_percentage
FROM {targets} t JOIN {student_skills} s ON t.student_id = s.student_id
JOIN {required} r ON r.detected_role = t.detected_role AND r.skill_key = lower(trim(s.skill))"""

VIEWS["owned"] = """
SELECT DISTINCT t.student_id, t.detected_role, r.skill_key, r.demand_percentage
FROM {targets} t JOIN {student_skills} s ON t.student_id = s.student_id
JOIN {role_skills} r
  ON r.detected_role = t.detected_role AND r.skill_key = lower(trim(s.skill))"""

# --- B. documents as postings ------------------------------------------------

TITLES = [
    "Junior Data Analyst", "Business  Intelligence Analyst", "Data Engineer",
    "Machine Learning Engineer Intern", "Analytics Engineer", "Data Scientist, Product",
    "Strategy & Operations Associate", "Software Engineer", "Senior Data Analyst",
    "Sr. Data Engineer", "Lead BI Developer", "Principal Decision Scientist",
    "Staff ML Engineer", "Manager, Marketing Analyst", "Head of Data", "Director of Insights",
    "Data Architect", "Reporting Associate", "Financial Analyst", "Analytics Associate",
    "Product Manager", "Recruiter", "Insights Partner", "Business Intelligence Lead",
    "Power BI Developer", "Tableau Developer", "dbt Developer", "Analytic Engineer",
    "NLP Engineer", "AI Intern", "Big Data Engineer\tII", "ETL Engineer",
    "Applied Scientist", "Data Quality Analyst", "Dashboard Developer", "Leadership Coach",
    "  ", None, "Barista", "Head Chef",
]
COMPANIES = ["Acme", " Blue  Door ", None, "North & Sons", "Ünder GmbH"]
LOCATIONS = [
    "United States", "New York, NY", "San Francisco, CA", "Washington DC-Baltimore Area",
    "Los Angeles Metropolitan Area", "Casablanca, Morocco", "Paris, Île-de-France, France",
    "Remote", "Toronto, CA", "Berlin, de", " Lyon , france ", "Greater Boston", "Worldwide",
    "Bay Area", "Lisbon", ", ,", "", None, "India", "Dallas-Fort Worth Metroplex",
]
PHRASES = [
    "", "mlops", "deep learning models in production", "dbt and analytics", "semantic layer",
    "Kafka engineer", "data lake", "causal inference on data", "A/B testing", "a/b testing data",
    "SQL reports", "data-driven", "reporting", "work from home", "This is a hybrid job",
    "on-site only", "not remote", "ON SITE", "ETL pipelines for every engineer",
    "data warehouse engineer", "excellent", "engineering sparks", "3-5 years confirmed",
    "internship for juniors",
]
FUNCTIONS = ["Information Technology", None, "Analyst", "Engineering and Information Technology", ""]
INDUSTRIES = ["Software", None, "Business Intelligence", "Staffing"]


def doc_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """One posting per document: its whole text with a phrase at the end."""
    i = F.col("doc_id")
    return texts(spark, folder, "documents", "doc_id", "source", "text").select(
        i.alias("job_id"),
        F.col("source").alias("source_name"),
        i.cast("string").alias("source_job_id"),
        pick(TITLES, i).alias("job_title"),
        pick(COMPANIES, i).alias("company_name"),
        pick(LOCATIONS, i).alias("location_text"),
        F.concat_ws(" ", "text", pick(PHRASES, i * 7)).alias("description_text"),
        pick(FUNCTIONS, i).alias("job_function"),
        pick(INDUSTRIES, i).alias("industries"),
    )


VIEWS["doc_jobs"] = f"""
SELECT doc_id AS job_id, source AS source_name, CAST(doc_id AS VARCHAR) AS source_job_id,
       {sql_pick(TITLES, 'doc_id')} AS job_title, {sql_pick(COMPANIES, 'doc_id')} AS company_name,
       {sql_pick(LOCATIONS, 'doc_id')} AS location_text,
       text || ' ' || {sql_pick(PHRASES, 'doc_id * 7')} AS description_text,
       {sql_pick(FUNCTIONS, 'doc_id')} AS job_function,
       {sql_pick(INDUSTRIES, 'doc_id')} AS industries
FROM documents"""

# --- raw records: one per document; the length is the source's own id, so that
# copies and equal lengths collide ---------------------------------------------


def raw_records(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("doc_id")
    key = F.when((F.col("lang") == "de") & (F.col("n_chars") < 1500), F.lit(None)).otherwise(
        F.col("n_chars")
    )
    body = F.to_json(
        F.struct(
            key.alias("job_id"),
            pick(TITLES, i).alias("title"),
            pick(COMPANIES, i).alias("company"),
            pick(LOCATIONS, i).alias("location"),
            F.when(F.col("lang") != "fr", F.col("text")).alias("description_text"),
            F.col("n_chars").alias("html_size"),
        )
    )
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    return texts(spark, folder, "documents", *columns).select(
        i.alias("position"),
        F.when((F.col("lang") == "es") & (F.col("n_chars") < 1500), F.lit("")).otherwise(
            F.col("source")
        ).alias("source_name"),
        F.concat(F.lit("https://jobs.example.com/"), i).alias("source_url"),
        F.lit("2026-06-18T08:00:00+00:00").alias("scraped_at"),
        F.when((F.col("lang") == "en") & (F.col("n_chars") < 400), F.lit("[1, 2]")).otherwise(
            body
        ).alias("raw_payload"),
    )


VIEWS["raw_fields"] = f"""
SELECT doc_id AS position, doc_id, lang, n_chars, source,
       CASE WHEN lang = 'es' AND n_chars < 1500 THEN '' ELSE source END AS source_name,
       'https://jobs.example.com/' || doc_id AS source_url,
       NOT (lang = 'en' AND n_chars < 400) AS is_object,
       CASE WHEN lang = 'de' AND n_chars < 1500 THEN NULL ELSE n_chars END AS payload_id,
       {sql_pick(TITLES, 'doc_id')} AS title, {sql_pick(COMPANIES, 'doc_id')} AS company,
       {sql_pick(LOCATIONS, 'doc_id')} AS location,
       CASE WHEN lang <> 'fr' THEN text END AS description_text
FROM documents"""

VIEWS["raw_records"] = """
SELECT *, CASE WHEN is_object THEN CAST(payload_id AS VARCHAR) END AS source_job_id,
       CASE WHEN is_object THEN '{' || array_to_string(list_filter([
              '"company":' || CAST(to_json(company) AS VARCHAR),
              '"description_text":' || CAST(to_json(description_text) AS VARCHAR),
              '"html_size":' || n_chars, '"job_id":' || payload_id,
              '"location":' || CAST(to_json(location) AS VARCHAR),
              '"title":' || CAST(to_json(title) AS VARCHAR)], lambda x: x IS NOT NULL
                AND NOT ends_with(x, ':null')), ',')
            || '}' ELSE '[1,2]' END AS canonical,
       CASE WHEN coalesce(source_name, '') = '' THEN 'missing source_name'
            WHEN NOT is_object THEN 'missing raw_payload dictionary'
            WHEN payload_id IS NULL THEN 'missing raw_payload.job_id' END AS reject_reason
FROM {raw_fields}"""


def stored_records(spark: SparkSession, folder: str) -> DataFrame:
    """What is already loaded: the keys of the labelled documents."""
    labelled = table(spark, folder, "labels").select("doc_id").distinct()
    documents = table(spark, folder, "documents").join(labelled, "doc_id")
    return documents.groupBy(
        F.col("source").alias("source_name"), F.col("n_chars").cast("string").alias("source_job_id")
    ).agg(F.min("doc_id").alias("raw_job_id"))


VIEWS["stored_records"] = """
SELECT source AS source_name, CAST(n_chars AS VARCHAR) AS source_job_id,
       min(documents.doc_id) AS raw_job_id
FROM documents JOIN (SELECT DISTINCT doc_id FROM labels) l ON documents.doc_id = l.doc_id
GROUP BY 1, 2"""

VIEWS["outcomes"] = """
SELECT r.*, CASE WHEN reject_reason IS NOT NULL THEN 'failed'
                 WHEN s.raw_job_id IS NULL AND nth = 1 THEN 'inserted'
                 ELSE 'skipped_duplicate' END AS outcome
FROM (SELECT *, row_number() OVER (PARTITION BY reject_reason IS NULL, source_name, source_job_id
                                   ORDER BY position) AS nth FROM {raw_records}) r
LEFT JOIN {stored_records} s
  ON r.source_name = s.source_name AND r.source_job_id = s.source_job_id"""

SPACES = r"[\s\p{Z}\x0B\x1C-\x1F\x85]"


def sql_collapse(text: str) -> str:
    return f"trim(regexp_replace({text}, '{SPACES}+', ' ', 'g'))"


def sql_clean(text: str) -> str:
    return f"nullif({sql_collapse(text)}, '')"


def sql_match_text(text: str) -> str:
    return f"coalesce({sql_collapse(f'lower({text})')}, '')"


def sql_phrase(text: str, phrase: str) -> str:
    escaped = "".join("\\" + c if c in "+.-/" else c for c in phrase.lower())
    word = r"[^\p{L}\p{N}_]"
    return f"regexp_matches({text}, {quote(f'(^|{word}){escaped}({word}|$)')})"


def sql_first_phrase(text: str, phrases) -> str:
    arms = " ".join(f"WHEN {sql_phrase(text, p)} THEN {quote(p.lower())}" for p in phrases)
    return f"CASE {arms} END"


def sql_country(location: str) -> str:
    names = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in V.COUNTRY_NAMES.items())
    stripped = f"regexp_replace({location}, '^{SPACES}+|{SPACES}+$', '', 'g')"
    part = (
        f"list_filter(list_transform(string_split({stripped}, ','), "
        f"lambda p: regexp_replace(p, '^{SPACES}+|{SPACES}+$', '', 'g')), lambda p: p <> '')[-1]"
    )
    metros = " OR ".join(f"contains(lower({stripped}), {quote(m)})" for m in V.US_METRO_SIGNALS)
    return f"""CASE WHEN {location} IS NULL OR {stripped} = '' THEN NULL
      WHEN lower({stripped}) IN {sql_in(V.NO_COUNTRY_WORDS)} THEN NULL
      WHEN CASE lower({stripped}) {names} END IS NOT NULL
        THEN CASE lower({stripped}) {names} END
      WHEN contains({stripped}, ',') AND upper({part}) IN {sql_in(V.US_STATE_CODES)}
        THEN 'United States'
      WHEN contains({stripped}, ',') AND CASE lower({part}) {names} END IS NOT NULL
        THEN CASE lower({part}) {names} END
      WHEN {metros} THEN 'United States' END"""


def sql_remote(location: str, description: str) -> str:
    text = f"lower(concat_ws(' ', nullif({location}, ''), nullif({description}, '')))"

    def any_of(parts) -> str:
        return "(" + " OR ".join(f"contains({text}, {quote(p)})" for p in parts) + ")"

    return (
        f"CASE WHEN contains({text}, 'hybrid') THEN 'hybrid' "
        f"WHEN {any_of(V.REMOTE_SIGNALS)} THEN 'remote' "
        f"WHEN {any_of(V.ONSITE_SIGNALS)} THEN 'onsite' ELSE 'unknown' END"
    )


VIEWS["role_texts"] = f"""
SELECT job_id, {sql_match_text('job_title')} AS title_text,
       concat_ws(' ', nullif({sql_match_text('job_title')}, ''),
                 nullif({sql_match_text('description_text')}, ''),
                 nullif({sql_match_text('job_function')}, ''),
                 nullif({sql_match_text('industries')}, '')) AS context_text
FROM {{doc_jobs}}"""
