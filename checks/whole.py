"""Rules and responses on whole texts, changes, large arrays, ledgers and page criteria.

The queries named like others with `_all` see every word or sentence of the texts, every part
name and type, and every customer and nation name, where the others see a few per document.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions import roles as R
from hirelens.functions import text as T
from hirelens.functions.once import with_computed
from hirelens.functions.location import parse_country, remote_text, remote_type
from hirelens.operators import bronze as B
from hirelens.operators import pages as P
from hirelens.operators import silver as S
from hirelens.operators import skills as K
from hirelens.plans import explore, incremental, search_index, skill_sets as sets
from hirelens.session import scratch_path, stage
from hirelens.sources import raw_records as raw_files
from hirelens.sources.tables import SILVER_SCAN, scan

from checks import bridge as b
from checks import docs, star, vocab, web
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


# --- titles and places: every word, sentence and name -------------------------------

b.VIEWS["name_items"] = """
SELECT DISTINCT item FROM (SELECT item FROM {rule_items} UNION ALL SELECT c_name FROM customer
  UNION ALL SELECT n_name FROM nation UNION ALL SELECT r_name FROM region
  UNION ALL SELECT c_mktsegment || ', ' || n_name FROM customer JOIN nation
    ON c_nationkey = n_nationkey) WHERE item IS NOT NULL"""


def name_items(spark, d):
    customer, nation = b.table(spark, d, "customer"), b.table(spark, d, "nation")
    placed = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    items = vocab.repeated_rule_items(spark, d)
    for more in (
        customer.select("c_name"), nation.select("n_name"),
        b.table(spark, d, "region").select("r_name"),
        placed.select(F.concat("c_mktsegment", F.lit(", "), "n_name")),
    ):
        items = items.unionAll(more)
    return items.filter("item is not null").distinct()


@query(f"""SELECT item, {b.sql_country('item')} AS country,
       {b.sql_remote('item', 'item')} AS remote_type FROM name_items""", "name_items")
def parse_country_all(spark, d):
    item = F.col("item")
    items = with_computed(name_items(spark, d), {
        "_place": T.strip_space(item), "_remote": remote_text(item, item)})
    return items.select(
        "item", parse_country(F.col("_place"), is_clean=True).alias("country"),
        remote_type(F.col("_remote")).alias("remote_type"),
    )


FIRST_EXCLUSION = b.sql_first_phrase(b.sql_match_text("item"), V.EXCLUSION_WORDS)


@query(f"""SELECT item, {quote(V.EXCLUSION_REASON)} || word AS exclusion_reason
FROM (SELECT item, {FIRST_EXCLUSION} AS word FROM name_items)""", "name_items")
def exclusion_all(spark, d):
    return name_items(spark, d).select(
        "item", R.exclusion_reason(T.match_text(F.col("item"))).alias("exclusion_reason")
    )


# --- responses with every word of a document, and every part ------------------------

CHAIN = ["responses", "parsed", "judged_responses", "raw_items", "items", "candidates",
         "new_vocabulary", "all_skills", "linked", "stored_aliases", "alias_rows"]


def whole(text: str) -> str:
    """A view over the responses below instead of those of a few words."""
    for name in CHAIN:
        text = text.replace("{" + name + "}", "{" + name + "_all}")
    return text


for _name in CHAIN:
    b.VIEWS[_name + "_all"] = whole(b.VIEWS[_name])
WORD_ITEM = ('{"skill_name":"', '","skill_category":"', '","raw_mention":"',
             '","confidence_score":', "}")
_W = "list_transform(range(1, len(w) + 1), lambda i: "
b.VIEWS["responses_all"] = f"""
SELECT job_id, '{{"skills":[' || array_to_string(list_concat(
         {_W} {quote(WORD_ITEM[0])} || w[i] || {quote(WORD_ITEM[1])}
           || {b.sql_pick(vocab.CATEGORIES, 'i')} || {quote(WORD_ITEM[2])}
           || w[i] || {b.sql_pick(vocab.MENTION_TAILS, 'i')} || {quote(WORD_ITEM[3])}
           || (i % 10) || {quote(WORD_ITEM[4])}),
         CASE WHEN p_name IS NULL THEN []
              ELSE ['{{"skill_name":"' || p_name || '","skill_category":"' || p_type || '"}}'] END
       ), ',') || ']}}' AS response_text
FROM (SELECT doc_id AS job_id, regexp_extract_all(lower(text), '[a-z]+') AS w
      FROM documents WHERE text IS NOT NULL) LEFT JOIN part ON job_id = p_partkey"""
b.VIEWS["raw_items_all"] = """
SELECT job_id, CAST(position AS INTEGER) AS position, item
FROM (SELECT job_id, unnest(l) AS item, generate_subscripts(l, 1) - 1 AS position
      FROM (SELECT job_id, from_json(json_extract(j, '$.skills'), '["json"]') AS l
            FROM {judged_responses_all}
            WHERE failure IS NULL AND json_type(j, '$.skills') = 'ARRAY'))"""
b.VIEWS["stored_aliases_all"] = """
SELECT min(p_partkey) AS skill_alias_id, min(p_partkey) AS skill_id, p_name AS alias_name
FROM part GROUP BY p_name"""


TASKS_A_CORE = 4


def responses_all(spark, d):
    """Every word of a document as an item, in order, and the part with its number."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    documents = b.texts(spark, d, "documents", "doc_id", "text").filter("text is not null")
    # few files would be few tasks, and an answer is many times as long as its text
    documents = documents.repartition(TASKS_A_CORE * spark.sparkContext.defaultParallelism, "doc_id")
    part = b.table(spark, d, "part")
    joined = documents.join(part, documents.doc_id == part.p_partkey, "left").select(
        F.col("doc_id").alias("job_id"), words.alias("w"), "p_name", "p_type")
    begin, category, mention, score, end = WORD_ITEM
    heads = [category + c + mention for c in vocab.CATEGORIES]
    tails = vocab.MENTION_TAILS
    ends = [tails[n % len(tails)] + score + str(n % 10) + end for n in range(len(tails) * 10)]
    items = F.transform("w", lambda w, i: F.concat(
        F.lit(begin), w, b.pick(heads, i + 1), w, b.pick(ends, i + 1)))
    own = F.when(F.col("p_name").isNull(), F.array().cast("array<string>")).otherwise(F.array(
        F.concat(F.lit('{"skill_name":"'), "p_name", F.lit('","skill_category":"'), "p_type",
                 F.lit('"}'))))
    text = F.concat(F.lit('{"skills":['), F.array_join(F.concat(items, own), ","), F.lit("]}"))
    return joined.select("job_id", text.alias("response_text"))


def _parsed_all(spark, d):
    return K.parse_responses(responses_all(spark, d))


def _lists_all(spark, d):
    return stage(K.response_lists(_parsed_all(spark, d)), "lists")


def _candidates_all(spark, d):
    return K.deduplicate(_lists_all(spark, d))


@query("""SELECT r.job_id, r.failure, i.position, i.skill_name, i.skill_category,
       i.raw_mention, i.confidence_score
FROM judged_responses_all r LEFT JOIN items_all i ON r.job_id = i.job_id""",
       "judged_responses_all", "items_all")
def response_parse_all(spark, d):
    return K.responses_with_items(_lists_all(spark, d))


@query("SELECT * FROM candidates_all", "candidates_all")
def skill_dedup_all(spark, d):
    return _candidates_all(spark, d)


@query("""SELECT (SELECT count(*) FROM judged_responses_all WHERE failure IS NULL) AS jobs_processed,
       (SELECT count(*) FROM candidates_all) AS links_saved,
       (SELECT count(*) FROM judged_responses_all WHERE failure IS NOT NULL) AS failed_jobs""",
       "judged_responses_all", "candidates_all")
def skill_report_all(spark, d):
    lists = _lists_all(spark, d)
    return K.extraction_report(lists, K.deduplicate(lists))


@query("SELECT * FROM all_skills_all", "all_skills_all")
def upsert_skills_all(spark, d):
    candidates = stage(_candidates_all(spark, d), "skills")
    merged = K.upsert_skills(vocab._vocabulary(spark, d), candidates)
    return merged.select("skill_id", "skill_name", "skill_category")


def _linked_all(spark, d):
    candidates = stage(_candidates_all(spark, d), "skills")
    return K.with_skill_ids(candidates, K.upsert_skills(vocab._vocabulary(spark, d), candidates))


@query("""SELECT skill_alias_id, skill_id, alias_name FROM stored_aliases_all
UNION ALL
SELECT CAST((SELECT max(skill_alias_id) FROM stored_aliases_all)
         + row_number() OVER (ORDER BY job_id, position, kind) AS BIGINT), skill_id, alias_name
FROM (SELECT *, row_number() OVER (PARTITION BY alias_name ORDER BY job_id, position, kind) AS nth
      FROM alias_rows_all) a
WHERE nth = 1 AND alias_name NOT IN (SELECT alias_name FROM stored_aliases_all)""",
       "alias_rows_all", "stored_aliases_all")
def insert_aliases_all(spark, d):
    part = b.table(spark, d, "part")
    stored = part.groupBy(F.col("p_name").alias("alias_name")).agg(
        F.min("p_partkey").alias("skill_id"))
    stored = stored.select(
        F.col("skill_id").alias("skill_alias_id"), "skill_id", "alias_name",
        F.lit("2026-01-01").cast("timestamp").alias("created_at"))
    merged = K.insert_aliases(stored, stage(_linked_all(spark, d), "linked"))
    return merged.select("skill_alias_id", "skill_id", "alias_name")


@query("""SELECT coalesce(n.job_id, l.job_id) AS job_id,
       coalesce(n.skill_id, l.skill_id) AS skill_id,
       CASE WHEN n.job_id IS NULL THEN l.extraction_method ELSE 'ai' END AS extraction_method,
       CASE WHEN n.job_id IS NULL THEN 'stored' ELSE n.raw_mention END AS raw_mention,
       CAST(CASE WHEN n.job_id IS NULL THEN l.confidence_score
            ELSE CAST(n.confidence_score AS DECIMAL(5,4)) END AS DOUBLE) AS confidence_score
FROM links l FULL JOIN linked_all n ON l.job_id = n.job_id AND l.skill_id = n.skill_id""",
       "links", "linked_all")
def upsert_links_all(spark, d):
    merged = K.upsert_links(vocab._stored_links(spark, d), _linked_all(spark, d), "ai")
    return merged.select(
        "job_id", "skill_id", "extraction_method", "raw_mention",
        F.col("confidence_score").cast("double").alias("confidence_score"),
    )


@query(f"""SELECT raw_mention, skill_name, mention_count FROM (
  SELECT raw_mention, s.skill_name, count(*) AS mention_count
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^.\\n]+')) AS raw_mention FROM documents)
  JOIN skills s ON doc_id = s.skill_id WHERE length(raw_mention) > {V.LONG_MENTION_LENGTH}
  GROUP BY 1, 2) ORDER BY length(raw_mention) DESC, raw_mention, skill_name
LIMIT {V.LONG_MENTION_ROWS}""", "skills")
def long_mentions_all(spark, d):
    """Every sentence of a document as a mention of the part with its number; the report has
    so many rows by itself."""
    sentences = F.regexp_extract_all("text", F.lit(r"[^.\n]+"), F.lit(0))
    mentions = b.texts(spark, d, "documents", "doc_id", "text").select(
        F.col("doc_id").alias("job_id"), F.col("doc_id").alias("skill_id"),
        F.explode(sentences).alias("raw_mention"))
    return explore.long_mentions(mentions, b.skills(spark, d))


# --- raw files, partial records, ledger, scans --------------------------------------


@query("""SELECT source_name, source_url, '2026-06-18T08:00:00+00:00' AS scraped_at,
       sha256(canonical) AS payload_hash FROM raw_records""", "raw_records")
def src_raw_array(spark, d):
    """JSON arrays, read in byte ranges."""
    path = scratch_path(spark, "src_raw_array")
    raw_files.write_record_arrays(b.raw_records(spark, d), path)
    records = raw_files.read_raw_records(spark, path, "split_array")
    hashed = B.with_content_hash(raw_files.require_records(records))
    return hashed.select("source_name", "source_url", "scraped_at",
                         F.col("content_hash").alias("payload_hash"))


MISSING = {
    "job_id": "coalesce(payload_id, 0) = 0", "title": "coalesce(title, '') = ''",
    "company": "coalesce(company, '') = ''", "location": "coalesce(location, '') = ''",
    "description_text": "coalesce(description_text, '') = ''",
}
_fields = ", ".join(
    f"CASE WHEN NOT is_object OR {test} THEN '{name}' END" for name, test in MISSING.items())
b.VIEWS["completeness"] = f"""
SELECT source_url, list_filter([{_fields}], lambda x: x IS NOT NULL) AS missing FROM {{raw_fields}}"""


@query("""SELECT source_url AS url, 'partial_success' AS status,
       array_to_string(missing, ',') AS missing, CAST(NULL AS VARCHAR) AS error
FROM completeness WHERE len(missing) > 0
UNION ALL SELECT url, 'failed', NULL, 'status ' || page_id FROM pages
UNION ALL SELECT NULL, 'saved', CAST(count(*) AS VARCHAR), NULL FROM completeness""",
       "completeness")
def partial_records_kept(spark, d):
    """Partial records are saved too, and pages stand for addresses that could not be fetched.
    One more row has the number of saved records."""
    checked = S.split_by_completeness(b.raw_records(spark, d), keep_partial=True)
    errors = b.texts(spark, d, "pages", "page_id", "url").select(
        "url", F.concat(F.lit("status "), F.col("page_id").cast("string")).alias("error"))
    failures = S.collection_failures(checked, errors).select(
        "url", "status", F.array_join("missing_fields", ",").alias("missing"), "error")
    none = F.lit(None).cast("string")
    saved = S.saved_rate(checked).select(
        none.alias("url"), F.lit("saved").alias("status"),
        F.col("saved_records").cast("string").alias("missing"), none.alias("error"))
    return failures.unionByName(saved)


@query("""SELECT source_name AS run_source, status, total_records AS raw_records_count,
       inserted_count AS inserted_raw_count, failed_count AS failed_records_count
FROM (SELECT source_name, count(*) AS total_records,
             count(*) FILTER (outcome = 'inserted') AS inserted_count,
             count(*) FILTER (outcome = 'failed') AS failed_count,
             CASE WHEN count(*) FILTER (outcome = 'failed') = 0 THEN 'success'
                  WHEN count(*) FILTER (outcome <> 'failed') > 0 THEN 'partial_success'
                  ELSE 'failed' END AS status
      FROM outcomes WHERE source_name <> '' GROUP BY 1)""", "outcomes")
def run_open_close(spark, d):
    """A run for each source, opened and closed; the closing rows are those that count."""
    counts = B.load_counts(docs._outcomes(spark, d), ["source_name"]).filter("source_name <> ''")
    ledger = None
    for number, row in enumerate(counts.orderBy("source_name").collect(), 1):
        name = row["source_name"]
        opened = B.open_run(spark, number, "load of " + name, name, row["total_records"])
        closed = B.close_run(opened, row["status"], row["inserted_count"], row["failed_count"])
        both = opened.unionByName(closed)
        ledger = both if ledger is None else ledger.unionByName(both)
    return B.latest_runs(ledger).select(
        F.col("source_name").alias("run_source"), "status",
        *[F.col(c).cast("bigint").alias(c) for c in
          ("raw_records_count", "inserted_raw_count", "failed_records_count")])


@query("""SELECT job_id, job_title, description_text, job_function, industries FROM doc_jobs
ORDER BY job_id LIMIT 25""", "doc_jobs")
def scan_silver_limited(spark, d):
    """The scan with its limit, which is the feature here."""
    return scan(b.doc_jobs(spark, d), SILVER_SCAN, "job_id", 25)


# --- criteria and comment values of pages -------------------------------------------

ITEM = '<li><a href="/([^"]*)">([^<]*)</a></li>'
AS_CRITERION = (
    f'<li class="{V.CRITERIA_ITEM[1][0]}"><h3 class="{V.CRITERIA_KEY[1][0]}">{{1}}</h3>'
    f'<span class="{V.CRITERIA_VALUE[1][0]}"> {{2}}\n</span></li>'
)
AD, AS_ID = "<!-- ad ([0-9]+) -->", '<code id="decoratedJobPostingId"><!--"{1}"--></code>'


def _numbered(pattern: str, sign: str) -> str:
    return pattern.replace("{1}", sign + "1").replace("{2}", sign + "2")


b.VIEWS["criteria"] = f"""
SELECT page_id, regexp_extract(html, '{AD}', 1) AS job_id, unnest(found) AS item,
       generate_subscripts(found, 1) AS position
FROM (SELECT *, regexp_extract_all(html, '{ITEM}', 0) AS found FROM pages)"""


@query(f"""SELECT page_id, job_id, criterion, arg_max(value, position) AS value
FROM (SELECT page_id, job_id, position, {web.sql_markup_text('value')} AS value,
             replace(replace(lower({web.sql_markup_text('name')}), ' ', '_'), '-', '_') AS criterion
      FROM (SELECT *, regexp_extract(item, '{ITEM}', 1) AS name,
                   regexp_extract(item, '{ITEM}', 2) AS value FROM criteria))
WHERE coalesce(criterion, '') <> '' AND coalesce(value, '') <> '' GROUP BY 1, 2, 3""", "criteria")
def page_criteria(spark, d):
    """Each page's links written as criteria, and its comment as the job's id."""
    html = F.regexp_replace("html", ITEM, _numbered(AS_CRITERION, "$"))
    html = F.regexp_replace(html, AD, _numbered(AS_ID, "$"))
    pages = web._pages(spark, d).withColumn("html", html)
    payloads = P.page_payloads(pages, ["page_id"])
    return payloads.select("page_id", "job_id", F.explode("criteria").alias("criterion", "value"))


# --- sets of skills -----------------------------------------------------------------

SUPPORT = 2
b.VIEWS["role_pairs"] = """
SELECT DISTINCT e.detected_role, e.job_id, l.skill_id
FROM {eligible} e JOIN {links} l ON e.job_id = l.job_id"""


@query(f"""SELECT detected_role, array_to_string(list_sort(list_transform(
         list_filter([a.skill_name, b.skill_name, c.skill_name], lambda x: x IS NOT NULL),
         lambda x: x)), ', ') AS skill_names, CAST(skills AS INTEGER) AS skills, jobs
FROM (SELECT x.detected_role, x.skill_id AS s1, y.skill_id AS s2, NULL AS s3, 2 AS skills,
             count(*) AS jobs
      FROM role_pairs x JOIN role_pairs y ON x.job_id = y.job_id AND x.skill_id < y.skill_id
      GROUP BY 1, 2, 3 HAVING count(*) >= {SUPPORT}
      UNION ALL
      SELECT x.detected_role, x.skill_id, y.skill_id, z.skill_id, 3, count(*)
      FROM role_pairs x JOIN role_pairs y ON x.job_id = y.job_id AND x.skill_id < y.skill_id
      JOIN role_pairs z ON y.job_id = z.job_id AND y.skill_id < z.skill_id
      GROUP BY 1, 2, 3, 4 HAVING count(*) >= {SUPPORT})
JOIN skills a ON a.skill_id = s1 JOIN skills b ON b.skill_id = s2
LEFT JOIN skills c ON c.skill_id = s3""", "role_pairs", "skills")
def skill_sets(spark, d):
    analysis = b.analysis(spark, d).filter(
        ~F.col("is_excluded_from_analysis") & ~F.col("detected_role").isin(V.NON_TARGET_ROLES))
    found = sets.skill_sets(analysis, b.link_pairs(spark, d), SUPPORT, largest=3)
    return sets.named_sets(found, b.skills(spark, d))


# --- search index -------------------------------------------------------------------

b.VIEWS["terms"] = """
SELECT DISTINCT lower(trim(term)) AS term FROM (
  SELECT n_name AS term FROM nation UNION ALL SELECT r_name FROM region
  UNION ALL SELECT substr(n_name, 2, 2) FROM nation UNION ALL SELECT substr(r_name, 1, 1) FROM region
  UNION ALL SELECT DISTINCT substr(p_name, 2, 7) FROM part
  UNION ALL SELECT DISTINCT 'é' || lang FROM documents UNION ALL SELECT '' FROM region)"""


def _terms(spark, d):
    nation, region = b.table(spark, d, "nation"), b.table(spark, d, "region")
    out = nation.select(F.col("n_name").alias("term"))
    for more in (
        region.select("r_name"), nation.select(F.substring("n_name", 2, 2)),
        region.select(F.substring("r_name", 1, 1)),
        b.table(spark, d, "part").select(F.substring("p_name", 2, 7)),
        b.texts(spark, d, "documents", "lang").select(F.concat(F.lit("é"), "lang")),
        region.select(F.lit("")),
    ):
        out = out.unionAll(more)
    return out


@query("""SELECT t.term, e.job_id FROM explorer e JOIN terms t
ON contains(lower(coalesce(e.job_title, '')), t.term)
OR contains(lower(coalesce(e.company_name, '')), t.term)
OR contains(lower(coalesce(e.location_text, '')), t.term)
OR contains(lower(coalesce(e.skill_names, '')), t.term)""", "explorer", "terms")
def explorer_search(spark, d):
    """Names, parts of names, short, empty and non-ASCII terms looked up in the index."""
    mart = stage(star._explorer(spark, d), "explorer")
    path = scratch_path(spark, "search-index")
    search_index.write_search_index(mart, path)
    return search_index.search(spark, path, mart, _terms(spark, d))


# --- incremental refresh ------------------------------------------------------------

SEEDS = {k.lower(): v for k, v in V.CANONICAL_SKILLS.items()}
for _name in [*V.CANONICAL_SKILLS.values(), *V.CATEGORY_BY_SKILL]:
    SEEDS.setdefault(_name.lower(), _name)
SEED_ROWS = ", ".join(
    f"({quote(' ' + ' '.join(_split) + ' ')}, {quote(v)})"
    for k, v in SEEDS.items()
    for _split in [re.findall(r"\w+(?:[.\-/]\w+)*[+#]*", k)]
)
b.VIEWS["found_skills"] = f"""
SELECT j.job_id, string_agg(DISTINCT s.skill_name, ', ' ORDER BY s.skill_name) AS skill_names
FROM (SELECT job_id, ' ' || array_to_string(regexp_extract_all(lower(concat_ws(' ',
               {sql_clean('job_title')}, {sql_clean('description_text')})),
               {quote(vocab.TOKEN)}), ' ') || ' ' AS words FROM {{doc_jobs}}) j
JOIN (VALUES {SEED_ROWS}) s(phrase, skill_name) ON contains(j.words, s.phrase)
GROUP BY 1"""


@query(f"""SELECT j.source_job_id, d.detected_role, d.confidence_score AS role_confidence_score,
       d.exclusion_word IS NOT NULL AS is_excluded_from_analysis,
       CASE WHEN d.exclusion_word IS NULL THEN f.skill_names END AS skill_names,
       {sql_clean('j.company_name')} AS company_name
FROM doc_jobs j JOIN judged d ON j.job_id = d.job_id
LEFT JOIN found_skills f ON f.job_id = j.job_id
WHERE {sql_clean('j.job_title')} IS NOT NULL AND {sql_clean('j.description_text')} IS NOT NULL""",
       "doc_jobs", "judged", "found_skills")
def refresh_incremental(spark, d):
    """The explorer mart after two loads: the English documents, then all of them."""
    jobs = b.doc_jobs(spark, d)
    payload = F.to_json(F.struct(
        F.col("source_job_id").alias("job_id"), F.col("job_title").alias("title"),
        F.col("company_name").alias("company"), F.col("location_text").alias("location"),
        "description_text", "job_function", "industries"))
    records = jobs.select(
        "job_id", F.lit("board").alias("source_name"),
        F.col("source_job_id").alias("source_url"),
        F.lit("2026-06-18T08:00:00+00:00").alias("scraped_at"), payload.alias("raw_payload"))
    english = b.texts(spark, d, "documents", "doc_id", "lang").filter("lang = 'en'")
    root = scratch_path(spark, "incremental")
    for name, part in (
        ("first", records.join(english, F.col("job_id") == F.col("doc_id"), "left_semi")),
        ("second", records),
    ):
        path = scratch_path(spark, f"incremental-{name}")
        raw_files.write_records(part, path)
        result = incremental.refresh_incremental(spark, path, root, layout="lines", buckets=4)
    return result.marts["mart_job_explorer"].select(
        F.col("source_url").alias("source_job_id"), "detected_role",
        F.col("role_confidence_score").cast("double").alias("role_confidence_score"),
        "is_excluded_from_analysis", "skill_names", "company_name")
