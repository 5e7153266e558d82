"""Skill responses, vocabulary, aliases, links and dictionary extraction.

Response texts are put together from each document's own words and the part
with its number.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions import skills as SK
from hirelens.functions import text as T
from hirelens.operators import skills as K
from hirelens.session import stage

from checks import bridge as b
from checks.bridge import quote, sql, sql_collapse

QUERIES, SQL = {}, {}


def query(statement: str | None, *views: str, name: str | None = None):
    def register(function):
        key = name or function.__name__
        QUERIES[key] = function
        if statement is not None:
            SQL[key] = sql(statement, *views)
        return function

    return register


NAMES = [
    "PySpark", "communication", "R", "PowerPoint", "x", "  Power   BI ", "postgres", "DBT",
    "Microsoft Azure", "SQL", "excel", "Excel", "A.I.", "database", "Data", "Tableau",
    "a very long skill name that goes on and on well past the limit of eighty characters in all",
    "Looker", "NumPy", "numpy", "Reporting", "Snowflake", "C",
]
CATEGORIES = [
    "Programming Language", "bi tools", "Cloud", "nonsense", "", "Database", "ml",
    "  Data   Warehouse ", "Statistics", "DEVOPS", "DevOps",
]
MENTION_TAILS = ["", " or similar", " (preferred)", " such as this", ", and more", " tools",
                 " a b c d e f g"]
FIRST_WORD = "[a-z]+"
SECOND_WORD = "[a-z]+[^a-z]+([a-z]+)"


def _fields(spark, d):
    i = F.col("doc_id")
    documents, part = b.table(spark, d, "documents"), b.table(spark, d, "part")
    joined = documents.join(part, documents.doc_id == part.p_partkey, "left")
    lowered = F.lower("text")
    return joined.select(
        i.alias("job_id"),
        b.pick(NAMES, i * 5).alias("name"),
        b.pick(CATEGORIES, i).alias("category"),
        F.regexp_extract(lowered, FIRST_WORD, 0).alias("w1"),
        F.concat(F.regexp_extract(lowered, SECOND_WORD, 1), b.pick(MENTION_TAILS, i)).alias("w2"),
        F.coalesce("p_name", F.lit("no part")).alias("p_name"),
        F.coalesce("p_type", F.lit("")).alias("p_type"),
    )


b.VIEWS["response_fields"] = f"""
SELECT doc_id AS job_id, {b.sql_pick(NAMES, 'doc_id * 5')} AS name,
       {b.sql_pick(CATEGORIES, 'doc_id')} AS category,
       regexp_extract(lower(text), '{FIRST_WORD}', 0) AS w1,
       regexp_extract(lower(text), '{SECOND_WORD}', 1)
           || {b.sql_pick(MENTION_TAILS, 'doc_id')} AS w2,
       coalesce(p_name, 'no part') AS p_name, coalesce(p_type, '') AS p_type
FROM documents LEFT JOIN part ON doc_id = p_partkey"""

# {name} and friends stand for the columns above
ITEM_1 = ('{"skill_name":"{name}","skill_category":"{category}","raw_mention":"{w1}",'
          '"confidence_score":0.9}')
ITEM_2 = ('{"skill_name":"{p_name}","skill_category":"{p_type}","raw_mention":"{w2}",'
          '"confidence_score":"0.45"}')
ITEM_3 = '{"skill_name":"{w1}","skill_category":"Programming","confidence_score":1}'
TEMPLATES = [
    f'{{"skills":[{ITEM_1},{ITEM_2},{ITEM_3}]}}',
    f'```json\n{{"skills":[{ITEM_1},{ITEM_2}]}}\n```',
    f'  ```\n{{"skills":[{ITEM_2}]}}\n``` ',
    '{"skills":[]}',
    '{"items":[1]}',
    '{"skills":null}',
    '{"skills":"none"}',
    '{"skills":[{"skill_name":"{name}"',
    f'{{"skills":[1,"x",{ITEM_1},null,["y"],{ITEM_2}]}}',
    '{"skills":[{"skill_name":"{name}","confidence_score":"1.5"},{"skill_name":"{w1}",'
    '"confidence_score":"high"},{"skill_name":"{p_name}","confidence_score":-0.2}]}',
    '{"skills":[{"skill_name":"{p_name} kit","confidence_score":0.4},{"skill_name":"{p_name} KIT",'
    '"skill_category":"Cloud","confidence_score":0.8},{"skill_name":"{p_name}  Kit",'
    '"confidence_score":0.8},{"skill_name":"{w1}"}]}',
    f'[{ITEM_1}]',
]
COLUMNS = ["name", "category", "w1", "w2", "p_name", "p_type"]


def _pieces(template: str) -> list[tuple[bool, str]]:
    """Template text cut into (is column, text)."""
    pieces, rest = [], template
    while rest:
        spots = [(rest.find("{" + c + "}"), c) for c in COLUMNS]
        spots = sorted(s for s in spots if s[0] >= 0)
        if not spots:
            pieces.append((False, rest))
            break
        at, column = spots[0]
        pieces += [(False, rest[:at]), (True, column)]
        rest = rest[at + len(column) + 2:]
    return pieces


def responses(spark, d):
    which = F.col("job_id") % len(TEMPLATES)
    text = F
    for n, template in enumerate(TEMPLATES):
        built = F.concat(*[F.col(p) if is_column else F.lit(p)
                           for is_column, p in _pieces(template)])
        text = text.when(which == n, built)
    return _fields(spark, d).select("job_id", text.alias("response_text"))


def _sql_template(template: str) -> str:
    parts = []
    for is_column, piece in _pieces(template):
        if is_column:
            parts.append(piece)
        else:
            parts.append(" || chr(10) || ".join(quote(line) for line in piece.split("\n")))
    return " || ".join(parts)


b.VIEWS["responses"] = (
    f"SELECT job_id, CASE job_id % {len(TEMPLATES)} "
    + " ".join(f"WHEN {n} THEN {_sql_template(t)}" for n, t in enumerate(TEMPLATES))
    + " END AS response_text FROM {response_fields}"
)
ENDS = f"^{b.SPACES}+|{b.SPACES}+$"
b.VIEWS["parsed"] = f"""
SELECT job_id, bare, CASE WHEN json_valid(bare) THEN CAST(bare AS JSON) END AS j
FROM (SELECT job_id, regexp_replace(regexp_replace(regexp_replace(
        regexp_replace(response_text, '{ENDS}', '', 'g'),
        '^```json{b.SPACES}*', ''), '^```{b.SPACES}*', ''), '{b.SPACES}*```$', '') AS bare
      FROM {{responses}})"""
b.VIEWS["judged_responses"] = f"""
SELECT job_id, j, CASE WHEN j IS NULL OR json_type(j) <> 'OBJECT' THEN {quote(K.BAD_JSON)}
    WHEN json_extract(j, '$.skills') IS NOT NULL AND json_type(j, '$.skills') <> 'NULL'
     AND json_type(j, '$.skills') <> 'ARRAY' THEN {quote(K.NOT_A_LIST)} END AS failure
FROM {{parsed}}"""


def sql_name(text: str) -> str:
    collapsed = f"coalesce({sql_collapse(text)}, '')"
    arms = {k.lower(): v for k, v in V.CANONICAL_SKILLS.items()}
    return f"coalesce({b.sql_case(f'lower({collapsed})', arms)}, {collapsed})"


def sql_category(name: str, category: str) -> str:
    collapsed = f"coalesce({sql_collapse(category)}, '')"
    aliases = {k.lower(): v for k, v in V.CATEGORY_ALIASES.items()}
    mapped = f"coalesce({b.sql_case(f'lower({collapsed})', aliases)}, {collapsed})"
    return (
        f"coalesce({b.sql_case(name, V.CATEGORY_BY_SKILL)}, "
        f"CASE WHEN {mapped} IN {b.sql_in(V.SKILL_CATEGORIES)} THEN {mapped} END, "
        f"{quote(V.DEFAULT_CATEGORY)})"
    )


def sql_rejected(name: str) -> str:
    key = f"lower(coalesce({sql_collapse(name)}, ''))"
    return (
        f"({key} IN {b.sql_in(V.REJECTED_SKILLS)} OR length({name}) > 80 "
        f"OR (length({name}) < 2 AND {name} <> 'R'))"
    )


def sql_confidence(text: str) -> str:
    number = f"TRY_CAST({text} AS DOUBLE)"
    return f"CASE WHEN {number} >= 0 AND {number} <= 1 THEN {number} END"


b.VIEWS["raw_items"] = """
SELECT job_id, CAST(position AS INTEGER) AS position, json_extract(j, '$.skills[' || position || ']') AS item
FROM (SELECT job_id, j,
             unnest(range(CAST(json_array_length(j, '$.skills') AS BIGINT))) AS position
      FROM {judged_responses} WHERE failure IS NULL AND json_type(j, '$.skills') = 'ARRAY')"""
b.VIEWS["items"] = f"""
SELECT job_id, position, skill_name, {sql_category('skill_name', 'category')} AS skill_category,
       CASE WHEN mention <> '' THEN mention ELSE skill_name END AS raw_mention,
       {sql_confidence('score')} AS confidence_score
FROM (SELECT job_id, position, {sql_name("json_extract_string(item, '$.skill_name')")}
               AS skill_name,
             json_extract_string(item, '$.skill_category') AS category,
             coalesce({sql_collapse("json_extract_string(item, '$.raw_mention')")}, '')
               AS mention,
             json_extract_string(item, '$.confidence_score') AS score
      FROM {{raw_items}} WHERE json_type(item) = 'OBJECT')
WHERE skill_name <> '' AND NOT {sql_rejected('skill_name')}"""
b.VIEWS["candidates"] = """
SELECT job_id, first_position AS position, skill_name, skill_category, raw_mention,
       confidence_score
FROM (SELECT *, min(position) OVER (PARTITION BY job_id, lower(skill_name)) AS first_position,
             row_number() OVER (PARTITION BY job_id, lower(skill_name)
                 ORDER BY coalesce(confidence_score, 0) DESC, position) AS nth
      FROM {items}) WHERE nth = 1"""


def _candidates(spark, d):
    return K.deduplicate(K.response_items(K.parse_responses(responses(spark, d))))


# --- scalar rules ------------------------------------------------------------------


@query(f"""SELECT job_id, lower(coalesce({sql_collapse('name')}, '')) AS skill_key,
       {sql_name('name')} AS skill_name FROM response_fields""", "response_fields")
def skill_norm(spark, d):
    return _fields(spark, d).select(
        "job_id", T.lookup_key(F.col("name")).alias("skill_key"),
        SK.normalize_name(F.col("name")).alias("skill_name"),
    )


@query(f"""SELECT job_id, {sql_category(sql_name('name'), 'category')} AS skill_category
FROM response_fields""", "response_fields")
def skill_category(spark, d):
    return _fields(spark, d).select(
        "job_id",
        SK.normalize_category(SK.normalize_name(F.col("name")), F.col("category")).alias(
            "skill_category"
        ),
    )


@query(f"""SELECT job_id, {sql_rejected(sql_name('name'))} AS is_rejected,
       {sql_rejected('w1')} AS is_word_rejected FROM response_fields""", "response_fields")
def skill_reject(spark, d):
    return _fields(spark, d).select(
        "job_id",
        SK.is_rejected(SK.normalize_name(F.col("name"))).alias("is_rejected"),
        SK.is_rejected(F.col("w1")).alias("is_word_rejected"),
    )


@query(f"""SELECT l_orderkey, l_linenumber,
       {sql_confidence('CAST(l_quantity / 25 AS VARCHAR)')} AS from_number,
       {sql_confidence("l_returnflag || '0.5'")} AS from_text FROM lineitem""")
def confidence(spark, d):
    return b.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        SK.confidence((F.col("l_quantity") / 25).cast("string")).alias("from_number"),
        SK.confidence(F.concat("l_returnflag", F.lit("0.5"))).alias("from_text"),
    )


@query(f"""SELECT doc_id, substr(coalesce({sql_collapse('text')}, ''), 1,
       {V.MAX_DESCRIPTION_CHARACTERS}) AS description FROM documents""")
def truncate_desc(spark, d):
    return b.texts(spark, d, "documents", "doc_id", "text").select(
        "doc_id", T.truncate(F.col("text"), V.MAX_DESCRIPTION_CHARACTERS).alias("description")
    )


SAFE = f"""(coalesce({sql_collapse('{m}')}, '') <> '' AND (
  lower(coalesce({sql_collapse('{m}')}, '')) = lower(coalesce({sql_collapse('{s}')}, ''))
  OR (length({sql_collapse('{m}')}) <= {V.MAX_ALIAS_LENGTH}
      AND len(string_split({sql_collapse('{m}')}, ' ')) <= {V.MAX_ALIAS_WORDS}
      AND NOT ({{x}}))))"""


def sql_safe(mention: str, name: str) -> str:
    markers = " OR ".join(
        f"contains(lower(coalesce({sql_collapse(mention)}, '')), {quote(m)})"
        for m in V.BROAD_ALIAS_MARKERS
    )
    return SAFE.replace("{m}", mention).replace("{s}", name).replace("{x}", markers)


@query(f"SELECT job_id, {sql_safe('w2', 'name')} AS is_safe, "
       f"{sql_safe('name', 'name')} AS own_name FROM response_fields", "response_fields")
def safe_alias(spark, d):
    return _fields(spark, d).select(
        "job_id",
        SK.is_safe_alias(F.col("w2"), F.col("name")).alias("is_safe"),
        SK.is_safe_alias(F.col("name"), F.col("name")).alias("own_name"),
    )


b.VIEWS["rule_items"] = """
SELECT DISTINCT item FROM (
  SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS item FROM documents
  UNION ALL SELECT unnest(regexp_extract_all(text, '[^.\\n]+')) FROM documents
  UNION ALL SELECT p_name FROM part UNION ALL SELECT p_type FROM part) WHERE item IS NOT NULL"""


def rule_items(spark, d):
    """Every word and sentence of the texts and every part name and type, each once."""
    return repeated_rule_items(spark, d).filter("item is not null").distinct()


def repeated_rule_items(spark, d):
    """The same, as often as they occur; of a text each once."""
    text, part = b.texts(spark, d, "documents", "text"), b.table(spark, d, "part")
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    sentences = F.regexp_extract_all("text", F.lit(r"[^.\n]+"), F.lit(0))
    items = text.select(F.explode(F.array_distinct(F.concat(words, sentences))).alias("item"))
    for column in ("p_name", "p_type"):
        items = items.unionAll(part.select(F.col(column).alias("item")))
    return items


@query(f"""SELECT item, lower(coalesce({sql_collapse('item')}, '')) AS skill_key,
       {sql_name('item')} AS skill_name, {sql_category(sql_name('item'), 'item')} AS skill_category,
       {sql_rejected(sql_name('item'))} AS is_rejected, {sql_safe('item', "'database'")} AS is_safe
FROM rule_items""", "rule_items")
def skill_rules_all(spark, d):
    """The scalar rules on all items, where the queries above see one or two per document."""
    item, name = F.col("item"), SK.normalize_name(F.col("item"))
    return rule_items(spark, d).select(
        "item", T.lookup_key(item).alias("skill_key"), name.alias("skill_name"),
        SK.normalize_category(name, item).alias("skill_category"),
        SK.is_rejected(name).alias("is_rejected"),
        SK.is_safe_alias(item, F.lit("database")).alias("is_safe"),
    )


# --- responses -----------------------------------------------------------------------


@query("""SELECT r.job_id, r.failure, i.position, i.skill_name, i.skill_category,
       i.raw_mention, i.confidence_score
FROM judged_responses r LEFT JOIN items i ON r.job_id = i.job_id""", "judged_responses", "items")
def response_parse(spark, d):
    parsed = K.parse_responses(responses(spark, d))
    items = K.response_items(parsed)
    return parsed.select("job_id", "failure").join(items, "job_id", "left")


@query("SELECT * FROM candidates", "candidates")
def skill_dedup(spark, d):
    return _candidates(spark, d)


@query("""SELECT (SELECT count(*) FROM judged_responses WHERE failure IS NULL) AS jobs_processed,
       (SELECT count(*) FROM candidates) AS links_saved,
       (SELECT count(*) FROM judged_responses WHERE failure IS NOT NULL) AS failed_jobs""",
       "judged_responses", "candidates")
def skill_report(spark, d):
    parsed = K.parse_responses(responses(spark, d))
    return K.extraction_report(parsed, K.deduplicate(K.response_items(parsed)))


# --- vocabulary, aliases, links ----------------------------------------------------------


def _vocabulary(spark, d):
    """Stored skills: one per part name, some without a category."""
    stamp = F.lit("2026-01-01").cast("timestamp")
    grouped = b.table(spark, d, "part").groupBy("p_name").agg(
        F.min("p_partkey").alias("skill_id"), F.min("p_brand").alias("_brand")
    )
    return grouped.select(
        "skill_id",
        F.col("p_name").alias("skill_name"),
        F.when(F.col("_brand") == "Brand#1", F.lit(None)).when(
            F.col("_brand") == "Brand#10", F.lit("")
        ).otherwise(F.lit("Cloud")).alias("skill_category"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


b.VIEWS["vocabulary"] = """
SELECT min(p_partkey) AS skill_id, p_name AS skill_name,
       CASE min(p_brand) WHEN 'Brand#1' THEN NULL WHEN 'Brand#10' THEN '' ELSE 'Cloud' END
           AS skill_category
FROM part GROUP BY p_name"""
b.VIEWS["new_vocabulary"] = """
SELECT vocabulary_key, v.skill_id AS known_id, c.skill_name, c.skill_category, c.job_id,
       c.position, CASE WHEN v.skill_id IS NULL THEN
         (SELECT max(skill_id) FROM {vocabulary}) + row_number() OVER (
           PARTITION BY v.skill_id IS NULL ORDER BY c.job_id, c.position) END AS new_id
FROM (SELECT *, lower(trim(skill_name)) AS vocabulary_key, row_number() OVER (
        PARTITION BY lower(trim(skill_name)) ORDER BY job_id, position) AS nth
      FROM {candidates}) c
LEFT JOIN {vocabulary} v ON lower(trim(v.skill_name)) = c.vocabulary_key WHERE nth = 1"""
b.VIEWS["all_skills"] = """
SELECT CAST(v.skill_id AS BIGINT) AS skill_id, v.skill_name,
       CASE WHEN n.known_id IS NULL THEN v.skill_category
            ELSE coalesce(nullif(v.skill_category, ''), n.skill_category) END AS skill_category
FROM {vocabulary} v LEFT JOIN {new_vocabulary} n ON n.known_id = v.skill_id
UNION ALL SELECT CAST(new_id AS BIGINT), skill_name, skill_category FROM {new_vocabulary}
WHERE known_id IS NULL"""
b.VIEWS["linked"] = """
SELECT c.*, s.skill_id FROM {candidates} c
JOIN {all_skills} s ON lower(trim(s.skill_name)) = lower(trim(c.skill_name))"""


@query("SELECT * FROM all_skills", "all_skills")
def upsert_skills(spark, d):
    merged = K.upsert_skills(_vocabulary(spark, d), stage(_candidates(spark, d), "skills"))
    return merged.select("skill_id", "skill_name", "skill_category")


def _linked(spark, d):
    candidates = stage(_candidates(spark, d), "skills")
    return K.with_skill_ids(candidates, K.upsert_skills(_vocabulary(spark, d), candidates))


def _stored_aliases(spark, d):
    """Stored aliases: the names of the red parts."""
    part = b.table(spark, d, "part").filter(F.col("p_name").startswith("red"))
    return part.groupBy(F.col("p_name").alias("alias_name")).agg(
        F.min("p_partkey").alias("skill_id")
    ).select(F.col("skill_id").alias("skill_alias_id"), "skill_id", "alias_name",
             F.lit("2026-01-01").cast("timestamp").alias("created_at"))


b.VIEWS["stored_aliases"] = """
SELECT min(p_partkey) AS skill_alias_id, min(p_partkey) AS skill_id, p_name AS alias_name
FROM part WHERE p_name LIKE 'red%' GROUP BY p_name"""
b.VIEWS["alias_rows"] = f"""
SELECT lower({sql_collapse('alias')}) AS alias_name, skill_id, job_id, position, kind
FROM (SELECT skill_id, job_id, position, skill_name, raw_mention AS alias, 0 AS kind FROM {{linked}}
      UNION ALL
      SELECT skill_id, job_id, position, skill_name, skill_name, 1 FROM {{linked}})
WHERE {sql_safe('alias', 'skill_name')}"""


@query("""SELECT skill_alias_id, skill_id, alias_name FROM stored_aliases
UNION ALL
SELECT CAST((SELECT max(skill_alias_id) FROM stored_aliases)
         + row_number() OVER (ORDER BY job_id, position, kind) AS BIGINT), skill_id, alias_name
FROM (SELECT *, row_number() OVER (PARTITION BY alias_name ORDER BY job_id, position, kind) AS nth
      FROM alias_rows) a
WHERE nth = 1 AND alias_name NOT IN (SELECT alias_name FROM stored_aliases)""",
       "alias_rows", "stored_aliases")
def insert_aliases(spark, d):
    merged = K.insert_aliases(_stored_aliases(spark, d), _linked(spark, d))
    return merged.select("skill_alias_id", "skill_id", "alias_name")


def _stored_links(spark, d):
    stored = b.links(spark, d)
    return stored.select(
        "job_id", "skill_id", "extraction_method", F.lit("stored").alias("raw_mention"),
        "confidence_score", F.lit("2026-01-01").cast("timestamp").alias("created_at"),
    )


@query("""SELECT coalesce(n.job_id, l.job_id) AS job_id,
       coalesce(n.skill_id, l.skill_id) AS skill_id,
       CASE WHEN n.job_id IS NULL THEN l.extraction_method ELSE 'ai' END AS extraction_method,
       CASE WHEN n.job_id IS NULL THEN 'stored' ELSE n.raw_mention END AS raw_mention,
       CAST(CASE WHEN n.job_id IS NULL THEN l.confidence_score
            ELSE CAST(n.confidence_score AS DECIMAL(5,4)) END AS DOUBLE) AS confidence_score
FROM links l FULL JOIN linked n ON l.job_id = n.job_id AND l.skill_id = n.skill_id""",
       "links", "linked")
def upsert_links(spark, d):
    merged = K.upsert_links(_stored_links(spark, d), _linked(spark, d), "ai")
    return merged.select(
        "job_id", "skill_id", "extraction_method", "raw_mention",
        F.col("confidence_score").cast("double").alias("confidence_score"),
    )


# --- dictionary ------------------------------------------------------------------------------

# Words and word pairs of the test texts stand in for skill names.
DICTIONARY = {
    "the": 1, "in the": 2, "of the": 2, "de la": 3, "le": 4, "des": 4, "und": 5, "der": 5,
    "that and on": 6, "is": 7, "on the it": 8, "license": 9, "ción": 10, "data": 11,
}
TOKEN = r"[\p{L}\p{N}_]+(?:[.\-/][\p{L}\p{N}_]+)*[+#]*"


def _aliases(spark):
    return spark.createDataFrame(list(DICTIONARY.items()), "alias_name string, skill_id bigint")


def _texts(spark, d):
    return b.texts(spark, d, "documents", "doc_id", "text").select(
        F.col("doc_id").alias("job_id"), "text"
    )


_values = ", ".join(f"({quote(k)}, {v})" for k, v in DICTIONARY.items())
DICTIONARY_SQL = f"""SELECT job_id, CAST(skill_id AS BIGINT) AS skill_id,
       min(alias_name) AS raw_mention
FROM (SELECT doc_id AS job_id,
             ' ' || array_to_string(regexp_extract_all(lower(text), {quote(TOKEN)}), ' ') || ' '
                 AS words FROM documents)
JOIN (VALUES {_values}) a(alias_name, skill_id) ON contains(words, ' ' || alias_name || ' ')
GROUP BY 1, 2"""


@query(DICTIONARY_SQL)
def skills_rule_based(spark, d):
    return K.extract_by_dictionary(_texts(spark, d), _aliases(spark))


@query(DICTIONARY_SQL)
def skills_rule_based_join(spark, d):
    """The same extraction by the join that large dictionaries take."""
    return K.extract_by_dictionary(_texts(spark, d), _aliases(spark), max_inline=3)
