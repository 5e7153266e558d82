"""URLs, stored pages, crawl novelty, search configuration and URL lists over pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions import urls as U
from hirelens.functions.payload import page_fingerprint as fingerprint
from hirelens.operators import pages as P
from hirelens.session import scratch_path
from hirelens.sources import search_config as C
from hirelens.sources import url_lists as L

from checks import bridge as b
from checks.bridge import quote, sql, sql_collapse

QUERIES, SQL = {}, {}


def query(statement: str | None, *views: str):
    def register(function):
        name = function.__name__
        QUERIES[name] = function
        if statement is not None:
            SQL[name] = sql(statement, *views)
        return function

    return register


def _pages(spark, d):
    return b.texts(spark, d, "pages", "page_id", "url", "html")


# --- URLs: page URLs rewritten as job URLs; https ones direct, http ones with a slug ----

DIRECT = "https://www.linkedin.com/jobs/view/"


def _job_urls(spark, d):
    to_direct = F.regexp_replace("url", "^https://[^/]+/[a-z]+/", DIRECT)
    url = F.regexp_replace(to_direct, "^http://[^/]+/[a-z]+/", DIRECT + "analyst-at-acme-")
    search = F.replace(F.col("url"), F.lit("page="), F.lit("currentJobId="))
    return _pages(spark, d).select("page_id", "url", url.alias("job_url"),
                                   search.alias("search_url"))


b.VIEWS["job_urls"] = f"""
SELECT page_id, url, replace(url, 'page=', 'currentJobId=') AS search_url,
       regexp_replace(regexp_replace(url, '^https://[^/]+/[a-z]+/', '{DIRECT}'),
                      '^http://[^/]+/[a-z]+/', '{DIRECT}analyst-at-acme-') AS job_url
FROM pages"""


@query(r"""SELECT page_id, job_url, coalesce(
         nullif(regexp_extract(job_url, '/jobs/view/(\d+)', 1), ''),
         nullif(regexp_extract(job_url, '/jobs/view/[^/?#]*?-(\d+)(?:[/?#]|$)', 1), '')) AS job_id
FROM job_urls""", "job_urls")
def url_job_id(spark, d):
    return _job_urls(spark, d).select("page_id", "job_url",
                                      U.job_id(F.col("job_url")).alias("job_id"))


@query(f"""SELECT page_id, CASE WHEN contains(search_url, 'currentJobId=')
       THEN '{DIRECT}' || regexp_extract(search_url, 'currentJobId=([^&#]*)', 1) || '/'
       ELSE search_url END AS direct_url FROM job_urls""", "job_urls")
def url_direct(spark, d):
    return _job_urls(spark, d).select(
        "page_id", U.direct_url(F.col("search_url")).alias("direct_url")
    )


IGNORED = ["page", "utm_source"]


@query("""SELECT page_id, 'https://search.example/more?' || array_to_string(list_concat(
         list_filter(string_split(regexp_extract(full_url, '\\?([^#]*)', 1), '&'),
                     lambda p: p <> '' AND split_part(p, '=', 1) NOT IN ('page', 'utm_source')),
         ['start=' || page_id * 25]), '&') AS result_url
FROM (SELECT page_id, split_part(url, '#', 1) || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END
        || 'keywords=machine+learning&f_E=2' AS full_url FROM pages)""")
def url_strip_params(spark, d):
    base = F.substring_index("url", "#", 1)
    full = F.concat(
        base,
        F.when(F.col("url").contains("?"), "&").otherwise("?"),
        F.lit("keywords=machine%20learning&f_E=2"),
    )
    return _pages(spark, d).select(
        "page_id",
        U.offset_url(full, F.col("page_id") * 25, "https://search.example/more", IGNORED).alias(
            "result_url"
        ),
    )


# --- page filters and fingerprints ------------------------------------------------------

MARKERS = ["cheap", "spam", "lottery", "casino"]


@query(f"""SELECT page_id, length(html) AS html_size, contains(lower(html), 'tion the') AS has_phrase,
       {' OR '.join(f"contains(lower(html), '{m}')" for m in MARKERS)} AS is_restricted
FROM pages""")
def page_filters(spark, d):
    status = P.with_page_status(_pages(spark, d), F.lit("Tion The"), MARKERS)
    return status.select("page_id", F.col("html_size").cast("bigint"), "has_phrase",
                         "is_restricted")


@query("SELECT page_id, substr(sha256(html), 1, 12) AS fingerprint FROM pages")
def page_fingerprint(spark, d):
    return _pages(spark, d).select("page_id", fingerprint(F.col("html")).alias("fingerprint"))


# --- links ---------------------------------------------------------------------------------

ROOT = "https://pages.example"
ID_PATTERN = r"^https://pages\.example/([^/?#]+)$"


def _links(spark, d, *keys):
    return P.page_links(
        _pages(spark, d),
        ["page_id", "url", *keys],
        to_url=lambda i: F.concat(F.lit(ROOT + "/"), i),
        link_path="/",
        root=ROOT,
        identify=lambda url: U.extract(url, ID_PATTERN),
    )


b.VIEWS["hrefs"] = """
SELECT page_id, url, unnest(tags) AS href, generate_subscripts(tags, 1) AS nth
FROM (SELECT page_id, url, regexp_extract_all(
        regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script>', '', 'g'),
        '<a href="([^"]*)"', 1) AS tags FROM pages)"""
b.VIEWS["page_ids"] = """
SELECT page_id, url, job_id, min(nth) AS nth
FROM (SELECT page_id, url, nth, nullif(regexp_extract(replace(href, '&amp;', '&'),
        '^/([^/?#]+)$', 1), '') AS job_id FROM {hrefs})
WHERE job_id IS NOT NULL GROUP BY 1, 2, 3"""
b.VIEWS["ranked_links"] = """
SELECT page_id, url, job_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY nth) - 1
         AS INTEGER) AS position FROM {page_ids}"""


@query(f"""SELECT page_id, position, job_id, '{ROOT}/' || job_id AS job_url FROM ranked_links""",
       "ranked_links")
def page_links(spark, d):
    return _links(spark, d).select("page_id", "position", "job_id", "job_url")


# --- crawl novelty: a host and a thousand of path numbers is a search of at most 1000 pages ---

HOST = "^https?://([^/]+)"
NUMBER = r"^https?://[^/]+/[a-z]+/(\d+)"
MAX_PAGES, MAX_URLS, MAX_NO_NEW = 1000, 40, 2


def _search(df):
    numbered = df.withColumn(
        "_number", F.coalesce(F.regexp_extract("url", NUMBER, 1).try_cast("bigint"), F.lit(0))
    )
    block = F.expr("_number div 1000").cast("string")
    return numbered.withColumns(
        {
            "search": F.concat(F.regexp_extract("url", HOST, 1), F.lit("/"), block),
            "page": (F.col("_number") % 1000).cast("int"),
        }
    )


def _search_links(spark, d):
    return _search(_links(spark, d)).select(
        "search", "page", "position", F.col("job_url").alias("url")
    )


_NUMBER_SQL = f"coalesce(TRY_CAST(regexp_extract(url, '{NUMBER}', 1) AS BIGINT), 0)"
_SEARCH_SQL = f"regexp_extract(url, '{HOST}', 1) || '/' || ({_NUMBER_SQL} // 1000)"
_PAGE_SQL = f"CAST({_NUMBER_SQL} % 1000 AS INTEGER)"
b.VIEWS["search_pages"] = f"""
SELECT DISTINCT {_SEARCH_SQL} AS search, {_PAGE_SQL} AS page FROM pages"""
b.VIEWS["search_links"] = f"""
SELECT {_SEARCH_SQL} AS search, {_PAGE_SQL} AS page, position,
       '{ROOT}/' || job_id AS url FROM {{ranked_links}}"""
b.VIEWS["novelty"] = f"""
SELECT p.search, p.page, count(f.url) - count(f.url) FILTER (f.first_page = p.page) AS known_urls,
       count(f.url) FILTER (f.first_page = p.page) AS new_urls
FROM {{search_pages}} p LEFT JOIN (
  SELECT DISTINCT search, page, url, min(page) OVER (PARTITION BY search, url) AS first_page
  FROM {{search_links}}) f ON p.search = f.search AND p.page = f.page
WHERE p.page < {MAX_PAGES} GROUP BY 1, 2"""
b.VIEWS["novelty_runs"] = """
SELECT *, CAST(sum(CASE WHEN new_urls = 0 THEN 1 ELSE 0 END) OVER (
         PARTITION BY search, block ORDER BY page) AS BIGINT) AS no_new_run
FROM (SELECT *, sum(CASE WHEN new_urls > 0 THEN 1 ELSE 0 END) OVER (
        PARTITION BY search ORDER BY page) AS block FROM {novelty})"""


@query(f"""SELECT n.search, n.page, n.known_urls, n.new_urls, n.no_new_run,
       NOT EXISTS (SELECT 1 FROM novelty_runs e WHERE e.search = n.search AND e.page < n.page
                   AND e.no_new_run >= {MAX_NO_NEW})
       AND coalesce((SELECT sum(new_urls) FROM novelty_runs e
                     WHERE e.search = n.search AND e.page < n.page), 0) < {MAX_URLS} AS is_visited
FROM novelty_runs n""", "novelty_runs")
def page_novelty(spark, d):
    pages = _search(_pages(spark, d)).select("search", "page")
    return P.page_novelty(pages, _search_links(spark, d), MAX_PAGES, MAX_URLS, MAX_NO_NEW)


@query(f"""SELECT search, url, CAST(nth AS INTEGER) AS discovery_rank FROM (
  SELECT search, url, row_number() OVER (PARTITION BY search ORDER BY page, position, url) AS nth
  FROM (SELECT search, url, min(page) AS page, arg_min(position, page * 100000 + position)
          AS position FROM search_links GROUP BY 1, 2)) WHERE nth <= {MAX_URLS}""",
       "search_links")
def discovered_urls(spark, d):
    return P.first_urls(_search_links(spark, d), MAX_URLS)


@query("""SELECT 'search' AS scope, search, count(*) AS url_references,
       CAST(NULL AS BIGINT) AS unique_urls, CAST(NULL AS BIGINT) AS duplicates_removed
FROM (SELECT DISTINCT search, url FROM search_links) GROUP BY search
UNION ALL SELECT 'total', NULL, count(*), count(DISTINCT url), count(*) - count(DISTINCT url)
FROM (SELECT DISTINCT search, url FROM search_links)""", "search_links")
def search_summary(spark, d):
    return P.search_summary(_search_links(spark, d).select("search", "url").distinct())


# --- payloads --------------------------------------------------------------------------------

SELECTORS = {
    "title": ("text", "h1", [], {}, None),
    "location": ("text", "title", [], {}, None),
    "description": ("markup", "article", [], {}, None),
    "company": ("text", "div", ["ad"], {}, None),
    "title_id": ("attribute", "html", [], {}, "lang"),
    "company_id": ("attribute", "meta", [], {}, "charset"),
}


def sql_markup_text(markup: str) -> str:
    """Tags to blanks, then entities, then whitespace. HTML also reads &amp without ;."""
    plain = f"regexp_replace({markup}, '<[^>]*>', ' ', 'g')"
    for entity, text in {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&copy;": "©",
                         "&middot;": "·", "&nbsp;": " "}.items():
        plain = f"replace({plain}, '{entity}', '{text}')"
    plain = f"regexp_replace({plain}, '&amp;?', '&', 'g')"  # HTML reads &amp without ; too
    return f"nullif({sql_collapse(plain)}, '')"


b.VIEWS["payloads"] = f"""
SELECT page_id, url, html,
       {sql_markup_text("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} AS title,
       {sql_markup_text("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS location,
       {sql_markup_text('''regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1)''')}
           AS company,
       nullif(regexp_extract(html, '(?s)<article>.*?</article>', 0), '') AS description_html,
       {sql_markup_text("regexp_extract(html, '(?s)<article>.*?</article>', 0)")}
           AS description_text,
       nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS title_id,
       nullif(regexp_extract(html, '<meta charset="([^"]*)"', 1), '') AS company_id,
       length(html) AS html_size
FROM pages"""
PAYLOAD = ["page_id", "title", "location", "company", "description_html", "description_text",
           "title_id", "company_id", "html_size"]


@query("SELECT " + ", ".join(PAYLOAD) + " FROM payloads", "payloads")
def page_payload(spark, d):
    payloads = P.page_payloads(_pages(spark, d), ["page_id"], SELECTORS)
    return payloads.withColumn("html_size", F.col("html_size").cast("bigint")).select(*PAYLOAD)


@query(f"""SELECT '{V.PAGE_SOURCE_NAME}' AS source_name,
       CASE WHEN contains(url, 'currentJobId=') THEN '{DIRECT}'
         || regexp_extract(url, 'currentJobId=([^&#]*)', 1) || '/' ELSE url END AS source_url,
       title AS payload_title, html_size AS payload_size FROM (
  SELECT replace(url, 'page=', 'currentJobId=') AS url, title, html_size FROM payloads)""",
       "payloads")
def page_records(spark, d):
    pages = _pages(spark, d).withColumn(
        "url", F.replace(F.col("url"), F.lit("page="), F.lit("currentJobId="))
    )
    records = P.page_records(P.page_payloads(pages, ["page_id", "url"], SELECTORS))
    body = F.parse_json("raw_payload")
    return records.select(
        "source_name",
        "source_url",
        F.variant_get(body, "$.title", "string").alias("payload_title"),
        F.variant_get(body, "$.html_size", "bigint").alias("payload_size"),
    )


# --- URL lists ---------------------------------------------------------------------------------


def _write_url_list(spark, d, name):
    """A list file with comments, blank lines and stray blanks around the URLs."""
    path = scratch_path(spark, name)
    lines = _pages(spark, d).select(
        F.explode(
            F.array(
                F.concat(F.lit("# page "), "page_id"),
                F.concat(F.lit("  "), "url", F.lit("\t")),
                F.lit("   "),
            )
        ).alias("line")
    )
    L.write_urls(lines, path, "line")
    return path


@query("SELECT url FROM pages")
def src_url_list(spark, d):
    return L.read_urls(spark, _write_url_list(spark, d, "src_url_list"))


@query("""SELECT unnest(['# page ' || page_id, '  ' || url || chr(9), '   ']) AS line
FROM pages""")
def sink_text(spark, d):
    return spark.read.text(_write_url_list(spark, d, "sink_text")).select(
        F.col("value").alias("line")
    )


def _split_urls(spark, d):
    """Link URLs of English pages, and of all other pages."""
    rows = _links(spark, d).withColumn("is_english", F.col("url").contains("/en/"))
    urls = rows.select("is_english", F.col("job_url").alias("url"))
    return (urls.filter("is_english").select("url"),
            urls.filter("NOT is_english").select("url"))


b.VIEWS["split_urls"] = f"""
SELECT contains(url, '/en/') AS is_english, '{ROOT}/' || job_id AS url FROM {{ranked_links}}"""


@query("SELECT DISTINCT url FROM split_urls", "split_urls")
def union_urls(spark, d):
    return L.combine_urls(*_split_urls(spark, d))


@query("""SELECT DISTINCT url FROM split_urls WHERE NOT is_english
AND url IN (SELECT url FROM split_urls WHERE is_english)""", "split_urls")
def known_urls(spark, d):
    english, others = _split_urls(spark, d)
    return L.known_urls(others, english)


@query("""SELECT url FROM split_urls WHERE NOT is_english
AND url NOT IN (SELECT url FROM split_urls WHERE is_english)""", "split_urls")
def new_urls(spark, d):
    english, others = _split_urls(spark, d)
    return L.new_urls(others, english)


# --- search configuration: one file row per customer, two searches each ------------------------


@query("""SELECT CAST(i AS INTEGER) AS search_index,
       CASE i WHEN 0 THEN c_mktsegment ELSE c_name END AS search_name,
       CASE i WHEN 0 THEN lower(c_mktsegment) ELSE 'jobs at ' || c_name END AS keywords,
       n_name AS location, 20 AS offset_step, 30 AS max_pages, 2 AS max_consecutive_no_new,
       CASE WHEN i = 0 THEN 200 ELSE CAST(c_nationkey AS INTEGER) END AS max_urls,
       'https://www.linkedin.com/jobs/search/?keywords=' || replace(replace(
          CASE i WHEN 0 THEN lower(c_mktsegment) ELSE 'jobs at ' || c_name END, '#', '%23'),
          ' ', '+') || '&location=' || replace(n_name, ' ', '+') AS search_url
FROM customer JOIN nation ON c_nationkey = n_nationkey, (VALUES (0), (1)) v(i)""")
def src_search_config(spark, d):
    nation = b.table(spark, d, "nation")
    customer = b.table(spark, d, "customer")
    configs = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("location"),
        F.lit(200).alias("max_urls_per_search"),
        F.lit(20).alias("offset_step"),
        F.lit(30).alias("max_pages"),
        F.lit(3).alias("delay_seconds"),
        F.lit("data/batches").alias("output_dir"),
        F.array(
            F.struct(
                F.col("c_mktsegment").alias("name"),
                F.lower("c_mktsegment").alias("keywords"),
                F.lit(None).cast("int").alias("max_urls"),
            ),
            F.struct(
                F.col("c_name").alias("name"),
                F.concat(F.lit("jobs at "), "c_name").alias("keywords"),
                F.col("c_nationkey").cast("int").alias("max_urls"),
            ),
        ).alias("searches"),
    )
    path = scratch_path(spark, "search_config")
    configs.write.json(path)
    return C.searches(C.read_search_config(spark, path, multiline=False)).drop(
        "max_urls_per_search"
    )
