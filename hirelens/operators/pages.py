"""Stored pages: filters, links, payloads, raw records and crawl novelty."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from html.entities import name2codepoint

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens import schemas
from hirelens.functions import page_reader
from hirelens.functions.literals import literal_map
from hirelens.functions.payload import page_fingerprint
from hirelens.functions.text import contains_any, contains_ignoring_case
from hirelens.functions.urls import absolute_url, direct_url, job_id, job_url


def is_restricted(html: Column, markers: Sequence[str] = tuple(V.RESTRICTION_MARKERS)) -> Column:
    """A login or access-restriction page."""
    return contains_any(F.lower(html), [m.lower() for m in markers])


def with_page_status(
    pages: DataFrame, phrase: Column, markers: Sequence[str] = tuple(V.RESTRICTION_MARKERS)
) -> DataFrame:
    """Add the page's size, fingerprint, phrase test and restriction test."""
    html = F.col("html")
    return pages.withColumns(
        {
            "html_size": F.length(html),
            "fingerprint": page_fingerprint(html),
            "has_phrase": contains_ignoring_case(html, phrase),
            "is_restricted": is_restricted(html, markers),
        }
    )


# --- links -------------------------------------------------------------------


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute inside a start tag, entities decoded."""
    pattern = (
        rf"(?is)[\s\"']{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
    )
    value = F.concat(*[F.regexp_extract(tag, pattern, n) for n in (1, 2, 3)])
    return F.nullif(decode_entities(value), F.lit(""))


def _after(text: Column, place) -> Column:
    """The text from a place (from 1) to its end."""
    return F.substring(text, place, F.length(text))


ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def decode_entities(value: Column) -> Column:
    """Named and numeric entities that end with a semicolon, each once; others, and numbers of
    no character, stay as they are. The text is cut at its ampersands."""
    characters = literal_map({name: chr(n) for name, n in name2codepoint.items()} | {"apos": "'"})

    def named(part: Column) -> Column:
        return F.struct(part.alias("part"), F.regexp_extract(part, ENTITY, 1).alias("name"))

    def numbered(at: Column) -> Column:
        name = at["name"]
        number = F.when(F.lower(name).startswith("#x"), F.conv(_after(name, 3), 16, 10)).when(
            name.startswith("#"), _after(name, 2))
        return F.struct(at["part"].alias("part"), name.alias("name"),
                        number.cast("bigint").alias("number"))

    def shown(at: Column) -> Column:
        number = at["number"]
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        code = F.unhex(F.lpad(F.hex(number), 8, "0"))
        character = F.when(valid, F.decode(code, "UTF-32")).when(
            number.isNull(), F.try_element_at(characters, at["name"]))
        rest = _after(at["part"], F.length(at["name"]) + 2)
        return F.coalesce(F.concat(character, rest), F.concat(F.lit("&"), at["part"]))

    # step by step, so that no step is written out, and done, more than once
    parts = F.slice(F.split(value, "&"), F.lit(2), F.length(value) + 1)
    decoded = F.transform(F.transform(F.transform(parts, named), numbered), shown)
    whole = F.concat(F.substring_index(value, "&", 1), F.array_join(decoded, ""))
    return F.when(value.contains("&"), whole).otherwise(value)


def anchors(html: Column) -> Column:
    """Start tags of the page's links in order, comments and scripts left out."""
    visible = F.regexp_replace(html, r"(?is)<!--.*?-->|<script\b.*?</script>", "")
    return F.regexp_extract_all(visible, F.lit(r"""(?is)<a\s(?:[^>"']|"[^"]*"|'[^']*')*+>"""), F.lit(0))


def page_job_ids(
    pages: DataFrame,
    card_class: str = V.CARD_LINK_CLASS,
    link_path: str = V.CARD_LINK_PATH,
    root: str = V.SITE_ROOT,
    identify=job_id,
) -> DataFrame:
    """Add the distinct job ids a page links to, in first-seen order.

    Card links count; a page without any falls back to links whose target
    contains the path. Everything happens inside the page's own row.
    """
    tagged = pages.withColumn("_tags", anchors(F.col("html")))

    def has_class(tag: Column) -> Column:
        return F.array_contains(F.split(_attribute(tag, "class"), r"\s+"), card_class)

    cards = F.filter("_tags", lambda t: F.coalesce(has_class(t), F.lit(False)))
    chosen = tagged.withColumn("_cards", cards).withColumn(
        "_links",
        F.when(F.size("_cards") > 0, F.col("_cards")).otherwise(
            F.filter(
                "_tags",
                lambda t: F.coalesce(_attribute(t, "href").contains(link_path), F.lit(False)),
            )
        ),
    )
    ids = F.transform(
        "_links", lambda t: identify(absolute_url(_attribute(t, "href"), root))
    )
    distinct_ids = F.array_distinct(F.array_compact(ids))
    return chosen.withColumn("job_ids", distinct_ids).drop("_tags", "_cards", "_links")


def page_links(pages: DataFrame, keys: Sequence[str], to_url=job_url, **options) -> DataFrame:
    """One row per page and linked job: position, job id and the job's own URL."""
    linked = page_job_ids(pages.select(*keys, "html"), **options)
    return linked.select(*keys, F.posexplode("job_ids").alias("position", "job_id")).withColumn(
        "job_url", to_url(F.col("job_id"))
    )


def page_novelty(
    pages: DataFrame, links: DataFrame, max_pages: int, max_urls: int, max_no_new: int
) -> DataFrame:
    """Per search and page: URLs known from earlier pages, new ones, the run of
    pages without new ones, and whether a crawl would have reached the page.

    ``pages`` has (search, page), page numbers from 0; ``links`` adds url. The
    pages of a URL come from an aggregate; the windows run over page
    counts, at most ``max_pages`` rows per search.
    """
    grid = pages.select("search", "page").filter(F.col("page") < max_pages).distinct()
    # a URL's pages are at most `max_pages` numbers: the links are read once
    urls = links.select("search", "page", "url").filter(F.col("page") < max_pages)
    seen = urls.groupBy("search", "url").agg(F.collect_set("page").alias("_pages"))
    found = (
        seen.select("search", F.array_min("_pages").alias("_first"),
                    F.explode("_pages").alias("page"))
        .groupBy("search", "page")
        .agg(F.count("*").alias("_urls"),
             F.count_if(F.col("page") == F.col("_first")).alias("_new"))
    )
    counts = (
        grid.join(found, ["search", "page"], "left")
        .select(
            "search",
            "page",
            F.coalesce("_new", F.lit(0)).alias("new_urls"),
            (F.coalesce("_urls", F.lit(0)) - F.coalesce("_new", F.lit(0))).alias("known_urls"),
        )
    )
    ordered = Window.partitionBy("search").orderBy("page")
    block = F.sum(F.when(F.col("new_urls") > 0, 1).otherwise(0)).over(ordered)
    runs = counts.withColumn("_block", block)
    in_block = Window.partitionBy("search", "_block").orderBy("page")
    stalled = runs.withColumn(
        "no_new_run",
        F.sum(F.when(F.col("new_urls") == 0, 1).otherwise(0)).over(in_block).cast("bigint"),
    )
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    stopped = F.max(F.col("no_new_run") >= max_no_new).over(before)
    collected = F.coalesce(F.sum("new_urls").over(before), F.lit(0))
    return stalled.select(
        "search",
        "page",
        "known_urls",
        "new_urls",
        "no_new_run",
        (~F.coalesce(stopped, F.lit(False)) & (collected < max_urls)).alias("is_visited"),
    )


def first_urls(links: DataFrame, max_urls: int) -> DataFrame:
    """The first URLs of each search in discovery order, up to the configured limit."""
    seen = links.groupBy("search", "url").agg(
        F.min(F.struct("page", "position")).alias("_seen")
    )
    order = Window.partitionBy("search").orderBy("_seen.page", "_seen.position", "url")
    ranked = seen.withColumn("discovery_rank", F.row_number().over(order))
    return ranked.filter(F.col("discovery_rank") <= max_urls).select(
        "search", "url", "discovery_rank"
    )


def search_summary(urls: DataFrame) -> DataFrame:
    """URLs per search and, in the total row, references, unique jobs and duplicates."""
    per_search = urls.groupBy("search").agg(F.count("*").alias("url_references"))
    unique = urls.select("url").distinct().agg(F.count("*").alias("unique_urls"))
    total = per_search.agg(F.sum("url_references").alias("url_references")).unionByName(
        unique, allowMissingColumns=True
    )
    total = total.agg(
        F.max("url_references").alias("url_references"), F.max("unique_urls").alias("unique_urls")
    )
    return per_search.withColumn("scope", F.lit("search")).unionByName(
        total.withColumns(
            {
                "scope": F.lit("total"),
                "duplicates_removed": F.col("url_references") - F.col("unique_urls"),
            }
        ),
        allowMissingColumns=True,
    ).select("scope", "search", "url_references", "unique_urls", "duplicates_removed")


# --- payloads ----------------------------------------------------------------


def page_payloads(
    pages: DataFrame,
    keys: Sequence[str],
    selectors: Mapping[str, tuple] = V.PAGE_SELECTORS,
) -> DataFrame:
    """Payload columns of every page. Pages are parsed in Arrow batches; the
    page text itself is not passed on."""
    fields = [pages.schema[k] for k in keys] + list(schemas.PAGE_PAYLOAD.fields)
    schema = type(pages.schema)(fields)
    names = [f.name for f in schemas.PAGE_PAYLOAD.fields]
    keys = list(keys)
    criteria = (V.CRITERIA_ITEM, V.CRITERIA_KEY, V.CRITERIA_VALUE)
    read = page_reader.read_payload
    selectors = dict(selectors)
    # executors get the reader with the task and need no installed package
    cloudpickle.register_pickle_by_value(page_reader)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [read(html or "", selectors, criteria) for html in batch["html"]]
            out = batch[keys].copy()
            for name in names:
                out[name] = [row.get(name) for row in rows]
            yield out

    return pages.select(*keys, "html").mapInPandas(parse, schema)


def page_records(payloads: DataFrame, url: str = "url", scraped_at: Column | None = None):
    """Raw records: the payload as JSON under the page's own URL, else the request URL."""
    names = schemas.PAGE_PAYLOAD.names
    body = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    return payloads.select(
        F.lit(V.PAGE_SOURCE_NAME).alias("source_name"),
        F.coalesce(F.nullif(F.col("linkedin_url"), F.lit("")), direct_url(F.col(url))).alias(
            "source_url"
        ),
        F.date_format(
            F.current_timestamp() if scraped_at is None else scraped_at,
            "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx",
        ).alias("scraped_at"),
        body.alias("raw_payload"),
    )
