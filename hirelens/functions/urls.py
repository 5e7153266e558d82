"""Job ids and query parameters in URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import fixed_values as V


def extract(text: Column, pattern: str) -> Column:
    """First group, NULL when the pattern is not found."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def form_encode(text: Column) -> Column:
    """Form encoding: blanks as +, ~ kept, * escaped."""
    encoded = F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~"))
    return F.replace(encoded, F.lit("*"), F.lit("%2A"))


def job_id(url: Column) -> Column:
    return F.coalesce(extract(url, V.DIRECT_ID_PATTERN), extract(url, V.SLUG_ID_PATTERN))


def job_url(identifier: Column) -> Column:
    return F.concat(F.lit(V.JOB_URL_PREFIX), identifier, F.lit("/"))


def query_string(url: Column) -> Column:
    """Text between ? and #, NULL without one."""
    return extract(url, r"^[^?#]*\?([^#]*)")


def query_pairs(url: Column) -> Column:
    """Parameters as an array of decoded name/value structs, blanks kept."""
    parts = F.filter(F.split(query_string(url), "&"), lambda p: p != "")

    def decode(text: Column) -> Column:
        return F.coalesce(F.try_url_decode(text), text)

    return F.transform(
        parts,
        lambda p: F.struct(
            decode(F.substring_index(p, "=", 1)).alias("name"),
            decode(F.regexp_replace(p, "^[^=]*=?", "")).alias("value"),
        ),
    )


def parameter(url: Column, name: str) -> Column:
    """First non-blank value of a parameter."""
    values = F.filter(query_pairs(url), lambda p: (p["name"] == name) & (p["value"] != ""))
    return F.get(values, F.lit(0))["value"]


def direct_url(url: Column, parameter_name: str = V.CURRENT_JOB_PARAMETER) -> Column:
    """Search URL pointing at one job -> that job's own URL, else unchanged."""
    return F.coalesce(job_url(parameter(url, parameter_name)), url)


def offset_url(
    url: Column,
    offset: Column,
    endpoint: Column | str = V.FRAGMENT_URL,
    ignored: Sequence[str] = tuple(V.NAVIGATION_PARAMETERS),
) -> Column:
    """Result-page URL: the search's own parameters, without navigation ones, at an offset."""
    kept = F.filter(query_pairs(url), lambda p: ~p["name"].isin(list(ignored)))
    encoded = F.transform(
        kept, lambda p: F.concat(form_encode(p["name"]), F.lit("="), form_encode(p["value"]))
    )
    start = F.array(F.concat(F.lit("start="), offset.cast("string")))
    parameters = F.concat(F.coalesce(encoded, F.array().cast("array<string>")), start)
    base = F.lit(endpoint) if isinstance(endpoint, str) else endpoint
    return F.concat(base, F.lit("?"), F.array_join(parameters, "&"))


def search_url(keywords: Column, location: Column) -> Column:
    return F.concat(
        F.lit(V.SEARCH_URL + "?keywords="), form_encode(keywords),
        F.lit("&location="), form_encode(location),
    )


def absolute_url(href: Column, root: str = V.SITE_ROOT) -> Column:
    """Resolve a link against the site root."""
    scheme = root.split("://")[0] + ":"
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(scheme), href))
        .when(href.startswith("/"), F.concat(F.lit(root), href))
        .otherwise(F.concat(F.lit(root + "/"), href))
    )
