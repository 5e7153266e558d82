"""Country and remote-work rules over free location text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions.literals import literal_map
from hirelens.functions.text import contains_any, strip_space


def last_comma_part(location: Column) -> Column:
    """The last non-blank comma part, NULL without one."""
    parts = F.transform(F.split(location, ","), strip_space)
    return F.try_element_at(F.filter(parts, lambda p: p != ""), F.lit(-1))


def parse_country(location: Column, is_clean: bool = False) -> Column:
    """Country by ordered rules; ``is_clean`` says the text is trimmed already."""
    countries = literal_map(V.COUNTRY_NAMES)
    text = location if is_clean else strip_space(location)
    lowered = F.lower(text)
    last = last_comma_part(text)
    return (
        F.when(text.isNull() | (text == "") | lowered.isin(V.NO_COUNTRY_WORDS), None)
        .when(lowered.isin(list(V.COUNTRY_NAMES)), F.try_element_at(countries, lowered))
        .when(
            text.contains(",") & F.upper(last).isin(V.US_STATE_CODES),
            F.lit("United States"),
        )
        .when(
            text.contains(",") & F.lower(last).isin(list(V.COUNTRY_NAMES)),
            F.try_element_at(countries, F.lower(last)),
        )
        .when(contains_any(lowered, V.US_METRO_SIGNALS), F.lit("United States"))
    )


def remote_text(location: Column, description: Column) -> Column:
    """The text the remote rules look at; compute it once, in its own select."""
    kept = [F.nullif(part, F.lit("")) for part in (location, description)]
    return F.lower(F.concat_ws(" ", *kept))


def remote_type(text: Column) -> Column:
    """hybrid before remote before onsite, as plain substrings."""
    return (
        F.when(text.contains("hybrid"), "hybrid")
        .when(contains_any(text, V.REMOTE_SIGNALS), "remote")
        .when(contains_any(text, V.ONSITE_SIGNALS), "onsite")
        .otherwise("unknown")
    )
