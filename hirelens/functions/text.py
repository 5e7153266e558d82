"""Whitespace, case and whole-phrase matching.

Java's ``\\s`` and ``\\b`` are ASCII only, so the classes are spelled out: all
Unicode spaces and separators, and word characters as letters, numbers and
underscore.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.literals import literal_list
from hirelens.functions.phrases import WORD_CLASS, PhraseIndex

SPACE_CLASS = r"[\s\p{Z}\x0B\x1C-\x1F\x85]"


def collapse(value: Column) -> Column:
    """Runs of whitespace to one blank, none at the ends; NULL stays NULL."""
    return F.trim(F.regexp_replace(value, SPACE_CLASS + "+", " "))


def clean_text(value: Column) -> Column:
    return F.nullif(collapse(value.cast("string")), F.lit(""))


def blank_if_null(value: Column) -> Column:
    """Collapsed text, NULL as ''."""
    return F.coalesce(collapse(value), F.lit(""))


def match_text(value: Column) -> Column:
    """Collapsed lower-case text for phrase matching, NULL as ''."""
    return F.coalesce(collapse(F.lower(value)), F.lit(""))


def lookup_key(value: Column) -> Column:
    return F.lower(blank_if_null(value))


def strip_space(value: Column) -> Column:
    """Drop whitespace at both ends only."""
    return F.regexp_replace(value, f"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")


def truncate(value: Column, limit: int) -> Column:
    return F.substring(blank_if_null(value), 1, limit)


def _literal(phrase: str) -> str:
    return re.escape(phrase.lower()).replace(r"\ ", " ")


def contains_phrase(text: Column, phrase: str) -> Column:
    """Whole-phrase match; the plain substring test keeps most rows off the regex."""
    pattern = f"(?<!{WORD_CLASS}){_literal(phrase)}(?!{WORD_CLASS})"
    return text.contains(phrase.lower()) & text.rlike(pattern)


def contains_any(text: Column, parts: Sequence[str]) -> Column:
    """Plain substring test for any of the parts."""
    return F.exists(literal_list(parts), lambda part: F.contains(text, part))


def first_phrase(text: Column, phrases: Sequence[str]) -> Column:
    """The first phrase in *list* order found as a whole phrase, else NULL."""
    index = PhraseIndex({"": phrases})
    return index.first(index.found(text), "")


def contains_ignoring_case(text: Column, phrase: Column) -> Column:
    """Substring test without case; an empty or missing phrase is never found."""
    found = F.lower(text).contains(F.lower(phrase))
    return F.coalesce((phrase != "") & found, F.lit(False))
