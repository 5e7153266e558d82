"""Skill names, categories, confidences, aliases and response text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions.literals import literal_map
from hirelens.functions.text import SPACE_CLASS, blank_if_null, contains_any, lookup_key


def _lookup(entries: dict[str, str], key: Column) -> Column:
    """The entry of a key. Maps are searched entry by entry, the set of their keys is not."""
    lowered = {k.lower(): v for k, v in entries.items()}
    return F.when(key.isin(list(lowered)), F.try_element_at(literal_map(lowered), key))


def canonical_name(cleaned: Column, key: Column, overrides: dict[str, str] | None = None) -> Column:
    """Canonical name of a collapsed name and its lower-case key."""
    return F.coalesce(_lookup(V.CANONICAL_SKILLS if overrides is None else overrides, key), cleaned)


def known_category(cleaned: Column, key: Column) -> Column:
    """A collapsed category, or what its lower-case key is an alias of."""
    return F.coalesce(_lookup(V.CATEGORY_ALIASES, key), cleaned)


def skill_category(name: Column, known: Column) -> Column:
    """Fixed category of the skill, else the known one if it is allowed, else the default."""
    names = V.CATEGORY_BY_SKILL
    fixed = F.when(name.isin(list(names)), F.try_element_at(literal_map(names), name))
    allowed = F.when(known.isin(V.SKILL_CATEGORIES), known)
    return F.coalesce(fixed, allowed, F.lit(V.DEFAULT_CATEGORY))


def normalize_name(name: Column, overrides: dict[str, str] | None = None) -> Column:
    """Canonical name by case-insensitive override, else the collapsed name."""
    return canonical_name(blank_if_null(name), lookup_key(name), overrides)


def normalize_category(name: Column, category: Column) -> Column:
    """Fixed category of the skill, else the category's alias, else the default."""
    cleaned = blank_if_null(category)
    return skill_category(name, known_category(cleaned, F.lower(cleaned)))


def is_rejected(name: Column, strict: bool = False) -> Column:
    """Vague, too long or too short, for a name that is already collapsed."""
    rejected = [r.lower() if strict else r for r in V.REJECTED_SKILLS]
    return (
        F.lower(name).isin(rejected)
        | (F.length(name) > V.MAX_SKILL_LENGTH)
        | ((F.length(name) < 2) & (name != V.SINGLE_LETTER_SKILL))
    )


def confidence(text: Column) -> Column:
    """Number text within [0, 1] as a decimal, anything else NULL."""
    number = text.try_cast("double")
    return F.when((number >= 0) & (number <= 1) & ~F.isnan(number), number)


def strip_fences(text: Column) -> Column:
    """Drop a Markdown code fence around a response. A text from { to } has none, so it is
    not searched."""
    ends = f"^{SPACE_CLASS}+|{SPACE_CLASS}+$"
    bare = F.regexp_replace(text, ends, "")
    bare = F.regexp_replace(bare, f"^```json{SPACE_CLASS}*", "")
    bare = F.regexp_replace(bare, f"^```{SPACE_CLASS}*", "")
    bare = F.regexp_replace(bare, f"{SPACE_CLASS}*```$", "")
    return F.when(F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}")), text).otherwise(
        bare)


def is_safe_alias(mention: Column, skill_name: Column) -> Column:
    """A mention that names one skill: the skill itself, or a short plain phrase."""
    cleaned = blank_if_null(mention)
    lowered = F.lower(cleaned)
    short = (F.length(cleaned) <= V.MAX_ALIAS_LENGTH) & (
        F.size(F.split(cleaned, " ")) <= V.MAX_ALIAS_WORDS
    )
    plain = ~contains_any(lowered, V.BROAD_ALIAS_MARKERS)
    return (cleaned != "") & ((lowered == lookup_key(skill_name)) | (short & plain))


def word_tokens(text: Column) -> Column:
    """Lower-case words; signs that belong to skill names (c++, c#, node.js, a/b) are kept."""
    return F.regexp_extract_all(
        F.lower(text), F.lit(r"[\p{L}\p{N}_]+(?:[.\-/][\p{L}\p{N}_]+)*[+#]*"), F.lit(0)
    )
