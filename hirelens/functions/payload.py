"""JSON payload access, canonical form and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(raw: Column) -> Column:
    """VARIANT, or NULL when the text is not valid JSON."""
    return F.try_parse_json(raw)


def is_object(raw: Column) -> Column:
    """Valid JSON whose top level is an object."""
    return F.coalesce(raw.rlike(r"^[ \t\r\n]*\{") & parse(raw).isNotNull(), F.lit(False))


def field(variant: Column, key: str, kind: str = "string") -> Column:
    return F.try_variant_get(variant, f"$.{key}", kind)


def canonical_json(raw: Column) -> Column:
    """Sorted keys, no blanks, non-ASCII text kept."""
    return F.to_json(parse(raw))


def content_hash(raw: Column) -> Column:
    return F.sha2(canonical_json(raw), 256)


def page_fingerprint(html: Column) -> Column:
    return F.substring(F.sha2(html, 256), 1, 12)
