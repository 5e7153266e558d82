"""Plain text out of HTML fragments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.text import collapse

# Entities decoded in this order (fixed values); &amp; last so that its result
# is not decoded a second time.
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&apos;": "'",
    "&nbsp;": " ",
    "&amp;": "&",
}


def strip_html(html: Column) -> Column:
    """Tags removed, entities decoded, whitespace collapsed."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</(script|style)>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"</?[A-Za-z!][^>]*>", "")
    for entity, plain in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return collapse(text)
