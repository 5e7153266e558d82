"""Lists and maps of fixed text as one SQL literal each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_texts(texts: Sequence[str]) -> str:
    return ", ".join(sql_text(t) for t in texts)


def literal_list(texts: Sequence[str]) -> Column:
    return F.expr(f"array({sql_texts(texts)})")


def literal_map(entries: Mapping[str, str]) -> Column:
    return F.expr(f"map({sql_texts([x for pair in entries.items() for x in pair])})")
