"""Columns computed exactly once per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that later filters and selects read instead of recomputing.

    A filter on a plain computed column is pushed below its select and takes a
    copy of the expression with it, once per use: a JSON parse or a regex over
    a whole description would run several times per row. A one-element
    ``inline`` stands between: it has one row in and one row out, and nothing
    that refers to its output moves below it.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[expression.alias(name) for name, expression in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
