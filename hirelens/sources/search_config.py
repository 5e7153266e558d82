"""Batch search configuration files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens import schemas
from hirelens.functions.urls import search_url


def read_search_config(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    return spark.read.schema(schemas.SEARCH_CONFIG).json(path, multiLine=multiline)


def config_errors(config: DataFrame) -> DataFrame:
    """One row per configuration problem: a missing field, or no searches."""
    missing = F.array(
        *[F.when(F.col(c).isNull(), F.lit(f"missing field: {c}")) for c in V.SEARCH_CONFIG_FIELDS],
        F.when(F.size("searches") == 0, F.lit("searches is empty")),
    )
    return config.select("location", F.explode(F.array_compact(missing)).alias("error"))


def searches(config: DataFrame) -> DataFrame:
    """One row per configured search; a search's own limit overrides the default."""
    return config.select(
        "location",
        "offset_step",
        "max_pages",
        F.coalesce(
            "max_consecutive_no_new", F.lit(V.DEFAULT_MAX_CONSECUTIVE_NO_NEW)
        ).alias("max_consecutive_no_new"),
        "max_urls_per_search",
        F.posexplode("searches").alias("search_index", "search"),
    ).select(
        "search_index",
        F.col("search.name").alias("search_name"),
        F.col("search.keywords").alias("keywords"),
        "location",
        "offset_step",
        "max_pages",
        "max_consecutive_no_new",
        F.coalesce("search.max_urls", "max_urls_per_search").alias("max_urls"),
        search_url(F.col("search.keywords"), F.col("location")).alias("search_url"),
    )
