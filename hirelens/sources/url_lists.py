"""URL lists: one URL per line, # starts a comment line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.functions.text import strip_space


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select(strip_space(F.col("value")).alias("url"))
    return lines.filter((F.col("url") != "") & ~F.col("url").startswith("#"))


def write_urls(urls: DataFrame, path: str, column: str = "url") -> None:
    lines = urls.select(F.col(column).alias("value")).filter(F.col("value").isNotNull())
    lines.write.mode("errorifexists").text(path)


def combine_urls(*lists: DataFrame) -> DataFrame:
    """Union of URL lists: trimmed, blanks dropped, each URL once."""
    combined = lists[0].select("url")
    for urls in lists[1:]:
        combined = combined.unionByName(urls.select("url"))
    trimmed = combined.select(strip_space(F.col("url")).alias("url"))
    return trimmed.filter(F.col("url") != "").distinct()


def known_urls(page_urls: DataFrame, discovered: DataFrame) -> DataFrame:
    """URLs of the page that were found before."""
    return page_urls.select("url").intersect(discovered.select("url"))


def new_urls(page_urls: DataFrame, discovered: DataFrame) -> DataFrame:
    """Rows of the page whose URL was not found before, repeats kept."""
    return page_urls.join(discovered.select("url").distinct(), "url", "left_anti")
