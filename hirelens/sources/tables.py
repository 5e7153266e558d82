"""Stored tables: Parquet folders, one snapshot folder per refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelens import schemas


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], schemas.TABLES[name])


def read_table(spark: SparkSession, root: str | None, name: str) -> DataFrame:
    """A stored table, or an empty one before the first refresh."""
    if root is None:
        return empty_table(spark, name)
    return spark.read.schema(schemas.TABLES[name]).parquet(f"{root}/{name}")


def write_table(df: DataFrame, root: str, name: str) -> DataFrame:
    """Write a table into a new snapshot and read it back, which cuts its lineage."""
    path = f"{root}/{name}"
    if name in schemas.TABLES:
        schema = schemas.TABLES[name]
        df = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def scan(df: DataFrame, columns: list[str], order: str, limit: int | None = None) -> DataFrame:
    """Pruned scan in key order; the limit is for development runs only."""
    rows = df.select(*columns).orderBy(order)
    return rows if limit is None else rows.limit(limit)


BRONZE_SCAN = [
    "raw_job_id", "pipeline_run_id", "source_name", "source_job_id", "source_url",
    "scraped_at", "raw_payload",
]
SILVER_SCAN = ["job_id", "job_title", "description_text", "job_function", "industries"]


def write_keys(df: DataFrame, table: str, keys: list[str], buckets: int) -> DataFrame:
    """Store known keys in the warehouse, bucketed and sorted by the keys.

    A join of incoming rows with the stored keys then moves the incoming side only: the
    stored buckets are read where they lie. Take as many buckets as the shuffle has partitions
    or more, so that a bucket fits into a task's memory.
    """
    stored = df.select(*keys).distinct()
    stored.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)
