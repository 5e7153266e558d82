"""Raw record files: JSON arrays as scraped, or one record per line."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens import schemas
from hirelens.sources.json_arrays import array_elements


def read_raw_records(spark: SparkSession, path: str, layout: str = "array") -> DataFrame:
    """Records with their position in arrival order.

    ``array`` reads files holding one JSON array each, a file in one task; ``split_array``
    reads the same files in byte ranges, for large ones; ``lines`` reads splittable JSON lines.
    ``raw_payload`` keeps the JSON text of the payload. A line, an element of a split array or
    a whole array file that is no JSON becomes one row with its text in ``unreadable``.
    """
    if layout not in ("array", "split_array", "lines"):
        raise ValueError(f"unknown layout: {layout}")
    if layout == "split_array":
        return split_array_records(spark, path)
    return with_position(json_records(spark.read, path, layout))


SCANNED = T.StructType([*schemas.RAW_RECORD, T.StructField("unreadable", T.StringType())])


def split_array_records(spark: SparkSession, path: str) -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "unreadable"}
    elements = array_elements(spark, path).withColumn(
        "_record", F.from_json("value", SCANNED, options))
    return elements.select(*[F.col("_record")[c].alias(c) for c in SCANNED.names], "position")


def json_records(reader, path: str, layout: str) -> DataFrame:
    """Records of a batch or streaming reader; text that is no JSON stands in ``unreadable``."""
    reader = reader.schema(SCANNED).option("columnNameOfCorruptRecord", "unreadable")
    return reader.json(path, mode="PERMISSIVE", multiLine=layout == "array")


def with_position(records: DataFrame) -> DataFrame:
    """Unique, increasing in reading order inside every input file."""
    return records.withColumn("position", F.monotonically_increasing_id())


def require_records(records: DataFrame) -> DataFrame:
    if records.isEmpty():
        raise ValueError("the input holds no records")
    return records


def _as_lines(records: DataFrame) -> DataFrame:
    shaped = records.withColumn("raw_payload", F.try_parse_json("raw_payload"))
    columns = [c for c in schemas.RAW_RECORD.names if c in records.columns]
    return shaped.select(F.to_json(F.struct(*columns)).alias("value"))


def write_records(records: DataFrame, path: str) -> None:
    """One JSON record per line, the payload as an object, not as text."""
    _as_lines(records).write.mode("errorifexists").text(path)


def write_record_arrays(records: DataFrame, path: str) -> None:
    """JSON arrays, a file per task, a record per line inside."""

    def bracketed(batches):
        before = "["
        for batch in batches:
            values = batch.column("value").to_pylist()
            lines = [(before if i == 0 else ",") + value for i, value in enumerate(values)]
            before = "," if values else before
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        end = "]" if before == "," else "[]"
        yield pa.RecordBatch.from_arrays([pa.array([end])], names=["value"])

    arrays = _as_lines(records).mapInArrow(bracketed, "value string")
    arrays.write.mode("errorifexists").text(path)
