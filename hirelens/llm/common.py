"""Helpers shared by the operators: inputs, written tables, ranks without one big task."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.session import scratch_path

ROWS_PER_SLICE = 100_000
LEAST_SLICES = 64


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Bound the Arrow batches of Python stages by rows and bytes: texts vary a lot in length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, and what a
    lost executor computed is not computed again."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def whole_row(docs: DataFrame, name: str = "doc") -> Column:
    """All columns as one struct, whatever their names."""
    return F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias(name)


_learned: dict[str, Any] = {}


def learned(name: str, make: Callable[[], Any]) -> Any:
    """What a Python worker has learned under a name, shared by the tasks of a stage. Workers
    outlive stages, so one keeps a single thing: another name drops it."""
    if name not in _learned:
        _learned.clear()
        _learned[name] = make()
    return _learned[name]


def forget() -> None:
    """Free what earlier stages have left in this Python worker."""
    _learned.clear()


def numbered(df: DataFrame, name: str, column: str = "row") -> DataFrame:
    """Rows with a unique number, written once so that every reader sees the same one."""
    return keep(df.withColumn(column, F.monotonically_increasing_id()), name)


def slices_for(rows: int) -> int:
    return max(LEAST_SLICES, math.ceil(rows / ROWS_PER_SLICE))


def _before(partition: Sequence[str | Column], order: str):
    return (
        Window.partitionBy(*partition)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def running_before(df: DataFrame, amount: str, order: str, name: str, width: int = 4096):
    """Add the sum of `amount` over all rows with a smaller `order` (a number from 0).

    Two levels: inside runs of `width` numbers, then over the runs' totals, so that the
    one window over everything sees a row per run.
    """
    run = F.floor(F.col(order) / F.lit(width))
    totals = df.groupBy(run.alias("_run")).agg(F.sum(amount).alias("_total"))
    starts = totals.select(
        "_run",
        F.coalesce(F.sum("_total").over(_before([F.lit(0)], "_run")), F.lit(0)).alias("_start"),
    )
    inside = F.coalesce(F.sum(amount).over(_before(["_run"], order)), F.lit(0))
    return (
        df.withColumn("_run", run)
        .withColumn("_inside", inside)
        .join(starts, "_run")
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_run", "_inside", "_start")
    )


def ranked(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    slices: int,
    rank: str,
    amount: str | None = None,
    before: str | None = None,
    mixed_by: Column | None = None,
) -> DataFrame:
    """Add a gap-free rank from 0 inside each group, and, for `amount`, the sum of the
    rows before.

    A group may hold any share of the rows: it is cut by a hash into slices, ranked inside
    its slices, and each slice starts where the slices before it end. The order is
    (slice, order). Group columns must not be null. `df` is read twice.
    """
    mixed = F.xxhash64(*order) if mixed_by is None else mixed_by
    sliced = df.withColumn("_slice", F.pmod(mixed, F.lit(slices)).cast("int"))
    inside = Window.partitionBy(*group, "_slice").orderBy(*order)
    sizes = [F.count(F.lit(1)).alias("_n"), (F.sum(amount) if amount else F.lit(0)).alias("_a")]
    totals = sliced.groupBy(*group, "_slice").agg(*sizes)
    earlier = _before(group, "_slice")
    starts = totals.select(
        *group,
        "_slice",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_a").over(earlier), F.lit(0)).alias("_sum_before"),
    )
    out = sliced.withColumn("_rank", F.row_number().over(inside) - 1)
    if amount:
        running = inside.rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("_running", F.coalesce(F.sum(amount).over(running), F.lit(0)))
    out = out.join(starts, [*group, "_slice"]).withColumn(
        rank, F.col("_rows_before") + F.col("_rank")
    )
    if amount:
        out = out.withColumn(before, F.col("_sum_before") + F.col("_running"))
    return out.drop("_slice", "_rank", "_running", "_rows_before", "_sum_before")


def words_of(text: str) -> list[str]:
    """Words as the shingle operators see them: lower case, cut at white space."""
    return text.lower().split()
