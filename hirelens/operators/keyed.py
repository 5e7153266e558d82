"""Keyed table maintenance: first/last writer, insert-if-absent, upsert, ids.

Winners are picked by an aggregate, not by a window: partial aggregation leaves
one row per key and map task before the shuffle, so a key holding a large share
of the rows never lands in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.session import freeze, stage


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], best) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    rank = F.struct(*[F.col(c) for c in order])
    picked = df.groupBy(*keys).agg(best(row, rank).alias("_row"))
    return picked.select(
        *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns]
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by the order columns, which must be unique per key."""
    return _pick(df, keys, order, F.min_by)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, keys, order, F.max_by)


def least_rows(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The rows that have their key's smallest `column`, null before all others, as an order
    by it would begin. A number's minimum is kept in a hash table, where the first row by several
    columns needs all rows sorted; take this before `first_per_key` where keys have many rows.
    `df` is read twice and should be stored."""
    names = [f"_least_{n}" for n in range(len(keys))]
    least = stage(
        df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(
            F.min(column).alias("_least"), F.max(F.col(column).isNull()).alias("_none")),
        "least")
    wanted = F.when(F.col("_none"), F.lit(None)).otherwise(F.col("_least"))
    test = F.col(column).eqNullSafe(wanted)
    for key, name in zip(keys, names):
        test = test & F.col(key).eqNullSafe(F.col(name))
    return df.join(least, test, "left_semi")


def new_rows(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The incoming rows an insert-if-absent would add: first per key, key not yet stored."""
    first = first_per_key(incoming, keys, order)
    return first.join(existing.select(*keys), list(keys), "left_anti")


def insert_new(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Table after insert-if-absent."""
    added = new_rows(existing, incoming, keys, order).select(*existing.columns)
    return existing.unionByName(added)


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    order: Sequence[str] | None,
    on_update: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Table after insert-or-update; the last incoming row per key wins. Without
    an order the incoming keys must be unique already.

    Matched rows take every ``update`` column from the incoming row, NULLs
    included, plus ``on_update`` values; all other columns keep the stored
    value. New rows take what the incoming row has, then ``on_insert``.
    """
    latest = last_per_key(incoming, keys, order) if order else incoming
    latest = latest.withColumn("_new", F.lit(True))
    stored = existing.withColumn("_old", F.lit(True))
    old, new = stored.alias("old"), latest.alias("new")
    on_update, on_insert = on_update or {}, on_insert or {}
    test = F.lit(True)
    for key in keys:
        test = test & (F.col(f"old.{key}") == F.col(f"new.{key}"))
    joined = old.join(new, test, "full_outer")
    has_old, has_new = F.col("old._old").isNotNull(), F.col("new._new").isNotNull()

    columns = []
    for name in existing.columns:
        kind = existing.schema[name].dataType
        incoming_value = (
            F.col(f"new.{name}").cast(kind) if name in incoming.columns else F.lit(None).cast(kind)
        )
        if name in keys:
            value = F.coalesce(F.col(f"old.{name}"), incoming_value)
        else:
            if name in update:
                kept = F.when(has_new, incoming_value).otherwise(F.col(f"old.{name}"))
            elif name in on_update:
                kept = F.when(has_new, on_update[name].cast(kind)).otherwise(
                    F.col(f"old.{name}")
                )
            else:
                kept = F.col(f"old.{name}")
            fresh = on_insert[name].cast(kind) if name in on_insert else incoming_value
            value = F.when(has_old, kept).otherwise(fresh)
        columns.append(value.alias(name))
    return joined.select(*columns)


def fill_empty(old: Column, new: Column) -> Column:
    """The stored text unless it is NULL or ''."""
    return F.coalesce(F.nullif(old, F.lit("")), new)


def delete_rows(table: DataFrame, deleted: DataFrame, column: str, deleted_key: str) -> DataFrame:
    """Cascade: rows of the table whose reference is not among the deleted keys."""
    gone = deleted.select(F.col(deleted_key).alias(column)).distinct()
    return table.join(gone, column, "left_anti").select(*table.columns)


def clear_reference(
    table: DataFrame, deleted: DataFrame, column: str, deleted_key: str
) -> DataFrame:
    """Set NULL: rows stay, references to deleted keys become NULL."""
    gone = deleted.select(F.col(deleted_key).alias(column)).distinct().withColumn(
        "_gone", F.lit(True)
    )
    joined = table.join(gone, column, "left")
    return joined.withColumn(column, F.when(F.col("_gone").isNull(), F.col(column))).select(
        *table.columns
    )


def with_global_index(
    df: DataFrame, order: Sequence[Column | str], name: str = "_index"
) -> DataFrame:
    """Add a gap-free 0-based index in the given (unique) order, without one global sort task.

    Rows are range-partitioned and sorted; the position inside a slice is the
    low half of ``monotonically_increasing_id`` and the slice sizes give each
    slice's offset. The slices are frozen first, so that sizes and rows come
    from the same run. Only the slice sizes, one row per partition, meet in one
    task and are broadcast.
    """
    sliced = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id())
    )
    frozen = freeze(sliced).withColumns(
        {
            "_slice": F.shiftright("_position", 33),
            "_local": F.col("_position").bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    sizes = frozen.groupBy("_slice").agg(F.count("*").alias("_size"))
    before = (
        Window.partitionBy(F.lit(0))
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        "_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    indexed = frozen.join(F.broadcast(offsets), "_slice")
    return indexed.withColumn(name, F.col("_offset") + F.col("_local")).drop(
        "_position", "_slice", "_local", "_offset"
    )


def assign_ids(
    df: DataFrame, id_column: str, order: Sequence[Column | str], after: int = 0
) -> DataFrame:
    """Ids after the largest one in use, following the order of arrival."""
    indexed = with_global_index(df, order)
    return indexed.withColumn(id_column, F.col("_index") + F.lit(after + 1)).drop("_index")


def largest_id(df: DataFrame, column: str) -> int:
    value = df.agg(F.max(column)).first()[0]
    return int(value or 0)
