"""Two-pass external shuffle into shards.

Pass one scatters the records into memory-sized buckets by a seeded hash. Pass two takes
one bucket per task, shuffles it (Fisher-Yates) and gives each record its place in the
whole order; shards are equal runs of that order.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import quoted, running_before, whole_row

SHARDS = 16
BUCKET_BYTES = 16 << 20
LEAST_BUCKETS = 64
SEED = 7


def _hashable(field: T.StructField) -> Column:
    """A column as it can be hashed: maps, at any depth, as JSON text."""
    column = F.col(quoted(field.name))
    return F.to_json(F.struct(column)) if "map<" in field.dataType.simpleString() else column


def shuffle_into_shards(
    docs: DataFrame,
    text: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    least_buckets: int = LEAST_BUCKETS,
) -> DataFrame:
    """Give every row of `docs` a shard (0 to shards-1) and a slot, gapless from 0.

    Returns `doc` (the whole input row as a struct, so no column can clash, whatever its name
    and type), `shard`, `slot`. Shard sizes in rows are at most one apart. The same rows and seed give the same
    places; rows equal in all columns are interchangeable. Nulls are values like any other;
    an empty table gives an empty frame.

    A bucket is chosen by a hash of the whole row, so a frequent source, key or text alone
    does not fill a bucket. Buckets are sized by the text's bytes; each row is shuffled
    once. Bucket sizes meet their start offsets in a two-level running sum, and the bucket
    gets its offset by co-grouping, without another pass over the rows.
    """
    total = docs.agg(
        F.sum(F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).alias("bytes"),
        F.count(F.lit(1)).alias("rows"),
    ).first()
    rows = total["rows"]
    buckets = max(least_buckets, math.ceil((total["bytes"] or 0) / bucket_bytes))
    values = [_hashable(f) for f in docs.schema.fields]
    hashed = [F.xxhash64(F.lit(seed + i), *values) for i in range(2)]
    scattered = docs.select(
        whole_row(docs), F.pmod(hashed[0], F.lit(buckets)).alias("bucket"), hashed[1].alias("order")
    )
    starts = running_before(
        scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "n", "bucket", "start"
    ).select(F.col("bucket").alias("of"), "start")

    def shuffle(key, left: pa.Table, right: pa.Table) -> pa.Table:
        number = key[0].as_py()
        count = left.num_rows
        order = np.argsort(left["order"].to_numpy(), kind="stable")
        fisher_yates = np.random.default_rng([seed, number]).permutation(count)
        place = right["start"][0].as_py() + np.arange(count, dtype=np.int64)
        shard = place * shards // rows
        first = -(-shard * rows // shards)  # the smallest place of the shard
        return pa.table(
            {
                "doc": left["doc"].take(pa.array(order[fisher_yates])),
                "shard": pa.array(shard.astype(np.int32)),
                "slot": pa.array(place - first),
            }
        )

    fields = [scattered.schema["doc"], T.StructField("shard", T.IntegerType()),
              T.StructField("slot", T.LongType())]
    schema = T.StructType(fields)
    return (
        scattered.groupBy("bucket")
        .cogroup(starts.groupBy("of"))
        .applyInArrow(shuffle, schema)
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """Write a folder per shard with the documents and their slots; files of a shard are
    runs of slots. Goes through Spark's file commit, so a lost task leaves nothing behind."""
    (
        placed.sortWithinPartitions("shard", "slot")
        .write.option("compression", "zstd").partitionBy("shard").parquet(path)
    )


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What `write_shards` wrote of a frame with this schema, the shard read from its folder."""
    return spark.read.schema(schema).parquet(path)
