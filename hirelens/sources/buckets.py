"""Keyed tables in folders by key hash, written in versions.

Layout under a root folder::

    layout/                                   number of buckets, written once
    tables/<name>/<kind>-<version>/_bucket=B/ rows of bucket B, `base` or `append`
    commits/version=V/                        what version V wrote, and its counters

A version writes new folders only. An `append` part adds rows to a bucket; a `base` part is
the whole bucket and stands for everything before it; `empty` stands for no rows. Nothing counts until the version's
commit is written, in one small file and last: a broken run is simply repeated, and readers
of an earlier version are not disturbed. How many parts a bucket may have is bounded, so the
state that the driver holds is bounded by the tables and buckets.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.operators.keyed import last_per_key, upsert
from hirelens.session import stage

BUCKETS = 64
MOST_PARTS = 16
COMMIT = "kind string, name string, bucket int, value bigint"
BASE, APPEND, EMPTY, COUNTER = "base", "append", "empty", "counter"


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A folder's rows; an empty frame while nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


class BucketStore:
    """The last committed version of the tables under `root`, and the one being written."""

    def __init__(
        self, spark: SparkSession, root: str, schemas: Mapping[str, T.StructType],
        buckets: int = BUCKETS,
    ):
        self.spark, self.root, self.schemas = spark, root, schemas
        layout = read_or_empty(spark, f"{root}/layout", "buckets int").first()
        if layout is None:
            one = spark.createDataFrame([(buckets,)], "buckets int")
            one.coalesce(1).write.parquet(f"{root}/layout")
        self.buckets = layout["buckets"] if layout else buckets
        commits = read_or_empty(spark, f"{root}/commits", f"{COMMIT}, version bigint")
        bases = commits.filter(F.col("kind").isin(BASE, EMPTY)).groupBy("name", "bucket").agg(
            F.max("version").alias("base"))
        live = (
            commits.filter(F.col("kind").isin(BASE, APPEND))
            .join(bases, ["name", "bucket"], "left")
            .filter(F.col("version") >= F.coalesce("base", F.lit(0)))
        )
        self.parts: dict[tuple[str, int], list[str]] = defaultdict(list)
        for row in live.orderBy("version").collect():
            place = row["name"], row["bucket"]
            self.parts[place].append(f"{row['kind']}-{row['version']}")
        counters = commits.filter(F.col("kind") == COUNTER).groupBy("name").agg(
            F.max("value").alias("value"))
        self.counters = {r["name"]: r["value"] for r in counters.collect()}
        self.version = (commits.agg(F.max("version")).first()[0] or 0) + 1
        self.written: list[tuple[str, str, int]] = []

    def bucket_of(self, keys: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def buckets_of(self, rows: DataFrame, keys: Sequence[str]) -> list[int]:
        """The buckets that the rows belong to: at most as many as there are."""
        found = rows.select(self.bucket_of(keys).alias("b")).distinct().collect()
        return sorted(r["b"] for r in found)

    def read(
        self, name: str, buckets: Sequence[int] | None = None, before: bool = False
    ) -> DataFrame:
        """A table, or some of its buckets: as written so far, or `before` this version."""
        parts = {
            b: list(own) for (table, b), own in self.parts.items()
            if table == name and (buckets is None or b in buckets)
        }
        for kind, table, b in [] if before else self.written:
            if table == name and (buckets is None or b in buckets):
                parts[b] = parts.get(b, []) if kind == APPEND else []
                parts[b] += [f"{kind}-{self.version}"] if kind != EMPTY else []
        paths = [
            f"{self.root}/tables/{name}/{part}/_bucket={b}"
            for b, own in sorted(parts.items()) for part in own
        ]
        if not paths:
            return self.spark.createDataFrame([], self.schemas[name])
        return self.spark.read.schema(self.schemas[name]).parquet(*paths)

    def _is_full(self, name: str, bucket: int) -> bool:
        return len(self.parts.get((name, bucket), [])) >= MOST_PARTS

    def _write(self, name: str, kind: str, rows: DataFrame, bucket: Column) -> None:
        columns = [
            rows[f.name].cast(f.dataType).alias(f.name) for f in self.schemas[name].fields
        ]
        path = f"{self.root}/tables/{name}/{kind}-{self.version}"
        shaped = rows.select(*columns, bucket.alias("_bucket")).repartition("_bucket")
        shaped.write.mode("overwrite").partitionBy("_bucket").parquet(path)
        schema = T.StructType([*self.schemas[name].fields, T.StructField("_bucket", T.IntegerType())])
        for row in read_or_empty(self.spark, path, schema).select("_bucket").distinct().collect():
            self.written.append((kind, name, row["_bucket"]))

    def append(self, name: str, rows: DataFrame, keys: Sequence[str]) -> None:
        """Add rows whose keys the table does not hold."""
        place, touched = self.bucket_of(keys), self.buckets_of(rows, keys)
        anew = [b for b in touched if self._is_full(name, b)]
        if anew:
            old = self.read(name, anew, before=True)
            columns = old.columns
            self._write(
                name, BASE, old.unionByName(rows.filter(place.isin(anew)).select(*columns)), place)
        if len(anew) < len(touched):
            self._write(name, APPEND, rows.filter(~place.isin(anew)), place)

    def replace(self, name: str, rows: DataFrame, keys: Sequence[str]) -> None:
        """Replace a whole table, one that is small beside the others."""
        self._write(name, BASE, rows, self.bucket_of(keys))
        now = {b for kind, table, b in self.written if table == name}
        self.written += [
            (EMPTY, name, b) for table, b in self.parts if table == name and b not in now
        ]

    def upsert(
        self, name: str, rows: DataFrame, keys: Sequence[str], bucket_keys: Sequence[str],
        update: Sequence[str], order: Sequence[str] | None = None,
        on_update: Mapping[str, Column] | None = None,
        on_insert: Mapping[str, Column] | None = None,
    ) -> None:
        """Insert or update rows by key. Buckets with a stored key, and those with many parts,
        are written anew; to the others the rows are added, whatever the buckets hold."""
        if order:
            rows = stage(last_per_key(rows, keys, order), f"last-{name}")
        touched = self.buckets_of(rows, bucket_keys)
        stored = self.read(name, touched, before=True)
        known = rows.select(*keys).join(stored.select(*keys), list(keys), "left_semi")
        anew = set(self.buckets_of(known, bucket_keys))
        anew |= {b for b in touched if self._is_full(name, b)}
        place, add = self.bucket_of(bucket_keys), [b for b in touched if b not in anew]
        for kind, own in ((BASE, sorted(anew)), (APPEND, add)):
            if own:
                old = self.read(name, own if kind == BASE else [], before=True)
                new = upsert(
                    old, rows.filter(place.isin(own)), keys, update, None, on_update, on_insert)
                self._write(name, kind, new, place)

    def commit(self, counters: Mapping[str, int]) -> None:
        """Make the version count, in one file written last."""
        rows = [(kind, name, b, None) for kind, name, b in self.written]
        rows += [(COUNTER, name, None, int(value)) for name, value in counters.items()]
        one = self.spark.createDataFrame(rows, COMMIT).coalesce(1)
        one.write.mode("errorifexists").parquet(f"{self.root}/commits/version={self.version}")
