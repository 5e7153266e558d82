"""Exact duplicates by deterministic block naming.

A text is cut into fixed-size blocks of bytes. Equal blocks get one integer name, then
adjacent names are named pairwise, level by level, until one name stands for the text.
Two texts of as many blocks are equal exactly when their last names are equal.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from hirelens.functions.once import with_computed
from hirelens.llm.common import keep, whole_row

BLOCK_BYTES = 1024
NAME_SLICES = 16384


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    other = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(other)


def _digests(salt: int, bits: int | None):
    """Two hash columns of a block. `bits` weakens them, for tests."""

    def of(block: Column) -> list[Column]:
        first, second = F.xxhash64(F.lit(salt), block), F.hash(F.lit(salt), block)
        if bits and salt == 0:
            first, second = first.bitwiseAND(F.lit((1 << bits) - 1)), F.lit(0)
        return [first.alias("a"), second.alias("b")]

    return of


def _name(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Integer names of distinct keys: their places in sorted order, slice by slice."""
    slice_ = F.pmod(F.xxhash64(*keys), F.lit(NAME_SLICES))
    order = Window.partitionBy("_slice").orderBy(*keys)
    place = F.row_number().over(order).cast("bigint") - 1
    return distinct.withColumn("_slice", slice_).select(
        *keys, (place * NAME_SLICES + F.col("_slice")).alias("name")
    )


def _blocks(text: Column, block_bytes: int) -> Column:
    data = text.cast("binary")
    count = F.greatest(F.ceil(F.octet_length(data) / block_bytes), F.lit(1)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes)),
    )


def exact_dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    digest_bits: int | None = None,
) -> DataFrame:
    """Name every text and keep, of equal ones, the row with the largest key.

    Texts are compared after lower-casing A-Z; a null text counts as empty, and empty
    texts are equal. Returns one row per input row: `doc_id` (the key), `keep_id`,
    `group_size`, `kept`, `text_sha256` of the normalised text. A null key is smaller than
    any other. Of rows with the same text and key exactly one is kept. An empty table gives
    an empty result. Other columns of `docs` are not read.

    Blocks are sorted by (digest, content). The contents behind each digest are compared
    as bytes, and if one digest had two contents, all is done again with another salt: the
    names never rest on a hash alone. Only distinct contents and narrow rows are shuffled;
    frequent blocks are merged before the shuffle, and joins on them are left to adaptive
    skew splitting.
    """
    source = docs.select(F.col(key).alias("doc_id"), ascii_lower(F.col(text)).alias("norm"))
    salt = 0
    while True:
        digests = _digests(salt, digest_bits)
        rows = keep(
            with_computed(source, {"norm": F.col("norm")}).select(
                F.monotonically_increasing_id().alias("row"),
                "doc_id",
                F.sha2("norm", 256).alias("text_sha256"),
                F.transform(
                    _blocks(F.col("norm"), block_bytes), lambda b: F.struct(*digests(b))
                ).alias("blocks"),
            ),
            "dedup-rows",
        )
        contents = (
            with_computed(source, {"norm": F.col("norm")})
            .select(F.explode(_blocks(F.col("norm"), block_bytes)).alias("block"))
            .select(*digests(F.col("block")), "block")
            .distinct()
        )
        seen = contents.groupBy("a", "b").agg(F.count(F.lit(1)).alias("contents"))
        distinct = keep(seen, "dedup-blocks")
        if distinct.filter("contents > 1").isEmpty():
            break
        salt += 1

    names = _name(distinct.select("a", "b"), ["a", "b"])
    level = keep(
        rows.select("row", F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "x"))
        .select("row", "n", "pos", F.col("x.a").alias("a"), F.col("x.b").alias("b"))
        .join(names, ["a", "b"])
        .select("row", "n", "pos", "name"),
        "dedup-level",
    )
    most = rows.agg(F.max(F.size("blocks"))).first()[0] or 1
    finished, width = [level.filter("n = 1").select("row", "n", "name")], 1
    while width < most:
        side = F.col("pos") % 2
        pairs = keep(
            level.filter(F.col("n") > width)
            .groupBy("row", "n", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(
                F.max(F.when(side == 0, F.col("name"))).alias("l"),
                F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1)).alias("r"),
            ),
            "dedup-pairs",
        )
        width *= 2
        names = _name(pairs.select("l", "r").distinct(), ["l", "r"])
        level = keep(
            pairs.join(names, ["l", "r"]).select("row", "n", "pos", "name"), "dedup-level"
        )
        finished.append(
            level.filter((F.col("n") <= width) & (F.col("n") > width // 2)).select(
                "row", "n", "name"
            )
        )
    identity = finished[0]
    for more in finished[1:]:
        identity = identity.unionByName(more)
    identity = keep(
        identity.join(rows.select("row", "doc_id", "text_sha256"), "row"), "dedup-identity"
    )
    groups = identity.groupBy("n", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    return identity.join(groups, ["n", "name"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows `exact_dedup` keeps, with all their columns."""
    kept = exact_dedup(docs, key, text).filter("kept").select(
        F.col("doc_id").alias("_key"), F.col("text_sha256").alias("_sha")
    )
    rows = docs.select(whole_row(docs), F.sha2(ascii_lower(F.col(text)), 256).alias("sha"))
    matched = rows.join(
        kept, (F.col("sha") == F.col("_sha")) & F.col(f"doc.{key}").eqNullSafe(F.col("_key")),
        "left_semi",
    )
    # rows repeated with key and text pass the join together: one of them stays
    one = matched.withColumn("id", F.col(f"doc.{key}")).dropDuplicates(["sha", "id"])
    return one.select("doc.*")
