"""N-gram Jaccard join by MinHash banding.

Texts whose word n-gram sets are alike share, in some band, all of the band's minimum
hashes with a chance set by the number of bands and rows; both are computed from the wanted
recall. Rows meet on band hashes, and every pair that meets is verified on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import bounded_batches, forget, keep, whole_row, words_of
from hirelens.llm.fingerprints import WordHashes, shingle_hashes

THRESHOLD = 0.8
RECALL = 0.9999
MOST_HASHES = 256
BLOCK_SHINGLES = 1 << 18
BLOCK_TEXTS = 1024
SEED = 11


def choose_bands(
    threshold: float = THRESHOLD, recall: float = RECALL, most_hashes: int = MOST_HASHES
) -> tuple[int, int]:
    """Bands and rows: the most selective banding (most rows per band) within the number of
    hashes that finds a pair at the threshold with at least the wanted chance. Pairs more
    alike are found more surely."""
    best = None
    for rows in range(1, most_hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows > most_hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError("the recall cannot be reached with so many hashes")
    return best


class MinHasher:
    def __init__(self, bands: int, rows: int, seed: int = SEED):
        draw = np.random.default_rng(seed)
        count = bands * rows
        self.bands, self.rows = bands, rows
        self.times = draw.integers(1, 1 << 63, count, dtype=np.uint64) | np.uint64(1)
        self.plus = draw.integers(0, 1 << 63, count, dtype=np.uint64)

    def band_hashes(self, shingles: np.ndarray) -> np.ndarray:
        """One number per band from the minimum of each hash function over the set."""
        least = np.full(len(self.times), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 2048):
            part = shingles[at:at + 2048]
            h = part[None, :] * self.times[:, None]
            h += self.plus[:, None]
            h >>= np.uint64(16)  # low bits of a product mix too little
            np.minimum(least, h.min(axis=1), out=least)
        grid = least.reshape(self.bands, self.rows)
        out = np.arange(1, self.bands + 1, dtype=np.uint64)  # a hash belongs to one band
        for i in range(self.rows):
            out = (out ^ grid[:, i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(31)
        return out.astype(np.int64)


def shingle_set(text: str, words: WordHashes, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(words.of(words_of(text)), size))


def _digest(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _signatures(docs: DataFrame, bands: int, rows: int, shingle: int) -> DataFrame:
    bounded_batches(docs.sparkSession)
    source = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id"),
        _digest(F.col("text")).alias("digest"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        words, hasher = WordHashes(), MinHasher(bands, rows)
        for batch in batches:
            counts, hashes = [], []
            for text in batch.column("text").to_pylist():
                shingles = shingle_set(text, words, shingle)
                counts.append(len(shingles))
                hashes.append(hasher.band_hashes(shingles) if len(shingles) else [])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "doc_id", "digest")),
                 pa.array(counts, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))],
                names=["row", "doc_id", "digest", "shingles", "bands"],
            )

    key = docs.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        sign, f"row bigint, doc_id {key}, digest binary, shingles bigint, bands array<bigint>"
    )


def _links_of_block(rows: list[dict], threshold: float, both: bool) -> list[tuple]:
    """Verified links of one block of a bucket: (text, links, smallest text of its part).

    `rows` are (text, side, earlier bands, set). With `both`, the block joins two different
    slices and only pairs across them count. A pair counts in the first band it shares.
    """
    count = len(rows)
    sizes = np.array([len(r["set"]) for r in rows])
    flat = np.concatenate([r["set"] for r in rows])
    owner = np.repeat(np.arange(count), sizes)
    _, number, repeats = np.unique(flat, return_inverse=True, return_counts=True)
    shared = repeats[number] > 1  # a shingle of one text alone is in no intersection
    column = np.cumsum(repeats > 1) - 1
    number, owner = column[number[shared]], owner[shared]
    common = np.zeros((count, count), np.float32)
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    width = max(256, (1 << 22) // count)
    top = int(number[-1]) + 1 if len(number) else 0
    for start in range(0, top, width):
        a, b = np.searchsorted(number, [start, start + width])
        grid = np.zeros((count, min(width, top - start)), np.float32)
        grid[owner[a:b], number[a:b] - start] = 1
        common += grid @ grid.T
    # |A and B| >= t |A or B|, in whole numbers up to the last comparison
    joint = sizes[:, None] + sizes[None, :] - common
    near = common >= threshold * joint - 1e-6
    np.fill_diagonal(near, False)
    if both:
        side = np.array([r["side"] for r in rows])
        near &= side[:, None] != side[None, :]
    earlier = np.array([r["earlier"] for r in rows], np.int64).reshape(count, -1)
    for i in np.flatnonzero(near.any(axis=1)):
        others = np.flatnonzero(near[i])
        met = (earlier[others] == earlier[i]).any(axis=1)
        near[i, others[met]] = False
    parent = list(range(count))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(count):
        for j in np.flatnonzero(near[i, i + 1:]) + i + 1:
            a, b = root(i), root(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
    links = near.sum(axis=1)
    least: dict[int, int] = {}
    for i in range(count):
        r = root(i)
        least[r] = min(least.get(r, rows[i]["text"]), rows[i]["text"])
    return [
        (rows[i]["text"], int(links[i]), least[root(i)]) for i in range(count) if links[i]
    ]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """The smallest member of each node's connected component: (`node`, `least`).

    `edges` (`a`, `b`) may hold any number of rows per node. Large-star and small-star
    steps alternate; each is a grouped minimum, merged before the shuffle, and a join on the
    node. Every round is written, so a lost executor repeats one round at most.
    """

    def mark(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()

    edges = keep(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        name,
    )
    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), "m")
            .filter("a <> m").select("a", F.col("m").alias("b")).distinct()
        )
        # the small star: neighbours below the node, and the node, meet their smallest one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").select(F.col("b").alias("a"), "m")
            .unionByName(low.select("a", "m"))
            .filter("a <> m").select("a", F.col("m").alias("b")).distinct()
        )
        edges = keep(small, name)
        after = mark(edges)
        if after == before:
            break
        before = after
    ends = edges.groupBy("a").agg(F.min("b").alias("least"))
    roots = edges.select(F.col("b").alias("node")).distinct()
    return ends.withColumnRenamed("a", "node").unionByName(
        roots.withColumn("least", F.col("node"))
    )


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    shingle: int = 5,
    block_shingles: int = BLOCK_SHINGLES,
    block_texts: int = BLOCK_TEXTS,
) -> DataFrame:
    """Join texts (`doc_id`, `text`) whose word n-gram sets have a Jaccard similarity of at
    least `threshold`. Returns one row per input row:

    `doc_id`; `class_id`, the smallest doc_id of its class (texts joined by links, at any
    distance); `text_id`, the smallest doc_id with the same text; `links`, the number of
    other texts linked to this one; `kept`, true for one row of each class, the smallest
    doc_id; `text_sha256` (binary).

    Equal texts are one text from the start and are not expanded into pairs. A null text
    counts as empty; texts without words have no n-grams and no links. Texts shorter than an
    n-gram are one n-gram of all their words. A null doc_id counts as larger than any other.
    Of rows with the same text and doc_id one is kept. An empty table gives an empty frame;
    other columns are not read.

    Buckets of a band with one text are dropped, and of buckets with the same texts only the
    first band's stays, so a text's set is sent once to each different group. A large bucket
    is cut into slices by hash, and each pair of slices is a block: no pair is left out, and
    no pair leaves the block it is verified in. A block sends back, per text, the number of
    its links and the smallest text of its connected part.
    """
    bands, rows = choose_bands(threshold, recall)
    signed = keep(_signatures(docs, bands, rows, shingle), "join-signatures")
    texts = keep(
        signed.groupBy("digest").agg(
            F.min("row").alias("text"), F.min("doc_id").alias("text_id"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "join-texts",
    )
    first = signed.join(texts.select(F.col("text").alias("row")), "row", "left_semi")
    entries = first.select(F.col("row").alias("text"), F.posexplode("bands").alias("band", "hash"))
    shared = entries.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    matched = keep(
        entries.join(shared.select("hash"), "hash", "left_semi").select("text", "band", "hash"),
        "join-matched",
    )
    mixed = [F.sum(F.xxhash64(F.lit(i), "text").cast("decimal(20,0)")) for i in range(2)]
    sizes = first.select(F.col("row").alias("text"), "shingles")
    different = (
        matched.join(sizes, "text")
        .groupBy("hash", "band").agg(
            F.count(F.lit(1)).alias("texts"), F.sum("shingles").alias("total"),
            mixed[0].alias("m0"), mixed[1].alias("m1"),
        )
        .groupBy("texts", "total", "m0", "m1")
        .agg(F.min(F.struct("band", "hash")).alias("first"))
        .select(
            "first.hash",
            F.greatest(
                F.ceil(F.col("total") / block_shingles), F.ceil(F.col("texts") / block_texts)
            ).cast("int").alias("slices"),
        )
    )
    # a text's slice in a bucket; a block is a pair of slices
    placed = keep(matched.join(different, "hash"), "join-placed")
    members = (
        placed.join(first.select(F.col("row").alias("text"), "digest", "bands"), "text")
        .withColumn("slice", F.pmod(F.xxhash64(F.lit(SEED), "text"), "slices").cast("int"))
        .withColumn("earlier", F.slice("bands", 1, F.col("band")))
        .drop("bands")
    )
    members = keep(members, "join-members")
    wanted = members.select("digest", "text").distinct()
    bounded_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        words = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, words, shingle).tobytes()
                    for t in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("text"), pa.array(sets, pa.binary())], names=["text", "set"]
            )

    bodies = (
        docs.select(_digest(F.col("text")).alias("digest"), F.col("text").alias("body"))
        .join(wanted, "digest")
        .dropDuplicates(["text"])
        .select("text", "body")
    )
    sets = bodies.mapInArrow(cut, "text bigint, set binary")
    blocks = (
        members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        .select(
            "band", "hash", F.least("slice", "other").alias("low"),
            F.greatest("slice", "other").alias("high"), "text", F.col("slice").alias("side"),
            "earlier",
        )
        .join(sets, "text")
    )
    key = ["band", "hash", "low", "high"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(group, own):
            if len(own) < 2:
                return []
            return _links_of_block(own, threshold, group[2] != group[3])

        def batch(out):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out)], names=["text", "links", "least"]
            )

        group, own = None, []
        for incoming in batches:
            out = []
            for row in incoming.to_pylist():
                at = tuple(row[k] for k in key)
                if at != group:
                    out += done(group, own)
                    group, own = at, []
                row["set"] = np.frombuffer(row["set"], np.uint64)
                own.append(row)
            if out:
                yield batch(out)
        if out := done(group, own):
            yield batch(out)

    found = keep(
        blocks.repartition(*key).sortWithinPartitions(*key, "text").mapInArrow(
            verify, "text bigint, links bigint, least bigint"
        ),
        "join-links",
    )
    links = found.groupBy("text").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("text").alias("a"), F.col("least").alias("b")))
    described = keep(
        texts.join(links, "text", "left").join(
            joined.withColumnRenamed("node", "text"), "text", "left"
        ).select(
            "digest", "text_id", F.coalesce("links", F.lit(0)).alias("links"),
            F.coalesce("least", "text").alias("class"),
        ),
        "join-classes",
    )
    every = signed.select("row", "doc_id", "digest").join(described, "digest")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    classes = every.groupBy("class").agg(F.min(order).alias("keep"))
    return every.join(classes, "class").select(
        "doc_id", F.col("keep.doc_id").alias("class_id"), "text_id", "links",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows `near_duplicates` keeps, with all their columns: one of each class."""
    kept = near_duplicates(docs, **options).filter("kept").select(
        F.col("doc_id").alias("_key"), F.col("text_sha256").alias("_digest")
    )
    rows = docs.select(whole_row(docs), _digest(F.col("text")).alias("digest"))
    matched = rows.join(
        kept,
        (F.col("digest") == F.col("_digest")) & F.col("doc.doc_id").eqNullSafe(F.col("_key")),
        "left_semi",
    )
    one = matched.withColumn("id", F.col("doc.doc_id")).dropDuplicates(["digest", "id"])
    return one.select("doc.*")
