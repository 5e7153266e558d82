"""Ranked lexical search by Block-Max MaxScore over an inverted index in shards.

A shard is a bounded stretch of a task's documents, in ascending order of their ids. Its
postings of a term are cut into blocks; a block stores differences of document places and
term frequencies, packed into bytes, and the largest impact among its postings. A search
sorts the lists of an item's terms by their largest possible part of a score. Lists whose
parts together stay below the k-th best score so far are not essential: a document that only
they hold cannot enter. Documents of the essential lists are candidates; for each other list
the maximum of the block that a candidate would be in decides whether the candidate can still
enter, before that block is unpacked. The best of all shards are merged by Spark.

Scores are integers: an item's term of weight w, in a document of norm m with tf occurrences,
counts w * ((1000000000 * tf) div (1000 * tf + 8 * m)); see `weight` and `norms`.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.llm.common import bounded_batches, keep

BLOCK = 128  # postings
SHARD_BYTES = 32 << 20  # of text; a longer document is a shard of its own
SHARD_DOCS = 50_000
ROWS_AT_ONCE = 50_000
FIRST_WINDOW = 512  # documents; each further window of a shard is twice as wide
ITEMS_AT_ONCE, ITEM_BYTES_AT_ONCE = 1000, 8 << 20
BEST = 10

_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8: stretches of ASCII letters and digits and of all characters
    beyond ASCII; only A-Z is lower-cased."""
    return (text or b"").translate(_TERM_BYTES).split()


def weight(documents: int, holding: int) -> int:
    """A term's weight among so many documents with a term, so many of which hold it."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def norms(lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The documents' m: 25 + (75 * length * documents) div total."""
    if 75 * int(lengths.max(initial=0)) * documents < 1 << 63:
        return 25 + 75 * lengths * documents // max(total, 1)
    return np.array([25 + 75 * int(n) * documents // total for n in lengths], np.int64)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes, seven bits each, the last byte of a number below 128; and the bytes
    used up to the end of each number."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for shift in range(7, 64, 7):
        more = values >> np.uint64(shift) > 0
        if not more.any():
            break
        sizes += more
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for i in range(int(sizes.max(initial=0))):
        has = sizes > i
        part = (values[has] >> np.uint64(7 * i)) & np.uint64(127)
        part |= (sizes[has] > i + 1).astype(np.uint64) << np.uint64(7)
        out[ends[has] - sizes[has] + i] = part
    return out, ends


def unpack(data: np.ndarray) -> np.ndarray:
    """The numbers of packed bytes."""
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1])
    if len(last) == len(data):
        return data.astype(np.int64)
    place = np.arange(len(data)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), first)


def _lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def _shard_rows(shard, keys, ids, lengths, terms, documents, total) -> Iterator[pa.RecordBatch]:
    """A row for each term of a shard, and one of no term for its documents. `ids` are the
    documents' term numbers one after another, `terms` the terms by number."""
    order = pc.sort_indices(keys, null_placement="at_end").to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    m = norms(lengths[order], documents, total)
    docs = len(order)
    posting, tf = np.unique(ids * docs + np.repeat(place, lengths), return_counts=True)
    term, doc = posting // docs, posting % docs
    heads = np.flatnonzero(np.diff(term, prepend=-1))
    count = np.diff(np.append(heads, len(term)))
    inside = np.arange(len(term)) - np.repeat(heads, count)
    block = np.flatnonzero(inside % BLOCK == 0)
    steps = np.diff(doc, prepend=0)
    steps[block] = doc[block]  # a block's first place is written whole
    part = impacts(tf, m[doc])
    blocks = np.concatenate([[0], np.cumsum(-(-count // BLOCK))])
    stop = np.append(block[1:], len(term)) if len(block) else block
    maxima = np.maximum.reduceat(part, block) if len(block) else part
    ends = heads + count
    streams = []
    for values in (steps, tf):
        data, used = pack(values)
        used = np.concatenate([[0], used])
        # ends of the blocks, from the beginning of their list
        streams.append((used[np.append(heads, len(term))], data,
                        used[stop] - np.repeat(used[heads], np.diff(blocks))))
    own = len(heads)
    kind = keys.type
    columns = {
        "shard": pa.array(np.full(own, shard), pa.int64()),
        "term": pa.array([terms[t] for t in term[heads]], pa.binary()),
        "df": pa.array(count, pa.int32()),
        "lasts": _lists(blocks, doc[stop - 1] if len(stop) else stop, pa.int32()),
        "maxima": _lists(blocks, maxima, pa.int64()),
        "step_ends": _lists(blocks, streams[0][2], pa.int32()),
        "tf_ends": _lists(blocks, streams[1][2], pa.int32()),
        "steps": _binary(streams[0][0], streams[0][1]),
        "tfs": _binary(streams[1][0], streams[1][1]),
        "keys": pa.nulls(own, pa.list_(kind)),
        "norms": pa.nulls(own, pa.list_(pa.int64())),
    }
    assert len(ends) == own
    table = pa.table(columns)
    yield from table.to_batches(max_chunksize=ROWS_AT_ONCE)
    one = {c: pa.nulls(1, v.type) for c, v in columns.items()}
    one["shard"] = pa.array([shard], pa.int64())
    one["keys"] = _lists(np.array([0, docs]), pc.take(keys, pa.array(order)), kind)
    one["norms"] = _lists(np.array([0, docs]), m, pa.int64())
    yield pa.RecordBatch.from_arrays(list(one.values()), names=list(one))


class _Numbers(dict):
    def __missing__(self, term):
        number = self[term] = len(self)
        return number


def write_index(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Index every row of `docs` at `path`: `stats` (documents with a term, all terms) and
    `shards`. Texts are cut twice, the first time for the two counts alone.

    Null and empty texts have no terms; they and rows with a null id are kept as documents,
    the latter after all others; repeated rows are documents of their own; an empty table gives
    an empty index. Only `key` and `text` are read, whatever else `docs` holds.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))

    def count(batches):
        for batch in batches:
            sizes = [len(terms_of(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([sum(map(bool, sizes))]), pa.array([sum(sizes)])],
                names=["documents", "terms"])

    totals = rows.mapInArrow(count, "documents bigint, terms bigint").groupBy().agg(
        F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"),
        F.coalesce(F.sum("terms"), F.lit(0)).alias("terms"))
    totals.write.parquet(f"{path}/stats")
    documents, total = docs.sparkSession.read.parquet(f"{path}/stats").first()
    plain = rows.schema["key"].dataType.simpleString()
    schema = (
        "shard bigint, term binary, df int, lasts array<int>, maxima array<bigint>, "
        "step_ends array<int>, tf_ends array<int>, steps binary, tfs binary, "
        f"keys array<{plain}>, norms array<bigint>"
    )

    def build(batches):
        shard = TaskContext.get().partitionId() << 32
        numbers, keys, ids, lengths, size = _Numbers(), [], [], [], 0

        def done():
            return _shard_rows(
                shard, pa.concat_arrays(keys), np.concatenate(ids),
                np.array(lengths, np.int64), list(numbers), documents, total)

        for batch in batches:
            first = 0
            for i, data in enumerate(batch.column("text").to_pylist()):
                if lengths and (size >= SHARD_BYTES or len(lengths) >= SHARD_DOCS):
                    keys.append(batch.column("key").slice(first, i - first))
                    yield from done()
                    numbers, keys, ids, lengths, size = _Numbers(), [], [], [], 0
                    shard, first = shard + 1, i
                terms = terms_of(data)
                ids.append(np.fromiter(map(numbers.__getitem__, terms), np.int64, len(terms)))
                lengths.append(len(terms))
                size += len(data or b"")
            keys.append(batch.column("key").slice(first))
        if lengths:
            yield from done()

    rows.mapInArrow(build, schema).write.option("compression", "zstd").parquet(f"{path}/shards")


class Postings:
    """A term's list in a shard; blocks are unpacked when they are first needed."""

    def __init__(self, row: dict, m: np.ndarray):
        self.lasts = np.asarray(row["lasts"], np.int64)
        self.maxima = np.asarray(row["maxima"], np.int64)
        self.most = int(self.maxima.max())
        self.m = m
        self.places = np.minimum(np.arange(len(self.lasts) + 1) * BLOCK, row["df"])
        self.streams = [
            (np.frombuffer(row[data], np.uint8), np.concatenate([[0], row[ends]]))
            for data, ends in (("steps", "step_ends"), ("tfs", "tf_ends"))
        ]
        self.ready = np.zeros(len(self.lasts), bool)
        self.docs = np.zeros(row["df"], np.int64)
        self.parts = np.zeros(row["df"], np.int64)

    def unpack(self, blocks: np.ndarray) -> None:
        """Unpack the blocks that are not yet; stretches of them at once."""
        blocks = blocks[~self.ready[blocks]]
        for own in np.split(blocks, np.flatnonzero(np.diff(blocks) > 1) + 1):
            if not len(own):
                continue
            a, b = int(own[0]), int(own[-1]) + 1
            steps, tf = (unpack(data[ends[a]:ends[b]]) for data, ends in self.streams)
            low, high = self.places[a], self.places[b]
            heads = self.places[a:b] - low
            sums = np.cumsum(steps)
            before = sums[heads] - steps[heads]
            docs = sums - np.repeat(before, np.diff(self.places[a:b + 1]))
            self.docs[low:high] = docs
            self.parts[low:high] = impacts(tf, self.m[docs])
            self.ready[a:b] = True

    def between(self, first: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from `first` to before `stop`, and their parts."""
        a = np.searchsorted(self.lasts, first)
        b = min(np.searchsorted(self.lasts, stop - 1) + 1, len(self.lasts))
        if a >= b:
            return self.docs[:0], self.parts[:0]
        self.unpack(np.arange(a, b))
        low, high = self.places[a], self.places[b]
        low, high = low + np.searchsorted(self.docs[low:high], (first, stop))
        return self.docs[low:high], self.parts[low:high]


def best_of_shard(lists: list[tuple[int, Postings]], docs: int, best: int = BEST):
    """Places and scores of a shard's best documents, best first, smaller places first among
    equals. `lists`: (weight times repeats, postings) of an item's terms, weights above 0."""
    lists = sorted(lists, key=lambda x: x[0] * x[1].most)
    sums = np.concatenate([[0], np.cumsum([w * p.most for w, p in lists])])
    places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    least, first, width = 1, 0, FIRST_WINDOW  # `least`: what a document must reach
    while first < docs:
        stop = min(first + width, docs)
        # the lists before `inner` reach less than `least` all together
        inner = int(np.searchsorted(sums, least) - 1)
        if inner >= len(lists):
            break
        total = np.zeros(stop - first, np.int64)
        for w, postings in lists[inner:]:
            own, parts = postings.between(first, stop)
            total[own - first] += w * parts
        found = np.flatnonzero(total)
        got = total[found]
        for i in range(inner - 1, -1, -1):
            w, postings = lists[i]
            block = np.searchsorted(postings.lasts, found + first)
            inside = block < len(postings.lasts)
            most = np.zeros(len(found), np.int64)
            most[inside] = w * postings.maxima[block[inside]]
            fits = got + most + sums[i] >= least
            found, got, block, inside = found[fits], got[fits], block[fits], inside[fits]
            if not len(found):
                break
            postings.unpack(np.unique(block[inside]))
            at = np.flatnonzero(inside)
            low, high = postings.places[block[at]], postings.places[block[at] + 1]
            # places of the candidates in their blocks: blocks of one list ascend
            spot = _inside(postings, found[at] + first, low, high)
            hit = spot >= 0
            got[at[hit]] += w * postings.parts[spot[hit]]
        fits = got >= least
        places = np.concatenate([places, found[fits] + first])
        scores = np.concatenate([scores, got[fits]])
        order = np.lexsort((places, -scores))[:best]
        places, scores = places[order], scores[order]
        if len(scores) == best:
            least = int(scores[-1]) + 1  # later documents have larger places
        first, width = stop, width * 2
    return places, scores


def _inside(postings: Postings, wanted: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Where the wanted documents stand in the postings, each looked for from `low` to before
    `high`; -1 where they are not."""
    low, high = low.copy(), high - 1
    while (low < high).any():
        middle = (low + high) // 2
        less = postings.docs[middle] < wanted
        low = np.where(less, middle + 1, low)
        high = np.where(less, high, middle)
        high = np.maximum(high, low)
    return np.where(postings.docs[low] == wanted, low, -1)


def _blocks_of_items(items: DataFrame, key: str, text: str):
    """Items in bounded blocks: (key, terms with their repeats)."""
    own, size = [], 0
    for row in items.select(
        F.col(key).alias("key"), F.col(text).cast("binary").alias("text")
    ).toLocalIterator():
        own.append((row["key"], Counter(terms_of(bytes(row["text"] or b"")))))
        size += len(row["text"] or b"")
        if len(own) == ITEMS_AT_ONCE or size > ITEM_BYTES_AT_ONCE:
            yield own
            own, size = [], 0
    if own:
        yield own


def _ranker(shared, best: int):
    """Rank a shard's documents for all items of a block: (number of the item, rank, doc,
    score)."""

    def rank_shard(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        head = next(r for r in rows if r["term"] is None)
        m = np.asarray(head["norms"], np.int64)
        postings = {r["term"]: Postings(r, m) for r in rows if r["term"] is not None}
        numbers, ranks, places, found = [], [], [], []
        for number, terms in enumerate(shared.value):
            own = [(w, postings[t]) for t, w in terms if t in postings]
            if own:
                at, scores = best_of_shard(own, len(m), best)
                numbers.extend([number] * len(at))
                ranks.extend(range(1, len(at) + 1))
                places.extend(at.tolist())
                found.extend(scores.tolist())
        keys = table.column("keys").drop_null().combine_chunks().flatten()
        return pa.table({
            "number": pa.array(numbers, pa.int32()), "rank": pa.array(ranks, pa.int32()),
            "doc": keys.take(pa.array(places, pa.int64())),
            "score": pa.array(found, pa.int64()),
        })

    return rank_shard


def search(
    spark: SparkSession, path: str, items: DataFrame, best: int = BEST,
    key: str = "item_id", text: str = "text",
) -> DataFrame:
    """The best documents of the index at `path` for each row of `items`: `item` (its `key`),
    `rank` from 1, `doc` (a document's id), `score`. Fewer where fewer documents score above 0;
    equal scores by ascending id, null ids last.

    Items are taken in blocks of a bounded number and size. Null and empty items and those
    without a known term have no row; repeated items are ranked each by itself. An empty index
    or an empty table of items gives no rows. Of the index only the lists of a block's terms
    are read, and dealt out by shard.
    """
    documents, _ = spark.read.parquet(f"{path}/stats").first()
    index = spark.read.parquet(f"{path}/shards")
    kind = index.schema["keys"].dataType.elementType
    item_kind = items.schema[key].dataType
    names = f"number int, rank int, doc {kind.simpleString()}, score bigint"
    out = spark.createDataFrame(
        [], f"item {item_kind.simpleString()}, rank int, doc {kind.simpleString()}, score bigint")
    for block in _blocks_of_items(items, key, text):
        every = sorted(set().union(*(own for _, own in block)))
        wanted = F.broadcast(spark.createDataFrame([(t,) for t in every], "term binary"))
        # read by two jobs: once for the document frequencies, once for the lists
        lists = index.join(wanted, "term", "left_semi")
        holding = dict(
            (bytes(r["term"]), r["df"])
            for r in lists.groupBy("term").agg(F.sum("df").alias("df")).collect()
        )
        weights = {t: weight(documents, n) for t, n in holding.items()}
        shared = spark.sparkContext.broadcast([
            [(t, n * weights[t]) for t, n in sorted(own.items()) if weights.get(t, 0) > 0]
            for _, own in block
        ])

        heads = index.filter("term is null")
        per_shard = lists.unionByName(heads).groupBy("shard").applyInArrow(
            _ranker(shared, best), names)
        order = Window.partitionBy("number").orderBy(
            F.col("score").desc(), F.col("doc").asc_nulls_last())
        merged = per_shard.withColumn("rank", F.row_number().over(order)).filter(
            F.col("rank") <= best)
        keys = spark.createDataFrame(
            [(i, k) for i, (k, _) in enumerate(block)],
            f"number int, item {item_kind.simpleString()}")
        answer = merged.join(F.broadcast(keys), "number").select("item", "rank", "doc", "score")
        out = out.unionByName(keep(answer, "search-block"))
    return out
