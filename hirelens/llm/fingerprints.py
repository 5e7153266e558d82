"""Document fingerprints: one-permutation MinHash with optimal densification.

The shingles of a text are hashed once. The top bits of a hash choose a bin, each bin keeps
its smallest hash, and an empty bin takes over the value of a filled bin that a hash of
(bin, attempt), the same for all texts, finds first. Only the lowest bits of the values are
stored; the likeness of two fingerprints corrects for chance agreement of those bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import bounded_batches, keep, words_of

SHINGLE_WORDS = 5
BINS = 512
BITS = 4
CACHED_WORDS = 400_000
PROBES = 64
MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words; remembers a bounded number of them."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


def shingle_hashes(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of all runs of `size` words; a shorter text is one run; none without words."""
    if not len(words):
        return words
    count = max(len(words) - size + 1, 1)
    h = np.full(count, min(len(words), size), np.uint64)
    for i in range(min(len(words), size)):
        h = scramble(h + words[i:i + count])
    return h


def _probes(bins: int, first: int, count: int) -> np.ndarray:
    """The bins that an empty bin asks in its attempts, one row per bin."""
    at = np.arange(bins, dtype=np.uint64)[:, None] << np.uint64(32)
    tries = np.arange(first, first + count, dtype=np.uint64)[None, :]
    return (scramble(at + tries + np.uint64(1)) % np.uint64(bins)).astype(np.int64)


class Sketcher:
    """Fingerprints of shingle hashes, and the likeness of two of them."""

    def __init__(self, bins: int = BINS, bits: int = BITS):
        if bins & (bins - 1) or 8 % bits:
            raise ValueError("bins must be a power of two, and bits divide 8")
        self.bins, self.bits = bins, bits
        self.shift = np.uint64(64 - bins.bit_length() + 1)
        self.probes = _probes(bins, 0, PROBES)
        self.own = scramble(np.arange(1, bins + 1, dtype=np.uint64))
        self.empty = np.full(bins, 1 << bits, np.uint16)  # equals no value

    def values(self, hashes: np.ndarray) -> np.ndarray:
        """Low bits of each bin's smallest hash, empty bins filled."""
        if not len(hashes):
            return self.empty
        ordered = np.sort(hashes)
        bins = (ordered >> self.shift).astype(np.int64)
        first = np.flatnonzero(np.diff(bins, prepend=-1))
        filled = np.zeros(self.bins, bool)
        filled[bins[first]] = True
        out = np.zeros(self.bins, np.uint64)
        out[bins[first]] = ordered[first]
        left, attempt = np.flatnonzero(~filled), 0
        while len(left):
            probes = self.probes if not attempt else _probes(self.bins, attempt, PROBES)
            asked = probes[left]
            hit = filled[asked]
            place = hit.argmax(axis=1)
            found = hit[np.arange(len(left)), place]
            out[left[found]] = out[asked[found, place[found]]]
            left, attempt = left[~found], attempt + PROBES
        # the bin takes part in the low bits: one value in many bins agrees by chance in few
        low = scramble(out + self.own) & np.uint64((1 << self.bits) - 1)
        return low.astype(np.uint16)

    def text(self, values: np.ndarray) -> str:
        """Packed low bits as hex digits; an empty text's fingerprint is `empty`."""
        if values is self.empty:
            return "empty"
        per = 8 // self.bits
        packed = np.zeros(self.bins // per, np.uint8)
        for i in range(per):
            packed |= values[i::per].astype(np.uint8) << np.uint8(self.bits * i)
        return packed.tobytes().hex()

    def read(self, text: str) -> np.ndarray:
        if text == "empty":
            return self.empty
        packed = np.frombuffer(bytes.fromhex(text), np.uint8)
        per = 8 // self.bits
        out = np.zeros(self.bins, np.uint16)
        for i in range(per):
            out[i::per] = packed >> np.uint8(self.bits * i) & np.uint8((1 << self.bits) - 1)
        return out

    def likeness(self, a: np.ndarray, b: np.ndarray) -> float:
        """Estimated Jaccard similarity: agreement less what chance gives, from 0 to 1. Two
        empty texts are alike, an empty one is unlike any other."""
        if a is self.empty or b is self.empty:
            return float(a is b)
        chance = 2.0**-self.bits
        return float(max(0.0, ((a == b).mean() - chance) / (1 - chance)))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the next text's beginning."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


OUT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def fingerprint_neighbours(
    docs: DataFrame, bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE_WORDS
) -> DataFrame:
    """Fingerprint every text (`doc_id`, `text`; null: empty) and its edited text.

    The next document is the one of the next smaller doc_id; after the last comes the first.
    Rows of one doc_id follow each other by content, a null doc_id comes last. A text
    without words has the fingerprint `empty`. A single row is its own next document. An
    empty table gives an empty frame; other columns are not read. Returns `OUT`.

    Rows are range-partitioned by doc_id once and read in order, one text ahead. What a
    task cannot know, the first text of the next task, is joined afterwards: two rows per
    task. A doc_id that fills a large share is spread by the content's hash.
    """
    bounded_batches(docs.sparkSession)
    body = F.coalesce(F.col("text"), F.lit(""))
    order = [F.col("doc_id").desc_nulls_last(), F.col("mixed")]
    rows = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("text"))
        .withColumn("mixed", F.xxhash64("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, "text")
        .select("doc_id", "text")
    )

    def tools():
        return WordHashes(), Sketcher(bins, bits)

    def describe(words, sketcher, doc_id, text, following, own, next_values):
        changed = edited(text, following)
        values = sketcher.values(shingle_hashes(words.of(words_of(changed)), shingle))
        return (
            doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(),
            sketcher.text(own), sketcher.text(values), sketcher.likeness(own, values),
            sketcher.likeness(own, next_values),
        )

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
             pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sketcher = tools()
        part, before = TaskContext.get().partitionId(), None
        edge = lambda doc_id, text, kind: (doc_id, *[None] * 6, kind, part, text)
        schema = pa.schema([*zip(names, kinds), ("edge", pa.string()), ("part", pa.int32()),
                            ("text", pa.string())])

        def batch(out):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema
            )

        for incoming in batches:
            out = []
            ids, texts = (incoming.column(i).to_pylist() for i in range(2))
            for doc_id, text in zip(ids, texts):
                own = sketcher.values(shingle_hashes(words.of(words_of(text)), shingle))
                if before is None:
                    out.append(edge(doc_id, text, "first"))
                else:
                    done = describe(words, sketcher, *before[:2], text, before[2], own)
                    out.append((*done, None, None, None))
                before = doc_id, text, own
            if out:
                yield batch(out)
        if before is not None:
            yield batch([edge(before[0], before[1], "last")])

    walked = keep(
        rows.mapInArrow(walk, f"{OUT}, edge string, part int, text string"), "fingerprints"
    )
    firsts = walked.filter("edge = 'first'").select("part", F.col("text").alias("following"))
    everything = Window.partitionBy(F.lit(0))
    parts = firsts.select("part").select(
        F.col("part").alias("to"),
        F.coalesce(
            F.lag("part").over(everything.orderBy("part")), F.max("part").over(everything)
        ).alias("part"),
    )
    pairs = (
        walked.filter("edge = 'last'")
        .select("doc_id", "text", "part")
        .join(parts, "part")
        .join(firsts.withColumnRenamed("part", "to"), "to")
        .select("doc_id", "text", "following")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sketcher = tools()
        for incoming in batches:
            out = []
            for doc_id, text, following in zip(*(c.to_pylist() for c in incoming.columns)):
                own, other = (
                    sketcher.values(shingle_hashes(words.of(words_of(t)), shingle))
                    for t in (text, following)
                )
                out.append(describe(words, sketcher, doc_id, text, following, own, other))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names
                )

    inner = walked.filter("edge is null").select(*names)
    return inner.unionByName(pairs.mapInArrow(finish, OUT))
