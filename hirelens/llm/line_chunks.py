"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of the last lines decides after which line a chunk ends, so
boundaries move with the text and not with its position. Chunks of several lines that occur
again anywhere are removed, after their bytes have been compared.

A chunk is found only where both its ends fall inside what is shared. `remove_repeated_runs`
therefore also looks at every line with its neighbour, so that no repeated run of lines is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import bounded_batches, keep

WINDOW = 2
LEAST_LINES = 2
MOST_LINES = 64
DIVISOR = 3
LONG_LINE_WORDS = 50
BASE = 0x100000001B3
MASK = (1 << 64) - 1


def chunk_spans(
    lines: list[str], window: int = WINDOW, divisor: int = DIVISOR,
    least: int = LEAST_LINES, most: int = MOST_LINES,
) -> list[tuple[int, int]]:
    """Spans of lines between content-defined boundaries.

    The rolling hash covers `window` lines: each new line enters, the oldest one leaves. A
    chunk ends where its high bits divide, has at least `least` lines, and at most `most`.
    """
    spans, start, rolling = [], 0, 0
    out = pow(BASE, window, 1 << 64)
    hashes = [xxhash.xxh64_intdigest(line) for line in lines]
    for i, entered in enumerate(hashes):
        rolling = (rolling * BASE + entered) & MASK
        if i >= window:
            rolling = (rolling - hashes[i - window] * out) & MASK
        size = i + 1 - start
        if size >= most or size >= least and (rolling >> 32) % divisor == 0:
            spans.append((start, i + 1))
            start = i + 1
    if start < len(lines):
        spans.append((start, len(lines)))
    return spans


def chunk_passages(lines: list[str], *rule: int) -> Iterator[tuple[int, int]]:
    """Chunks of at least two lines with a letter or digit in them."""
    for a, b in chunk_spans(lines, *rule):
        if b - a > 1 and any(c.isalnum() for line in lines[a:b] for c in line):
            yield a, b


def run_passages(lines: list[str], long_line: int = LONG_LINE_WORDS) -> set[tuple[int, int]]:
    """The chunks, and what every repeated run of lines is made of.

    These are each line with the next one, each line with letters or digits with the next such
    line and what lies between, and each line of over `long_line` words by itself.
    """
    found = set(chunk_passages(lines))
    last = None
    for i, line in enumerate(lines):
        if not any(c.isalnum() for c in line):
            if last == i - 1 and i:
                found.add((i - 1, i + 1))
            continue
        if i:
            found.add((i - 1, i + 1))
        if last is not None:
            found.add((last, i + 1))
        if len(line) > long_line and len(line.split()) > long_line:
            found.add((i, i + 1))
        last = i
    return found


def remove_repeated(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    window: int = WINDOW, divisor: int = DIVISOR, least: int = LEAST_LINES,
    most: int = MOST_LINES,
) -> DataFrame:
    """Remove chunks of at least two lines that occurred before, in any text.

    A shared passage goes as far as whole chunks lie in it. One-line chunks stay, as do chunks
    without a letter or digit. Rows and columns are those of `remove_passages`.
    """
    return remove_passages(
        docs, lambda lines: chunk_passages(lines, window, divisor, least, most), key, text
    )


def remove_repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove every run of at least two lines that occurred before, in any text, and every
    line of over 50 words that did.

    A run is found at any place and length, as each two neighbouring lines of it occurred
    before. Runs without a letter or digit stay; so do further lines without one at the ends
    of a run, and shorter lines that are repeated alone. Rows and columns are those of
    `remove_passages`.
    """
    return remove_passages(docs, run_passages, key, text)


def remove_passages(
    docs: DataFrame, passages: Callable[[list[str]], Iterator[tuple[int, int]]],
    key: str = "doc_id", text: str = "text", bits: int = 64,
) -> DataFrame:
    """Remove passages (spans of lines) that occurred before, in any text.

    Returns one row per input row: `doc_id` (the key), `text` without the removed lines,
    `lines`, `removed_lines`, `removed` (spans of line numbers, from 0, end excluded; spans
    that touch are one). The first occurrence, by key and then place, stays; a null key comes
    first, and rows of one key follow each other by a hash of the text; rows repeated with key
    and text count as one text and are treated alike. A passage that overlaps its own first
    occurrence is no repeat. A line stays at least where it stands first. A null text stays
    null and has no lines; an empty text has one empty line. An empty table gives an empty
    frame; other columns are not read.

    Narrow rows (hash and place) are counted first, merged before the shuffle. Only texts
    with a repeated hash send passages on, each content once per task, to compare the bytes of
    a hash: if one hash had two contents, another salt is taken and all is done again.
    Frequent passages are split by adaptive execution.
    """
    bounded_batches(docs.sparkSession)
    source = docs.select(
        F.col(key).alias("doc_id"), F.xxhash64(key, text).alias("same"), F.col(text).alias("text")
    )
    for salt in count():
        asked = _asked(source, passages, salt, bits)
        if _one_content_each(source, asked, passages):
            return _without(source, asked)


def _same_text(key: str, same: str):
    return F.col("doc_id").eqNullSafe(F.col(key)) & (F.col("same") == F.col(same))


def _asked(source: DataFrame, passages, salt: int, bits: int) -> DataFrame:
    """Of each text the passages whose hash occurs again, and whether they go."""
    kind = source.schema["doc_id"].dataType.simpleString()

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, stops, hashes = [], [], [], []
            for i, body in enumerate(batch.column("text").to_pylist()):
                lines = (body or "").split("\n")
                for a, b in passages(lines):
                    ids.append(i)
                    starts.append(a)
                    stops.append(b)
                    digest = xxhash.xxh64_intdigest("\n".join(lines[a:b]), salt)
                    hashes.append((digest >> (64 - bits)) - (1 << 63))
            at = pa.array(ids, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("same").take(at),
                 pa.array(starts, pa.int32()), pa.array(stops, pa.int32()),
                 pa.array(hashes, pa.int64())],
                names=["doc_id", "same", "start", "stop", "hash"],
            )

    found = keep(
        source.mapInArrow(
            places, f"doc_id {kind}, same bigint, start int, stop int, hash bigint"
        ),
        "line-passages",
    )
    place = F.struct("doc_id", "same", "start")
    repeated = keep(
        found.groupBy("hash").agg(
            F.min(place).alias("first"), F.count(F.lit(1)).alias("times")
        ).filter("times > 1").drop("times"),
        "line-repeated",
    )
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (
        F.col("same") == F.col("first.same")
    )
    goes = ~own | (F.col("start") - F.col("first.start") >= F.col("stop") - F.col("start"))
    return keep(
        found.join(repeated, "hash")
        .withColumn("goes", goes)
        .groupBy(F.col("doc_id").alias("k"), F.col("same").alias("s"))
        .agg(F.collect_set(F.struct("start", "stop", "hash", "goes")).alias("asked")),
        "line-asked",
    )


def _one_content_each(source: DataFrame, asked: DataFrame, passages) -> bool:
    """Whether all passages of a repeated hash have the same bytes."""

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, bodies = [], []
            for body, wanted in zip(
                batch.column("text").to_pylist(), batch.column("asked").to_pylist()
            ):
                lines = (body or "").split("\n")
                for w in wanted:
                    hashes.append(w["hash"])
                    bodies.append("\n".join(lines[w["start"]:w["stop"]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.int64()), pa.array(bodies, pa.string())],
                names=["hash", "passage"],
            )

    known = source.join(asked, _same_text("k", "s")).select("text", "asked")
    seen = known.mapInArrow(contents, "hash bigint, passage string").distinct()
    return seen.groupBy("hash").count().filter("count > 1").isEmpty()


def _without(source: DataFrame, asked: DataFrame) -> DataFrame:
    """The texts without the passages that go."""
    kind = source.schema["doc_id"].dataType.simpleString()
    spans_type = "array<struct<start:int,stop:int>>"

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_of = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            out = []
            for wanted in batch.column("asked").to_pylist():
                spans: list[dict] = []
                for a, b in sorted((w["start"], w["stop"]) for w in wanted if w["goes"]):
                    if spans and a <= spans[-1]["stop"]:
                        spans[-1]["stop"] = max(spans[-1]["stop"], b)
                    else:
                        spans.append({"start": a, "stop": b})
                out.append(spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("s"), pa.array(out, spans_of)],
                names=["k", "s", "removed"],
            )

    removed = asked.mapInArrow(merge, f"k {kind}, s bigint, removed {spans_type}").filter(
        F.size("removed") > 0
    )
    lines = F.split("text", "\n")
    spans = F.coalesce("removed", F.expr("array()").cast(spans_type))
    joined = source.join(removed, _same_text("k", "s"), "left").withColumn("removed", spans)
    gone = F.aggregate("removed", F.lit(0), lambda n, s: n + s["stop"] - s["start"])
    # the lines between removed spans
    starts = F.concat(F.array(F.lit(0)), F.transform("removed", lambda s: s["stop"]))
    stops = F.concat(F.transform("removed", lambda s: s["start"]), F.array(F.size(lines)))
    left = F.flatten(
        F.transform(
            F.arrays_zip(starts.alias("a"), stops.alias("b")),
            lambda s: F.slice(lines, s["a"] + 1, s["b"] - s["a"]),
        )
    )
    text_left = F.when(F.size("removed") == 0, F.col("text")).otherwise(F.array_join(left, "\n"))
    return joined.select(
        "doc_id",
        F.when(F.col("text").isNotNull(), text_left).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).alias("lines"),
        gone.alias("removed_lines"),
        "removed",
    )
