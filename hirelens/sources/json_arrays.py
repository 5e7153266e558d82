"""One large JSON array read in many tasks.

The file is read in byte ranges, cut after every closing brace, wherever that brace stands.
Whether a range begins inside a string, and at which depth of brackets, is not known from the
range alone; but each range turns either beginning into an end by itself. A first pass takes
these effects, one short row per range; put one after another they give the state in which
each range begins. A second pass cuts the ranges at the commas of the outer array. Elements
that lie in several ranges are put together from their parts; all others never move.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_QUOTE = re.compile(r'(?<!\\)(?:\\\\)*"')
_MARKS = re.compile(r"[\[\]{},]")
_INSIDE, _HEAD, _MIDDLE, _TAIL = "inside", "head", "middle", "tail"


def _quoted_parts(piece: str) -> list[str]:
    """A piece cut at its quotation marks that are not escaped: every other part is a string."""
    if '"' not in piece:
        return [piece]
    return _QUOTE.split(piece)


def _depth(text: str) -> int:
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


def _pieces(batches):
    """(file, start of the range, text) of the rows of a task, in order."""
    for batch in batches:
        yield from zip(
            batch.column("file").to_pylist(), batch.column("start").to_pylist(),
            batch.column("value").to_pylist(), strict=True)


def _effects(batches):
    """Of each range: whether its quotes leave it in the other state, and by how much it
    changes the depth if it begins outside or inside a string."""
    found: dict[tuple, list[int]] = {}
    for file, start, value in _pieces(batches):
        odd, outside, inside, count = found.get((file, start), (0, 0, 0, 0))
        parts = _quoted_parts(value + "}")
        even = sum(_depth(p) for p in parts[::2])
        uneven = sum(_depth(p) for p in parts[1::2])
        if odd:
            even, uneven = uneven, even
        found[file, start] = (
            odd ^ (len(parts) + 1) % 2, outside + even, inside + uneven, count + 1)
    rows = [(*key, *effect) for key, effect in found.items()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    names = ["file", "start", "odd", "outside", "inside", "pieces"]
    types = [pa.string(), *[pa.int64()] * 5]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _cut(pieces, in_string: bool, depth: int, last: int | None):
    """Parts of the elements of one range: (kind, text). `last`: the number of the file's last
    piece in this range, after which no brace was cut off."""
    text: list[str] = []
    any_cut = False

    def done(end: str):
        nonlocal any_cut
        text.append(end)
        out = (_INSIDE if any_cut else _HEAD, "".join(text))
        any_cut = True
        text.clear()
        return out

    for number, piece in enumerate(pieces):
        whole = piece if number == last else piece + "}"
        parts = _quoted_parts(whole)
        first = 1 if in_string else 0
        out = parts[first::2]
        if depth - sum(p.count("]") + p.count("}") for p in out) > 1:
            text.append(whole)  # the outer array's own commas are out of reach
            depth += sum(map(_depth, out))
        else:
            begin, at, own = 0, 0, in_string
            for k, part in enumerate(parts):
                if not own:
                    for mark in _MARKS.finditer(part):
                        sign, place = mark.group(), at + mark.start()
                        if sign in "[{":
                            if depth == 0 and sign == "[":
                                text.clear()
                                any_cut, begin = True, place + 1
                            depth += 1
                        elif sign in "]}":
                            depth -= 1
                            if depth == 0:
                                yield done(whole[begin:place])
                                begin = place + 1
                        elif depth == 1:
                            yield done(whole[begin:place])
                            begin = place + 1
                at += len(part)
                if k + 1 < len(parts):  # the quotes, with the backslashes before them
                    at = _QUOTE.match(whole, at).end()
                    own = not own
            text.append(whole[begin:])
        in_string ^= (len(parts) + 1) % 2 == 1
    yield (_TAIL if any_cut else _MIDDLE), "".join(text)


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """The elements of JSON array files, as text in `value`, with a `position` that grows in
    reading order inside a file.

    A file is read in as many tasks as it has byte ranges of `spark.sql.files.maxPartitionBytes`.
    The driver holds a row per range. Empty elements and what stands outside the array give no
    row; an element that is no JSON is returned as it is. An empty file or array has no rows.
    """
    pieces = spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), "value",
    )
    effects = pieces.mapInArrow(
        _effects, "file string, start long, odd long, outside long, inside long, pieces long")
    ranges = defaultdict(list)
    for row in effects.collect():
        ranges[row["file"]].append(row)
    states, number = {}, 0
    for file in sorted(ranges):
        in_string, depth = 0, 0
        own = sorted(ranges[file], key=lambda r: r["start"])
        for row in own:
            last = row["pieces"] - 1 if row is own[-1] else None
            states[file, row["start"]] = (number, bool(in_string), depth, last)
            depth += row["inside"] if in_string else row["outside"]
            in_string ^= row["odd"]
            number += 1
    shared = spark.sparkContext.broadcast(states)

    def cut(batches):
        groups, order = defaultdict(list), []
        for file, start, value in _pieces(batches):
            if (file, start) not in groups:
                order.append((file, start))
                if len(order) > 1:
                    yield from _fragments(shared, order[-2], groups.pop(order[-2]))
                    groups[order[-2]] = []
            groups[file, start].append(value)
        if order:
            yield from _fragments(shared, order[-1], groups.pop(order[-1]))

    parts = pieces.mapInArrow(cut, "file string, range long, place long, kind string, value string")
    inner = parts.filter(F.col("kind") == _INSIDE)
    edges = parts.filter(F.col("kind") != _INSIDE)
    # which parts make one element: those from a range's tail up to the next range's head
    order = Window.partitionBy("file").orderBy("range", "place")
    keyed = edges.select("file", "range", "place", "kind").withColumn(
        "element", F.sum((F.col("kind") == _TAIL).cast("int")).over(order))
    whole = (
        edges.join(keyed.drop("kind"), ["file", "range", "place"])
        .groupBy("file", "element")
        .agg(
            F.array_sort(F.collect_list(F.struct("range", "place", "value"))).alias("_parts"))
        .select(
            F.array_join(F.transform("_parts", lambda p: p["value"]), "").alias("value"),
            F.get("_parts", F.lit(0))["range"].alias("range"),
            F.get("_parts", F.lit(0))["place"].alias("place"),
        )
    )
    rows = inner.select("value", "range", "place").unionByName(whole)
    return rows.filter(F.regexp_like("value", F.lit(r"\S"))).select(
        "value",
        (F.shiftleft(F.col("range"), 33) + F.col("place")).alias("position"),
    )


def _fragments(shared, key, pieces):
    """Arrow batches of a range's parts."""
    number, in_string, depth, last = shared.value[key]
    rows: list[tuple] = []
    size = 0
    for place, (kind, value) in enumerate(chain(_cut(pieces, in_string, depth, last))):
        rows.append((key[0], number, place, kind, value))
        size += len(value)
        if size > 4_000_000:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["file", "range", "place", "kind", "value"])
