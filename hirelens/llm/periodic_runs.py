"""Periodic runs of words, found on a grammar of each document.

A run is a stretch of consecutive words with smallest period q (words q apart are the same),
of at least max(6, 4 q) words, that no neighbouring word extends.

Re-Pair replaces repeated pairs of symbols by nonterminals, pass by pass: in each pass a pair
that a document holds more than once is replaced wherever no overlapping pair is more
frequent. Documents of an Arrow batch are treated side by side, each with symbols of its own.
What is left of a document is its top sequence. A run lies inside the text of one nonterminal,
or crosses a boundary of the top sequence; inside a nonterminal it lies in one of the two
halves or crosses the boundary between them. So the runs that cross a boundary are looked for
once for each nonterminal, at one of its places, and once for each boundary of the top
sequences; those of a nonterminal are moved to all its places, and the intervals of one period
that overlap by a period or more are merged.

At a boundary the longer side of a run holds two periods, so the 2^j words next to the
boundary, for 2^j <= q < 2^(j+1), come again q words on. Stretches of 2^j words get numbers by
doubling, equal for equal words of one document, and only stretches that come more than once
are carried on; equal numbers at a distance in that range are the candidates.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from hirelens.llm.common import bounded_batches, whole_row

LEAST_WORDS = 6
LEAST_PERIODS = 4
FAR_WORDS = 24  # compared before a candidate is followed by itself


def numbered_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number from 0 for each distinct key, how often each occurs, and the places by key."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.empty(len(keys), bool)
    new[:1] = True
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    number = np.cumsum(new) - 1
    out = np.empty(len(keys), np.int64)
    out[order] = number
    return out, np.bincount(number), order


def _chosen(places: np.ndarray, weight: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Which of the pairs at `places` a pass replaces: those that no overlapping pair beats.
    Ties go to the larger pair number; a pair that overlaps itself is taken at every other
    place."""
    overlap = places[1:] == places[:-1] + 1
    wins = np.ones(len(places), bool)
    heavier = (weight[1:] > weight[:-1]) | (
        (weight[1:] == weight[:-1]) & (which[1:] > which[:-1]))
    same = overlap & (which[1:] == which[:-1])
    wins[:-1] &= ~(overlap & heavier)
    wins[1:] &= ~overlap | heavier | same
    index = np.arange(len(places))
    head = np.where(np.append(False, same), 0, index)
    return wins & ((index - np.maximum.accumulate(head)) % 2 == 0)


def repair(symbols: np.ndarray, docs: np.ndarray) -> tuple[list[tuple], np.ndarray]:
    """Re-Pair of documents side by side. `symbols`: numbers that no two documents share.

    Returns the passes, each (nonterminal, start, middle, end) of every replaced pair in
    words, and the starts of the symbols that are left. Where a pair occurs once, no repeated
    pair can arise later, whatever its symbols go into: symbols between two such places are
    set aside.
    """
    sequence, starts = symbols.copy(), np.arange(len(symbols))
    ends = starts + 1
    following = int(symbols.max(initial=-1)) + 1
    passes, tops = [], []
    live = np.append(docs[1:] == docs[:-1], False)[:len(symbols)]  # the place after a symbol
    while len(sequence):
        places = np.flatnonzero(live)
        pair, times, _ = numbered_keys(sequence[places] * following + sequence[places + 1])
        often = times[pair]
        live[places] = again = often > 1
        places, pair, often = places[again], pair[again], often[again]
        stay = np.ones(len(sequence), bool)
        if len(places):
            took = _chosen(places, often, pair)
            at = places[took]
            made = following + pair[took]
            following += len(times)
            passes.append((made, starts[at], starts[at + 1], ends[at + 1]))
            sequence[at], ends[at], live[at] = made, ends[at + 1], live[at + 1]
            stay[at + 1] = False
        sequence, starts, ends, live = sequence[stay], starts[stay], ends[stay], live[stay]
        stay = live | np.append(False, live[:-1])
        tops.append(starts[~stay])
        sequence, starts, ends, live = sequence[stay], starts[stay], ends[stay], live[stay]
    return passes, np.sort(np.concatenate(tops)) if tops else starts


def _stretch(words: np.ndarray, place: int, period: int, low: int, high: int) -> tuple[int, int]:
    """The longest stretch in [low, high) with the period, around the equal words `place` and
    `place + period`."""
    size, end = 32, place + 1
    while True:  # to the right, in growing steps
        top = min(end + size, high - period)
        if end >= top:
            break
        other = np.flatnonzero(words[end:top] != words[end + period:top + period])
        if len(other):
            end += int(other[0])
            break
        end, size = top, size * 4
    size, start = 32, place
    while True:
        bottom = max(start - size, low)
        if start <= bottom:
            break
        other = np.flatnonzero(words[bottom:start] != words[bottom + period:start + period])
        if len(other):
            start = bottom + int(other[-1]) + 1
            break
        start, size = bottom, size * 4
    return start, end + period


def _next_to(words, at, low, high):
    """Boundaries with two equal words on one side: period 1."""
    sides = []
    for side, start in ((1, at), (-1, at - 2)):
        index = np.flatnonzero((start >= low) & (start + 2 <= high))
        index = index[words[start[index]] == words[start[index] + 1]]
        sides.append((index, np.ones_like(index), start[index], np.full(len(index), side)))
    return map(np.concatenate, zip(*sides, strict=True))


def _candidates(words, at, low, high, index, period, place, side) -> np.ndarray:
    """Rows (boundary, period, place with an equal word a period on, start and end of the
    words beside the boundary that must have the period). The longer side of a run holds at
    least 3 words and two periods: its farthest words must fit too."""
    span = np.maximum(LEAST_WORDS // 2, 2 * period) - period
    first = np.where(side > 0, at[index], at[index] - period - span)
    fits = np.flatnonzero((first >= low[index]) & (first + span + period <= high[index]))
    for i in range(FAR_WORDS):
        away = np.minimum(i, span[fits] - 1)
        spot = np.where(side[fits] > 0, first[fits] + span[fits] - 1 - away, first[fits] + away)
        fits = fits[words[spot] == words[spot + period[fits]]]
    return np.stack([index, period, place, first, first + span + period], axis=1)[fits]


def crossing(
    words: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray
) -> list[tuple[int, int, int, int]]:
    """Runs in [low, high) that cross the boundary before the word `at`, for each boundary:
    (number of the boundary, start, end, period). `words`: numbers that no two documents share.
    A stretch may also be listed with multiples of its smallest period."""
    total, longest = len(words), int(np.max(high - low, initial=0))
    found = [_candidates(words, at, low, high, *_next_to(words, at, low, high))]
    pair, size = words, 1
    places = np.arange(total)  # starts of the stretches that come more than once
    number = np.full(total, -1)
    sides = {1: np.arange(len(at)), -1: np.arange(len(at))}  # boundaries still looked at
    while len(places) and 2 * size * LEAST_PERIODS <= longest:
        again = np.bincount(pair)[pair] > 1
        number[places] = np.where(again, pair, -1)
        places = places[again]
        places = places[places + size < total]
        places = places[number[places + size] >= 0]
        names = number[places] * (total + 1) + number[places + size]
        size *= 2
        pair, _, order = numbered_keys(names)
        number[:] = -1
        number[places] = pair
        key = pair[order] * (total + 1) + places[order]
        # the stretch after the boundary comes again further on; that before it came earlier
        for side, index in sides.items():
            start = at[index] if side > 0 else at[index] - size
            inside = (start >= low[index]) & (start + size <= high[index])
            index, start = index[inside], start[inside]
            sides[side] = index = index[number[start] >= 0]
            x = at[index] if side > 0 else at[index] - size
            own = number[x] * (total + 1)
            if side > 0:
                first = own + x + size
                stop = own + np.minimum(x + 2 * size, high[index] - size + 1)
            else:
                first = own + np.maximum(x - 2 * size + 1, low[index])
                stop = own + x - size + 1
            a, b = np.searchsorted(key, first), np.searchsorted(key, stop)
            many = np.maximum(b - a, 0)
            who = np.repeat(np.arange(len(index)), many)
            step = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)
            other = key[a[who] + step] - own[who]
            found.append(_candidates(
                words, at, low, high, index[who], np.abs(other - x[who]),
                np.minimum(other, x[who]), np.full(len(who), side),
            ))
    found = np.unique(np.concatenate(found), axis=0).tolist()
    out, seen, here = [], [], -1
    for i, q, p, first, last in found:  # by boundary, then period
        if i != here:
            here, seen = i, []
        if any(q % least == 0 and a <= first and last <= b for least, a, b in seen):
            continue  # the same stretch, and a multiple of its period
        start, end = _stretch(words, p, q, int(low[i]), int(high[i]))
        seen.append((q, start, end))
        if end - start >= max(LEAST_WORDS, LEAST_PERIODS * q) and start < at[i] < end:
            out.append((i, start, end, q))
    return out


def merged(intervals: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Maximal runs (start, end, period) from stretches inside them, of one document."""
    by_period = defaultdict(list)
    for start, end, q in intervals:
        by_period[q].append((start, end))
    smallest: dict[tuple[int, int], int] = {}
    for q, own in by_period.items():
        own.sort()
        low, high = own[0]
        joined = []
        for start, end in own[1:]:
            if start <= high - q:
                high = max(high, end)
            else:
                joined.append((low, high))
                low, high = start, end
        joined.append((low, high))
        for place in joined:
            smallest[place] = min(q, smallest.get(place, q))
    return sorted((start, end, q) for (start, end), q in smallest.items())


def runs_of(ids: np.ndarray, lengths: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (start, end, period) of each document that has any; `ids` are the documents' words
    one after another, `lengths` their numbers."""
    docs = np.repeat(np.arange(len(lengths)), lengths)
    words, _, _ = numbered_keys(docs * (int(ids.max(initial=0)) + 1) + ids)
    first = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    passes, tops = repair(words, docs)
    at, low, high, symbol = [], [], [], []
    for made, start, middle, end in passes:
        _, one = np.unique(made, return_index=True)
        at.append(middle[one])
        low.append(start[one])
        high.append(end[one])
        symbol.append(made[one])
    inner = tops[tops > first[docs[tops]]] if len(tops) else tops
    at.append(inner)
    low.append(first[docs[inner]])
    high.append(first[docs[inner] + 1])
    symbol.append(np.full(len(inner), -1))
    at, low, high, symbol = map(np.concatenate, (at, low, high, symbol))
    out = defaultdict(list)
    of_symbol = defaultdict(list)
    for i, start, end, q in crossing(words, at, low, high):
        if symbol[i] < 0:
            d = int(docs[start])
            out[d].append((start - int(first[d]), end - int(first[d]), q))
        else:
            of_symbol[int(symbol[i])].append((start - int(low[i]), end - int(low[i]), q))
    if of_symbol:
        wanted = np.fromiter(of_symbol, np.int64, len(of_symbol))
        for made, start, _, _ in passes:
            for k in np.flatnonzero(np.isin(made, wanted)):
                d = int(docs[start[k]])
                base = int(start[k]) - int(first[d])
                out[d].extend(
                    (base + s, base + e, q) for s, e, q in of_symbol[int(made[k])]
                )
    return {d: merged(own) for d, own in out.items()}


def repeated_tail(words: list, doc_id: int | None) -> list:
    """The words as the query takes them: every tenth document, by a hash of its id, repeats
    a stretch of its words to its end. A null id changes nothing."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * -(-(n - a) // p))[:n - a]


class _Numbers(dict):
    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def find_runs(
    docs: DataFrame, text: str = "text", key: str = "doc_id", change=None, keep_text: bool = True
) -> DataFrame:
    """Add to every row of `docs`, all of it under `doc`: `words` (their number), `runs`
    (start, length, period; by start, then period) and, if `keep_text`, `collapsed`, the words
    that no run holds after its first period, joined by one space; `collapsed_sha256` of it.
    `change(words, key)` may replace the words first.

    Words are what stands between space, tab, line feed, vertical tab, form feed and carriage
    return. Null and empty texts have no words and no run; repeated rows stay; an empty table
    gives an empty one; columns of any name may stand in `docs`. Whole texts are treated, an
    Arrow batch at a time, without a shuffle.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        whole_row(docs), F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    run = StructType().add("start", "long").add("length", "long").add("period", "long")
    schema = rows.select("doc").schema.add("words", "long").add(
        "runs", ArrayType(run)).add(
        "collapsed", "string").add("collapsed_sha256", "string")
    kind = pa.list_(pa.struct(
        [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches):
        for batch in batches:
            texts = [(t or b"").split() for t in batch.column("text").to_pylist()]
            if change:
                texts = [
                    change(words, k)
                    for words, k in zip(texts, batch.column("key").to_pylist(), strict=True)
                ]
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            numbers = _Numbers()
            ids = np.fromiter(
                map(numbers.__getitem__, chain.from_iterable(texts)), np.int64,
                int(lengths.sum()),
            )
            found = runs_of(ids, lengths)
            runs, collapsed, digests = [], [], []
            for i, words in enumerate(texts):
                own = found.get(i, [])
                runs.append([
                    {"start": s, "length": e - s, "period": q}
                    for s, e, q in sorted(own, key=lambda r: (r[0], r[2]))
                ])
                if own:
                    gone = np.zeros(len(words), bool)
                    for s, e, q in own:
                        gone[s + q:e] = True
                    words = [words[k] for k in np.flatnonzero(~gone)]
                joined = b" ".join(words)
                digests.append(hashlib.sha256(joined).hexdigest())
                collapsed.append(joined.decode() if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(lengths, pa.int64()), pa.array(runs, kind),
                 pa.array(collapsed, pa.string()), pa.array(digests, pa.string())],
                names=["doc", "words", "runs", "collapsed", "collapsed_sha256"],
            )

    return rows.mapInArrow(work, schema)


def run_report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per row of `find_runs`: its id, the number of runs, the longest one and the
    digests. Of equally long runs the first counts, then that of the smallest period."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r.length).alias("less"), r.start.alias("start"), r.period.alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return (
        found.withColumn("_longest", longest)
        .select(
            F.col(f"doc.{key}").alias(key),
            F.size("runs").cast("long").alias("n_runs"),
            F.col("_longest.start").alias("start"),
            (-F.col("_longest.less")).alias("length"),
            F.col("_longest.period").alias("period"),
            F.expr("-_longest.less * 1000 div _longest.period").alias("exponent_milli"),
            F.sha2(lines, 256).alias("runs_sha256"),
            "collapsed_sha256",
        )
    )
