"""Packing documents into fixed-length token sequences: shortest-pack-first over the
length histogram.

The histogram has at most one entry per length, so the packing itself is planned from a
bounded table, whatever the number of documents: lengths from the longest to the shortest
go to the pattern with the most room, and what changes are counts of patterns. Documents
then take the places of their length by rank.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import bounded_batches, keep, learned, ranked, slices_for

MOST_TOKENS = 4096
END_ID = 2
CACHED_PIECES = 100_000
BATCH_ROWS = 4000
PIECES = (
    "row bigint, doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint"
)


# fixed values: the vocabulary's cut of a lower-case Latin-1 word into pieces that it merges
# apart; the letters and numbers are those of the classes L and N
PIECE = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    r"|[^\sa-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+"
)
PLAIN = re.compile(r"[\x21-\x7e\xa1-\xac\xae-\xff]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte as a letter: printable Latin-1 as itself, the
    others in order from 256 on."""
    printable = {b for b in range(256) if PLAIN.fullmatch(chr(b))}
    others = iter(range(256, 512))
    return {b: chr(b if b in printable else next(others)) for b in range(256)}


class Remembered(dict):
    """What `learn` returns for a key, remembered for at most twice `most` keys: when `most`
    are held they become the older ones, and an older key is held again once it is asked for.
    So keys that keep coming stay, and what comes once goes."""

    def __init__(self, learn: Callable[[str], bytes], most: int):
        self.learn, self.most, self.older = learn, most, {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.learn(key)
        if len(self) >= self.most:
            self.older = self.copy()
            self.clear()
        self[key] = found
        return found


def _encoder(path: str, most: int = CACHED_PIECES):
    """Token ids of the whole texts of an Arrow column: all ids, and where each text's end.

    The vocabulary drops white space and merges inside words only, so a text's ids are its
    words' ids one after the other. Each word of a batch is looked at once, however often it
    comes there. Plain Latin-1 words are cut into lower-case pieces, which go to the merges
    directly; anything else, where normalising could matter, goes through the whole
    tokenizer. Each worker remembers a bounded number of pieces.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    merges, letters = tokenizer.model, _byte_letters()
    numbers = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]

    def learn(piece: str) -> bytes:
        if piece.isascii() and piece.isalpha():
            return b"".join([numbers[token.id] for token in merges.tokenize(piece)])
        if not PLAIN.fullmatch(piece) or "<|" in piece:
            ids = tokenizer.encode(piece, add_special_tokens=False).ids
            return b"".join([numbers[i] for i in ids])
        shown = piece.encode().decode("latin-1").translate(letters)
        return b"".join([numbers[token.id] for token in merges.tokenize(shown)])

    known = Remembered(learn, most)

    def word_ids(word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return known[word.lower()]
        if not PLAIN.fullmatch(word) or "<|" in word:
            return known[word]
        lower = word.lower()
        if lower.isalpha():
            return known[lower]
        return b"".join([known[piece] for piece in PIECE.findall(lower)])

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = pc.dictionary_encode(words.flatten())
        own = list(map(word_ids, coded.dictionary.to_pylist()))
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        starts = np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy()
        counts = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(counts)])
        at = np.repeat(starts[codes] - ends[:-1], counts) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(own), "<u4")[at]
        return ids, ends[np.cumsum(pc.list_value_length(words).to_numpy())]

    return encode


def tokenize(
    docs: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    most: int = MOST_TOKENS,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of at most `most` ids of every document, with the ids as little-endian
    unsigned 32-bit numbers. A null text counts as empty; a document is its text's ids and
    `end_id`, so none is without a piece. `row` numbers the input rows of one run."""
    bounded_batches(docs.sparkSession, rows=BATCH_ROWS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = learned(tokenizer_path, lambda: _encoder(tokenizer_path))
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out, begin = [], 0
            every, ends = encode(batch.column(2))
            rows, keys = (batch.column(i).to_pylist() for i in range(2))
            for row, doc, stop in zip(rows, keys, ends.tolist()):
                ids = every[begin:stop].tobytes() + end
                begin, count = stop, len(ids) // 4
                for start in range(0, count, most):
                    part = ids[4 * start:4 * (start + most)]
                    out.append((row, doc, start, len(part) // 4, part, count))
            kinds = [pa.int64()] * 4 + [pa.binary(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            if columns:
                names = ["row", "doc_id", "start", "length", "ids", "doc_tokens"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
    ).mapInArrow(cut, PIECES)


def pack_patterns(histogram: Mapping[int, int], most: int) -> list[tuple[tuple, int]]:
    """Shortest-pack-first: a list of (pattern, count).

    A pattern is a chain ((...), length, times): the lengths placed before, and `times`
    pieces of one length after them. Lengths are placed from the longest; each goes to the
    shortest pack that has room, as many packs at once as there are alike.
    """
    open_packs: dict[int, list[tuple[tuple, int]]] = defaultdict(list)  # by room left
    closed: list[tuple[tuple, int]] = []
    rooms: list[int] = []  # rooms in use, sorted

    def put(room: int, pattern: tuple, count: int) -> None:
        if room == 0:
            closed.append((pattern, count))
            return
        if not open_packs[room]:
            rooms.insert(int(np.searchsorted(rooms, room)) if rooms else 0, room)
        open_packs[room].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if rooms and rooms[-1] >= length:
                room = rooms[-1]
                pattern, count = open_packs[room].pop()
                if not open_packs[room]:
                    rooms.pop()
                # as many of this length as keep it the emptiest pack, at once
                second = rooms[-1] if rooms else 0
                times = 1
                if left >= count:
                    times = max(1, min(left // count, (room - max(second, length)) // length + 1))
                    times = min(times, room // length)
                used = min(count, left)
                if used < count:
                    put(room, pattern, count - used)
                put(room - times * length, (pattern, length, times), used)
                left -= used * times
            else:
                times = min(left, most // length)
                whole = left // times
                put(most - times * length, ((), length, times), whole)
                left -= whole * times
    for room in rooms:
        closed.extend(open_packs[room])
    return closed


def place_table(patterns: list[tuple[tuple, int]], most: int) -> dict[str, np.ndarray]:
    """Where the pieces of each length go: runs of ranks of a length with the sequence,
    offset and repeats of the run. Sorted by (length, first rank)."""
    runs, sequence = [], 0
    for pattern, count in patterns:
        chain = []
        while pattern:
            pattern, length, times = pattern
            chain.append((length, times))
        offset = 0
        for length, times in reversed(chain):
            runs.append((length, sequence, count, offset, times))
            offset += length * times
        sequence += count
    runs.sort(key=lambda run: run[0])
    table = np.array(runs, dtype=np.int64).reshape(-1, 5)
    pieces = table[:, 2] * table[:, 4]
    ends = np.cumsum(pieces)
    length_start = np.searchsorted(table[:, 0], table[:, 0], side="left")
    before = np.concatenate([[0], ends])[length_start]
    return {
        "length": table[:, 0], "first": ends - pieces - before, "sequence": table[:, 1],
        "offset": table[:, 3], "times": table[:, 4],
    }


def pack(pieces: DataFrame, most: int = MOST_TOKENS) -> DataFrame:
    """Add `sequence_id` and `offset` to pieces (`row`, `start`, `length` from 1 to `most`).

    All other columns are carried along. `pieces` is read twice and should be stored. The
    pieces of a length, however many, are ranked in hashed slices. The place table has a
    bound set by `most` alone (lengths and patterns, not documents); it goes to every task.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    table = place_table(pack_patterns(histogram, most), most)
    # one sorted key for (length, rank): lengths start where those before them end
    starts = np.zeros(most + 2, dtype=np.int64)
    counts = np.zeros(most + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    starts[1:] = np.cumsum(counts)
    table["key"] = starts[table["length"]] + table["first"]
    shared = pieces.sparkSession.sparkContext.broadcast((starts, table))
    order = ["row", "start"]
    by_length = ranked(
        pieces, ["length"], order, slices_for(sum(histogram.values())), "rank"
    )
    fields = [f for f in by_length.schema.fields if f.name != "rank"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    schema += ", sequence_id bigint, offset bigint"

    def place(batches):
        starts, t = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            run = np.searchsorted(t["key"], starts[length] + rank, side="right") - 1
            inside = rank - t["first"][run]
            sequence = t["sequence"][run] + inside // t["times"][run]
            offset = t["offset"][run] + inside % t["times"][run] * length
            names = [f.name for f in fields]
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    return by_length.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    most: int = MOST_TOKENS,
    end_id: int = END_ID,
    keep_ids: bool = True,
) -> DataFrame:
    """Pack whole documents into sequences of at most `most` tokens.

    Returns one row per piece: `row`, `doc_id`, `start` (ids of its document before it),
    `length`, `ids` (if kept), `ids_crc32`, `doc_tokens`, `sequence_id`, `offset`. Long
    documents are cut after every `most` ids; full pieces fill a sequence alone. Null and
    empty texts are the end id only; null keys stay null and repeated rows are packed each
    for itself (`row` tells them apart). An empty table gives an empty frame. Other columns
    are not read.
    """
    pieces = tokenize(docs, tokenizer_path, key, text, most, end_id).withColumn(
        "ids_crc32", F.crc32("ids")
    )
    stored = keep(pieces if keep_ids else pieces.drop("ids"), "pack-pieces")
    return pack(stored, most)


def token_path(spark: SparkSession, path: str | None = None) -> str:
    """The vocabulary file; by default the installed public one."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
