"""SentencePiece encoding by a table of prefixes' last tokens.

The model is a merge-type (BPE) one: of all neighbouring symbols whose joined text is a piece,
the pair with the best score is merged first, the leftmost of equals. A sequence of tokens is
a text's encoding exactly if each two neighbours are the encoding of their joined text: no
merge crosses a boundary in the whole text that would not cross it in the pair alone. So each
prefix has one last token, the piece ending there that goes with the last token of the prefix
before it. An automaton finds the pieces ending at each place, a table remembers which pairs
go together, and the ids are recovered from the end of the text backwards.

A text is cut where no piece holds the two characters around the cut; parts are encoded by
themselves, and frequent ones are remembered, a bounded number of them.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from hirelens.llm.common import bounded_batches, learned, whole_row

MARK = "▁"  # stands for a space
CACHED_PARTS = 700_000
CACHED_PAIRS = 1_000_000
CACHED_LENGTH = 48  # longer parts are seldom met twice
CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Vocabulary:
    """Pieces and scores of a model, and how it writes characters that are no piece."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        special = (model.is_unknown, model.is_control, model.is_byte, model.is_unused)
        self.ids = {
            model.id_to_piece(i): i for i in every if not any(kind(i) for kind in special)
        }
        self.rank = {piece: -model.get_score(i) for piece, i in self.ids.items()}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = model.unk_id()
        self.size = len(every)
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            raise ValueError("a piece goes on after a space: texts cannot be cut there")
        if model.encode("a") != model.encode("  a")[-1:] or not model.is_byte(self.bytes[0]):
            raise ValueError("the model must keep spaces, mark the first word and fall back to bytes")


def merge(symbols: list[str], rank: dict[str, float]) -> list[str]:
    """Merge neighbours, best score first and leftmost of equals, until none is a piece."""
    while len(symbols) > 1:
        best, place = None, -1
        for i in range(len(symbols) - 1):
            found = rank.get(symbols[i] + symbols[i + 1])
            if found is not None and (best is None or found < best):
                best, place = found, i
        if best is None:
            break
        symbols[place:place + 2] = [symbols[place] + symbols[place + 1]]
    return symbols


class Remembered(dict):
    """Results by text, made when first asked for; a bounded number of short ones is kept."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, text: str):
        found = self.make(text)
        if len(text) <= CACHED_LENGTH:
            if len(self) > CACHED_PARTS:
                self.clear()
            self[text] = found
        return found


class Encoder:
    """Encodes texts; remembers parts of texts and pairs of tokens, a bounded number."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.vocabulary = vocabulary
        self.pieces = {i: piece for piece, i in vocabulary.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for piece, i in vocabulary.ids.items():
            if len(piece) > 1:
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.joined = {
            piece[i:i + 2] for piece in vocabulary.ids for i in range(len(piece) - 1)
        }
        self.chunks, self.parts = Remembered(self.chunk), Remembered(self.part)
        self.pairs: dict[int, bool] = {}

    def together(self, left: int, right: int) -> bool:
        """Whether the two tokens are the encoding of their joined text; a left one that is
        no piece stands for the start, or for a character that no piece holds."""
        second, first = self.pieces[right], self.pieces.get(left, "")
        if first + second in self.vocabulary.ids and first:
            return False
        wanted = [first, second] if first else [second]
        return merge(list(first + second), self.vocabulary.rank) == wanted

    def part(self, text: str) -> tuple[int, ...]:
        """Ids of a text by its prefixes' last tokens. The pieces of several characters that
        end at a place are tried, longest first; if none fits, the character is the token."""
        size, pairs, own = self.vocabulary.size, self.pairs, self.vocabulary.ids
        last = [size]  # the prefixes' last tokens; `size`: the start, or no piece
        before = [0]  # where they begin
        known = 1  # the number of prefixes done
        for end, (token, length) in self.automaton.iter(text):
            if end + 1 < known:
                continue
            while known <= end:
                last.append(own.get(text[known - 1], size))
                before.append(known - 1)
                known += 1
            start = end + 1 - length
            key = last[start] * size + token
            fits = pairs.get(key)
            if fits is None:
                if len(pairs) > CACHED_PAIRS:
                    pairs.clear()
                fits = pairs[key] = self.together(last[start], token)
            if fits:
                last.append(token)
                before.append(start)
                known += 1
        for i in range(known - 1, len(text)):
            last.append(own.get(text[i], size))
            before.append(i)
        out, end = [], len(text)
        while end:
            start = before[end]
            if last[end] == size:
                out.extend(self.vocabulary.bytes[b] for b in reversed(text[start].encode()))
            else:
                out.append(last[end])
            end = start
        out.reverse()
        return tuple(out)

    def chunk(self, text: str) -> tuple[int, ...]:
        """Ids of a stretch of marks and other characters, its first mark left out; cut into
        parts, unless it is a plain word."""
        plain, text, joined, parts = text.isalpha(), MARK + text, self.joined, self.parts
        if plain:
            return self.part(text)
        cuts = [i for i in range(1, len(text)) if text[i - 1:i + 1] not in joined]
        return tuple(chain.from_iterable(
            [parts[text[a:b]] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]
        ))

    def encode(self, text: str) -> list[int]:
        """Ids of a text. Its start counts as a space; the empty text has none."""
        if not text:
            return []
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            chunks = [c[1:] for c in CHUNKS.findall(MARK + text.replace(" ", MARK))]
        else:
            chunks = text.split(" ")
        known = self.chunks
        return list(chain.from_iterable([known[c] for c in chunks]))


def encode_texts(docs: DataFrame, path: str, text: str = "text", keep_ids: bool = True) -> DataFrame:
    """Add to every row of `docs`, all of it under `doc`: `ids` (null if not `keep_ids`),
    `n_tokens`, `ids_sha256` (of the decimal ids joined by commas), `decoded` and
    `decoded_sha256` (of the library's decoding of the ids).

    Whole texts are encoded row by row without a shuffle; null counts as empty, an empty text
    has no ids and decodes to the empty text, repeated rows stay, an empty table gives an
    empty one, and columns of any name may stand in `docs`. Very long texts are held one Arrow
    batch at a time.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(whole_row(docs), F.col(text).alias("text"))
    schema = rows.drop("text").schema.add("ids", ArrayType(IntegerType())).add("n_tokens", "long").add(
        "ids_sha256", "string").add("decoded", "string").add("decoded_sha256", "string")

    def work(batches):
        import sentencepiece

        encoder, model, names = learned("pieces-" + path, lambda: (
            Encoder(vocabulary := Vocabulary(path)),
            sentencepiece.SentencePieceProcessor(model_file=path),
            list(map(str, range(vocabulary.size))),
        ))
        for batch in batches:
            kept, counts, digests, decoded, checks = [], [], [], [], []
            for value in batch.column("text"):
                ids = encoder.encode(value.as_py() or "")
                back = model.decode(ids) if ids else ""
                kept.append(ids if keep_ids else None)
                counts.append(len(ids))
                joined = ",".join([names[i] for i in ids])
                digests.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded.append(back if keep_ids else None)
                checks.append(hashlib.sha256(back.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(kept, pa.list_(pa.int32())),
                 pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(decoded, pa.string()), pa.array(checks, pa.string())],
                names=["doc", "ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"],
            )

    return rows.mapInArrow(work, schema)


def model_path(spark: SparkSession | None, path: str | None = None) -> str:
    """The model's file: a path that every worker can read."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
