"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's
probability is the sum over all its segmentations into pieces, found by a forward pass; a
text's is the product over its words. Pieces' probabilities are fitted by expectation
maximisation (forward-backward) on a bounded sample of labelled texts.

A letter is what Unicode calls one (the classes L*); a run is a longest stretch of them.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.llm.common import bounded_batches, learned, whole_row

TEXTS_PER_LANGUAGE = 400
BYTES_PER_LANGUAGE = 4_000_000  # of the texts that are learned from
SLICES = 64  # of a language's rows, when its texts are chosen
ROUNDS = 3
RESCALE_EVERY = 12  # letters; 1e-7 a letter stays far above the smallest float until then
WORDS_AT_ONCE = 20_000
UNSEEN = 1e-7
CACHED_WORDS = 700_000
MARK = "▁"  # the vocabulary's mark of a word's beginning
LETTERS = regex.compile(r"\p{L}+")
# ASCII characters that are no letters cut a text just as white space does
_CUT = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def piece_table(path: str) -> dict[str, int]:
    """Numbers of the lower-case letter pieces of a sentencepiece vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    wanted = {
        p for p in pieces
        if (p == MARK or LETTERS.fullmatch(p.removeprefix(MARK)))
        and p == p.lower()
    }
    return {p: i for i, p in enumerate(sorted(wanted))}


def letter_runs(token: str) -> list[str]:
    """Marked runs of letters of a lower-case token, whole."""
    return [MARK + run for run in LETTERS.findall(token)]


def tokens_of(text: str) -> list[str]:
    """Lower-case stretches of a text without white space and ASCII characters other than
    letters. Other characters that are no letters are cut out of a token when it is scored."""
    data = text.lower().encode("utf-8", "surrogatepass").translate(_CUT)
    return data.decode("utf-8", "surrogatepass").split()


def piece_finder(pieces: dict[str, int]):
    """An automaton that finds all pieces in a text, with their numbers and lengths."""
    import ahocorasick

    finder = ahocorasick.Automaton()
    for piece, number in pieces.items():
        finder.add_word(piece, number << 16 | len(piece))
    finder.make_automaton()
    return finder


def _arcs(words: list[str], pieces: dict[str, int], finder) -> dict[int, list[tuple]]:
    """The pieces in the words by the place where they end: (size, words that have such a
    piece there, the pieces' numbers). A single letter always has a place: unknown ones share
    the number after the last."""
    starts = np.cumsum([0] + [len(w) + 1 for w in words])
    pairs = chain.from_iterable(finder.iter("\n".join(words))) if pieces else ()
    found = np.fromiter(pairs, np.int64).reshape(-1, 2)
    last, number, size = found[:, 0], found[:, 1] >> 16, found[:, 1] & 0xFFFF
    known = np.zeros(starts[-1], bool)
    known[starts[1:] - 1] = True  # what stands between the words
    known[last[size == 1]] = True
    missing = np.flatnonzero(~known)
    last = np.concatenate([last, missing])
    number = np.concatenate([number, np.full(len(missing), len(pieces))])
    size = np.concatenate([size, np.ones(len(missing), np.int64)])
    word = np.searchsorted(starts, last, "right") - 1
    end = last + 1 - starts[word]
    order = np.lexsort((word, size, end))
    word, end, size, number = word[order], end[order], size[order], number[order]
    heads = np.flatnonzero(np.diff(end << 16 | size, prepend=-1))
    out = defaultdict(list)
    for a, b in zip(heads, np.append(heads[1:], len(end)), strict=True):
        out[int(end[a])].append((int(size[a]), word[a:b], number[a:b]))
    return out


def _learn_counts(words, weight, pieces, finder, table) -> np.ndarray:
    """How often each piece is expected to be used in each language, by forward and backward
    sums in logarithms over whole words of any length. `words` are by falling length."""
    languages = table.shape[1]
    counts = np.full((len(pieces) + 2, languages), 0.01)
    with np.errstate(divide="ignore"):
        logs = np.log(table)
    for first in range(0, len(words), WORDS_AT_ONCE):
        own, share = words[first:first + WORDS_AT_ONCE], weight[first:first + WORDS_AT_ONCE]
        arcs = _arcs(own, pieces, finder)
        lengths = np.array([len(w) for w in own])
        before = [np.zeros((len(own), languages))]
        for end in range(1, lengths[0] + 1):
            now = np.full((int((lengths >= end).sum()), languages), -np.inf)
            for size, word, number in arcs[end]:
                now[word] = np.logaddexp(now[word], before[end - size][word] + logs[number])
            before.append(now)
        total = np.zeros((len(own), languages))
        for end in range(1, lengths[0] + 1):
            done = lengths == end
            total[done] = before[end][done[:len(before[end])]]
        after = [np.full(b.shape, -np.inf) for b in before]
        for end in range(lengths[0], 0, -1):
            here = after[end]
            here[lengths[:len(here)] == end] = 0.0
            for size, word, number in arcs[end]:
                step = here[word] + logs[number]
                use = np.exp(before[end - size][word] + step - total[word]) * share[word]
                for k in range(languages):
                    counts[:, k] += np.bincount(number, use[:, k], len(counts))
                earlier = after[end - size]
                earlier[word] = np.logaddexp(earlier[word], step)
    return counts


def word_scores(
    words: list[str], pieces: dict[str, int], table: np.ndarray, finder=None
) -> np.ndarray:
    """Log probability of each word in each language, all segmentations summed.

    Words of any length: the pass keeps the sums of the last letters only, as many as the
    longest piece has, and rescales them now and then.
    """
    out = np.zeros((len(words), table.shape[1]), np.float64)
    longest = max(map(len, pieces), default=1)
    finder = finder or piece_finder(pieces)
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    for first in range(0, len(order), WORDS_AT_ONCE):
        places = np.array(order[first:first + WORDS_AT_ONCE])
        lengths = np.array([len(words[i]) for i in places])
        arcs = _arcs([words[i] for i in places], pieces, finder)
        reached = [np.ones((len(places), table.shape[1]))]
        scale = np.zeros((len(places), table.shape[1]))
        n = len(places)
        for end in range(1, int(lengths[0]) + 1):
            while lengths[n - 1] < end:  # the shortest are done
                n -= 1
            now = np.zeros((n, table.shape[1]))
            for size, word, number in arcs[end]:
                now[word] += reached[-size][word] * table[number]
            reached = [*reached[1 - longest:], now] if longest > 1 else [now]
            if end % RESCALE_EVERY == 0:
                scale[:n] += np.log(now)
                reached = [r[:n] / now for r in reached]
            done = np.flatnonzero(lengths[:n] == end)
            out[places[done]] = scale[done] + np.log(reached[-1][done])
    return out


def _normalised(counts: np.ndarray) -> np.ndarray:
    table = np.zeros((counts.shape[0] + 1, counts.shape[1]))
    table[:-1] = np.maximum(counts / counts.sum(axis=0), UNSEEN)
    return table  # the last row, of no piece, stays 0


def fit(samples: dict[str, Counter], pieces: dict[str, int], rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities, one column per language (sorted), from counts of runs."""
    languages = sorted(samples)
    words = sorted(set().union(*samples.values()), key=lambda w: (-len(w), w))
    weight = np.array([[samples[k][w] for k in languages] for w in words], float)
    finder = piece_finder(pieces)
    table = _normalised(np.ones((len(pieces) + 1, len(languages))))
    for _ in range(rounds):
        table = _normalised(_learn_counts(words, weight, pieces, finder, table)[:-1])
    return table


def least_fluency(samples: dict[str, Counter], pieces: dict[str, int], table) -> float:
    """The lowest log probability a letter that a learned run has in its own language. A text
    of runs learned in one language is never below it, whatever its length."""
    lowest = np.inf
    for k, language in enumerate(sorted(samples)):
        words = sorted(samples[language])
        scores = word_scores(words, pieces, table)[:, k]
        lowest = min(lowest, float((scores / [len(w) for w in words]).min()))
    return lowest if samples else -np.inf


def sample_texts(
    docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE, size: int = BYTES_PER_LANGUAGE
) -> DataFrame:
    """Texts of at most so many ids of each language that are not held out, those of the
    smallest id hash, as far as their bytes do not pass `size` together.

    The ids are chosen from narrow columns, first in slices of a language, so that no task
    sees all its rows, and broadcast: their number is bounded by `per_language` and the
    languages. Of rows that share an id one text counts.
    """
    mixed = F.xxhash64("doc_id")
    order = [mixed, F.col("doc_id"), F.col("_size")]
    sliced = Window.partitionBy("lang", "_slice").orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    running = whole.rowsBetween(Window.unboundedPreceding, 0)
    chosen = (
        docs.select("doc_id", "lang", F.octet_length("text").cast("long").alias("_size"))
        .filter("lang is not null and doc_id is not null and _size <= " + str(int(size)))
        .filter(~held_out(F.col("doc_id")))
        .withColumn("_slice", F.pmod(F.shiftright(mixed, 32), F.lit(SLICES)))
        .withColumn("_n", F.row_number().over(sliced)).filter(F.col("_n") <= per_language)
        .withColumn("_n", F.row_number().over(whole)).filter(F.col("_n") <= per_language)
        .withColumn("_sum", F.sum("_size").over(running)).filter(F.col("_sum") <= size)
        .select("doc_id", "lang")
        .distinct()
    )
    return (
        docs.select("doc_id", "lang", "text")
        .join(F.broadcast(chosen), ["doc_id", "lang"])
        .groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
        .filter("text is not null")
    )


def train(
    docs: DataFrame, pieces: dict[str, int], per_language: int = TEXTS_PER_LANGUAGE
) -> tuple[list[str], np.ndarray, float]:
    """Languages, piece probabilities and `least_fluency` from rows that are not held out. At
    most `per_language` texts of a language and BYTES_PER_LANGUAGE of them reach the driver."""
    samples = defaultdict(Counter)
    for row in sample_texts(docs, per_language).select("lang", "text").collect():
        for token in tokens_of(row["text"]):
            samples[row["lang"]].update(letter_runs(token))
    samples = {k: c for k, c in samples.items() if c}
    table = fit(samples, pieces) if samples else np.zeros((len(pieces) + 2, 0))
    return sorted(samples), table, least_fluency(samples, pieces, table)


class _Scorer:
    """Scores of tokens; remembers a bounded number of them."""

    def __init__(self, pieces, table):
        self.pieces, self.table, self.finder = pieces, table, piece_finder(pieces)
        self.clear()

    def clear(self):
        self.places: dict[str, int] = {}
        self.scores = np.zeros((0, self.table.shape[1] + 2), np.float32)

    def learn(self, tokens: list[str]) -> None:
        runs = [letter_runs(t) for t in tokens]
        words = list(dict.fromkeys(chain.from_iterable(runs)))
        at = {w: i for i, w in enumerate(words)}
        found = word_scores(words, self.pieces, self.table, self.finder)
        sizes = np.array([len(w) for w in words], float)
        flat = np.fromiter(map(at.__getitem__, chain.from_iterable(runs)), np.int64)
        owner = np.repeat(np.arange(len(tokens)), [len(own) for own in runs])
        new = np.zeros((len(tokens), self.table.shape[1] + 2), np.float32)
        for k in range(self.table.shape[1]):
            new[:, k] = np.bincount(owner, found[flat, k], len(tokens))
        new[:, -2] = np.bincount(owner, sizes[flat], len(tokens))
        new[:, -1] = np.bincount(owner, minlength=len(tokens))
        first = len(self.places)
        self.places.update((t, first + i) for i, t in enumerate(tokens))
        self.scores = np.concatenate([self.scores, new])

    def texts(self, texts: list[str]) -> np.ndarray:
        """Summed log probabilities of each text, the letters and marks scored, and its number
        of letter runs."""
        tokens = [tokens_of(t) for t in texts]
        seen = set().union(*tokens)
        if len(self.places) > CACHED_WORDS:
            self.clear()
        new = [t for t in seen if t not in self.places]
        if new:
            self.learn(new)
        out = np.zeros((len(texts), self.table.shape[1] + 2))
        for i, own in enumerate(tokens):
            if own:
                at = np.fromiter(map(self.places.__getitem__, own), np.int64, len(own))
                out[i] = self.scores[at].sum(axis=0, dtype=np.float64)
        return out


def predict(
    docs: DataFrame, languages: list[str], pieces: dict[str, int], table: np.ndarray,
    least: float = -np.inf, text: str = "text",
) -> DataFrame:
    """Add a language to every row: `doc` (the whole input row), `lang_pred`, `score`,
    `letter_runs` (how many the text has, whether or not a language was learned), `fluency`
    (log probability in that language a letter) and `accepted` (the text has letters, and
    its fluency is at least `least`).

    The score is the posterior probability under equal priors. Null texts and texts without
    a letter are `und` with score 0, as is everything when no language was learned; their
    fluency is null. Whole texts of any length are scored, row by row, without a shuffle;
    repeated rows get the same result, an empty table gives an empty one, and columns of any
    name may stand in `docs`. The model's size is that of the vocabulary times the languages.
    """
    bounded_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast((languages, pieces, table, least))
    rows = docs.select(whole_row(docs), F.col(text).alias("text"))
    schema = rows.drop("text").schema.add("lang_pred", "string").add("score", "double").add(
        "letter_runs", "long").add("fluency", "double").add("accepted", "boolean")

    name = uuid.uuid4().hex

    def score(batches):
        languages, pieces, table, least = model.value
        scorer = learned(name, lambda: _Scorer(pieces, table))
        for batch in batches:
            sums = scorer.texts([t or "" for t in batch.column("text").to_pylist()])
            names, scores, fluency, accepted = [], [], [], []
            for row in sums:
                if not row[-1] or not languages:
                    names.append("und")
                    scores.append(0.0)
                    fluency.append(None)
                    accepted.append(bool(row[-1]))
                    continue
                best = int(row[:-2].argmax())
                names.append(languages[best])
                scores.append(float(1 / np.exp(row[:-2] - row[best]).sum()))
                fluency.append(float(row[best] / row[-2]))
                accepted.append(fluency[-1] >= least - 1e-4)  # sums are kept in short floats
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(sums[:, -1].astype(np.int64)),
                 pa.array(fluency, pa.float64()), pa.array(accepted, pa.bool_())],
                names=["doc", "lang_pred", "score", "letter_runs", "fluency", "accepted"],
            )

    return rows.mapInArrow(score, schema)


def held_out(key: Column) -> Column:
    """Whether a row is kept out of learning: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(
    docs: DataFrame, vocabulary: str, per_language: int = TEXTS_PER_LANGUAGE
) -> DataFrame:
    """Learn from the rows of `docs` (`doc_id`, `text`, `lang`) that are not held out and
    have a language, and predict every row: `doc`, `held_out` and what `predict` adds. Rows
    with a null doc_id are not held out, and not learned from either; of rows that share an id
    and a language one text is learned from. Texts of any length are predicted whole; only
    learning leaves out texts of more than BYTES_PER_LANGUAGE."""
    pieces = piece_table(vocabulary)
    languages, table, least = train(docs, pieces, per_language)
    out = predict(docs, languages, pieces, table, least)
    return out.withColumn("held_out", held_out(F.col("doc.doc_id")))


def vocabulary_path(spark: SparkSession, path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
