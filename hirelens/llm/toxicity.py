"""Toxicity by multiple-instance learning: sentence scores joined by a noisy-or.

Only documents carry labels. A sentence's score is a logistic function of its words and
their beginnings and endings; a document is toxic unless every sentence and a small leak fail to make it so. The weights
are fitted on document labels, and the sentence scores then locate the offending ones.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import bounded_batches, learned, whole_row, words_of
from hirelens.llm.fingerprints import WordHashes, shingle_hashes
from hirelens.llm.language import held_out

SAMPLE_TEXTS = 4000
LEAST_Z = 7.0
LEAST_TEXTS = 5
STEPS = 400
CACHED_WORDS = 300_000
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of sentences: runs between full stops, marks and line ends, with a letter."""
    return [m.span() for m in SENTENCE.finditer(text) if WORD.search(m.group())]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def features(word: str) -> list[str]:
    """A lower-case word, its beginnings and its endings of three to six letters: inflected
    and compounded words share them."""
    ends = range(3, min(7, len(word)))
    return [f"^{word}$", *(f"^{word[:n]}" for n in ends), *(f"{word[-n:]}$" for n in ends)]


def choose_features(
    bags: list[set[str]], labels: np.ndarray, least_z: float = LEAST_Z
) -> list[str]:
    """Features that toxic texts hold significantly more often than others."""
    known: dict[str, list[str]] = {}

    def of(bag: set[str]) -> set[str]:
        found = set()
        for word in bag:
            if word not in known:
                known[word] = features(word)
            found.update(known[word])
        return found

    toxic = Counter()
    for bag, label in zip(bags, labels):
        if label:
            toxic.update(of(bag))
    toxic = {f: n for f, n in toxic.items() if n >= LEAST_TEXTS}
    known = {w: [f for f in own if f in toxic] for w, own in known.items()}
    other = Counter()
    for bag, label in zip(bags, labels):
        if not label:
            for word in bag:
                if word not in known:
                    known[word] = [f for f in features(word) if f in toxic]
            other.update(set().union(*[known[w] for w in bag]))
    rate = labels.mean() if len(labels) else 0.0
    chosen = []
    for feature, t in toxic.items():
        n = t + other[feature]
        if (t - n * rate) / max((n * rate * (1 - rate)) ** 0.5, 1e-9) >= least_z:
            chosen.append(feature)
    return sorted(chosen)


def independent(texts: list[str]) -> list[int]:
    """Places of texts that are no near copy of an earlier one: no smallest shingle hash of
    four orders in common. Copies carry one label many times and would pass for evidence."""
    hashes, seen, out = WordHashes(), set(), []
    for i, text in enumerate(texts):
        shingles = shingle_hashes(hashes.of(words_of(text)))
        marks = {
            (k, int((shingles * np.uint64(2 * k + 1) + np.uint64(k) >> np.uint64(8)).min()))
            for k in range(1, 5)
        } if len(shingles) else {(0, 0)}
        if not marks & seen:
            out.append(i)
        seen |= marks
    return out


def fit(texts: list[str], labels: list[int], steps: int = STEPS) -> dict:
    """Weights, bias and leak from document labels by gradient steps on the noisy-or's
    log likelihood.

    p(sentence) = sigmoid(bias + weights of its features);
    p(document) = 1 - (1 - leak) * product(1 - p(sentence)), over sentences with a chosen
    feature. A sentence without one has no part: what it would add is the leak's.
    """
    own = independent(texts)
    texts, y = [texts[i] for i in own], np.array([labels[i] for i in own], float)
    split = [[t[a:b] for a, b in sentences(t)] for t in map(str.lower, texts)]
    bags = [[set(WORD.findall(s)) for s in own] for own in split]
    words = choose_features([set().union(*own) if own else set() for own in bags], y)
    at = {w: i for i, w in enumerate(words)}
    hits_of: dict[str, list[int]] = {}
    doc, rows, columns = [], [], []
    for i, own in enumerate(bags):
        for bag in own:
            for word in bag:
                if word not in hits_of:
                    hits_of[word] = [at[f] for f in features(word) if f in at]
            hits = set().union(*[hits_of[w] for w in bag])
            if hits:
                rows += [len(doc)] * len(hits)
                columns += sorted(hits)
                doc.append(i)
    doc, rows, columns = (np.array(x, np.int64) for x in (doc, rows, columns))
    values = np.concatenate([np.full(len(words), 1.0), [-2.0, -3.0]])  # words, bias, leak
    moment, square = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, steps + 1):
        score = values[-2] + np.bincount(rows, values[:-2][columns], len(doc))
        p = _sigmoid(score)
        leak = _sigmoid(values[-1])
        none = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y)) + np.log1p(-leak)
        quiet = np.exp(none)
        right = np.clip(1 - quiet, 1e-9, 1)
        # the slope of the log likelihood by log(1 - p) of a part of the document
        slope = -(y * quiet / right) + (1 - y)
        by_score = -slope[doc] * p
        slopes = np.concatenate([
            np.bincount(columns, by_score[rows], len(words)),
            [by_score.sum(), -(slope * leak).sum()],
        ])
        slopes = slopes / max(len(y), 1) - 1e-4 * values
        moment = 0.9 * moment + 0.1 * slopes
        square = 0.99 * square + 0.01 * slopes**2
        rate = 0.1 / (1 + step / 100)
        values = values + rate * (moment / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.99**step)) + 1e-8
        )
    return {
        "weights": dict(zip(words, values[:-2].tolist())),
        "bias": float(values[-2]),
        "leak": float(_sigmoid(values[-1])) if len(y) else 0.0,
    }


def sample_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_TEXTS) -> DataFrame:
    """`text` and `toxic` of at most `sample` labelled ids that are not held out, those of
    the smallest id hash. The ids are chosen from the labels alone, so their number is
    bounded before they are broadcast. A repeated label counts once, the largest; of rows
    that share an id one text counts."""
    chosen = (
        labels.filter("doc_id is not null and toxic is not null")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        docs.select("doc_id", text.alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_TEXTS) -> dict:
    """Fit on a bounded sample; nothing else reaches the driver."""
    rows = sample_rows(docs, labels, sample).orderBy("doc_id").collect()
    return fit([r["text"] for r in rows], [int(r["toxic"]) for r in rows])


class _Scorer:
    def __init__(self, model: dict):
        self.model, self.known = model, {}
        self.weights = model["weights"]
        # a word can have a feature only with one of these three letters at an end
        self.starts = {f[1:4].rstrip("$") for f in self.weights if f[0] == "^"}
        self.stops = {f[-4:-1] for f in self.weights if f[0] != "^"}

    def _hits(self, token: str) -> tuple[str, ...]:
        """Weighted features of a white-space token; most have none."""
        own = set()
        for word in [token] if token.isalpha() else WORD.findall(token):
            if word[:3] in self.starts or word[-3:] in self.stops:
                own.update(f for f in features(word) if f in self.weights)
        found = self.known[token] = tuple(sorted(own)) if own else ()
        return found

    def score(self, text: str) -> tuple[float, list[dict]]:
        lower = text.lower()
        known, none = self.known, np.log1p(-self.model["leak"])
        if len(known) > CACHED_WORDS:
            known.clear()
        found = []
        if any([known[t] if t in known else self._hits(t) for t in set(lower.split())]):
            for i, (a, b) in enumerate(sentences(text)):
                hits = set()
                for t in text[a:b].lower().split():
                    hits.update(known[t] if t in known else self._hits(t))
                if hits:
                    x = self.model["bias"] + sum(self.weights[f] for f in sorted(hits))
                    p = 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))
                    none += math.log1p(-min(p, 1 - 1e-12))
                    if p >= 0.5:
                        found.append({"sentence": i, "start": a, "stop": b, "score": p})
        return 1 - math.exp(none), found


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """Add `score` (0 to 1) and `offending` sentences to every row, which becomes `doc`.

    Sentences are counted from 0; their spans are code points of the text. Null and empty texts
    get the leak, repeated rows the same score; an empty table gives an empty one. Whole texts are read, row by row, without a shuffle. The
    model holds the chosen words of the bounded sample only.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(whole_row(docs), F.col(text).alias("text"))
    part = T.StructType()
    for name in ("sentence", "start", "stop"):
        part = part.add(name, T.IntegerType())
    part = part.add("score", T.DoubleType())
    schema = rows.drop("text").schema.add("score", T.DoubleType()).add(
        "offending", T.ArrayType(part)
    )
    kind = pa.list_(pa.struct([("sentence", pa.int32()), ("start", pa.int32()),
                               ("stop", pa.int32()), ("score", pa.float64())]))

    name = uuid.uuid4().hex

    def run(batches):
        scorer = learned(name, lambda: _Scorer(shared.value))
        for batch in batches:
            out = [scorer.score(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array([x for x, _ in out], pa.float64()),
                 pa.array([x for _, x in out], kind)],
                names=["doc", "score", "offending"],
            )

    return rows.mapInArrow(run, schema)


def detect(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_TEXTS) -> DataFrame:
    """Learn from labelled rows that are not held out and score every row of `docs`
    (`doc_id`, `text`): `doc`, `held_out`, `score`, `predicted`, `offending`. Labels without
    a document are ignored; a null doc_id is not held out, and has no label. Without any
    label every score is 0. Other columns of both tables are not read."""
    model = train(docs, labels, sample)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select(
        F.struct("doc.doc_id", "doc.text").alias("doc"),
        held_out(F.col("doc.doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending",
    )
