"""Lexical search, piece encoding and periodic runs against brute force, and on awkward rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from hirelens.llm import lexical, periodic_runs, pieces

MODEL = pieces.model_path(None)


# --- lexical search -------------------------------------------------------------


def ranked(docs, items, best=10):
    """All scores of all documents, plainly."""
    pattern = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = [(d, Counter(pattern.findall((t or "").translate(lower)))) for d, t in docs]
    many = sum(1 for _, c in cut if c)
    total = sum(sum(c.values()) for _, c in cut)
    holding = Counter()
    for _, c in cut:
        holding.update(c.keys())
    out = []
    for item, text in items:
        scores = []
        for d, c in cut:
            m = 25 + 75 * sum(c.values()) * many // total if total else 0
            score = sum(
                lexical.weight(many, holding[w]) * (10**9 * c[w] // (1000 * c[w] + 8 * m))
                for w in pattern.findall((text or "").translate(lower)) if c[w]
            )
            if score > 0:
                scores.append((-score, d is None, d))
        scores.sort()
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(scores[:best])]
    return sorted(out, key=repr)


def searched(spark, path, docs, items, **options):
    lexical.write_index(docs, str(path))
    rows = lexical.search(spark, str(path), items, **options).collect()
    return sorted(((r["item"], r["rank"], r["doc"], r["score"]) for r in rows), key=repr)


def test_search_equals_brute_force(spark, tmp_path, monkeypatch):
    draw = random.Random(2)
    words = lambda n: " ".join(f"w{int(draw.paretovariate(.6) % 900)}" for _ in range(n))
    docs = [(i, words(draw.randrange(60))) for i in range(1500)]
    docs += docs[:20] + [(None, words(30)), (2000, None), (2001, "Été ÉTÉ 3½ w1-W2_w3")]
    items = [(i, words(draw.randrange(25))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "unheard of"), (33, "W1 w1 été ÉTÉ 3½"), (33, "w2")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(lexical, "SHARD_DOCS", 300)
    monkeypatch.setattr(lexical, "ITEMS_AT_ONCE", 9)
    assert searched(spark, tmp_path / "a", d, i) == ranked(docs, items)
    assert searched(spark, tmp_path / "b", d, i, best=3) == ranked(docs, items, 3)


def test_blocks_are_rejected_before_they_are_unpacked():
    """A frequent term of little weight beside a rare one: most of its blocks stay packed."""
    docs, draw = 60_000, np.random.default_rng(1)
    m = np.full(docs, 100, np.int64)

    def postings(places, tf):
        block = np.arange(0, len(places), lexical.BLOCK)
        stop = np.append(block[1:], len(places))
        steps = np.diff(places, prepend=0)
        steps[block] = places[block]
        row = {"df": len(places), "lasts": places[stop - 1],
               "maxima": np.maximum.reduceat(lexical.impacts(tf, m[places]), block)}
        for data, ends, values in (("steps", "step_ends", steps), ("tfs", "tf_ends", tf)):
            packed, used = lexical.pack(values)
            row[data], row[ends] = packed.tobytes(), used[stop - 1]
        return lexical.Postings(row, m)

    often = np.arange(docs)
    rare = np.sort(draw.choice(docs, 300, replace=False))
    lists = [(3, postings(often, draw.integers(1, 4, docs))), (9000, postings(rare, np.ones(300, int)))]
    places, scores = lexical.best_of_shard(lists, docs)
    total = np.zeros(docs, np.int64)
    for w, p in lists:
        p.unpack(np.arange(len(p.ready))) if p is lists[1][1] else None
    assert lists[0][1].ready.mean() < 0.6
    for w, p in lists:
        p.unpack(np.arange(len(p.ready)))
        total[p.docs] += w * p.parts
    order = np.lexsort((np.arange(docs), -total))[:10]
    assert places.tolist() == order.tolist() and scores.tolist() == total[order].tolist()


def test_numbers_survive_packing():
    draw = random.Random(4)
    for size in (0, 1, 7, 500):
        values = np.array([draw.choice([0, 1, 127, 128, 16383, 16384, 2**40]) for _ in range(size)],
                          np.int64)
        data, ends = lexical.pack(values)
        assert len(ends) == size and (not size or lexical.unpack(data).tolist() == values.tolist())


def test_search_on_awkward_and_empty_tables(spark, tmp_path, dotted):
    items = spark.createDataFrame([(1, "word 5678"), (2, "quick0 the1")], "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in dotted.select("doc_id", "text").collect()]
    wanted = ranked(docs, [(1, "word 5678"), (2, "quick0 the1")])
    assert searched(spark, tmp_path / "a", dotted, items) == wanted
    assert searched(spark, tmp_path / "b", dotted.limit(0), items) == []
    assert searched(spark, tmp_path / "c", dotted, items.limit(0)) == []


# --- pieces ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_equal_the_library(model, monkeypatch):
    encoder = pieces.Encoder(pieces.Vocabulary(MODEL))
    draw = random.Random(7)
    atoms = ["a", "b", "th", "er", " ", "  ", "▁", "\n", "\t", "é", "½", "字", "\U0001f600", "\0",
             "<s>", "<0x0A>", "The", "ing", "1", "...", "\xa0", "é", "aaaa", "==", "\r", "ß", "한국", "но"]
    own = list(encoder.vocabulary.ids)
    texts = ["", " ", "a" * 5000, " " * 3000, "ab" * 4000 + " x", "字" * 2000]
    texts += ["".join(draw.choices(atoms, k=draw.randrange(16))) for _ in range(6000)]
    texts += ["".join(draw.choices(own, k=draw.randrange(6))) for _ in range(6000)]
    assert [encoder.encode(t) for t in texts] == model.encode(texts)
    monkeypatch.setattr(pieces, "CACHED_PARTS", 5)
    monkeypatch.setattr(pieces, "CACHED_PAIRS", 5)
    small = pieces.Encoder(pieces.Vocabulary(MODEL))
    assert [small.encode(t) for t in texts[:800]] == model.encode(texts[:800])


def test_each_prefix_has_one_last_token(model):
    """Of the pieces that end at a place, exactly one goes with the prefix before it."""
    encoder = pieces.Encoder(pieces.Vocabulary(MODEL))
    text = "▁unbelievablyrepresentationalism"
    last = [-1]
    for end in range(1, len(text) + 1):
        fit = []
        for start in range(end):
            token = encoder.vocabulary.ids.get(text[start:end])
            if token is not None and encoder.together(last[start], token):
                fit.append(token)
        assert len(fit) == 1
        last.append(fit[0])
        assert model.encode(text[1:end])[-1:] == fit or end == 1


def test_pieces_on_awkward_and_empty_tables(spark, dotted, model):
    rows = pieces.encode_texts(dotted, MODEL).collect()
    assert len(rows) == dotted.count()
    for r in rows:
        ids = model.encode(r["doc"]["text"] or "")
        back = model.decode(ids) if ids else ""
        assert (r["ids"], r["n_tokens"], r["decoded"]) == (ids, len(ids), back)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
        assert r["doc"]["meta.url"] == "x"
    assert pieces.encode_texts(dotted.limit(0), MODEL).collect() == []


# --- periodic runs --------------------------------------------------------------


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e, q) for (s, e), q in found.items())


def some_words(draw):
    size = draw.randrange(120)
    if draw.random() < .3:
        return [draw.randrange(draw.choice([2, 3])) for _ in range(size)]
    out = [1] * draw.randrange(40) if draw.random() < .2 else []
    while len(out) < size:
        unit = [draw.randrange(draw.choice([2, 4, 30])) for _ in range(draw.randrange(1, 9))]
        out += (unit * draw.randrange(1, 8))[:draw.choice([None, -1])]
    return out * draw.choice([1, 1, 1, 4, 5, 6])


def test_runs_equal_brute_force():
    draw = random.Random(5)
    for _ in range(120):
        docs = [some_words(draw) for _ in range(draw.randrange(1, 10))]
        ids = np.array([w for d in docs for w in d], np.int64)
        found = periodic_runs.runs_of(ids, np.array([len(d) for d in docs]))
        assert [found.get(i, []) for i in range(len(docs))] == [plain_runs(d) for d in docs]


def test_repair_is_a_grammar_of_the_words():
    """Every replaced pair has the text of its nonterminal, and no pair is left twice."""
    draw = random.Random(6)
    docs = [some_words(draw) for _ in range(12)]
    owner = np.repeat(np.arange(12), [len(d) for d in docs])
    words = np.array([w + 1000 * i for i, d in enumerate(docs) for w in d], np.int64)
    passes, tops = periodic_runs.repair(words, owner)
    text, size, at = {}, len(words), dict(enumerate(words.tolist()))
    for made, start, middle, end in passes:
        assert (start < middle).all() and (middle < end).all()
        for symbol, a, b in zip(made.tolist(), start.tolist(), end.tolist(), strict=True):
            assert text.setdefault(symbol, words[a:b].tolist()) == words[a:b].tolist()
        size -= len(made)
        for symbol, a in zip(made.tolist(), start.tolist(), strict=True):
            at[a] = symbol
    assert size == len(tops)
    symbols = [at[a] for a in tops.tolist()]
    left = Counter(
        pair for i, pair in enumerate(zip(symbols[:-1], symbols[1:], strict=True))
        if owner[tops[i]] == owner[tops[i + 1]]
    )
    assert passes and max(left.values()) == 1


def test_run_report_on_awkward_and_empty_tables(spark, dotted):
    more = spark.createDataFrame(
        [(50, "a b " * 9 + "c " * 7), (51, "x " * 6), (52, "x " * 5), (53, "p q r " * 4 + "p\x0bq")],
        "doc_id long, text string",
    )
    docs = dotted.unionByName(more, allowMissingColumns=True)
    found = periodic_runs.find_runs(docs)
    assert found.count() == docs.count()
    for full, row in zip(found.collect(), periodic_runs.run_report(found).collect(), strict=True):
        words = re.findall("[^\x20\x09-\x0d]+", full["doc"]["text"] or "")
        runs = plain_runs(words)
        assert full["words"] == len(words) and row["n_runs"] == len(runs)
        lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in sorted(runs, key=lambda r: (r[0], r[2])))
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        gone = {i for s, e, q in runs for i in range(s + q, e)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert full["collapsed"] == kept
        assert row["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
        longest = min(((s - e, s, q) for s, e, q in runs), default=None)
        own = [row[c] for c in ("start", "length", "period", "exponent_milli")]
        if longest is None:
            assert own == [None] * 4
        else:
            less, s, q = longest
            assert own == [s, -less, q, 1000 * -less // q]
    assert periodic_runs.run_report(periodic_runs.find_runs(dotted.limit(0))).collect() == []


def test_repeated_tail_follows_its_rule():
    import zlib

    draw, changed = random.Random(8), 0
    for key in range(300):
        words = [str(draw.randrange(50)).encode() for _ in range(draw.randrange(80))]
        got = periodic_runs.repeated_tail(list(words), key)
        h = zlib.crc32(str(key).encode())
        wanted = list(words)
        if h % 10 == 0 and words:
            a = (h // 10) % len(words)
            p = 1 + (len(words) - a) // (3 + (h // 10) % 8)
            for i in range(a, len(words)):
                wanted[i] = words[a + (i - a) % p]
        changed += wanted != words
        assert got == wanted
    assert changed > 10
    assert periodic_runs.repeated_tail([b"x"], None) == [b"x"]
