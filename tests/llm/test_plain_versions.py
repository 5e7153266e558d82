"""Operators against plain recomputations, columns of any name and kind, and rejections."""

import math
import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline as pipeline
import numpy as np
import pytest
from hirelens.llm import (
    exact_dedup, fingerprints, jaccard, language, line_chunks, mixing, queries, sharding,
    toxicity, warc,
)
from llm_text import prose
from pyspark.sql import functions as F
from test_operators import brute_targets, speech

PIECES = language.vocabulary_path(None)


# --- columns of any name and kind -----------------------------------------------


def test_dotted_and_map_columns_pass_through(spark, dotted, tmp_path):
    many = dotted.count()
    placed = sharding.shuffle_into_shards(dotted)
    assert sorted(r["slot"] for r in placed.collect() if r["shard"] == 0) == [0]
    assert placed.count() == many and placed.select("doc.`meta.url`").distinct().count() == 1
    for frame in (
        language.identify(dotted, PIECES), toxicity.score(dotted, toxicity.fit([], [])),
    ):
        assert [r["doc"]["meta.url"] for r in frame.collect()] == ["x"] * many
    for stage in (pipeline.identify_language, pipeline.drop_copies, pipeline.drop_near_copies,
                  pipeline.mix_sources):
        left = stage(spark, dotted, str(tmp_path))
        assert left.columns == dotted.columns
        rows = left.collect()
        assert rows and all(r["meta.url"] == "x" and r["tags"] == {"a": 1} for r in rows)
        assert stage(spark, dotted.limit(0), str(tmp_path)).collect() == []


def test_exact_and_near_copies_keep_rows_whole(spark, dotted):
    kept = exact_dedup.without_copies(dotted).collect()
    assert Counter((r["text"] or "").lower() for r in kept).most_common(1)[0][1] == 1
    ones = jaccard.one_of_each(dotted).collect()
    assert {r["text"] for r in ones} <= {r["text"] for r in dotted.collect()}


# --- language -------------------------------------------------------------------


def test_only_letters_make_runs(spark):
    assert language.letter_runs("½²①a1é_ßⅷ字") == ["▁a", "▁é", "▁ß", "▁字"]
    rows = [(i, t, "en") for i, t in enumerate(["½", "2² ①", "ⅷ", "١٢", "word one", "other words"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc"]["text"]: r for r in language.identify(docs, PIECES).collect()}
    for text in ("½", "2² ①", "ⅷ", "١٢"):
        assert (found[text]["lang_pred"], found[text]["score"]) == ("und", 0.0)
    assert found["word one"]["lang_pred"] == "en"


def test_whole_runs_are_learned(spark):
    """Forward and backward sums over whole runs give the expected uses of each piece."""
    pieces = {"▁": 0, "a": 1, "b": 2, "ab": 3, "▁a": 4}
    long = "ab" * 400
    table = np.array([[.1], [.2], [.1], [.3], [.2], [1e-7], [0.]])
    finder = language.piece_finder(pieces)
    words = ["▁" + long, "▁aab"]
    counts = language._learn_counts(words, np.array([[0.], [1.]]), pieces, finder, table) - 0.01

    def ways(word):
        if not word:
            yield 1.0, []
        for piece, i in pieces.items():
            if word.startswith(piece):
                for p, rest in ways(word[len(piece):]):
                    yield p * table[i, 0], [i, *rest]

    every = list(ways("▁aab"))
    total = sum(p for p, _ in every)
    for i in range(5):
        assert abs(counts[i, 0] - sum(p * w.count(i) for p, w in every) / total) < 1e-9
    long_counts = language._learn_counts(
        words, np.array([[1.], [0.]]), pieces, finder, table) - 0.01
    letters = long_counts[1, 0] + 2 * long_counts[3, 0] + long_counts[2, 0] + long_counts[4, 0]
    assert abs(letters - 800) < 1e-6


def test_the_model_rejects_what_it_does_not_know(spark, tmp_path):
    draw = random.Random(4)
    rows = [(speech(draw, lang, draw.choice([1, 2, 30])), lang) for _ in range(60) for lang in ("en", "de")]
    junk = ["жшщ ъьы юя эё", "字漢文 語言", "ж", "qxq zzxj"]
    rows += [(t, "en") for t in junk[:0]] + [("1234 %", "en"), (None, "de")]
    rows = [(i, *r) for i, r in enumerate(rows)] + [(1000 + i, t, None) for i, t in enumerate(junk)]
    rows += [(2000, speech(draw, "de", 40), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    left = {r["doc_id"]: r for r in pipeline.identify_language(spark, docs, str(tmp_path)).collect()}
    clean = {r[0] for r in rows if r[2] and r[1] and r[1] != "1234 %"} | {2000}
    assert clean <= set(left) and not {1000, 1001, 1002} & set(left)
    assert left[2000]["lang"] == "de"  # a null language becomes the predicted one
    assert {r["text"] for r in left.values()}.isdisjoint({"1234 %", None})


def test_samples_are_bounded_in_bytes(spark):
    rows = [(i, "ab " * 1000, "en") for i in range(50)] + [(99, "x " * 9000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.sample_texts(docs, 40, 9500).collect()
    assert len(found) == 3 and all(len(r["text"]) == 3000 for r in found)


# --- mixing ---------------------------------------------------------------------


def test_the_mix_query_is_recomputed(spark, tmp_path):
    draw = random.Random(21)
    rows = [(i, prose(i, draw.randrange(0, 40)) if draw.random() < .95 else None,
             draw.choice(["a", "a", "a", "b", "c", None])) for i in range(300)]
    rows += rows[:5] + [(None, "some more words", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.QUERIES["op9_mixing"](spark, str(tmp_path)).collect()
    size = lambda t: len((t or "").split())
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size(text)
    targets = brute_targets(sizes)
    wanted = Counter((k, size(t), sizes[s], round(targets[s], 6)) for k, t, s in rows)
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6))
                   for r in found) == wanted
    of, taken = {s: (sizes[s], round(t, 6)) for s, t in targets.items()}, Counter()
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source_size"], round(r["target"], 6)] += r["taken"]
    for s, place in of.items():
        own = [t for t in targets if of[t] == place]
        assert abs(taken[place] - sum(targets[t] for t in own)) <= 0.5 * len(own) + 1e-6
    again = queries.QUERIES["op9_mixing"](spark, str(tmp_path)).collect()
    assert Counter(map(str, again)) == Counter(map(str, found))


def test_a_document_taken_in_part_keeps_its_bytes(column):
    text = "  one\n\ntwo\tthree  four\n"
    for n, wanted in [(1, "  one"), (2, "  one\n\ntwo"), (4, "  one\n\ntwo\tthree  four"), (9, text[:-1])]:
        assert column([text], lambda c, n=n: mixing.first_words(c, F.lit(n))) == [wanted]


def test_blocks_grow_so_that_draws_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 10)
    rows = [(i, "a" if i % 3 else "b", 20, i) for i in range(200)]
    frame = spark.createDataFrame(rows, "row long, source string, size long, content long")
    draws, targets = mixing.mix(frame, block_words=10, shards=4)
    assert draws.agg(F.max("block")).first()[0] < 11
    assert draws.agg(F.sum("words")).first()[0] == targets.agg(F.sum("quota")).first()[0]


# --- fingerprints ---------------------------------------------------------------


def test_bins_densification_and_digits_by_hand():
    """One pass over the shingles, each empty bin by its own search, digits one by one."""
    sketcher, words = fingerprints.Sketcher(), fingerprints.WordHashes()
    for count in (1, 5, 9, 60, 900, 4000):
        hashes = fingerprints.shingle_hashes(words.of(prose(count, count).split()))
        smallest = {}
        for h in hashes.tolist():
            b = h >> (64 - 9)
            smallest[b] = min(h, smallest.get(b, h))
        values = []
        for b in range(512):
            at, attempt = b, 0
            while at not in smallest:
                asked = np.array([(b << 32) + attempt + 1], np.uint64)
                at = int(fingerprints.scramble(asked)[0]) % 512
                attempt += 1
            own = int(fingerprints.scramble(np.array([b + 1], np.uint64))[0])
            mixed = np.array([(smallest[at] + own) % (1 << 64)], np.uint64)
            values.append(int(fingerprints.scramble(mixed)[0]) & 15)
        got = sketcher.values(hashes)
        assert got.tolist() == values
        text = sketcher.text(got)
        assert text == "".join(f"{values[i + 1]:x}{values[i]:x}" for i in range(0, 512, 2))
        assert sketcher.read(text).tolist() == values


# --- toxicity -------------------------------------------------------------------


def test_noisy_or_by_hand_and_its_spans():
    model = {"weights": {"^vile$": 2.5, "^hor": 1.0, "ful$": 0.5}, "bias": -1.5, "leak": 0.02}
    scorer = toxicity._Scorer(model)
    text = "İ was vile. Horrible and awful! kind words\nvile, VILE horror"
    score, found = scorer.score(text)
    ps = [1 / (1 + math.exp(-x)) for x in (-1.5 + 2.5, -1.5 + 1.0 + 0.5, -1.5 + 2.5 + 1.0)]
    none = math.prod(1 - p for p in ps) * 0.98
    assert abs(score - (1 - none)) < 1e-12
    assert [text[f["start"]:f["stop"]] for f in found] == [
        "İ was vile", " Horrible and awful", "vile, VILE horror"]
    assert scorer.score("") == (pytest.approx(0.02), [])


def test_the_fit_ends_where_the_likelihood_is_flat():
    """At the fitted values, small changes of any weight do not raise the penalised likelihood."""
    draw = random.Random(3)
    texts, labels = [], []
    for i in range(240):
        bad = draw.random() < .4
        lines = [prose(5000 + 20 * i + j, 8) for j in range(3)]
        if bad:
            lines[draw.randrange(3)] += draw.choice([" grubnik", " zorblatt", ""])
        texts.append(". ".join(lines))
        labels.append(int(bad))
    model = toxicity.fit(texts, labels, 1500)
    assert model["weights"]

    def likelihood(weights, bias, leak):
        scorer, total = toxicity._Scorer({"weights": weights, "bias": bias, "leak": leak}), 0.0
        for text, label in zip(texts, labels, strict=True):
            p = min(max(scorer.score(text)[0], 1e-9), 1 - 1e-9)
            total += math.log(p if label else 1 - p)
        logit = math.log(leak / (1 - leak))
        size = sum(w * w for w in weights.values()) + bias**2 + logit**2
        return total / len(texts) - 0.5e-4 * size

    own = toxicity.independent(texts)
    texts, labels = [texts[i] for i in own], [labels[i] for i in own]
    weights, bias, leak = model["weights"], model["bias"], model["leak"]
    best = likelihood(weights, bias, leak)
    for step in (-0.05, 0.05):
        for f in list(weights)[:6]:
            assert likelihood({**weights, f: weights[f] + step}, bias, leak) <= best + 2e-4
        assert likelihood(weights, bias + step, leak) <= best + 2e-4


def test_toxicity_on_awkward_rows(spark, dotted):
    labels = spark.createDataFrame([(1, 1), (4, 0), (6, 1), (None, 1)], "doc_id long, toxic int")
    found = toxicity.detect(dotted, labels).collect()
    assert len(found) == dotted.count() and all(0 <= r["score"] <= 1 for r in found)
    for r in found:
        key = r["doc_id"] if "doc_id" in r else r["doc"]["doc_id"]
        assert r["held_out"] == (key is not None and zlib.crc32(str(key).encode()) % 5 == 0)


# --- lines, archives ------------------------------------------------------------


def test_line_runs_on_awkward_and_empty_tables(spark, dotted):
    found = line_chunks.remove_repeated_runs(dotted).collect()
    assert len(found) == dotted.count()
    assert all((r["text"] is None) == (r["lines"] == 0) for r in found)
    assert line_chunks.remove_repeated_runs(dotted.limit(0)).collect() == []


def test_archives_are_bounded_and_awkward_pages_pass(spark, tmp_path, monkeypatch):
    rows = [(i, f"u{i}", prose(i, 40)) for i in range(60)] + [(60, "u", "x" * 300_000)]
    rows += rows[:3] + [(None, None, None), (61, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "record_type", F.lit(1)).withColumn("a.b", F.lit(2))
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3 * (300_000 + warc.HEADER_BYTES))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    resolved = warc.resolve_revisits(pages).coalesce(1)
    warc.write_archives(resolved, str(tmp_path / "a"))
    files = list((tmp_path / "a").glob("part-*"))
    assert len(files) >= len(rows) / 3
    read = warc.resolved_records(warc.read_archives(spark, str(tmp_path / "a"))).collect()
    assert Counter(r["page_id"] for r in read) == Counter(r[0] for r in rows)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") in (before, "1000")
    warc.write_archives(warc.resolve_revisits(pages.limit(0)), str(tmp_path / "b"))
    assert warc.read_archives(spark, str(tmp_path / "b")).collect() == []
