"""The pipeline against a plain version on a small table."""

import random
from collections import Counter, defaultdict

import corpus_pipeline as pipeline
import numpy as np
from hirelens.llm import language, mixing, packing
from llm_text import prose
from test_operators import brute_classes, brute_targets


def test_pipeline(spark, tmp_path):
    draw = random.Random(12)
    rows = []
    for seed in range(40):
        base = prose(seed, 80)
        rows.append((base, "en", draw.choice(["a", "a", "b", None])))
        if seed % 4 == 0:
            rows.append((base.upper(), "en", "b"))  # an exact copy after lower-casing
        if seed % 5 == 0:
            rows.append((base + " tail words", "en", "a"))  # a near copy
    rows += [("1234 %", "en", "a"), (None, None, "a")]
    rows = [(i, *r, len(r[0] or "")) for i, r in enumerate(rows)]
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, columns)
    folder = str(tmp_path / "tables")
    docs.write.parquet(f"{folder}/documents.parquet")

    left = [r for r in rows if r[1] and language.LETTERS.search(r[1])]
    largest = {}
    for r in left:
        largest[r[1].lower()] = max(largest.get(r[1].lower(), -1), r[0])
    left = [r for r in left if largest[r[1].lower()] == r[0]]
    classes = brute_classes([(r[0], r[1]) for r in left])
    left = {r[0]: r for r in left if classes[r[0]][0] == r[0]}

    now = spark.read.parquet(f"{folder}/documents.parquet")
    for i, (_, stage) in enumerate(pipeline.STAGES[:3]):
        now = stage(spark, now, folder)
        assert now.columns == docs.columns
        now.write.parquet(f"{tmp_path}/stage{i}")
        now = spark.read.parquet(f"{tmp_path}/stage{i}")
    assert sorted(map(tuple, now.collect())) == sorted(left.values())

    mixed = pipeline.mix_sources(spark, now, folder).collect()
    sizes = defaultdict(int)
    for r in left.values():
        sizes[r[3]] += len(r[1].split())
    taken = Counter()
    for r in mixed:
        assert r["n_chars"] == len(r["text"])
        assert left[r["doc_id"]][1].startswith(r["text"])
        taken[r["source"]] += len(r["text"].split())
    targets = brute_targets(sizes)
    assert all(abs(taken[s] - targets[s]) <= 0.5 for s in sizes)

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.token_path(spark))
    wanted = Counter()
    for r in mixed:
        ids = tokenizer.encode(r["text"], add_special_tokens=False).ids + [2]
        wanted[r["doc_id"], len(ids)] += 1
    packed = pipeline.run(spark, folder).collect()
    assert Counter((r["doc_id"], r["doc_tokens"]) for r in packed) == wanted
    assert sum(r["length"] for r in packed) == sum(n * c for (_, n), c in wanted.items())
    assert np.bincount([r["sequence_id"] for r in packed]).min() > 0
    assert mixing.SHARDS == 16


def test_unlabelled_tables_keep_their_documents(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "some words", None), (2, "12 %", None), (3, None, None), (4, "é", None)],
        "doc_id bigint, text string, lang string")
    left = pipeline.identify_language(spark, docs, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in left) == [1, 4]
