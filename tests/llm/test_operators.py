"""The operators against brute force on small tables, and on awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_text import prose
from pyspark.sql import functions as F

from hirelens.llm import (
    exact_dedup, fingerprints, jaccard, language, line_chunks, mixing, packing, queries,
    sharding, toxicity, warc,
)
from hirelens.llm.common import numbered

VOCABULARY = packing.token_path(None)
PIECES = language.vocabulary_path(None)


def make(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


# --- packing --------------------------------------------------------------------


def test_packing_covers_every_id(spark, awkward):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = packing.pack_documents(awkward, VOCABULARY, most=256).collect()
    wanted = Counter()
    for r in awkward.select("doc_id", "text").collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        wanted[r["doc_id"], np.array(ids, "<u4").tobytes()] += 1
    by_row = defaultdict(list)
    for r in rows:
        assert r["length"] <= 256 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        by_row[r["row"]].append(r)
    found = Counter()
    for own in by_row.values():
        own.sort(key=lambda r: r["start"])
        data = b"".join(bytes(r["ids"]) for r in own)
        assert own[0]["doc_tokens"] * 4 == len(data)
        found[own[0]["doc_id"], data] += 1
    assert found == wanted
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert sorted(sequences) == list(range(len(sequences)))


def test_patterns_use_the_histogram_exactly():
    draw = random.Random(3)
    for _ in range(30):
        most = draw.choice([8, 64, 100])
        histogram = {
            n: draw.randrange(1, 400) for n in draw.sample(range(1, most + 1), draw.randrange(1, 8))
        }
        used, full = Counter(), 0
        for pattern, count in packing.pack_patterns(histogram, most):
            size = 0
            while pattern:
                pattern, length, times = pattern
                used[length] += times * count
                size += times * length
            assert 0 < size <= most
            full += count
        assert used == histogram
        assert full <= 2 * sum(k * n for k, n in histogram.items()) / most + 1
    assert packing.pack_patterns({}, 8) == []


def test_packing_learns_frequent_words_once(monkeypatch):
    """Words that keep coming are learned once, whatever comes between them."""
    import pyarrow as pa

    learned = Counter()

    class Counted(packing.Remembered):
        def __init__(self, learn, most):
            def counted(piece):
                learned[piece] += 1
                return learn(piece)

            super().__init__(counted, most)

    monkeypatch.setattr(packing, "Remembered", Counted)
    encode = packing._encoder(VOCABULARY, 100)
    letters = [chr(97 + i // 26 % 26) + chr(97 + i % 26) for i in range(676)]
    for at in range(0, 600, 20):
        rare = " ".join("rare" + x for x in letters[at:at + 20])
        ids, ends = encode(pa.array([f"The word, the WORD. {rare} the word", None]))
        assert len(ids) == ends[0] == ends[1]
    assert learned["the"] == learned["word"] == learned[","] == learned["."] == 1
    assert max(learned.values()) == 1 and len(learned) == 600 + 4 + 1  # and the null text's
    known = packing.Remembered(lambda key: key.encode(), 10)
    for i in range(1000):
        assert known[str(i)] == str(i).encode()
        assert len(known) + len(known.older) <= 20


def test_packing_ids_are_those_of_the_whole_tokenizer():
    import pyarrow as pa
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    draw = random.Random(7)
    latin = [chr(i) for i in range(256)]
    odd = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|", "H\u0331", "e\u0301", "\u212a", "\u0130",
           "\u2019", "\u3000", "\u2028", "\x1c", "\x85", "\xa0", "'S", "'re", "''s", "\r\n"]
    texts = ["", " ", "\n\t", None, "1234 \xbd\xb2 \xc0\xde\xdf"]
    texts += ["".join(draw.choice(draw.choice([latin, odd, list("aAeE'st ,.")]))
                      for _ in range(draw.randrange(1, 60))) for _ in range(1500)]
    encode = packing._encoder(VOCABULARY, 50)
    for at in range(0, len(texts), 300):
        batch = texts[at:at + 300]
        ids, ends = encode(pa.array(batch, pa.string()))
        for text, begin, end in zip(batch, [0, *ends[:-1]], ends):
            wanted = tokenizer.encode(text or "", add_special_tokens=False).ids
            assert ids[begin:end].tolist() == wanted, text


# --- sharding -------------------------------------------------------------------


def test_shards_are_even_and_gapless(awkward):
    rows = sharding.shuffle_into_shards(awkward, shards=4, least_buckets=3).collect()
    again = sharding.shuffle_into_shards(awkward, shards=4, least_buckets=3).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert Counter(r["doc"] for r in rows) == Counter(awkward.collect())


def test_written_shards_are_read_back(spark, awkward, nothing, tmp_path):
    path = str(tmp_path / "shards")
    placed = sharding.shuffle_into_shards(awkward, shards=4, least_buckets=3)
    sharding.write_shards(placed, path)
    found = sharding.read_shards(spark, path, placed.schema)
    assert dict(found.dtypes) == dict(placed.dtypes)
    assert sorted(map(str, found.select(placed.columns).collect())) == sorted(
        map(str, placed.collect()))
    for n in range(4):  # files of a shard are runs of slots
        for file in (tmp_path / "shards" / f"shard={n}").glob("*.parquet"):
            slots = [r["slot"] for r in spark.read.parquet(str(file)).collect()]
            assert slots == list(range(slots[0], slots[0] + len(slots)))
    empty = sharding.shuffle_into_shards(nothing)
    sharding.write_shards(empty, path + "-none")
    assert sharding.read_shards(spark, path + "-none", empty.schema).count() == 0


def test_sharding_query_reads_written_files(spark, awkward, tmp_path):
    awkward.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op2_sharding(spark, str(tmp_path))
    assert found.inputFiles() and all("/shard=" in f for f in found.inputFiles())
    wanted = [(str(r["doc_id"]), len((r["text"] or "").encode()) + 1,
               zlib.crc32((r["text"] or "").encode())) for r in awkward.collect()]
    assert sorted(wanted) == sorted(
        (str(r["doc_id"]), r["size"], r["text_crc32"]) for r in found.collect())


# --- lines ----------------------------------------------------------------------


def brute_lines(rows):
    seen, out = set(), {}
    for key, text in sorted(rows):
        lines, left, gone = text.split("\n"), [], 0
        for a, b in line_chunks.chunk_spans(lines):
            chunk = "\n".join(lines[a:b])
            if b - a > 1 and chunk in seen and any(c.isalnum() for c in chunk):
                gone += b - a
            else:
                left += lines[a:b]
            if b - a > 1:
                seen.add(chunk)
        out[key] = ("\n".join(left), len(lines), gone)
    return out


def test_repeated_chunks_go(spark):
    draw = random.Random(5)
    shared = [prose(90 + i, 8) for i in range(12)]
    rows = []
    for i in range(60):
        lines = [prose(1000 + 50 * i + j, 6) for j in range(draw.randrange(0, 9))]
        if i % 3 == 0:
            lines[2:2] = shared
        rows.append((i, "\n".join(lines)))
    found = {
        r["doc_id"]: (r["text"], r["lines"], r["removed_lines"])
        for r in line_chunks.remove_repeated(make(spark, rows)).collect()
    }
    wanted = brute_lines(rows)
    assert found == wanted
    assert sum(w[2] for w in wanted.values()) > 60


def test_boundaries_move_with_the_text():
    lines = [prose(i, 5) for i in range(200)]
    ends = {tuple(lines[a:b]) for a, b in line_chunks.chunk_spans(lines)}
    moved = {tuple((["new", "lines"] + lines)[a:b])
             for a, b in line_chunks.chunk_spans(["new", "lines"] + lines)}
    assert len(ends & moved) > 0.9 * len(ends)


def brute_runs(rows):
    """Lines that go: of runs of at least two lines seen before, and long lines seen before."""
    seen, gone = {}, {}
    for key, text in sorted(rows):
        lines, own = text.split("\n"), set()
        for a, b in sorted((a, a + n) for n in (1, 2) for a in range(len(lines) - n + 1)):
            run = tuple(lines[a:b])
            if not any(c.isalnum() for line in run for c in line):
                continue
            if b - a == 1 and len(lines[a].split()) <= 50:
                continue
            first = seen.setdefault(run, (key, a))
            if first[0] != key or a >= first[1] + b - a:
                own |= set(range(a, b))
        gone[key] = own
    return gone


def lines_gone(rows):
    return {r["doc_id"]: {n for s in r["removed"] for n in range(s["start"], s["stop"])}
            for r in rows}


def test_repeated_runs_go_at_any_place(spark):
    draw = random.Random(15)
    shared = {n: [[prose(5000 + 100 * n + 10 * k + j, 8) for j in range(n)] for k in range(6)]
              for n in range(2, 6)}
    rows, planted, number = [], {}, 0
    for n, passages in shared.items():
        for passage in passages:
            for _ in range(3):
                before = [prose(90000 + 20 * number + j, 6) for j in range(draw.randrange(0, 6))]
                after = [prose(90010 + 20 * number + j, 6) for j in range(draw.randrange(0, 6))]
                planted[number] = (n, len(before))
                rows.append((number, "\n".join(before + passage + after)))
                number += 1
    found = line_chunks.remove_repeated_runs(make(spark, rows)).collect()
    gone = lines_gone(found)
    assert gone == brute_runs(rows)
    text = dict(rows)
    for r in found:
        n, at = planted[r["doc_id"]]
        assert gone[r["doc_id"]] == (set(range(at, at + n)) if r["doc_id"] % 3 else set())
        kept = [t for i, t in enumerate(text[r["doc_id"]].split("\n"))
                if i not in gone[r["doc_id"]]]
        assert (r["text"], r["removed_lines"]) == ("\n".join(kept), len(gone[r["doc_id"]]))
    # the chunk rule alone loses most of them
    chunks = lines_gone(line_chunks.remove_repeated(make(spark, rows)).collect())
    assert sum(map(len, chunks.values())) < 0.5 * sum(map(len, gone.values()))


def test_runs_with_gaps_and_long_lines(spark):
    long, short = prose(1, 51), prose(2, 50)
    rows = [
        (1, f"{long}\na\n{short}\nb"), (2, f"c\n{long}\nd"), (3, f"e\n{short}\nf"),
        (4, "head\n\n---\n\ntail"), (5, "g\nhead\n\n---\n\ntail\nh"), (6, "\n---\n"),
        (7, "x\nx\nx"), (8, "y\ny\ny\ny"),
    ]
    gone = lines_gone(line_chunks.remove_repeated_runs(make(spark, rows)).collect())
    assert gone == {1: set(), 2: {1}, 3: set(), 4: set(), 5: {1, 2, 3, 4, 5}, 6: set(),
                    7: set(), 8: {2, 3}}


def test_colliding_line_hashes_are_salted_again(spark):
    rows = [(i, f"{prose(i // 2, 4)}\n{prose(800 + i // 2, 4)}") for i in range(12)]
    found = line_chunks.remove_passages(
        make(spark, rows), line_chunks.run_passages, bits=5).collect()
    assert lines_gone(found) == {i: {0, 1} if i % 2 else set() for i in range(12)}


# --- fingerprints ---------------------------------------------------------------


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_follow_the_order(spark):
    texts = {i * 3: prose(i, 20 + 7 * i) for i in range(40)} | {200: "", 201: "one two"}
    docs = make(spark, list(texts.items())).repartition(5)
    found = {r["doc_id"]: r for r in fingerprints.fingerprint_neighbours(docs).collect()}
    ids = sorted(texts, reverse=True)
    for i, k in enumerate(ids):
        text, after = texts[k], texts[ids[(i + 1) % len(ids)]]
        changed = fingerprints.edited(text, after)
        assert found[k]["n_chars"] == len(text)
        assert found[k]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert abs(found[k]["near_edited"] - likeness(text, changed)) < 0.15
        assert abs(found[k]["near_next"] - likeness(text, after)) < 0.15


def test_likeness_is_unbiased():
    sketcher = fingerprints.Sketcher()
    draw = np.random.default_rng(1)
    for share in (0.1, 0.5, 0.9):
        errors = []
        for _ in range(40):
            a, b, both = (draw.integers(0, 1 << 63, n, dtype=np.uint64)
                          for n in (*[int(300 * (1 - share) / 2)] * 2, int(300 * share)))
            x, y = (sketcher.values(np.concatenate([own, both])) for own in (a, b))
            assert (sketcher.read(sketcher.text(x)) == x).all()
            errors.append(sketcher.likeness(x, y) - len(both) / (len(a) + len(b) + len(both)))
        assert abs(np.mean(errors)) < 0.02


# --- near duplicates ------------------------------------------------------------


def brute_classes(rows):
    first = {}
    for key, text in sorted(rows):
        first.setdefault(text, key)
    sets = {k: shingles(t) for t, k in first.items()}
    parent, links = {k: k for k in sets}, Counter()

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {k: (root(first[t]), first[t], links[first[t]]) for k, t in rows}


def edited_copies(count, words=120):
    draw = random.Random(7)
    rows, number = [], 0
    for seed in range(count):
        base = prose(seed, words).split()
        for _ in range(draw.randrange(1, 7)):
            copy = list(base)
            for _ in range(draw.randrange(0, 6)):
                copy[draw.randrange(words)] = "changed" + str(draw.randrange(99))
            rows.append((number, " ".join(copy)))
            number += 1
    return rows


@pytest.mark.parametrize("slice_texts", [1024, 2])
def test_links_and_classes(spark, slice_texts):
    rows = edited_copies(25)
    found = {
        r["doc_id"]: (r["class_id"], r["text_id"], r["links"])
        for r in jaccard.near_duplicates(make(spark, rows), block_texts=slice_texts).collect()
    }
    assert found == brute_classes(rows)
    kept = {r["doc_id"] for r in jaccard.one_of_each(make(spark, rows)).collect()}
    assert kept == {v[0] for v in found.values()}


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, rows = jaccard.choose_bands(threshold, 0.999)
        assert 1 - (1 - threshold**rows) ** bands >= 0.999
        assert bands * rows <= jaccard.MOST_HASHES


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)]
    edges += [(i, i + 1) for i in range(400, 460)]
    parent = {}

    def root(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    wanted = {k: root(k) for a, b in edges if a != b for k in (a, b)}
    found = jaccard.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["least"] for r in found} == wanted


# --- exact dedup ----------------------------------------------------------------


def brute_exact(rows):
    groups = defaultdict(list)
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for key, text in rows:
        groups[(text or "").translate(lower)].append(key)
    return sorted(
        (str(key), str(max(own, key=lambda k: -1 if k is None else k)), len(own),
         hashlib.sha256(text.encode()).hexdigest())
        for text, own in groups.items() for key in own
    )


@pytest.mark.parametrize("digest_bits", [None, 2])
def test_exact_dedup(spark, awkward, digest_bits):
    """Two-bit digests collide; the contents show it and another salt is taken."""
    found = exact_dedup.exact_dedup(awkward, block_bytes=64, digest_bits=digest_bits).collect()
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    assert brute_exact(rows) == sorted(
        (str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in found
    )
    kept = [r["text_sha256"] for r in found if r["kept"]]
    assert len(kept) == len(set(kept)) == len({r["text_sha256"] for r in found})
    assert exact_dedup.without_copies(awkward).count() == len(kept)


# --- language, toxicity ---------------------------------------------------------


def test_forward_sums_all_segmentations():
    pieces = {"▁": 0, "▁a": 1, "a": 2, "b": 3, "ab": 4, "▁ab": 5}
    table = np.array([[.1], [.2], [.05], [.3], [.15], [.2], [1e-7], [0.]])

    def every(word):
        if not word:
            return 1.0
        return sum(table[pieces[word[:n]], 0] * every(word[n:])
                   for n in range(1, len(word) + 1) if word[:n] in pieces)

    scores = language.word_scores(["▁ab", "▁aab"], pieces, table)
    assert np.allclose(np.exp(scores[:, 0]), [every("▁ab"), every("▁aab")])


def test_long_pieces_and_whole_runs_are_summed():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = {model.id_to_piece(i) for i in range(model.get_piece_size())}
    known = language.piece_table(PIECES)
    long = {p for p in own if len(p) > 10 and p == p.lower()
            and language.LETTERS.fullmatch(p.removeprefix("▁"))}
    assert long and long <= set(known)
    pieces = {"▁": 0, "▁a": 1, "a": 2, "b": 3, "ab": 4, "bababababababa": 5}
    table = np.array([[.1, .3], [.2, .1], [.05, 1e-7], [.3, 1e-7], [.15, .1], [.2, .2],
                      [1e-7, 1e-7], [0., 0.]])
    draw = random.Random(3)
    words = ["▁" + "ab" * n for n in (1, 7, 15, 16, 40, 500)] + ["▁", "▁" + "zq" * 60]
    words += ["▁" + "".join(draw.choices("abz", k=n)) for n in range(1, 80, 7)]

    def exact(word, k):
        from fractions import Fraction as Q

        sums = [Q(1)]
        for end in range(1, len(word) + 1):
            at = Q(0)
            for n in range(1, min(14, end) + 1):
                p = pieces.get(word[end - n:end], 6 if n == 1 else None)
                at += 0 if p is None else sums[-n] * Q(table[p, k])
            sums.append(at)
        from decimal import Decimal

        return float((Decimal(sums[-1].numerator) / Decimal(sums[-1].denominator)).ln())

    scores = language.word_scores(words, pieces, table)
    assert np.allclose(scores, [[exact(w, k) for k in (0, 1)] for w in words])
    assert language.letter_runs("x" * 90) == ["▁" + "x" * 90]


def speech(draw, lang, words):
    syllables = {"en": ["th", "ing", "er", "ou"], "de": ["sch", "ung", "ei", "ver"]}[lang]
    return " ".join("".join(draw.choices(syllables, k=3)) for _ in range(words))


def test_language(spark):
    draw = random.Random(4)
    rows = [(i, speech(draw, lang, 30), lang) for i in range(60) for lang in ["en", "de"]]
    rows = [(i, t, lang) for i, (_, t, lang) in enumerate(rows)] + [(900, "12 %", "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = language.identify(docs, PIECES).collect()
    for r in found:
        key = r["doc"]["doc_id"]
        assert r["held_out"] == (zlib.crc32(str(key).encode()) % 5 == 0)
        assert r["lang_pred"] == ("und" if key == 900 else r["doc"]["lang"])
        assert 0 <= r["score"] <= 1


def test_toxicity(spark):
    draw = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        lines = [prose(7000 + 9 * i + j, 12) for j in range(4)]
        if i % 5 == 0:
            lines[1] += draw.choice([" grumpbag", " snarkface indeed"])
        rows.append((i, ".\n".join(lines)))
        labels.append((i, int(i % 5 == 0)))
    docs = make(spark, [*rows, (1000, None), (None, "")])
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    for r in toxicity.detect(docs, marks).collect():
        key = r["doc"]["doc_id"]
        bad = key is not None and key < 1000 and key % 5 == 0
        assert r["predicted"] == int(bad), key
        assert [s["sentence"] for s in r["offending"]] == ([1] if bad else [])
    assert {r["score"] for r in toxicity.detect(docs, marks.limit(0)).collect()} == {0.0}


# --- mixing ---------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] >= most * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= full
    return target


def test_targets(spark):
    draw = random.Random(8)
    for _ in range(3):
        sizes = {draw.choice("abcdefghiéz") + str(i): draw.choice([0, 3, 50, 4000])
                 for i in range(9)} | {None: 77}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        found = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
        wanted = brute_targets(sizes)
        assert all(abs(found[s] - wanted[s]) < 1e-6 for s in sizes)


def test_tree_is_exact():
    tree = mixing.splitting_tree([100, 7, 0, 33], 5, 1)
    assert [sum(c) for c in zip(*tree)] == [100, 7, 0, 33]
    assert max(map(sum, tree)) - min(map(sum, tree)) <= 3
    assert tree == mixing.splitting_tree([100, 7, 0, 33], 5, 1)


def test_mix(spark):
    draw = random.Random(9)
    rows = [(i, draw.choice(["a", "a", "a", "b", None]), draw.randrange(0, 90), i * 31)
            for i in range(500)]
    frame = spark.createDataFrame(rows, "row bigint, source string, size bigint, content bigint")
    draws, targets = mixing.mix(frame, block_words=500, shards=4)
    quota = {r["source"]: r["quota"] for r in targets.collect()}
    of = {r[0]: r for r in rows}
    taken, words, slots = Counter(), Counter(), defaultdict(list)
    for r in draws.collect():
        taken[of[r["row"]][1]] += r["words"]
        words[r["row"]] += r["words"]
        slots[r["shard"]].append(r["slot"])
    assert all(taken[s] == q for s, q in quota.items())
    assert all(n <= 3 * of[k][2] for k, n in words.items())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


# --- archives -------------------------------------------------------------------


def test_archives(spark, tmp_path):
    odd = "<p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n</p>"
    rows = [(1, "u1", "same"), (2, None, "same"), (3, "u\r\n3", odd), (4, "u4", None),
            (5, "u5", ""), (6, "u6", "é" * 3000), (7, "u7", "same"), (None, "u8", "same")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    path = str(tmp_path / "warc")
    warc.write_archives(warc.resolve_revisits(pages), path)
    found = warc.resolved_records(warc.read_archives(spark, path)).collect()
    import base64

    best = {}
    for k, _, html in rows:
        best[html or ""] = max(best.get(html or "", -1), -1 if k is None else k)
    wanted = []
    for k, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = best[html or ""]
        wanted.append((str(k), len(data), digest, "response" if k == first else "revisit",
                       None if k == first else first))
    assert sorted(map(str, wanted)) == sorted(
        str((str(r["page_id"]), *list(r)[1:])) for r in found
    )


# --- awkward rows and empty tables ----------------------------------------------


def test_awkward_rows(spark, awkward):
    count = awkward.count()
    assert line_chunks.remove_repeated(awkward).count() == count
    assert fingerprints.fingerprint_neighbours(awkward).count() == count
    found = jaccard.near_duplicates(awkward).collect()
    assert len(found) == count
    assert {r["class_id"] for r in found if r["doc_id"] in (6, 7)} == {6}
    assert language.identify(awkward, PIECES).count() == count
    docs = awkward.select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "text", "source")
    rows = numbered(docs.select("doc_id", "source", mixing.word_count(F.col("text"))
                                .alias("size"), F.xxhash64("text").alias("content")), "t")
    draws, _ = mixing.mix(rows)
    total = rows.agg(F.sum("size")).first()[0]
    assert abs(draws.agg(F.sum("words")).first()[0] - total) <= 4


def test_empty_tables(spark, nothing):
    marks = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert packing.pack_documents(nothing, VOCABULARY).count() == 0
    assert sharding.shuffle_into_shards(nothing).count() == 0
    assert line_chunks.remove_repeated(nothing).count() == 0
    assert fingerprints.fingerprint_neighbours(nothing).count() == 0
    assert jaccard.near_duplicates(nothing).count() == 0
    assert toxicity.detect(nothing, marks).count() == 0
    assert exact_dedup.exact_dedup(nothing).count() == 0
    assert language.identify(nothing, PIECES).count() == 0
    rows = nothing.select(F.lit(0).cast("bigint").alias("row"), "source",
                          F.lit(1).cast("bigint").alias("size"), F.lit(1).alias("content"))
    assert mixing.mix(rows)[0].count() == 0
