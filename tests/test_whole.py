"""Split arrays, one-pass phrases, entities, skill sets and the search index."""

import html as html_module
import itertools
import json
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hirelens.functions.phrases import PhraseIndex
from hirelens.operators import bronze as B
from hirelens.operators.pages import decode_entities
from hirelens.plans import explore, search_index, skill_sets
from hirelens.operators.keyed import new_rows
from hirelens.sources import json_arrays, raw_records, url_lists
from hirelens.sources.tables import write_keys

# --- JSON arrays in ranges --------------------------------------------------------


@pytest.fixture
def small_ranges(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


NASTY = [
    {"source_name": "b", "raw_payload": {"job_id": "1", "t": 'a]},{"b\\', "x": {"y": [1, {"z": {}}]}}},
    {"source_name": "b", "raw_payload": {"job_id": "2", "t": "}" * 40 + '"' + "[{," * 9}},
    {"source_name": "é\n", "raw_payload": {"job_id": "3", "t": "\\\"}]" * 7, "l": [[], [{}], "}"]}},
    {"source_name": "b", "raw_payload": {"job_id": "4"}}, {},
    {"source_name": "b", "source_url": "u", "raw_payload": {"job_id": "5", "long": "w}" * 900}},
]


@pytest.mark.parametrize("indent", [None, 2])
def test_elements_of_a_split_array(spark, tmp_path, small_ranges, indent):
    draw = random.Random(3)
    records = NASTY + [
        {"source_name": "s", "raw_payload": {"job_id": str(i), "t": "".join(
            draw.choices('ab{}[]",\\ é', k=draw.randrange(40)))}} for i in range(60)
    ]
    path = tmp_path / "a.json"
    path.write_text(json.dumps(records, indent=indent, ensure_ascii=False), encoding="utf-8")
    for size in (37, 64, 500, 1 << 20):
        small_ranges(size)
        rows = json_arrays.array_elements(spark, str(path)).orderBy("position").collect()
        assert [json.loads(r["value"]) for r in rows] == records, size
        assert len({r["position"] for r in rows}) == len(rows)


def test_split_arrays_are_read_like_whole_ones(spark, tmp_path, small_ranges):
    for name, body in {
        "a.json": json.dumps(NASTY, indent=1), "b.json": "[]", "c.json": " [ ] \n",
        "d.json": json.dumps(NASTY[:1]),
    }.items():
        (tmp_path / name).write_text(body, encoding="utf-8")
    small_ranges(50)
    whole = raw_records.read_raw_records(spark, str(tmp_path), "array")
    split = raw_records.read_raw_records(spark, str(tmp_path), "split_array")
    assert split.drop("position").columns == whole.drop("position").columns

    def shown(df):
        hashed = B.with_content_hash(df.filter("unreadable is null"))
        return sorted(map(repr, hashed.select("source_name", "source_url", "content_hash").collect()))

    assert shown(split) == shown(whole) and split.count() == len(NASTY) + 1
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "x.json").write_text('[{"source_name": "k"}, 5, "x}", {"a": }]')
    broken = raw_records.read_raw_records(spark, str(tmp_path / "e"), "split_array")
    assert [r["unreadable"] is None for r in broken.orderBy("position").collect()] == [
        True, False, False, False]
    assert [r.reject_reason for r in B.with_reject_reason(broken).orderBy("position").collect()][1:] \
        == [B.UNREADABLE] * 3


def test_a_large_array_is_read_in_several_tasks(spark, tmp_path):
    raw = spark.range(20_000).select(
        F.lit("s").alias("source_name"), F.lit("u").alias("source_url"),
        F.lit("t").alias("scraped_at"),
        F.to_json(F.struct(F.col("id").cast("string").alias("job_id"),
                           F.repeat(F.lit("x}{"), 120).alias("text"))).alias("raw_payload"))
    path = str(tmp_path / "arrays")
    raw_records.write_record_arrays(raw.coalesce(1), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        read = raw_records.read_raw_records(spark, path, "split_array")
        pieces = spark.read.text(path, lineSep="}").rdd.getNumPartitions()
        assert pieces > 5
        ids = B.with_keys(read).select(F.col("source_job_id").cast("long").alias("i"))
        found = ids.agg(F.count("*"), F.sum("i"), F.countDistinct("i")).first()
        assert tuple(found) == (20_000, sum(range(20_000)), 20_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")


# --- phrases ----------------------------------------------------------------------


def test_lists_of_phrases_in_one_pass(column):
    lists = {
        "a": ["data analyst intern", "data", "analyst", "a/b", "c++"],
        "b": ["data analyst", "intern data", "data-driven", "étude", "5+ years"],
        "c": ["data analyst intern", "x"], "d": [],
    }
    index = PhraseIndex(lists)
    draw = random.Random(9)
    words = ["data", "analyst", "intern", "data-driven", "a/b", "c++", "étude", "5+", "years", "x",
             "xdata", "data_", "-", "analysts", "5+years", "c+++", "  "]
    texts = [None, ""] + [" ".join(draw.choices(words, k=draw.randrange(9))) for _ in range(300)]

    def plain(text, phrases):
        for p in phrases:
            if text is not None and re.search(rf"(?<!\w){re.escape(p)}(?!\w)", text):
                return p
        return None

    for name, phrases in lists.items():
        got = column(texts, lambda c, name=name: index.first(index.found(c), name))
        assert got == [plain(t, phrases) for t in texts], name
        has = column(texts, lambda c, name=name: F.coalesce(
            index.has(index.found(c), name), F.lit(False)).cast("string"))
        assert has == [str(plain(t, phrases) is not None).lower() for t in texts]


# --- entities ---------------------------------------------------------------------


def test_entities_are_decoded_once(column):
    values = ["a&amp;b", "&amp;lt;", "&eacute;&#233;&#xE9;&#XE9;", "x&#47;y&colon;", "&", "&&amp;",
              "&unknown; &lt;&gt;&quot;&apos;", "no", "", None, "&#128512;", "a=1&b=2", "&amp"]
    kept = {"x&#47;y&colon;": "x/y&colon;", "&amp": "&amp"}
    wanted = [v if v is None else kept.get(v, html_module.unescape(v)) for v in values]
    assert column(values, decode_entities) == wanted
    assert column(["&#0;", "&#xD800;", "&#9999999;"], decode_entities) == [
        "&#0;", "&#xD800;", "&#9999999;"]


# --- sets of skills ---------------------------------------------------------------


def test_frequent_sets_of_a_role(spark):
    draw = random.Random(4)
    jobs = [(j, draw.choice(["x", "y", None])) for j in range(80)]
    links = [(j, s) for j, _ in jobs for s in draw.sample(range(8), draw.randrange(0, 6))]
    links += links[:30] + [(0, None), (999, 1)]
    own = dict(jobs)
    baskets = {}
    for j, s in links:
        if own.get(j) and s is not None:
            baskets.setdefault(j, set()).add(s)
    for support, largest in ((6, None), (2, 3), (1, 2)):
        counts = Counter(
            (own[j], c) for j, b in baskets.items()
            for n in range(2, (largest or 8) + 1) for c in itertools.combinations(sorted(b), n))
        found = skill_sets.skill_sets(
            spark.createDataFrame(jobs, "job_id long, detected_role string"),
            spark.createDataFrame(links, "job_id long, skill_id long"), support, largest)
        got = {(r["detected_role"], tuple(r["skill_ids"])): r["jobs"] for r in found.collect()}
        assert got == {k: n for k, n in counts.items() if n >= support}
    none = skill_sets.skill_sets(
        spark.createDataFrame([], "job_id long, detected_role string"),
        spark.createDataFrame(links, "job_id long, skill_id long"), 1)
    assert none.collect() == []


# --- known keys -------------------------------------------------------------------


def test_stored_keys_are_not_moved(spark):
    keys = ["source_name", "source_job_id"]
    stored = spark.range(500).select(
        F.concat(F.lit("s"), F.col("id") % 3).alias("source_name"),
        F.col("id").cast("string").alias("source_job_id"))
    table = write_keys(stored, "known_job_keys", keys, 6)
    url_table = write_keys(
        stored.select(F.concat(F.lit("u"), "source_job_id").alias("url")), "known_urls", ["url"], 6)
    incoming = spark.range(480, 520).select(
        F.concat(F.lit("s"), F.col("id") % 3).alias("source_name"), F.col("id").cast("string").alias("source_job_id"),
        F.col("id").alias("position"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for found, count in (
            (new_rows(table, incoming, keys, ["position"]), 20),
            (url_lists.new_urls(
                incoming.select(F.concat(F.lit("u"), "source_job_id").alias("url")), url_table), 20),
        ):
            assert found.count() == count
            plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
            depth = lambda line: len(line) - len(line.lstrip(" +-:"))
            at = next(i for i, line in enumerate(plan) if "Bucketed: true" in line)
            above, now = [], depth(plan[at])
            for line in reversed(plan[:at]):
                if depth(line) < now:
                    above, now = [*above, line], depth(line)
                    if "Join" in line:
                        break
            assert "Join" in above[-1] and not any("Exchange" in line for line in above)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE known_job_keys")
        spark.sql("DROP TABLE known_urls")


# --- search -----------------------------------------------------------------------


def test_index_finds_what_the_explorer_finds(spark, tmp_path):
    draw = random.Random(5)
    words = ["Data", "analyst", "Ünder", "é", "SQL, Excel", "x", "", None, "München"]
    rows = [(i, *[draw.choice(words) if draw.random() < .5 else f"{draw.choice(words)} {draw.choice(words)}"
                  for _ in range(4)]) for i in range(120)]
    mart = spark.createDataFrame(
        rows, "job_id long, job_title string, company_name string, location_text string, "
              "skill_names string").withColumns({
                  "is_excluded_from_analysis": F.lit(False), "detected_role": F.lit("x"),
                  "source_url": F.lit("u")})
    path = str(tmp_path / "index")
    search_index.write_search_index(mart, path)
    terms = ["data", " DATA ", "a", "an", "nal", "analyst", "data analyst", "ünder", "é", "sql, e", "",
             "none such", "zzz", "qq", "ünchen x", "l, excel"]
    asked = spark.createDataFrame([(t,) for t in terms] + [(None,)], "term string")
    got = {}
    for r in search_index.search(spark, path, mart, asked).collect():
        assert r["job_id"] not in got.setdefault(r["term"], set())
        got[r["term"]].add(r["job_id"])
    for term in terms:
        wanted = {r["job_id"] for r in explore.explore_jobs(mart, search=term).collect()}
        assert got.get(term.strip().lower(), set()) == wanted, term
    empty = mart.limit(0)
    search_index.write_search_index(empty, path + "2")
    assert search_index.search(spark, path + "2", empty, asked).collect() == []
