"""Loads and refreshes that follow what changed, against full ones."""

import json

import pytest
from pyspark.sql import functions as F
from test_flow import FIRST, SECOND, record, write

from pyspark.sql.types import StructType

from hirelens.operators import bronze as B
from hirelens.operators import skills as K
from hirelens.plans import incremental as I
from hirelens.plans import refresh as R
from hirelens.sources.buckets import BucketStore
from hirelens.streaming import ingest

TIMES = {"cleaned_at", "created_at", "updated_at", "analyzed_at", "built_at", "ingested_at"}
THIRD = [
    # a key that equals a stored one after cleaning: the posting is updated
    record(" 3", title="Data Scientist", text="Python and R with forecasting models"),
    record("6", title="Data Engineer", text="Airflow, Kafka and  PySpark"),
    record("7", title="Data Engineer", text="nothing known"),
    {"source_name": "board", "raw_payload": "text"},
]


def rows(df):
    columns = sorted(c for c in df.columns if c not in TIMES)
    return sorted(map(repr, df.select(*columns).collect()))


def lines(path, records):
    path.write_text("".join(json.dumps(r) + "\n" for r in records), encoding="utf-8")
    return str(path)


def same_as_full(spark, root, full):
    store = I.store_of(spark, root)
    for name in ("job_postings", "job_analysis", "job_skills", "skills", "skill_aliases"):
        assert rows(store.read(name)) == rows(full.tables[name]), name
    marts = I.marts_of(store.read("mart_counts"), store.read("skills"))
    marts["mart_job_explorer"] = store.read("mart_job_explorer")
    for name, mart in marts.items():
        assert rows(mart) == rows(full.marts[name]), name


def test_incremental_equals_full_refresh(spark, tmp_path):
    full_root, root = str(tmp_path / "full"), str(tmp_path / "inc")
    for n, records in enumerate([FIRST, SECOND + THIRD]):
        path = write(tmp_path / f"{n}.json", records)
        full = R.refresh(spark, path, full_root)
        result = I.refresh_incremental(spark, path, root, buckets=3)
        same_as_full(spark, root, full)
        assert result.checks.agg(F.sum("failures")).first()[0] == 0
    assert rows(I.raw_rows(spark, root)) == rows(full.tables["raw_job_postings"])
    left = I.ledger(spark, root).drop("started_at", "finished_at", "cleaned_records_count")
    right = R.runs(spark, full_root).drop("started_at", "finished_at", "cleaned_records_count")
    assert rows(left) == rows(right)
    # cleaned rows of the run itself, not of the whole table
    cleaned = {r.pipeline_run_id: r.cleaned_records_count for r in I.ledger(spark, root).collect()}
    assert cleaned == {1: 3, 2: 4}


def test_buckets_are_written_anew_when_they_have_many_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("hirelens.sources.buckets.MOST_PARTS", 2)
    kinds = {"a": StructType().add("k", "string").add("n", "long"),
             "b": StructType().add("k", "string").add("n", "long")}
    root, seen = str(tmp_path / "store"), {}
    for n in range(6):
        store = BucketStore(spark, root, kinds, 2)
        assert store.version == n + 1 and store.buckets == 2
        rows = [(f"{n}{i}", n) for i in range(5)]
        seen.update(rows)
        store.append("a", spark.createDataFrame(rows, kinds["a"]), ["k"])
        changed = [*rows, (f"{max(n - 1, 0)}0", 100 + n)]
        new = spark.createDataFrame(changed, kinds["b"])
        store.upsert("b", new, ["k"], ["k"], ["n"], order=["n"])
        store.commit({"n": n})
        assert all(len(own) <= 3 for own in BucketStore(spark, root, kinds).parts.values())
    store = BucketStore(spark, root, kinds)
    assert dict(map(tuple, store.read("a").collect())) == seen and store.counters == {"n": 5}
    wanted = {k: 100 + int(k[0]) + 1 if k.endswith("0") and k != "50" else v
              for k, v in seen.items()}
    assert dict(map(tuple, store.read("b").collect())) == wanted
    store.replace("b", spark.createDataFrame([], kinds["b"]), ["k"])
    assert store.read("b").count() == 0 and store.read("b", before=True).count() == 30
    store.commit({})
    assert BucketStore(spark, root, kinds).read("b").count() == 0


def test_a_broken_change_is_repeated(spark, tmp_path):
    root = str(tmp_path / "inc")
    first = write(tmp_path / "a.json", FIRST)
    I.load(spark, first, root, buckets=2)

    def broken(todo, aliases):
        raise RuntimeError("no extractor")

    with pytest.raises(RuntimeError):
        I.apply_changes(spark, root, broken, buckets=2)
    store = I.store_of(spark, root)
    assert store.version == 1 and store.read("job_postings").count() == 0
    I.apply_changes(spark, root, buckets=2)
    full = R.refresh(spark, first, str(tmp_path / "full"))
    same_as_full(spark, root, full)


def test_skipped_skills_are_made_up_for(spark, tmp_path):
    root, full_root = str(tmp_path / "inc"), str(tmp_path / "full")
    path = write(tmp_path / "a.json", FIRST)
    I.refresh_incremental(spark, path, root, skip_skills=True, buckets=2)
    assert I.store_of(spark, root).read("job_skills").count() == 0
    I.refresh_incremental(spark, write(tmp_path / "b.json", SECOND), root, buckets=2)
    R.refresh(spark, path, full_root, skip_skills=True)
    same_as_full(spark, root, R.refresh(spark, str(tmp_path / "b.json"), full_root))


def test_an_empty_category_that_is_filled_moves_its_jobs(spark, tmp_path):
    """A stored skill without a category gets one from a later job; the earlier job shows it."""
    root = str(tmp_path / "inc")

    def answers(category):
        def extract(todo, aliases):
            return todo.select(
                "job_id", F.lit(0).alias("position"), F.lit("Python").alias("skill_name"),
                F.lit(category).alias("skill_category"), F.lit("python").alias("raw_mention"),
                F.lit(None).cast("double").alias("confidence_score"),
            ), "ai"
        return extract

    I.refresh_incremental(spark, write(tmp_path / "a.json", [record("1")]), root,
                          extractor=answers(""), buckets=2)
    last = I.refresh_incremental(spark, write(tmp_path / "b.json", [record("2")]), root,
                                 extractor=answers("Programming"), buckets=2)
    shown = {r.source_url: r.skill_categories for r in last.marts["mart_job_explorer"].collect()}
    assert shown == {"https://b/1": "Programming", "https://b/2": "Programming"}
    row = last.marts["mart_skills_by_category"].collect()
    assert [(r.skill_category, r.jobs_with_category, r.job_skill_links) for r in row] == [
        ("Programming", 2, 2)]


def test_second_load_reads_new_raw_rows_only(spark, tmp_path, monkeypatch):
    root, seen = str(tmp_path / "inc"), []
    many = [record(str(i), text="Python") for i in range(300)]
    I.refresh_incremental(
        spark, write(tmp_path / "a.json", many), root, skip_skills=True, buckets=2)
    original = I.S.silver_candidates
    monkeypatch.setattr(
        I.S, "silver_candidates",
        lambda raw, *rest: (seen.append(raw), original(raw, *rest))[1])
    I.refresh_incremental(
        spark, write(tmp_path / "b.json", [*many[:50], record("900")]), root,
        skip_skills=True, buckets=2)
    assert seen[0].count() == 1
    files = {name.rsplit("pipeline_run_id=", 1)[1].split("/")[0] for name in seen[0].inputFiles()}
    assert files == {"2"}


def test_phrase_index_with_a_large_dictionary(spark, monkeypatch):
    texts = spark.createDataFrame(
        [(1, "w7 w8 and x1 x2 x3; W199999!"), (2, "hot hot 5"), (3, None), (4, "x1 x2")],
        "job_id bigint, text string")
    known = [(f"w{i}", i) for i in range(100_000, 200_000)] + [(f"hot {i}", i) for i in range(100_000)]
    known += [("x1 x2 x3", -1), ("x2", -2), ("hot", -3), ("w8 and", -4)]
    aliases = spark.createDataFrame(known, "alias_name string, skill_id bigint")
    wanted = [(1, -4, "w8 and"), (1, -2, "x2"), (1, -1, "x1 x2 x3"), (1, 199_999, "w199999"),
              (2, -3, "hot"), (2, 5, "hot 5"), (4, -2, "x2")]
    assert sorted(map(tuple, K.extract_by_dictionary(texts, aliases).collect())) == wanted
    monkeypatch.setattr(K, "MAX_BROADCAST_BYTES", 0)
    assert sorted(map(tuple, K.extract_by_dictionary(texts, aliases).collect())) == wanted


# --- stream into bronze ---------------------------------------------------------


def test_stream_feeds_the_batch_table(spark, tmp_path):
    source, root, full_root = tmp_path / "in", str(tmp_path / "s"), str(tmp_path / "full")
    source.mkdir()
    for n, records in enumerate([FIRST, SECOND + THIRD]):
        lines(source / f"{n}.json", records)
        if n == 1:
            with (source / "1.json").open("a") as f:
                f.write("{broken\n")
        ingest.stream_into_bronze(spark, str(source), root, buckets=2)
        ingest.stream_into_bronze(spark, str(source), root, buckets=2)  # nothing new
        full = R.refresh(spark, str(source / f"{n}.json"), full_root, layout="lines")
    I.apply_changes(spark, root, buckets=2)  # both runs at once
    left = I.store_of(spark, root).read("job_postings").drop("job_id")
    assert rows(left) == rows(full.tables["job_postings"].drop("job_id"))
    assert rows(I.raw_rows(spark, root)) == rows(full.tables["raw_job_postings"])
    reasons = [r.reject_reason for r in I.rejected_rows(spark, root).collect()]
    assert reasons.count(B.UNREADABLE) == 1 and len(reasons) == 5
    ledger = {r.pipeline_run_id: r for r in I.ledger(spark, root).collect()}
    assert [ledger[n].status for n in (1, 2)] == ["partial_success"] * 2
    assert [ledger[n].failed_records_count for n in (1, 2)] == [3, 2]
    assert [ledger[n].source_name for n in (1, 2)] == ["board"] * 2


def test_a_failed_micro_batch_takes_the_same_ids(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    batch = spark.read.schema("source_name string, source_url string, scraped_at string, "
                              "raw_payload string").json(lines(tmp_path / "a.json", FIRST))
    ingest.load_bronze_batch(batch, 0, root, buckets=2)
    more = spark.read.schema(batch.schema).json(lines(tmp_path / "b.json", [*SECOND, *THIRD]))

    def fails(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(B, "close_run", fails)  # after the rows have been written
        patch.setattr(B, "fail_run", lambda opened, *rest: opened)
        with pytest.raises(RuntimeError):
            ingest.load_bronze_batch(more, 1, root, buckets=2)
    assert I.closed_runs(spark, root) == [1] and I.raw_rows(spark, root).count() == 4
    left = [r.raw_job_id for r in spark.read.parquet(f"{root}/raw_job_postings")
            .filter("pipeline_run_id = 2").collect()]
    assert ingest.load_bronze_batch(more, 1, root, buckets=2) == 2
    assert ingest.load_bronze_batch(more, 1, root, buckets=2) == 2  # known, not loaded again
    got = I.raw_rows(spark, root)
    assert got.count() == got.select("raw_job_id").distinct().count() == 8
    assert sorted(r.raw_job_id for r in got.filter("pipeline_run_id = 2").collect()) == sorted(left)
    assert sorted(left) == [5, 6, 7, 8]
    # a later run took the ids: the batch is loaded under a new number
    with monkeypatch.context() as patch:
        patch.setattr(B, "inserted_rows", fails)
        with pytest.raises(RuntimeError):
            ingest.load_bronze_batch(more, 2, root, buckets=2)
    other = I.load(spark, write(tmp_path / "c.json", [record("77")]), root, buckets=2)
    extra = spark.read.schema(batch.schema).json(lines(tmp_path / "d.json", [record("78")]))
    assert ingest.load_bronze_batch(extra, 2, root, buckets=2) > other
    got = I.raw_rows(spark, root)
    assert got.count() == got.select("raw_job_id").distinct().count() == 10
