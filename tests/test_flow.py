import hashlib
import json

import pytest
from pyspark.sql import functions as F

from hirelens.operators import bronze as B
from hirelens.operators import skills as K
from hirelens.plans import refresh as R
from hirelens.sources import raw_records, search_config, url_lists
from hirelens.streaming import ingest


def record(job_id, title="Data Engineer", text="Python and SQL with PowerBI", **extra):
    payload = {"job_id": job_id, "title": title, "company": "A", "location": "Rabat, Morocco",
               "description_text": text, **extra}
    return {"source_name": "board", "source_url": f"https://b/{job_id}",
            "scraped_at": "2026-06-18T08:00:00+00:00", "raw_payload": payload}


FIRST = [
    record("1"),
    record("2", title="Senior Data Analyst", text="Tableau, R and Excel"),
    record("1", title="copy of the first"),
    {"source_name": "board", "raw_payload": "text"},
    {"source_name": "", "raw_payload": {"job_id": "9"}},
    {"source_name": "board", "raw_payload": {"title": "no id"}},
    record(3, title="Baker", text="flour", tags=["é", {"b": 1, "a": None}]),
    record("4", title="  "),
]
SECOND = [record("1", title="changed"), record("5", title="ML Engineer", text="python postgres")]


def write(path, records):
    path.write_text(json.dumps(records, indent=2, ensure_ascii=False), encoding="utf-8")
    return str(path)


def test_content_hash_is_sha256_of_canonical_json(spark, tmp_path):
    frame = raw_records.read_raw_records(spark, write(tmp_path / "a.json", FIRST))
    got = {r.position: r.content_hash for r in B.with_content_hash(frame).collect()}
    for position in (0, 6):
        text = json.dumps(FIRST[position]["raw_payload"], sort_keys=True, ensure_ascii=False,
                          separators=(",", ":"))
        assert got[position] == hashlib.sha256(text.encode()).hexdigest()


def test_validation_and_outcomes(spark, tmp_path):
    frame = raw_records.read_raw_records(spark, write(tmp_path / "a.json", FIRST))
    checked = B.with_reject_reason(frame)
    assert [r.reject_reason for r in checked.orderBy("position").collect()] == [
        None, None, None, B.MISSING_PAYLOAD, B.MISSING_SOURCE, B.MISSING_JOB_ID, None, None
    ]
    stored = spark.createDataFrame([("board", "2")], "source_name string, source_job_id string")
    outcomes = B.with_outcome(checked, stored)
    assert [r.outcome for r in outcomes.orderBy("position").collect()] == [
        "inserted", "skipped_duplicate", "skipped_duplicate", "failed", "failed", "failed",
        "inserted", "inserted",
    ]
    counts = B.load_counts(outcomes).first()
    assert (counts.inserted_count, counts.skipped_count, counts.failed_count, counts.status) == (
        3, 2, 3, "partial_success"
    )
    profile = B.duplicate_profile(frame).first()
    assert profile.total_records == 8 and profile.duplicate_job_ids
    assert B.single_source(frame) == "board"
    with pytest.raises(ValueError):
        B.single_source(frame.unionByName(frame.withColumn("source_name", F.lit("other"))))
    with pytest.raises(ValueError):
        raw_records.require_records(frame.limit(0))


def test_status_rules(spark):
    cases = [(1, 0, 0, 1, "success"), (1, 0, 1, 2, "partial_success"), (0, 0, 2, 2, "failed"),
             (0, 0, 0, 0, "success")]
    frame = spark.createDataFrame(cases, "i int, s int, f int, t int, want string")
    status = B.final_status(*[F.col(c) for c in "isft"])
    assert [r.got for r in frame.select(status.alias("got")).collect()] == [c[4] for c in cases]


def test_refresh_end_to_end_and_again(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    first = R.refresh(spark, write(tmp_path / "a.json", FIRST), root)
    assert (first.run_id, first.status) == (1, "partial_success")
    jobs = {r.source_job_id: r for r in first.tables["job_postings"].collect()}
    assert set(jobs) == {"1", "2", "3"} and jobs["1"].job_title == "Data Engineer"
    assert jobs["1"].country == "Morocco"
    names = {r.skill_name for r in first.tables["skills"].collect()}
    assert names == {"Python", "SQL", "Power BI"}  # the senior job is left out
    overview = first.marts["mart_market_overview"].first()
    assert (overview.total_jobs, overview.excluded_jobs, overview.total_skills) == (3, 1, 3)
    assert first.checks.agg(F.sum("failures")).first()[0] == 0

    second = R.refresh(spark, write(tmp_path / "b.json", SECOND), root)
    again = {r.source_job_id: r for r in second.tables["job_postings"].collect()}
    assert second.status == "success" and set(again) == {"1", "2", "3", "5"}
    assert again["1"].job_id == jobs["1"].job_id and again["1"].job_title == "Data Engineer"
    assert again["1"].created_at == jobs["1"].created_at
    old_ids = {r.skill_name: r.skill_id for r in first.tables["skills"].collect()}
    new_ids = {r.skill_name: r.skill_id for r in second.tables["skills"].collect()}
    assert old_ids.items() <= new_ids.items() and "PostgreSQL" in new_ids
    ledger = {r.pipeline_run_id: r for r in R.runs(spark, root).collect()}
    assert ledger[1].failed_records_count == 3 and ledger[2].inserted_raw_count == 1
    assert ledger[2].cleaned_records_count == 4

    third = R.refresh(spark, write(tmp_path / "c.json", SECOND), root, force_skills=True)
    assert third.tables["raw_job_postings"].count() == 5
    same = ["job_id", "skill_id", "extraction_method", "raw_mention"]
    assert sorted(map(tuple, third.tables["job_skills"].select(*same).collect())) == sorted(
        map(tuple, second.tables["job_skills"].select(*same).collect())
    )


def test_failed_refresh_is_recorded_and_leaves_the_snapshot(spark, tmp_path):
    root = str(tmp_path / "warehouse")

    def broken(todo, aliases):
        raise RuntimeError("no extractor")

    with pytest.raises(RuntimeError):
        R.refresh(spark, write(tmp_path / "a.json", FIRST), root, extractor=broken)
    run = R.runs(spark, root).first()
    assert (run.status, run.failed_records_count, run.inserted_raw_count) == ("failed", 8, 0)
    assert R.latest_snapshot(spark, root) is None
    result = R.refresh(spark, write(tmp_path / "a.json", FIRST), root, skip_skills=True)
    assert result.tables["job_postings"].count() == 3


def test_refresh_with_responses(spark, tmp_path):
    answer = json.dumps({"skills": [
        {"skill_name": "pyspark", "skill_category": "x", "raw_mention": "PySpark",
         "confidence_score": "0.9"},
        {"skill_name": "Spark", "confidence_score": 0.95}, 5, {"skill_name": "teamwork"}]})
    responses = spark.createDataFrame(
        [(1, f"```json\n{answer}\n```"), (2, "broken"), (3, '{"skills": 1}')],
        "job_id bigint, response_text string",
    )
    extractor = R.extract_from_responses(responses)
    result = R.refresh(spark, write(tmp_path / "a.json", FIRST), str(tmp_path / "w"),
                       extractor=extractor)
    links = result.tables["job_skills"].collect()
    assert [(r.job_id, r.extraction_method, str(r.confidence_score)) for r in links] == [
        (1, "ai", "0.9500")
    ]
    assert [r.skill_name for r in result.tables["skills"].collect()] == ["Spark"]
    assert [r.alias_name for r in result.tables["skill_aliases"].collect()] == ["spark"]


def test_response_edge_cases(spark):
    texts = {
        1: '{"skills":[]}', 2: '{"skills":null}', 3: '{}', 4: '{"skills":"x"}', 5: "nope",
        6: "[1]", 7: '{"skills":[{"skill_name":"SQL","confidence_score":NaN}]}',
        8: '{"skills":[{"skill_name":"sql","confidence_score":true},{"skill_name":"SQL"}]}',
    }
    frame = spark.createDataFrame(list(texts.items()), "job_id bigint, response_text string")
    parsed = K.parse_responses(frame)
    failures = {r.job_id: r.failure for r in parsed.collect()}
    assert [failures[i] for i in range(1, 9)] == [
        None, None, None, K.NOT_A_LIST, K.BAD_JSON, K.BAD_JSON, K.BAD_JSON, None
    ]
    kept = K.deduplicate(K.response_items(parsed)).collect()
    assert [(r.job_id, r.skill_name, r.confidence_score) for r in kept] == [(8, "sql", 1.0)]
    report = K.extraction_report(parsed, K.deduplicate(K.response_items(parsed))).first()
    assert (report.jobs_processed, report.links_saved, report.failed_jobs) == (4, 1, 4)


def test_replace_links_drops_stale_ones(spark):
    stored = spark.createDataFrame(
        [(1, 1, "ai", "a", None, None), (2, 1, "ai", "a", None, None)],
        "job_id bigint, skill_id bigint, extraction_method string, raw_mention string, "
        "confidence_score decimal(5,4), created_at timestamp",
    )
    linked = spark.createDataFrame(
        [(1, 2, "b", 0.5, 0)],
        "job_id bigint, skill_id bigint, raw_mention string, confidence_score double, "
        "position int",
    )
    kept = K.upsert_links(stored, linked, "rule_based")
    assert sorted((r.job_id, r.skill_id) for r in kept.collect()) == [(1, 1), (1, 2), (2, 1)]
    replaced = K.upsert_links(stored, linked, "rule_based", replace_links=True)
    assert sorted((r.job_id, r.skill_id) for r in replaced.collect()) == [(1, 2), (2, 1)]


def test_dictionary_paths_agree(spark):
    texts = spark.createDataFrame(
        [(1, "Knows C++, Power  BI and node.js; power bi!"), (2, "powerbi"), (3, None),
         (4, "Google Cloud Platform (GCP)"), (5, "big" * 3)],
        "job_id bigint, text string",
    )
    aliases = spark.createDataFrame(
        [("c++", 1), ("power bi", 2), ("powerbi", 2), ("node.js", 3), ("gcp", 4),
         ("google cloud platform", 4), ("bi", 5), ("", 6)],
        "alias_name string, skill_id bigint",
    )
    expected = [(1, 1, "c++"), (1, 2, "power bi"), (1, 3, "node.js"), (1, 5, "bi"),
                (2, 2, "powerbi"), (4, 4, "gcp")]
    inline = K.extract_by_dictionary(texts, aliases)
    joined = K.extract_by_dictionary(texts, aliases, max_inline=2)
    assert sorted(map(tuple, inline.collect())) == expected
    assert sorted(map(tuple, joined.collect())) == expected
    assert K.extract_by_dictionary(texts, aliases.limit(0)).count() == 0


def test_stream_equals_batch_and_is_idempotent(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    root = str(tmp_path / "store")
    write(source / "a.json", FIRST)
    ingest.load_new_files(spark, str(source), root)
    write(source / "b.json", SECOND)
    ingest.load_new_files(spark, str(source), root)
    ingest.load_new_files(spark, str(source), root)
    got = {(r.source_job_id, r.content_hash) for r in ingest.stored(spark, root).collect()}

    batch = raw_records.read_raw_records(spark, str(source / "a.json"))
    nothing = spark.createDataFrame([], "source_name string, source_job_id string")
    kept = B.with_outcome(B.with_reject_reason(batch), nothing).filter("outcome = 'inserted'")
    expected = {(r.source_job_id, r.content_hash) for r in B.with_content_hash(kept).collect()}
    fresh = raw_records.read_raw_records(spark, str(source / "b.json"))
    new = B.with_content_hash(B.with_keys(fresh)).filter("source_job_id = '5'").first()
    assert got == expected | {("5", new.content_hash)}
    assert ingest.rejected(spark, root).count() == 3
    # a replayed micro-batch rewrites its own folder
    ingest.load_batch(fresh.drop("position"), 1, root)
    assert ingest.stored(spark, root).count() == len(got)


def test_broken_records_are_rejected(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    root = str(tmp_path / "store")
    good = [json.dumps(FIRST[0]), json.dumps(FIRST[1])]
    (source / "a.json").write_text("\n".join([good[0], '{"source_name": "board", ', good[1]]),
                                   encoding="utf-8")
    checked = B.with_reject_reason(
        raw_records.read_raw_records(spark, str(source / "a.json"), "lines")
    ).orderBy("position")
    rows = checked.collect()
    assert [r.reject_reason for r in rows] == [None, B.UNREADABLE, None]
    assert rows[1].raw_payload == '{"source_name": "board", '
    ingest.load_new_files(spark, str(source), root, "lines")
    (source / "b.json").write_text('[{"source_name"', encoding="utf-8")
    ingest.load_new_files(spark, str(source), root, "lines")
    keys = {(r.source_name, r.source_job_id) for r in rows if not r.reject_reason}
    assert {(r.source_name, r.source_job_id) for r in ingest.stored(spark, root).collect()} == keys
    refused = ingest.rejected(spark, root).collect()
    assert {r.reject_reason for r in refused} == {B.UNREADABLE}
    assert {r.raw_payload for r in refused} == {'{"source_name": "board", ', '[{"source_name"'}
    array = raw_records.read_raw_records(spark, str(source / "b.json"))
    assert [r.reject_reason for r in B.with_reject_reason(array).collect()] == [B.UNREADABLE]


def test_json_sink_round_trip(spark, tmp_path):
    frame = raw_records.read_raw_records(spark, write(tmp_path / "a.json", FIRST[:3]))
    raw_records.write_records(frame, str(tmp_path / "out"))
    back = raw_records.read_raw_records(spark, str(tmp_path / "out"), "lines")
    columns = ["source_name", "source_url", "content_hash"]
    assert sorted(map(tuple, B.with_content_hash(back).select(*columns).collect())) == sorted(
        map(tuple, B.with_content_hash(frame).select(*columns).collect())
    )


def test_url_lists_and_search_config(spark, tmp_path):
    (tmp_path / "urls.txt").write_text("# jobs\n https://a \n\n#x\nhttps://b\n", encoding="utf-8")
    urls = url_lists.read_urls(spark, str(tmp_path / "urls.txt"))
    assert [r.url for r in urls.collect()] == ["https://a", "https://b"]
    config = {
        "location": "United States", "max_urls_per_search": 200, "offset_step": 20,
        "max_pages": 30, "delay_seconds": 3, "output_dir": "out",
        "searches": [{"name": "de", "keywords": "data engineer"},
                     {"name": "ml", "keywords": "ml engineer", "max_urls": 5}],
    }
    (tmp_path / "c.json").write_text(json.dumps(config, indent=2), encoding="utf-8")
    frame = search_config.read_search_config(spark, str(tmp_path / "c.json"))
    got = search_config.searches(frame).orderBy("search_index").collect()
    assert [(r.search_name, r.max_urls, r.max_consecutive_no_new) for r in got] == [
        ("de", 200, 2), ("ml", 5, 2)
    ]
    assert got[0].search_url.endswith("?keywords=data+engineer&location=United+States")
    assert search_config.config_errors(frame).count() == 0
    broken = frame.withColumn("location", F.lit(None).cast("string"))
    assert search_config.config_errors(broken).first().error == "missing field: location"
