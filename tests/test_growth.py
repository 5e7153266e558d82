"""Work that must grow no faster than the input."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from hirelens.operators import keyed, skills
from hirelens.plans import search_index, skill_sets
from hirelens.session import configure


def test_search_index_holds_a_job_once_a_word_at_most(spark, tmp_path):
    explorer = spark.range(40).select(
        F.col("id").alias("job_id"), F.lit("Data engineer of pipelines").alias("job_title"),
        F.concat(F.lit("Company#"), "id").alias("company_name"),
        F.lit(None).cast("string").alias("location_text"),
        F.lit("SQL, blue gear, large ring").alias("skill_names"))
    path = str(tmp_path / "index")
    search_index.write_search_index(explorer, path)
    assert spark.read.parquet(f"{path}/postings").count() <= 40 * 10
    terms = ["e gear, large r", "ue gea", "gear, large", "engineer of pipe", "rline", "y#7", "of  p"]
    asked = spark.createDataFrame([(t,) for t in terms], "term string")
    got = search_index.search(spark, path, explorer, asked).groupBy("term").count().collect()
    assert {r["term"]: r["count"] for r in got} == {
        "e gear, large r": 40, "ue gea": 40, "gear, large": 40, "engineer of pipe": 40, "y#7": 1}


def test_sets_of_a_job_in_two_roles_stay_apart(spark):
    own = spark.createDataFrame(
        [(j, r) for j in (1, 2) for r in ("x", "y")] + [(3, "x")],
        "job_id long, detected_role string")
    links = spark.createDataFrame(
        [(j, s) for j in (1, 2, 3) for s in (4, 5)], "job_id long, skill_id long")
    found = skill_sets.skill_sets(own, links, 2)
    assert sorted(map(tuple, found.collect())) == [("x", [4, 5], 2, 3), ("y", [4, 5], 2, 2)]


def test_answers_are_reduced_in_their_own_row(spark):
    item = '{"skill_name":"%s","raw_mention":"%s","confidence_score":%s}'
    texts = {
        1: [("sql", "a", 0.2), ("Go", "b", 0.1), ("SQL", "c", 0.9), ("go", "d", 0.1)],
        2: [("sql", "a", 0.2)], 3: [("sql", "e", "null"), ("SQL", "f", 0)],
    }
    rows = [(j, '{"skills":[' + ",".join(item % i for i in items) + "]}")
            for j, items in texts.items()]
    rows += [(2, '{"skills":[' + item % ("SQL", "z", 0.3) + "]}"), (4, "no"), (None, rows[0][1])]
    answers = spark.createDataFrame(rows, "job_id long, response_text string")
    lists = skills.response_lists(skills.parse_responses(answers)).localCheckpoint()
    by_row = skills.deduplicate(skills.response_items(lists))
    found = skills.deduplicate(lists)
    assert sorted(map(str, found.collect())) == sorted(map(str, by_row.collect()))
    assert found.filter("job_id = 1").select("position", "skill_name", "raw_mention").collect() == [
        (1, "Go", "b"), (0, "SQL", "c")]
    joined = lists.select("job_id", "failure").join(skills.response_items(lists), "job_id", "left")
    assert sorted(map(str, skills.responses_with_items(lists).collect())) == sorted(
        map(str, joined.collect()))


def test_first_rows_of_a_key_need_no_sort(spark):
    rows = [(k, j, p) for k in ("a", "b", None) for j in (None, 3, 1, 1) for p in (2, 1)
            if not (k == "b" and j is None)]
    df = spark.createDataFrame(rows, "k string, job_id long, position int")
    left = keyed.least_rows(df, ["k"], "job_id")
    assert sorted(map(str, left.select("k", "job_id").distinct().collect())) == sorted(
        ["Row(k='a', job_id=None)", "Row(k='b', job_id=1)", "Row(k=None, job_id=None)"])
    plan = df.sparkSession.createDataFrame(rows, df.schema).groupBy("k").min("job_id")
    assert "SortAggregate" not in plan._jdf.queryExecution().executedPlan().toString()


def test_stored_layers_are_packed_tightly(spark, tmp_path):
    path = str(tmp_path / "t")
    configure(spark).range(5).write.parquet(path)
    assert any(".zstd." in name for name in os.listdir(path))
