import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from hirelens import schemas
from hirelens.operators import keyed as K
from hirelens.operators import quality as Q
from hirelens.plans import explore, gap, marts


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_insert_new_keeps_first_writer(spark):
    stored = spark.createDataFrame([("a", "old", 0)], "k string, v string, n int")
    incoming = spark.createDataFrame(
        [("a", "new", 1), ("b", "second", 3), ("b", "first", 2)], "k string, v string, n int"
    )
    once = K.insert_new(stored, incoming, ["k"], ["n"])
    assert rows(once, "k") == [("a", "old", 0), ("b", "first", 2)]
    assert rows(K.insert_new(once, incoming, ["k"], ["n"]), "k") == rows(once, "k")


def test_upsert_takes_nulls_and_keeps_the_rest(spark):
    stored = spark.createDataFrame(
        [(1, "a", "x", "c1", "u1"), (2, "b", "y", "c2", "u2")],
        "id int, title string, note string, created string, updated string",
    )
    incoming = spark.createDataFrame(
        [(1, None, 1), (3, "n", 2), (3, "last", 3)], "id int, title string, seq int"
    )
    merged = K.upsert(
        stored, incoming, ["id"], ["title"], ["seq"],
        on_update={"updated": F.lit("now")},
        on_insert={"created": F.lit("new"), "updated": F.lit("new")},
    )
    assert rows(merged, "id") == [
        (1, None, "x", "c1", "now"),
        (2, "b", "y", "c2", "u2"),
        (3, "last", None, "new", "new"),
    ]


def test_global_index_matches_sorted_order(spark):
    frame = spark.range(0, 1000).select(((F.col("id") * 7919) % 1000).alias("v"))
    indexed = K.with_global_index(frame.repartition(5), ["v"])
    assert indexed.filter("_index <> v").count() == 0
    ids = K.assign_ids(frame, "new_id", ["v"], after=50)
    assert ids.agg(F.min("new_id"), F.max("new_id"), F.countDistinct("new_id")).first() == (
        51, 1050, 1000
    )


def test_delete_and_clear_references(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, parent int")
    gone = spark.createDataFrame([(10,), (10,)], "pid int")
    assert rows(K.delete_rows(child, gone, "parent", "pid"), "id") == [(2, 20), (3, None)]
    assert rows(K.clear_reference(child, gone, "parent", "pid"), "id") == [
        (1, None), (2, 20), (3, None)
    ]


def star(spark):
    jobs = spark.createDataFrame(
        [(i, f"c{i % 3}", "s") for i in range(1, 7)],
        "job_id bigint, company_name string, source_name string",
    )
    analysis = spark.createDataFrame(
        [(1, "data_engineer", False), (2, "data_engineer", False), (3, "data_engineer", False),
         (4, "data_engineer", True), (5, "other", False)],
        "job_id bigint, detected_role string, is_excluded_from_analysis boolean",
    )
    links = spark.createDataFrame(
        [(1, 1), (1, 2), (2, 1), (4, 1), (5, 2), (2, 3)], "job_id bigint, skill_id bigint"
    )
    skills = spark.createDataFrame(
        [(1, "SQL", "Database"), (2, "dbt", "Data Engineering"), (3, "AWS", "Cloud"),
         (4, "Git", None)],
        "skill_id bigint, skill_name string, skill_category string",
    )
    return jobs, analysis, links, skills


def test_top_skills(spark):
    mart = marts.top_skills_by_role(*star(spark))
    got = [(r.skill_name, r.jobs_with_skill, r.total_jobs_for_role, str(r.demand_percentage),
            r.skill_rank) for r in mart.orderBy("skill_rank").collect()]
    assert got == [("SQL", 2, 3, "66.67", 1), ("AWS", 1, 3, "33.33", 2), ("dbt", 1, 3, "33.33", 3)]


def test_rank_over_slices_equals_window_rank(spark):
    jobs = spark.range(1, 200).select(
        F.col("id").alias("job_id"), F.lit("c").alias("company_name"),
        F.lit("s").alias("source_name"),
    )
    analysis = jobs.select(
        "job_id", F.when(F.col("job_id") % 3 == 0, "data_engineer").otherwise("data_analyst")
        .alias("detected_role"), F.lit(False).alias("is_excluded_from_analysis"),
    )
    links = jobs.select("job_id", F.explode(F.sequence(F.lit(1), F.col("job_id") % 40 + 1)).alias(
        "skill_id"))
    skills = spark.range(1, 42).select(
        F.col("id").alias("skill_id"), F.concat(F.lit("n"), F.col("id") % 4).alias("skill_name"),
        F.lit("Cloud").alias("skill_category"),
    )
    sliced = marts.top_skills_by_role(jobs, analysis, links, skills)
    order = Window.partitionBy("detected_role").orderBy(
        F.col("jobs_with_skill").desc(), "skill_name"
    )
    window = marts.skill_demand(jobs, analysis, links, skills).withColumn(
        "skill_rank", F.rank().over(order)
    ).select(*sliced.columns)
    assert sorted(map(tuple, window.collect())) == sorted(map(tuple, sliced.collect()))


def test_overview_and_categories(spark):
    jobs, analysis, links, skills = star(spark)
    assert tuple(marts.market_overview(jobs, analysis, links, skills).first()) == (
        6, 3, 1, 2, 4, 1, 4, 6
    )
    got = rows(marts.skills_by_category(skills, links), F.col("skill_category").asc_nulls_first())
    # a skill without links counts as one link
    assert got == [(None, 1, 0, 1), ("Cloud", 1, 1, 1), ("Data Engineering", 1, 2, 2),
                   ("Database", 1, 3, 3)]


def test_explorer_sets_are_ordered_and_null_when_empty(spark):
    jobs, analysis, links, skills = star(spark)
    blank = ["job_title", "location_text", "country", "remote_type", "employment_type",
             "seniority_level", "source_url"]
    wide = jobs.select("*", *[F.lit(None).cast("string").alias(c) for c in blank])
    judged = analysis.withColumns({"confidence_score": F.lit(1), "exclusion_reason": F.lit("")})
    got = {r.job_id: r.skill_names
           for r in marts.job_explorer(wide, judged, links, skills).collect()}
    assert got == {1: "SQL, dbt", 2: "AWS, SQL", 3: None, 4: "SQL", 5: "dbt", 6: None}


def test_match_score_worked_example(spark):
    demand = [("SQL", 88), ("Python", 80), ("PostgreSQL", 58), ("Docker", 50), ("Airflow", 46),
              ("Spark", 38)]
    frame = spark.createDataFrame(
        [("data_engineer", i, n, "c", d, 100, float(d)) for i, (n, d) in enumerate(demand)],
        "detected_role string, skill_id int, skill_name string, skill_category string, "
        "jobs_with_skill int, total_jobs_for_role int, demand_percentage double",
    )
    required = gap.required_skills(frame)
    targets = spark.createDataFrame([(1, "data_engineer")], "student_id int, detected_role string")
    owned = spark.createDataFrame(
        [(1, " python"), (1, "SQL"), (1, "sql"), (1, "Cooking")], "student_id int, skill string"
    )
    assert gap.match_score(targets, owned, required).first().match_score == 46.67
    summary = gap.gap_summary(targets, owned, required).first()
    assert (summary.required_count, summary.matched_count, summary.coverage) == (6, 2, 33.33)
    missing = gap.missing_skills(targets, owned, required).orderBy("learning_rank").collect()
    assert [r.skill_name for r in missing] == ["PostgreSQL", "Docker", "Airflow", "Spark"]


def test_gap_over_more_skills_than_shown(spark):
    """A student who owns skills 16 to 30 of thirty: all of them count."""
    frame = spark.createDataFrame(
        [("data_engineer", i, f"skill {i:02}", "c", 100 - i, 100, 100.0 - i)
         for i in range(1, 31)],
        "detected_role string, skill_id int, skill_name string, skill_category string, "
        "jobs_with_skill int, total_jobs_for_role int, demand_percentage double",
    )
    targets = spark.createDataFrame(
        [(1, "data_engineer"), (2, "data_engineer")], "student_id int, detected_role string"
    )
    owned = spark.createDataFrame(
        [(1, f"Skill {i:02}") for i in range(16, 31)] + [(2, f"skill {i:02}") for i in range(1, 16)],
        "student_id int, skill string",
    )
    scores = gap.match_score(targets, owned, gap.role_skills(frame)).collect()
    assert {r.student_id: r.match_score for r in scores} == {1: 45.56, 2: 54.44}
    missing = gap.first_missing_skills(targets, owned, gap.ranked_role_skills(frame), 3)
    got = {(r.student_id, r.learning_rank): r.skill_name for r in missing.collect()}
    assert got == {(s, n): f"skill {first + n:02}" for s, first in [(1, 0), (2, 15)]
                   for n in (1, 2, 3)}


def test_skill_ties_do_not_depend_on_order(spark):
    from hirelens.operators import skills as S

    rows = [(1, 0, "Data Flow", "c", "data flow", None), (1, 0, "data flow", "c", "Data Flow", None)]
    columns = ("job_id int, position int, skill_name string, skill_category string, "
               "raw_mention string, confidence_score double")
    stored = spark.createDataFrame(
        [], "skill_id bigint, skill_name string, skill_category string, "
        "created_at timestamp, updated_at timestamp")
    for order in (rows, rows[::-1]):
        found = S.upsert_skills(stored, spark.createDataFrame(order, columns).coalesce(1))
        assert [r.skill_name for r in found.collect()] == ["Data Flow"]


def test_checks_report_each_kind(spark):
    skills = spark.createDataFrame(
        [(1, "Pandas", "Cloud"), (2, "pandas", "Nope"), (2, None, None)],
        "skill_id bigint, skill_name string, skill_category string",
    )
    report = {(r.check_name, r.column_name): r.failures
              for r in Q.run_checks({"stg_skills": skills}).collect()}
    assert report == {
        ("not_null", "skill_id"): 0, ("not_null", "skill_name"): 1,
        ("not_null", "skill_category"): 1, ("unique", "skill_id"): 1, ("unique", "skill_name"): 0,
        ("accepted_values", "skill_category"): 1, ("case_variants", "skill_name"): 1,
    }
    assert rows(Q.case_variants(skills, "skill_name"), "row_count") == [
        ("pandas", 2, "Pandas, pandas")
    ]
    names = spark.createDataFrame([(n,) for n in ("b", "a", "A", "a", "c", "B")], "name string")
    assert list(map(tuple, Q.case_variants(names, "name", repeats=True).collect())) == [
        ("a", 3, "A, a, a"), ("b", 2, "B, b")
    ]


def test_latest_run_row_wins(spark):
    from hirelens.operators import bronze as B

    opened = B.open_run(spark, 7, "n", "s", 3)
    ledger = opened.unionByName(B.close_run(opened, "success", 2, 0))
    got = B.latest_runs(ledger).first()
    assert (got.status, got.inserted_raw_count) == ("success", 2)
    assert isinstance(got.finished_at, datetime.datetime)
    assert ledger.schema.names == schemas.PIPELINE_RUNS.names


def test_collation_changes_order_only(spark):
    jobs, analysis, links, skills = star(spark)
    names = {1: "AWS", 2: "airflow", 3: "Docker"}
    renamed = skills.withColumn(
        "skill_name", F.create_map(*[F.lit(x) for p in names.items() for x in p])[F.col("skill_id")]
    ).filter("skill_id < 4")
    everything = jobs.select("job_id", F.explode(F.array(*map(F.lit, names))).alias("skill_id"))
    binary = marts.skills_per_job(everything, renamed).first().skill_names
    unicode = marts.skills_per_job(everything, renamed, "UNICODE").first().skill_names
    assert (binary, unicode) == ("AWS, Docker, airflow", "airflow, AWS, Docker")
    ranks = marts.top_skills_by_role(jobs, analysis, everything, renamed, collation="UNICODE")
    assert [r.skill_name for r in ranks.orderBy("skill_rank").collect()] == [
        "airflow", "AWS", "Docker"
    ]


def test_explorer_filters(spark):
    frame = spark.createDataFrame(
        [(1, "Data (Jr)", "Acme", None, "data_engineer", False, None, "u1"),
         (2, "Lead", None, "Rabat", "other", True, "SQL", None),
         (3, "Baker", "Blue", "Fes", None, None, "R", "u3")],
        "job_id int, job_title string, company_name string, location_text string, "
        "detected_role string, is_excluded_from_analysis boolean, skill_names string, "
        "source_url string",
    )

    def found(**options):
        return sorted(r.job_id for r in explore.explore_jobs(frame, **options).collect())

    assert found() == [1]
    assert found(only_analyzable=False) == [1, 2, 3]
    assert found(only_analyzable=False, roles=[]) == [1, 2, 3]
    assert found(only_analyzable=False, roles=["other"]) == [2]
    assert found(only_analyzable=False, search=" (JR) ") == [1]
    assert found(only_analyzable=False, search="rab|blue", as_pattern=True) == [2, 3]
    assert found(only_analyzable=False, search="rab|blue") == []
    rows = {r.job_id: r for r in explore.explore_jobs(frame, only_analyzable=False).collect()}
    assert rows[1]["Skills"] == "No skills extracted" and rows[1]["Location"] == ""
    assert [rows[i]["Analysis status"] for i in (1, 2, 3)] == ["Included", "Excluded", ""]


def test_skill_options_prefer_capitals(spark):
    names = ["pandas", "Pandas", "numpy", " NumPy ", "", None, "r", "C++"]
    frame = spark.createDataFrame([(n,) for n in names], "skill_name string")
    got = [r.skill_name for r in explore.skill_options(frame).collect()]
    assert got == ["C++", "NumPy", "Pandas", "r"]


def test_one_key_with_a_third_of_the_rows(spark):
    """Winners, distinct counts and missing parents against plain Python."""
    data = [("hot" if i % 3 == 0 else f"k{i % 50}", i * 7919 % 3001) for i in range(3000)]
    frame = spark.createDataFrame(data, "k string, n int").repartition(8)
    first, last = {}, {}
    for key, n in data:
        first[key] = min(n, first.get(key, n))
        last[key] = max(n, last.get(key, n))
    assert dict(map(tuple, K.first_per_key(frame, ["k"], ["n"]).collect())) == first
    assert dict(map(tuple, K.last_per_key(frame, ["k"], ["n"]).collect())) == last
    parents = spark.createDataFrame([("k1",)], "id string")
    missing = Q.relationships(frame, "k", parents, "id").filter("k = 'hot'").first()
    assert missing.row_count == 1000
