import pytest
from pyspark.sql import functions as F

from hirelens.functions import location as L
from hirelens.functions import skills as SK
from hirelens.functions import urls as U
from hirelens.functions.markup import strip_html
from hirelens.functions.roles import role_label
from hirelens.operators.analysis import analyze, with_seniority

COUNTRIES = {
    "United States": "United States",
    "New York, NY": "United States",
    "San Francisco, CA": "United States",
    "Washington DC-Baltimore Area": "United States",
    "Los Angeles Metropolitan Area": "United States",
    "Casablanca, Morocco": "Morocco",
    "Paris, Île-de-France, France": "France",
    "Remote": None,
    "Toronto, CA": "United States",
    "Berlin, DE": "United States",
    "pune, in": "United States",
    " lyon , FRANCE ": "France",
    ", ,": None,
    "": None,
    None: None,
    "Lisbon": None,
    "Greater Boston": "United States",
}


def test_country(column):
    assert column(list(COUNTRIES), L.parse_country) == list(COUNTRIES.values())


@pytest.mark.parametrize(
    "location, description, expected",
    [
        ("Remote", None, "remote"),
        (None, "this is not remote", "remote"),
        ("Remote", "hybrid schedule", "hybrid"),
        ("Paris", "On site only", "onsite"),
        ("Paris", "office", "unknown"),
        (None, None, "unknown"),
    ],
)
def test_remote_type(spark, location, description, expected):
    frame = spark.createDataFrame([(location, description)], "a string, b string")
    text = frame.select(L.remote_text(F.col("a"), F.col("b")).alias("t"))
    assert text.select(L.remote_type(F.col("t"))).first()[0] == expected


ROLE_CASES = [
    ("Junior Data Analyst", "Use SQL, Excel, and dashboards to analyze business metrics.",
     "data_analyst", "0.90"),
    ("Business Intelligence Analyst", "Build dashboards using Tableau and Power BI.",
     "bi_analyst", "0.95"),
    ("Data Engineer", "Build ETL pipelines using Spark and Airflow.", "data_engineer", "0.95"),
    ("Machine Learning Engineer Intern", "Deploy machine learning models and build ML pipelines.",
     "machine_learning_engineer", "0.95"),
    ("Analytics Engineer", "Use dbt and data modeling in the warehouse.",
     "analytics_engineer", "0.95"),
    ("Data Scientist, Product Analytics",
     "Work on experimentation, metrics, and predictive modeling.", "data_scientist", "0.95"),
    ("Strategy & Operations Associate", "Support business operations and strategic initiatives.",
     "other", "0.60"),
    ("Software Engineer", "Build backend services and APIs.", "other", "0.80"),
    # a context rule of a higher role beats the title rule of a lower one
    ("Data Analyst", "Knows mlops.", "machine_learning_engineer", "0.75"),
    # dashboards in the context never make a BI analyst
    ("Tableau Person", "dashboards reporting power bi", "other", "0.60"),
    ("Insights Partner", "hello", "unknown", "0.40"),
    (None, None, "unknown", "0.00"),
    ("Financial Analyst", "excel", "data_analyst", "0.70"),
    ("Plumber", "dbt and analytics", "analytics_engineer", "0.70"),
    ("Plumber", "dbt", "other", "0.60"),
]


def test_roles(spark):
    rows = [(i, t, d, None, None) for i, (t, d, _, _) in enumerate(ROLE_CASES)]
    frame = spark.createDataFrame(
        rows, "job_id bigint, job_title string, description_text string, "
              "job_function string, industries string"
    )
    got = {r.job_id: (r.detected_role, str(r.confidence_score)) for r in analyze(frame).collect()}
    assert got == {i: (role, score) for i, (_, _, role, score) in enumerate(ROLE_CASES)}


def test_role_reasons_and_exclusion(spark):
    frame = spark.createDataFrame(
        [(1, "Lead Senior Financial Analyst", "uses  SQL", None, None),
         (2, "Leadership Data Analyst", "", None, None),
         (3, None, "spark for an engineer", None, None)],
        "job_id bigint, job_title string, description_text string, job_function string, "
        "industries string",
    )
    rows = {r.job_id: r for r in analyze(frame).collect()}
    assert rows[1].role_reason == (
        "Title contains analyst signal: analyst; context contains data-analysis signal: sql"
    )
    assert rows[1].exclusion_reason == "senior/exclusion keyword in title: senior"
    assert rows[2].is_excluded_from_analysis is False and rows[2].exclusion_reason is None
    assert rows[3].role_reason == "Context contains data engineering signal: spark"


def test_seniority(spark):
    frame = spark.createDataFrame(
        [("Internship in data", ""), ("Analyst", "0-2 years"), ("Analyst", "3-5 years confirmed"),
         ("Architect", "any"), ("Data Analyst", "Strong SQL"), ("Dev", "needs 5+ years of work")],
        "job_title string, description_text string",
    )
    assert [r.seniority for r in with_seniority(frame).collect()] == [
        "Internship", "Junior", "Intermediate", "Senior", "Unknown", "Senior"
    ]


def test_role_label(column):
    assert column(["data_analyst", None], role_label) == ["Data Analyst", "Unknown"]


def test_skill_names(column):
    names = [" apache   SPARK", "DBT", "a.i.", "Pandas ", None, "PowerBI"]
    assert column(names, SK.normalize_name) == [
        "Spark", "dbt", "Artificial Intelligence", "Pandas", "", "Power BI"
    ]


def test_skill_categories(spark):
    cases = [
        ("SQL", "Cloud", "Database"),
        ("sql", "Query Language", "Database"),
        ("dbt", "etl", "Data Engineering"),
        ("x", "devops", "Other Technical"),
        ("x", "DevOps", "DevOps"),
        ("x", None, "Other Technical"),
        ("x", " bi   tool ", "Data Visualization"),
    ]
    frame = spark.createDataFrame(cases, "name string, category string, expected string")
    rows = frame.select(
        SK.normalize_category(F.col("name"), F.col("category")).alias("got"), "expected"
    ).collect()
    assert [r.got for r in rows] == [r.expected for r in rows]


def test_rejected_names(column):
    names = ["Communication", "PowerPoint", "R", "C", "x" * 80, "x" * 81, "Data"]
    assert column(names, SK.is_rejected) == [True, False, False, True, False, True, True]
    assert column(["PowerPoint"], lambda c: SK.is_rejected(c, strict=True)) == [True]


def test_confidence(column):
    values = ["0.5", "1", "-0.1", "1.01", "high", None, "NaN", " 0.25 "]
    assert column(values, SK.confidence) == [0.5, 1.0, None, None, None, None, None, 0.25]


def test_safe_alias(spark):
    cases = [
        ("postgres", "PostgreSQL", True),
        ("apache airflow", "Airflow", True),
        ("cloud data platforms (snowflake or aws preferred)", "Snowflake", False),
        ("SQL and Python", "SQL", False),
        ("a b c d e f", "x", True),
        ("a b c d e f g", "x", False),
        ("a, b", "A, B", True),
        ("y" * 61, "x", False),
        ("", "x", False),
        (None, "x", False),
    ]
    frame = spark.createDataFrame(cases, "mention string, skill string, expected boolean")
    rows = frame.select(
        SK.is_safe_alias(F.col("mention"), F.col("skill")).alias("got"), "expected"
    ).collect()
    assert [bool(r.got) for r in rows] == [r.expected for r in rows]


def test_fences(column):
    texts = ['```json\n{"a":1}\n```', '```\n[]```', '  {"a":1} ', "```json```"]
    assert column(texts, SK.strip_fences) == ['{"a":1}', "[]", '{"a":1}', ""]


def test_job_ids(column):
    urls = [
        "https://x/jobs/view/4430018168/",
        "https://x/jobs/view/data-analyst-company-4430018168",
        "https://x/jobs/view/data-analyst-77?trk=1",
        "https://x/jobs/view/none",
        "https://x/other/12",
    ]
    assert column(urls, U.job_id) == ["4430018168", "4430018168", "77", None, None]


def test_direct_url(column):
    urls = ["https://www.linkedin.com/jobs/search/?currentJobId=44&x=1", "https://a/b?x=1",
            "https://a/b?currentJobId=&currentJobId=7"]
    assert column(urls, U.direct_url) == [
        "https://www.linkedin.com/jobs/view/44/", "https://a/b?x=1",
        "https://www.linkedin.com/jobs/view/7/",
    ]


def test_offset_url(spark):
    url = ("https://www.linkedin.com/jobs/search/?keywords=machine%20learning"
           "&location=United%20States&f_E=2&start=75&trk=x&empty=")
    frame = spark.createDataFrame([(url,)], "url string")
    got = frame.select(U.offset_url(F.col("url"), F.lit(25))).first()[0]
    assert got == (
        "https://www.linkedin.com/jobs-guest/jobs/api/seeMoreJobPostings/search"
        "?keywords=machine+learning&location=United+States&f_E=2&empty=&start=25"
    )


def test_search_and_absolute_urls(spark):
    frame = spark.createDataFrame([("c++ & *data~", "/jobs/view/1")], "k string, h string")
    row = frame.select(
        U.search_url(F.col("k"), F.lit("Rabat")).alias("s"), U.absolute_url(F.col("h")).alias("a"),
        U.absolute_url(F.lit("https://z/q")).alias("b"), U.absolute_url(F.lit("//z/q")).alias("c"),
    ).first()
    assert row.s.endswith("?keywords=c%2B%2B+%26+%2Adata~&location=Rabat")
    assert (row.a, row.b, row.c) == (
        "https://www.linkedin.com/jobs/view/1", "https://z/q", "https://z/q"
    )


def test_strip_html(column):
    html = "<p>We are looking for <b>Data Engineer</b> &amp; Python  developer...</p>"
    assert column([html, "<!-- x --><style>p{}</style>a &amp;lt; b"], strip_html) == [
        "We are looking for Data Engineer & Python developer...", "a &lt; b"
    ]


def test_rules_see_every_word_sentence_and_part(spark, tmp_path):
    from checks import vocab

    texts = spark.createDataFrame([(1, "One two three. Teamwork helps\nR"), (2, None)],
                                  "doc_id bigint, text string")
    parts = spark.createDataFrame([(1, "blue bolt", "SQL"), (2, "red nut", None)],
                                  "p_partkey bigint, p_name string, p_type string")
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    parts.write.parquet(f"{tmp_path}/part.parquet")
    rows = vocab.skill_rules_all(spark, str(tmp_path)).collect()
    assert sorted(r["item"] for r in rows) == sorted([
        "one", "two", "three", "teamwork", "helps", "r", "One two three", " Teamwork helps", "R",
        "blue bolt", "red nut", "SQL",
    ])
    assert {r["item"] for r in rows if r["is_rejected"]} == {"teamwork", "r"}
