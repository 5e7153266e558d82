import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions import text as T

SAMPLES = st.lists(
    st.one_of(
        st.none(),
        st.text(alphabet="aB é  \t\n\x0b\x1c\x85,.-/_9ßñ語 data", max_size=30),
    ),
    min_size=1,
    max_size=25,
)
FEW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_clean_text_example(column):
    got = column(["  Data   Analyst\n ", None, "  ", "a  b"], T.clean_text)
    assert got == ["Data Analyst", None, None, "a b"]


@FEW
@given(values=SAMPLES)
def test_clean_text_like_python(column, values):
    def rule(value):
        return None if value is None else re.sub(r"\s+", " ", value.strip()) or None

    assert column(values, T.clean_text) == [rule(v) for v in values]


@FEW
@given(values=SAMPLES, phrase=st.sampled_from(["data", "a", "é", "b", "9"]))
def test_contains_phrase_like_python(column, values, phrase):
    def rule(value):
        text = "" if value is None else re.sub(r"\s+", " ", value.lower().strip())
        return re.search(r"\b" + re.escape(phrase) + r"\b", text) is not None

    got = column(values, lambda c: T.contains_phrase(T.match_text(c), phrase))
    assert got == [rule(v) for v in values]


@FEW
@given(words=st.lists(st.sampled_from(["data", "engineer", "big", "junior", "x", "analyst", "bi",
                                       "-", "intern"]), max_size=8))
def test_first_phrase_is_list_order(column, words):
    phrases = ["data engineer", "junior data engineer", "big data engineer", "engineer", "data",
               "data analyst intern", "bi", "bi analyst"]
    text = " ".join(words)
    expected = next(
        (p for p in phrases if re.search(r"\b" + re.escape(p) + r"\b", text)), None
    )
    assert column([text], lambda c: T.first_phrase(c, phrases)) == [expected]


def test_boundaries_are_unicode(column):
    got = column(["édata", "data_x", "data-x", "data.", "(data)"],
                 lambda c: T.contains_phrase(c, "data"))
    assert got == [False, False, True, True, True]


def test_truncate_counts_characters_after_collapse(column):
    long = "é  " * 5000
    got = column([long, None], lambda c: T.truncate(c, V.MAX_DESCRIPTION_CHARACTERS))
    assert got == [" ".join(["é"] * 5000)[:6000], ""]


def test_phrase_in_page(column, spark):
    frame = spark.createDataFrame(
        [("<p>We Need SQL</p>", "need sql"), ("x", ""), ("x", None), ("", "a")],
        "html string, phrase string",
    )
    rows = frame.select(T.contains_ignoring_case(F.col("html"), F.col("phrase")).alias("x"))
    assert [r.x for r in rows.collect()] == [True, False, False, False]
