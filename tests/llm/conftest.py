import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from llm_text import prose  # noqa: E402

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
@pytest.fixture
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, ties, columns with clashing names."""
    long = prose(1, 9000)
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, "   \n ", "en", "a", 4),
        (4, "Word", "en", None, 4), (4, "Word", "en", None, 4), (5, "wORD", "de", "a", 4),
        (None, "Word", "en", "b", 4), (None, None, None, "b", None), (6, long, "en", "b", 9),
        (7, long + " tail", "en", "b", 9), (8, prose(2, 60), "fr", "c", 9),
        (9, prose(2, 60), "fr", "c", 9), (10, "1234 5678", "en", "c", 9),
        (11, "é́ \U0001f600 <|endoftext|>", "fr", "c", 9),
    ]
    docs = spark.createDataFrame(rows, COLUMNS)
    from pyspark.sql import functions as F

    clash = ["row", "shard", "slot", "bucket", "order", "size", "hash", "digest", "name",
             "copy", "score", "key", "kept", "doc", "start", "length"]
    return docs.withColumns({c: F.lit(1) for c in clash})


@pytest.fixture
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture
def dotted(awkward):
    """The awkward rows with a dotted and a map column."""
    from pyspark.sql import functions as F

    return awkward.withColumn("meta.url", F.lit("x")).withColumn(
        "tags", F.create_map(F.lit("a"), F.lit(1)))
