"""The corpus pipeline: language ID, exact copies, near copies, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written and read again
as the next stage's documents. ORACLE_SQL is None: language ID, the near-duplicate join and
the mix's random draws cannot be said in SQL. tests/llm compares run() with a brute-force
version on small tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import exact_dedup, jaccard, language, mixing, packing
from hirelens.llm.common import keep, numbered, quoted, read_table, whole_row

ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the language model rejects: null texts, texts without a letter,
    and texts less probable a letter, in their best language, than the least probable run of
    letters that was learned is in its own. A text of learned words is never below that. Where
    no language could be learned, only letterless texts go. A null `lang` becomes the
    predicted one; all else stays as it is, repeated rows and very long texts too, and an
    empty table stays empty."""
    found = language.identify(docs, language.vocabulary_path(spark)).filter("accepted")
    known = F.nullif(F.col("lang_pred"), F.lit("und"))
    return found.select(*[
        (F.coalesce(f"doc.{quoted(c)}", known) if c == "lang" else F.col(f"doc.{quoted(c)}"))
        .alias(c) for c in docs.columns
    ])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in either case) the row with the largest doc_id stays."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the smallest doc_id."""
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw the mix: a document has a row for each time it is drawn. The one document of a
    source that is drawn in part has its first words only, and `n_chars` to match."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = numbered(
        docs.select(
            whole_row(docs), "source",
            mixing.word_count(F.col("text")).alias("size"),
            F.xxhash64("doc_id", text).alias("content"),
        ),
        "pipeline-mix",
    )
    draws, _ = mixing.mix(rows.drop("doc"))
    drawn = rows.select("row", "doc", "size").join(draws.select("row", "words"), "row")
    cut = F.col("words") < F.col("size")
    part = mixing.first_words(F.col("doc.text"), F.col("words").cast("int"))
    new = drawn.withColumn("part", F.when(cut, part).otherwise(F.col("doc.text")))
    changed = {
        "text": F.col("part"),
        "n_chars": F.when(cut, F.char_length("part").cast("bigint")).otherwise(
            F.col("doc.n_chars")),
    }
    return new.select(
        *[changed.get(c, F.col(f"doc.{quoted(c)}")).alias(c) for c in docs.columns]
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    packed = packing.pack_documents(docs, packing.token_path(spark), keep_ids=False)
    return packed.drop("row")


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
