"""The registered queries of the training-text operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelens.llm import (
    exact_dedup, fingerprints, jaccard, language, lexical, line_chunks, mixing, packing,
    periodic_runs, pieces, sharding, toxicity, warc,
)
from hirelens.llm.common import numbered, read_table
from hirelens.session import scratch_path

QUERIES: dict = {}
SQL: dict = {}


def query(statement: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if statement:
            SQL[function.__name__] = statement
        return function

    return register


@query()
def op1_packing(spark, d):
    packed = packing.pack_documents(
        read_table(spark, d, "documents"), packing.token_path(spark), keep_ids=False
    )
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query()
def op2_sharding(spark, d):
    path = scratch_path(spark, "shards")
    shuffled = sharding.shuffle_into_shards(read_table(spark, d, "documents"))
    sharding.write_shards(shuffled, path)
    placed = sharding.read_shards(spark, path, shuffled.schema)
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    return placed.select(
        "doc.doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op3_line_dedup(spark, d):
    cleaned = line_chunks.remove_repeated_runs(read_table(spark, d, "documents"))
    return cleaned.select("doc_id", "text", "lines", "removed_lines", "removed")


@query()
def op4_fingerprints(spark, d):
    return fingerprints.fingerprint_neighbours(read_table(spark, d, "documents"))


@query()
def op5_jaccard_join(spark, d):
    return jaccard.near_duplicates(read_table(spark, d, "documents")).select(
        "doc_id", "class_id", "text_id", "links", "kept"
    )


@query()
def op6_toxicity(spark, d):
    found = toxicity.detect(read_table(spark, d, "documents"), read_table(spark, d, "labels"))
    return found.select("doc.doc_id", "held_out", "score", "predicted", "offending")


@query(
    """
    WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
    SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept,
           sha256(d.t) AS text_sha256
    FROM d JOIN g USING (t)
    """
)
def op7_exact_dedup(spark, d):
    return exact_dedup.exact_dedup(read_table(spark, d, "documents"))


@query()
def op8_language(spark, d):
    found = language.identify(
        read_table(spark, d, "documents"), language.vocabulary_path(spark)
    )
    return found.select("doc.doc_id", "held_out", "lang_pred", "score")


@query()
def op9_mixing(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "text", "source")
    rows = numbered(
        docs.select(
            "doc_id", "source", mixing.word_count(F.col("text")).alias("size"),
            F.xxhash64("doc_id", "text").alias("content"),
        ),
        "mix-rows",
    )
    draws, targets = mixing.mix(rows)
    taken = draws.groupBy("row").agg(
        F.sum("words").alias("taken"), F.sort_array(F.collect_list("shard")).alias("shards")
    )
    return (
        rows.withColumn("key", mixing.source_key(F.col("source")))
        .join(targets.select("key", "source_size", "target"), "key")
        .join(taken, "row", "left")
        .select(
            "doc_id", "size", "source_size", "target",
            F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), "shards",
        )
    )


@query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS s FROM p),
    b AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32),
              lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  ((('0x' || substr(s, CAST(5 * (i // 4) + 1 AS INTEGER), 5))::BIGINT
                    // CAST(power(32, 3 - i % 4) AS BIGINT)) % 32 + 1)::INTEGER, 1)), '')
              AS payload_digest FROM h),
    g AS (SELECT payload_digest, max(page_id) AS original FROM b GROUP BY payload_digest)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> original THEN original END AS refers_to
    FROM b JOIN g USING (payload_digest)
    """
)
def op10_warc(spark, d):
    path = scratch_path(spark, "warc")
    pages = read_table(spark, d, "pages")
    largest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0
    warc.write_archives(warc.resolve_revisits(pages), path, largest=largest)
    return warc.resolved_records(warc.read_archives(spark, path))


@query(
    """
    WITH d AS (SELECT doc_id, regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents),
    n AS (SELECT row_number() OVER () AS r, doc_id, t, len(t) AS n FROM d WHERE len(t) > 0),
    total AS (SELECT count(*) AS dn, CAST(sum(n) AS BIGINT) AS dl FROM n),
    p AS (SELECT r, doc_id, n, term, count(*) AS tf
          FROM (SELECT r, doc_id, n, unnest(t) AS term FROM n) GROUP BY ALL),
    f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
    i AS (SELECT item_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
    s AS (SELECT i.item_id, p.r, p.doc_id, CAST(sum(
              CAST(floor(1000 * ln((2 * dn + 2) / (2 * df + 1))) AS BIGINT)
              * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * dn) // dl)))) AS BIGINT)
              AS score
          FROM i JOIN p USING (term) JOIN f USING (term) CROSS JOIN total
          GROUP BY i.item_id, p.r, p.doc_id),
    k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
          FROM s WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
    """
)
def op11_lexical_search(spark, d):
    path = scratch_path(spark, "lexical-index")
    lexical.write_index(read_table(spark, d, "documents"), path)
    found = lexical.search(spark, path, read_table(spark, d, "benchmark"))
    return found.select(
        F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score"
    )


@query()
def op12_sentencepiece(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    encoded = pieces.encode_texts(docs, pieces.model_path(spark), keep_ids=False)
    return encoded.select("doc.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query()
def op13_periodic_runs(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    found = periodic_runs.find_runs(
        docs, change=periodic_runs.repeated_tail, keep_text=False
    )
    return periodic_runs.run_report(found)
