"""WARC archives without repeated payloads: writing, reading, revisit resolution."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.functions.once import with_computed
from hirelens.llm.common import bounded_batches

CRLF = "\r\n"
ARCHIVE_BYTES = 1 << 30
HEADER_BYTES = 2048  # allowed for a record's headers; addresses may be longer
# fixed values: RFC 4648 base 32, and the digits of a number in base 32
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = (
    "record_type string, record_id string, uri string, page_id bigint, payload_digest string, "
    "refers_to string, refers_to_page bigint, content_length bigint, payload binary"
)


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1: 20 bits, five hex digits, give four letters."""
    hexed = F.sha1(data)
    parts = [
        F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def resolve_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Say of every page whether it is a response or revisits another one.

    Of pages with equal payloads (UTF-8 of `html`, null: empty) of at least `least_bytes`
    the one with the largest `page_id` is the response and the others refer to it; smaller
    payloads are all responses. A null page_id is smaller than any other; rows that share
    the largest page_id and the payload are all responses. Returns `page_id`, `url`,
    `html` (never null), `payload_bytes`, `payload_digest`, `record_type`, `refers_to`.
    Other columns are not read; an empty table gives an empty frame.

    Only digests and ids are grouped (merged before the shuffle); the pages are shuffled
    once, by digest, in a join whose hot digests adaptive execution splits.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    headed = with_computed(
        pages.select("page_id", "url", html.alias("html")),
        {"payload_bytes": F.octet_length("html").cast("bigint"),
         "payload_digest": base32_sha1(F.col("html"))},
    )
    originals = (
        headed.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.max("page_id").alias("_original"))
    )
    joined = headed.join(
        originals,
        (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") >= least_bytes),
        "left",
    )
    revisit = F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_original"))
    return joined.select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("_original")).alias("refers_to"),
    )


def _record_id(page_id: Column, digest: Column) -> Column:
    """A name for the record made from its page and payload, the same on every run."""
    h = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("none")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line; left out where the value is null. Line breaks cannot enter a header."""
    clean = F.regexp_replace(value, "[\\r\\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit(""))


def record_text(date: str) -> Column:
    """One WARC record, without the line feed that the text sink adds at its end."""
    revisit = F.col("record_type") == "revisit"
    payload = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    target = F.coalesce(F.col("url"), F.lit("urn:none"))
    headers = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", target),
        _header("WARC-Page-ID", F.col("page_id").cast("string")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _header("WARC-Refers-To", F.when(
            revisit, _record_id(F.col("refers_to"), F.col("payload_digest")))),
        _header("WARC-Refers-To-Page-ID", F.col("refers_to").cast("string")),
        _header("Content-Type", F.lit("text/html")),
        _header("Content-Length", F.octet_length(payload).cast("string")),
        F.lit(CRLF),
    )
    return F.concat(headers, payload, F.lit(CRLF + "\r"))


def write_archives(
    resolved: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z",
    largest: int | None = None,
) -> None:
    """Write records as gzip archives through Spark's own file commit, so that any store works
    and a lost executor leaves no half file behind.

    A task starts another archive when one has as many records as ARCHIVE_BYTES of the largest
    payload would be, so no archive passes that size before it is compressed, whatever the size
    of a partition. `largest` is that payload's bytes; without it, it is looked up first.
    """
    if largest is None:
        largest = resolved.agg(F.max("payload_bytes")).first()[0] or 0
    records = resolved.select(record_text(date).alias("value"))
    records.write.option("lineSep", "\n").option("compression", "gzip").option(
        "maxRecordsPerFile", max(1, ARCHIVE_BYTES // (largest + HEADER_BYTES))
    ).text(path)


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and content of each record, cut by Content-Length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}: {lines[0][:40]!r}")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        start = end + 4
        stop = start + int(headers["content-length"])
        yield headers, data[start:stop]
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where its length says")
        at = stop + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives under a path. A file is parsed whole in one task; the writer
    bounds its size. An Arrow batch holds few bytes beside a large archive."""
    bounded_batches(spark)
    names = [part.split()[0] for part in READ_SCHEMA.split(", ")]

    def parse(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                data = content.as_py()
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                for h, body in parse_archive(data):
                    page, to = h.get("warc-page-id"), h.get("warc-refers-to-page-id")
                    rows.append((
                        h["warc-type"], h["warc-record-id"], h["warc-target-uri"],
                        None if page is None else int(page),
                        h["warc-payload-digest"].removeprefix("sha1:"), h.get("warc-refers-to"),
                        None if to is None else int(to), len(body), body,
                    ))
                    size += len(body)
                    if size > 4 << 20 or len(rows) >= 1000:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(),
             pa.int64(), pa.int64(), pa.binary()]

    def _batch(rows):
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, READ_SCHEMA)


def resolved_records(records: DataFrame) -> DataFrame:
    """One row per record as read, a revisit with the length of the response it refers to.

    Responses are checked: the digest of the payload must be the one in the header. Only
    headers are shuffled. Rows repeated in the input are responses of one id: their
    lengths are merged by payload digest first.
    """
    checked = with_computed(records, {"_found": base32_sha1(F.col("payload"))}).select(
        "record_type", "page_id", "refers_to_page", "payload_digest", "content_length",
        F.when(
            (F.col("record_type") == "revisit") | (F.col("_found") == F.col("payload_digest")),
            F.lit(True),
        ).otherwise(F.raise_error(F.lit("payload does not match its digest"))).alias("_right"),
    )
    lengths = (
        checked.filter((F.col("record_type") == "response") & F.col("_right"))
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.max("content_length").alias("_length"))
    )
    return checked.join(lengths, F.col("payload_digest") == F.col("_digest"), "left").select(
        "page_id",
        F.when(F.col("record_type") == "revisit", F.col("_length"))
        .otherwise(F.col("content_length")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.col("refers_to_page").alias("refers_to"),
    )
