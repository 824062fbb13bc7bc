"""Content-addressed WARC archive.

Payload bytes are stored once per SHA-256 in one table; the exact header bytes of every record stand in another. Reading
joins them: a response takes its payload, a revisit what was verified of the response it refers to.
"""

from __future__ import annotations

import base64
import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm import exchange as X
from oreline.llm.shared import ship, store

_RECORD = "<urn:page:{}:{}>"


@dataclass(frozen=True)
class Archive:
    """headers (digest, header) and payloads (digest, payload), stored tables."""

    headers: DataFrame
    payloads: DataFrame


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _digests(payload: bytes) -> tuple[int, str, str]:
    return len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), hashlib.sha256(payload).hexdigest()


def _header(page, copy, url, size, sha1, first, date) -> bytes:
    """Header block with its closing empty line. A null id or url leaves out what would hold it."""
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines += [f"WARC-Date: {date}", "WARC-Record-ID: " + _RECORD.format("" if page is None else page, copy)]
    lines += [f"WARC-Payload-Digest: sha1:{sha1}"]
    if first is not None:
        lines.append("WARC-Refers-To: " + _RECORD.format("" if first == X.NO_ID else first, 1))
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += ["Content-Type: text/html", f"Content-Length: {size if first is None else 0}", "", ""]
    return "\r\n".join(lines).encode()


def write(pages: DataFrame, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> Archive:
    """Archive one record per row of (page_id, url, html); the payload is html in UTF-8, null is empty.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the smallest page_id is the response
    (then by url; null ids and urls last; of rows equal in all this the first copy) and the
    others are revisits. Other columns are not read. An empty table gives an empty archive.
    """
    ship(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    facts_schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("size", pa.int64()), ("sha1", pa.string()), ("digest", pa.string())
    ])

    def facts(batches):
        for batch in batches:
            page, url, payload = (batch.column(c).to_pylist() for c in ("page_id", "url", "payload"))
            yield _batch([(p, u, *_digests(d)) for p, u, d in zip(page, url, payload)], facts_schema)

    # Equal rows become one with a number of copies before anything is shuffled.
    known = (
        rows.mapInArrow(facts, "page_id long, url string, size long, sha1 string, digest string")
        .withColumn("place", F.struct(X.ranked("page_id").alias("rank"), F.col("url").isNull().alias("no_url"), F.coalesce("url", F.lit("")).alias("u")))
        .groupBy("page_id", "url", "place", "size", "sha1", "digest").agg(F.count("*").alias("copies"))
    )
    known = store(known, "warc-facts")
    firsts = known.groupBy("digest").agg(F.min("place").alias("first"))
    records = (
        known.join(firsts, "digest")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .withColumn("stored", (F.col("size") < min_bytes) | ((F.col("place") == F.col("first")) & (F.col("copy") == 1)))
        .select("digest", "page_id", "url", "size", "sha1", "copy", F.when(~F.col("stored"), F.col("first.rank")).alias("first"))
    )
    header_schema = pa.schema([("digest", pa.string()), ("header", pa.binary())])

    def headers(batches):
        for batch in batches:
            names = ("digest", "page_id", "copy", "url", "size", "sha1", "first")
            yield _batch(
                [(d, _header(*rest, date)) for d, *rest in zip(*(batch.column(c).to_pylist() for c in names))],
                header_schema,
            )

    payload_schema = pa.schema([("digest", pa.string()), ("payload", pa.binary())])

    def payloads(batches):
        for batch in batches:
            # Copies within a batch go no further than here.
            own = {hashlib.sha256(d).hexdigest(): d for d in batch.column("payload").to_pylist()}
            yield _batch(list(own.items()), payload_schema)

    once = (
        rows.select("payload").mapInArrow(payloads, "digest string, payload binary")
        .groupBy("digest").agg(F.any_value("payload").alias("payload"))
    )
    return Archive(
        store(records.mapInArrow(headers, "digest string, header binary"), "warc-headers"), store(once, "warc-payloads")
    )


def records(archive: Archive) -> DataFrame:
    """The original records: digest and the bytes of header, payload and the two closing line ends.

    Revisits are given back as they were archived, without a payload.
    """
    body = F.coalesce(F.when(_field("WARC-Type") == "response", F.col("payload")), F.lit(b""))
    whole = archive.headers.join(archive.payloads, "digest")
    return whole.select("digest", F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record"))


def _field(name: str):
    """A field of the header, null where it is absent."""
    value = F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(value != "", value)


def _page(name: str):
    return F.regexp_extract(_field(name), r"^<urn:page:(-?[0-9]+):", 1)


def read(archive: Archive) -> DataFrame:
    """One row per record, from the parsed headers and the verified payloads: page_id, url, payload_bytes,
    payload_digest, record_type, refers_to and verified (the stored bytes have the SHA-256 they are filed under, and
    the SHA-1 that the header names)."""
    schema = pa.schema([("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("intact", pa.bool_())])

    def verify(batches):
        for batch in batches:
            out = []
            for digest, payload in zip(batch.column("digest").to_pylist(), batch.column("payload").to_pylist()):
                size, sha1, sha256 = _digests(payload)
                out.append((digest, size, sha1, sha256 == digest))
            yield _batch(out, schema)

    ship(archive.headers.sparkSession)
    stored = archive.payloads.mapInArrow(verify, "digest string, payload_bytes long, payload_digest string, intact boolean")
    parsed = archive.headers.select(
        "digest",
        _page("WARC-Record-ID").try_cast("long").alias("page_id"),
        _field("WARC-Target-URI").alias("url"), _field("WARC-Type").alias("record_type"),
        _page("WARC-Refers-To").try_cast("long").alias("refers_to"),
        F.regexp_extract(_field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("named"),
    )
    return parsed.join(stored, "digest").select(
        "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to",
        (F.col("intact") & (F.col("named") == F.col("payload_digest"))).alias("verified"),
    )
