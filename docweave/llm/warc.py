"""WARC archives with revisit resolution.

Headers (id, address, payload digest, length) are made once and shuffled by
payload digest; of each digest the record with the largest page_id is the
response, all others become revisit records that name it and carry no
payload. A payload crosses the network once per digest and map task at most
(it is aggregated by digest map-side), never once per copy. Records are
UTF-8 strings written by Spark's text writer (CRLF CRLF is the separator a
WARC needs after each record), gzip-compressed, dated by the time of writing, a
bounded number per file: a folder for every fourfold of payload size (all under
64 KB are one), so that a file holds ``BYTES_PER_FILE`` of payloads or one of them.

Reading takes each archive as one binary value (compressed) and streams
through it record by record by Content-Length; a revisit's length and its
page are resolved by joining its WARC-Refers-To with the response's record id.

Defined cases: null html is an empty payload (all empty payloads are equal);
null url is an empty address; of rows that repeat a page_id and payload one is
the response and the others revisit it; a null page_id is smaller than any
other and read back as null; payloads under ``min_bytes`` are all responses;
no pages give no archive and no rows; a payload of any length a string can have is
written and read whole; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import materialize, prepare, table
from docweave.session import scratch_path

RECORDS_PER_FILE = 4000
BYTES_PER_FILE = 256 << 20  # of payloads, or one payload
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

PARSED = ("record_id string, record_type string, page_id long, url string, payload_digest string, "
          "payload_bytes long, refers_to_id string, payload binary")


def base32_sha1(payload: F.Column) -> F.Column:
    """Upper-case base32 of the SHA-1: four groups of 40 bits, 8 digits each."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(*cols) -> F.Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in cols]))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def _record(kind: str, block: F.Column, *extra: tuple[str, F.Column]) -> F.Column:
    """One WARC record as a string, without the separator after it. A field
    whose value is null is left out."""
    fields = [("WARC-Type", F.lit(kind)), ("WARC-Record-ID", F.col("record_id")), ("WARC-Date", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), DATE_FORMAT)),
              ("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]", "")),
              ("X-Page-ID", F.col("page_id").cast("string")), *extra,
              ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
              ("Content-Type", F.lit("application/http; msgtype=response")),
              ("Content-Length", F.octet_length(block).cast("string"))]
    lines = [F.concat(F.lit(f"{k}: "), v) for k, v in fields]
    return F.concat(F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines), F.lit(CRLF * 2), block)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write deduplicated archives of (page_id, url, html)."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), base32_sha1(payload).alias("digest"), F.octet_length(payload).alias("bytes"))
    heads = materialize(rows.select("page_id", "url", "digest", "bytes",
                                    F.monotonically_increasing_id().alias("rid")), "warc-headers")
    heads = heads.withColumn("record_id", _urn("digest", "page_id", "rid"))
    own = F.col("digest") if min_bytes <= 0 else F.when(F.col("bytes") >= min_bytes, F.col("digest")).otherwise(
        F.concat_ws(":", "digest", "rid"))
    heads = heads.withColumn("key", own)
    best = heads.groupBy("key").agg(F.max(F.struct("page_id", "rid", "url", "digest", "record_id", "bytes")).alias("r"))
    originals = best.select("key", "r.*")

    def write(records: DataFrame, folder: str, at_most: int) -> None:
        records.write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", at_most).text(f"{path}/{folder}")

    # responses by size, so that a file is bounded in bytes: payloads of 4**k to 4**(k + 1) bytes are one folder
    sizes = [r[0] for r in heads.select(_size_class("bytes").alias("k")).distinct().collect()]
    for k in sorted(sizes):
        mine = _size_class("bytes") == k
        texts = rows.where(mine).groupBy("digest").agg(F.first("payload").alias("payload"))
        write(originals.where(mine).join(texts, "digest").select(_record("response", F.concat(F.lit(HTTP), "payload")).alias("value")),
              f"responses-{k:02d}", max(1, min(RECORDS_PER_FILE, BYTES_PER_FILE >> 2 * (k + 1))))
    target = originals.select("key", F.col("rid").alias("to_rid"), F.col("record_id").alias("to_id"),
                              F.col("url").alias("to_url"))
    revisits = heads.join(target, "key").where("rid <> to_rid").select(_record(
        "revisit", F.lit(HTTP), ("WARC-Profile", F.lit(PROFILE)), ("WARC-Refers-To", F.col("to_id")),
        ("WARC-Refers-To-Target-URI", F.regexp_replace("to_url", "[\r\n]", ""))).alias("value"))
    write(revisits, "revisits", RECORDS_PER_FILE)


def _size_class(size: str) -> F.Column:
    """k for payloads of 4**k to 4**(k + 1) bytes; 7 for all under 64 KB."""
    return F.greatest(F.lit(7), F.floor(F.log2(F.greatest(F.col(size), F.lit(1))) / 2)).cast("int")


def _records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of an archive."""
    while line := stream.readline():
        if line.strip() == b"":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name] = value.strip()
        yield fields, stream.read(int(fields["Content-Length"]))


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """PARSED rows of all archives under ``path``. Digest and length of a response
    are those of the payload read; a digest that differs from the header's fails
    the read. A revisit has its header's digest and a null length."""
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PARSED.split(", ")]
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        rows, held = [], 0
        for batch in batches:
            for content in batch.column(0):
                with gzip.GzipFile(fileobj=pa.BufferReader(content.as_buffer())) as stream:
                    for fields, block in _records(stream):
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        page, size, payload = fields.get("X-Page-ID"), None, None
                        if fields["WARC-Type"] == "response":
                            payload = block[block.index(b"\r\n\r\n") + 4:]
                            size = len(payload)
                            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                                raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
                        rows.append((fields["WARC-Record-ID"], fields["WARC-Type"], int(page) if page else None,
                                     fields["WARC-Target-URI"], digest, size, fields.get("WARC-Refers-To"),
                                     payload if with_payload else None))
                        held += size if with_payload and size else 200
                        if held > 1 << 23:
                            yield batch_of(rows)
                            rows, held = [], 0
        if rows:
            yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, PARSED)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to;
    revisits joined to the responses they refer to. ``records`` is read twice."""
    responses = records.where("record_type = 'response'")
    target = responses.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
                              F.col("payload_bytes").alias("to_bytes"), F.col("payload_digest").alias("to_digest"))
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes").join(target, "refers_to_id")
    return responses.select("page_id", "payload_bytes", "payload_digest", "record_type",
                            F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisits.select("page_id", F.col("to_bytes").alias("payload_bytes"), F.col("to_digest").alias("payload_digest"),
                        "record_type", "refers_to"))


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    headers = materialize(read_archives(spark, path).drop("payload", "url"), "warc-read")
    return resolve_revisits(headers)


_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP8_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h, row_number() OVER () AS rid FROM pages),
d AS (SELECT page_id, payload_bytes, rid, array_to_string(list_transform(range(32), lambda k:
   substr('{_B32}', (((('0x' || substr(h, (10 * (k // 8) + 1)::INT, 10))::BIGINT >> (35 - 5 * (k % 8))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest FROM p),
o AS (SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST, rid) AS k, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN top END AS refers_to FROM o"""
