"""WARC archives with revisit resolution.

Headers (id, digest, size) are shuffled to find, for each payload digest,
the record that stays a ``response``; the others become ``revisit`` records
that refer to it and carry no payload.  The rows then join the narrow list of
revisits, which is written, counted and broadcast; only beyond BROADCAST_ROWS
of them are payloads shuffled too.  Archives are written by Spark's text
writer, whose record separator is the WARC one (bytes pass unchanged), so any
store that Spark reaches will do; a file holds as many records as stay below
ARCHIVE_BYTES even if all were as long as the longest.  They are read back as
binary files and parsed record by record by Content-Length.

Defined results: null html is an empty payload; payloads of fewer than
``min_bytes`` bytes are always responses; the smallest id of a payload is the
response, and rows that repeat this id with the same payload are responses as
well; a null id comes after all others; null urls leave the target out; tabs
and line breaks of a url are percent-encoded; extra columns are not read; an empty
table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstar.llm.common import arrow_map, materialize, small_side, table
from eventstar.session import scratch_path

END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

#: Bytes of a file, below what a binary cell can hold, and of a record's headers.
ARCHIVE_BYTES, HEADER_BYTES = 1 << 28, 16 << 10

RECORDS = ("page_id bigint, url string, record_type string, payload_bytes bigint, "
           "payload_digest string, refers_to bigint, payload binary")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1: each 40 bits are eight digits of base 32."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def page_records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest of every page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                        payload.alias("payload"),
                        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
                        base32_sha1(payload).alias("payload_digest"))


def resolve_revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``records`` with record_type and refers_to.

    Records without a payload (revisits of archives read earlier) refer to the
    response that holds their payload, whatever its id; those whose original is
    missing keep their old reference, if the column is there.
    """
    old = F.col("refers_to") if "refers_to" in records.columns else F.lit(None).cast("bigint")
    rows = records.select("page_id", "url", "payload", "payload_bytes", "payload_digest",
                          old.alias("old_refers_to"))
    has = F.col("payload").isNotNull()
    heads = rows.select("page_id", "payload_bytes", "payload_digest", has.alias("has"))
    # a group of copies of any size reaches the shuffle as one row per task
    firsts = (heads.filter(F.col("payload_bytes") >= min_bytes)
              .groupBy("payload_digest", "payload_bytes")
              .agg(F.min(F.when(F.col("has"), F.col("page_id"))).alias("first"),
                   F.count(F.lit(1)).alias("copies"))
              .filter((F.col("copies") > 1) & F.col("first").isNotNull()))
    revisits = (heads.join(firsts, ["payload_digest", "payload_bytes"])
                .filter(~F.col("page_id").eqNullSafe(F.col("first")) | ~F.col("has"))
                .select(F.col("page_id").alias("r_id"), F.col("payload_digest").alias("r_digest"),
                        "first").distinct())
    revisits = small_side(materialize(revisits, "revisits"))
    joined = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("r_id"))
                       & (F.col("payload_digest") == F.col("r_digest")), "left")
    again = F.col("first").isNotNull()
    return joined.select(
        "page_id", "url",
        F.when(again | F.col("payload").isNull(), "revisit").otherwise("response")
        .alias("record_type"),
        "payload_bytes", "payload_digest",
        F.coalesce("first", F.when(F.col("payload").isNull(), F.col("old_refers_to")))
        .alias("refers_to"),
        F.when(~again, F.col("payload")).alias("payload"))


def _urn(page_id: Column, digest: Column) -> Column:
    """A record id that depends on the record alone."""
    h = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("-")), digest))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in cuts)),
                    F.lit(">"))


def record_bytes(date: str) -> Column:
    """The record, fresh headers and block, as text of unchanged bytes."""
    revisit = F.col("record_type") == "revisit"
    field = lambda name, value: F.concat(F.lit(f"\r\n{name}: "), value)         # noqa: E731
    maybe = lambda name, value: F.coalesce(field(name, value), F.lit(""))       # noqa: E731
    url = F.col("url")
    for code in (0x09, 0x0A, 0x0D):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    size = F.when(revisit, F.lit(0)).otherwise(F.octet_length("payload")) + len(HTTP_HEAD)
    return F.concat(
        F.lit("WARC/1.1"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", _urn(F.col("page_id"), F.col("payload_digest"))),
        field("WARC-Date", F.lit(date)),
        maybe("WARC-Target-URI", url),
        maybe("Page-ID", F.col("page_id").cast("string")),
        F.concat(F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        field("Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(
            F.lit(f"\r\nWARC-Profile: {PROFILE}"),
            maybe("WARC-Refers-To", _urn(F.col("refers_to"), F.col("payload_digest"))),
            maybe("Refers-To-Page-ID", F.col("refers_to").cast("string")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response"),
        field("Content-Length", size.cast("string")),
        F.lit(END + HTTP_HEAD.decode()),
        F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string")))


def write_archives(records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z",
                   records_per_file: int = 4000, longest: int = 0) -> None:
    """Gzipped WARC files of at most ``records_per_file`` records each, fewer if
    payloads of up to ``longest`` bytes could make a file too long to be read
    back whole (ARCHIVE_BYTES; a single longer record is a file of its own)."""
    records_per_file = max(1, min(records_per_file, ARCHIVE_BYTES // (longest + HEADER_BYTES)))
    (records.select(record_bytes(date).alias("value")).write
     .option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of a stream; memory holds one
    record and one chunk."""
    buffer, done = bytearray(), False

    def more() -> bool:
        nonlocal done
        for c in chunks:
            buffer.extend(c)
            return True
        done = True
        return False

    while True:
        seen = 0
        while (head := buffer.find(END.encode(), max(0, seen - 3))) < 0:
            seen = len(buffer)
            if not more():
                if buffer.strip():
                    raise ValueError("archive ends inside a record")
                return
        lines = bytes(buffer[:head]).decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        need = head + 4 + int(fields["content-length"]) + 4
        while len(buffer) < need and more():
            pass
        if len(buffer) < need:
            raise ValueError("archive ends inside a record")
        yield fields, bytes(buffer[head + 4:need - 4])
        del buffer[:need]


def unzipped(content: memoryview, step: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, piece by piece."""
    z = zlib.decompressobj(31)
    for at in range(0, len(content), step):
        data = bytes(content[at:at + step])
        while data:
            yield z.decompress(data)
            data = z.unused_data
            if z.eof:
                z = zlib.decompressobj(31)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of the archives below ``path``.  Payload digests of
    responses are computed anew and must equal their headers."""
    def number(v: str | None) -> int | None:
        return None if v is None else int(v)

    def rows_of(content: memoryview) -> Iterator[tuple]:
        for f, block in parse_records(unzipped(content)):
            digest = f["warc-payload-digest"].removeprefix("sha1:")
            size, body = number(f["payload-length"]), None
            if f["warc-type"] == "response":
                body = block.partition(END.encode())[2]
                found = base64.b32encode(hashlib.sha1(body).digest()).decode()
                if (found, len(body)) != (digest, size):
                    raise ValueError(f"payload of {f['warc-record-id']} differs from its headers")
            yield (number(f.get("page-id")), f.get("warc-target-uri"), f["warc-type"], size, digest,
                   number(f.get("refers-to-page-id")), body if payload else None)

    def parse(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()),
                            ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                            ("payload", pa.binary())])
        for content in batch.column(0):
            rows, held = [], 0
            for row in rows_of(memoryview(content.as_buffer())):
                rows.append(row)
                held += 200 + len(row[-1] or b"")
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(schema.names, r, strict=True)) for r in rows], schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return arrow_map(files.select("content"), parse, RECORDS)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, deduplicated by payload, read back."""
    path = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    longest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0
    write_archives(resolve_revisits(page_records(pages)), path, longest=longest)
    return read_archives(spark, path, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


#: The same in DuckDB; url as the archives hold it.
OP8_SQL = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, url, strlen(html) AS n, sha1(html) AS hex,
             min(page_id) OVER (PARTITION BY html) AS first FROM p),
b AS (SELECT page_id, url, n, first, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((CAST('0x' || substr(hex, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INT) + 1, 1)
        for i in range(32)], '') AS digest FROM h)
SELECT page_id, replace(replace(replace(url, chr(9), '%09'), chr(10), '%0A'), chr(13), '%0D') AS url,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""
