import base64
import glob
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from eventstar.llm import warc as W
from eventstar.session import scratch_path

SCHEMA = "page_id bigint, url string, html string, payload string"
ROWS = [(3, "http://a/1", "same", "x"), (1, "http://a/2", "same", "x"), (2, None, "same", "x"),
        (4, "http://a/\r\nb", "other\r\n\r\nWARC/1.1\r\nWARC-Type: response", "x"), (5, "u", None, "x"),
        (6, "u", "", "x"), (7, "u", "é日本" * 5000, "x"), (None, "u", "same", "x"), (9, "u", "z" * 300000, "x"),
        (8, "v", "tie", "x"), (8, "v", "tie", "x")]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, min_bytes=0):
    first = {}
    for i, _, html, _ in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    for i, _, html, _ in rows:
        html = html or ""
        small = len(html.encode()) < min_bytes
        again = not small and i != first.get(html)
        yield (i, len(html.encode()), digest(html), "revisit" if again else "response",
               first.get(html) if again else None)


def key(r):
    return tuple(str(x) for x in r)


def written(spark, records):
    path = scratch_path(spark, "warc-test")
    W.write_archives(records, path, records_per_file=3)
    return path


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(spark, min_bytes):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    path = written(spark, W.resolve_revisits(W.page_records(pages), min_bytes))
    got = W.read_archives(spark, path).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in got), key=key) == sorted(expected(ROWS, min_bytes), key=key)
    html = {r[0]: r[2] or "" for r in ROWS}
    assert all(bytes(r.payload).decode() == html[r.page_id] for r in got if r.record_type == "response")
    assert all(r.payload is None for r in got if r.record_type == "revisit")
    assert {r.url for r in got if r.page_id in (2, 4)} == {None, "http://a/%0D%0Ab"}


def test_binary_payloads_pass_unchanged(spark):
    rows = [(i, "u", bytes(range(256)) * (i + 1)) for i in range(3)]
    records = spark.createDataFrame(rows, "page_id bigint, url string, payload binary").select(
        "*", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        W.base32_sha1(F.col("payload")).alias("payload_digest"))
    got = W.read_archives(spark, written(spark, W.resolve_revisits(records))).collect()
    assert {r.page_id: bytes(r.payload) for r in got} == {i: p for i, _, p in rows}


def test_archives_read_back_can_be_resolved_again(spark):
    """Merging archives: revisits find their original under any id."""
    pages = spark.createDataFrame([(5, "u", "aa", ""), (6, "u", "aa", "")], SCHEMA)
    older = W.read_archives(spark, written(spark, W.resolve_revisits(W.page_records(pages))))
    newer = W.page_records(spark.createDataFrame([(2, "v", "aa", ""), (3, "v", "b", "")], SCHEMA))
    merged = older.unionByName(newer.withColumns(
        {"record_type": F.lit("response"), "refers_to": F.lit(None).cast("bigint")}))
    got = {r.page_id: (r.record_type, r.refers_to) for r in
           W.read_archives(spark, written(spark, W.resolve_revisits(merged))).collect()}
    assert got == {2: ("response", None), 3: ("response", None), 5: ("revisit", 2), 6: ("revisit", 2)}
    orphan = older.filter("record_type = 'revisit'")
    kept = W.resolve_revisits(orphan).collect()
    assert [(r.page_id, r.record_type, r.refers_to) for r in kept] == [(6, "revisit", 5)]


def test_records_follow_the_format(spark):
    pages = spark.createDataFrame(ROWS[:1], SCHEMA).coalesce(1)           # payloads are not dealt anew
    path = written(spark, W.resolve_revisits(W.page_records(pages)))
    (file,) = glob.glob(path.removeprefix("file:") + "/*.gz")
    raw = gzip.open(file).read()
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    assert rest.endswith(b"\r\n\r\n") and len(rest) == int(fields["Content-Length"]) + 4
    assert fields["WARC-Payload-Digest"] == "sha1:" + digest("same")


def test_broken_archives_raise():
    record = b"WARC/1.1\r\nContent-Length: 10\r\n\r\n0123456789\r\n\r\n"
    assert [b for _, b in W.parse_records(iter([record[:9], record[9:], record]))] == [b"0123456789"] * 2
    with pytest.raises(ValueError, match="inside a record"):
        list(W.parse_records(iter([record[:-12]])))
    with pytest.raises(ValueError, match="not a record"):
        list(W.parse_records(iter([b"junk\r\n\r\n"])))


def test_empty_table(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert W.read_archives(spark, written(spark, W.resolve_revisits(W.page_records(pages)))).count() == 0


def test_archives_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(W, "ARCHIVE_BYTES", 100_000)
    pages = spark.createDataFrame([(i, "u", f"{i:05d}" * 4000, "x") for i in range(12)], SCHEMA).coalesce(1)
    path = scratch_path(spark, "warc-bytes")
    W.write_archives(W.resolve_revisits(W.page_records(pages)), path, longest=20_000)
    sizes = [len(gzip.decompress(open(f, "rb").read())) for f in glob.glob(f"{path}/*.gz")]
    assert len(sizes) == 6 and max(sizes) < 100_000
    assert W.read_archives(spark, path).count() == 12


def test_payloads_stay_where_they_are(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    plan = W.resolve_revisits(W.page_records(pages))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
