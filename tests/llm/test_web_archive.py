import hashlib
import re

from pyspark.sql import functions as F

from adloom.llm import web_archive as w


def test_round_trip_of_odd_rows(spark):
    long, same = "é" * 200_000, "<p>" + "x" * 1200
    rows = [
        (1, "http://a/", same), (9, None, same), (None, "http://n/", same), (4, "bad\r\nurl", same),
        (4, "bad\r\nurl", same), (9, None, same), (5, "u", "short"), (6, "u", "short"), (7, None, None),
        (8, "v", ""), (10, "v", long), (None, None, "only " * 300), (None, None, "only " * 300),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.withColumns({"header": F.lit("x"), "sha256": F.lit(1), "payload": F.lit(2)})
    archive = w.archived(pages)
    assert archive.payloads.count() == len({h or "" for *_, h in rows})
    found = w.records(archive).collect()
    names = {r.record_id for r in found}
    key = lambda r: (str(r[0]), r[1])
    assert sorted(((r.page_id, bytes(r.payload)) for r in found), key=key) == sorted(
        ((p, (h or "").encode()) for p, _, h in rows), key=key
    )
    for r in found:
        assert r.digest == hashlib.sha1(r.payload).hexdigest()
        revisit = bytes(r.payload) == same.encode() and r.page_id != 9
        assert (r.record_type, r.refers_to) == (("revisit", 9) if revisit else ("response", None))
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and rest.endswith(b"\r\n\r\n")
        size = int(head.rpartition(b"Content-Length: ")[2])
        block = rest[:-4]
        http, _, body = block.partition(b"\r\n\r\n")
        assert size == len(block) and b"WARC-Date: 2024-01-01T00:00:00Z\r\n" in head
        assert block == b"" if revisit else body == bytes(r.payload) and http.startswith(b"HTTP/1.1 200 OK")
        assert f"WARC-Record-ID: {r.record_id}".encode() in head
        refers = re.findall(rb"WARC-Refers-To: ([^\r]*)", head)
        assert bool(refers) == revisit and all(x.decode() in names for x in refers)
    assert len(names) == len(found)
    # Urls come back as they were, line breaks and all.
    assert sorted((str(r.page_id), r.url) for r in found if r.url) == sorted((str(p), u) for p, u, _ in rows if u)
    assert w.records(w.archived(pages.limit(0))).count() == 0


def test_spoilt_payload_is_noticed(spark, folder):
    pages = spark.createDataFrame([(1, "u", "some text")], "page_id long, url string, html string")
    archive, at, heads = w.archived(pages), folder("payloads"), folder("headers")
    archive.payloads.withColumn("payload", F.lit(b"other")).write.parquet(at)
    archive.headers.write.parquet(heads)
    try:
        w.records(w.open_archive(spark, at, heads)).collect()
    except Exception as error:
        assert "don't have the digest" in str(error)
    else:
        raise AssertionError("not noticed")
