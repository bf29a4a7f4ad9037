import base64
import hashlib

from slotwise.llm import warc

ROWS = [
    (5, "http://a", "same\r\n\r\nWARC/1.1\r\n\r\n"), (2, "http://b\r\nX: y", "same\r\n\r\nWARC/1.1\r\n\r\n"), (3, None, None),
    (4, "http://c", ""), (9, "http://d", "é" * 5000), (9, "http://d", "é" * 5000), (None, "http://e", "é" * 5000), (11, "u", "x"),
]


def brute(rows, least=0):
    out = []
    for n, (key, _, html) in enumerate(rows):
        payload = (html or "").encode()
        same = [(k is None, k or 0, m) for m, (k, _, h) in enumerate(rows) if (h or "").encode() == payload]
        first = min(same)
        leads = first[2] == n or len(payload) < least
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((key or -1, len(payload), digest, "response" if leads else "revisit", -1 if leads else first[1]))
    return sorted(out)


def told(df):
    return sorted((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type,
                   -1 if r.refers_to is None else r.refers_to) for r in df.collect())


def test_archives_hold_every_record(spark):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, digest string")
    assert told(warc.archive_report(pages)) == brute(ROWS)
    assert warc.archive_report(pages.limit(0)).count() == 0


def test_small_payloads_stay_whole(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    path = str(tmp_path / "out")
    warc.write_archives(pages, path, least=10)
    got = warc.read_archives(spark, path).collect()
    assert sum(r.record_type == "response" for r in got) == sum(r[3] == "response" for r in brute(ROWS, 10))
    assert {bytes(r.payload).decode() for r in got if r.payload is not None} == {h or "" for _, _, h in ROWS}
    assert all(r.url.startswith(("http", "urn", "u")) for r in got)


def test_parser_reads_by_length():
    record = b"WARC/1.1\r\nContent-Length: 8\r\nA: b\r\n\r\n\r\n\r\nWARC\r\n\r\n"
    assert [(f["a"], b) for f, b in warc.parsed(record * 2)] == [("b", b"\r\n\r\nWARC")] * 2
