import base64
import gzip
import hashlib
import random

import pytest

from textsift.llm import warc as W


def test_records_round_trip_and_damage():
    body = "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n".encode()
    sha = hashlib.sha1(body).digest()
    data = W.record("response", 7, "http://x.y/\r\nz", "2024-01-01T00:00:00Z", sha, len(body), body, None) + W.record("revisit", None, None, "2024-01-01T00:00:01Z", sha, len(body), b"", 7)
    a, b = W.parse(data)
    assert (a["page_id"], a["record_type"], a["payload_bytes"], a["refers_to"], a["url"]) == (7, "response", len(body), None, "http://x.y/ z")
    assert (b["page_id"], b["record_type"], b["payload_bytes"], b["refers_to"], b["offset"]) == (None, "revisit", len(body), 7, a["length"])
    for bad in (data[:-1], data[1:], data.replace("é".encode(), b"ee", 1)):
        with pytest.raises(ValueError):
            list(W.parse(bad))


def test_loser_tree():
    rnd = random.Random(1)
    for k in (0, 1, 2, 3, 8, 13):
        runs = [sorted(rnd.randrange(30) for _ in range(rnd.randrange(20))) for _ in range(k)]
        assert list(W.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_pages_edges_and_order(spark, tmp_path):
    rows = [(i, f"http://{h}.example.com/p{i % 5}?q=1", f"<html>{i % 7}</html>") for i, h in enumerate(["www", "a", "B"] * 40)]
    rows += [(500, None, None), (501, "not a url", ""), (502, "http://[bad", "x" * 300000), (None, "http://x.y/", "only"), (None, "http://x.y/", "<html>1</html>"), (503, "http://x.y/", "twice"), (503, "http://x.y/", "twice"), (504, "u", "\r\n\r\n\x00퟿")]
    df = spark.createDataFrame([(*r, "clash", b"x") for r in rows], "page_id long, url string, html string, sha string, payload binary")
    index = W.capture_histories(df, file_bytes=20000)
    got = index.collect()
    assert [(r.url_key, r.captured, r.page_id or -1) for r in got] == sorted((r.url_key, r.captured, r.page_id or -1) for r in got)
    want = []
    for i, u, t in rows:
        raw = (t or "").encode()
        top = max((j for j, _, x in rows if (x or "") == (t or "") and j is not None), default=None)
        refers = top if top is not None and (i is None or i < top) else None
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if refers is None else "revisit", refers))
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(want, key=key)
    # entries point at their records
    for r in got[:20]:
        data = gzip.open(r.file.removeprefix("file:")).read()[r.offset:r.offset + r.length]
        assert next(W.parse(data))["page_id"] == r.page_id
    assert W.capture_histories(df.limit(0)).count() == 0
    small = W.capture_histories(df, min_payload_bytes=10**6).collect()
    assert {r.record_type for r in small} == {"response"}
