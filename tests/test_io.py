"""Sources and sinks: index lines, JSONL documents with bad lines, archives, incremental streaming, sinks."""
import gzip
import json
import os
import random
import tempfile
import zlib

from pyspark.sql import functions as F

from textsift.sinks import writers as K
from textsift.sources import archive as AR
from textsift.sources import readers as S


def test_index_line_parser_keeps_bad_json(spark):
    lines = spark.createDataFrame([('pt,x)/ 20080101000000 {"url": "http://x.pt/", "status": "200", '
                                    '"mime": "text/html"}',), ("pt,y)/ 20080101000001 {not json",)], "value string")
    rows = {r["surt"]: r for r in S.parse_index_lines(lines).collect()}
    assert rows["pt,x)/"]["url"] == "http://x.pt/" and rows["pt,x)/"]["_raw"] is None
    assert rows["pt,y)/"]["url"] is None and rows["pt,y)/"]["_raw"].startswith("pt,y)/")


def test_read_documents_counts_malformed_lines(spark):
    d = tempfile.mkdtemp(prefix="ts-docs-")
    os.makedirs(os.path.join(d, "sub"))
    with gzip.open(os.path.join(d, "sub", "colA_part.jsonl.gz"), "wt") as f:
        f.write(json.dumps({"text": "hello world", "metadata": {"url": "http://a.pt/x"}}) + "\n")
        f.write("{broken\n")
    df = S.read_documents(spark, d)
    rows = df.select("text", "_corrupt_record").collect()
    assert len(rows) == 2 and sum(1 for r in rows if r["_corrupt_record"]) == 1
    assert df.select(S.collection_of(F.element_at(F.split("file_path", "/"), -1))).first()[0] == "colA"


def _warc(records):
    out = []
    for url, html in records:
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n{html}".encode()
        head = (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {url}\r\nWARC-Date: 2008-01-01T00:00:00Z\r\n"
                f"Content-Length: {len(http)}\r\n\r\n").encode()
        out.append(head + http + b"\r\n\r\n")
    return gzip.compress(b"".join(out))


def test_archive_reader_and_bad_file(spark):
    d = tempfile.mkdtemp(prefix="ts-warc-")
    os.makedirs(os.path.join(d, "c1"))
    with open(os.path.join(d, "c1", "a.warc.gz"), "wb") as f:
        f.write(_warc([("http://a.pt/1", "<html><title>T</title><p>one</p></html>"), ("http://a.pt/2", "<p>x</p>")]))
    with open(os.path.join(d, "c1", "bad.warc.gz"), "wb") as f:
        f.write(b"not gzip at all")
    rows = AR.read_archive(spark, d, glob="*/*.warc.gz").collect()
    good = [r for r in rows if r["error"] is None]
    assert sorted(r["url"] for r in good) == ["http://a.pt/1", "http://a.pt/2"]
    assert any(r["error"] for r in rows)


def _members(records):
    return [_warc([r]) for r in records]


def _arc(url, html):
    return gzip.compress(f"{url} 192.0.2.1 20080101000000 text/html {len(html)}\n{html}\n".encode())


def _stored(data):
    """A gzip member whose data stand in it as they are."""
    pack = zlib.compressobj(0, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def test_archives_are_split_at_records(spark):
    rnd = random.Random(5)
    page = lambda k: f"<p>{k} " + " ".join(str(rnd.random()) for _ in range(rnd.randrange(1, 400))) + "</p>"
    records = [(f"http://a.pt/{k}", page(k)) for k in range(200)]
    d = tempfile.mkdtemp(prefix="ts-split-")
    put = lambda name, data: open(os.path.join(d, name), "wb").write(data)  # noqa: E731, SIM115
    put("members.gz", b"".join(_members(records)))
    put("one.gz", _warc(records))  # one member: can't be split
    put("arc.gz", b"".join(_arc(u, h) for u, h in records))
    blob = gzip.decompress(_warc(records))
    put("across.gz", b"".join(gzip.compress(blob[k:k + 5000]) for k in range(0, len(blob), 5000)))  # records across members
    # a page that is an archive of several members, kept as it is: its members are no records of the file
    inner = b"".join(_members([(f"http://inner.pt/{k}", page(k)) for k in range(60)]))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: application/gzip\r\n\r\n" + inner
    outer = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://a.pt/inner\r\nContent-Length: " + str(len(http)).encode() + b"\r\n\r\n" + http + b"\r\n\r\n"
    put("nested.gz", b"".join(_members(records[:100])) + _stored(outer) + b"".join(_members(records[100:])))
    put("empty.gz", b"")
    put("short.gz", b"\x1f")
    whole = AR.read_archive(spark, d, glob="*.gz", html_only=False)
    plain = sorted((r.file_path, r.url, r.html, r.error) for r in whole.collect() if r.error is None)
    assert len(plain) == 5 * 200 + 1 and not any(u.startswith("http://inner") for _, u, _, _ in plain)
    for split in (3000, 40_000):
        files = spark.read.format("binaryFile").load(f"{d}/*.gz").select("path", "length")
        runs = AR.archive_runs(files, split).collect()
        by = {}
        for r in sorted(runs, key=lambda r: (r.path, r.start)):
            by.setdefault(r.path.rsplit("/", 1)[1], []).append((r.start, r.end))
        for name, spans in by.items():  # no byte is left out, none is read twice
            assert spans[0][0] == 0 and spans[-1][1] == os.path.getsize(os.path.join(d, name))
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
        if split == 3000:
            assert len(by["members.gz"]) >= 20 and len(by["arc.gz"]) >= 20 and len(by["one.gz"]) == 1
    for split in (3000, 40_000):
        got = AR.read_archive(spark, d, glob="*.gz", html_only=False, split_bytes=split).collect()
        assert sorted((r.file_path, r.url, r.html, r.error) for r in got if r.error is None) == plain


def test_damaged_bytes_cost_one_run(spark):
    records = [(f"http://a.pt/{k}", f"<p>{k * 7919}</p>") for k in range(100)]
    parts = _members(records)
    parts[40] = parts[40][:12] + b"\xff\xff\xff" + parts[40][15:]
    d = tempfile.mkdtemp(prefix="ts-bad-")
    with open(os.path.join(d, "a.gz"), "wb") as f:
        f.write(b"".join(parts))
    size = sum(map(len, parts))
    rows = AR.read_archive(spark, d, glob="*.gz", split_bytes=size // 10).collect()
    urls = [r.url for r in rows if r.error is None]
    assert len([r for r in rows if r.error]) == 1 and len(set(urls)) == len(urls) >= 85 and "http://a.pt/99" in urls


def test_written_archives_are_read_by_ranges(spark):
    rows = [(f"http://a.pt/{k}", "20080101000000", f"<p>ã {k}</p>") for k in range(150)] + [("http://a.pt/empty", None, None)]
    path = os.path.join(tempfile.mkdtemp(prefix="ts-arch-"), "out")
    K.write_archives(spark.createDataFrame(rows, "url string, timestamp string, html string").repartition(2), path)
    assert sorted(os.path.splitext(f)[1] for f in os.listdir(path) if not f.startswith(".")) == [".gz", ".gz"]
    got = AR.read_archive(spark, path, glob="*.warc.gz", split_bytes=2000)
    assert sorted((r.url, r.timestamp, r.html) for r in got.collect()) == sorted((u, t or "", h or "") for u, t, h in rows)
    empty = os.path.join(tempfile.mkdtemp(prefix="ts-arch-"), "out")
    K.write_archives(spark.createDataFrame([], "url string, timestamp string, html string"), empty)


def test_incremental_stream_skips_done(spark):
    from textsift.operators import waterfall as WF
    from textsift.streaming.incremental import incremental_filter
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("ts-in-", "ts-out-", "ts-ck-"))

    def put(name, text):
        with gzip.open(os.path.join(src, name), "wt") as f:
            f.write(json.dumps({"id": name, "text": text, "metadata": {"language": "pt", "language_score": 1.0}})
                    + "\n")

    put("a.jsonl.gz", "uma frase com palavras")
    p = WF.FilterParams(remove_short_lines=False)
    incremental_filter(spark, src, out, params=p, checkpoint=ck)
    put("b.jsonl.gz", "outra frase com palavras")
    incremental_filter(spark, src, out, params=p, checkpoint=ck)
    got = spark.read.parquet(os.path.join(out, "labelled"))
    assert sorted(r["id"] for r in got.collect()) == ["a.jsonl.gz", "b.jsonl.gz"]
    assert got.select("batch_id").distinct().count() == 2


def test_sinks_partitioned(spark):
    d = tempfile.mkdtemp(prefix="ts-sink-")
    df = spark.createDataFrame([(1, "t1", "high", "c1", 5), (2, "t2", "low", "c2", 7)],
                               "doc_id long, text string, quality_label string, collection string, token_count long")
    K.write_tiers(df, os.path.join(d, "tiers"))
    back = spark.read.json(os.path.join(d, "tiers"))
    assert back.count() == 2 and "metadata" in back.columns
    assert os.path.isdir(os.path.join(d, "tiers", "quality_label=high", "collection=c1"))


def test_few_files_are_spread(spark):
    """one gzip file is one task; its documents are filtered in several a core."""
    from textsift.streaming.incremental import incremental_filter
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("ts-in-", "ts-out-", "ts-ck-"))
    with gzip.open(os.path.join(src, "a.jsonl.gz"), "wt") as f:
        f.writelines(json.dumps({"id": str(i), "text": "uma frase com palavras", "metadata": {"language": "pt", "language_score": 1.0}}) + "\n" for i in range(200))
    incremental_filter(spark, src, out, checkpoint=ck)
    got = spark.read.parquet(os.path.join(out, "labelled"))
    assert sorted(int(r.id) for r in got.select("id").collect()) == list(range(200)) and len(got.inputFiles()) > 4
