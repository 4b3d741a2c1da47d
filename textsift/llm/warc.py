"""WARC archives with an externally merged capture index (operator 4).

Writing: each page becomes a record. Of pages with equal payloads the one with the largest id is a response record,
the others are revisit records that refer to it and carry its digest and length, not the payload. The records are dealt to files of about
``file_bytes`` and sorted within each by (URL key, timestamp, id), so every file is a locally sorted capture run.
Spark's text writer puts the bytes down, compressed by gzip: a record ends in CR LF CR LF, whose last byte is the writer's
line end. Offsets and lengths are those of the uncompressed archive. What equal payloads were found by is deleted once the
archives are written.

Reading: each file is parsed record by record; payloads are checked against their digests. The entries (CDX) of a file
are its run, in the file's order. The index merge deals the entries to ranges of the key; a range holds a slice of
every run, and a loser tree merges the slices k ways by URL key and timestamp. The parts in order are
the globally ordered capture histories.

Scale: one shuffle of payloads, by id and digest, which no hot payload can skew; groups of equal payloads are
aggregated by digest before anything is joined. Ranges include the run and its position, so captures of one URL, or
repeated rows, split over tasks too.

Defined cases: a null payload is empty; payloads are equal if length and SHA-256 are. A null id is never referred to:
such a page revisits its group's response if there is one, else it is a response. Rows that share id and payload are
written as often as they occur, all of one type. A null or malformed URL has the URL itself (or nothing) as its key.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textsift.llm.common import drop_table, saved, scratch, shuffle_partitions

CRLF = b"\r\n"
#: The first capture's time where pages have none; each page follows its id in seconds.
EPOCH = 1_700_000_000
ENTRY = ("page_id bigint, url string, url_key string, captured string, record_type string, refers_to bigint, payload_bytes bigint, "
         "payload_digest string, file string, seq bigint, offset bigint, length bigint")


def url_key(url: Column) -> Column:
    """Sort-friendly key: host labels reversed, then path and query, in lower case."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    rest = F.lower(F.concat(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), F.coalesce(F.concat(F.lit("?"), F.try_parse_url(url, F.lit("QUERY"))), F.lit(""))))
    return F.coalesce(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest), url, F.lit(""))


def default_time(page_id: Column) -> Column:
    return F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(1_000_000_000))), "yyyy-MM-dd'T'HH:mm:ss'Z'")


# --- records -------------------------------------------------------------------------------------------------------

def digest32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    number = (name or "")[len("<urn:page:"):-1]
    return int(number) if re.fullmatch(r"-?[0-9]+", number) else None


def record(kind: str, page_id: int | None, url: str | None, captured: str, sha1: bytes, size: int, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC/1.1 response or revisit record; the block is an HTTP response, without its body in a revisit."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {captured}",
            # a header is one line
            f"WARC-Target-URI: {re.sub(r'[\r\n]+', ' ', url or '')}", f"WARC-Payload-Digest: sha1:{digest32(sha1)}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_name(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + CRLF + CRLF + block + CRLF + CRLF


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (x.partition(b":") for x in lines.split(CRLF)[1:])
    return {k.strip().lower().decode(): v.strip().decode() for k, _, v in pairs}


def parse(data: bytes) -> Iterator[dict]:
    """Records of an archive in order; raises ValueError where the bytes are no record or a payload isn't the digest's."""
    at = 0
    while at < len(data):
        end = data.find(CRLF + CRLF, at)
        if end < 0 or data[at:at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        head = _headers(data[at:end])
        start, size = end + 4, int(head["content-length"])
        stop = start + size
        if data[stop:stop + 4] != CRLF + CRLF:
            raise ValueError(f"the record at byte {at} has a wrong length")
        http = data.find(CRLF + CRLF, start, stop)
        payload_bytes = int(_headers(data[start:http])["content-length"])
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        payload = data[http + 4:stop]
        if head["warc-type"] == "response" and (len(payload) != payload_bytes or digest32(hashlib.sha1(payload).digest()) != digest):
            raise ValueError(f"the payload at byte {at} isn't the digest's")
        yield {"page_id": _page(head["warc-record-id"]), "url": head["warc-target-uri"], "captured": head["warc-date"], "record_type": head["warc-type"],
               "refers_to": _page(head.get("warc-refers-to")), "payload_bytes": payload_bytes, "payload_digest": digest, "offset": at, "length": stop + 4 - at}
        at = stop + 4


# --- Spark ---------------------------------------------------------------------------------------------------------

def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = zip(*[c.to_pylist() for c in b.columns], strict=True)
        # without the last byte, which the text writer adds
        made = [record("response" if refers is None else "revisit", page, url, when, sha1, size, body or b"", refers)[:-1] for page, url, when, sha1, size, body, refers in rows]
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["record"])


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", time_col: str | None = None,
                   min_payload_bytes: int = 0, file_bytes: int = 32 << 20) -> None:
    """Write every page as a record below ``path``. ``time_col``: WARC dates; else derived from the id."""
    page = F.col(id_col).cast("bigint")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    when = F.coalesce(F.col(time_col).cast("string"), default_time(page)) if time_col else default_time(page)
    rows = pages.select(page.alias("page_id"), F.col(url_col).alias("url"), when.alias("captured"), payload.alias("payload"))
    rows = rows.select("*", F.coalesce(F.col("page_id").cast("string"), F.lit("none")).alias("pid"), F.sha2("payload", 256).alias("sha"), F.octet_length("payload").cast("bigint").alias("size"))

    meta = saved(rows.select("page_id", "pid", "sha", "size"), "payloads")
    total = meta.agg(F.sum(F.col("size") + 600)).first()[0] or 0
    groups = meta.where(F.col("size") >= min_payload_bytes).groupBy("sha", "size").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
    groups = saved(groups.where((F.col("n") > 1) & F.col("response").isNotNull()).select("sha", "size", "response"), "equal")
    refers = meta.join(groups, ["sha", "size"]).where(F.col("page_id").isNull() | (F.col("page_id") < F.col("response")))
    refers = saved(refers.groupBy("pid", "sha").agg(F.max("response").alias("refers_to")), "revisits")

    files = max(1, math.ceil(total / file_bytes))
    rows = rows.repartition(files, "pid", "sha").join(refers.repartition(files, "pid", "sha"), ["pid", "sha"], "left")
    rows = rows.select("page_id", "url", "captured", F.unhex(F.sha1("payload")).alias("sha1"), "size", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("body"), "refers_to")
    rows = rows.sortWithinPartitions(url_key(F.col("url")), "captured", "page_id")
    rows.mapInArrow(_records, "record binary").select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", "gzip").text(path)
    for t in (meta, groups, refers):
        drop_table(t)


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """The entries of every archive below ``path``; (file, seq) gives each file's order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("captured", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("file", pa.string()), ("seq", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
        for b in batches:
            for name, content in zip(b.column(0), b.column(1), strict=True):
                data = content.as_buffer().to_pybytes()
                if name.as_py().endswith(".gz"):
                    data = gzip.decompress(data)
                rows = [x | {"file": name.as_py(), "seq": i} for i, x in enumerate(parse(data))]
                yield pa.RecordBatch.from_pylist(rows, schema)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    order = [c.split()[0] for c in ENTRY.split(", ")]
    return files.mapInArrow(run, ENTRY.replace("url_key string, ", "")).withColumn("url_key", url_key(F.col("url"))).select(order)


class LoserTree:
    """k-way merge of sorted runs: inner nodes hold the loser of their match, the root the overall winner."""

    def __init__(self, runs: list[Iterator]):
        self.runs, k = runs, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.losers = [0] * max(1, k)
        winner = [0] * k + list(range(k))
        for n in range(k - 1, 0, -1):
            a, b = winner[2 * n], winner[2 * n + 1]
            winner[n], self.losers[n] = (a, b) if self.beats(a, b) else (b, a)
        if k > 1:
            self.losers[0] = winner[1]

    def beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def __iter__(self) -> Iterator:
        k = len(self.runs)
        while k and self.heads[i := self.losers[0]] is not None:
            yield self.heads[i]
            self.heads[i] = next(self.runs[i], None)
            n = (i + k) // 2
            while n:  # replay the winner's way up
                if self.beats(self.losers[n], i):
                    self.losers[n], i = i, self.losers[n]
                n //= 2
            self.losers[0] = i


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (file, seq): slices of the runs, merged by (url_key, captured, page_id)."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    column = lambda name: table.column(name).to_pylist()
    slices: dict[str, list] = {}
    for i, (f, u, t, p) in enumerate(zip(column("file"), column("url_key"), column("captured"), column("page_id"), strict=True)):
        # the order of Spark's sort: bytes of strings, nulls first
        slices.setdefault(f, []).append((u.encode(), t.encode(), p is not None, p or 0, i))
    merged = [x[-1] for x in LoserTree([iter(s) for s in slices.values()])]
    for a in range(0, len(merged), 10_000):
        yield from table.take(pa.array(merged[a:a + 10_000])).combine_chunks().to_batches()


def merge_index(entries: DataFrame, part_rows: int = 200_000) -> DataFrame:
    """``entries`` globally ordered by (url_key, captured, page_id): partitions are consecutive ranges of the key."""
    spark = entries.sparkSession
    runs = saved(entries, "runs")
    n = runs.count()
    parts = max(1, math.ceil(n / part_rows), min(math.ceil(n / 5_000), shuffle_partitions(spark)))
    ranges = runs.repartitionByRange(parts, "url_key", "captured", "page_id", "file", "seq")
    return ranges.sortWithinPartitions("file", "seq").mapInArrow(_merge, ENTRY)


def capture_histories(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back and return the merged index."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archives(pages, path, **options)
    return merge_index(read_entries(spark, path))


def page_records(pages: DataFrame) -> DataFrame:
    """The result of op4 from the merged index."""
    return capture_histories(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT t, max(page_id) AS m FROM p GROUP BY t),
d AS (SELECT p.*, g.m, list_transform(range(0, 8), lambda i: CAST('0x' || substr(h, CAST(i * 5 + 1 AS INTEGER), 5) AS INTEGER)) AS v FROM p JOIN g USING (t))
SELECT page_id, CAST(octet_length(CAST(encode(t) AS BLOB)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(v, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x // 32768) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x // 1024) % 32 + 1, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x // 32) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x % 32 + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> m THEN m END AS refers_to FROM d"""
