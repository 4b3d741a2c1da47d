"""Archive reader (S6/S7): gzip web-archive files (WARC or ARC) -> one row per HTML response record.

The file listing is a DataFrame (``binaryFile`` with the content column pruned, so nothing is loaded by Spark), and
``mapInPandas`` streams byte ranges of the files from their filesystem (pyarrow: local, HDFS, S3 including ``s3a://``)
through the stdlib gzip decoder, record by record; memory holds one record at a time. A range that fails yields an
``error`` row and the task goes on (S7).

A gzip stream can't be split, but archives are one gzip member a record. A file of more than ``split_bytes`` is cut
into ranges of that size, and a first job looks up in each where its first record starts: the first member that
inflates to its end with the right checksum and begins with a record header. A page may hold such bytes itself (an
archive in a member that stores them uncompressed); they lie inside a member that began before, so a start below the end of an
earlier range's members is no cut. What remains cuts the file into runs that are read by tasks of their own. A file of
one member, or with records across members only, stays one run.
"""

from __future__ import annotations

import gzip
import io
import re
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty
from pyspark.sql.window import Window

ARCHIVE_SCHEMA = Ty.StructType([
    Ty.StructField("file_path", Ty.StringType()),
    Ty.StructField("url", Ty.StringType()),
    Ty.StructField("timestamp", Ty.StringType()),
    Ty.StructField("mime", Ty.StringType()),
    Ty.StructField("html", Ty.StringType()),
    Ty.StructField("error", Ty.StringType()),
])


SPLIT_BYTES = 64 << 20
MAGIC = b"\x1f\x8b\x08"  # Fixed value: how a gzip member of deflate data begins.
ARC_HEADER = re.compile(rb"(filedesc|[a-z][a-z0-9+.-]*):[^ \n]* [^ \n]+ [0-9]{14} [^ \n]+ [0-9]+\r?\n")


def filesystem_of(path: str):
    """(file system, path in it) of a Hadoop path, for tasks."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    for hadoop, arrow in (("s3a://", "s3://"), ("s3n://", "s3://")):  # Hadoop's names of the scheme
        if path.startswith(hadoop):
            path = arrow + path[len(hadoop):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _open(path: str):
    """The file, opened for reading at any position; gzip is decoded below, member by member."""
    filesystem, p = filesystem_of(path)
    return filesystem.open_input_file(p)


class _Range(io.RawIOBase):
    """Bytes ``start`` to ``end`` of an open file, as a file."""

    def __init__(self, file, start: int, end: int):
        super().__init__()
        self.file, self.left = file, end - start
        file.seek(start)

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.file.read(min(len(buffer), self.left))
        buffer[:len(data)] = data
        self.left -= len(data)
        return len(data)


def _member(file, at: int) -> tuple[int, bytes] | None:
    """(end, first decoded bytes) of the gzip member at ``at``; None if there is no whole one with the right checksum."""
    file.seek(at)
    inflate, head = zlib.decompressobj(31), b""
    while not inflate.eof:
        piece = file.read(1 << 14)
        if not piece:
            return None
        try:
            out = inflate.decompress(piece)
        except zlib.error:
            return None
        if len(head) < 1 << 16:
            head += out[:1 << 16]
        at += len(piece)
    return at - len(inflate.unused_data), head


def _next_magic(file, at: int, stop: int) -> int | None:
    """The first position from ``at``, before ``stop``, where a gzip member may start."""
    file.seek(at)
    tail = b""
    while at < stop:
        piece = file.read(1 << 16)
        found = (tail + piece).find(MAGIC)
        if found >= 0:
            found += at - len(tail)
            return found if found < stop else None
        if not piece:
            return None
        at += len(piece)
        tail = (tail + piece)[-2:]
    return None


def _first_record(path: str, start: int, stop: int) -> tuple[int | None, int | None]:
    """Of the gzip members that start in ``start``..``stop``: where the first with a record header starts, where the last ends."""
    first = reach = None
    with _open(path) as raw:
        file = io.BufferedReader(raw, 1 << 20)
        at = _next_magic(file, start, stop)
        while at is not None:
            found = _member(file, at)
            if found is None:
                at = _next_magic(file, at + 1, stop)
                continue
            end, head = found
            if first is None and (head.startswith(b"WARC/") or ARC_HEADER.match(head)):
                first = at
            reach = max(reach or 0, end)
            at = _next_magic(file, end, stop)
    return first, reach


def _http_body(block: bytes) -> tuple[str | None, bytes, str | None]:
    """Split an HTTP response into (content type, body, charset); transfer and content encodings are undone."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        head, _, body = block.partition(b"\n\n")
    fields = {}
    for line in head.split(b"\n")[1:]:
        k, _, v = line.partition(b":")
        fields[k.strip().lower()] = v.strip().decode("latin-1")
    kind, _, rest = fields.get(b"content-type", "").partition(";")
    charset = re.search(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", rest)
    if "chunked" in fields.get(b"transfer-encoding", "").lower():
        body = _unchunk(body)
    coding = fields.get(b"content-encoding", "").lower()
    try:
        if coding in ("gzip", "x-gzip"):
            body = gzip.decompress(body)
        elif coding == "deflate":
            body = zlib.decompress(body)
    except (OSError, EOFError, zlib.error):
        pass  # some archives store the body decoded but keep the header
    return kind.strip().lower() or None, body, charset[1] if charset else None


def _unchunk(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9a-fA-F]+", size):
            return body if not out else b"".join(out)  # not chunked after all, or cut short
        n = int(size, 16)
        if n == 0:
            return b"".join(out)
        out.append(body[end + 2:end + 2 + n])
        at = end + 2 + n + 2


def _decode(body: bytes, charset: str | None = None) -> str:
    """The declared charset if it fits, else UTF-8, else Latin-1."""
    for name in (charset, "utf-8"):
        try:
            if name:
                return body.decode(name)
        except (UnicodeDecodeError, LookupError):
            pass
    return body.decode("latin-1")


def iter_warc(stream):
    """Yield (url, timestamp, mime, html) for WARC response records."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue
        headers = {}
        while True:
            h = stream.readline()
            if h in (b"\r\n", b"\n", b""):
                break
            k, _, v = h.decode("utf-8", "replace").partition(":")
            headers[k.strip().lower()] = v.strip()
        block = stream.read(int(headers.get("content-length", "0")))
        if headers.get("warc-type") == "response":
            mime, body, charset = _http_body(block)
            ts = headers.get("warc-date", "").replace("-", "").replace(":", "").replace("T", "").rstrip("Z")
            yield headers.get("warc-target-uri"), ts, mime, _decode(body, charset)


def iter_arc(stream):
    """Yield (url, timestamp, mime, html) for ARC v1 records (``url ip date mime length`` header lines)."""
    while True:
        line = stream.readline()
        if not line:
            return
        parts = line.strip().split(b" ")
        if len(parts) < 5 or not parts[-1].isdigit():
            continue
        block = stream.read(int(parts[-1]))
        url = parts[0].decode("utf-8", "replace")
        if url.startswith("filedesc:"):
            continue
        mime, body, charset = _http_body(block)
        yield url, parts[2].decode(), mime or parts[3].decode().lower(), _decode(body, charset)


def _records(path: str, start: int, end: int):
    with _open(path) as raw, gzip.GzipFile(fileobj=io.BufferedReader(_Range(raw, start, end), 1 << 20)) as gz:
        stream = io.BufferedReader(gz)
        first = stream.peek(5)[:5]
        it = iter_warc(stream) if first.startswith(b"WARC") else iter_arc(stream)
        yield from it


def archive_runs(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, start, end) of byte ranges that begin with a record and together are the whole ``files`` (path, length).

    A file of at most ``split_bytes`` is one run and isn't looked into. The windows have a row for each ``split_bytes`` of a file.
    """
    cores = max(1, files.sparkSession.sparkContext.defaultParallelism)
    whole = files.where(F.col("length") <= split_bytes).select("path", F.lit(0).cast("bigint").alias("start"), F.col("length").alias("end"))
    large = files.where(F.col("length") > split_bytes)
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(split_bytes).cast("bigint"))
    ranges = large.select("path", "length", F.explode(starts).alias("at")).repartition(cores, "path", "at")

    def look(batches):
        for pdf in batches:
            found = []
            for path, length, at in zip(pdf["path"], pdf["length"], pdf["at"], strict=True):
                try:
                    found.append(_first_record(path, int(at), min(int(at) + split_bytes, int(length))))
                except Exception:  # noqa: BLE001 - S7: the run that reads these bytes reports them
                    found.append((None, None))
            for k, name in enumerate(("first", "reach")):
                pdf[name] = pd.array([f[k] for f in found], dtype="Int64")
            yield pdf

    found = ranges.mapInPandas(look, "path string, length bigint, at bigint, first bigint, reach bigint")
    order = Window.partitionBy("path").orderBy("at")
    before = F.coalesce(F.max("reach").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = found.select("path", "length", "at", "first", before.alias("before"))
    start = F.when(F.col("at") == 0, F.lit(0).cast("bigint")).when(F.col("first") >= F.col("before"), F.col("first"))
    cuts = cuts.select("path", "length", start.alias("start")).where(F.col("start").isNotNull())
    end = F.coalesce(F.lead("start").over(Window.partitionBy("path").orderBy("start")), F.col("length"))
    return whole.unionByName(cuts.select("path", "start", end.alias("end")))


def read_archive(spark: SparkSession, path: str, glob: str = "*/*.arc.gz", html_only: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of the archives that match ``glob`` below ``path`` (each part of the glob is one level).

    Files of more than ``split_bytes`` are inflated twice: once for the cuts, once for the records. After damaged bytes a
    run gives an ``error`` row and ends; the file's other runs are read.
    """
    files = spark.read.format("binaryFile").load(f"{path.rstrip('/')}/{glob}").select("path", "length")
    runs = archive_runs(files, split_bytes).repartition(max(1, spark.sparkContext.defaultParallelism))

    def run(batches):
        for pdf in batches:
            for p, start, end in zip(pdf["path"], pdf["start"], pdf["end"], strict=True):
                rows = []
                try:
                    for url, ts, mime, html in _records(p, int(start), int(end)):
                        if not html_only or (mime or "").startswith("text/html"):
                            rows.append((p, url, ts, mime, html, None))
                        if len(rows) >= 256:  # bounded memory: emit in small Arrow batches
                            yield pd.DataFrame(rows, columns=ARCHIVE_SCHEMA.fieldNames())
                            rows = []
                except Exception as e:  # noqa: BLE001 - S7: bad bytes are reported, the task goes on
                    rows.append((p, None, None, None, None, f"{type(e).__name__}: {e}"))
                if rows:
                    yield pd.DataFrame(rows, columns=ARCHIVE_SCHEMA.fieldNames())

    return runs.mapInPandas(run, ARCHIVE_SCHEMA)


def require_some_success(rows: DataFrame) -> DataFrame:
    """``rows`` of ``read_archive``, unless every file failed: then an error that names the first one."""
    seen = rows.agg(F.count("url").alias("good"), F.min("error").alias("error")).first()
    if seen["error"] is not None and not seen["good"]:
        raise RuntimeError(f"no archive could be read; the first error: {seen['error']}")
    return rows
