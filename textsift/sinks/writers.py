"""Sinks (K1-K5): documents, removed-by-step, removed-by-language, quality tiers and statistics.

All sinks are partitioned DataFrame writes (one task per output partition, no driver involvement). Documents are
nested back to the reference's record shape ``{text, title, metadata: {...}}`` only here, at the edge.
"""

from __future__ import annotations

import gzip
import uuid

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsift.sources.archive import filesystem_of


def as_records(df: DataFrame, *, text_col: str = "text", title_col: str | None = "title",
               partition_cols: tuple[str, ...] = ()) -> DataFrame:
    """Nest every non-text column under ``metadata`` (partition columns stay top level for ``partitionBy``)."""
    meta = [c for c in df.columns if c not in (text_col, title_col, *partition_cols)]
    cols = [F.col(text_col).alias("text")]
    if title_col and title_col in df.columns:
        cols.append(F.col(title_col).alias("title"))
    if meta:
        cols.append(F.struct(*[F.col(c) for c in meta]).alias("metadata"))
    return df.select(*cols, *partition_cols)


def write_documents(df: DataFrame, path: str, *, fmt: str = "json", mode: str = "overwrite",
                    partition_cols: tuple[str, ...] = (), **kw) -> None:
    """K1: gz JSONL (``fmt='json'``) or parquet.

    Partitioned writes are rebalanced by the folder first, so a folder gets few files however many tasks wrote to it, and a
    folder that is larger than others is split by its size."""
    out = as_records(df, partition_cols=partition_cols, **kw)
    if partition_cols:
        out = out.hint("rebalance", *partition_cols)
    w = out.write.mode(mode)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if fmt == "json":
        w.option("compression", "gzip").json(path)
    else:
        w.format(fmt).save(path)


def write_removed(labelled: DataFrame, path: str, **kw) -> None:
    """K2: removed documents, one folder per waterfall step (``filter_step=...``), reason kept per record."""
    removed = labelled.where(F.col("filter_step").isNotNull())
    write_documents(removed, path, partition_cols=("filter_step",), **kw)


def write_removed_by_language(removed: DataFrame, path: str, **kw) -> None:
    """K3: language-filter rejects, one folder per detected language."""
    write_documents(removed.withColumn("language", F.coalesce("language", F.lit("unknown"))), path,
                    partition_cols=("language",), **kw)


def write_tiers(scored: DataFrame, path: str, **kw) -> None:
    """K4: documents routed to ``quality_label=low|medium|high`` folders, one sub-folder per collection."""
    write_documents(scored, path, partition_cols=("quality_label", "collection"), **kw)


def write_stats(stats: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5: a tidy statistics table as JSON lines (the collection is a column, not part of the file name)."""
    stats.write.mode(mode).json(path)


def write_archives(pages: DataFrame, path: str, *, url_col: str = "url", time_col: str = "timestamp", html_col: str = "html") -> None:
    """Pages as WARC files of one gzip member a record, a file for each partition; ``time_col``: 14 digits.

    A file gets its name when it is whole, so a task that runs twice leaves one. Rows without page are empty pages.
    """
    def write(batches):
        filesystem, folder = filesystem_of(path)
        filesystem.create_dir(folder, recursive=True)
        part, out = f"{folder}/.{uuid.uuid4().hex}", None
        for pdf in batches:
            out = out or filesystem.open_output_stream(part, compression=None)
            for url, time, html in zip(pdf["url"], pdf["time"], pdf["html"], strict=True):
                block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (html or "").encode()
                date = f"{time[:4]}-{time[4:6]}-{time[6:8]}T{time[8:10]}:{time[10:12]}:{time[12:14]}Z" if time else ""
                head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {url or ''}\r\nWARC-Date: {date}\r\nContent-Length: {len(block)}\r\n\r\n"
                out.write(gzip.compress(head.encode() + block + b"\r\n\r\n", 6))
            yield pdf[["url"]].iloc[:0]
        if out:
            out.close()
            filesystem.move(part, f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz")

    rows = pages.select(F.col(url_col).alias("url"), F.col(time_col).alias("time"), F.col(html_col).alias("html"))
    rows.mapInPandas(write, "url string").write.format("noop").mode("overwrite").save()
