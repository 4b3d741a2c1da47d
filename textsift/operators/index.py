"""Crawl-index operators: de-duplication, fetch lists, batch numbering, fetch-log statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textsift.functions import urls as U
from textsift.session import checkpoint_dir

# Fetch batch size = min(1000, 3960 // 4) (API ceiling 4,000/min used at 99 %).
FETCH_BATCH = min(1000, 3960 // 4)


def select_index(rows: DataFrame, tok: str = "pt") -> DataFrame:
    """F1 + F2 + F5: HTML pages with status 200 under the country token, one row per (surt, timestamp)."""
    ok = rows.where(U.http_ok(F.col("status"), F.col("mime")) & U.country_url(F.col("url"), F.col("surt"), tok))
    return dedup_index(ok)


def dedup_index(rows: DataFrame, keys: tuple[str, ...] = ("surt", "timestamp")) -> DataFrame:
    """one row per key over the whole index (the reference forgot keys every 200 rows; this is global).
    The survivor is the smallest remaining row, so the result does not depend on input order."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.dropDuplicates(list(keys))
    return (rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def fetch_list(rows: DataFrame, prefix: str = "https://replay.example/wayback/",
               batch: int = FETCH_BATCH, partitions: int | None = None) -> DataFrame:
    """F9 + F10 + F11: (surt, timestamp, url, replay_url, batch) with consecutive batches of ``batch`` rows in
    (surt, timestamp, url) order.

    The global row number is computed without a single-partition window: rows are dealt to ranges and sorted, and
    numbered by partition and position in one pass, which is checkpointed, so that the sampled range boundaries are
    the same for all that follows. Each partition's size (one row a partition) becomes an offset that is broadcast
    back. The number of ranges follows the data's size (AQE) unless ``partitions`` is given.
    """
    checkpoint_dir(rows.sparkSession)
    order = ["surt", "timestamp", "url"]
    picked = rows.select(*order)
    ranged = picked.repartitionByRange(partitions, *order) if partitions else picked.repartitionByRange(*order)
    # monotonically_increasing_id: partition number in the upper 31 bits, position below
    ranged = ranged.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    ranged = ranged.select(*order, F.shiftright("_at", 33).alias("_pid"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_pos"))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    offsets = counts.select("_pid", F.coalesce(F.sum("_c").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    idx = ranged.join(F.broadcast(offsets), "_pid").select(*order, (F.col("_off") + F.col("_pos")).alias("_i"))
    return idx.select(*order, U.replay_url(F.col("timestamp"), F.col("url"), prefix).alias("replay_url"),
                      F.floor(F.col("_i") / F.lit(batch)).cast("bigint").alias("batch"))


def fetch_log_from_events(events: DataFrame) -> DataFrame:
    """A fetch log stand-in from the ``events`` table: status = event_type, bytes = value, ts = ts."""
    return events.select(F.col("event_id").alias("fetch_id"), F.col("event_type").alias("status"),
                         F.col("value").alias("bytes"), "ts")


def fetch_ok(log: DataFrame, ok_status: str = "view") -> DataFrame:
    """only fetches with the OK status and a non-empty body yield a page."""
    return log.where((F.col("status") == ok_status) & (F.col("bytes") > 0))


def fetch_stats(log: DataFrame) -> DataFrame:
    """per status: count, bits (8 * bytes) and bits per second over the whole log's time span; plus a
    ``total`` row. Every fetch is counted once (the reference counted empty bodies twice).

    One rollup over the log; the span comes from the ``total`` row and is spread over the handful of result rows
    with an unpartitioned window (the input to that window is one row per status).
    """
    g = (log.rollup("status").agg(F.count(F.lit(1)).cast("bigint").alias("n"), (F.sum("bytes") * 8).alias("bits"),
                                  F.min("ts").alias("_t0"), F.max("ts").alias("_t1"), F.grouping_id().alias("_g")))
    us = F.unix_micros(F.col("_t1").cast("timestamp")) - F.unix_micros(F.col("_t0").cast("timestamp"))
    span = F.max(F.when(F.col("_g") == 1, us)).over(Window.partitionBy())
    out = g.withColumn("_us", span)
    return out.select(F.when(F.col("_g") == 1, F.lit("total")).otherwise(F.col("status")).alias("status"), "n",
                      F.round("bits", 6).alias("bits"),
                      F.round(F.when(F.col("_us") > 0, F.col("bits") / (F.col("_us") / 1e6)), 6).alias("bits_per_s"))
