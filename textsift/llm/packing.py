"""Packing with optimal length buckets (operator 8).

A document longer than ``max_tokens`` is cut into pieces of that length and a rest, so lengths lie in 1..max_tokens
and the global histogram has at most ``max_tokens`` rows. Dynamic programming over it chooses the ``buckets`` upper
lengths with the least padding when every sequence is padded to the upper length of its bucket. Inside a bucket,
batches of as many sequences as the token budget holds are formed in a seeded order.

Scale: one narrow pass counts tokens; the histogram is aggregated map-side, and its bounded rows are all the driver
sees. Positions in a bucket are running counts over 4096 ranges of the order, then within one range, so a bucket that
holds most sequences is 4096 groups.

Defined cases: a null or empty text has no tokens and no row. Equal paddings: the smaller boundaries. Pieces with
equal order keys (rows that share an id, or have none) follow each other by length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textsift.llm.common import n_words, saved

RANGE_DIGITS = 3


def best_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets that minimise the padding of a histogram (lengths ascending).

    cost[j] after k rounds: least padding of the first j lengths in k buckets. A bucket of lengths a+1..j costs
    lengths[j] * (sequences in it) - (their tokens), from prefix sums.
    """
    m = len(lengths)
    if not m:
        return []
    size = np.concatenate([[0], np.cumsum(np.array(counts, dtype=object))])
    tokens = np.concatenate([[0], np.cumsum(np.array([n * c for n, c in zip(lengths, counts, strict=True)], dtype=object))])
    if tokens[-1] * 2 < 2**62 // max(1, m):
        size, tokens = size.astype(np.int64), tokens.astype(np.int64)
    upper = np.array([0, *lengths], dtype=size.dtype)
    cost, last = upper * size - tokens, []  # one bucket for the first j lengths
    for _ in range(1, min(buckets, m)):
        new, cut = cost.copy(), np.zeros(m + 1, np.int64)
        for j in range(1, m + 1):
            via = cost[:j] + upper[j] * (size[j] - size[:j]) - (tokens[j] - tokens[:j])
            cut[j] = int(np.argmin(via))  # the first of equal ones
            new[j] = via[cut[j]]
        last.append(cut)
        cost = new
    out, j = [], m
    for cut in reversed(last):
        if not j:
            break
        out.append(int(upper[j]))
        j = int(cut[j])
    if j:
        out.append(int(upper[j]))
    return out[::-1]


def sequences(docs: DataFrame, id_col: str, text_col: str, max_tokens: int) -> DataFrame:
    """(doc_id, piece, start, n_tokens): pieces of at most ``max_tokens`` tokens."""
    n = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), n_words(F.col(text_col)).alias("n")).where(F.col("n") > 0)
    rows = n.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {max_tokens}"))).alias("piece"))
    start = F.col("piece") * max_tokens
    return rows.select("doc_id", "piece", start.alias("start"), F.least(F.lit(max_tokens).cast("bigint"), F.col("n") - start).alias("n_tokens"))


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 2048, buckets: int = 8,
         batch_tokens: int = 65536, seed: int = 11) -> DataFrame:
    """(doc_id, piece, start, n_tokens, bucket, bucket_length, batch, slot), a row for each sequence."""
    rows = saved(sequences(docs, id_col, text_col, max_tokens), "sequences")
    histogram = rows.groupBy("n_tokens").count().orderBy("n_tokens").collect()  # at most max_tokens rows
    upper = best_boundaries([r[0] for r in histogram], [r[1] for r in histogram], buckets) or [max_tokens]
    at = F.lit(len(upper))
    for k in range(len(upper) - 1, 0, -1):
        at = F.when(F.col("n_tokens") <= upper[k - 1], k).otherwise(at)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    rows = rows.select("*", at.cast("int").alias("bucket"), F.md5(F.concat_ws(":", F.lit(str(seed)), name("doc_id"), name("piece"))).alias("key"))
    rows = rows.select("*", F.element_at(F.array(*[F.lit(u).cast("bigint") for u in upper]), F.col("bucket")).alias("bucket_length"), F.substring("key", 1, RANGE_DIGITS).alias("range"))
    ranges = rows.groupBy("bucket", "range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("bucket").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select("bucket", "range", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("bucket", "range").orderBy("key", "n_tokens", "doc_id")) - 1
    rows = rows.join(ranges, ["bucket", "range"]).select("*", (F.col("before") + inside).alias("pos"))
    room = F.greatest(F.lit(1).cast("bigint"), F.expr(f"{batch_tokens} div bucket_length"))
    rows = rows.select("*", room.alias("room"))
    return rows.select("doc_id", "piece", "start", "n_tokens", "bucket", "bucket_length", F.expr("pos div room").alias("batch"), (F.col("pos") % F.col("room")).alias("slot"))


def oracle(max_tokens: int, buckets: int, batch_tokens: int, seed: int) -> str:
    """DuckDB form: the dynamic programme as one common table expression for each number of buckets."""
    ctes = [f"""n AS (SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS BIGINT) AS n FROM documents),
p AS (SELECT doc_id, n, unnest(range(0, (n + {max_tokens - 1}) // {max_tokens})) AS piece FROM n WHERE n > 0),
s AS (SELECT doc_id, piece, piece * {max_tokens} AS start, least({max_tokens}, n - piece * {max_tokens}) AS n_tokens FROM p),
h AS (SELECT row_number() OVER o AS j, n_tokens AS u, sum(count(*)) OVER o AS c, sum(count(*) * n_tokens) OVER o AS t FROM s GROUP BY n_tokens WINDOW o AS (ORDER BY n_tokens)),
z AS MATERIALIZED (SELECT * FROM h UNION ALL SELECT 0, 0, 0, 0),
d1 AS MATERIALIZED (SELECT j, u * c - t AS cost, 0 AS cut FROM z)"""]
    for k in range(2, buckets + 1):
        ctes.append(f"""d{k} AS MATERIALIZED (SELECT j.j, min(d.cost + j.u * (j.c - a.c) - (j.t - a.t)) AS cost, arg_min(a.j, (d.cost + j.u * (j.c - a.c) - (j.t - a.t), a.j)) AS cut
  FROM z j JOIN z a ON a.j < j.j JOIN d{k - 1} d ON d.j = a.j GROUP BY j.j UNION ALL SELECT 0, 0, 0)""")
    # with fewer lengths than buckets the programme has a round for each length
    ctes.append(f"e{buckets} AS (SELECT max(j) AS j, least({buckets}, max(j)) AS k FROM z)")
    for k in range(buckets, 1, -1):
        ctes.append(f"e{k - 1} AS (SELECT CASE WHEN e.k >= {k} THEN d.cut ELSE e.j END AS j, e.k FROM e{k} e JOIN d{k} d ON d.j = e.j)")
    ctes.append("ends AS (" + " UNION ".join(f"SELECT j FROM e{k}" for k in range(1, buckets + 1)) + ")")
    ctes.append("b AS (SELECT row_number() OVER (ORDER BY u) AS bucket, u AS bucket_length, coalesce(lag(u) OVER (ORDER BY u), 0) AS low FROM ends JOIN z USING (j) WHERE j > 0)")
    ctes.append(f"""q AS (SELECT s.*, b.bucket, b.bucket_length, greatest(1, {batch_tokens} // b.bucket_length) AS room, row_number() OVER (PARTITION BY b.bucket ORDER BY
  md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'none') || ':' || piece), n_tokens, doc_id) - 1 AS pos FROM s JOIN b ON n_tokens > low AND n_tokens <= bucket_length)""")
    return "WITH " + ",\n".join(ctes) + """
SELECT doc_id, CAST(piece AS BIGINT) AS piece, CAST(start AS BIGINT) AS start, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(bucket AS INTEGER) AS bucket,
  CAST(bucket_length AS BIGINT) AS bucket_length, CAST(pos // room AS BIGINT) AS batch, CAST(pos % room AS BIGINT) AS slot FROM q"""
