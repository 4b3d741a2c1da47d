"""Exact top-k search by tiled matrix products, partial selection per tile and tree merging (operator 1).

Every component x becomes floor(scale * x); the score is the inner product of these integers. Rows are packed into
blocks; a cell is one query block against one part of the shards, and its tiles are plain matrix products. Each tile
selects its k best by (score descending, id ascending), a cell keeps one list per query, and the lists of the cells
are merged in rounds of ``FAN_IN`` until one is left. No row is skipped and no group grows with the data: a cell holds
at most about ``query_block`` queries and ``part_rows`` candidates, and ``CELL_NUMBERS`` components of either.

Defined cases: a vector that is null, or has a null, NaN or infinite component, takes no part, nor does a row without
id. Of rows that share an id, the one with the smallest vector (arrays compared element by element) stands for all.
A query is compared with vectors of its own length only; empty vectors score 0 against each other. A query with
no candidate has no row. Scores beyond the range of long are clipped to it
before they are ranked.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textsift.llm.common import saved, shuffle_partitions

FAN_IN = 8
TILE_QUERIES, TILE_ROWS = 256, 4096
CELL_NUMBERS = 1 << 22


def _matrix(values: pd.Series) -> np.ndarray:
    """Integer-valued doubles, one row per vector."""
    return np.stack([np.asarray(v, dtype=np.float64) for v in values])


def _product(q: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Exact integer inner products as int64: BLAS in doubles while every partial sum is below 2**53."""
    most = float(max(1.0, np.abs(q).max(initial=0))), float(max(1.0, np.abs(s).max(initial=0)))
    if most[0] < 2.0**53 / most[1] / max(1, q.shape[1]):
        return (q @ s.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in q], dtype=object).reshape(q.shape)
    other = np.array([[int(x) for x in r] for r in s], dtype=object).reshape(s.shape)
    return np.clip(exact.dot(other.T), -(2**63), 2**63 - 1).astype(np.int64)


def select_best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k best columns by (score descending, id ascending); ``ids`` is ascending. Returns scores, ids.

    The k-th score is found by partial selection; above it all are taken, at it the first ones.
    """
    n = scores.shape[1]
    if n <= k:
        order = np.argsort(-scores.astype(object) if scores.min(initial=0) == -(2**63) else -scores, axis=1, kind="stable")
        return np.take_along_axis(scores, order, 1), ids[order]
    kth = np.partition(scores, n - k, axis=1)[:, n - k, None]
    above = scores > kth
    at = scores == kth
    take = above | (at & (np.cumsum(at, axis=1) <= k - above.sum(1, keepdims=True)))
    cols = np.nonzero(take)[1].reshape(-1, k)
    got = np.take_along_axis(scores, cols, 1)
    order = np.argsort(np.where(got == -(2**63), 2**63 - 1, -got), axis=1, kind="stable")
    cols = np.take_along_axis(cols, order, 1)
    return np.take_along_axis(scores, cols, 1), ids[cols]


def _cell(k: int):
    """One query block against one part of the shards: tiles, selection per tile, one list per query."""
    cols = ["query_id", "vec_id", "score"]

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if queries.empty or rows.empty:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ["cell", *cols]})
        rows = rows.sort_values("vec_id")
        q_all, s_all = _matrix(queries["v"]), _matrix(rows["v"])
        q_ids, s_ids = queries["vec_id"].to_numpy(np.int64), rows["vec_id"].to_numpy(np.int64)
        for a in range(0, len(q_ids), TILE_QUERIES):
            q, own = q_all[a:a + TILE_QUERIES], q_ids[a:a + TILE_QUERIES]
            best: tuple[np.ndarray, np.ndarray] | None = None
            for b in range(0, len(s_ids), TILE_ROWS):
                ids = s_ids[b:b + TILE_ROWS]
                # k + 1 so that the query's own row can be taken out afterwards
                got = select_best(_product(q, s_all[b:b + TILE_ROWS]), ids, k + 1)
                best = got if best is None else _merge(best, got, k + 1)
            scores, ids = best
            keep = ids != own[:, None]
            keep &= np.cumsum(keep, axis=1) <= k
            out.append(pd.DataFrame({"query_id": np.repeat(own, keep.sum(1)), "vec_id": ids[keep], "score": scores[keep]}))
        done = pd.concat(out)
        done.insert(0, "cell", int(rows["cell"].iloc[0]))
        return done
    return run


def _merge(x, y, k):
    """Two lists per row into one; the ids in ``x`` are all smaller, so a stable sort keeps ties in id order."""
    scores, ids = np.concatenate([x[0], y[0]], axis=1), np.concatenate([x[1], y[1]], axis=1)
    order = np.lexsort((ids, np.where(scores == -(2**63), 2**63 - 1, -scores)), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def top_k(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, scale: int = 64,
          query_every: int = 20, query_block: int = 16384, part_rows: int = 65536) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row whose id is divisible by ``query_every``."""
    spark = vectors.sparkSession
    x = F.col(vector_col)
    ok = F.col(id_col).isNotNull() & x.isNotNull() & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    rows = vectors.where(F.coalesce(ok, F.lit(False))).select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.transform(x, lambda e: e.cast("double") * scale).alias("v"))
    # the floor is taken on doubles: F.floor would cast to long
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    whole = lambda e: F.when(F.abs(e) < 2.0**52, F.floor(e).cast("double")).otherwise(e)  # noqa: E731  larger doubles are whole
    rows = saved(rows.select("vec_id", F.transform("v", whole).alias("v"), F.size("v").alias("dim")), "vectors")

    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("vec_id") % query_every == 0).cast("int")).alias("q"))
    n, q, dim = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("q"), F.lit(0)), F.coalesce(F.max("dim"), F.lit(1))).first()
    # a cell holds its block and its part in memory: fewer rows of long vectors
    part_rows, query_block = (max(1, min(m, CELL_NUMBERS // max(1, dim))) for m in (part_rows, query_block))
    parts = max(1, math.ceil(n / part_rows), min(math.ceil(n / 2048), 2 * shuffle_partitions(spark)))
    blocks = max(1, math.ceil(q / query_block))

    spread = lambda seed, m: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(m)).cast("int")
    # aliases: the two sides of a cogroup must not share attributes
    cell = [(F.col("block").cast("bigint") * parts + F.col("part")).alias("cell"), *[F.col(c).alias(c) for c in ("dim", "vec_id", "v")]]
    shards = rows.withColumn("part", spread(1, parts)).select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")).select(*cell)
    queries = rows.where(F.col("vec_id") % query_every == 0).withColumn("block", spread(2, blocks)).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")).select(*cell)
    # one task for a cell or a few: the cells are the unit of work
    lists = queries.groupBy("cell", "dim").cogroup(shards.groupBy("cell", "dim")).applyInPandas(
        _cell(k), "cell bigint, query_id bigint, vec_id bigint, score bigint")

    # merge the lists of FAN_IN cells at a time
    lists = lists.withColumn("cell", F.pmod(F.col("cell"), F.lit(parts)))
    order = [F.col("score").desc(), F.col("vec_id").asc()]
    while parts > 1:
        parts = math.ceil(parts / FAN_IN)
        lists = lists.withColumn("cell", F.floor(F.col("cell") / FAN_IN))
        best = F.row_number().over(Window.partitionBy("query_id", "cell").orderBy(*order))
        lists = lists.withColumn("rank", best).where(F.col("rank") <= k).drop("rank")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return lists.select("query_id", rank.alias("rank"), "vec_id", "score")
