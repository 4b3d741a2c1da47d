"""Distributed connected components (M5) by alternating large-star and small-star (Kiveris et al. 2014).

Edges are kept as (u, v) with v < u. A large-star hands every larger neighbour of a vertex to the smallest vertex it
knows, a small-star does the same with the smaller neighbours; both keep the components, and when nothing changes any
more every vertex points at its component's smallest one. The number of edges never grows beyond the input's.

A vertex may be a hub with a third of all vertices as neighbours. Its neighbours are dealt to parts by their hash: the
smallest neighbour of a part comes from a partial aggregation, the vertex's from its parts, and it is joined back by
(vertex, part), so no task ever holds a hub, whatever AQE does. The number of parts follows the number of edges.

Each step is written as a table in the shared folder: lineage is cut, a lost executor costs tasks, not rounds, and the
table before the last is deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsift.session import drop_path, scratch_path

#: Edges of a hub that one task should hold at most, and the fewest parts.
PART_EDGES = 100_000
LEAST_PARTS = 32


class NotConverged(RuntimeError):
    pass


def _with_min(edges: DataFrame, parts: int) -> DataFrame:
    """(u, v, m): ``m`` is the smallest ``v`` of ``u``; hubs are dealt to parts."""
    dealt = edges.withColumn("_part", F.pmod(F.xxhash64("v"), F.lit(parts)).cast("int"))
    some = dealt.groupBy("u", "_part").agg(F.min("v").alias("_m"))
    whole = some.groupBy("u").agg(F.min("_m").alias("m"))
    return dealt.join(some.join(whole, "u").select("u", "_part", "m"), ["u", "_part"]).select("u", "v", "m")


def _pairs(rows: DataFrame, pairs: Column) -> DataFrame:
    """Distinct (u, v) of an array of struct<u, v>, without loops."""
    return rows.select(F.explode(pairs).alias("e")).select("e.u", "e.v").where("u <> v").distinct()


def large_star(edges: DataFrame, parts: int = LEAST_PARTS) -> DataFrame:
    """Every larger neighbour of a vertex moves to the smallest of the vertex and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    rows = _with_min(both, parts).where(F.col("v") > F.col("u"))
    return rows.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def small_star(edges: DataFrame, parts: int = LEAST_PARTS) -> DataFrame:
    """Every vertex and its smaller neighbours move to the smallest of these."""
    return _pairs(_with_min(edges, parts), F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 40) -> DataFrame:
    """(id, component) for every vertex that appears in ``edges``; component = smallest id in the component.

    Null ends and loops are no edges; repeated and reversed edges count once."""
    spark = edges.sparkSession
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where((F.col("u") > F.col("v")) & F.col(src).isNotNull() & F.col(dst).isNotNull()).distinct()
    held: list[str] = []

    def table(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "edges")
        df.write.parquet(path)
        held.append(path)
        for old in held[:-2]:
            drop_path(spark, old)
            held.remove(old)
        return spark.read.schema(df.schema).parquet(path)

    def mark(df: DataFrame) -> tuple:
        """Number of edges and two sums of hashes: equal for equal sets."""
        big = lambda seed: F.sum(F.xxhash64(F.lit(seed), "u", "v").cast("decimal(38,0)"))
        return tuple(df.agg(F.count(F.lit(1)), big(1), big(2)).first())
    e = table(e)
    seen = mark(e)
    for _ in range(max_rounds):
        parts = max(LEAST_PARTS, seen[0] // PART_EDGES)
        e = table(small_star(table(large_star(e, parts)), parts))
        now = mark(e)
        if now == seen:
            roots = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
            return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
        seen = now
    raise NotConverged(f"connected components did not converge in {max_rounds} rounds")
