"""Near-duplicate removal (M6-M11): clusters, survivors, cluster sizes and upsampling weights.

``minhash_clusters`` runs signatures -> band buckets -> star edges -> connected components and returns, for every
document, its cluster id (smallest id in its component; its own id when it has no near-duplicate) and the cluster
size. ``scope`` columns (collection, tier) partition every step, so all collections or all tiers are deduplicated
in one plan without matching across scopes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsift.functions import bloom
from textsift.operators import minhash as M
from textsift.operators.components import connected_components
from textsift.session import saved

#: Members of clusters that are broadcast (24 bytes each, some 40 MB as a hash table).
BROADCAST_MEMBERS = 500_000

# Cluster-size thresholds and the weight from each threshold on (size >= threshold).
UPSAMPLING_STEPS = [(1, 1), (2, 2), (3, 3), (5, 5), (100, 8), (1000, 1)]


def upsampling_weight(size: Column) -> Column:
    """M8: step function of the cluster size; sizes below the first threshold get weight 1."""
    w = F.lit(1)
    for lo, weight in UPSAMPLING_STEPS:
        w = F.when(size >= lo, F.lit(weight)).otherwise(w)
    return w.cast("int")


def cluster_members(df: DataFrame, cfg: M.MinhashConfig = M.PER_COLLECTION, *, id_col: str = "doc_id",
                    text_col: str = "text", scope: tuple[str, ...] = (), max_rounds: int = 40) -> DataFrame:
    """(id, component, size) for the documents that have at least one near-duplicate (only they have edges)."""
    sigs = M.signatures(df, cfg, id_col=id_col, text_col=text_col, keep=scope)
    edges = M.bucket_edges(M.band_keys(sigs, cfg, scope), scope)
    comp = connected_components(edges.select(F.col("id").alias("src"), F.col("dup_of").alias("dst")),
                                max_rounds=max_rounds)
    # a table of its own, so that the join exchanges both sides and AQE can split the members of a giant cluster
    sizes = comp.groupBy("component").agg(F.count(F.lit(1)).alias("size")).checkpoint()
    return saved(comp.join(sizes, "component"), "members")


def _attach(df: DataFrame, members: DataFrame, id_col: str, broadcast_members: int = BROADCAST_MEMBERS) -> DataFrame:
    """Left join on the id: documents without near-duplicates are their own cluster of size 1.

    Up to ``broadcast_members`` members are broadcast and no text is shuffled. Beyond it a Bloom filter of their ids, of
    bounded size, is: documents that it doesn't know pass as they are, and only possible members are shuffled to the
    exact join."""
    n = members.count()
    members = members.withColumnRenamed("id", "_m_id")
    known = F.col(id_col) == F.col("_m_id")
    if n <= broadcast_members:
        full = df.join(F.broadcast(members), known, "left")
    else:
        words = bloom.words_for(n)
        probed = bloom.may_hold(df, F.col(id_col), bloom.build(members, F.col("_m_id"), words), words, "_maybe")
        none = probed.where(~F.col("_maybe")).drop("_maybe").select("*", *[F.lit(None).cast(t).alias(c) for c, t in members.dtypes])
        full = none.unionByName(probed.where("_maybe").drop("_maybe").hint("shuffle_merge").join(members, known, "left"))
    return (full.drop("_m_id").withColumn("minhash_cluster_id", F.coalesce("component", id_col))
            .withColumn("minhash_cluster_size", F.coalesce("size", F.lit(1)).cast("bigint"))
            .drop("component", "size"))


def minhash_clusters(df: DataFrame, cfg: M.MinhashConfig = M.PER_COLLECTION, *, id_col: str = "doc_id",
                     text_col: str = "text", scope: tuple[str, ...] = (), max_rounds: int = 40) -> DataFrame:
    """(scope..., id_col, minhash_cluster_id, minhash_cluster_size) for every input row. Ids must be unique."""
    members = cluster_members(df, cfg, id_col=id_col, text_col=text_col, scope=scope, max_rounds=max_rounds)
    return _attach(df.select(*scope, F.col(id_col)), members, id_col).select(
        *scope, id_col, "minhash_cluster_id", "minhash_cluster_size")


def dedup(df: DataFrame, cfg: M.MinhashConfig = M.PER_COLLECTION, *, id_col: str = "doc_id", text_col: str = "text",
          scope: tuple[str, ...] = (), materialise_weight: bool = False, broadcast_members: int = BROADCAST_MEMBERS) -> tuple[DataFrame, DataFrame]:
    """M7: (kept, removed). The survivor of a cluster is its smallest id; kept rows carry the cluster size and
    ``upsampling_weight``; with ``materialise_weight`` (M9) each kept row is repeated ``weight`` times."""
    members = cluster_members(df, cfg, id_col=id_col, text_col=text_col, scope=scope)
    full = _attach(df, members, id_col, broadcast_members)
    kept = (full.where(F.col("minhash_cluster_id") == F.col(id_col))
            .withColumn("upsampling_weight", upsampling_weight(F.col("minhash_cluster_size"))))
    removed = full.where(F.col("minhash_cluster_id") != F.col(id_col))
    if materialise_weight:
        kept = kept.withColumn("_rep", F.explode(F.sequence(F.lit(1), F.col("upsampling_weight")))).drop("_rep")
    return kept, removed
