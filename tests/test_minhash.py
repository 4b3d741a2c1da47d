"""MinHash, components and dedup."""
import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textsift.functions import bloom
from textsift.operators import components as CC
from textsift.operators import dedup as D
from textsift.operators import minhash as M
from textsift.sources.readers import spread


def test_upsampling_weights(spark):
    sizes = [0, 1, 2, 3, 4, 5, 99, 100, 999, 1000]
    df = spark.createDataFrame([(s,) for s in sizes], "s long")
    got = [r[0] for r in df.select(D.upsampling_weight(F.col("s"))).collect()]
    assert got == [1, 1, 2, 3, 3, 5, 5, 8, 8, 1]


def test_components_chain_and_pairs(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (10, 11), (20, 21)], "src long, dst long")
    got = {r["id"]: r["component"] for r in CC.connected_components(e).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 10: 10, 11: 10, 20: 20, 21: 20}


def test_long_chain_converges(spark):
    """10,000 vertices in a row, their ids in and out of order."""
    for place in (lambda i: i, lambda i: i * 7919 % 10_000):
        e = spark.createDataFrame([(place(i), place(i + 1)) for i in range(9_999)], "src long, dst long")
        got = CC.connected_components(e).agg(F.count("*"), F.countDistinct("component"), F.max("component")).first()
        assert tuple(got) == (10_000, 1, 0)


def test_star_of_three_million_is_in_no_task(spark):
    n = 3_000_000
    e = spark.range(1, n).select(F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(0).alias("src"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("dst"))
    assert tuple(CC.connected_components(e).agg(F.count("*"), F.max("component")).first()) == (n, 0)
    # rows of the hub by task, before any skew handling
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        both = spark.range(1, 400_000).select(F.lit(0).cast("bigint").alias("u"), F.col("id").alias("v"))
        per = CC._with_min(both, 64).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    counts = sorted(r["count"] for r in per)
    assert sum(counts) == 399_999 and counts[-1] < 3 * counts[len(counts) // 2]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 25)), st.integers(-5, 25)), max_size=25))
def test_components_equal_union_find(spark, pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in pairs:
        if a is not None and a != b:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    e = spark.createDataFrame(pairs, "src long, dst long")
    assert {r["id"]: r["component"] for r in CC.connected_components(e).collect()} == {x: root(x) for x in parent}


def test_identical_texts_share_cluster_and_dedup_idempotent(spark):
    text = "the quick brown fox jumps over the lazy dog again and again " * 3
    rows = [(1, text), (2, "something entirely different with many other words in it ok"), (3, text), (4, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cl = {r["doc_id"]: (r["minhash_cluster_id"], r["minhash_cluster_size"]) for r in D.minhash_clusters(df).collect()}
    assert cl[1] == cl[3] == cl[4] == (1, 3) and cl[2] == (2, 1)
    kept, removed = D.dedup(df)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
    kept2, _ = D.dedup(kept.select("doc_id", "text"))
    assert kept2.count() == 2


def test_short_documents_do_not_all_collide(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, "a b")], "doc_id long, text string")
    got = {r["doc_id"]: r["minhash_cluster_id"] for r in D.minhash_clusters(df).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_signature_matches_python(spark):
    """Minima over all shingles, hash by hash, in whole numbers."""
    words = "alpha beta gamma delta epsilon zeta eta".split()
    df = spark.createDataFrame([(1, " ".join(words).title())], "doc_id long, text string")
    eight = lambda s: int.from_bytes(hashlib.md5(s.encode()).digest()[:8], "big")
    sig = M.signatures(df, M.MinhashConfig(2, 3, 5)).collect()[0]["sig"]
    a, b = M.hash_params(6)
    assert sig == [min((int(x) * M.md5_31(s) + int(y)) % M.P31 for s in M.shingles(words, 5)) for x, y in zip(a, b)]
    sig = M.signatures(df, M.MinhashConfig(2, 3, 5, "xx64")).collect()[0]["sig"]
    h = [r[0] % 2**64 for r in spark.createDataFrame([(s,) for s in M.shingles(words, 5)], "s string").select(F.xxhash64("s")).collect()]
    assert [x % 2**64 for x in sig] == [min(((eight(f"a{i}") | 1) * x + eight(f"b{i}")) % 2**64 for x in h) for i in range(1, 7)]
    assert abs(M.PER_COLLECTION.threshold - 0.719) < 0.01 and abs(M.PER_TIER.threshold - 0.782) < 0.01


def test_signatures_are_computed_once(spark):
    df = spread(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    for cfg in (M.PER_COLLECTION, M.PER_COLLECTION_64):
        plan = M.band_keys(M.signatures(df, cfg), cfg)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and plan.index("ArrowEvalPython") < plan.index("Exchange"), plan


def test_text_not_in_bucket_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    cfg = M.PER_COLLECTION
    edges = M.bucket_edges(M.band_keys(M.signatures(df, cfg), cfg))
    plan = edges._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange" in line:
            assert "text" not in line


def test_dedup_shuffles_no_text(spark):
    df = spread(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).select("doc_id", "text")
    expected = sorted(map(tuple, D.dedup(df)[0].select("doc_id", "minhash_cluster_size").collect()))
    kept, _ = D.dedup(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    assert "Exchange hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
    # beyond the bound: a Bloom filter first, then an exact join of what it lets through
    kept, removed = D.dedup(df, broadcast_members=0)
    assert sorted(map(tuple, kept.select("doc_id", "minhash_cluster_size").collect())) == expected
    assert removed.count() + len(expected) == df.count() and removed.where("text is null").count() == 0


def test_bloom_filter_lets_every_key_through(spark):
    keys, others = spark.range(0, 20_000), spark.range(20_000, 120_000)
    for limit, rate in ((bloom.MAX_WORDS, 0.05), (40, 1)):
        words = bloom.words_for(20_000, limit)
        table = bloom.build(keys, F.col("id"), words)
        assert table.count() <= words
        assert bloom.may_hold(keys, F.col("id"), table, words, "hit").where("hit").count() == 20_000
        assert bloom.may_hold(others, F.col("id"), table, words, "hit").where("hit").count() <= rate * 100_000
    assert bloom.may_hold(keys.select(F.lit(None).cast("bigint").alias("id")), F.col("id"), table, words, "hit").where("hit").count() == 0
