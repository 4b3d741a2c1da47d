"""Signatures, language scores and plugged predictors: memory doesn't follow the rows of an Arrow batch."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textsift.operators import language as LG
from textsift.operators import minhash as M
from textsift.operators import scoring as SC


def test_signature_memory_is_bounded():
    """a long document against many hash functions: no product of both is held, and values are as before."""
    import tracemalloc
    a, b = M.hash_params(600)
    h = np.arange(20_000, dtype=np.int64) * 104_729 % M.P31
    tracemalloc.start()
    got = M.signature_31(h, a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20  # one product of 8,192 shingles with 600 functions is 39 MB
    assert got[:3].tolist() == [min((int(x) * int(v) + int(y)) % M.P31 for v in h) for x, y in zip(a[:3], b[:3])]


def test_signatures_are_flat(spark):
    rows = [(1, "one two three four five six"), (2, None), (3, ""), (4, "Six five four three two one"), (5, "one")]
    cfg = M.MinhashConfig(2, 3, 2)
    a, b = M.hash_params(6)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in M.signatures(df, cfg).collect():
        if rows[r.id - 1][1] is None:
            continue
        words = rows[r.id - 1][1].lower().split()
        h = [M.md5_31(x) for x in M.shingles(words, 2)]
        assert r.sig == ([min((int(x) * v + int(y)) % M.P31 for v in h) for x, y in zip(a, b)] if h else None)


def test_word_slots(monkeypatch):
    """slots of lists cut into small pieces, of a slice with nulls and empty lists."""
    lists = [["gone"], ["a", "b", "a"], None, [], ["c"] * 9, ["b", "é"], None]
    monkeypatch.setattr(LG, "WORDS_AT_ONCE", 4)
    monkeypatch.setattr(LG, "SLOTS_KEPT", 1)
    got = [x.tolist() for x in LG.word_slots(pa.array(lists, pa.list_(pa.string())).slice(1), 97)]
    assert got == [[LG.python_bucket(w, 97) for w in x or []] for x in lists[1:]]


def test_predictor_batches_are_bounded(spark):
    """F8: a predictor never gets more than 1,000 rows, whatever Spark puts into a batch."""
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    try:
        df = spark.range(0, 2500, 1, 1).select("id", F.when(F.col("id") != 7, F.lit("x")).alias("text"))
        got = SC.score_with(df, lambda: lambda t: ([len(t)] * len(t), [float("nan")] * len(t), [[0, 1, 0]] * len(t))).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    assert len(got) == 2500 and {r.edu_score for r in got} == {1000.0, 500.0} and {(r.quality_label, r.error, r.depth_score) for r in got} == {("medium", None, None)}


def test_small_batches(monkeypatch):
    monkeypatch.setattr(SC, "BATCH_BYTES", 5)
    monkeypatch.setattr(SC, "BATCH_ROWS", 3)
    texts = ["abc", "de", "f", None, None, "", "longer than that", "x", None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    got = [b.column(0).to_pylist() for b in SC.small_batches(batch, 0)]
    assert [t for b in got for t in b] == texts and all(len(b) <= 3 and (len(b) == 1 or sum(len(t or "") for t in b) <= 5) for b in got)
