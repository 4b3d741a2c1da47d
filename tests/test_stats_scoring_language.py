"""Statistics, scoring and language operators on literal rows."""
from pyspark.sql import functions as F

from textsift.operators import language as LG
from textsift.operators import scoring as SC
from textsift.operators import stats as A


def test_cumulative_token_distribution(spark):
    df = spark.createDataFrame([("high", 3999), ("high", 4000), ("high", 8000), ("high", 256000)],
                               "quality_label string, token_count long")
    got = {r["bucket"]: r["n"] for r in A.token_distribution(df).collect()}
    assert got == {"4k": 3, "8k": 2, "16k": 1, "32k": 1, "64k": 1, "128k": 1, "256k": 1}


def test_grand_total_excludes_low(spark):
    df = spark.createDataFrame([("low", 5, 50), ("medium", 1, 10), ("high", 2, 20)],
                               "tier string, total_entries long, total_token_count long")
    got = {r["tier"]: r["total_entries"] for r in A.with_grand_total(df, [], ["total_entries", "total_token_count"]).collect()}
    assert got["total"] == 3


def test_top_n_with_others(spark):
    for k, others in [(0, 0), (40, 0), (41, 1)]:
        rows = [(f"l{i:02d}", 100 - i) for i in range(k)]
        df = spark.createDataFrame(rows, "language string, n long") if rows else \
            spark.createDataFrame([], "language string, n long")
        got = {r["key"]: r["n"] for r in A.top_n_with_others(df, "language").collect()}
        assert got["Others"] == (100 - 40 if others else 0)
        assert len(got) == min(k, 40) + 1


def test_format_count(spark):
    df = spark.createDataFrame([(999,), (1000,), (1250,), (999999,), (1000000,)], "x long")
    got = [r[0] for r in df.select(A.format_count(F.col("x"))).collect()]
    assert got == ["999", "1.0K", "1.3K", "1000.0K", "1.0M"]


def test_pretty_labels(spark):
    df = spark.createDataFrame([("2_gopher_rep", "dup_line_frac")], "s string, r string")
    r = df.select(A.pretty_step(F.col("s")), A.pretty_reason(F.col("r"))).collect()[0]
    assert tuple(r) == ("2 Gopher Rep", "Dup line frac")


def test_argmax_ties_and_binary_edu(spark):
    df = spark.createDataFrame([([1.0, 1.0, 0.0], 2.5), ([0.0, 2.0, 2.0], 2.49), ([0.0, 0.0, 3.0], 0.0)],
                               "l array<double>, e double")
    got = [tuple(r) for r in df.select(SC.argmax_label(F.col("l")), SC.binary_edu(F.col("e"))).collect()]
    assert got == [("low", 1), ("medium", 0), ("high", 0)]


def test_failing_predictor_keeps_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, text string")

    def factory():
        def predict(texts):
            raise ValueError("boom")
        return predict

    out = SC.score_with(df, factory).collect()
    assert len(out) == 2 and all(r["error"].startswith("ValueError") for r in out)


def test_language_filter_boundary(spark):
    df = spark.createDataFrame([(1, "pt", 0.799), (2, "pt", 0.798), (3, "es", 0.99)],
                               "id long, language string, language_score double")
    kept, removed = LG.language_filter(df)
    assert [r["id"] for r in kept.collect()] == [1]
    assert sorted(r["id"] for r in removed.collect()) == [2, 3]


def test_language_model_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = LG.train(docs)
    out = LG.detect(model, docs).join(docs.select("doc_id", "lang"), "doc_id")
    acc = out.where(F.col("language") == F.col("lang")).count() / out.count()
    assert acc > 0.9
