from pyspark.sql import functions as F

from textsift.plans import corpus as CP


def test_labelled_frame_is_written_once(spark, monkeypatch):
    """the waterfall's rows are read back from a table; an eager checkpoint ran the waterfall twice."""
    monkeypatch.setattr(CP.D, "dedup", lambda df, *a, **k: (df, df))
    monkeypatch.setattr(CP.SC, "score_documents", lambda model, df: df)
    docs = spark.createDataFrame([(1, "one two three", "c", "pt", 1.0)], "doc_id long, text string, collection string, language string, language_score double")
    tiered, labelled = CP.curate(docs, None)
    assert labelled.inputFiles() and labelled.where(F.col("filter_step").isNotNull()).count() == 1 and tiered.count() == 0
