"""Waterfall properties on the fixture documents."""
from pyspark.sql import functions as F

from textsift.operators import waterfall as WF
from textsift.plans.catalog import labelled_documents, PARAMS


def test_partition_and_first_failure(spark):
    lab = labelled_documents(spark, "/root/testdata/sf0.001")
    kept, removed = WF.split(lab)
    n = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert kept.count() + removed.count() == n
    assert kept.join(removed, "doc_id").count() == 0
    assert removed.where(F.col("filter_reason").isNull()).count() == 0


def test_raising_threshold_never_removes_more(spark):
    from dataclasses import replace
    base = labelled_documents(spark, "/root/testdata/sf0.001", replace(PARAMS, dup_line_frac=0.2))
    loose = labelled_documents(spark, "/root/testdata/sf0.001", replace(PARAMS, dup_line_frac=0.5))
    assert loose.where(F.col("filter_step").isNotNull()).count() <= base.where(F.col("filter_step").isNotNull()).count()


def test_user_rule(spark):
    df = spark.createDataFrame([(1, "keep this text please"), (2, "drop SPAM text")], "id long, text string")
    rule = WF.filter_where("5_user", "spam", F.col("text").contains("SPAM"))
    lab = WF.label(df, WF.FilterParams(remove_short_lines=False), language_col=None, rules=[], extra_rules=[rule])
    got = {r["id"]: r["filter_reason"] for r in lab.collect()}
    assert got == {1: None, 2: "spam"}


def test_python_nodes_in_rule_plans(spark):
    """Rules stay JVM-side: no Python node with the Catalyst n-gram engine, exactly one Arrow node otherwise."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", "text", F.col("lang").alias("language"), F.lit(1.0).alias("language_score"))

    def plan(engine):
        lab = WF.label(df, PARAMS, ngram_engine=engine)
        return lab._jdf.queryExecution().executedPlan().toString()

    assert "Python" not in plan("catalyst")
    arrow = plan("arrow")
    assert arrow.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in arrow
