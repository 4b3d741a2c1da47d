import corpus_pipeline as C
from pyspark.sql import functions as F

from textsift.llm import mixing, packing, pii, quality, simhash
from tests.llm.test_simhash import brute


def test_stages_on_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("q_v", F.lit(1)).withColumn("rid", F.lit("x"))
    odd = [(None, None, None, None, None, 1, "x"), (-1, "", "en", "src1", 0, 1, "x"), (-2, "word " * 10, None, None, 0, 1, "x")]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    columns, kept = docs.columns, docs
    for name, stage in C.STAGES:
        before = [r.asDict() for r in kept.collect()]
        after = stage(spark, kept, "").checkpoint()
        if name == "quality_rules":
            good = {r.doc_id for r in quality.quality(kept).where("kept").collect()}
            assert sorted(r.doc_id for r in after.collect()) == sorted(x["doc_id"] for x in before if x["doc_id"] in good)
        if name == "near_duplicates":
            _, comp = brute([(x["doc_id"], x["text"]) for x in before])
            assert sorted(r.doc_id for r in after.collect()) == sorted(set(comp))
        if name == "personal_data":
            assert after.count() == len(before) and pii.find_pii(after).where(F.size("base") > 0).count() == 0
        if name == "source_mixture":
            taken = {r.doc_id for r in mixing.mixture(kept, mixing.document_levels(), mixing.WEIGHTS, budget=(9, 10), max_epochs=1).collect()}
            assert {r.doc_id for r in after.collect()} == taken
        if name == "packing":
            assert after.agg(F.sum("n_tokens")).first()[0] == sum(len((x["text"] or "").split()) for x in before)
        else:
            assert after.columns == columns
        kept = after
    empty = docs.limit(0)
    for _, stage in C.STAGES:
        empty = stage(spark, empty, "")
        assert empty.count() == 0
    assert packing and simhash


def test_run_is_its_stages(spark):
    assert C.run(spark, "/root/testdata/sf0.001").count() > 0
