"""Registered queries of the training-data operators: ``QUERIES[name] = (fn(spark, sf_dir), DuckDB SQL or None)``.

Each query hands one whole table to its operator with production parameters and returns the operator's rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textsift.llm import alignment, article, licenses, mixing, packing, pii, quality, simhash, tokens, topk, toxicity, variants, warc
from textsift.session import table

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


OP1_SQL = """
WITH ok AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS (SELECT vec_id, min(v) AS v FROM ok GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM r q JOIN r c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
k AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM k WHERE rank <= 20"""


@register("op1_topk", OP1_SQL)
def op1(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@register("op2_licenses", licenses.oracle())
def op2(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@register("op6_simhash")
def op6(spark, sf_dir):
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=4, radius=4)


@register("op9_quality")
def op9(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"))


@register("op7_pii")
def op7(spark, sf_dir):
    return pii.pii_digest(table(spark, sf_dir, "documents"))


MIX = {"budget": (3, 2), "max_epochs": 4, "seed": 7}


@register("op3_mixing", mixing.oracle(**MIX))
def op3(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"), mixing.document_levels(), mixing.WEIGHTS, **MIX)


PACK = {"max_tokens": 2048, "buckets": 8, "batch_tokens": 65536, "seed": 11}


@register("op8_packing", packing.oracle(**PACK))
def op8(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), **PACK)


@register("op4_warc", warc.ORACLE)
def op4(spark, sf_dir):
    return warc.page_records(table(spark, sf_dir, "pages"))


@register("op5_token_store")
def op5(spark, sf_dir):
    import public_tokenizers
    return tokens.token_positions(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register("op10_toxicity")
def op10(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), toxicity.label_chain())


@register("op12_variants", variants.oracle())
def op12(spark, sf_dir):
    return variants.variants(table(spark, sf_dir, "documents"))


@register("op13_article", article.ORACLE)
def op13(spark, sf_dir):
    return article.extract_articles(table(spark, sf_dir, "pages"))


@register("op11_alignment")
def op11(spark, sf_dir):
    import public_tokenizers as P
    return alignment.align(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), P.PATTERN)
