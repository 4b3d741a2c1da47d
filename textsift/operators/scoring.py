"""Model scoring and tiering.

Two predictor paths:

* built-in: three classes of hashed words in closed form. The fit is one aggregation (counts by slot and class, the
  sufficient statistics); weights are whole numbers (2^-20 of a log likelihood), so sums have one value in any order and
  any engine. Scoring is in place: no row for a word, no shuffle;
* pluggable: any Python predictor over Arrow batches (``mapInArrow``), loaded once per task, batches of at most 1,000 rows
  (like the reference) and 8 MB of text, however many rows Spark's own batches have. A failing batch keeps its rows
  and records the error (the reference dropped the batch). A predictor with a bounded input gets a document as windows of so
  many words (``score_windows``), where the reference cut the text; a document's scores are those of its windows,
  weighted by their words.

Outputs follow the reference: ``quality_label`` = argmax of three logits (low, medium, high; first wins ties),
``edu_score``, ``depth_score`` and ``binary_edu_score`` = edu >= 2.5.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from textsift.functions.normalize import TOKEN_RE
from textsift.functions.text import words
from textsift.operators.language import word_bucket, word_slots

# Tier names in logit order, and the binary edu threshold.
LABELS = ["low", "medium", "high"]
EDU_THRESHOLD = 2.5


def argmax_label(logits: Column, labels: list[str] = LABELS) -> Column:
    """Label of the largest logit; the first one wins ties. Null logits have no label."""
    pos = F.array_position(logits, F.array_max(logits)).cast("int")
    return F.when(F.array_max(logits).isNotNull(), F.element_at(F.array(*[F.lit(x) for x in labels]), pos))


def binary_edu(edu: Column, threshold: float = EDU_THRESHOLD) -> Column:
    """C3."""
    return (edu >= threshold).cast("int")


def training_tier(quality: Column, toxic: Column) -> Column:
    """Three-class target from the binary labels (our decision): quality 0 -> low, quality 1 and toxic -> medium,
    quality 1 and not toxic -> high."""
    return (F.when(quality == 0, F.lit(0.0)).when(toxic == 1, F.lit(1.0)).otherwise(F.lit(2.0)))


SCALE = 1 << 20
PRIOR_WORDS = 5000


def quality_tokens(text: Column) -> Column:
    """Lowercased words, and every other character that isn't white space on its own: markup debris tells junk from prose."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_RE), 0)



@dataclass
class QualityModel:
    """Whole-number weights, 1 / SCALE of a log: (buckets, 3) by slot and class, and the classes' priors."""
    weights: np.ndarray
    prior: np.ndarray


def train_quality_model(labelled: DataFrame, *, text_col: str = "text", buckets: int = 1 << 18) -> QualityModel:
    """Fit from counts: weight of a slot and class = log((c + PRIOR_WORDS * p) / (n + PRIOR_WORDS) / p), with c of the class's n
    tokens in the slot and p = (tokens of the slot + 1) / (all tokens + buckets): a class is pulled towards the whole
    corpus as if PRIOR_WORDS of its tokens came from there, so classes of few documents aren't at a disadvantage.

    Tokens are lowercased words and single other characters, hashed in the JVM as for L1. At most 3 x ``buckets`` counts and 3 priors reach the driver. Fit once and pass the model on: scoring is a plan
    of its own. A class without documents never wins."""
    rows = labelled.select(training_tier(F.col("quality"), F.col("toxic")).cast("int").alias("k"), quality_tokens(F.col(text_col)).alias("w"))
    counts = rows.select("k", F.explode("w").alias("w")).groupBy("k", word_bucket(F.col("w"), buckets).alias("b")).agg(F.count(F.lit(1)).alias("c")).toPandas()
    docs = np.zeros(len(LABELS))
    for r in rows.groupBy("k").count().collect():
        docs[r["k"]] = r["count"]
    table = np.zeros((buckets, len(LABELS)), dtype=np.int64)
    table[counts["b"].to_numpy(np.int64), counts["k"].to_numpy(np.int64)] = counts["c"]
    whole = lambda x: np.floor(x * SCALE + 0.5).astype(np.int64)
    prior = np.log(np.where(docs > 0, docs, 1e-300) / max(1.0, docs.sum()))
    share = ((table.sum(axis=1) + 1.0) / (table.sum() + buckets))[:, None]
    return QualityModel(whole(np.log((table + PRIOR_WORDS * share) / (table.sum(axis=0) + PRIOR_WORDS) / share)), whole(prior))


def quality_logits(model: QualityModel, text: Column) -> Column:
    """Logits of the three classes: (prior + sum of the words' weights) / SCALE / sqrt(number of words)."""
    weights, prior = model.weights, model.prior

    @F.arrow_udf("array<double>")
    def logits(words: pa.Array) -> pa.Array:
        out = [(prior + weights[at].sum(axis=0)) / SCALE / math.sqrt(max(1, len(at))) for at in word_slots(words, len(weights))]
        return pa.array(out, pa.list_(pa.float64()))
    # Marked non-deterministic only so that a filter on a score isn't pushed below it, which would read each text twice.
    return logits.asNondeterministic()(quality_tokens(text))


def score_documents(model: QualityModel, df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """C1 + C2 + C3 with the built-in model, over whole texts. A null or empty text is scored by the priors."""
    out = df.withColumn("_z", quality_logits(model, F.col(text_col)))
    e = F.transform("_z", lambda x: F.exp(x - F.array_max("_z")))
    out = out.withColumn("_e", e)
    total = F.element_at("_e", 1) + F.element_at("_e", 2) + F.element_at("_e", 3)
    edu = F.round((F.element_at("_e", 2) + F.lit(2.0) * F.element_at("_e", 3)) / total * F.lit(2.5), 6)
    res = (out.withColumn("quality_label", argmax_label(F.col("_z")))
           .withColumn("edu_score", edu)
           .withColumn("depth_score", F.round(F.element_at("_e", 3) / total * F.lit(5.0), 6))
           .withColumn("binary_edu_score", binary_edu(F.col("edu_score"))))
    return res.drop("_z", "_e")


PREDICTION_FIELDS = [Ty.StructField("edu_score", Ty.DoubleType()), Ty.StructField("depth_score", Ty.DoubleType()),
                     Ty.StructField("logits", Ty.ArrayType(Ty.DoubleType())), Ty.StructField("error", Ty.StringType())]


#: A predictor's batch: rows (like the reference) and bytes of text; a longer text is a batch of its own.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def small_batches(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Cuts an Arrow batch so that column ``at`` of a piece is bounded, however many rows Spark puts into a batch."""
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
    first = 0
    while first < batch.num_rows:
        last = min(first + BATCH_ROWS, max(first + 1, int(np.searchsorted(ends, ends[first] + BATCH_BYTES, "right")) - 1))
        last = min(last, batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def score_with(df: DataFrame, predictor_factory: Callable[[], Callable[[list[str]], tuple]], *,
               text_col: str = "text") -> DataFrame:
    """C1 + C6 with a user predictor: ``predictor_factory()`` runs once per task and returns
    ``predict(texts) -> (edu_scores, depth_scores, logits)``. Errors are kept per batch in ``error``."""
    schema = Ty.StructType(df.schema.fields + PREDICTION_FIELDS)
    at = df.columns.index(text_col)
    kinds = [pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.string()]

    def run(batches):
        predict = predictor_factory()
        for whole in batches:
            for b in small_batches(whole, at):
                n = b.num_rows
                try:
                    edu, depth, logits = predict(b.column(at).to_pylist())
                    made = [list(edu), list(depth), [list(x) for x in logits], [None] * n]
                    if any(len(m) != n for m in made):
                        raise ValueError(f"a batch of {n} texts has {[len(m) for m in made[:3]]} predictions")
                    columns = [pa.array(m, k, from_pandas=True) for m, k in zip(made, kinds)]
                except Exception as e:  # noqa: BLE001 - a failing batch keeps its rows
                    columns = [pa.nulls(n, k) for k in kinds[:3]] + [pa.array([f"{type(e).__name__}: {e}"] * n, kinds[3])]
                yield pa.RecordBatch.from_arrays([*b.columns, *columns], schema.names)

    scored = df.mapInArrow(run, schema)
    return (scored.withColumn("quality_label", argmax_label(F.col("logits")))
            .withColumn("binary_edu_score", binary_edu(F.col("edu_score"))))


def text_windows(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokens: int = 512, split: Callable[[Column], Column] = words) -> DataFrame:
    """(id, window, n_tokens, text): each document as rows of at most ``tokens`` consecutive words; one without words has one empty row.

    ``split`` gives the words of a text; windows join them by one space."""
    ws = df.select(F.col(id_col), F.inline(F.array(F.struct(F.coalesce(split(F.col(text_col)), F.array().cast("array<string>")).alias("_w")))))
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size("_w") / tokens).cast("int") - 1, F.lit(0))), lambda i: F.slice("_w", i * tokens + 1, tokens))
    return ws.select(id_col, F.posexplode(cut).alias("window", "_p")).select(id_col, "window", F.size("_p").alias("n_tokens"), F.array_join("_p", " ").alias("text"))


def score_windows(df: DataFrame, predictor_factory: Callable[[], Callable[[list[str]], tuple]], *, id_col: str = "doc_id", text_col: str = "text",
                  tokens: int = 512, split: Callable[[Column], Column] = words) -> DataFrame:
    """C1 for predictors with a bounded input: (id, n_windows, n_tokens, edu_score, depth_score, logits, error, quality_label, binary_edu_score).

    Windows are predicted in batches, whatever document they come from; a document's scores are the means of its windows',
    weighted by their words (an empty one counts as one word). Only ids and scores are shuffled. A document with a failing window has
    no scores and the error. Rows that share an id are one document."""
    scored = score_with(text_windows(df, id_col=id_col, text_col=text_col, tokens=tokens, split=split), predictor_factory)
    weight = F.greatest("n_tokens", F.lit(1))
    mean = lambda c: F.sum(c * weight) / F.sum(weight)
    some = scored.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_windows"), F.sum("n_tokens").alias("n_tokens"), mean(F.col("edu_score")).alias("edu_score"), mean(F.col("depth_score")).alias("depth_score"),
                                      F.array(*[mean(F.get("logits", k)) for k in range(len(LABELS))]).alias("logits"), F.min("error").alias("error"))
    ok = lambda c: F.when(F.col("error").isNull(), c)
    some = some.select(id_col, "n_windows", "n_tokens", ok(F.col("edu_score")).alias("edu_score"), ok(F.col("depth_score")).alias("depth_score"), ok(F.col("logits")).alias("logits"), "error")
    return some.withColumn("quality_label", argmax_label(F.col("logits"))).withColumn("binary_edu_score", binary_edu(F.col("edu_score")))


def tier_counts(scored: DataFrame, collection_col: str = "collection", label_col: str = "quality_label") -> DataFrame:
    """Documents per (collection, tier)."""
    return scored.groupBy(F.col(collection_col).alias("collection"), F.col(label_col).alias("quality_label")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))
