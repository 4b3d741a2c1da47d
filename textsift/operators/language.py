"""Language identification (L1) and the language filter (L2).

L1 is a multinomial naive-Bayes identifier trained with DataFrame operations. Words (lowercased
letter/digit runs) are hashed into ``buckets`` feature slots (first 4 bytes of MD5 mod p mod buckets), so the
model has at most ``buckets`` rows whatever the corpus size. Training is one ``explode`` + ``groupBy``; the model, at most
buckets x languages doubles, goes to the tasks as an array. Scoring is in place: an Arrow UDF sums each document's
word weights, so there is no row for a word, no shuffle and no join back to the text.

Score: per language, (log prior + sum of log word likelihoods with add-one smoothing) divided by the number of words,
softmax over languages; the label is the argmax (ties: first language in sorted order) and the score its
probability. A document without words gets no label and score 0.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsift.functions.text import norm_words

P31 = 2147483647


def word_bucket(word: Column, buckets: int) -> Column:
    h = F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint")
    return (h % P31) % buckets


@dataclass
class LanguageModel:
    weights: np.ndarray         # (buckets, languages): log(count + 1)
    languages: list[str]        # sorted labels
    log_prior: list[float]
    log_denom: list[float]      # log(total words of the language + buckets)
    buckets: int


def train(labelled: DataFrame, *, text_col: str = "text", label_col: str = "lang",
          buckets: int = 1 << 16) -> LanguageModel:
    """Count hashed words per language. The per-language constants are one small row per language."""
    words = labelled.select(F.col(label_col).alias("lang"), F.explode(norm_words(F.col(text_col))).alias("w"))
    counts = words.groupBy("lang", word_bucket(F.col("w"), buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("c"))
    docs = labelled.where(F.col(label_col).isNotNull()).groupBy(F.col(label_col).alias("lang")).agg(
        F.count(F.lit(1)).alias("d"))
    # One row per language label (a handful to a few hundred), then at most buckets x languages counts.
    consts = sorted(docs.collect(), key=lambda r: r["lang"])
    n_docs = sum(r["d"] for r in consts)
    langs = [r["lang"] for r in consts]
    got = counts.where(F.col("lang").isin(langs)).toPandas()
    at = {lg: i for i, lg in enumerate(langs)}
    table = np.zeros((buckets, len(langs)), dtype=np.int64)
    table[got["bucket"].to_numpy(dtype=np.int64), got["lang"].map(at).to_numpy(dtype=np.int64)] = got["c"]
    log_prior = [math.log(r["d"] / n_docs) for r in consts]
    log_denom = [math.log(int(n) + buckets) for n in table.sum(axis=0)]
    return LanguageModel(np.log(table + 1.0), langs, log_prior, log_denom, buckets)


def python_bucket(word: str, buckets: int) -> int:
    return int.from_bytes(hashlib.md5(word.encode("utf-8")).digest()[:4], "big") % P31 % buckets


#: Words that ``word_slots`` looks at in one go (a longer document is taken whole), and slots that it remembers.
WORDS_AT_ONCE = 1 << 17
SLOTS_KEPT = 1 << 17


def word_slots(words: pa.Array, buckets: int) -> Iterator[np.ndarray]:
    """The slot of every word of each document of a batch (a list array; null: no words). A few documents at a time: each distinct
    word becomes a Python string once, and memory doesn't follow the batch."""
    slot: dict[str, int] = {}
    ends = words.offsets.to_numpy()
    full = words.is_valid().to_numpy(zero_copy_only=False)
    first = 0
    while first < len(words):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + WORDS_AT_ONCE, "right")) - 1)
        coded = words.values.slice(ends[first], ends[last] - ends[first]).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(slot) > SLOTS_KEPT:
            slot.clear()
        for w in distinct:
            if w not in slot:
                slot[w] = python_bucket(w, buckets)
        at = np.fromiter(map(slot.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        for i in range(first, last):
            yield at[ends[i] - ends[first]:ends[i + 1] - ends[first]] if full[i] else at[:0]
        first = last


def detected(model: LanguageModel, text: Column) -> Column:
    """Struct (language, language_score) of a text, in place."""
    weights, buckets = model.weights, model.buckets
    prior, denom = np.array(model.log_prior), np.array(model.log_denom)
    names = np.array([*model.languages, None], dtype=object)

    @F.arrow_udf("language string, language_score double")
    def score(words: pa.Array) -> pa.Array:
        out = []
        for at in word_slots(words, buckets):
            n = len(at)
            if not n or not len(prior):
                out.append((None, 0.0))
                continue
            z = (prior + weights[at].sum(axis=0) - n * denom) / n
            e = np.exp(z - z.max())
            best = int(np.argmax(z))  # first maximum (languages are sorted)
            out.append((names[best], float(e[best] / e.sum())))
        columns = [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64(), from_pandas=True)]
        return pa.StructArray.from_arrays(columns, ["language", "language_score"])

    return score(norm_words(text))


def with_language(model: LanguageModel, df: DataFrame, *, text_col: str = "text", language_col: str = "language",
                  score_col: str = "language_score") -> DataFrame:
    """``df`` with label and score of every text; no shuffle, no join."""
    out = df.withColumn("_lg", detected(model, F.col(text_col)))
    return (out.withColumn(language_col, F.col("_lg.language"))
            .withColumn(score_col, F.round(F.col("_lg.language_score"), 6)).drop("_lg"))


def detect(model: LanguageModel, df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, language, language_score) for every row of ``df``."""
    return with_language(model, df.select(id_col, text_col), text_col=text_col).drop(text_col)


def language_filter(scored: DataFrame, languages: tuple[str, ...] = ("pt",), threshold: float = 0.799,
                    lang_col: str = "language", score_col: str = "language_score") -> tuple[DataFrame, DataFrame]:
    """L2: (kept, removed): keep iff the label is a target language and the score reaches the threshold."""
    keep = F.col(lang_col).isin(list(languages)) & (F.col(score_col) >= threshold)
    keep = F.coalesce(keep, F.lit(False))
    return scored.where(keep), scored.where(~keep)
