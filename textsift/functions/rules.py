"""Per-document rule metrics as Catalyst expressions (repetition, line quality, document quality).

Each metric is an integer numerator/denominator pair so that the Spark result and the SQL oracle compare exactly;
rules compare ``num / den`` (double) with the threshold. All builders take a ``Ctx`` of already-bound arrays
(words, lines, ...), which ``bind`` materialises once per row in a projection.
"""

from __future__ import annotations

import re

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsift.functions import text as T

# ---------------------------------------------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# Stop words of the document-quality step (FineWeb-2 Portuguese list), in the reference's order.
STOP_WORDS_PT = ["de", "a", "e", "o", "em", "do", "da", "que", "um", "no", "uma", "com", "para", "na", "é", "foi"]
# Terminal punctuation for the line-punctuation rule, ellipsis forms and bullet marks (our decision, paper wording).
END_PUNCT = ".!?\"'…"
ELLIPSIS = ["...", "…"]
BULLETS = "-*•‣◦⁃"
# ---------------------------------------------------------------------------------------------------------------


def _cls(chars: str) -> str:
    """Regex character class for literal characters (escape the few that are special inside [])."""
    return "[" + "".join("\\" + c if c in "\\]^-[" else c for c in chars) + "]"


END_PUNCT_RE = _cls(END_PUNCT) + r"[ \t]*\z"
ELLIPSIS_LINE_RE = r"(\.\.\.|…)[ \t]*\z"
BULLET_LINE_RE = r"\A[ \t]*" + _cls(BULLETS)

# Columns bound once per row by ``bind``.
W, NW, L, NB, NG = "_w", "_nw", "_l", "_nb", "_ng"
WS = "_ws"  # counts of the words, for rules that need no array


@dataclass(frozen=True)
class Ctx:
    text: Column
    w: Column
    nw: Column
    lines: Column
    nb: Column
    ng: Column | None = None  # struct from ngrams.ngram_metrics when engine="arrow"
    ws: Column | None = None  # struct from word_counts, where it is bound

    @property
    def n_words(self) -> Column:
        return F.size(self.w) if self.ws is None else self.ws["n"]

    @property
    def word_chars(self) -> Column:
        return T.total_length(self.w) if self.ws is None else self.ws["chars"]

    @property
    def alpha_words(self) -> Column:
        return alpha_words(self.w) if self.ws is None else self.ws["alpha"]


def alpha_words(ws: Column) -> Column:
    return F.size(F.filter(ws, lambda x: x.rlike(T.ALPHA_RE)))


def word_counts(text: str | Column) -> Column:
    """Struct of the number of words, their characters and the words with a letter; the array of words is not kept."""
    return T.let(T.words(text), lambda w: F.struct(F.size(w).alias("n"), T.total_length(w).alias("chars"), alpha_words(w).alias("alpha")))


class NgramFields(dict):
    """Stands in for ``Ctx.ng`` to find out which n-gram metrics a rule reads."""

    def __missing__(self, field: str) -> Column:
        self[field] = F.lit(0).cast("bigint")
        return self[field]


def ngram_fields(predicate) -> set[str]:
    """Names of the n-gram metrics that ``predicate(ctx)`` reads; empty for a rule that needs none."""
    seen = NgramFields()
    predicate(Ctx(F.lit(""), F.array().cast("array<string>"), F.array().cast("array<string>"), F.array().cast("array<string>"),
                  F.array().cast("array<string>"), seen))
    return set(seen)


class Reads:
    """Stands in for ``Ctx`` to find out what a rule reads: names of arrays in ``arrays``, n-gram metrics in ``ng``."""

    def __init__(self, ngram_engine: str = "arrow"):
        self.text, self.arrays, self.ng = F.lit(""), set(), NgramFields() if ngram_engine == "arrow" else None

    def _array(self, name: str) -> Column:
        self.arrays.add(name)
        return F.array().cast("array<string>")

    w = property(lambda self: self._array(W))
    nw = property(lambda self: self._array(NW))
    lines = property(lambda self: self._array(L))
    nb = property(lambda self: self._array(NB))
    n_words = word_chars = alpha_words = property(lambda self: self.arrays.add(WS) or F.lit(0))


def first_failing(df: DataFrame, predicates: list, text_col: str = "text", ngram_engine: str = "arrow", name: str = "_rule") -> DataFrame:
    """``df`` with the number (from 1) of the first of ``predicates(ctx)`` that is true; null where none is.

    Each predicate is evaluated once, and for the documents that passed all before it. So are the arrays and the n-gram
    metrics: they are bound where the first predicate reads them, and null for documents that are decided by then."""
    if ngram_engine not in ("arrow", "catalyst"):
        raise ValueError(f"unknown ngram_engine {ngram_engine!r}")
    read = []
    for pred in predicates:
        read.append(r := Reads(ngram_engine))
        pred(r)
    metrics = tuple(sorted(set().union(*[r.ng or () for r in read])))
    keep, out, bound, chain = df.columns, df, [], None
    made = {W: T.words(text_col), WS: word_counts(text_col), NW: T.norm_words(text_col), L: T.lines(text_col), NB: T.nonblank(T.lines(text_col))}
    ctx = Ctx(F.col(text_col), F.col(W), F.col(NW), F.col(L), F.col(NB), F.col(NG) if metrics else None, F.col(WS))

    def decided(rows: DataFrame) -> DataFrame:
        return rows if chain is None else T.materialize(rows, [*keep, *bound], **{name: chain})

    for i, (pred, r) in enumerate(zip(predicates, read), 1):
        new = [a for a in (W, WS, NW, L, NB) if a not in bound and a in r.arrays]
        new += [NG] if r.ng and NG not in bound else []
        if new:
            out = decided(out)
            open_ = F.col(name).isNull() if name in out.columns else F.lit(True)
            for a in new:
                if a == NG:
                    from textsift.functions.ngrams import ngram_metrics
                    out = out.withColumn(NG, ngram_metrics(F.when(open_, F.col(text_col)), open_, metrics))
                else:
                    out = out.withColumn(a, F.when(open_, made[a]))
            bound += new
            chain = F.when(F.col(name).isNotNull(), F.col(name)) if name in out.columns else None
        cond = pred(ctx)
        chain = F.when(cond, F.lit(i)) if chain is None else chain.when(cond, F.lit(i))
    bound = []
    return decided(out) if chain is not None else out.withColumn(name, F.lit(None).cast("int"))


def bind(df: DataFrame, text_col: str = "text", ngram_engine: str = "arrow",
         ngram_need=None, fields: tuple[str, ...] | None = None) -> tuple[DataFrame, Ctx]:
    """Materialise the token arrays once; later projections reference them by name.

    ``ngram_engine="arrow"`` also computes the n-gram repetition metrics with the Arrow UDF (one pass, all sizes);
    ``"catalyst"`` leaves them to the higher-order-function forms below. ``ngram_need(ctx) -> Column`` limits the
    UDF to the documents that reach the n-gram rules; ``fields`` names the metrics wanted (any size, see
    ``ngrams.FIELDS`` for the default).
    """
    out = (df.withColumn(W, T.words(text_col))
             .withColumn(NW, T.norm_words(text_col))
             .withColumn(L, T.lines(text_col)))
    out = out.withColumn(NB, T.nonblank(F.col(L)))
    ng = None
    if ngram_engine == "arrow":
        from textsift.functions.ngrams import FIELDS, ngram_metrics
        fields = FIELDS if fields is None else fields
    if ngram_engine == "arrow" and fields:
        pre = Ctx(F.col(text_col), F.col(W), F.col(NW), F.col(L), F.col(NB))
        need = ngram_need(pre) if ngram_need is not None else None
        out = out.withColumn(NG, ngram_metrics(F.col(text_col), need, tuple(fields)))
        ng = F.col(NG)
    elif ngram_engine not in ("arrow", "catalyst"):
        raise ValueError(f"unknown ngram_engine {ngram_engine!r}")
    return out, Ctx(F.col(text_col), F.col(W), F.col(NW), F.col(L), F.col(NB), ng)


def top_chars(c: Ctx, n: int) -> Column:
    return c.ng[f"top_{n}gram_chars"] if c.ng is not None else top_ngram_chars(c.w, n)


def dup_chars_n(c: Ctx, n: int) -> Column:
    return c.ng[f"dup_{n}gram_chars"] if c.ng is not None else dup_ngram_chars(c.w, n)


# --- repetition (Gopher) -----------------------------------------------------------------------------------------

def top_ngram_chars(ws: Column, n: int) -> Column:
    """Characters covered by the most frequent word n-gram: count * length(n-gram joined by spaces).

    Most frequent = highest count, then longest (decision 7.6.5). The n-grams are sorted and the run lengths
    scanned in one ``aggregate`` pass: no shuffle, O(k log k) per document.
    """
    srt = F.array_sort(T.ngram_strings(ws, n))
    init = F.struct(F.lit(None).cast("string").alias("cur"), F.lit(0).cast("bigint").alias("run"),
                    F.lit(0).cast("bigint").alias("bc"), F.lit(0).cast("bigint").alias("bl"))

    def step(acc, x):
        run = F.when(acc["cur"] == x, acc["run"] + 1).otherwise(F.lit(1).cast("bigint"))
        ln = F.length(x).cast("bigint")
        better = (run > acc["bc"]) | ((run == acc["bc"]) & (ln > acc["bl"]))
        return F.struct(x.alias("cur"), run.alias("run"),
                        F.when(better, run).otherwise(acc["bc"]).alias("bc"),
                        F.when(better, ln).otherwise(acc["bl"]).alias("bl"))

    return F.aggregate(srt, init, step, lambda acc: acc["bc"] * acc["bl"])


def dup_ngram_chars(ws: Column, n: int) -> Column:
    """Characters of words covered by a repeated n-gram (second and later occurrences), each word counted once.

    N-grams are keyed by xxhash64 of the joined words and sorted with their position; an element whose key equals
    its predecessor's is a repeat. Covered positions are the union of ``[p, p+n-1]`` over repeats.
    """
    k = F.size(ws) - n + 1
    keyed = F.transform(F.sequence(F.lit(1), k),
                        lambda i: F.struct(F.xxhash64(F.array_join(F.slice(ws, i, n), " ")).alias("h"), i.alias("p")))

    def covered_chars(srt: Column) -> Column:
        reps = F.filter(
            F.transform(F.sequence(F.lit(2), k),
                        lambda j: F.when(F.element_at(srt, j)["h"] == F.element_at(srt, j - 1)["h"],
                                         F.element_at(srt, j)["p"])),
            lambda x: x.isNotNull())
        covered = F.array_distinct(F.flatten(F.transform(reps, lambda p: F.sequence(p, p + n - 1))))
        return F.aggregate(covered, F.lit(0).cast("bigint"),
                           lambda acc, p: acc + F.length(F.element_at(ws, p)).cast("bigint"))

    chars = T.let(F.array_sort(keyed), covered_chars)
    return F.when(F.size(ws) >= n + 1, chars).otherwise(F.lit(0).cast("bigint"))


def repetition_metrics(c: Ctx) -> dict[str, Column]:
    """Integer pieces of rules R1-R13."""
    paras = T.nonblank(T.paragraphs(c.text))
    m = {
        "n_lines": F.size(c.nb).cast("bigint"),
        "dup_lines": T.n_dup(c.nb),
        "n_paras": F.size(paras).cast("bigint"),
        "dup_paras": T.n_dup(paras),
        "n_chars": F.length(c.text).cast("bigint"),
        "dup_line_chars": T.dup_chars(c.nb),
        "dup_para_chars": T.dup_chars(paras),
        "word_chars": T.total_length(c.w),
    }
    for n in (2, 3, 4):
        m[f"top_{n}gram_chars"] = top_chars(c, n)
    for n in range(5, 11):
        m[f"dup_{n}gram_chars"] = dup_chars_n(c, n)
    return m


# --- line quality (FineWeb) --------------------------------------------------------------------------------------

def line_quality_metrics(c: Ctx) -> dict[str, Column]:
    return {
        "n_lines": F.size(c.nb).cast("bigint"),
        "punct_lines": F.size(F.filter(c.nb, lambda x: x.rlike(END_PUNCT_RE))).cast("bigint"),
        "short_lines": F.size(F.filter(c.nb, lambda x: F.length(x) < 30)).cast("bigint"),
        "line_chars": T.total_length(c.nb),
        "dup_line_chars": T.dup_chars(c.nb),
        "newlines": (F.size(c.lines) - 1).cast("bigint"),
        "n_words": F.size(c.w).cast("bigint"),
    }


# --- document quality (Gopher) -----------------------------------------------------------------------------------

def doc_quality_metrics(c: Ctx, stop_words: list[str] = STOP_WORDS_PT) -> dict[str, Column]:
    stops = F.array(*[F.lit(s) for s in stop_words]) if stop_words else F.array().cast("array<string>")
    return {
        "n_words": F.size(c.w).cast("bigint"),
        "word_chars": T.total_length(c.w),
        "alpha_words": F.size(F.filter(c.w, lambda x: x.rlike(T.ALPHA_RE))).cast("bigint"),
        "hashes": T.count_substr(c.text, "#"),
        "ellipses": T.count_substr(c.text, "...") + T.count_substr(c.text, "…"),
        "n_lines": F.size(c.nb).cast("bigint"),
        "bullet_lines": F.size(F.filter(c.nb, lambda x: x.rlike(BULLET_LINE_RE))).cast("bigint"),
        "ellipsis_lines": F.size(F.filter(c.nb, lambda x: x.rlike(ELLIPSIS_LINE_RE))).cast("bigint"),
        "stop_words": F.size(F.array_intersect(F.array_distinct(c.nw), stops)).cast("bigint"),
    }


# --- lexicons (G8/G9) ----------------------------------------------------------------------------------------------

def lexicon_key(entry: str) -> tuple[str, ...]:
    """The normalised words of an entry, as those of a text: hyphenated entries and phrases are several."""
    return tuple(re.findall(r"[^\W_]+", entry.lower()))


def lexicon_hits(c: Ctx, lexicon: list[str], distinct: bool = False) -> Column:
    """Occurrences (or distinct entries) of a small user lexicon among the normalised words (array literals).

    Entries of several words match consecutive words; entries that normalise alike are one, entries without words none."""
    keys: dict[int, set[str]] = {}
    for k in filter(None, map(lexicon_key, lexicon)):
        keys.setdefault(len(k), set()).add(" ".join(k))
    total = F.lit(0).cast("bigint")
    for n, entries in sorted(keys.items()):
        lx = F.array(*[F.lit(x) for x in sorted(entries)])
        grams = c.nw if n == 1 else T.ngram_strings(c.nw, n)
        total = total + F.size(_among(grams, lx, distinct))
    return total.cast("bigint")


def _among(grams: Column, entries: Column, distinct: bool) -> Column:
    return F.array_intersect(F.array_distinct(grams), entries) if distinct else F.filter(grams, lambda x: F.array_contains(entries, x))


def lexicon_counts(df: DataFrame, lexicon: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   word_col: str = "word") -> DataFrame:
    """(id, hits) for a large lexicon table: explode normalised words and, for entries of several words, the word sequences of
    their lengths; semi-join with the lexicon (AQE broadcasts it when its measured bytes allow), count per document.
    Documents without hits get 0."""
    lx = lexicon.select(T.norm_words(F.col(word_col)).alias("k")).where(F.size("k") > 0).select(F.size("k").alias("n"), F.array_join("k", " ").alias("w")).distinct()
    lengths = sorted(r["n"] for r in lx.select("n").distinct().collect())  # at most the longest entry's words
    grams = df.select(F.col(id_col).alias("_id"), F.inline(F.array(F.struct(T.norm_words(F.col(text_col)).alias("_w")))))
    each = F.concat(*[F.col("_w") if n == 1 else T.ngram_strings(F.col("_w"), n) for n in lengths or [1]])
    words = grams.select("_id", F.explode(each).alias("w"))
    hits = words.join(lx.select("w"), "w", "left_semi").groupBy("_id").agg(F.count(F.lit(1)).alias("hits"))
    return (df.select(F.col(id_col).alias("_id")).join(hits, "_id", "left")
            .select(F.col("_id").alias(id_col), F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits")))
