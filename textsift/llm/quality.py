"""Quality rules as weak supervision (operator 9), in column expressions only.

Every rule votes good (1) or bad (-1) or abstains (0). Expectation-maximisation over the counts of vote patterns
estimates, for good and for bad documents, how often each rule votes bad when it votes; a document's posterior
probability of being good then replaces the test that every rule passes. Two base conditions come first: fewer than
``min_words`` words, or more than ``max_repeat`` percent of the words inside repeated windows, fail a document outright.

Scale: the metrics are one narrow projection over whole texts. The patterns are aggregated map-side to at most
3 ** len(RULES) rows, whatever the corpus, and only sums over them (one row an iteration) reach the driver.

Defined cases: a null or empty text has no words: all counts are 0 and it fails the base condition. A rule whose
measure has no denominator (no words, no lines) abstains. Equal rows get equal verdicts, each its own row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsift.llm.common import SPACE_CLASS, SPACES, bind, saved, words

WINDOW = 8
# Fixed value: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"

#: name, numerator, denominator, bad if (ratio) ..., good if ...; between the two the rule abstains. Ratios of counts.
RULES: list[tuple[str, str, str, tuple[str, float], tuple[str, float]]] = [
    ("symbols", "n_symbols", "n_words", (">", 0.10), ("<=", 0.03)),
    ("duplicate_lines", "n_dup_lines", "n_lines", (">", 0.40), ("<=", 0.10)),
    ("repeated_windows", "n_repeat_words", "n_words", (">", 0.25), ("<=", 0.05)),
    ("lettered_words", "n_lettered", "n_words", ("<", 0.70), (">=", 0.90)),
    ("capitals", "n_capitals", "word_chars", (">", 0.30), ("<=", 0.15)),
    ("punctuation", "n_marks", "word_chars", (">", 0.20), ("<=", 0.10)),
    ("word_runs", "n_same_as_last", "n_words", (">", 0.20), ("<=", 0.05)),
    ("short_words", "word_chars", "n_words", ("<", 2.5), (">=", 3.5)),
    ("long_words", "word_chars", "n_words", (">", 15.0), ("<=", 10.0)),
]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_lettered", "n_capitals", "n_marks", "n_same_as_last"]
#: Where the estimation starts, and pseudo-counts that hold it there while there is no evidence.
PRIOR_GOOD, BAD_IF_GOOD, BAD_IF_BAD, WEIGHT = 0.85, 0.03, 0.40, 5.0


def repeated_words(w: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur at least twice in the array ``w``, first ones included."""
    def covered(found: Column) -> Column:  # sorted (hash, position): a window occurs again if a neighbour has its hash
        again = F.filter(found, lambda x, k: F.get(found, k - 1)["h"].eqNullSafe(x["h"]) | F.get(found, k + 1)["h"].eqNullSafe(x["h"]))
        return bind(F.sort_array(F.transform(again, lambda x: x["i"])), lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x))

    def windows(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            bind(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered))
    return F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(
        bind(F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW))), windows)).cast("bigint")


def without(text: Column, pattern: str) -> Column:
    """Code points that match a character class."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("bigint")


def measured(df: DataFrame, text_col: str, prefix: str) -> DataFrame:
    """``df`` with the counts of ``COUNTS`` and a vote for each rule, all named ``prefix`` + name."""
    text, p = F.coalesce(F.col(text_col), F.lit("")), prefix
    bare = F.translate(text, SPACES, "")
    has_word = lambda x: x.rlike(SPACE_CLASS.replace("[", "[^", 1))
    df = df.select("*", words(F.col(text_col)).alias(p + "w"), F.filter(F.split(text, "\n", -1), has_word).alias(p + "l"))
    w, lines = F.col(p + "w"), F.col(p + "l")
    count = lambda c: c.cast("bigint")
    values = {
        "n_words": count(F.size(w)), "word_chars": count(F.length(bare)), "n_symbols": count(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))),
        "n_dup_lines": count(F.size(lines) - F.size(F.array_distinct(lines))), "n_repeat_words": repeated_words(w), "n_lines": count(F.size(lines)),
        "n_lettered": count(F.size(F.filter(w, lambda x: x.rlike(r"\p{L}")))), "n_capitals": without(text, r"\p{Lu}+"), "n_marks": without(bare, r"[^\p{L}\p{M}\p{N}]+"),
        "n_same_as_last": count(F.size(F.filter(w, lambda x, i: x.eqNullSafe(F.get(w, i - 1))))),
    }
    keep = [c for c in df.columns if c not in (p + "w", p + "l")]
    df = df.select(*keep, *[c.alias(p + n) for n, c in values.items()])

    def vote(num, den, bad, good):
        ratio = F.when(F.col(p + den) > 0, F.col(p + num) / F.col(p + den))
        test = {">": ratio.__gt__, "<": ratio.__lt__, "<=": ratio.__le__, ">=": ratio.__ge__}
        return F.when(test[bad[0]](bad[1]), -1).when(test[good[0]](good[1]), 1).otherwise(0)
    return df.select("*", *[vote(*r[1:]).alias(p + "v_" + r[0]) for r in RULES])


def log_odds(model: dict, prefix: str) -> Column:
    """Posterior log-odds of a good document from its votes."""
    total = F.lit(math.log(model["good"] / (1 - model["good"])))
    for name, *_ in RULES:
        g, b = model[name]
        total = total + F.when(F.col(f"{prefix}v_{name}") == -1, math.log(g / b)).when(F.col(f"{prefix}v_{name}") == 1, math.log((1 - g) / (1 - b))).otherwise(0.0)
    return total


def posterior(model: dict, prefix: str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-log_odds(model, prefix)))


def estimate(patterns: DataFrame, prefix: str, rounds: int = 25, tolerance: float = 1e-4) -> dict:
    """EM over (votes..., n). ``model[rule]``: how often it votes bad, when it votes, on good and on bad documents."""
    model = {"good": PRIOR_GOOD} | {r[0]: (BAD_IF_GOOD, BAD_IF_BAD) for r in RULES}
    for _ in range(rounds):
        good, n = F.col("good") * F.col("n"), (1 - F.col("good")) * F.col("n")
        sums = [F.sum(good).alias("good"), F.sum(n).alias("bad")]
        for name, *_ in RULES:
            v = F.col(f"{prefix}v_{name}")
            for of, weight in (("g", good), ("b", n)):
                sums += [F.sum(F.when(v == -1, weight).otherwise(0.0)).alias(f"{name}_{of}_bad"), F.sum(F.when(v != 0, weight).otherwise(0.0)).alias(f"{name}_{of}_all")]
        row = patterns.withColumn("good", posterior(model, prefix)).agg(*sums).first()
        if row["good"] is None:  # no rows
            return model
        rate = lambda name, of, start: (row[f"{name}_{of}_bad"] + WEIGHT * start) / (row[f"{name}_{of}_all"] + WEIGHT)  # noqa: E731, B023
        new = {"good": (row["good"] + WEIGHT * PRIOR_GOOD) / (row["good"] + row["bad"] + WEIGHT)}
        for name, *_ in RULES:
            g, b = rate(name, "g", BAD_IF_GOOD), rate(name, "b", BAD_IF_BAD)
            g = min(max(g, 1e-4), 0.5)
            new[name] = (g, min(max(b, g), 1 - 1e-4))  # a vote for bad never speaks for good
        new["good"] = min(max(new["good"], 0.01), 0.99)
        moved = max(abs(a - b) for k in new for a, b in zip(*[x[k] if k != "good" else (x[k],) for x in (new, model)], strict=True))
        model = new
        if moved < tolerance:
            break
    return model


def vote_patterns(df: DataFrame, prefix: str) -> DataFrame:
    return df.groupBy(*[f"{prefix}v_{r[0]}" for r in RULES]).agg(F.count(F.lit(1)).alias("n"))


def base_failed(prefix: str, min_words: int, max_repeat: int) -> Column:
    n = F.col(prefix + "n_words")
    return (n < min_words) | (100 * F.col(prefix + "n_repeat_words") > max_repeat * n)


def quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = 20, max_repeat: int = 30,
            threshold: float = 0.5) -> DataFrame:
    """A row per document: doc_id, the counts, base_failed, kept, and the posterior probability of being good."""
    df = saved(measured(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")), "t", "").drop("t"), "quality")
    model = estimate(saved(vote_patterns(df, "").coalesce(1), "patterns"), "")
    good, failed = posterior(model, ""), base_failed("", min_words, max_repeat)
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                     (~failed & (good >= threshold)).alias("kept"), F.round(good, 6).alias("posterior"))


def keep_good(docs: DataFrame, *, text_col: str = "text", min_words: int = 20, max_repeat: int = 30, threshold: float = 0.5) -> DataFrame:
    """The documents kept, with the columns of ``docs``. The documents are written once with their votes, so that the rules run once."""
    prefix = "q_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    failed = base_failed(prefix, min_words, max_repeat).alias(prefix + "failed")
    df = saved(measured(docs, text_col, prefix).select(*docs.columns, *[f"{prefix}v_{r[0]}" for r in RULES], failed), "votes")
    model = estimate(saved(vote_patterns(df, prefix).coalesce(1), "patterns"), prefix)
    return df.where(~F.col(prefix + "failed") & (posterior(model, prefix) >= threshold)).select(docs.columns)
