"""Shared column builders: words, lines, paragraphs, n-grams.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so that rules stay inside Catalyst and
whole-stage code generation. Regexes use only syntax that means the same in Java and RE2 (the DuckDB oracle), and
whitespace is spelled out instead of ``\\s`` because the two engines disagree on vertical tab.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word = maximal run of non-whitespace (decision 7.6.1).
WORD_RE = r"[^ \t\n\r\f\x0B]+"
# A line is blank when it holds nothing but horizontal whitespace.
NONBLANK_RE = r"[^ \t\r\f\x0B]"
# Normalised word for stop words and shingles: letters and digits only, taken from the lowercased text.
NORM_WORD_RE = r"[\p{L}\p{N}]+"
ALPHA_RE = r"\p{L}"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text: str | Column) -> Column:
    """Whitespace tokens, in order."""
    return F.regexp_extract_all(col_(text), F.lit(WORD_RE), 0)


def norm_words(text: str | Column) -> Column:
    """Lowercased letter/digit tokens (stop words, shingles)."""
    return F.regexp_extract_all(F.lower(col_(text)), F.lit(NORM_WORD_RE), 0)


def lines(text: str | Column) -> Column:
    """Lines split on ``\\n``, trailing empty line kept (same as DuckDB ``string_split``)."""
    return F.split(col_(text), "\n", -1)


def nonblank(arr: Column) -> Column:
    return F.filter(arr, lambda x: x.rlike(NONBLANK_RE))


def paragraphs(text: str | Column) -> Column:
    """Blocks separated by two or more newlines."""
    return F.split(col_(text), "\n\n+", -1)


def count_substr(text: Column, s: str) -> Column:
    """Non-overlapping occurrences of a literal string."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(s), F.lit("")))) / F.lit(len(s))).cast("bigint")


def total_length(arr: Column) -> Column:
    """Sum of character lengths of a string array (0 for empty); its strings aren't null."""
    return F.length(F.array_join(arr, "")).cast("bigint")


def n_dup(arr: Column) -> Column:
    """Number of second-and-later occurrences."""
    return (F.size(arr) - F.size(F.array_distinct(arr))).cast("bigint")


def dup_chars(arr: Column) -> Column:
    """Characters in second-and-later occurrences of equal elements."""
    return total_length(arr) - total_length(F.array_distinct(arr))


def ngram_strings(ws: Column, n: int) -> Column:
    """All word n-grams joined by one space (empty when fewer than n words)."""
    return F.when(F.size(ws) >= n,
                  F.transform(F.sequence(F.lit(1), F.size(ws) - n + 1),
                              lambda i: F.array_join(F.slice(ws, i, n), " "))
                  ).otherwise(F.array().cast("array<string>"))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    A lambda body that refers to an outer array expression re-evaluates it for every element; binding it to a
    lambda variable first keeps per-document work linear.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def materialize(df, keep: list[str], **cols: Column):
    """Compute ``cols`` once per row behind a ``Generate`` (``inline`` of a one-element array).

    The optimizer pushes a filter on a projected expression below the projection (and below a repartition),
    copying the expression into the filter. Predicates on generated columns stay above the ``Generate``, so each
    expensive column is evaluated once, after any ``spread`` repartition.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def ratio(num: Column, den: Column) -> Column:
    """num/den as double, 0 when den is 0 (decision 7.6.8)."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))
