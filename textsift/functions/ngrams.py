"""Word n-gram repetition metrics (rules R2-R10) as one Arrow-batched pandas UDF.

Counting n-grams is the one rule family that built-in functions express only through nested higher-order
functions (sort + scan per n), which run interpreted: at sf0.01 that was about 2.5 s per n-gram size, against
well under a second for all nine sizes here. The helper is small and per document; Spark still partitions the
documents and nothing leaves the executor. The Catalyst forms stay in ``rules.py`` (``engine="catalyst"``).
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

TOP_NS = (2, 3, 4)
DUP_NS = (5, 6, 7, 8, 9, 10)
FIELDS = tuple(f"top_{n}gram_chars" for n in TOP_NS) + tuple(f"dup_{n}gram_chars" for n in DUP_NS)
_FIELD = re.compile(r"(top|dup)_([0-9]+)gram_chars")


def sizes(fields: tuple[str, ...], kind: str) -> tuple[int, ...]:
    return tuple(sorted(int(m[2]) for m in map(_FIELD.fullmatch, fields) if m[1] == kind))


def metrics(text: str, tops: tuple[int, ...] = TOP_NS, dups: tuple[int, ...] = DUP_NS) -> tuple[int, ...]:
    """``top`` (count * length of the most frequent n-gram, ties: the longer one; 0 when there is none) for each size in
    ``tops``, then ``dup`` (characters of words covered by second-and-later occurrences, each word once) for ``dups``.

    N-grams are numbered from the numbers of the n-grams one word shorter, so equal numbers mean equal n-grams
    (exact, no hashing), and each size costs one sort of whole numbers. From the size on at which no n-gram
    repeats, none needs numbering.
    """
    raw = text.encode()
    words = raw.split()  # the white space of bytes is that of WORD_RE
    k = len(words)
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, k)
    lens = np.fromiter(map(len, number) if len(raw) == len(text) else (len(w.decode()) for w in number), np.int64, len(number))[ids]
    ends = np.concatenate([[0], np.cumsum(lens)])
    got: dict[tuple[str, int], int] = {}
    grams, repeats = ids, len(number) < k
    for n in range(1, min(max((0, *tops, *dups)), k) + 1):
        m = k - n + 1
        if n > 1 and repeats:
            values, first, grams = np.unique(grams[:m] * max(1, len(number)) + ids[n - 1:], return_index=True, return_inverse=True)
            repeats = len(values) < m
        elif repeats and n in dups:
            first = np.unique(grams, return_index=True)[1]
        if n in tops:
            chars = ends[n:] - ends[:m] + n - 1
            if repeats:
                count = np.bincount(grams)
                got["top", n] = int(count.max() * chars[count[grams] == count.max()].max())
            else:
                got["top", n] = int(chars.max())
        if n in dups and repeats:
            later = np.ones(m, dtype=bool)
            later[first] = False
            at = np.flatnonzero(later)
            cover = np.zeros(k + 1, dtype=np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + n, -1)
            got["dup", n] = int(lens[np.cumsum(cover[:k]) > 0].sum())
    return tuple(got.get(("top", n), 0) for n in tops) + tuple(got.get(("dup", n), 0) for n in dups)


def ngram_metrics(text: Column, need: Column | None = None, fields: tuple[str, ...] = FIELDS) -> Column:
    """Struct of the metrics ``fields`` (``top_<n>gram_chars``, ``dup_<n>gram_chars``, any n) of each document.

    ``need`` (boolean) skips documents whose outcome is already decided by an earlier, cheaper rule: their
    metrics are null and never read (the waterfall's ``CASE`` stops before them).
    """
    tops, dups = sizes(fields, "top"), sizes(fields, "dup")
    names = [f"top_{n}gram_chars" for n in tops] + [f"dup_{n}gram_chars" for n in dups]
    nulls = (None,) * len(names)

    @F.pandas_udf(Ty.StructType([Ty.StructField(n, Ty.LongType()) for n in names]))
    def udf(texts: pd.Series, wanted: pd.Series) -> pd.DataFrame:
        rows = [metrics(t, tops, dups) if n and t is not None else nulls for t, n in zip(texts, wanted)]
        return pd.DataFrame(rows, columns=names, dtype="Int64")

    # Marked non-deterministic only so that the optimizer never pushes a filter on a rule outcome below the UDF's
    # projection (a Python UDF inside a pushed-down CASE cannot be evaluated there). The values are deterministic.
    return udf.asNondeterministic()(text, F.coalesce(need, F.lit(False)) if need is not None else F.lit(True))
