"""Toxicity by classifier chains (operator 10).

The categories are predicted one after another, each by a logistic model over the words of a text and the
probabilities of the categories before it. While training, those probabilities are out-of-fold predictions: a
document's come from models that haven't seen it, so a later model learns how far earlier ones can be trusted.

Features are the distinct words of a text (lower case, without the marks around them) and their first letters
(``PREFIXES``), present or not. A model keeps the ``features`` that tell its category apart best on its training rows.

Scale: the models are fitted on at most ``sample_rows`` labelled rows (a parameter; rows in the order of a hash of
their id). Spark counts their features and picks those that differ between the categories' values; the rows' picked features,
about a hundred each, reach the driver. Every document is scored whole in one narrow pass; the models
travel with the tasks and have at most ``features`` weights for each category.

Defined cases: a null or empty text has no features and gets the probabilities of the intercepts. Labels that are null
take no part; of several label rows of an id the largest labels count. A category without labelled rows, or
with one value only, gets that value's smoothed share as its constant probability. Rows without id are scored too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsift.llm.common import saved

PREFIXES = (4, 5, 6)
EDGE = re.compile(r"^\W+|\W+$")
WORDS_KEPT = 1 << 18


def features_of(word: str) -> list[int]:
    """32-bit features of a word as it stands in the text."""
    word = EDGE.sub("", word.lower())
    return [xxhash.xxh32_intdigest(f"{n}:{word[:n]}") for n in PREFIXES if len(word) > n] + [xxhash.xxh32_intdigest(word)] if word else []


class Features(dict):
    """word -> its features, those in ``only`` if given."""

    def __init__(self, only: set[int] | None = None):
        self.only = only

    def __missing__(self, word: str) -> list[int]:
        got = features_of(word)
        if self.only is not None:
            got = [f for f in got if f in self.only]
        if len(self) > WORDS_KEPT:
            self.clear()
        self[word] = got
        return got

    def of_text(self, text: str | None) -> set[int]:
        return {f for got in map(self.__getitem__, set((text or "").split())) if got for f in got}


class Rows:
    """Sparse 0/1 rows: feature numbers (0 ... width - 1) of each row, one after another."""

    def __init__(self, sets: list[np.ndarray], width: int | None = None):
        self.n = len(sets)
        self.col = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(self.n), [len(s) for s in sets])
        self.width = int(self.col.max(initial=-1)) + 1 if width is None else width

    def select(self, rows: np.ndarray, known: np.ndarray | None = None) -> Rows:
        """The given rows; with ``known``, only these features, numbered by their place in it."""
        place = np.full(self.n, -1)
        place[rows] = np.arange(len(rows))
        ok = place[self.row] >= 0
        col, row = self.col[ok], place[self.row[ok]]
        out = Rows([], self.width)
        if known is not None:
            number = np.full(self.width, -1)
            number[known] = np.arange(len(known))
            ok = number[col] >= 0
            col, row, out.width = number[col[ok]], row[ok], len(known)
        out.n, out.col, out.row = len(rows), col, row
        return out

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n)

    def turned(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, r[self.row], self.width)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def minimise(f, x: np.ndarray, rounds: int = 60, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking; ``f`` returns value and gradient."""
    value, g = f(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, back = g.copy(), []
        for s, y in reversed(steps):
            a = s @ q / (s @ y)
            q -= a * y
            back.append(a)
        if steps:
            q *= (steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1])
        for (s, y), a in zip(steps, reversed(back), strict=True):
            q += (a - y @ q / (s @ y)) * s
        t = 1.0 if steps else 1 / max(1.0, np.abs(g).sum())
        while True:
            new_value, new_g = f(x - t * q)
            if new_value <= value - 1e-4 * t * (g @ q) or t < 1e-10:
                break
            t /= 2
        s, y = -t * q, new_g - g
        if s @ y > 1e-10:
            steps = [*steps[1 - memory:], (s, y)]
        done = value - new_value < 1e-6 * max(1.0, abs(value))
        x, value, g = x + s, new_value, new_g
        if done:
            break
    return x


def best_features(rows: Rows, y: np.ndarray, most: int, least: int = 3) -> np.ndarray:
    """The features whose shares among 1s and 0s differ most, in standard errors; ascending."""
    pos = rows.turned(y)
    n = np.bincount(rows.col, minlength=rows.width)
    share = y.mean()
    z = np.abs(pos - n * share) / np.sqrt(n * share * (1 - share) + 1e-9)
    z[n < least] = 0
    top = np.argsort(-z, kind="stable")[:most]
    return np.sort(top[z[top] > 1])


def fit(rows: Rows, train: np.ndarray, earlier: np.ndarray, y: np.ndarray, most: int, ridge: float = 1.0) -> dict:
    """Logistic model on the rows ``train``; ``earlier``: probabilities of the categories before, a column each."""
    t = y[train].astype(float)
    if len(t) == 0 or t.min() == t.max():
        p = (t.sum() + 0.5) / (len(t) + 1) if len(t) else 0.0
        return {"known": np.zeros(0, np.int64), "w": np.zeros(0), "e": np.zeros(earlier.shape[1]), "b": float(np.log((p + 1e-9) / (1 - p + 1e-9)))}
    known = best_features(rows.select(train), t, most)
    x, e, k = rows.select(train, known), earlier[train], len(known)

    def loss(v):
        z = x.times(v[:k]) + e @ v[k:-1] + v[-1]
        p = sigmoid(z)
        value = np.sum(np.logaddexp(0, z) - t * z) + ridge / 2 * np.sum(v[:-1] ** 2)
        return value, np.concatenate([x.turned(p - t), e.T @ (p - t), [np.sum(p - t)]]) + ridge * np.concatenate([v[:-1], [0]])
    start = np.zeros(k + e.shape[1] + 1)
    start[-1] = np.log(t.mean() / (1 - t.mean()))
    v = minimise(loss, start)
    return {"known": known, "w": v[:k], "e": v[k:-1], "b": float(v[-1])}


def predict(model: dict, rows: Rows, which: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    return sigmoid(rows.select(which, model["known"]).times(model["w"]) + earlier[which] @ model["e"] + model["b"])


def fit_chain(rows: Rows, labels: np.ndarray, folds: np.ndarray, most: int) -> tuple[list[dict], np.ndarray]:
    """A model for each column of ``labels`` (NaN: not labelled), and the out-of-fold probabilities."""
    earlier, models = np.zeros((rows.n, 0)), []
    for y in labels.T:
        known = ~np.isnan(y)
        out = np.zeros(rows.n)
        for f in np.unique(folds):
            out[folds == f] = predict(fit(rows, np.nonzero(known & (folds != f))[0], earlier, y, most), rows, np.nonzero(folds == f)[0], earlier)
        models.append(fit(rows, np.nonzero(known)[0], earlier, y, most))
        earlier = np.column_stack([earlier, out])
    return models, earlier


# --- Spark ---------------------------------------------------------------------------------------------------------

def selected(sample: DataFrame, names: list[str], most: int, least: int = 3) -> set[int]:
    """At most ``most`` features of the sample that tell some category apart: a first choice, made by Spark; every model
    then chooses among them from its own training rows."""
    shares = sample.agg(*[F.avg(n).alias(n) for n in names]).first()
    sums = [x for n in names for x in (F.sum(n).alias(f"p_{n}"), F.count(n).alias(f"m_{n}"))]
    counts = sample.select(*names, F.explode("f").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n"), *sums).where(F.col("n") >= least)
    scores = [F.abs(F.coalesce(f"p_{n}", F.lit(0)) - F.col(f"m_{n}") * s) / F.sqrt(F.col(f"m_{n}") * (s * (1 - s)) + 1e-9) for n, s in zip(names, shares, strict=True) if s is not None]
    if not scores:
        return set()
    score = F.greatest(*scores, F.lit(0.0)).alias("score")
    return {r["f"] for r in counts.select("f", score).where("score > 1").orderBy(F.desc("score"), "f").limit(most).collect()}


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], *, id_col: str = "doc_id", text_col: str = "text",
          sample_rows: int = 20_000, features: int = 2_000, folds: int = 4) -> list[dict]:
    """The chain's models. ``categories``: name -> 0/1 column of ``labels``, in the chain's order."""
    names = [f"c{k}" for k in range(len(categories))]
    marks = labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("lid"), *[c.cast("int").alias(n) for n, c in zip(names, categories.values(), strict=True)])
    marks = marks.groupBy("lid").agg(*[F.max(n).alias(n) for n in names]).where(F.coalesce(*names).isNotNull())
    marks = marks.withColumn("h", F.xxhash64("lid")).orderBy("h", "lid").limit(sample_rows)
    # the marks are at most sample_rows narrow rows
    texts = docs.select(F.col(id_col).cast("bigint").alias("lid"), F.col(text_col).cast("string").alias("t"))
    own = texts.join(F.broadcast(marks), "lid").select("h", *names, "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features()
        for b in batches:
            got = [sorted(known.of_text(t)) for t in b.column(len(names) + 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, pa.list_(pa.int64()))], ["h", *names, "f"])
    schema = "h bigint, " + ", ".join(f"{n} int" for n in names) + ", f array<bigint>"
    sample = saved(own.mapInArrow(run, schema), "sample")
    if sample.count() > sample_rows:  # documents that repeat an id exceed the bound: the sample is cut again
        sample = saved(sample.orderBy("h", F.hash("f")).limit(sample_rows), "sample")
    kept = selected(sample, names, 2 * features)

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [[f for f in row if f in kept] for row in b.column(len(names) + 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, pa.list_(pa.int64()))], ["h", *names, "f"])
    sample = sample.mapInArrow(only, schema).toArrow()
    # feature numbers while fitting, the features themselves in the models
    names_of, numbers = np.unique(sample.column("f").combine_chunks().flatten().to_numpy(), return_inverse=True)
    rows = Rows(np.split(numbers, np.cumsum([len(x) for x in sample.column("f")])[:-1]) if sample.num_rows else [], len(names_of))
    y = np.column_stack([sample.column(n).to_numpy(zero_copy_only=False).astype(float) for n in names]) if sample.num_rows else np.zeros((0, len(names)))
    h = sample.column("h").to_numpy() if sample.num_rows else np.zeros(0, np.int64)
    models = fit_chain(rows, y, (h >> 8) % folds, features)[0]
    return [m | {"known": names_of[m["known"]]} for m in models]


def score(docs: DataFrame, models: list[dict], names: list[str], *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.4) -> DataFrame:
    """(doc_id, p_<category>..., <category>...): probabilities and decisions of every document."""
    tables = [dict(zip(m["known"].tolist(), m["w"].tolist(), strict=True)) for m in models]
    only = set().union(*tables)
    chain = [(m["e"].tolist(), m["b"]) for m in models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features(only)
        for b in batches:
            out: list[list[float]] = [[] for _ in chain]
            for t in b.column(1):
                found, before = known.of_text(t.as_py()), []
                for table, (e, bias), column in zip(tables, chain, out, strict=True):
                    z = bias + sum(table.get(f, 0.0) for f in sorted(found)) + sum(w * p for w, p in zip(e, before, strict=True))
                    before.append(float(sigmoid(z)))
                    column.append(before[-1])
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, out)], ["doc_id", *[f"p{k}" for k in range(len(out))]])
    schema = "doc_id bigint, " + ", ".join(f"p{k} double" for k in range(len(models)))
    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(run, schema)
    return rows.select("doc_id", *[F.round(f"p{k}", 6).alias(f"p_{n}") for k, n in enumerate(names)], *[(F.col(f"p{k}") >= threshold).alias(n) for k, n in enumerate(names)])


def toxicity(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], **options) -> DataFrame:
    """Train the chain on the labelled documents and score all of them."""
    columns = {k: options[k] for k in ("id_col", "text_col") if k in options}
    return score(docs, train(docs, labels, categories, **options), list(categories), **columns)


def label_chain() -> dict[str, Column]:
    """The categories of the table ``labels``: junk (quality 0), then toxic."""
    return {"junk": 1 - F.col("quality"), "toxic": F.col("toxic")}
