import random
import re

import numpy as np
from pyspark.sql import functions as F

from textsift.llm import toxicity as T


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)) == 0
    models = T.train(docs, labels.where(~held), T.label_chain())
    got = T.score(docs, models, ["junk", "toxic"]).join(labels.where(held).withColumnRenamed("toxic", "y"), "doc_id").where("quality = 1").collect()
    toxic, clean = [r for r in got if r.y == 1], [r for r in got if r.y == 0]
    assert sum(r.toxic for r in toxic) >= 0.85 * len(toxic) and sum(r.toxic for r in clean) <= 0.01 * len(clean)


def test_edges(spark):
    rows = [(i, "you idiot thing" if i % 3 == 0 else f"nice word{i}") for i in range(60)] + [(100, None), (101, ""), (None, "idiot!!"), (1, "nice word1"), (102, "x" * 200000), (103, "idiot " * 30000)]
    docs = spark.createDataFrame([(i, t, 1.0, 2) for i, t in rows], "doc_id long, text string, h double, p0 int")
    labels = spark.createDataFrame([(i, None if i == 5 else 1, int(i % 3 == 0)) for i in range(40)] + [(0, 1, 1), (None, 0, 0), (900, 0, 1)], "doc_id long, quality int, toxic int")
    got = T.toxicity(docs, labels, T.label_chain(), sample_rows=1000).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[None].toxic and by[103].toxic and by[57].toxic and not by[58].toxic and not by[100].toxic and by[100].p_toxic == by[101].p_toxic and not by[1].junk
    none = T.toxicity(docs, labels.limit(0), T.label_chain()).collect()
    assert len(none) == len(rows) and not any(r.toxic or r.junk for r in none)
    assert T.toxicity(docs.limit(0), labels, T.label_chain()).count() == 0


def test_chain_uses_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    x = [np.flatnonzero(rng.random(30) < 0.3) for _ in range(400)]
    first = np.array([float(3 in r) for r in x])
    flip = np.where(rng.random(400) < 0.1, 1 - first, first)
    models, out = T.fit_chain(T.Rows(x), np.column_stack([first, flip]), np.arange(400) % 4, 20)
    assert models[1]["e"][0] > 1 and ((out[:, 0] > 0.5) == (first > 0.5)).mean() > 0.97


def plain_features(t):
    out = set()
    for w in (t or "").split():
        w = re.sub(r"^\W+|\W+$", "", w.lower())
        out |= {("word", w)} | {(n, w[:n]) for n in (4, 5, 6) if len(w) > n} if w else set()
    return out


def plain_model(x, y):
    """Logistic regression with an L2 penalty of 1/2 on all but the intercept, by Newton steps on dense rows."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge, v = np.diag([1.0] * (x.shape[1] - 1) + [0.0]), np.zeros(x.shape[1])
    v[-1] = np.log(y.mean() / (1 - y.mean()))
    for _ in range(40):
        p = 1 / (1 + np.exp(-x @ v))
        v -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge + 1e-9 * np.eye(len(v)), x.T @ (p - y) + ridge @ v)
    return v


def plain_standouts(x, y):
    n, pos, share = x.sum(0), x.T @ y, y.mean()
    return (n >= 3) & (np.abs(pos - n * share) / np.sqrt(n * share * (1 - share) + 1e-9) > 1)


def test_against_plain_chain(spark):
    rnd = random.Random(5)
    words = [f"term{chr(97 + k % 26)}{k}" for k in range(60)]
    texts, marks = [], []
    for _ in range(300):
        t = rnd.choices(words, k=rnd.randrange(3, 25))
        junk = sum(w in words[:8] for w in t) + rnd.random() > 2.3
        toxic = sum(w in words[5:15] for w in t) + 1.5 * junk + rnd.random() > 3.2
        texts.append(" ".join(rnd.choice([w, w.upper(), f"({w})", w + "!"]) for w in t))
        marks.append((int(junk), int(toxic)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, None if i % 17 == 0 else 1 - a, b) for i, (a, b) in enumerate(marks) if i < 240], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in T.toxicity(docs, labels, T.label_chain(), features=100_000).collect()}

    fold = {r.doc_id: (r.h >> 8) % 4 for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    sets = [plain_features(t) for t in texts]
    names = sorted(set().union(*sets), key=str)
    x = np.array([[float(f in s) for f in names] for s in sets])
    fold = np.array([fold[i] for i in range(300)])
    y = np.array([[np.nan if i % 17 == 0 or i >= 240 else a, np.nan if i >= 240 else b] for i, (a, b) in enumerate(marks)], float)
    first = np.zeros(len(names), bool)
    for c in y.T:  # over the labelled sample, as Spark's first choice
        ok = ~np.isnan(c)
        first |= plain_standouts(x[ok], c[ok])
    first &= x[:240].sum(0) >= 3
    x = x[:, first]
    folded, final = np.zeros((300, 0)), np.zeros((300, 0))

    def one(rows, c, e, to, e_to):
        keep = plain_standouts(x[rows], c[rows])
        v = plain_model(np.column_stack([x[rows][:, keep], e[rows]]), c[rows])
        return 1 / (1 + np.exp(-np.column_stack([x[to][:, keep], e_to[to], np.ones(len(to))]) @ v))
    for c in y.T:
        ok, out = ~np.isnan(c), np.zeros(300)
        for f in range(4):
            to = np.nonzero(fold == f)[0]
            out[to] = one(np.nonzero(ok & (fold != f))[0], c, folded, to, folded)
        last = one(np.nonzero(ok)[0], c, folded, np.arange(300), final)
        folded, final = np.column_stack([folded, out]), np.column_stack([final, last])
    p = np.array([[got[i].p_junk, got[i].p_toxic] for i in range(300)])
    assert 0.1 < np.nanmean(y[:, 1]) < 0.9 and np.abs(p - final).max() < 0.02, np.abs(p - final).max()
