import random

from pyspark.sql import functions as F

from textsift.llm import mixing as M
from textsift.llm import packing as K


def fill(budget, nodes, weights):
    """Shares of a budget among {name: cap}: level by level, plain."""
    out, rest, left = {}, budget, dict(nodes)
    while left:
        w = sum(weights.get(k, 1) for k in left)
        full = [k for k, cap in left.items() if cap * w <= rest * weights.get(k, 1)]
        if not full:
            out |= {k: rest * weights.get(k, 1) // w for k in left}
            break
        for k in full:
            out[k] = left.pop(k)
        rest = budget - sum(out.values())
    return out


def test_budgets_against_plain_filling(spark):
    rnd = random.Random(8)
    leaves = {(f"d{a}", f"l{b}", f"s{c}"): rnd.choice([1, 50, 400, 9000]) for a in range(3) for b in range(3) for c in range(rnd.randrange(1, 5))}
    weights = {"domain": {"d0": 7, "d1": 2}, "lang": {"l1": 5}, "source": {"s0": 3, "s2": 4}}
    df = spark.createDataFrame([(*k, n, 2 * n) for k, n in leaves.items()], "domain string, lang string, source string, tokens long, cap long")
    for budget in (0, 17, 5000, 40000, 10**9):
        got = {(r.domain, r.lang, r.source): r.budget for r in M.leaf_budgets(df, ["domain", "lang", "source"], weights, budget).collect()}
        want, cap = {}, {k: 2 * n for k, n in leaves.items()}
        total = lambda p: sum(v for k, v in cap.items() if k[:len(p)] == p)  # noqa: E731, B023
        for d, b in fill(min(budget, total(())), {k[0]: total(k[:1]) for k in cap}, weights["domain"]).items():
            for g, c in fill(b, {k[1]: total(k[:2]) for k in cap if k[0] == d}, weights["lang"]).items():
                want |= {(d, g, s): v for s, v in fill(c, {k[2]: total(k) for k in cap if k[:2] == (d, g)}, weights["source"]).items()}
        assert got == want


def test_mixture_edges(spark):
    rows = [(1, "a b c", "en", "src1"), (1, "a b c", "en", "src1"), (2, None, "en", "src1"), (3, "", None, None), (None, "x y", None, None), (None, "x y z", None, "src2"), (4, "w " * 5000, "de", "nonumber")]
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], "doc_id long, text string, lang string, source string, key string, copies int")
    got = M.mixture(df, M.document_levels(), M.WEIGHTS, budget=(2, 1), max_epochs=2).collect()
    assert sum(r.copies * r.n_tokens + r.last_tokens for r in got) == 2 * (3 + 3 + 2 + 3 + 5000)
    some = M.mixture(df, M.document_levels(), M.WEIGHTS, budget=(1, 2), max_epochs=1).collect()
    assert all(0 < r.copies * r.n_tokens + r.last_tokens <= r.n_tokens for r in some)
    kept = M.select_documents(df, M.document_levels(), M.WEIGHTS, budget=(1, 1))
    assert kept.columns == df.columns and kept.count() == 5
    assert M.mixture(df.limit(0), M.document_levels(), M.WEIGHTS).count() == 0 == M.select_documents(df.limit(0), M.document_levels(), M.WEIGHTS).count()


def padding(lengths, counts, upper):
    return sum(c * (min(u for u in upper if u >= n) - n) for n, c in zip(lengths, counts))


def test_boundaries_against_all_choices():
    from itertools import combinations
    rnd = random.Random(2)
    for _ in range(25):
        lengths = sorted(rnd.sample(range(1, 60), rnd.randrange(1, 9)))
        counts = [rnd.randrange(1, 30) for _ in lengths]
        for k in (1, 2, 3, 9):
            best = min(padding(lengths, counts, [*c, lengths[-1]]) for n in range(min(k, len(lengths))) for c in combinations(lengths[:-1], n))
            got = K.best_boundaries(lengths, counts, k)
            assert len(got) <= k and got[-1] == lengths[-1] and padding(lengths, counts, got) == best
    assert K.best_boundaries([], [], 4) == []


def test_pack_edges(spark):
    rows = [(1, "a " * 25), (2, None), (3, ""), (None, "x y"), (4, "z"), (4, "z"), (5, "w " * 1000)] + [(10 + i, "t " * (i % 9 + 1)) for i in range(200)]
    df = spark.createDataFrame([(i, t, 0, 1) for i, t in rows], "doc_id long, text string, bucket int, n int")
    got = K.pack(df, max_tokens=10, buckets=3, batch_tokens=40).collect()
    words = sum(len((t or "").split()) for _, t in rows)
    assert sum(r.n_tokens for r in got) == words and all(r.n_tokens <= r.bucket_length for r in got)
    assert sorted(r.start for r in got if r.doc_id == 1) == [0, 10, 20]
    for b in {r.bucket for r in got}:
        own = [r for r in got if r.bucket == b]
        room = 40 // own[0].bucket_length
        assert sorted((r.batch, r.slot) for r in own) == [(i // room, i % room) for i in range(len(own))]
    assert K.pack(df.limit(0)).count() == 0 and K.pack(df.where(F.col("doc_id") == 2)).count() == 0
