import math
import random

from textsift.llm import topk as T


def brute(rows, k=20, every=20):
    best = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or math.isnan(x) or math.isinf(x) for x in v):
            continue
        best[i] = min(best.get(i, v), v)
    ints = {i: [math.floor(64 * x) for x in v] for i, v in best.items()}
    out = []
    for q in sorted(ints):
        if q % every == 0:
            s = [(-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(ints[q], v)))), i) for i, v in ints.items() if i != q and len(v) == len(ints[q])]
            out += [(q, r, i, -n) for r, (n, i) in enumerate(sorted(s)[:k], 1)]
    return out


def check(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1.0, "x") for i, v in rows], "vec_id long, embedding array<double>, score double, rank string")
    got = sorted(map(tuple, T.top_k(df, **options).collect()))
    assert got == sorted(brute(rows, options.get("k", 20)))


def test_against_brute_force(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(6)]) for i in range(700)]
    rows += [(700 + i, [0.5] * 6) for i in range(300)]  # ties
    rows += [(0, [0.1] * 6), (20, None), (40, [1.0, None]), (2000, [float("nan")] * 6), (2020, [float("inf")] * 6), (None, [0.1] * 6), (1020, []), (1021, []), (1040, [1.0, 2.0]), (2040, [3.0])]
    check(spark, rows)
    check(spark, rows, k=3, part_rows=60, query_block=7)
    assert T.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_large_components_are_exact(spark):
    rows = [(i, [float(2**40 + i), float(3 * i)]) for i in range(30)] + [(60, [1e300, 1.0]), (61, [-1e300, 1.0])]
    check(spark, rows)
