import math
import random
import re

import regex

from textsift.llm import quality as Q


def base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    inside = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside), n < 20 or 100 * len(inside) > 30 * n


def test_base_against_plain_counts(spark):
    rnd = random.Random(4)
    v = [f"wort{k}" for k in range(300)]
    texts = [None, "", " \n\t", "x", "a b c d e f g h " * 2, "a b c d e f g h", "x " * 3000, "\U0001F600é " * 30, "l1 x\nl1 x\n\n \n \nl1 x", "#*$%&|<> " * 25, "a b c d e f g h i " * 9, "w" * 100000]
    for _ in range(60):
        t = [rnd.choice(v) for _ in range(rnd.randrange(120))]
        if t and rnd.random() < 0.5:
            a = rnd.randrange(len(t))
            t = t + t[a:a + rnd.randrange(30)]
        texts.append(rnd.choice([" ", "\n", "\x0b", "\f", "\r\n"]).join(t))
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, t string")
    got = {r.doc_id: r for r in Q.quality(df).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t), (i, t and t[:80])
        assert not (r.kept and r.base_failed)
    kept = Q.keep_good(df).collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i, r in got.items() if r.kept) and set(kept[0].asDict()) == set(df.columns)
    assert Q.quality(df.limit(0)).count() == 0 == Q.keep_good(df.limit(0)).count()


def test_estimates_agree_with_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = Q.quality(docs).join(labels, "doc_id").where("not base_failed").collect()
    right = sum(r.kept == (r.quality == 1) for r in got)
    assert right >= 0.97 * len(got)
    clean = [r for r in got if r.quality == 1]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)


def plain_votes(t):
    t = t or ""
    n, chars, symbols, again, inside, _ = base(t)
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in t.split("\n"))
    marks = sum(len(regex.findall(r"[^\p{L}\p{M}\p{N}]", x)) for x in w)
    shares = [(symbols, n, ">", .10, .03), (again, lines, ">", .40, .10), (inside, n, ">", .25, .05), (sum(bool(regex.search(r"\p{L}", x)) for x in w), n, "<", .70, .90),
              (len(regex.findall(r"\p{Lu}", t)), chars, ">", .30, .15), (marks, chars, ">", .20, .10), (sum(a == b for a, b in zip(w, w[1:], strict=False)), n, ">", .20, .05),
              (chars, n, "<", 2.5, 3.5), (chars, n, ">", 15.0, 10.0)]
    out = []
    for a, b, side, bad, good in shares:
        sign = 1 if side == ">" else -1
        out.append(0 if not b else -1 if sign * (a / b) > sign * bad else 1 if sign * (a / b) <= sign * good else 0)
    return out


def plain_posteriors(votes, rounds=25):
    """EM document by document: q of a document from its votes, then the rules' rates from all q."""
    k = len(votes[0])
    share, rate = 0.85, [[0.03] * k, [0.40] * k]  # of bad votes, when it votes: good documents, bad documents

    def q(v):
        like = [share, 1 - share]
        for c, r in enumerate(rate):
            for x, p in zip(v, r, strict=True):
                like[c] *= p if x < 0 else 1 - p if x > 0 else 1
        return like[0] / sum(like)
    for _ in range(rounds):
        qs = [q(v) for v in votes]
        mass = [qs, [1 - x for x in qs]]
        new = [[(sum(m for m, v in zip(mass[c], votes, strict=True) if v[j] < 0) + 5 * s) / (sum(m for m, v in zip(mass[c], votes, strict=True) if v[j]) + 5) for j in range(k)]
               for c, s in ((0, 0.03), (1, 0.40))]
        new[0] = [min(max(x, 1e-4), 0.5) for x in new[0]]
        new[1] = [min(max(b, g), 1 - 1e-4) for g, b in zip(*new, strict=True)]
        s = min(max((sum(qs) + 5 * 0.85) / (len(qs) + 5), 0.01), 0.99)
        moved = max(abs(a - b) for a, b in zip([s, *new[0], *new[1]], [share, *rate[0], *rate[1]], strict=True))
        share, rate = s, new
        if moved < 1e-4:
            break
    return [q(v) for v in votes]


def test_verdicts_against_plain_estimation(spark):
    rnd = random.Random(9)
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    texts = [r.text for r in rows] + [None, "", "!?. " * 40, "ALL CAPITALS HERE " * 20, "x " * 50, "w" * 5000, "12 34 " * 30]
    texts += [" ".join(rnd.choice(["#", "Wort", "ab", "$$", "GROSS", "lang" * 6, "4", "...", "text"]) for _ in range(rnd.randrange(15, 80))) for _ in range(150)]
    got = {r.doc_id: r for r in Q.quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)).collect()}
    want = plain_posteriors([plain_votes(t) for t in texts])
    assert len({round(x, 3) for x in want}) > 10
    for i, (t, q) in enumerate(zip(texts, want, strict=True)):
        assert math.isclose(got[i].posterior, q, abs_tol=2e-6), (i, got[i].posterior, q)
        if abs(q - 0.5) > 1e-6:
            assert got[i].kept == (q >= 0.5 and not base(t)[-1])


def test_rules_run_once(spark):
    docs = spark.createDataFrame([(i, "some words of a text " * i) for i in range(40)], "doc_id long, text string")
    plan = Q.keep_good(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "split" not in plan and "xxhash64" not in plan
