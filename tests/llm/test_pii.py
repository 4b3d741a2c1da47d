import hashlib
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from textsift.llm import pii as P


def base(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(x) for x in re.sub(r"[^0-9]", "", m.group())]
        s = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d[::-1]))
        if 16 <= len(d) <= 19 and s % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def plain_contexts(left, right):
    """Patterns of a span from all the text on either side."""
    space = " \t\n\x0b\f\r"
    word = f"[^{space}]"
    norm = lambda t: [w for w in re.split(f"[{space}]+", re.sub("[0-9]", "0", t.lower())) if w]
    a, b = norm(re.sub(rf"(?<!{word}){word}+\Z", "", left)), norm(re.sub(rf"\A{word}+", "", right))
    return [*(["2 " + " ".join(a[-2:])] if len(a) > 1 else []), *(["1 " + a[-1]] if a else []), *(["r " + b[0]] if b else [])]


def plain_candidates(t, spans, min_length=5):
    edge = "\"'`(),.;:!?[]{}<>"
    for m in re.finditer("[^ \t\n\x0b\f\r]+", t):
        if re.search("[0-9@]", m.group()):
            x = m.group().strip(edge)
            s = m.start() + len(m.group()) - len(m.group().lstrip(edge))
            if len(x) >= min_length and not any(a < s + len(x) and s < b for _, a, b in spans):
                yield s, s + len(x)


def plain_pii(texts, rounds=2, reliable=0.8, min_support=5):
    """All spans of each text, by dictionaries over the whole graph."""
    occ, kinds = [], {}
    for d, t in enumerate(texts):
        spans = base(t)
        for k, a, b in [*[(P.KINDS.index(k), a, b) for k, a, b in spans], *[(None, a, b) for a, b in plain_candidates(t, spans)]]:
            ps = plain_contexts(t[:a], t[b:])
            occ.append((d, k, a, b, ps))
            for p in ps:
                kinds.setdefault((t[a:b].lower(), p), set()).update([k] if k is not None else [])
    size, support = Counter(p for _, p in kinds), Counter((p, k) for (_, p), ks in kinds.items() for k in ks)
    support = {x: n for x, n in support.items() if n >= min_support}
    score = {(p, k): n / (size[p] + 1) for (p, k), n in support.items()}
    for _ in range(rounds):
        instance = {}
        for (i, p), ks in kinds.items():
            for k in range(len(P.KINDS)) if not ks else ():
                if score.get((p, k), 0) >= reliable / 2:
                    instance[i, k] = max(instance.get((i, k), 0), score[p, k])
        score = {(p, k): (n + sum(instance.get((i, k), 0) for (i, q), ks in kinds.items() if q == p and not ks)) / (size[p] + 1) for (p, k), n in support.items()}
    out = [[(P.KINDS.index(k), a, b) for k, a, b in base(t)] for t in texts]
    for d, k, a, b, ps in occ:
        best = max(((score[p, j], -j) for p in ps for j in range(len(P.KINDS)) if score.get((p, j), 0) >= reliable), default=None)
        if k is None and best:
            out[d].append((-best[1], a, b))
    return [joined((P.KINDS[k], a, b) for k, a, b in sorted(set(x))) for x in out]


def test_spans_equal_a_plain_version(spark):
    rnd = random.Random(7)
    words = ["mail", "to", "box", "call", "the", "office", "id", "host", "x" * 200, "number,", "(at)", "é"]
    value = [lambda i: f"user{i}@site{i % 7}.org", lambda i: f"10.0.{i % 256}.7", lambda i: f"+1 415 555 {1000 + i}", lambda i: f"AB-{i}-77", lambda i: f"u{i}#s{i}", lambda i: f"{i}"]
    frames = ["please mail to {} today", "host {} is up", "call {} now", "id {} of the", "mail to {}, or call {} now", "see ({}) at " + "y" * 150 + " {}"]
    texts = []
    for i in range(400):
        frame = rnd.choice(frames)
        usual = {"please": 0, "host": 1, "call": 2, "id": 3, "mail": 0, "see": 5}[frame.split()[0]]
        pick = lambda: value[usual if rnd.random() < 0.85 else rnd.randrange(6)](rnd.randrange(10_000, 99_999))  # noqa: E731, B023
        texts.append(" ".join(rnd.choices(words, k=rnd.randrange(4))) + " " + frame.format(pick(), pick()) + " " + " ".join(rnd.choices(words, k=rnd.randrange(4))))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for settings in ({}, {"reliable": 0.6, "min_support": 3}, {"rounds": 1, "reliable": 0.5, "min_support": 2}):
        want = plain_pii(texts, **settings)
        got = {r.doc_id: r.spans for r in P.pii_digest(df, **settings).collect()}
        assert [got[i] for i in range(len(texts))] == want
    assert sum(len(w) > len(joined(base(t))) for w, t in zip(want, texts)) > 20  # some spans are added


def test_far_words_are_whole(spark):
    """Words that differ beyond any window are different contexts."""
    rows = [(i, f"{'w' * 200} user{i}@site{i}.org") for i in range(30)] + [(100, f"{'q' * 10}{'w' * 200} abc#12345"), (101, f"{'w' * 200} abd#12345")]
    got = {r.doc_id: r.spans for r in P.pii_digest(spark.createDataFrame(rows, "doc_id long, text string"), min_support=5).collect()}
    assert got[100] == "" and got[101] == "email:201:210"


def test_many_spans_in_one_text_take_linear_time(spark):
    n = 100_000
    t = " ".join(f"a{i}@b.cc id{i:06d}x" for i in range(n))
    df = spark.createDataFrame([(1, t)], "doc_id long, text string")
    began = time.time()
    r = P.observed(df, "doc_id", "text", 5).select(F.size("base"), F.size("cand")).first()
    assert tuple(r) == (n, n) and time.time() - began < 60
    began = time.time()
    spans = df.select("text", F.expr(f"transform(sequence(0, {n - 1}), i -> struct(0 as k, i * 10 as s, i * 10 + 3 as e))").alias("sp"))
    got = spans.select(P.masked(F.col("text"), F.col("sp"))).first()[0]
    want, at = [], 0
    for i in range(n):
        want += [t[at:i * 10], "<EMAIL>"]
        at = i * 10 + 3
    assert got == "".join(want) + t[at:] and time.time() - began < 60


def test_base_against_plain_patterns(spark):
    rnd = random.Random(2)
    texts = [None, "", "a@b.c_d@e.f", "x@y", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.1", "4111 1111 1111 1111", "+1 (415) 555-2671",
             "+1 2", "\U0001F600 é a.b@c-d.org \U0001F600 10.0.0.1", "4111-1111-1111-1111-1 5500005555555559", "+++1 555 0100 99.", "a" * 30000,
             "1" * 30000, "1 " * 8000, "a@" * 8000, "+1" + "-" * 20000, "." * 50000 + "@", "1." * 8000, "mail me x@y.z " * 300]
    pieces = ["a", "Z9", "@", ".", "b.c", "1", "42", "255", "256", " ", "-", "+1", "(", ")", "\n", "é", "\U0001F600", "4111111111111111", "_", "%"]
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(40))) for _ in range(1500)]
    df = spark.createDataFrame([(i, t, "clash", 0) for i, t in enumerate(texts)] + [(None, "x@y.zz", "", 1), (3, texts[3], "", 2)], "doc_id long, text string, base string, h int")
    rows = P.pii_digest(df, min_support=10**6).collect()
    assert len(rows) == len(texts) + 2
    got = {r.doc_id: r for r in rows}
    for i, t in enumerate(texts):
        want = base(t or "")
        assert got[i].spans == joined(want), (i, t and t[:200])
        assert got[i].base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest()
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(k == x for k, *_ in want) for x in P.KINDS]
    assert P.pii_digest(df.limit(0)).count() == 0


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"please write to mail box user{i}@site{i}.org today and again") for i in range(30)]
    rows += [(100 + i, f"please write to mail box user{i}#at{i} today and again") for i in range(2)]
    rows += [(200 + i, f"room number b{i}77x of the house") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in P.pii_digest(df, reliable=0.8, min_support=5).collect()}
    for i in range(2):
        s = rows[30 + i][1].index("user")
        assert got[100 + i] == f"email:{s}:{s + len(f'user{i}#at{i}')}"
    assert all(got[200 + i] == "" for i in range(40))
    out = {r.doc_id: r.text for r in P.mask_pii(df).collect()}
    assert out[0] == out[100] == "please write to mail box <EMAIL> today and again" and out[200] == rows[32][1]


def test_masking(spark):
    t = "x a@b.cc, +1 415 555 2671 or 4111111111111111 \U0001F600 10.0.0.1 end"
    df = spark.createDataFrame([(1, t, 5), (1, t, 6), (2, None, 7), (None, t, 8), (3, "plain", 9)], "doc_id long, text string, spans int")
    got = {r.spans: r.text for r in P.mask_pii(df).collect()}
    assert got[7] is None and got[9] == "plain" and got[5] == got[6] == got[8]
    assert "a@b" not in got[5] and "10.0.0.1" not in got[5] and "4111111" not in got[5] and got[5].startswith("x <EMAIL>, <") and got[5].endswith("<IP> end")


def test_context_is_the_text_around(spark):
    """A match next to a span is a word of its context, for seeds and candidates, wherever they stand."""
    far = "\U0001F600 é" * 400
    texts = ["account 42 AB12-99 end", "A1-111, A2-222, A3-333", "mail 7 (jane@x.org), 8 to", f"{far} one b12345 two c12345 three {far}", "id=a@b.cc_d x12345", "12345", f"{'w' * 300} 12345 {'v' * 300}",
             f"{'w' * 3000} {'x' * 70_000}  98765 {'v' * 70_000}", f"a b{'w' * 5000}12346c{'v' * 5000} d e", "\x01 67890 \x01a@b.cc 4711\x01 x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = P.observed(df, "doc_id", "text", 5).collect()
    for r in seen:
        for x in [*r.base, *r.cand]:
            t = texts[r.doc_id]
            assert t[x.s:x.e] == x.m and t[:x.s].endswith(x.l) and t[x.e:].startswith(x.r), (x, t)
            assert plain_contexts(x.l, x.r) == plain_contexts(t[:x.s], t[x.e:]), (x, t)
    spans = [(x.m, x.l, x.r) for r in seen for x in [*r.base, *r.cand]]
    df = spark.createDataFrame(spans, "m string, l string, r string")
    got = {r.m: r.p for r in df.select("m", P.contexts(df.l, df.r).alias("p")).collect()}
    assert got["AB12-99"] == ["2 account 00", "1 00", "r end"] and got["A2-222"] == ["1 a0-000,", "r a0-000"] and got["A3-333"] == ["2 a0-000, a0-000,", "1 a0-000,"]
    assert got["jane@x.org"] == ["2 mail 0", "1 0", "r 0"] and got["c12345"] == ["2 b00000 two", "1 two", "r three"] and got["x12345"] == ["1 id=a@b.cc_d"]


def test_candidates_behind_other_matches(spark):
    rows = [(i, f"please send to box 7 user{i}@site{i}.org 8 today") for i in range(30)]
    rows += [(100 + i, f"please send to box 7 user{i}#at{i} 8 today") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in P.pii_digest(df, reliable=0.8, min_support=5).collect()}
    for i in range(2):
        s = rows[30 + i][1].index("user")
        assert got[100 + i] == f"email:{s}:{s + len(f'user{i}#at{i}')}"
