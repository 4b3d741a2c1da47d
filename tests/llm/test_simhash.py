import random

import numpy as np
import xxhash

from textsift.llm import simhash as S
from textsift.operators.components import connected_components


def brute(docs, radius=4, n=4):
    import re
    fps = []
    for i, t in docs:
        t = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sh = [" ".join(w[k:k + n]) for k in range(len(w) - n + 1)] if len(w) >= n else ([" ".join(w)] if w else [])
        c = [0] * 64
        for s in sh:
            h = xxhash.xxh64_intdigest(s.encode(), 42)
            for b in range(64):
                c[b] += h >> b & 1
        fps.append((i, sum(1 << b for b in range(64) if 2 * c[b] > len(sh))))
    return fps, components(fps, radius)


def components(fps, radius):
    p = list(range(len(fps)))

    def find(x):
        while p[x] != x:
            x = p[x]
        return x
    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a][1] ^ fps[b][1]).count("1") <= radius:
                p[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(fps):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return [low.get(find(k)) for k in range(len(fps))]


def test_documents_against_brute_force(spark):
    rnd = random.Random(3)
    w = [f"w{k}" for k in range(400)]
    docs = []
    for i in range(150):
        t = [rnd.choice(w) for _ in range(rnd.choice([1, 2, 3, 4, 5, 80, 200]))]
        docs.append((i, " ".join(t)))
        for _ in range(rnd.choice([0, 0, 2])):
            u = list(t)
            u[rnd.randrange(len(u))] = "X"
            docs.append((1000 + len(docs), "\n".join(u).upper() if rnd.random() < 0.5 else "\t".join(u)))
    docs += [(5000, None), (5001, ""), (5002, " \n"), (None, docs[0][1]), (0, docs[0][1]), (5003, "é " * 9), (5004, "long word " * 30000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, fp string, component_id int")
    got = sorted(((r.doc_id is None, r.doc_id, r.fingerprint, r.component_id) for r in S.simhash_components(df).collect()), key=str)
    fps, comp = brute(docs)
    want = sorted(((i is None, i, f"{f:016x}", c) for (i, f), c in zip(fps, comp)), key=str)
    assert got == want
    kept = S.keep_one(df).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted([*{str(c) for c in comp if c is not None}, "None"])
    assert set(kept[0].asDict()) == {"doc_id", "text", "fp", "component_id"}
    assert S.simhash_components(df.limit(0)).count() == 0 == S.keep_one(df.limit(0)).count()


def test_hot_buckets_small_chunks(spark):
    """Thousands of fingerprints around one centre, cut into many chunks and tiles: same groups as brute force."""
    rnd = random.Random(5)
    fps = {rnd.getrandbits(64) for _ in range(200)}
    for centre in (0x0123456789ABCDEF, 0xFFFF0000FFFF0000):
        for _ in range(250):
            x = centre
            for b in rnd.sample(range(64), rnd.randrange(12)):
                x ^= 1 << b
            fps.add(x)
    rows = [(k, x) for k, x in enumerate(sorted(fps))]
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)), k) for k, x in rows], "fp long, rep long")
    want = components(rows, 4)
    for chunk in (40, 4096):
        got = dict(connected_components(S.links(df, 4, chunk), "u", "v").collect())
        assert [got.get(k, k) for k, _ in rows] == want


def test_any_number_of_blocks_finds_every_link(spark):
    rnd = random.Random(8)
    fps = []
    for _ in range(120):
        f = rnd.getrandbits(64)
        fps.append(f)
        for bits in (1, 3, 4, 4, 5, 6):
            fps.append(f ^ sum(1 << b for b in rnd.sample(range(64), bits)))
    fps = list(dict.fromkeys(fps))
    want = dict(enumerate(components(list(enumerate(fps)), 4)))
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f, i) for i, f in enumerate(fps)], "fp long, rep long")
    for blocks in (7, 10):
        got = dict(connected_components(S.links(df, 4, 64, blocks), "u", "v").collect())
        assert {i: got.get(i, i) for i in want} == want, blocks
    assert [S.blocks_for(n, 4) for n in (0, 10**6, 2 * 10**8, 10**9, 10**10, 10**12)] == [6, 6, 6, 7, 7, 8] and S.blocks_for(10**10, 0) == 2
    for n in (10**9, 10**10, 10**11):
        blocks = S.blocks_for(n, 4)
        assert n >> sum(S.widths_of(blocks)[4:]) <= 256


def test_within_counts_every_radius():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**63, 300).astype(np.uint64)
    for radius in (0, 1, 3, 4, 7, 30):
        f = S.Forest(301)
        S.link_rows(S.planes_of(fps), fps, range(300), 0, 300, radius, f, True)
        want = components([(k, int(x)) for k, x in enumerate(fps)], radius)
        assert f.p[:300].tolist() == want


def test_ids_shared_by_different_texts(spark):
    """An id under several texts is one vertex: it joins their groups, and no group goes without a document."""
    rnd = random.Random(9)
    text = [" ".join(rnd.choice([f"w{k}" for k in range(500)]) for _ in range(120)) for _ in range(40)]
    docs = [(3, text[0]), (5, text[0]), (5, text[1]), (9, text[1])]  # 3 and 5 by text 0, 5 and 9 by text 1
    docs += [(100, text[2]), (101, text[2]), (101, text[3]), (50, text[3])]  # the smallest id is at the far text
    docs += [(200, text[4]), (200, text[5]), (200, text[6]), (None, text[6]), (None, text[7])]
    docs += [(300 + rnd.randrange(25), text[8 + rnd.randrange(32)]) for _ in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    fps, _ = brute(docs)
    low = list(range(len(docs)))  # row numbers, joined until nothing changes
    near = [[bin(x ^ y).count("1") <= 4 or (i is not None and i == j) for j, y in fps] for i, x in fps]
    for _ in docs:
        low = [min(low[b] for b in range(len(docs)) if near[a][b]) for a in range(len(docs))]
    ids = {g: [i for (i, _), h in zip(docs, low, strict=True) if h == g and i is not None] for g in set(low)}
    want = sorted(((str(i), f"{f:016x}", str(min(ids[g], default=None))) for (i, f), g in zip(fps, low, strict=True)))
    got = S.simhash_components(df).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    assert {r.component_id for r in got if r.doc_id in (3, 5, 9)} == {3} and {r.component_id for r in got if r.doc_id in (100, 101, 50)} == {50}
    kept = sorted(str(r.doc_id) for r in S.keep_one(df).collect())
    assert kept == sorted([*(str(min(x)) for x in ids.values() if x), "None", "None"])
