"""Spelling variants against a brute-force version, and its edge cases."""
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from textsift.llm import variants as V


def words_of(doc_id, text):
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        yield run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    counts = Counter(w for d, t in rows for w in words_of(d, t))
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    others = {w: [o for o in n if near(w, o)] for w in n}
    form = {}
    for w, os in others.items():
        best = min(os, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {w: (n[w], len(others[w]), form[w], n[form[w]] if form[w] else None, root(w)) for w in n}


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, word string, n int, root string")
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in V.variants(df, **options).collect()}


def rows():
    base = {"letter": 400, "lettere": 60, "letteree": 9, "leter": 9, "lettex": 6, "lettexx": 25, "aabbcc": 50, "aabcc": 40, "aabbccc": 5, "Übermut": 70, "übermut": 8,
            "übermüt": 7, "zzzzzzzz": 5, "z" * 70: 30, "z" * 71: 5, "y" + "z" * 69: 6}
    out = [(i, (w if i % 2 or not w.isascii() else w.upper()) + "!", None, i, None) for w, c in base.items() for i in range(c)]
    return [*out, (None, "letter  letter", None, 1, None), (None, None, "x", 2, None), (7, "", None, 3, None), (7, "letter letter", None, 4, None), (7, "letter letter", None, 4, None)]


def test_brute_force(spark):
    data = rows()
    expected = brute([(r[0], r[1]) for r in data])
    got = run(spark, data)
    assert got == expected
    assert any(v[2] and v[4] != v[2] for v in expected.values())  # a chain of forms
    # filters in many rounds, a piece each
    assert run(spark, data, broadcast_bytes=1) == expected


def test_empty_and_null(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, None, None, 1, None), (2, "", None, 1, None)]) == {}


def test_rounds_cover_every_piece():
    blocks = {6: 5 * V.PIECE + 1, 7: 1, 63: 3 * V.PIECE}
    made = V.rounds(blocks, 2 * V.PIECE * 64)
    assert all(sum(z - a for a, z in r.values()) <= 2 for r in made)
    assert sorted((s, p) for r in made for s, (a, z) in r.items() for p in range(a, z)) == sorted((s, p) for s, n in blocks.items() for p in range(-(-n // V.PIECE)))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abzàÿ", min_size=6, max_size=9), min_size=1, max_size=30, unique=True))
def test_each_near_pair_is_generated_once(words):
    counts = Counter(map(len, words))
    blocks = V.shard_blocks(counts)
    bits = {s: np.zeros(V.PIECE * 8, np.uint64) for s in blocks}
    for length, at in V.by_length(words):
        h = V.mixed((V.points([words[i] for i in at]) * V.powers(length)).sum(axis=1, dtype=np.uint64))
        for k in range(V.PROBES):
            bit = V.bit_of(h, k)
            np.bitwise_or.at(bits[length], V.block_of(h, blocks[length]) * 8 + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    shards = {s: V.Filter(b, 0, blocks[s]) for s, b in bits.items()}
    got = Counter()
    for length, at in V.by_length(words):
        some = [words[i] for i in at]
        for w, made in V.neighbours(some, length, shards, 6):
            got.update(frozenset((some[i], m)) for i, m in zip(w.tolist(), made) if m in words)
    assert got == {frozenset((a, b)): 1 for a in words for b in words if near(a, b)}
