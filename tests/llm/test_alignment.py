"""Alignment of two tokenizers against a plain version over whole texts, and the parts of the external count."""
import hashlib
import json
from collections import Counter
from functools import cache

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textsift.llm import alignment as L

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def plain_encoder():
    """Whole texts through the libraries' own tokenizers: (a ids, b ids) or None."""
    import sentencepiece
    from tokenizers import Tokenizer
    ta = Tokenizer.from_file(A_PATH)
    ta.encode_special_tokens = True
    tb = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    letters = L.byte_alphabet()
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in json.load(open(A_PATH))["model"]["vocab"].items() if t != "<|endoftext|>"}

    def b_bytes(i):
        p = tb.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if tb.is_byte(i) else p.replace("▁", " ").encode()

    def encode(text):
        if not text:
            return None
        whole = (" " + text).encode()
        a, b = ta.encode(" " + text, add_special_tokens=False).ids, tb.encode(text)
        ab, bb = [a_bytes[i] for i in a], [b_bytes(i) for i in b]
        return (list(zip(a, ab)), list(zip(b, bb))) if b"".join(ab) == whole == b"".join(bb) else None
    return encode


@pytest.fixture(scope="module")
def plain():
    return plain_encoder()


def grouped(pair):
    """Groups [(a ids, b ids)] by ends of both."""
    ends = lambda side: np.cumsum([len(x) for _, x in side]).tolist()
    a, b = pair
    ea, eb = ends(a), ends(b)
    both = sorted(set(ea) & set(eb))
    out, x, y = [], 0, 0
    for e in both:
        i, j = ea.index(e, x) + 1, eb.index(e, y) + 1
        out.append(([t for t, _ in a[x:i]], [t for t, _ in b[y:j]]))
        x, y = i, j
    return out


def shown(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def brute(texts, encode):
    rows = [grouped(p) if (p := encode(t)) else [] for t in texts]
    links = [[(a[-1], b[-1]) for a, b in g] for g in rows]
    count = Counter(x for ls in links for x in ls)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [(sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(ls), sum(count[x] == best[x[1]] for x in ls), sum(count[x] for x in ls),
             hashlib.sha256(shown(g).encode()).hexdigest() if g else "") for g, ls in zip(rows, links)]


ODD = ["", None, " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n", "x\n\n  y\t z ", "a▁b c", "<|endoftext|> and </s> <s> <0x41>", "Üñí çödé — “quotes” 你好 世界 🙂🙂 é", "a  b　c", "word " * 50 + "\n" + "long" * 3000,
       "tab\tand\x0bvt \x1c\x85 nel", "don't we'll   I'd", "1234567 89 0.5%", "\x00 zero", "x" + " " * 40 + "y"]


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, pid string, bucket int, n int")
    out = L.align(df, A_PATH, B_PATH, P.PATTERN).collect()
    return sorted(((r["doc_id"], *[r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")]) for r in out), key=str)


def test_brute_force_odd_texts(spark, plain):
    texts = ODD * 2
    ids = [None if i == 3 else i // 2 for i in range(len(texts))]
    expected = sorted(((i, *x) for i, x in zip(ids, brute(texts, plain))), key=str)
    assert run(spark, [(i, t, "p", None, 1) for i, t in zip(ids, texts)]) == expected


def test_brute_force_table(spark, plain):
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    expected = sorted(((i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows], plain))), key=str)
    assert run(spark, [(i, t, None, None, None) for i, t in rows]) == expected


def test_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, None, None, None)]) == [(1, 0, 0, 0, 0, 0, 0, "")]


@cache
def loaded():
    return L.Aligner(A_PATH, B_PATH, P.PATTERN), plain_encoder()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab Z9'.,\n\té 你🙂▁-"), max_size=30), min_size=1, max_size=4))
def test_segments_are_whole_texts(texts):
    a, encode = loaded()
    texts = [t for t in texts if t]
    if not texts:
        return
    for t in texts:
        assert "".join(" " + s for s in L.segments(t)) == " " + t
    sums, digests, links, of = a.align(texts)
    for i, t in enumerate(texts):
        g = grouped(p) if (p := encode(t)) else []
        assert digests[i] == (hashlib.sha256(shown(g).encode()).hexdigest() if g else "")
        assert links[of == i].tolist() == [y[-1] * a.a.size + x[-1] for x, y in g]



def test_vocabulary_entries_encode_to_themselves():
    """tiktoken takes a piece that is an entry as it is; the merges must lead there too."""
    from tokenizers import Tokenizer
    own, fast = Tokenizer.from_file(A_PATH), L.ByteLevel(A_PATH, P.PATTERN)
    own.encode_special_tokens = True
    texts = []
    for b in fast.bytes_of:
        try:
            texts.append(b.decode())
        except UnicodeDecodeError:
            pass
    got = own.encode_batch(texts, add_special_tokens=False)
    assert [e.ids for e in got] == [fast.encode(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 9)), max_size=40), max_size=70), st.integers(1, 5))
def test_merge_adds_up(runs, frame):
    def frames(run):
        rows = sorted(run)
        for i in range(0, len(rows), frame):
            yield np.array([k for k, _ in rows[i:i + frame]], np.uint32), np.array([n for _, n in rows[i:i + frame]], np.int64)
    got = [(int(k), int(n)) for ks, ns in L.merged([frames(r) for r in runs]) for k, n in zip(ks, ns)]
    count = Counter()
    for r in runs:
        for k, n in r:
            count[k] += n
    assert got == sorted(count.items())


def test_pieces_keep_every_record(monkeypatch):
    monkeypatch.setattr(L, "PIECE", 7)
    rng = np.random.default_rng(5)
    keys, docs = rng.integers(0, 40, 500), rng.integers(0, 9, 500)
    keys[:200] = 17  # a hot pair is cut over pieces
    got, count = Counter(), Counter()
    for _, n, ks, body in L.pieces((keys.astype(np.uint64) << np.uint64(32)) | docs.astype(np.uint64), 4):
        assert n <= 7
        (delta, docs_of, dd, times), = L.unpacked(body, ("<u4",) * 4)
        own = np.repeat(np.cumsum(delta, dtype=np.uint32), docs_of).tolist()
        for k, d, m in zip(own, np.cumsum(dd, dtype=np.uint32).tolist(), times.tolist()):
            got[k, d] += m
        for k, c in L.frames_of(ks):
            count.update(dict(zip(k.tolist(), c.tolist())))
    assert got == Counter(zip(keys.tolist(), docs.tolist())) and count == Counter(keys.tolist())
