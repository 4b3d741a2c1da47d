"""Spelling variants by Bloom-guided neighbourhoods (operator 12).

The vocabulary is counted over whole texts. Each of its words generates the words one edit away, and generated words are
looked up in Bloom filters of the vocabulary, sharded by word length; only what a filter lets through is shuffled, to an
exact join with the vocabulary that removes the false positives. Edits are symmetric, so each pair is generated from one side: by
deletion from the longer word, by replacement with a later code point from the one that is smaller there.

A filter is a row of 512-bit blocks; a word sets ``PROBES`` bits of one block. The hash is a polynomial of the code points,
so an edit's hash comes from the word's by one multiplication, and strings are made for positives only.

Scale: counting aggregates in the task before it shuffles. The filters are built in pieces of ``PIECE`` blocks by Spark and
broadcast at most ``broadcast_bytes`` at a time: a larger vocabulary is probed in several rounds, each with the next
pieces, so no size is left out. Words are near at most some hundred others, so no join key is hot beyond that; counts and
best forms are partial aggregates.

Defined cases: a null text has no words; a null id counts as an empty string in the typing rule. Rows that share an id
are documents of their own. Words of any length are handled in slices. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsift.llm.common import saved

# The code points of words, once A-Z are lower case.
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
TYPING = 199  # the part of (document, run) that is typed wrongly

HELD = 300_000  # words that a task counts before it passes them on
BITS_A_WORD = 16
PROBES = 6
PIECE = 1024  # blocks of 64 bytes
LONGEST = 63  # words this long or longer share a shard
STEP = 1 << 20  # edits looked up at once

BASE = 0x9E3779B97F4A7C15 | 1
BACK = pow(BASE, -1, 1 << 64)


# --- vocabulary ----------------------------------------------------------------------------------------------------

def typed(prefix: int, run: str) -> str:
    """The word that a lower-cased run stands for; ``prefix``: CRC-32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), prefix)
    if h % TYPING:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _counter(min_length: int):
    find = re.compile("[a-zÀ-ÿ]{%d,}" % min_length).findall  # a shorter run can't become a longer word

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return made
        for b in batches:
            for doc, text in zip(b.column(0), b.column(1), strict=True):
                prefix = zlib.crc32(f"{doc.as_py() or ''}:".encode())
                for r, n in Counter(find(text.as_buffer().to_pybytes().translate(LOWER).decode())).items():
                    w = typed(prefix, r)
                    if len(w) >= min_length:
                        held[w] += n
                if len(held) > HELD:
                    yield out()
        yield out()
    return run


def vocabulary(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n) of the words with at least ``min_length`` code points and ``min_count`` occurrences."""
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("d"), F.col(text_col).cast("binary").alias("t"))
    counts = rows.mapInArrow(_counter(min_length), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- hashes and filters ----------------------------------------------------------------------------------------------

def points(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads a polynomial's value over all 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def bit_of(h: np.ndarray, probe: int) -> np.ndarray:
    """Bit 0-511 of the block; odd steps from a start, both from the hash's lower half."""
    return (h + np.uint64(probe) * ((h >> np.uint64(9)) | np.uint64(1))) & np.uint64(511)


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, positions of its words)."""
    n = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(n):
        yield int(length), np.flatnonzero(n == length)


def shard_blocks(counts: dict[int, int]) -> dict[int, int]:
    """Blocks of each shard's filter, at least one."""
    return {s: max(1, -(-n * BITS_A_WORD // 512)) for s, n in counts.items()}


def _hashed(blocks: dict[int, int]):
    """word -> (shard, piece, block in the piece, hash)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column(0).to_pylist()
            for length, at in by_length(words):
                shard = min(length, LONGEST)
                for a in range(0, len(at), max(1, STEP // length)):
                    p = points([words[i] for i in at[a:a + max(1, STEP // length)]])
                    h = mixed((p * powers(length)).sum(axis=1, dtype=np.uint64))
                    block = block_of(h, blocks[shard])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), shard), pa.int32()), pa.array(block // PIECE, pa.int64()), pa.array(block % PIECE, pa.int32()), pa.array(h.view(np.int64))], ["shard", "piece", "block", "h"])
    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, piece) -> a row for each piece with its bits."""
    key, bits = None, None
    out = lambda: pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([bits.tobytes()], pa.binary())], ["shard", "piece", "bits"])
    for b in batches:
        shard, piece, block, h = (c.to_numpy(zero_copy_only=False) for c in b.columns)
        h = h.view(np.uint64)
        cuts = np.flatnonzero(np.diff(shard) | np.diff(piece)) + 1
        for a, z in zip([0, *cuts], [*cuts, len(h)], strict=True):
            if a == z:
                continue
            if key != (now := (int(shard[a]), int(piece[a]))):
                if key:
                    yield out()
                key, bits = now, np.zeros(PIECE * 8, np.uint64)
            for k in range(PROBES):
                bit = bit_of(h[a:z], k)
                np.bitwise_or.at(bits, block[a:z].astype(np.int64) * 8 + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    if key:
        yield out()


def filters(vocab: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """(shard, piece, bits) of the filters as a table, and each shard's blocks (at most ``LONGEST`` shards)."""
    shard = F.least(F.length("word"), F.lit(LONGEST))
    blocks = shard_blocks({r["s"]: r["n"] for r in vocab.groupBy(shard.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()})
    bits = vocab.select("word").mapInArrow(_hashed(blocks), "shard int, piece bigint, block int, h bigint")
    bits = bits.repartition("shard", "piece").sortWithinPartitions("shard", "piece").mapInArrow(_pieces, "shard int, piece bigint, bits binary")
    return saved(bits, "filters"), blocks


def rounds(blocks: dict[int, int], broadcast_bytes: int) -> list[dict[int, tuple[int, int]]]:
    """The pieces of each round, as ranges by shard; a round's pieces take at most ``broadcast_bytes`` (or are one)."""
    room = max(1, broadcast_bytes // (PIECE * 64))
    out: list[dict[int, tuple[int, int]]] = [{}]
    left = room
    for s, n in sorted(blocks.items()):
        at, end = 0, -(-n // PIECE)
        while at < end:
            if not left:
                out.append({})
                left = room
            take = min(left, end - at)
            out[-1][s] = (at, at + take)
            at, left = at + take, left - take
    return [r for r in out if r]


# --- neighbourhoods --------------------------------------------------------------------------------------------------

class Filter:
    """Some pieces of one shard's filter."""

    def __init__(self, bits: np.ndarray, first: int, blocks: int):
        self.bits, self.first, self.blocks = bits, first * PIECE, blocks

    def has(self, raw: np.ndarray) -> np.ndarray:
        """Positions of the polynomial values that may be words of these pieces."""
        h = mixed(raw)
        block = block_of(h, self.blocks) - self.first
        at = np.flatnonzero((block >= 0) & (block < len(self.bits) // 8))
        for k in range(PROBES):
            if not len(at):
                break
            bit = bit_of(h[at], k)
            word = self.bits[block[at] * 8 + (bit >> np.uint64(6)).astype(np.int64)]
            at = at[(word >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)]
        return at


def neighbours(words: list[str], length: int, shards: dict[int, Filter], min_length: int) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(positions of words, generated words) that the filters let through: deletions, and replacements by later code points."""
    shorter = shards.get(min(length - 1, LONGEST)) if length > min_length else None
    same = shards.get(min(length, LONGEST))
    width = len(ALPHABET)
    rows = max(1, STEP // (length * width))
    cols = max(1, min(length, STEP // width))
    pw, back = powers(length), np.uint64(BACK)
    for a in range(0, len(words), rows):
        some = words[a:a + rows]
        p = points(some)
        sums = np.cumsum(p * pw, axis=1, dtype=np.uint64)
        whole = sums[:, -1:]
        if shorter:
            cut = (sums - p * pw) + (whole - sums) * back
            new = np.ones(p.shape, bool)
            new[:, :-1] = p[:, 1:] != p[:, :-1]  # of equal neighbours the last goes
            at = np.flatnonzero(new)
            got = at[shorter.has(cut.ravel()[at])]
            w, i = np.divmod(got, length)
            if len(w):
                yield w + a, [some[x][:y] + some[x][y + 1:] for x, y in zip(w.tolist(), i.tolist(), strict=True)]
        if same:
            for c in range(0, length, cols):
                part = p[:, c:c + cols]
                ok = ALPHABET[None, None, :] > part[:, :, None]
                w, i, k = np.nonzero(ok)
                got = same.has(whole[w, 0] + (ALPHABET[k] - part[w, i]) * pw[c + i])
                if len(got):
                    w, i, k = w[got], i[got] + c, ALPHABET[k[got]]
                    yield w + a, [some[x][:y] + chr(z) + some[x][y + 1:] for x, y, z in zip(w.tolist(), i.tolist(), k.tolist(), strict=True)]


def _probe(sent, blocks: dict[int, int], min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = {s: Filter(np.frombuffer(raw, np.uint64), first, blocks[s]) for s, (first, raw) in sent.value.items()}
        for b in batches:
            words, n = b.column(0).to_pylist(), b.column(1).to_numpy()
            for length, at in by_length(words):
                for w, made in neighbours([words[i] for i in at], length, shards, min_length):
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at[w])), pa.array(n[at[w]], pa.int64()), pa.array(made, pa.string())], ["word", "n", "other"])
    return run


def near_pairs(vocab: DataFrame, *, min_length: int = 6, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(word, n, other, other_n), each pair of near words once."""
    spark = vocab.sparkSession
    table, blocks = filters(vocab)
    found = None
    for ranges in rounds(blocks, broadcast_bytes):
        wanted = [f"(shard = {s} AND piece >= {a} AND piece < {z})" for s, (a, z) in ranges.items()]
        got: dict[int, tuple[int, bytearray]] = {s: (a, bytearray(PIECE * 64 * (z - a))) for s, (a, z) in ranges.items()}
        for r in table.where(" OR ".join(wanted)).collect():  # at most broadcast_bytes
            first, raw = got[r["shard"]]
            at = (r["piece"] - first) * PIECE * 64
            raw[at:at + PIECE * 64] = r["bits"]
        sent = spark.sparkContext.broadcast({s: (a, bytes(raw)) for s, (a, raw) in got.items()})
        positives = vocab.select("word", "n").mapInArrow(_probe(sent, blocks, min_length), "word string, n bigint, other string")
        found = positives if found is None else found.unionByName(positives)
    if found is None:
        return vocab.select("word", "n", F.lit("").alias("other"), F.lit(0).cast("bigint").alias("other_n")).limit(0)
    return found.join(vocab.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other").select("word", "n", "other", "other_n")


# --- forms and roots ---------------------------------------------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): follows forms to the last by doubling. A form occurs several times as often as
    its word, so there are no cycles and chains are short."""
    known = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = saved(known.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = step.where("moved").limit(1).count()
        known = step.select("word", "root")
        if not moved:
            return known


def variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_count: int = 5, ratio: int = 5,
             broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word; see the contract of op12."""
    vocab = saved(vocabulary(docs, id_col=id_col, text_col=text_col, min_length=min_length, min_count=min_count), "vocabulary")
    pairs = near_pairs(vocab, min_length=min_length, broadcast_bytes=broadcast_bytes)
    both = pairs.select(F.explode(F.array(F.struct("word", F.col("other").alias("o"), F.col("other_n").alias("o_n")), F.struct(F.col("other").alias("word"), F.col("word").alias("o"), F.col("n").alias("o_n")))).alias("x"))
    near = both.groupBy(F.col("x.word").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("x.o_n")).alias("n"), F.col("x.o").alias("o"))).alias("best"))
    words = vocab.join(near, "word", "left")
    is_form = -F.col("best.n") >= ratio * F.col("n")
    words = saved(words.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(is_form, F.col("best.o")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n")), "words")
    last = roots(words.where(F.col("form").isNotNull()))
    return words.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def oracle(min_length: int = 6, min_count: int = 5, ratio: int = 5) -> str:
    """DuckDB SQL of ``variants``: CRC-32 by its table, near words by equal deletions and equal masked words."""
    table = _crc_table()
    return f"""
WITH RECURSIVE runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{{{min_length},}}')) AS r FROM documents),
counted AS (SELECT d, r, count(*) AS c FROM runs GROUP BY ALL),
bytes AS (SELECT r, c, hex(encode(d || ':' || r)) AS x FROM counted),
crc AS (SELECT r, c, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, CAST(length(x) // 2 AS BIGINT)), lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
  lambda acc, b: xor(acc >> 8, t.entries[CAST((xor(acc, b) & 255) + 1 AS BIGINT)])), CAST(4294967295 AS BIGINT)) AS h FROM bytes, (SELECT {table} AS entries) t),
words AS (SELECT CASE WHEN h % {TYPING} = 0 THEN substr(r, 1, CAST(h % length(r) AS BIGINT)) || substr(r, CAST(h % length(r) + 2 AS BIGINT)) ELSE r END AS word, c FROM crc),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM words WHERE length(word) >= {min_length} GROUP BY word HAVING sum(c) >= {min_count}),
spots AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
cut AS (SELECT DISTINCT word, n, substr(word, 1, CAST(i - 1 AS BIGINT)) || substr(word, CAST(i + 1 AS BIGINT)) AS o FROM spots),
masked AS (SELECT word, n, i, substr(word, 1, CAST(i - 1 AS BIGINT)) || '*' || substr(word, CAST(i + 1 AS BIGINT)) AS m FROM spots),
near AS (SELECT cut.word, cut.n, v.word AS o, v.n AS o_n FROM cut JOIN v ON v.word = cut.o
  UNION ALL SELECT v.word, v.n, cut.word, cut.n FROM cut JOIN v ON v.word = cut.o
  UNION ALL SELECT a.word, a.n, b.word, b.n FROM masked a JOIN masked b ON a.m = b.m AND a.i = b.i AND a.word <> b.word),
best AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY o_n DESC, o) AS k, count(*) OVER (PARTITION BY word) AS c FROM near),
f AS (SELECT v.word, v.n, CAST(coalesce(b.c, 0) AS BIGINT) AS n_near, CASE WHEN b.o_n >= {ratio} * v.n THEN b.o END AS form, CASE WHEN b.o_n >= {ratio} * v.n THEN b.o_n END AS form_n
  FROM v LEFT JOIN best b ON b.word = v.word AND b.k = 1),
walk AS (SELECT word, word AS last, form AS next FROM f UNION ALL SELECT w.word, f.word, f.form FROM walk w JOIN f ON f.word = w.next)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, w.last AS root FROM f JOIN walk w ON w.word = f.word AND w.next IS NULL"""


def _crc_table() -> str:
    entries = []
    for x in range(256):
        for _ in range(8):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        entries.append(x)
    return "CAST([" + ", ".join(map(str, entries)) + "] AS BIGINT[])"
