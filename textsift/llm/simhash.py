"""SimHash near-duplicates with bit-sliced comparison (operator 6).

1. Every text gets a 64-bit fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of ``shingle`` words
   (fewer words: the whole sequence), XXH64 with seed 42 of each; a bit is 1 if set in over half the hashes.
2. Equal fingerprints are one row from here on, whatever their number of documents.
3. The 64 bits are cut into B blocks, B at least ``radius + 2``. Fingerprints that differ in at most ``radius`` bits agree on
   at least B - ``radius`` whole blocks, so each choice of so many blocks gives a table, its values the bucket: no link
   is lost. B follows the number of fingerprints (``blocks_for``), so that a bucket's rows don't grow with the corpus.
4. Within a bucket, fingerprints are stored as bit planes (plane b holds bit b of 64 fingerprints a word). The
   distances of many pairs are counted at once with carry-save counters, and a block of words leaves as soon as all
   of its pairs exceed the radius. Small buckets compare the planes with themselves shifted, large ones with one
   fingerprint after another; a bucket beyond ``chunk`` rows is cut into chunks and its pairs of chunks are dealt out
   as tiles of their own, so no task gets more than two chunks of it to compare.
5. A task sends a spanning star for each group it found, not all pairs; connected components join them.

Defined cases: a null or empty text has no words and the fingerprint zero, linked like any other. A row without id
gets the component of its fingerprint, or null if no row with an id is in it. Rows that share an id are one
vertex for linking, also where their texts differ; each keeps its row. All is done on whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsift.llm.common import fresh, saved
from textsift.operators.components import connected_components

SEED = 42
ONES = np.uint64(2**64 - 1)
#: Buckets up to this many rows are compared by shifted planes, larger ones row against planes.
SMALL = 64
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(raw: bytes, shingle: int) -> int:
    """64-bit SimHash of a text in UTF-8."""
    words = raw.translate(LOWER).split()  # bytes.split: runs of \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-shingle] + 1).tolist()]
    ends = ends[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)), np.uint64, len(ends))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("t"))
    return rows.mapInArrow(run, "doc_id bigint, fp bigint")


# --- bit planes ----------------------------------------------------------------------------------------------------

def planes_of(fps: np.ndarray) -> np.ndarray:
    """(64, words): bit i % 64 of word i // 64 of plane b is bit b of fingerprint i; one empty word more."""
    n = len(fps)
    bits = np.zeros((64 * (n // 64 + 2), 64), np.uint8)
    bits[:n] = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def packed(flags: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(64 * words, np.uint8)
    out[:len(flags)] = flags
    return np.packbits(out, bitorder="little").view("<u8").astype(np.uint64)


def within(diff, valid: np.ndarray, radius: int) -> np.ndarray:
    """Words of lanes whose distance is at most ``radius``. ``diff(b, at)`` gives plane b's differences at the words
    ``at`` (None: all). Counters start at 2**bits - 1 - radius, so the carry out of the top bit means beyond it."""
    bits = (radius + 1).bit_length()
    start = 2**bits - 1 - radius
    counters = [np.full(valid.shape, ONES if start >> k & 1 else 0, np.uint64) for k in range(bits)]
    over, at = ~valid, None
    for b in range(0, 64, 2):
        x, y = diff(b, at), diff(b + 1, at)
        either = x ^ y
        carry = (x & y) | (counters[0] & either)
        counters[0] ^= either
        for k in range(1, bits):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if b % 8 == 6:  # abandon the words in which all lanes are beyond the radius
            live = over != ONES
            if 2 * live.sum() < len(live):
                at = np.nonzero(live)[0] if at is None else at[live]
                counters, over = [c[live] for c in counters], over[live]
                if not len(over):
                    break
    if at is None:
        return ~over
    out = np.zeros_like(valid)
    out[at] = ~over
    return out


def lanes(words: np.ndarray) -> np.ndarray:
    """Numbers of the set lanes."""
    some = np.nonzero(words)[0]
    bits = np.unpackbits(words[some].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    w, lane = np.nonzero(bits)
    return some[w] * 64 + lane


class Forest:
    """Smallest row number of each group, fed with links."""

    def __init__(self, n: int):
        self.p = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.p[i], self.p[j]
            new = a != b
            i, j, a, b = i[new], j[new], a[new], b[new]
            np.minimum.at(self.p, np.maximum(a, b), np.minimum(a, b))
            while (self.p != (up := self.p[self.p])).any():
                self.p = up


def link_rows(planes: np.ndarray, fps: np.ndarray, queries: range, first: int, last: int, radius: int, forest: Forest, later: bool) -> None:
    """Compare the ``queries`` with rows first..last-1; ``later``: only with rows after the query's own."""
    a, z = first // 64, -(-last // 64)
    part, width = planes[:, a:z], z - a
    row = np.arange(a * 64, z * 64)
    inside = (row >= first) & (row < last)
    step = max(1, (1 << 14) // width)
    for s in range(queries.start, queries.stop, step):
        q = np.arange(s, min(s + step, queries.stop))
        flip = (fps[q, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)) * ONES
        ok = inside & (row > q[:, None]) if later else np.broadcast_to(inside, (len(q), len(row)))
        valid = np.packbits(ok, axis=1, bitorder="little").view("<u8").astype(np.uint64).ravel()

        def diff(b, at, flip=flip):
            if at is None:
                return (part[b] ^ flip[:, b, None]).ravel()
            return part[b][at % width] ^ flip[at // width, b]
        found = lanes(within(diff, valid, radius))
        forest.add(q[found // (64 * width)], a * 64 + found % (64 * width))


def link_chunk(buckets: np.ndarray, fps: np.ndarray, radius: int) -> Forest:
    """Groups of rows of equal bucket within the radius; rows sorted by bucket."""
    n = len(fps)
    forest, planes = Forest(n), planes_of(fps)
    cuts = np.nonzero(np.diff(buckets))[0] + 1
    starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [n]])
    sizes = ends - starts
    left = np.repeat(np.where(sizes <= SMALL, ends, 0), sizes) - np.arange(n) - 1  # rows of a small bucket after this one
    for shift in range(1, int(left.max(initial=0)) + 1):
        rows = np.nonzero(left >= shift)[0]
        at0 = np.unique(rows // 64)
        valid = packed(left >= shift, planes.shape[1])[at0]
        w, s = shift // 64, np.uint64(shift % 64)

        def diff(b, at, at0=at0, w=w, s=s):
            x = at0 if at is None else at0[at]
            p = planes[b]
            moved = p[x + w] if not s else p[x + w] >> s | p[x + w + 1] << (np.uint64(64) - s)
            return p[x] ^ moved
        found = lanes(within(diff, valid, radius))
        i = at0[found // 64] * 64 + found % 64
        forest.add(i, i + shift)
    for k in np.nonzero(sizes > SMALL)[0]:
        link_rows(planes, fps, range(starts[k], ends[k]), starts[k], ends[k], radius, forest, True)
    return forest


# --- Spark ---------------------------------------------------------------------------------------------------------

LINKS = "u bigint, v bigint, bucket bigint, chunk int, fp bigint"


def _stars(forest: Forest, rep: np.ndarray) -> pd.DataFrame:
    i = np.nonzero(forest.p != np.arange(len(forest.p)))[0]
    return pd.DataFrame({"u": rep[i], "v": rep[forest.p[i]], "bucket": pd.array([None] * len(i), "Int64"), "chunk": pd.array([None] * len(i), "Int32"), "fp": pd.array([None] * len(i), "Int64")})


def _compare(radius: int, chunk: int, rows_at_once: int = 1 << 16):
    """Rows sorted by (bucket, fp) -> links, and the rows of buckets beyond ``chunk`` rows with their chunk number.

    A group is one chunk of one bucket; rows are held until their group is complete, at most about
    ``rows_at_once + chunk`` of them.
    """
    def done(bucket, number, fps, rep) -> pd.DataFrame:
        group = np.cumsum(np.concatenate([[0], (np.diff(bucket) != 0) | (np.diff(number) != 0)]))
        links = _stars(link_chunk(group, fps.view(np.uint64), radius), rep)
        full = np.bincount(group)[group] == chunk
        i = np.nonzero((number > 0) | full)[0]
        rest = pd.DataFrame({"u": rep[i], "v": rep[i], "bucket": pd.array(bucket[i], "Int64"), "chunk": pd.array(number[i], "Int32"), "fp": pd.array(fps[i], "Int64")})
        return pd.concat([links, rest]) if len(i) else links

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, last, seen = None, None, 0
        for batch in batches:
            if not len(batch):
                continue
            bucket = batch["bucket"].to_numpy()
            starts = np.concatenate([[0], np.nonzero(np.diff(bucket))[0] + 1])
            sizes = np.diff(np.concatenate([starts, [len(bucket)]]))
            pos = np.arange(len(bucket)) - np.repeat(starts, sizes)
            if bucket[0] == last:
                pos[:sizes[0]] += seen
            last, seen = bucket[-1], int(pos[-1]) + 1
            new = [bucket, pos // chunk, batch["fp"].to_numpy(), batch["rep"].to_numpy()]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            if len(held[0]) >= rows_at_once:
                open_ = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
                cut = int(np.argmax(open_))
                if cut:
                    yield done(*[x[:cut] for x in held])
                    held = [x[cut:] for x in held]
        if held is not None:
            yield done(*held)
    return run


def _tile(radius: int):
    """Links between two chunks of one bucket."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["chunk", "fp"])
        n = int((part["chunk"] == part["a"]).sum())
        fps, forest = part["fp"].to_numpy().view(np.uint64), Forest(len(part))
        link_rows(planes_of(fps), fps, range(n), n, len(fps), radius, forest, False)
        return _stars(forest, part["rep"].to_numpy())
    return run


def widths_of(blocks: int) -> list[int]:
    return [64 // blocks + (k < 64 % blocks) for k in range(blocks)]


def blocks_for(fingerprints: int, radius: int, rows: int = 256) -> int:
    """The fewest blocks of which ``blocks - radius`` have so many bits that a bucket of spread fingerprints has at most ``rows``."""
    blocks = radius + 2
    while blocks < 64 and fingerprints >> sum(widths_of(blocks)[radius:]) > rows:
        blocks += 1
    return blocks


def links(groups: DataFrame, radius: int, chunk: int, blocks: int | None = None) -> DataFrame:
    """(u, v) between representatives of fingerprints within the radius: enough of them to join every group.

    ``groups``: one row per fingerprint (fp, rep).
    """
    blocks = blocks or blocks_for(groups.count(), radius)
    width = widths_of(blocks)
    mask = [((1 << n) - 1) << sum(width[:k]) for k, n in enumerate(width)]
    tables = [sum(mask[k] for k in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    # two buckets that share a hash are compared with each other too: more work, no other result
    buckets = F.transform(F.array(*[F.lit(m - 2**64 if m >= 2**63 else m).cast("bigint") for m in tables]), lambda m, t: F.xxhash64(F.col("fp").bitwiseAND(m), t))
    rows = groups.where(F.col("rep").isNotNull()).select("fp", "rep", F.explode(buckets).alias("bucket"))
    found = saved(rows.repartition("bucket").sortWithinPartitions("bucket", "fp").mapInPandas(_compare(radius, chunk), LINKS), "links")
    near = found.where(F.col("bucket").isNull()).select("u", "v")
    large = found.where(F.col("bucket").isNotNull()).select("bucket", "chunk", "fp", F.col("u").alias("rep"))
    if large.isEmpty():
        return near
    last = large.groupBy("bucket").agg(F.max("chunk").alias("last"))
    tiles = (large.join(last, "bucket").select("*", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("x")).where(F.col("x") != F.col("chunk"))
             .select("bucket", F.least("x", "chunk").alias("a"), F.greatest("x", "chunk").alias("b"), "chunk", "fp", "rep"))
    return near.unionByName(tiles.groupBy("bucket", "a", "b").applyInPandas(_tile(radius), LINKS).select("u", "v"))


def simhash_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                       radius: int = 4, chunk: int = 4096) -> DataFrame:
    """(doc_id, fingerprint, component_id), a row per document; the component is the smallest id reachable."""
    fps = saved(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    groups = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "groups")
    edges = links(groups, radius, chunk)
    several = fps.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b"))
    several = saved(several.where(F.col("a") != F.col("b")).select("doc_id"), "several")
    if not several.isEmpty():  # an id with several fingerprints links them
        edges = edges.unionByName(fps.join(several, "doc_id").join(groups, "fp").select(F.col("rep").alias("u"), F.col("doc_id").alias("v")).distinct())
    joined = connected_components(edges, "u", "v")
    groups = groups.join(joined.withColumnRenamed("id", "rep"), "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(groups, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` without the near copies: the document with the smallest id of each component stays.

    Of several rows with that id one stays (the smallest, columns compared in order). Rows without id have nothing to
    be told apart by and stay. Columns are those of ``docs``.
    """
    found = saved(simhash_components(docs, id_col=id_col, text_col=text_col, shingle=shingle, radius=radius), "components")
    # rows of one id have one component, whose smallest id is among the rows
    ids = found.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("component_id").alias("c"), F.count(F.lit(1)).alias("n"))
    rid, n = fresh(docs, "rid", "n")
    ids = ids.where(F.col("c") == F.col("doc_id")).select(F.col("doc_id").alias(rid), F.col("n").alias(n))
    kept = docs.join(ids, F.col(id_col) == F.col(rid))
    once = kept.where(F.col(n) == 1).select(docs.columns)
    again = kept.where(F.col(n) > 1).groupBy(id_col).agg(F.min(F.struct(*docs.columns)).alias(rid)).select(f"{rid}.*")
    return once.unionByName(again).unionByName(docs.where(F.col(id_col).isNull()))
