"""MinHash signatures and LSH band buckets (M1-M4).

Shingles are word n-grams of the normalised words (lowercase letters/digits); a document without words has none, hence
no signature, and is never a duplicate. Two hash families:

* ``xx64`` (64 bits, what production runs use): xxhash64 of the shingle, hash function i is ``a_i * h + b_i mod 2^64``
  with odd ``a_i``;
* ``affine31`` (portable): the first 4 bytes of the shingle's MD5 mod p = 2^31 - 1, and ``(a*h + b) mod p`` with
  ``a, b`` drawn by a fixed rule from MD5 as well, so that any SQL engine can recompute the signature.

Shingles are hashed in the JVM. The minima are taken per document in an Arrow UDF (numpy over the shingle hashes), once; band keys are two
64-bit hashes of the band's values, so the shuffle carries ``(scope, band, key1, key2, id)`` and never the text.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from textsift.functions.text import let, norm_words
from textsift.session import scratch_path

P31 = (1 << 31) - 1


@dataclass(frozen=True)
class MinhashConfig:
    """Band/row layout, shingle size and hash family. Defaults: per-collection run (14 x 8, 5-grams)."""
    bands: int = 14
    rows: int = 8
    n_grams: int = 5
    family: str = "affine31"

    @property
    def num_hashes(self) -> int:
        return self.bands * self.rows

    @property
    def threshold(self) -> float:
        """Approximate Jaccard similarity at which a pair becomes a candidate half the time: (1/b)^(1/r)."""
        return (1.0 / self.bands) ** (1.0 / self.rows)


PER_COLLECTION = MinhashConfig(14, 8, 5)
PER_TIER = MinhashConfig(40, 15, 4)
PER_COLLECTION_64 = MinhashConfig(14, 8, 5, "xx64")
SALTS = 32  # parts of a bucket, by id


def md5_31(s: str) -> int:
    return int.from_bytes(hashlib.md5(s.encode("utf-8")).digest()[:4], "big") % P31


def hash_params(k: int) -> tuple[np.ndarray, np.ndarray]:
    """Parameters of hash function i (1-based): a_i = md5_31('a<i>') mod (p-1) + 1, b_i = md5_31('b<i>')."""
    a = np.array([int.from_bytes(hashlib.md5(f"a{i}".encode()).digest()[:4], "big") % (P31 - 1) + 1
                  for i in range(1, k + 1)], dtype=np.int64)
    b = np.array([md5_31(f"b{i}") for i in range(1, k + 1)], dtype=np.int64)
    return a, b


def hash_params_64(k: int) -> tuple[np.ndarray, np.ndarray]:
    """Parameters of hash function i (1-based): the first 8 bytes of the MD5 of 'a<i>' (made odd) and of 'b<i>'."""
    eight = lambda s: int.from_bytes(hashlib.md5(s.encode()).digest()[:8], "big")
    return (np.array([eight(f"a{i}") | 1 for i in range(1, k + 1)], dtype=np.uint64),
            np.array([eight(f"b{i}") for i in range(1, k + 1)], dtype=np.uint64))


def shingles(words, n: int) -> set[str]:
    """Distinct word n-grams joined by one space; a document shorter than n words is one shingle, without words none."""
    words = list(words)
    if not words:
        return set()
    if len(words) < n:
        return {" ".join(words)}
    return {" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}


CHUNK_VALUES = 1 << 17  # hash values (shingles x functions) held at once, 1 MB


def signature_31(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.full(len(a), P31, dtype=np.int64)
    h, chunk = np.asarray(hashes, dtype=np.int64), max(1, CHUNK_VALUES // len(a))
    for lo in range(0, len(h), chunk):
        np.minimum(out, ((a[:, None] * h[None, lo:lo + chunk] + b[:, None]) % P31).min(axis=1), out=out)
    return out


def signature_64(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.full(len(a), 2**64 - 1, dtype=np.uint64)
    h, chunk = np.asarray(hashes, dtype=np.int64).view(np.uint64), max(1, CHUNK_VALUES // len(a))
    for lo in range(0, len(h), chunk):
        np.minimum(out, (a[:, None] * h[None, lo:lo + chunk] + b[:, None]).min(axis=1), out=out)
    return out.view(np.int64)


def _signature_udf(cfg: MinhashConfig):
    minima, params = (signature_64, hash_params_64) if cfg.family == "xx64" else (signature_31, hash_params)
    a, b = params(cfg.num_hashes)

    @F.arrow_udf(Ty.ArrayType(Ty.LongType()))
    def sig(hashes: pa.Array) -> pa.Array:
        # flat on both sides: a batch costs its hashes and 8 bytes a value of its signatures, no Python numbers
        # (the one hash of a null text is null and counts as the least number)
        values, ends = hashes.values.fill_null(-1 << 63).to_numpy(), hashes.offsets.to_numpy()
        some = hashes.is_valid().to_numpy(zero_copy_only=False) & (np.diff(ends) > 0)
        out = np.empty((int(some.sum()), len(a)), dtype=np.int64)
        for row, i in enumerate(np.flatnonzero(some)):
            out[row] = minima(values[ends[i]:ends[i + 1]], a, b)
        at = np.concatenate([[0], np.cumsum(some)]) * len(a)
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(out.ravel()), mask=pa.array(~some))

    # Marked non-deterministic only so that a filter on the signature is never pushed below the projection (and below a
    # spread of the input), where it would run the UDF a second time. The values are deterministic.
    return sig.asNondeterministic()


def shingle_hashes(words: Column, n: int, family: str = "xx64") -> Column:
    """Hash of every shingle, computed in the JVM (``xx64``: xxhash64, ``affine31``: from the MD5); null for a document without words."""
    def one(shingle: Column) -> Column:
        return F.xxhash64(shingle) if family == "xx64" else F.conv(F.substring(F.md5(shingle.cast("binary")), 1, 8), 16, 10).cast("bigint") % P31
    return let(words, lambda w: F.when(F.size(w) == 0, F.lit(None)).otherwise(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1))), lambda i: one(F.array_join(F.slice(w, i, n), " ")))))


def signatures(df: DataFrame, cfg: MinhashConfig = PER_COLLECTION, *, id_col: str = "doc_id",
               text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., id, sig ARRAY<BIGINT>) for every document."""
    if cfg.family not in ("xx64", "affine31"):
        raise ValueError(f"unknown hash family {cfg.family!r}")
    hashes = shingle_hashes(norm_words(F.col(text_col)), cfg.n_grams, cfg.family)
    # behind a Generate: the hashes are made in the JVM before the UDF, not as part of its argument
    hashed = df.select(*keep, F.col(id_col).alias("id"), F.inline(F.array(F.struct(hashes.alias("_h")))))
    return hashed.select(*keep, "id", _signature_udf(cfg)("_h").alias("sig"))


def band_keys(sigs: DataFrame, cfg: MinhashConfig = PER_COLLECTION, scope: tuple[str, ...] = ()) -> DataFrame:
    """(scope..., id, band, k1, k2): one row per document with a signature and band; (k1, k2) is a 128-bit key of the band."""
    sigs = sigs.where(F.col("sig").isNotNull())  # stays above the UDF, see _signature_udf
    r = cfg.rows
    bands = F.array(*[F.struct(F.lit(i).alias("band"),
                               F.xxhash64(F.lit("k1"), F.slice("sig", i * r + 1, r)).alias("k1"),
                               F.xxhash64(F.lit("k2"), F.slice("sig", i * r + 1, r)).alias("k2"))
                      for i in range(cfg.bands)])
    return sigs.select(*scope, "id", F.explode(bands).alias("b")).select(*scope, "id", "b.band", "b.k1", "b.k2")


def bucket_edges(keys: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """(scope..., id, band, dup_of): each document that shares a band bucket with a smaller id points at the
    bucket's smallest id (star edges: linear in the bucket size, never all pairs).

    The keys are written to a table in the shared folder, so signatures are computed once. A bucket is cut into ``SALTS`` parts by id: the
    minimum of each part comes from a partial aggregation, the bucket's from its at most ``SALTS`` parts, and it is joined
    back by (bucket, part). The bucket of a boilerplate page that a third of the corpus shares is thus never in one task,
    whatever AQE does.
    """
    spark = keys.sparkSession
    k = list(scope) + ["band", "k1", "k2"]
    keys = keys.withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    path = scratch_path(spark, "band_keys")  # a table: an eager checkpoint would compute the signatures twice
    keys.write.parquet(path)
    keys = spark.read.schema(keys.schema).parquet(path)
    parts = keys.groupBy(*k, "_part").agg(F.min("id").alias("_m"), F.count(F.lit(1)).alias("_n"))
    mins = (parts.groupBy(*k).agg(F.min("_m").alias("dup_of"), F.sum("_n").alias("_all")).where(F.col("_all") > 1))
    mins = parts.join(mins, k).select(*k, "_part", "dup_of")
    return (keys.join(mins, [*k, "_part"]).where(F.col("id") != F.col("dup_of"))
            .select(*scope, "id", "band", "dup_of"))
