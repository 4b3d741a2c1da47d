"""A Bloom filter as a table of 64-bit words, built and probed with built-in functions.

Every id sets ``BITS`` bits of one word, so a probe is one lookup. The table is small enough to broadcast by
construction: ``max_words`` bounds it, and more ids only make it less selective. What it lets through has to be joined
exactly by the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 4
BITS_AN_ID = 12
MAX_WORDS = 4 << 20


def _mask(key: Column) -> Column:
    h = F.xxhash64(F.lit(2), key)
    out = F.lit(0).cast("bigint")
    for k in range(BITS):
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")))
    return out


def _slot(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), key), F.lit(words).cast("bigint"))


def words_for(n: int, max_words: int = MAX_WORDS) -> int:
    return min(max_words, max(1, -(-n * BITS_AN_ID // 64)))


def build(keys: DataFrame, key: Column, words: int) -> DataFrame:
    """(_slot, _word): at most ``words`` rows. Null keys are left out."""
    keys = keys.where(key.isNotNull())
    return keys.groupBy(_slot(key, words).alias("_slot")).agg(F.bit_or(_mask(key)).alias("_word"))


def may_hold(df: DataFrame, key: Column, table: DataFrame, words: int, name: str) -> DataFrame:
    """``df`` with the boolean ``name``: false only for keys that were not put in. One broadcast join, no shuffle."""
    probed = df.join(F.broadcast(table), _slot(key, words) == F.col("_slot"), "left")
    hit = key.isNotNull() & F.coalesce(F.col("_word").bitwiseAND(_mask(key)) == _mask(key), F.lit(False))
    return probed.withColumn(name, hit).drop("_slot", "_word")
