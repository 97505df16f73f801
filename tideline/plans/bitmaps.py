"""Exact key sets as compressed bitmaps, for integer references too large to broadcast as rows.

Keys are cut into blocks of 2**15 consecutive numbers, 512 words of 64 bits each: a block is
one row of 4 KB, whether it holds one key or all 32,768.  100 million dense keys are some
3,000 rows and 13 MB.  The number of blocks is counted before anything is built; a set that
does not fit the bound (sparse or random keys) is left to the shuffled join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.session import materialize

WORDS = 512
BLOCK_BYTES = 8 * WORDS + 64
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_integral(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, INTEGRAL)


def block_of(key: Column) -> Column:
    return F.shiftright(key.cast("long"), 15)


def key_blocks(keys: DataFrame, max_bytes: int) -> DataFrame | None:
    """``block, words`` for the non-null keys of a one-column integer DataFrame; None if they take more than ``max_bytes``."""
    most = max_bytes // BLOCK_BYTES
    k = F.col(keys.columns[0]).cast("long")
    if most < 1 or keys.select(block_of(k).alias("block")).distinct().limit(most + 1).count() > most:
        return None
    bits = F.shiftright(F.col("k"), 6)
    words = keys.select(k.alias("k")).groupBy(bits.alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(k & 63 as int))")).alias("bits"))
    entry = F.struct(F.expr("cast(w & 511 as int)").alias("at"), "bits")
    blocks = words.groupBy(F.shiftright("w", 9).alias("block")).agg(F.map_from_entries(F.collect_list(entry)).alias("m"))  # at most 512 words
    dense = F.expr(f"transform(sequence(0, {WORDS - 1}), i -> coalesce(try_element_at(m, i), 0L))")
    return materialize(blocks.select("block", dense.alias("words")), "key-blocks")


def has_key(key: Column, words: Column) -> Column:
    """Whether ``key`` is in the block that has been joined to it; false for a null key or without a block."""
    word = F.try_element_at(words, (F.shiftright(key.cast("long"), 6).bitwiseAND(F.lit(WORDS - 1)) + 1).cast("int"))
    return F.coalesce(F.getbit(word, key.cast("long").bitwiseAND(F.lit(63)).cast("int")) == 1, F.lit(False))
