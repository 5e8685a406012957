"""A Bloom filter of join keys, built from aggregates and read as a scalar subquery.

The semi join that cuts a large table to asked-for keys shuffles every row of
it, wide columns included. The filter drops nearly all unwanted rows at the
scan: each key sets four bits in one 64-bit word, and the words, a few megabytes
at most whatever the data, reach the scan as one array. A filter computes an
expression again wherever it stands, so the hash of the keys, which may be long
texts put together on the way, stands in it three times only: for the word and,
by a table of masks and a shift, for the bits. It lets a few unwanted
rows through and never drops a wanted one, so the exact join still follows.
Spark's own runtime filter needs a selective predicate on the key side, which a
stored table of keys does not have.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_KEY = 16
LEAST_WORDS = 1 << 6
MOST_WORDS = 1 << 20  # 8 MB; with more keys than that suits, more rows pass
EXPECTED_KEYS = 1_000_000
_MASK_BITS = 10


def _masks() -> list[int]:
    """Fixed masks with four bits each, below 2^49, to be shifted by up to 15 places."""
    draw = random.Random(0)
    return [sum(1 << b for b in draw.sample(range(49), 4)) for _ in range(1 << _MASK_BITS)]


_MASKS = f"array({','.join(f'{m}L' for m in _masks())})"


def filter_words(expected: int) -> int:
    """Number of 64-bit words for the keys expected, a power of two within fixed bounds."""
    wanted = max(1, expected) * BITS_PER_KEY // 64
    return min(MOST_WORDS, max(LEAST_WORDS, 1 << wanted.bit_length()))


def _place(keys: list[Column], words: int) -> tuple[Column, Column]:
    """Word and bits of a key; the hash of the key stands in them three times."""
    h = F.xxhash64(*keys)
    slot = h.bitwiseAND(F.lit(words - 1).cast("long")).cast("int")
    mask = F.get(F.expr(_MASKS), F.shiftrightunsigned(h, 64 - _MASK_BITS).cast("int"))
    return slot, F.call_function("shiftleft", mask, F.shiftrightunsigned(h, 40).bitwiseAND(F.lit(15)).cast("int"))


def possible(keys: DataFrame, columns: list[str], expected: int = EXPECTED_KEYS) -> Column:
    """Whether a row's ``columns`` may be among those of ``keys``: true for all that are, and for few others.

    The columns have the same types on both sides. ``expected`` keys set the
    size of the filter, up to a fixed bound.
    """
    words = filter_words(expected)
    slot, mask = _place([F.col(c) for c in columns], words)
    set_words = keys.select(slot.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))
    every = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("_word"))
    filled = every.join(set_words, "_word", "left").select("_word", F.coalesce("_mask", F.lit(0).cast("long")).alias("_mask"))
    gathered = filled.agg(F.array_sort(F.collect_list(F.struct("_word", "_mask"))).alias("all"))
    array = gathered.select(F.transform("all", lambda x: x["_mask"]).alias("words")).scalar()
    return F.bitwise_not(F.get(array, slot)).bitwiseAND(mask) == 0


def keep_possible(rows: DataFrame, keys: DataFrame, columns: list[str], expected: int = EXPECTED_KEYS) -> DataFrame:
    """Rows that are ``possible``; no row whose ``columns`` are among those of ``keys`` is lost."""
    return rows.filter(possible(keys, columns, expected))
