"""Exact distinct counts that can be merged: bitmaps of whole numbers.

A number n is bit ``n & 63`` of word ``n >> 6``.  ``number_bits`` gives one
64-bit word per (keys, word); the words of a coarser grouping are their
bitwise or, and its distinct count is the number of bits set.  So one table
at a fine grain serves every coarser distinct count, with fixed-width hash
aggregates only, and a hot group costs a task one row a word.  (Spark's
``bitmap_construct_agg`` holds 4 KB a group whatever it contains, which is
more than the rows themselves for a log's few hundred sessions a year.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD, BITS = "_word", "_bits"


def number_bits(df: DataFrame, keys, number: str) -> DataFrame:
    """(keys, word, bits) of the distinct values of ``number``.

    NULL numbers are in no bitmap, but their group stays (word NULL, no bit
    set), as a distinct count of it is 0.  Negative numbers have words too.
    """
    n = F.col(number).cast("bigint")
    bit = F.when(n.isNotNull(), F.expr(f"shiftleft(1L, CAST(CAST(`{number}` AS BIGINT) & 63 AS INT))")).otherwise(F.lit(0))
    return (df.select(*keys, F.shiftright(n, 6).alias(WORD), bit.cast("bigint").alias(BITS))
              .groupBy(*keys, WORD).agg(F.bit_or(BITS).alias(BITS)))


def merge_bits(table: DataFrame, keys) -> DataFrame:
    """The bitmaps of a coarser grouping."""
    return table.groupBy(*keys, WORD).agg(F.bit_or(BITS).alias(BITS))


def count_bits(table: DataFrame, keys, name: str) -> DataFrame:
    """(keys, name): distinct numbers per group, from bitmaps of any finer grouping."""
    return merge_bits(table, keys).groupBy(*keys).agg(
        F.coalesce(F.sum(F.bit_count(F.col(BITS))), F.lit(0)).cast("bigint").alias(name))
