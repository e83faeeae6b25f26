"""Lookup tables of fixed size as scalars of a plan.

A table has as many slots as its caller says, whatever the input, so it may
travel with every task. Rows are combined per slot before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import checkpointed

FLAGS = 1 << 21


def slot(key: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(5), key), F.lit(size)).cast("int")


def table(rows: DataFrame, size: int) -> Column:
    """The array of v by slot, from one row (slot, v) per slot in use; the others hold 0."""
    every = rows.sparkSession.range(size).select(F.col("id").cast("int").alias("slot"))
    full = every.join(rows, "slot", "left").select("slot", F.coalesce("v", F.lit(0)).alias("v"))
    dense = full.agg(F.transform(
        F.array_sort(F.collect_list(F.struct("slot", "v"))), lambda s: s["v"]).alias("a"))
    return checkpointed(dense).scalar()


def marked(keys: DataFrame, key: Column, size: int = FLAGS) -> Column:
    """A bit table of the keys: `test` is true for all of them and, by chance, for others."""
    bits = keys.select(slot(key, size).alias("s")).groupBy(
        F.shiftright("s", 6).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, s & 63)")).alias("v"))
    return table(bits, size // 64)


def test(bits: Column, key: Column, size: int = FLAGS) -> Column:
    s = slot(key, size)
    word = F.element_at(bits, F.shiftright(s, 6) + 1)
    return F.getbit(word, s.bitwiseAND(F.lit(63))) == 1
