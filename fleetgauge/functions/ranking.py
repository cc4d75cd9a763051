"""Latest-per-key and top-n-per-key selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# How many slices a key is ranked in before the final ranking, so that one hot key
# is shared by many tasks instead of landing in one.
SLICES = 32


def rank_per(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], name: str = "rn") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def newest_per(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key in ``order``, ranked in ``rn``.

    For small ``n``: the limit is applied in each map task before the shuffle, so a key of any size
    sends at most ``n`` rows per task.
    """
    return rank_per(df, keys, order).filter(F.col("rn") <= n)


def newest_of_series(df: DataFrame, keys: Sequence[str], names: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per series in ``order``; in ``names`` a NULL and an empty text are the same series.

    A row is ranked with each name once, and with a number that tells which were NULL, instead of with the names and keys
    made of them, which takes less memory to sort.
    """
    bits = [F.when(F.col(c).isNull(), F.lit(1 << at)).otherwise(F.lit(0)) for at, c in enumerate(names)]
    plain = df.withColumns({"_nulls": reduce(add, bits), **{c: F.coalesce(c, F.lit("")) for c in names}})
    first = newest_per(plain, [*keys, *names], order)
    given = {c: F.when(F.col("_nulls").bitwiseAND(1 << at) == 0, F.col(c)) for at, c in enumerate(names)}
    return first.withColumns(given).drop("rn", "_nulls")


def top_per(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    tie: Sequence[str],
    n: int,
    slices: int = SLICES,
) -> DataFrame:
    """The first ``n`` rows per key, ranked in ``rn``; ``tie`` completes the order to a total one.

    Ranked twice: per slice of a key first, then over the at most ``slices * n`` survivors.  The top
    of the slices' tops is the top of the key, so the result does not depend on ``slices``.
    """
    total = [*order, *(F.col(t).asc() for t in tie)]
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*tie), F.lit(slices)))
    survivors = newest_per(sliced, [*keys, "_slice"], total, n).drop("rn", "_slice")
    return newest_per(survivors, keys, total, n)


def top_overall(df: DataFrame, order: Sequence[Column], tie: Sequence[str], n: int, slices: int = 256) -> DataFrame:
    """The first ``n`` rows of the whole frame, in order; rows that repeat ``tie`` count once."""
    total = [*order, *(F.col(t).asc() for t in tie)]
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*tie), F.lit(slices)))
    # Repeats share a rank, so they crowd nothing else out of their slice.
    place = F.dense_rank().over(Window.partitionBy("_slice").orderBy(*total))
    survivors = sliced.withColumn("rn", place).filter(F.col("rn") <= n).drop("rn", "_slice")
    return survivors.dropDuplicates(list(tie)).orderBy(*total).limit(n)
