"""Deterministic shuffles, slices and stratified splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandemtext.operators import ranges

#: Rows below which a stratum goes to train whole; share of a stratum that dev and test may each take.
LEAST_ROWS, MOST_SHARE = 3, 3


def shuffle_key(seed: int, keys: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))


def shuffled(df: DataFrame, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Rows in a fixed random order."""
    return df.orderBy(shuffle_key(seed, keys), *keys)


def row_slice(df: DataFrame, order: Sequence[str], start: int | None = None, end: int | None = None) -> DataFrame:
    """Rows ``start:end`` of an ordered table as Python slices them, in order, negative and open ends included.

    Rows are numbered in ranges of their order (see ``ranges``): no task sees all of them.
    """
    numbered = ranges.sum_before(ranges.in_ranges(df, [], order), [], order, F.lit(1), "__place")
    total = F.lit(0) if (start or 0) >= 0 and (end or 0) >= 0 else F.lit(df.count())
    bound = lambda n: total + n if n < 0 else F.lit(n)
    out = numbered if start is None else numbered.where(F.col("__place") >= bound(start))
    return (out if end is None else out.where(F.col("__place") < bound(end))).drop("__place", ranges.PART).orderBy(*order)


def stratified_split(df: DataFrame, stratum: str, keys: Sequence[str], dev: int, test: int, seed: int = 42, name: str = "split") -> DataFrame:
    """``df`` with a split column: each stratum gives dev and test their share, at least one row, at most a third each.

    The share is target / all rows, rounded half to even; strata of fewer than
    three rows go to train. The rank of a row in its stratum needs no task to
    hold the stratum: the first 16 bits of the shuffle key cut it into ranges
    that are counted first and ranked one by one.
    """
    total = df.agg(F.count("*").alias("__total"))
    keyed = df.withColumn("__h", shuffle_key(seed, keys)).withColumn("__b", F.substring("__h", 1, 4))
    sizes = keyed.groupBy(stratum, "__b").agg(F.count("*").alias("__n"))
    whole = Window.partitionBy(stratum)
    before = F.coalesce(F.sum("__n").over(whole.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col(stratum).alias("__s"), F.col("__b").alias("__c"), before.alias("__before"), F.sum("__n").over(whole).alias("__size"))
    rank = F.row_number().over(Window.partitionBy(stratum, "__b").orderBy("__h", *keys))
    ranked = keyed.withColumn("__r", rank).join(sizes, F.col(stratum).eqNullSafe(F.col("__s")) & (F.col("__b") == F.col("__c"))).join(F.broadcast(total))
    place, size = F.col("__r") + F.col("__before"), F.col("__size")

    def share(target: int) -> Column:
        wanted = F.greatest(F.lit(1), F.rint(size * (F.lit(float(target)) / F.col("__total"))).cast("long"))
        return F.when(size < LEAST_ROWS, F.lit(0)).otherwise(F.least(wanted, F.floor(size / MOST_SHARE)))

    split = F.when(place <= share(dev), "validation").when(place <= share(dev) + share(test), "test").otherwise("train")
    return ranked.withColumn(name, split).drop("__h", "__b", "__s", "__c", "__r", "__before", "__size", "__total")
