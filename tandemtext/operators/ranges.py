"""Ordered folds without a task that holds a whole scope: rows are cut into ranges of their order, folded there, and the folds carried over."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandemtext.session import cut_lineage

PART = "__part"


def in_ranges(df: DataFrame, scope: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with the number of its range of (scope, order); equal keys share a range.

    The cut is written to a checkpoint, so that every fold sees the same ranges.
    """
    return cut_lineage(df.repartitionByRange(*scope, *order).withColumn(PART, F.spark_partition_id()))


def _with_earlier(cut: DataFrame, scope: Sequence[str], folds: DataFrame) -> DataFrame:
    """The rows with what ``folds`` has for their scope and range. A range gives one row a scope, so this is small beside ``cut``."""
    names = {c: f"__f_{c}" for c in (*scope, PART)}
    named = folds.select(*[F.col(c).alias(n) for c, n in names.items()], *[c for c in folds.columns if c not in names])
    on = F.lit(True)
    for c, n in names.items():
        on = on & F.col(c).eqNullSafe(F.col(n))
    return cut.join(named, on).drop(*names.values())


def sum_before(cut: DataFrame, scope: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """``cut`` (see :func:`in_ranges`) with the sum of ``value`` over the rows before within the scope; 0 for the first."""
    sums = cut.groupBy(*scope, PART).agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(*scope).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    folds = sums.select(*scope, PART, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__earlier"))
    own = Window.partitionBy(*scope, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = _with_earlier(cut.withColumn("__own", F.coalesce(F.sum(value).over(own), F.lit(0))), scope, folds)
    return out.withColumn(name, F.col("__own") + F.col("__earlier")).drop("__own", "__earlier")


def last_before(cut: DataFrame, scope: Sequence[str], order: Sequence[str], value: Column, name: str, inclusive: bool = False) -> DataFrame:
    """``cut`` with the last value that is not null of the rows before within the scope (and the row's own if ``inclusive``)."""
    marked = cut.withColumn("__value", value)
    lasts = marked.groupBy(*scope, PART).agg(F.max_by("__value", F.when(F.col("__value").isNotNull(), F.struct(*order))).alias("__last"))
    earlier = Window.partitionBy(*scope).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    folds = lasts.select(*scope, PART, F.last("__last", ignorenulls=True).over(earlier).alias("__earlier"))
    own = Window.partitionBy(*scope, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    out = _with_earlier(marked.withColumn("__own", F.last("__value", ignorenulls=True).over(own)), scope, folds)
    return out.withColumn(name, F.coalesce("__own", "__earlier")).drop("__value", "__own", "__earlier")


def quantiles(df: DataFrame, column: str, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., share, value): exact quantiles with linear interpolation; null and NaN do not count.

    Distinct values are counted first (partly before the shuffle) and ranked in
    ranges, so neither a task nor an aggregation buffer holds all values of a group.
    """
    value = F.col(column)
    usable = df.where(value.isNotNull() & ~F.isnan(value.cast("double")))
    counts = in_ranges(usable.groupBy(*by, value.alias("__v")).agg(F.count("*").alias("__n")), by, ["__v"])
    ranked = sum_before(counts, by, ["__v"], F.col("__n"), "__before")
    names = {c: f"__t_{c}" for c in by}
    totals = counts.groupBy(*by).agg(F.sum("__n").alias("__total")).select(*[F.col(c).alias(n) for c, n in names.items()], "__total")
    on = F.lit(True)
    for c, n in names.items():
        on = on & F.col(c).eqNullSafe(F.col(n))
    wanted = ranked.join(totals, on).withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    place = F.col("share") * (F.col("__total") - 1)
    inside = lambda rank: F.when((F.col("__before") <= rank) & (rank < F.col("__before") + F.col("__n")), F.col("__v"))
    near = wanted.groupBy(*by, "share", "__total").agg(F.max(inside(F.floor(place))).alias("__low"), F.max(inside(F.ceil(place))).alias("__high"))
    return near.select(*by, "share", (F.col("__low") + (F.col("__high") - F.col("__low")) * (place - F.floor(place))).alias("value"))
