"""Summary reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandemtext.functions.text import round4
from tandemtext.operators import ranges

SHARES = (0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)


def counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n")).orderBy(*by)


def score_stats(df: DataFrame, score: str, *by: str) -> DataFrame:
    """(by..., n, mean, median, least, most) of a score; null and NaN do not count; the median is exact."""
    value = F.col(score)
    usable = df.where(value.isNotNull() & ~F.isnan(value.cast("double")))
    plain = usable.groupBy(*by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.min(value).alias("least"), F.max(value).alias("most"))
    names = {c: f"__m_{c}" for c in by}
    median = ranges.quantiles(usable, score, [0.5], by).select(*[F.col(c).alias(n) for c, n in names.items()], F.col("value").alias("median"))
    on = F.lit(True)
    for c, n in names.items():
        on = on & F.col(c).eqNullSafe(F.col(n))
    return plain.join(median, on).select(*by, "n", "mean", "median", "least", "most")


def percentiles(df: DataFrame, score: str, shares: Sequence[float] = SHARES) -> DataFrame:
    """(share, value): exact percentiles with linear interpolation."""
    return ranges.quantiles(df, score, shares)


def histogram(df: DataFrame, score: str, bins: int = 40) -> DataFrame:
    """(bin, n): equal bins between least and most, the last closed; empty bins are left out."""
    value = F.col(score).cast("double")
    usable = df.where(value.isNotNull() & ~F.isnan(value))
    edges = usable.agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    place = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(F.least(F.floor((value - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins), F.lit(bins - 1)))
    return usable.join(F.broadcast(edges)).groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def label_histogram(df: DataFrame, labels: str = "quality_warnings") -> DataFrame:
    """(label, n, percent): rows with each label, most frequent first (ties by label), and their share of all rows."""
    total = df.agg(F.count("*").alias("__t"))
    found = df.select(F.explode(labels).alias("label")).groupBy("label").agg(F.count("*").alias("n"))
    return found.join(F.broadcast(total)).select("label", "n", round4(F.col("n") * 100 / F.col("__t")).alias("percent")).orderBy(F.desc("n"), "label")


def warning_summary(df: DataFrame) -> DataFrame:
    """One row: rows, rows with a warning, their percent, mean consistency and mean ratio (0.0 for none)."""
    some = F.count_if(F.size("quality_warnings") > 0)
    return df.agg(
        F.count("*").alias("n"), some.alias("warned"), F.coalesce(round4(F.try_divide(some * 100, F.count("*"))), F.lit(0.0)).alias("percent"),
        F.coalesce(F.avg("identification_consistency"), F.lit(0.0)).alias("mean_consistency"), F.coalesce(F.avg("len_ratio"), F.lit(0.0)).alias("mean_len_ratio"),
    )


def pass_rate(df: DataFrame, check: Column) -> DataFrame:
    return df.agg((F.avg(F.coalesce(check, F.lit(False)).cast("int")) * 100).alias("percent"))


def match_rate(matched: DataFrame, total: DataFrame) -> DataFrame:
    m, t = matched.agg(F.count("*").alias("matched")), total.agg(F.count("*").alias("total"))
    return m.join(F.broadcast(t)).withColumn("percent", F.coalesce(round4(F.try_divide(F.col("matched") * 100, F.col("total"))), F.lit(0.0)))


def dictionary_stats(entries: DataFrame) -> DataFrame:
    """One row over parsed dictionary entries: entries, senses, examples, entries with variants and with a phonetic form."""
    examples = F.aggregate(F.transform("senses", lambda s: F.size(s["examples"])), F.lit(0), lambda a, x: a + x)
    return entries.agg(
        F.count("*").alias("entries"), F.sum(F.size("senses")).alias("senses"), F.sum(examples).alias("examples"),
        F.count_if(F.size("variants") > 0).alias("with_variants"), F.count_if(F.coalesce("ipa", F.lit("")) != "").alias("with_ipa"),
    )


def kind_histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def best_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group in ``order``; map tasks keep one row per group before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(window)).where("__r = 1").drop("__r")


def replace_if_larger(chapters: DataFrame, number: str, order: str, size: str) -> DataFrame:
    """One row per chapter number: of several the last that is at least as large as those before, at the first one's place."""
    largest = Window.partitionBy(number).orderBy(F.desc(size), F.desc(order))
    first = F.min(order).over(Window.partitionBy(number))
    return chapters.withColumns({"__r": F.row_number().over(largest), "place": first}).where("__r = 1").drop("__r")


def failures(df: DataFrame, status: str = "parse_status") -> DataFrame:
    return df.agg(F.count_if(F.col(status) != "ok").alias("failed"), F.count("*").alias("total"))
