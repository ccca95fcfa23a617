"""Exact removal of duplicates: first wins, and best of each connected component."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tandemtext.session import cut_lineage


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``; null keys are equal to each other."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(window)).where("__r = 1").drop("__r")


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of which any single key occurs more than once. Counts are pre-aggregated, so a hot key costs one row a task."""
    out = df.withColumn("__hit", F.lit(False))
    for k in keys:
        many = df.groupBy(F.col(k).alias("__k")).count().where("count > 1 and __k is not null").select("__k", F.lit(True).alias("__many"))
        out = out.join(many, out[k] == many["__k"], "left").withColumn("__hit", F.col("__hit") | F.coalesce("__many", F.lit(False))).drop("__k", "__many")
    return out.where("__hit").drop("__hit")


def components(df: DataFrame, key: str, links: Sequence[str], most_rounds: int = 60) -> DataFrame:
    """``df`` with ``component``: the least key among rows linked by equal values of any column of ``links``, transitively.

    Rows are joined through the values (a star, never all pairs of a value),
    whose 128-bit digests stand for them in every shuffle.
    Each round sends a value the least label of its rows (a pre-aggregated
    minimum) and every row the least of its values' labels, then jumps to the
    label of its label; long chains so halve. Labels are checkpointed each
    round. Only rows that share a value take part; the others are their own component.
    """
    edges = None
    for n, column in enumerate(links):
        part = df.where(F.col(column).isNotNull()).select(F.col(key).alias("id"), F.md5(F.concat(F.lit(f"{n}:"), F.col(column).cast("string"))).alias("value"))
        edges = part if edges is None else edges.union(part)
    edges = edges.distinct()
    shared = edges.groupBy("value").count().where("count > 1").select("value")
    edges = cut_lineage(edges.join(shared, "value", "left_semi"))  # a value of one row links nothing
    labels = cut_lineage(edges.select("id", F.col("id").alias("label")).distinct())
    for _ in range(most_rounds):
        least = edges.join(labels, "id").groupBy("value").agg(F.min("label").alias("m"))
        seen = edges.join(least, "value").groupBy("id").agg(F.min("m").alias("m"))
        stepped = labels.join(seen, "id", "left").select("id", "label", F.least("label", F.coalesce("m", "label")).alias("m"))
        jump = stepped.select(F.col("id").alias("m"), F.col("m").alias("j"))
        new = cut_lineage(stepped.join(jump, "m", "left").select("id", F.col("label").alias("old"), F.least("m", F.coalesce("j", "m")).alias("label")))
        if new.where("old <> label").isEmpty():
            found = new.select(F.col("id").alias(key), F.col("label").alias("component"))
            return df.join(found, key, "left").withColumn("component", F.coalesce("component", F.col(key)))
        labels = new.select("id", "label")
    raise RuntimeError(f"no fixpoint after {most_rounds} rounds")


def keep_best(df: DataFrame, key: str, links: Sequence[str], score: str) -> DataFrame:
    """The row of highest score of each component (nulls last; ties by least key); rows without duplicates stay."""
    window = Window.partitionBy("component").orderBy(F.col(score).desc_nulls_last(), key)
    return components(df, key, links).withColumn("__r", F.row_number().over(window)).where("__r = 1").drop("__r")
