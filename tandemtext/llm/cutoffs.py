"""Score cutoffs that keep a target share of each source's records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Steps a unit of score for the coarse counts; scores beyond +-2 share the outer steps.
STEPS = 4096
#: Targets up to this number are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 10_000


def source_key(source: Column) -> Column:
    """A source however it is spelt: no outer spaces, lower case."""
    return F.lower(F.trim(source))


def score_counts(records: DataFrame, targets: DataFrame, scores: list[str]) -> DataFrame:
    """(source, score_name, score, n): how often each score occurs in each source that has a target.

    Null and NaN scores are no numbers and do not count; null sources belong to
    none. The counting is partial before the shuffle, so a source with a third
    of all rows sends one row per distinct score and task.
    """
    wanted = targets.select(source_key(F.col("source")).alias("key"), "score_name").distinct()
    lists = F.array(*[F.struct(F.lit(s).alias("score_name"), F.col(s).cast("double").alias("score")) for s in scores])
    long = records.select(source_key(F.col("source")).alias("key"), F.explode(lists).alias("s")).select("key", "s.*")
    long = long.where("key is not null and score is not null and not isnan(score)")
    return long.groupBy("key", "score_name", "score").agg(F.count("*").alias("n")).join(wanted, ["key", "score_name"], "left_semi")


def cutoffs(records: DataFrame, targets: DataFrame, scores: list[str]) -> DataFrame:
    """(source, score_name, keep_pct, cutoff, kept, total) of every target with records.

    The cutoff is the highest score at or above which at least ``keep_pct``
    percent of the source's counted records lie; all ties at the cutoff are
    kept. Descending running sums go over compact counts in two levels: first
    over at most ``4 * STEPS`` coarse steps of a source, then over the distinct
    scores of the one step in which the target falls, so no task orders all
    scores of a source. A target without counted records gives no row; repeated
    target rows give one.
    """
    counts = score_counts(records, targets, scores)
    step = F.floor(F.least(F.greatest(F.col("score"), F.lit(-2.0)), F.lit(2.0)) * STEPS)
    counts = counts.withColumn("step", step)
    coarse = counts.groupBy("key", "score_name", "step").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy("key", "score_name")
    above = whole.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.select(
        "key", "score_name", "step", "n",
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("total"),
    )
    goals = targets.select("source", source_key(F.col("source")).alias("key"), "score_name", "keep_pct").distinct()
    enough = lambda n: n * 100 >= F.col("keep_pct") * F.col("total")
    hit = goals.join(coarse, ["key", "score_name"]).where(enough(F.col("before") + F.col("n")) & ~enough(F.col("before")) | ((F.col("before") == 0) & (F.col("keep_pct") <= 0)))
    fine = hit.drop("n").join(counts, ["key", "score_name", "step"])
    inside = Window.partitionBy("source", "score_name", "keep_pct").orderBy(F.desc("score"))
    fine = fine.withColumn("kept", F.col("before") + F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.row_number().over(inside)
    fine = fine.where(enough(F.col("kept"))).withColumn("first", first).where("first = 1")
    return fine.select("source", "score_name", "keep_pct", F.col("score").alias("cutoff"), "kept", "total")


def kept_records(records: DataFrame, targets: DataFrame, scores: list[str], key: str = "pair_id") -> DataFrame:
    """(source, score_name, keep_pct, key): every record at or above its source's cutoff, spelt as in the targets.

    ``records`` has one row per record. The cutoffs are as many as the targets;
    they are broadcast only after their number has been checked.
    """
    found = cutoffs(records, targets, scores)
    found = found.withColumn("key", source_key(F.col("source")))
    if targets.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    lists = F.array(*[F.struct(F.lit(s).alias("score_name"), F.col(s).cast("double").alias("score")) for s in scores])
    long = records.select(F.col(key).alias("record"), source_key(F.col("source")).alias("key"), F.explode(lists).alias("s"))
    long = long.select("record", "key", "s.*").where("score is not null and not isnan(score)")
    kept = long.join(found, ["key", "score_name"]).where("score >= cutoff")
    return kept.select("source", "score_name", "keep_pct", F.col("record").alias(key))
