"""Word lists and their set algebra."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemtext.functions.text import tokens


def words_in(df: DataFrame, text: str) -> DataFrame:
    """Distinct lower-case tokens of a text column."""
    return df.select(F.explode(tokens(F.col(text))).alias("word")).distinct()


def list_words(df: DataFrame) -> DataFrame:
    """Words of a published list, whose column is named word or text."""
    column = "word" if "word" in df.columns else "text"
    return df.select(F.lower(column).alias("word")).where("word is not null and word <> ''").distinct()


def lexicon_words(df: DataFrame, text: str) -> DataFrame:
    """Dictionary vocabulary: no bracketed phonetics, blanks cut, no ``@`` tokens, leading dots then hyphens off, two letters or more."""
    bare = F.lower(F.regexp_replace(F.col(text), r"\[[^\]]*\]", " "))
    words = df.select(F.explode(F.split(bare, r"\s+")).alias("word")).where(~F.col("word").startswith("@"))
    trimmed = F.regexp_replace(F.regexp_replace("word", r"^\.+", ""), "^-+", "")
    return words.select(trimmed.alias("word")).where(F.length("word") >= 2).distinct()


def union_words(lists: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.union(b), [x.select("word") for x in lists]).distinct()


def except_words(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("word").subtract(b.select("word"))


def common_words(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("word").intersect(b.select("word"))


def foreign_words(foreign: Sequence[DataFrame], native: Sequence[DataFrame], spark: SparkSession | None = None) -> DataFrame:
    """Words of any foreign list that no native list has, sorted; an empty list without foreign ones."""
    if not foreign:
        return (spark or SparkSession.active()).createDataFrame([], "word string")
    out = union_words(foreign)
    return (except_words(out, union_words(native)) if native else out).orderBy("word")


def overlap_sizes(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: sizes of both lists, of their common part and of either rest."""
    marked = a.select("word").distinct().withColumn("a", F.lit(1)).join(b.select("word").distinct().withColumn("b", F.lit(1)), "word", "full")
    both = F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull())
    return marked.agg(F.count("a").alias("first"), F.count("b").alias("second"), both.alias("common"), (F.count("a") - both).alias("only_first"), (F.count("b") - both).alias("only_second"))


def disjoint(a: Column, b: Column) -> Column:
    return ~F.arrays_overlap(a, b)
