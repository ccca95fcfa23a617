"""Dictionary rows: synonym lists, proverb notes, and the job that runs both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandemtext.functions.text import is_blank, length_ratio, strip

SEPARATOR = r"\s*[,;]\s*"
#: Most words of a synonym and of the Moore side.
MOST_WORDS = 4


def words_of(text: Column) -> Column:
    return F.size(F.filter(F.split(strip(text), r"\s+"), lambda w: w != ""))


def is_synonym_list(french: Column, moore: Column) -> Column:
    """Two short terms or more between separators, no sentence mark, a short Moore side."""
    parts = F.filter(F.split(strip(french), SEPARATOR), lambda p: p != "")
    short = F.forall(parts, lambda p: (words_of(p) <= MOST_WORDS) & ~p.rlike(r"[.!?]"))
    return F.coalesce(french.rlike("[,;]") & (F.size(parts) >= 2) & short & (words_of(moore) <= MOST_WORDS), F.lit(False))


def explode_synonyms(df: DataFrame) -> DataFrame:
    """One row per synonym: French and English lists are paired, the shorter one repeats its last term.

    Rows that are no list, or whose Moore side is a list itself, stay as they
    are (``synonym_no`` is null there). Other columns are carried along.
    """
    french, english, moore = F.col("french"), F.col("english"), F.col("moore")
    splits = is_synonym_list(french, moore) & ~F.coalesce(moore.rlike("[,;]"), F.lit(False))
    a = F.filter(F.split(strip(french), SEPARATOR), lambda p: p != "")
    b = F.filter(F.split(strip(F.coalesce(english, F.lit(""))), SEPARATOR), lambda p: p != "")
    paired = F.transform(
        F.arrays_zip(a.alias("f"), b.alias("e")),
        lambda z: F.struct(F.coalesce(z["f"], F.try_element_at(a, F.lit(-1)), F.lit("")).alias("f"), F.coalesce(z["e"], F.try_element_at(b, F.lit(-1)), F.lit("")).alias("e")),
    )
    one = F.array(F.struct(french.alias("f"), english.alias("e")))
    rows = df.withColumn("__split", splits).select("*", F.posexplode(F.when(F.col("__split"), paired).otherwise(one)).alias("__no", "__z"))
    return rows.withColumns({"french": F.col("__z.f"), "english": F.col("__z.e"), "synonym_no": F.when(F.col("__split"), F.col("__no") + 1)}).drop("__split", "__no", "__z")


def strip_proverb(text: Column) -> Column:
    """Without proverb notes: in parentheses, trailing after a sentence, or as a prefix; doubled stops become one."""
    out = F.regexp_replace(text, r"(?is)\s*\(\s*(?:Proverbe|Proverb)\s*:[^)]*\)", "")
    out = F.regexp_replace(out, r"(?is)(?<=[.!?])\s*(?:Proverbe|Proverb)\s*:.*$", "")
    out = F.regexp_replace(out, r"(?is)^\s*(?:Proverbe|Proverb)\s*:\s*", "")
    return F.regexp_replace(out, r"(?<!\.)\.\.(?!\.)", ".")


def strip_proverbs(df: DataFrame) -> DataFrame:
    """French and English without notes; ``len_ratio`` anew where present and both sides have text."""
    out = df.withColumns({c: strip_proverb(F.col(c)) for c in ("french", "english") if c in df.columns})
    if "len_ratio" not in df.columns:
        return out
    full = ~is_blank(F.col("french")) & ~is_blank(F.col("moore"))
    return out.withColumn("len_ratio", F.when(F.col("len_ratio").isNotNull() & full, length_ratio(F.col("french"), F.col("moore"))).otherwise(F.col("len_ratio")))


def clean_lexicon(df: DataFrame, proverbs: bool = True, synonyms: bool = True) -> DataFrame:
    """Strip notes first, then split synonyms."""
    if not proverbs and not synonyms:
        raise ValueError("choose at least one step")
    out = strip_proverbs(df) if proverbs else df
    return explode_synonyms(out) if synonyms else out
