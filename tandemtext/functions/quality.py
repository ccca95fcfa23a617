"""Quality signals of sentence pairs as Column expressions. Null texts count as empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandemtext.functions.text import length_ratio, round4, strip, tokens

#: Emoji blocks, bullets and the signs that end a sentence.
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]"
BULLETS = "●•◦▪▸►‣⁃◆◇→−–—^*"
TERMINATORS = "[.?!…]"
NUMBERS = r"\b\d[\d.,]*\b"
BRACKETED = r"[(\[][^)\]]{2,}[)\]]"

LABELS = ("emoji", "dots_asymmetry", "number_mismatch", "parenthesis_asymmetry", "bullet_asymmetry", "foreign_words", "terminal_punctuation")
#: Shortest word that counts, fewest words that make a score, and the penalty that makes a warning.
SHORTEST, FEWEST, PENALTY = 3, 2, -2.0


def text_of(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def has_emoji(target: Column) -> Column:
    return text_of(target).rlike(EMOJI)


def dotted(text: Column) -> Column:
    """Two dots or more at the start or among the last five characters."""
    t = strip(text_of(text))
    return t.startswith("..") | F.right(t, F.lit(5)).contains("..")


def dots_asymmetry(source: Column, target: Column) -> Column:
    return dotted(source) != dotted(target)


def number_set(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text_of(text), F.lit(NUMBERS), F.lit(0)))


def number_mismatch(source: Column, target: Column) -> Column:
    """Numbers on one side only, or none in common."""
    a, b = number_set(source), number_set(target)
    none = (F.size(a) == 0) & (F.size(b) == 0)
    return F.when(none, F.lit(False)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(True)).otherwise(~F.arrays_overlap(a, b))


def parenthesis_asymmetry(source: Column, target: Column) -> Column:
    """The source has a bracketed remark, the target none."""
    return text_of(source).rlike(BRACKETED) & ~text_of(target).rlike(BRACKETED)


def bulleted(text: Column) -> Column:
    first = F.substring(strip(text_of(text)), 1, 1)
    return (first != "") & F.lit(BULLETS).contains(first)


def bullet_asymmetry(source: Column, target: Column) -> Column:
    return bulleted(source) != bulleted(target)


def terminal_score(source: Column, target: Column) -> Column:
    """``-ln(d + 1)``: d counts the difference of terminators and those beyond the first on either side."""
    s, t = (F.regexp_count(text_of(c), F.lit(TERMINATORS)) for c in (source, target))
    d = F.abs(s - t) + F.greatest(s - 1, F.lit(0)) + F.greatest(t - 1, F.lit(0))
    return F.lit(0.0) - F.log(d + F.lit(1.0))


def counted_words(text: Column) -> Column:
    """Distinct lower-case words long enough to count."""
    return F.array_distinct(F.filter(tokens(text_of(text)), lambda w: F.length(w) >= SHORTEST))


def consistency(text: Column, foreign: Column) -> Column:
    """Share of the distinct words that the foreign list does not hold; 0.0 with fewer than two words."""
    words = counted_words(text)
    native = F.size(F.array_except(words, foreign))
    return F.when(F.size(words) < FEWEST, F.lit(0.0)).otherwise(round4(native / F.size(words)))


def has_foreign_word(text: Column, foreign: Column) -> Column:
    return F.arrays_overlap(counted_words(text), foreign)


def warnings(source: Column, target: Column, foreign: Column | None = None) -> Column:
    """ARRAY<STRING> of the labels that apply, in fixed order."""
    foreign_words = F.lit(False) if foreign is None else has_foreign_word(target, foreign)
    checks = (
        has_emoji(target), dots_asymmetry(source, target), number_mismatch(source, target), parenthesis_asymmetry(source, target),
        bullet_asymmetry(source, target), foreign_words, terminal_score(source, target) < PENALTY,
    )
    return F.array_compact(F.array(*[F.when(check, F.lit(label)) for check, label in zip(checks, LABELS)]))


def with_consistency(df: DataFrame, text: str, foreign: DataFrame, key: str, name: str = "identification_consistency", flag: str = "foreign_words") -> DataFrame:
    """``df`` with the consistency score and a foreign-word flag, against a word list of any size.

    ``foreign`` has one column ``word``. The distinct words of each row meet
    the list in an equi-join on the word (adaptive execution broadcasts the list
    where its measured size allows) and go back to their row by a count; rows
    without countable words get 0.0 and false. ``key`` is unique in ``df``.
    """
    listed = foreign.select(F.col("word").alias("__w")).where("__w is not null").distinct()
    words = df.select(F.col(key).alias("__k"), F.explode(counted_words(F.col(text))).alias("__w"))
    marked = words.join(listed.withColumn("__f", F.lit(1)), "__w", "left")
    scored = marked.groupBy("__k").agg(F.count("*").alias("__n"), F.count("__f").alias("__m"))
    out = df.join(scored, df[key] == scored["__k"], "left")
    n, m = F.coalesce("__n", F.lit(0)), F.coalesce("__m", F.lit(0))
    return out.withColumns({name: F.when(n < FEWEST, F.lit(0.0)).otherwise(round4((n - m) / n)), flag: m > 0}).drop("__k", "__n", "__m")


def annotate(df: DataFrame, source: str = "french", target: str = "moore", foreign: Column | None = None) -> DataFrame:
    """``df`` with ``quality_warnings`` and ``len_ratio``, in one projection."""
    return df.withColumns({"quality_warnings": warnings(F.col(source), F.col(target), foreign), "len_ratio": length_ratio(F.col(source), F.col(target))})
