"""Row filters with stated null rules, and cascades that report what each stage drops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandemtext.operators import ranges
from tandemtext.functions.text import has_copyright, has_url, is_blank, is_number_dots, is_standalone_number


def _number(column: str) -> Column:
    """NaN becomes null: no comparison with it holds."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def at_least(column: str, least: float) -> Column:
    """Null and NaN fail."""
    return F.coalesce(_number(column) >= least, F.lit(False))


def at_least_or_null(column: str, least: float, strict: bool = False) -> Column:
    """Null and NaN pass."""
    value = F.col(column)
    return value.isNull() | (value > least if strict else value >= least)


def at_least_or_zero(column: str, least: float) -> Column:
    """Null counts as 0 and NaN fails; a least of 0 switches the filter off."""
    return F.lit(True) if least <= 0 else F.coalesce(_number(column), F.lit(0.0)) >= least


def identified(prob: str, lang: str, expected: str, least: float) -> Column:
    """Language as expected with enough probability; null and NaN fail."""
    return F.coalesce((_number(prob) >= least) & (F.col(lang) == expected), F.lit(False))


def free_of(labels: Sequence[str], column: str = "quality_warnings") -> Column:
    """None of the labels is among the row's warnings; null has none."""
    return ~F.arrays_overlap(F.coalesce(F.col(column), F.array().cast("array<string>")), F.array(*[F.lit(x) for x in labels]))


def language_gate(prob: str, sentence_prob: str, lang: str, expected: str = "mos_Latn", least: float = 0.9) -> Column:
    """Both probabilities above ``least`` and the label contains ``expected``; null and NaN count as 0 or ''."""
    return (F.coalesce(_number(prob), F.lit(0.0)) > least) & (F.coalesce(_number(sentence_prob), F.lit(0.0)) > least) & F.coalesce(F.col(lang), F.lit("")).contains(expected)


def known(df: DataFrame, stages: dict[str, tuple[str, Column]]) -> dict[str, Column]:
    """The stages whose column ``df`` has; the others are skipped."""
    return {name: check for name, (column, check) in stages.items() if column in df.columns}


def cascade(df: DataFrame, stages: dict[str, Column], name: str = "first_failed") -> DataFrame:
    """``df`` with the first stage each row fails (null where it passes all), in one pass."""
    return df.withColumn(name, F.coalesce(*[F.when(~check, F.lit(stage)) for stage, check in stages.items()], F.lit(None).cast("string")))


def cascade_counts(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """(stage, dropped): rows that each stage of a sequential filter drops; 'kept' has the rest."""
    return cascade(df, stages).groupBy(F.coalesce("first_failed", F.lit("kept")).alias("stage")).agg(F.count("*").alias("dropped"))


def dropped_by_source(df: DataFrame, keep: Column, source: str = "source") -> DataFrame:
    return df.groupBy(source).agg(F.count_if(~keep).alias("dropped"), F.count("*").alias("total"))


def gate_then_score(df: DataFrame, gate: Column, score, name: str) -> DataFrame:
    """Score only the rows that pass; the others get null. ``score`` maps a DataFrame to one with ``name``.

    Filter and union keep an expensive model off the other rows, which a
    ``when`` around a Python function would not.
    """
    passed = F.coalesce(gate, F.lit(False))
    scored = score(df.where(passed))
    return scored.unionByName(df.where(~passed).withColumn(name, F.lit(None).cast(scored.schema[name].dataType)))


def usable_segment(text: Column) -> Column:
    """Neither blank nor a lone number, address or copyright line."""
    return ~(is_blank(text) | is_standalone_number(text) | has_url(text) | has_copyright(text))


def usable_sentence(text: Column) -> Column:
    """Neither blank nor a list number alone."""
    return ~(is_blank(text) | is_number_dots(text))


def both_sides(first: Column, second: Column) -> Column:
    return ~is_blank(first) & ~is_blank(second)


def any_side(first: Column, second: Column) -> Column:
    return ~is_blank(first) | ~is_blank(second)


def clean_lemma(lemma: Column) -> Column:
    """Not a gloss marker nor a question: such lemmas are parse errors."""
    return ~(lemma.startswith("Frn") | lemma.contains("?"))


def below_quantile(df: DataFrame, column: str, share: float) -> DataFrame:
    """Rows below an exact quantile of their column (see ``ranges.quantiles``), which is one row."""
    cut = ranges.quantiles(df, column, [share]).select(F.col("value").alias("__cut"))
    return df.join(F.broadcast(cut), F.col(column) < F.col("__cut")).drop("__cut")


def in_pages(page: Column, start: int, end: int) -> Column:
    """start <= page < end."""
    return (page >= start) & (page < end)
