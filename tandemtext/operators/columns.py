"""Management of columns: renames, migrations, validation, codecs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandemtext.functions.text import round4

#: Language codes of the field names.
LANGUAGE_OF_FIELD = {"french": "fra_Latn", "english": "eng_Latn", "moore": "mos_Latn", "eng_Latn": "eng_Latn", "mos_Latn": "mos_Latn", "fra_Latn": "fra_Latn"}


def require(df: DataFrame, *columns: str) -> DataFrame:
    """``df``; fails with the columns there are where one is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)}; there are {', '.join(df.columns)}")
    return df


def language_code(field: str, given: str | None = None) -> str:
    """Language code of a field; a given one wins; unknown fields fail."""
    if given:
        return given
    if field not in LANGUAGE_OF_FIELD:
        raise ValueError(f"no language code for {field}; pass one")
    return LANGUAGE_OF_FIELD[field]


def label_columns(field: str) -> tuple[str, str]:
    return f"{field}_glotlid_lang", f"{field}_glotlid_prob"


def score_column(model: str, source: str, target: str) -> str:
    """Name of a model's score: laser_fra_mos, comet_qe_eng_mos."""
    return f"{model}_{source.split('_')[0]}_{target.split('_')[0]}"


def migrate_score(df: DataFrame, old: str = "score", new: str = "laser_score") -> DataFrame:
    """Rename ``old`` to ``new`` where absent and round it to four places; with both columns only round ``new``."""
    if old not in df.columns and new not in df.columns:
        return df
    if new in df.columns:
        return df.withColumn(new, round4(F.col(new)))
    return df.withColumn(new, round4(F.col(old))).drop(old)


def needs_migration(df: DataFrame, old: str = "score", new: str = "laser_score") -> bool:
    """Whether the old name is in use or any score has more than four places."""
    if old in df.columns and new not in df.columns:
        return True
    if new not in df.columns:
        return False
    return bool(df.agg(F.bool_or(F.abs(F.col(new) - round4(F.col(new))) > 1e-12)).first()[0])


def drop_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Without those of ``columns`` that have no value in any row; one aggregate decides for all of them."""
    row = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    return df.drop(*[c for c in columns if not row[c]])


def drop_unrequested(df: DataFrame, wanted: Sequence[str], shared: Sequence[str] = ("quality_warnings", "identification_consistency")) -> DataFrame:
    return df.drop(*[c for c in shared if c not in wanted])


def to_json_rows(df: DataFrame, omit_empty: bool = True) -> DataFrame:
    """(value): each row as JSON; null fields and empty arrays are omitted."""
    if omit_empty:
        arrays = {c: F.when(F.size(c) > 0, F.col(c)) for c, t in df.dtypes if t.startswith("array")}
        df = df.withColumns(arrays) if arrays else df
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": str(omit_empty).lower()}).alias("value"))


def page_bounds(pages: Column) -> Column:
    """STRUCT<end_page, page_count> of an array of pages."""
    return F.struct(F.try_element_at(pages, F.lit(-1))["page_number"].alias("end_page"), F.size(pages).alias("page_count"))
