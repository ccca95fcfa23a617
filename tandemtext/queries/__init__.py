"""Named queries over the test tables, grouped by module."""

from __future__ import annotations

import importlib
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession

NAMES = ("packed", "pairs", "documents", "folds")


def modules() -> list[ModuleType]:
    return [importlib.import_module(f"tandemtext.queries.{name}") for name in NAMES]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tandemtext.queries.pairs import hard_filter_cascade

    return hard_filter_cascade(spark, sf_dir)
