"""Tables of which a repeated row counts once, the latest one holds and the source has one spelling; for Spark and for SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemtext.session import latest, table

#: Key and time of load of each table that repeats rows, and whether its source is spelt in several ways.
REPEATING = {
    "fr_mos_combined": ("pair_id", "loaded_at", True), "aligned_pairs": ("pair_id", "loaded_at", True), "parallel_text": ("pt_id", "loaded_at", True),
    "lexicon_entries": ("entry_id", "loaded_at", False), "aligned_corpus": ("pt_id", "run_at", False), "chapters": ("chapter_id", "loaded_at", False), "sections": ("section_id", "loaded_at", False),
}


def once(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """``columns`` (and the key) of the latest row of each key; a table without a time of load repeats nothing."""
    key, time, several = REPEATING[name]
    wanted, df = list(dict.fromkeys([key, *columns])), table(spark, sf, name)
    df = latest(df.select(*dict.fromkeys([*wanted, time])), key, time).select(*wanted) if time in df.columns else df.select(*wanted)
    return df.withColumn("source", F.lower(F.trim("source"))) if several and "source" in columns else df


def each_once(sql: str) -> str:
    """``sql`` with each mention of such a table replaced by the latest rows of its keys."""

    def view(found: re.Match) -> str:
        key, time, several = REPEATING[found.group(1)]
        columns = "* REPLACE (lower(trim(source)) AS source)" if several else "*"
        return f"FROM (SELECT {columns} FROM {found.group(1)} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {time} DESC NULLS LAST) = 1)"

    return re.sub(rf"\bFROM ({'|'.join(REPEATING)})\b(?! QUALIFY)", view, sql)
