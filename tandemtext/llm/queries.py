"""Queries of this package, by name; ``SQL`` has those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemtext.llm.bitext import sentence_pairs
from tandemtext.llm.cutoffs import cutoffs, kept_records
from tandemtext.llm.langid import field_languages, field_stretches, wrong_labels
from tandemtext.llm.leaks import leaked_items
from tandemtext.llm.overlaps import cross_split_pairs, overlap_counts
from tandemtext.llm.reading import DEMANDING, check_by_source, reading_levels
from tandemtext.llm.scans import noisy_lines, repaired
from tandemtext.llm.sentences import sentence_units
from tandemtext.llm.tokenize import token_ids
from tandemtext.session import latest, table


SCORES = ["laser_score", "comet_qe"]


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(table(spark, sf_dir, "fr_mos_combined", "pair_id", "source", *SCORES, "loaded_at"), "pair_id")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_records(_scored(spark, sf_dir), table(spark, sf_dir, "keep_targets"), SCORES)
    return kept.select("source", "score_name", "pair_id")


def p2_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutoffs(_scored(spark, sf_dir), table(spark, sf_dir, "keep_targets"), SCORES)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections = table(spark, sf_dir, "sections", "section_id", "body", "subsections", "loaded_at")
    return sentence_units(spark, latest(sections, "section_id"))


def _labelled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["pair_id", "french", "moore", "english", "french_glotlid_lang", "moore_glotlid_lang", "loaded_at"]
    return latest(table(spark, sf_dir, "aligned_pairs", *columns), "pair_id")


def p4_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return field_stretches(spark, _labelled_pairs(spark, sf_dir))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrong_labels(field_languages(spark, _labelled_pairs(spark, sf_dir))).select("pair_id", "side", "lang")


def _split_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(table(spark, sf_dir, "fr_mos_combined", "pair_id", "french", "moore", "split_name", "source", "loaded_at"), "pair_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_split_pairs(spark, _split_records(spark, sf_dir))


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_counts(spark, _split_records(spark, sf_dir))


def p6_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "parallel_text", "pt_id", "french", "moore", "loaded_at")
    return sentence_pairs(spark, latest(documents, "pt_id"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_pairs(spark, sf_dir).select("pt_id", "french_no", "moore_no")


def _scanned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sections = table(spark, sf_dir, "sections", "section_id", "chapter_id", "title", "subsections", "body", "raw_text", "loaded_at")
    chapters = table(spark, sf_dir, "chapters", "chapter_id", "manual_title", "title", "raw_text", "loaded_at")
    return latest(sections, "section_id"), latest(chapters, "chapter_id")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noisy_lines(spark, *_scanned(spark, sf_dir))


def p7_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(spark, *_scanned(spark, sf_dir))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids(spark, table(spark, sf_dir, "documents", "doc_id", "text"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "test_items"))


def p10_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return reading_levels(spark, documents, table(spark, sf_dir, "reading_labels"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_levels(spark, sf_dir).where(F.col("grade") >= DEMANDING).select("doc_id")


def p10_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return check_by_source(spark, documents, table(spark, sf_dir, "reading_labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found,
    "p2_cutoffs": p2_cutoffs,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_segments": p4_segments,
    "p5_found": p5_found,
    "p5_report": p5_report,
    "p6_found": p6_found,
    "p6_pairs": p6_pairs,
    "p7_found": p7_found,
    "p7_paragraphs": p7_paragraphs,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p10_found": p10_found,
    "p10_levels": p10_levels,
    "p10_report": p10_report,
}

_P2 = """
WITH seen AS (SELECT * FROM fr_mos_combined QUALIFY row_number() OVER (PARTITION BY pair_id ORDER BY loaded_at DESC NULLS LAST) = 1),
long AS (
  SELECT pair_id, lower(trim(source)) AS key, 'laser_score' AS score_name, laser_score AS score FROM seen
  UNION ALL SELECT pair_id, lower(trim(source)), 'comet_qe', comet_qe FROM seen),
num AS (
  SELECT t.source, t.score_name, t.keep_pct, pair_id, score
  FROM (SELECT DISTINCT * FROM keep_targets) t JOIN long l ON l.key = lower(trim(t.source)) AND l.score_name = t.score_name
  WHERE score IS NOT NULL AND NOT isnan(score)),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY source, score_name, keep_pct ORDER BY score DESC) AS upto,
         count(*) OVER (PARTITION BY source, score_name, keep_pct) AS total FROM num),
cut AS (
  SELECT source, score_name, keep_pct, max(score) AS cutoff, any_value(total) AS total FROM ranked
  WHERE upto * 100 >= keep_pct * total GROUP BY ALL)
"""

SQL: dict[str, str] = {
    "p2_found": _P2 + "SELECT n.source, n.score_name, n.pair_id FROM num n JOIN cut c USING (source, score_name, keep_pct) WHERE n.score >= c.cutoff",
    "p2_cutoffs": _P2
    + """SELECT c.source, c.score_name, c.keep_pct, c.cutoff, count(*) AS kept, any_value(c.total) AS total
FROM cut c JOIN num n USING (source, score_name, keep_pct) WHERE n.score >= c.cutoff GROUP BY ALL""",
}
