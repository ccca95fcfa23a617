"""Queries over sentence pairs: quality signals, filters, duplicates, splits, word lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemtext.functions import quality as Q
from tandemtext.functions import text as T
from tandemtext.operators import columns as C
from tandemtext.operators import dedup, filters, report, split, wordlists
from tandemtext.queries.once import each_once, once
from tandemtext.session import table

PAIR = ("pair_id", "french", "moore", "source", "loaded_at")


def _annotated(spark: SparkSession, sf: str) -> DataFrame:
    return Q.annotate(once(spark, sf, "aligned_pairs", *PAIR, "identification_consistency", "comet_qe").withColumn("identification_consistency", F.nanvl("identification_consistency", F.lit(None).cast("double"))))


def pair_len_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf, "fr_mos_combined", *PAIR).select("pair_id", T.length_ratio(F.col("french"), F.col("moore")).alias("ratio"))


def pair_quality_warnings(spark: SparkSession, sf: str) -> DataFrame:
    return _annotated(spark, sf).select("pair_id", F.array_join("quality_warnings", ",").alias("warnings"), T.round4(Q.terminal_score(F.col("french"), F.col("moore"))).alias("terminal"))


def warning_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return report.label_histogram(_annotated(spark, sf))


def warning_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = report.warning_summary(_annotated(spark, sf))
    return out.withColumns({c: T.round4(F.col(c)) for c in ("mean_consistency", "mean_len_ratio")})


def hard_filter_cascade(spark: SparkSession, sf: str) -> DataFrame:
    df = _annotated(spark, sf)
    stages = {
        "warnings": filters.free_of(["emoji", "dots_asymmetry", "number_mismatch"]),
        "consistency": filters.at_least_or_zero("identification_consistency", 0.5),
        "len_ratio": filters.at_least_or_zero("len_ratio", 0.4),
        "comet": filters.at_least("comet_qe", 0.5),
    }
    return filters.cascade_counts(df, stages)


def identified_cascade(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "aligned_pairs", "pair_id", "moore_glotlid_lang", "moore_glotlid_prob", "french_glotlid_lang", "french_glotlid_prob", "laser_score")
    stages = filters.known(
        df,
        {
            "moore_lid": ("moore_glotlid_prob", filters.identified("moore_glotlid_prob", "moore_glotlid_lang", "mos_Latn", 0.9)),
            "french_lid": ("french_glotlid_prob", filters.identified("french_glotlid_prob", "french_glotlid_lang", "fra_Latn", 0.9)),
            "sentence_lid": ("target_sentence_lid", filters.at_least("laser_score", 0.9)),
            "laser": ("laser_score", filters.at_least("laser_score", 0.5)),
        },
    )
    return filters.cascade_counts(df, stages)


def _builder_keep():
    return filters.at_least_or_null("len_ratio", 0.1, strict=True) & filters.at_least_or_null("comet_qe", 0.35) & filters.at_least_or_null("laser_score", 0.5)


def builder_quality_filter(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "pair_id", "len_ratio", "comet_qe", "laser_score", "source")
    return df.where(_builder_keep()).select("pair_id", "source")


def builder_dropped(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "len_ratio", "comet_qe", "laser_score", "source")
    return filters.dropped_by_source(df, _builder_keep())


def lid_gate(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "aligned_pairs", "pair_id", "moore_glotlid_lang", "moore_glotlid_prob", "identification_consistency", "laser_score")
    gate = filters.language_gate("moore_glotlid_prob", "identification_consistency", "moore_glotlid_lang")
    return df.where(gate & filters.at_least_or_zero("laser_score", 0.6)).select("pair_id", "laser_score")


def gated_score(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "aligned_pairs", "pair_id", "french", "moore", "moore_glotlid_lang", "moore_glotlid_prob", "identification_consistency")
    gate = filters.language_gate("moore_glotlid_prob", "identification_consistency", "moore_glotlid_lang")
    out = filters.gate_then_score(df, gate, lambda d: d.withColumn("quality", T.length_ratio(F.col("french"), F.col("moore"))), "quality")
    return out.select("pair_id", "quality")


def _foreign(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "french", "moore")
    return wordlists.foreign_words([wordlists.words_in(df, "french")], [wordlists.words_in(df, "moore")])


def foreign_wordlist(spark: SparkSession, sf: str) -> DataFrame:
    return _foreign(spark, sf)


def wordlist_overlap(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "french", "moore")
    return wordlists.overlap_sizes(wordlists.words_in(df, "french"), wordlists.words_in(df, "moore"))


def consistency_score(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "aligned_pairs", "pair_id", "moore", "loaded_at")
    out = Q.with_consistency(df, "moore", _foreign(spark, sf), "pair_id", "consistency", "foreign")
    return out.select("pair_id", "consistency", "foreign")


def lexicon_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return wordlists.lexicon_words(once(spark, sf, "lexicon_entries", "moore"), "moore")


def dedup_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", *PAIR)
    return dedup.first_wins(df, ["french", "moore"], ["pair_id", "loaded_at"]).select("pair_id")


def repeated_sides(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", *PAIR)
    return dedup.repeated(df, ["french", "moore"]).select("pair_id")


def dedup_components_keep_best(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", *PAIR, "comet_qe")
    df = df.withColumn("comet_qe", F.nanvl("comet_qe", F.lit(None).cast("double")))
    return dedup.keep_best(df, "pair_id", ["french", "moore"], "comet_qe").select("pair_id", "component")


def _split(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "documents", "doc_id", "source")
    return split.stratified_split(df, "source", ["doc_id"], dev=100, test=80)


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).select("doc_id", "source", "split")


def split_report(spark: SparkSession, sf: str) -> DataFrame:
    return report.counts(_split(spark, sf), "split", "source")


def split_source_rollup(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "split_name", "source")
    return df.rollup("split_name", "source").agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))


def shuffled_rank(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "documents", "doc_id")
    return split.shuffled(df, ["doc_id"]).select("doc_id", split.shuffle_key(42, ["doc_id"]).alias("shuffle_key"))


def score_stats(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "laser_score", "source")
    out = report.score_stats(df, "laser_score", "source")
    return out.withColumns({"mean": T.round4(F.col("mean")), "median": T.round4(F.col("median"))})


def score_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return report.percentiles(once(spark, sf, "fr_mos_combined", "comet_qe"), "comet_qe").withColumn("value", T.round4(F.col("value")))


def score_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return report.histogram(table(spark, sf, "events", "value"), "value")


def below_decile(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "pair_id", "laser_score").where("laser_score is not null and not isnan(laser_score)")
    return filters.below_quantile(df, "laser_score", 0.10)


def pass_rate(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "len_ratio", "comet_qe", "laser_score")
    return report.pass_rate(df, _builder_keep()).withColumn("percent", T.round4(F.col("percent")))


def score_migration(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "laser_score").withColumnRenamed("laser_score", "score")
    return C.migrate_score(df.withColumn("score", F.nanvl("score", F.lit(None).cast("double"))))


def top_per_source(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "pair_id", "source", "comet_qe").where("source is not null and comet_qe is not null and not isnan(comet_qe)")
    return report.best_per_group(df, ["source"], [F.desc("comet_qe"), F.col("pair_id")]).select("source", "pair_id", "comet_qe")


def row_slice(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders", "o_orderkey", "o_totalprice")
    return split.row_slice(df, ["o_orderkey"], 100, -100)


def number_and_address_filter(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "documents", "doc_id", "text").where("text is not null")
    t = F.col("text")
    return df.select("doc_id", filters.usable_segment(t).alias("usable"), filters.usable_sentence(t).alias("sentence"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        pair_len_ratio, pair_quality_warnings, warning_histogram, warning_summary, hard_filter_cascade, identified_cascade,
        builder_quality_filter, builder_dropped, lid_gate, gated_score, foreign_wordlist, wordlist_overlap, consistency_score,
        lexicon_vocabulary, dedup_first_wins, repeated_sides, dedup_components_keep_best, stratified_split, split_report,
        split_source_rollup, shuffled_rank, score_stats, score_percentiles, score_histogram, below_decile, pass_rate,
        score_migration, top_per_source, row_slice, number_and_address_filter,
    )
}

_RATIO = """CASE WHEN length(coalesce(french,''))=0 OR length(coalesce(moore,''))=0 THEN 0.0
  ELSE round_even(least(length(french),length(moore))/greatest(length(french),length(moore))*10000.0,0)/10000 END"""
_SP = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1C}-\x{1F}]"


def _strip(c: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({c},''), '^{_SP}+', ''), '{_SP}+$', '')"


_WARN = rf"""
WITH base AS (SELECT pair_id, source, identification_consistency, comet_qe, french, moore, coalesce(french,'') AS s, coalesce(moore,'') AS t,
    {_strip("french")} AS ss, {_strip("moore")} AS tt FROM aligned_pairs),
sig AS (SELECT *,
    regexp_matches(t, '[\x{{1F600}}-\x{{1F64F}}\x{{1F300}}-\x{{1F5FF}}\x{{1F680}}-\x{{1F6FF}}\x{{1F1E0}}-\x{{1F1FF}}\x{{2702}}-\x{{27B0}}\x{{24C2}}-\x{{1F251}}]') AS e,
    (regexp_matches(ss, '^\.\.') OR regexp_matches(right(ss,5), '\.\.')) <> (regexp_matches(tt, '^\.\.') OR regexp_matches(right(tt,5), '\.\.')) AS d,
    list_distinct(regexp_extract_all(s, '\b\d[\d.,]*\b')) AS sn, list_distinct(regexp_extract_all(t, '\b\d[\d.,]*\b')) AS tn,
    regexp_matches(s, '[(\[][^)\]]{{2,}}[)\]]') AND NOT regexp_matches(t, '[(\[][^)\]]{{2,}}[)\]]') AS p,
    regexp_matches(ss, '^[●•◦▪▸►‣⁃◆◇→−–—^*]') <> regexp_matches(tt, '^[●•◦▪▸►‣⁃◆◇→−–—^*]') AS b,
    len(regexp_extract_all(s, '[.?!…]')) AS sc, len(regexp_extract_all(t, '[.?!…]')) AS tc FROM base),
scored AS (SELECT *, 0.0 - ln(abs(sc-tc) + greatest(sc-1,0) + greatest(tc-1,0) + 1.0) AS term,
    CASE WHEN len(sn)=0 AND len(tn)=0 THEN false WHEN len(sn)=0 OR len(tn)=0 THEN true ELSE NOT list_has_any(sn, tn) END AS n FROM sig),
ann AS (SELECT pair_id, comet_qe, CASE WHEN isnan(identification_consistency) THEN NULL ELSE identification_consistency END AS cons, term, {_RATIO} AS ratio,
    list_filter([CASE WHEN e THEN 'emoji' END, CASE WHEN d THEN 'dots_asymmetry' END, CASE WHEN n THEN 'number_mismatch' END,
      CASE WHEN p THEN 'parenthesis_asymmetry' END, CASE WHEN b THEN 'bullet_asymmetry' END, CASE WHEN term < -2 THEN 'terminal_punctuation' END], lambda x: x IS NOT NULL) AS w FROM scored)
"""
_KEEP = "(len_ratio IS NULL OR len_ratio > 0.1) AND (comet_qe IS NULL OR comet_qe >= 0.35) AND (laser_score IS NULL OR laser_score >= 0.5)"
_TOKENS = r"unnest(regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]+'))"
_LISTS = f"""WITH f AS (SELECT DISTINCT {_TOKENS.format("french")} AS word FROM fr_mos_combined), m AS (SELECT DISTINCT {_TOKENS.format("moore")} AS word FROM fr_mos_combined)"""
_GATE = "coalesce(moore_glotlid_prob > 0.9 AND NOT isnan(moore_glotlid_prob), false) AND coalesce(identification_consistency > 0.9 AND NOT isnan(identification_consistency), false) AND contains(coalesce(moore_glotlid_lang,''), 'mos_Latn')"
_ONE = "(SELECT * FROM {} QUALIFY row_number() OVER (PARTITION BY pair_id ORDER BY loaded_at DESC NULLS LAST) = 1)"
_SPLIT = """WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('42|' || doc_id), doc_id) AS place,
  count(*) OVER (PARTITION BY source) AS size, (SELECT count(*) FROM documents) AS total FROM documents),
s AS (SELECT *, CASE WHEN size < 3 THEN 0 ELSE least(greatest(1, round_even(size * (100.0::DOUBLE / total), 0)), size // 3) END AS d,
  CASE WHEN size < 3 THEN 0 ELSE least(greatest(1, round_even(size * (80.0::DOUBLE / total), 0)), size // 3) END AS t FROM r),
o AS (SELECT doc_id, source, CASE WHEN place <= d THEN 'validation' WHEN place <= d + t THEN 'test' ELSE 'train' END AS split FROM s)"""

SQL: dict[str, str] = {
    "pair_len_ratio": f"SELECT pair_id, {_RATIO} AS ratio FROM fr_mos_combined",
    "pair_quality_warnings": _WARN + "SELECT pair_id, array_to_string(w, ',') AS warnings, round_even(term*10000,0)/10000 AS terminal FROM ann",
    "warning_histogram": _WARN + """, x AS (SELECT unnest(w) AS label FROM ann)
SELECT label, count(*) AS n, round_even(count(*)*100.0::DOUBLE/(SELECT count(*) FROM ann)*10000,0)/10000 AS percent FROM x GROUP BY label""",
    "warning_summary": _WARN + """SELECT count(*) AS n, count(*) FILTER (len(w)>0) AS warned, round_even(count(*) FILTER (len(w)>0)*100.0::DOUBLE/count(*)*10000,0)/10000 AS percent,
  round_even(avg(cons)*10000,0)/10000 AS mean_consistency, round_even(avg(ratio)*10000,0)/10000 AS mean_len_ratio FROM ann""",
    "hard_filter_cascade": _WARN + """SELECT CASE WHEN list_has_any(w, ['emoji','dots_asymmetry','number_mismatch']) THEN 'warnings' WHEN NOT coalesce(cons,0) >= 0.5 THEN 'consistency'
  WHEN NOT ratio >= 0.4 THEN 'len_ratio' WHEN NOT coalesce(comet_qe >= 0.5 AND NOT isnan(comet_qe), false) THEN 'comet' ELSE 'kept' END AS stage, count(*) AS dropped FROM ann GROUP BY 1""",
    "identified_cascade": """SELECT CASE WHEN NOT coalesce(moore_glotlid_prob >= 0.9 AND NOT isnan(moore_glotlid_prob) AND moore_glotlid_lang = 'mos_Latn', false) THEN 'moore_lid'
  WHEN NOT coalesce(french_glotlid_prob >= 0.9 AND NOT isnan(french_glotlid_prob) AND french_glotlid_lang = 'fra_Latn', false) THEN 'french_lid'
  WHEN NOT coalesce(laser_score >= 0.5 AND NOT isnan(laser_score), false) THEN 'laser' ELSE 'kept' END AS stage, count(*) AS dropped FROM aligned_pairs GROUP BY 1""",
    "builder_quality_filter": f"SELECT pair_id, source FROM fr_mos_combined WHERE {_KEEP}",
    "builder_dropped": f"SELECT source, count(*) FILTER (NOT ({_KEEP})) AS dropped, count(*) AS total FROM fr_mos_combined GROUP BY source",
    "lid_gate": f"SELECT pair_id, laser_score FROM aligned_pairs WHERE {_GATE} AND coalesce(laser_score,0) >= 0.6 AND NOT coalesce(isnan(laser_score), false)",
    "gated_score": f"SELECT pair_id, CASE WHEN {_GATE} THEN {_RATIO} END AS quality FROM aligned_pairs",
    "foreign_wordlist": _LISTS + " SELECT word FROM f EXCEPT SELECT word FROM m",
    "wordlist_overlap": _LISTS + """, c AS (SELECT word FROM f INTERSECT SELECT word FROM m)
SELECT (SELECT count(*) FROM f) AS first, (SELECT count(*) FROM m) AS second, (SELECT count(*) FROM c) AS common,
  (SELECT count(*) FROM f) - (SELECT count(*) FROM c) AS only_first, (SELECT count(*) FROM m) - (SELECT count(*) FROM c) AS only_second""",
    "consistency_score": _LISTS + f""", x AS (SELECT word FROM f EXCEPT SELECT word FROM m),
p AS {_ONE.format("aligned_pairs")}, k AS (SELECT DISTINCT pair_id, {_TOKENS.format("moore")} AS word FROM p),
c AS (SELECT pair_id, count(*) AS n, count(x.word) AS f FROM k LEFT JOIN x USING (word) WHERE length(k.word) >= 3 GROUP BY pair_id)
SELECT p.pair_id, CASE WHEN coalesce(n,0) < 2 THEN 0.0 ELSE round_even((n-f)/n*10000.0,0)/10000 END AS consistency, coalesce(f,0) > 0 AS "foreign" FROM p LEFT JOIN c USING (pair_id)""",
    "lexicon_vocabulary": r"""WITH w AS (SELECT unnest(regexp_split_to_array(lower(regexp_replace(moore, '\[[^\]]*\]', ' ', 'g')), '\s+')) AS word FROM lexicon_entries)
SELECT DISTINCT regexp_replace(regexp_replace(word, '^\.+', ''), '^-+', '') AS word FROM w WHERE NOT starts_with(word, '@') AND length(regexp_replace(regexp_replace(word, '^\.+', ''), '^-+', '')) >= 2""",
    "dedup_first_wins": "SELECT pair_id FROM fr_mos_combined QUALIFY row_number() OVER (PARTITION BY french, moore ORDER BY pair_id, loaded_at) = 1",
    "repeated_sides": f"""WITH p AS {_ONE.format("fr_mos_combined")}, c AS (SELECT pair_id, french, moore, count(*) OVER (PARTITION BY french) AS a, count(*) OVER (PARTITION BY moore) AS b FROM p)
SELECT pair_id FROM c WHERE (french IS NOT NULL AND a > 1) OR (moore IS NOT NULL AND b > 1)""",
    "dedup_components_keep_best": """WITH RECURSIVE p AS (SELECT pair_id, french, moore, CASE WHEN isnan(comet_qe) THEN NULL ELSE comet_qe END AS q FROM fr_mos_combined),
t AS (SELECT pair_id, 'f' || french AS v FROM p WHERE french IS NOT NULL UNION ALL SELECT pair_id, 'm' || moore FROM p WHERE moore IS NOT NULL),
e AS (SELECT DISTINCT a.pair_id AS a, b.pair_id AS b FROM t a JOIN t b USING (v)),
r AS (SELECT pair_id AS a, pair_id AS b FROM p UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS pair_id, min(b) AS component FROM r GROUP BY a)
SELECT pair_id, component FROM c JOIN p USING (pair_id) QUALIFY row_number() OVER (PARTITION BY component ORDER BY q DESC NULLS LAST, pair_id) = 1""",
    "stratified_split": _SPLIT + " SELECT doc_id, source, split FROM o",
    "split_report": _SPLIT + " SELECT split, source, count(*) AS n FROM o GROUP BY split, source",
    "split_source_rollup": """SELECT split_name, source, count(*) AS n, grouping(split_name, source)::INTEGER AS level FROM (SELECT split_name, lower(trim(source)) AS source FROM fr_mos_combined)
GROUP BY ROLLUP (split_name, source)""",
    "shuffled_rank": "SELECT doc_id, md5('42|' || doc_id) AS shuffle_key FROM documents",
    "score_stats": """SELECT lower(trim(source)) AS source, count(*) AS n, round_even(avg(laser_score)*10000,0)/10000 AS mean, round_even(median(laser_score)*10000,0)/10000 AS median,
  min(laser_score) AS least, max(laser_score) AS most FROM fr_mos_combined WHERE laser_score IS NOT NULL AND NOT isnan(laser_score) GROUP BY 1""",
    "score_percentiles": """WITH s AS (SELECT unnest([0.10,0.25,0.50,0.75,0.90,0.95,0.99]::DOUBLE[]) AS share, unnest(quantile_cont(comet_qe, [0.10,0.25,0.50,0.75,0.90,0.95,0.99])) AS value
  FROM fr_mos_combined WHERE comet_qe IS NOT NULL AND NOT isnan(comet_qe)) SELECT share, round_even(value*10000,0)/10000 AS value FROM s""",
    "score_histogram": """WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events WHERE value IS NOT NULL AND NOT isnan(value))
SELECT CASE WHEN hi = lo THEN 0 ELSE least(floor((value-lo)/(hi-lo)*40), 39) END::INTEGER AS bin, count(*) AS n FROM events, e WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY 1""",
    "below_decile": """WITH v AS (SELECT pair_id, laser_score FROM fr_mos_combined WHERE laser_score IS NOT NULL AND NOT isnan(laser_score))
SELECT * FROM v WHERE laser_score < (SELECT quantile_cont(laser_score, 0.10) FROM v)""",
    "pass_rate": f"SELECT round_even(avg(CASE WHEN {_KEEP} THEN 1 ELSE 0 END)*100*10000,0)/10000 AS percent FROM fr_mos_combined",
    "score_migration": "SELECT pair_id, CASE WHEN isnan(laser_score) THEN NULL ELSE round_even(laser_score*10000,0)/10000 END AS laser_score FROM fr_mos_combined",
    "top_per_source": """SELECT source, pair_id, comet_qe FROM fr_mos_combined WHERE source IS NOT NULL AND comet_qe IS NOT NULL AND NOT isnan(comet_qe)
QUALIFY row_number() OVER (PARTITION BY source ORDER BY comet_qe DESC, pair_id) = 1""",
    "row_slice": "SELECT o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (ORDER BY o_orderkey) BETWEEN 101 AND (SELECT count(*) FROM orders) - 100",
    "number_and_address_filter": rf"""SELECT doc_id, NOT ({_strip("text")} = '' OR regexp_matches(text, '^\s*\d+(?:[-–]\d+)?(?:[.,;:\s]+\d+(?:[-–]\d+)?)*[.,;:]?\s*$')
  OR regexp_matches(text, '(?i)https?://|www\.') OR contains(text, '©')) AS usable, NOT ({_strip("text")} = '' OR regexp_matches(text, '^\d+\.+$')) AS sentence FROM documents WHERE text IS NOT NULL""",
}

SQL = {name: each_once(text) for name, text in SQL.items()}
