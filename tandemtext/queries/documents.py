"""Queries over documents, manuals, dictionaries and vectors: segmentation, normalisation, joins, ordered folds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemtext.functions import text as T
from tandemtext.operators import joins, lexicon, lines, report, segment
from tandemtext.queries.once import each_once, once
from tandemtext.session import table
from tandemtext.sources.readers import BITEXT_COLUMNS, bitext_field


def sentence_split(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "documents", "doc_id", "text")
    return segment.explode_sentences(df, "text", "doc_id").select("doc_id", "pos", "sentence")


def lines_joined(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "chapters", "chapter_id", "raw_text", "loaded_at").where("raw_text is not null")
    t = F.col("raw_text")
    return df.select("chapter_id", F.unix_micros("loaded_at").alias("at"), T.squeeze(t).alias("squeezed"), T.drop_page_references(t).alias("unreferenced"), T.expand_ligatures(t).alias("expanded"))


def french_normalized(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "pair_id", "french", "moore")
    return df.select("pair_id", T.normalize_french(F.col("french")).alias("french"), T.normalize_moore(F.col("moore")).alias("moore"))


def folded_keys(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf, "lexicon_entries", "entry_id", "french").select("entry_id", T.fold_key(F.col("french")).alias("folded"))


def plain_cells(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf, "lexicon_entries", "entry_id", "synonym").select("entry_id", T.clean_cell(F.col("synonym")).alias("cell"))


def heading_groups(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "sections", "section_id", "raw_text", "loaded_at").where("raw_text is not null")
    numbered = lines.heading_groups(lines.lines_of(df, "section_id", "raw_text"), "section_id", "line_no", F.col("line").rlike(r"^\d+\. "))
    return numbered.groupBy("section_id", "group_no").agg(F.count("*").alias("lines"), F.min("line_no").alias("first_line"))


def numbered_items(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "sections", "section_id", "raw_text", "loaded_at").where("raw_text is not null")
    return lines.numbered_items(lines.lines_of(df, "section_id", "raw_text"), "section_id", "line_no")


def carried_headings(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "chapters", "chapter_id", "raw_text", "loaded_at").where("raw_text is not null")
    carried = lines.carry_heading(lines.lines_of(df, "chapter_id", "raw_text"), "chapter_id", "line_no", F.col("line").rlike(r"^(?:Chapitre|\d+\. )"))
    return carried.groupBy("chapter_id", "heading").agg(F.count("*").alias("lines"))


def manual_units(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "sections", "section_id", "subsections", "items", "bullet_items", "body", "loaded_at")
    units = segment.manual_units(F.struct("subsections", "items", "bullet_items", "body"))
    return df.select("section_id", F.posexplode(units).alias("pos", "unit"))


def chapter_replacement(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "chapters", "chapter_id", "manual_id", "chapter_num", "raw_text", "loaded_at")
    df = df.select("chapter_id", F.concat_ws("-", "manual_id", "chapter_num").alias("number"), F.coalesce(F.length("raw_text"), F.lit(0)).alias("size"))
    return report.replace_if_larger(df, "number", "chapter_id", "size").select("number", "chapter_id", "place")


def language_boundary(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "parallel_text", "pt_id", "moore", "french", "loaded_at")
    units = F.concat(F.coalesce("moore", F.array().cast("array<string>")), F.coalesce("french", F.array().cast("array<string>")))
    langs = F.concat(F.transform(F.coalesce("moore", F.array().cast("array<string>")), lambda _: F.lit("mos_Latn")), F.transform(F.coalesce("french", F.array().cast("array<string>")), lambda _: F.lit("fra_Latn")))
    parts = segment.language_boundary(units, langs, end=r"(?i)^kibar sebre")
    return df.select("pt_id", parts.alias("p")).select("pt_id", F.coalesce(F.size("p.moore"), F.lit(0)).alias("moore_units"), F.coalesce(F.size("p.french"), F.lit(0)).alias("french_units"))


def positional_zip(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "aligned_corpus", "pt_id", "run_at", "french", "moore", "scores")
    out = joins.zip_places(df, ["french", "moore", "scores"], "pt_id", "run_at")
    return out.select("pt_id", F.unix_micros("run_at").alias("at"), "pos", "french", "moore", T.round4(F.col("scores")).alias("score"))


def aligned_threshold(spark: SparkSession, sf: str) -> DataFrame:
    df = joins.zip_places(once(spark, sf, "aligned_corpus", "pt_id", "run_at", "french", "moore", "scores"), ["french", "moore", "scores"], "pt_id", "run_at")
    kept = df.where((F.col("scores") >= 0.6) & ~T.is_blank(F.col("french")) & ~T.is_blank(F.col("moore")))
    return kept.groupBy("pt_id", F.unix_micros("run_at").alias("at")).agg(F.count("*").alias("n"))


def regrouped_units(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "parallel_text", "pt_id", "moore", "loaded_at")
    parts = df.select("pt_id", F.posexplode("moore").alias("pos", "unit")).where("unit is not null").withColumn("size", F.length("unit"))
    return joins.regroup(parts, "pt_id", "pos", "size").select("pt_id", F.array_join("size", ",").alias("sizes"))


def glossary_lookup(spark: SparkSession, sf: str) -> DataFrame:
    probe = once(spark, sf, "fr_mos_combined", "french").where("french is not null").select("pair_id", "french")
    build = once(spark, sf, "lexicon_entries", "french", "moore").select("entry_id", F.col("french").alias("term"), F.col("moore").alias("gloss"))
    a, b = joins.term_keys(F.col("french"), F.col("french")), joins.term_keys(F.col("term"), F.col("term"))
    out = joins.prioritised_lookup(probe, build, list(zip(a, b)), ["entry_id", "gloss"], "entry_id")
    return out.select("pair_id", "entry_id", "gloss", "match_pass")


def numbered_left_join(spark: SparkSession, sf: str) -> DataFrame:
    left = table(spark, sf, "nation", "n_nationkey", "n_name").withColumnRenamed("n_nationkey", "num")
    right = table(spark, sf, "region", "r_regionkey", "r_name").withColumnRenamed("r_regionkey", "num")
    return joins.left_by_number(left, right, "num", "num", "r_name")


def similarity_threshold(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    out = joins.similar_pairs(df.where("vec_id % 100 = 0"), df, "label", "vec_id", "embedding", below=0.7)
    return out.groupBy("label", "vec_id_a").agg(F.count("*").alias("low"))


def rowwise_score(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "embeddings", "vec_id", "embedding")
    other = df.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return df.join(other, "vec_id").select("vec_id", T.round4(joins.cosine(F.col("embedding"), F.col("other"))).alias("score"))


def dtw_align(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    # sequences of fifty neighbouring rows of a label stand for documents
    df = df.withColumn("label", F.concat_ws("/", "label", F.floor(F.col("vec_id") / 500)))
    return joins.sequence_join(df.where("vec_id % 2 = 0"), df.where("vec_id % 2 = 1"), "label", "vec_id", "embedding")


def synonym_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "lexicon_entries", "entry_id", "french", "moore", "english", "loaded_at")
    return lexicon.explode_synonyms(df).select("entry_id", F.unix_micros("loaded_at").alias("at"), "french", "english", "synonym_no")


def proverbs_stripped(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "lexicon_entries", "entry_id", "french", "english", "moore", "len_ratio", "loaded_at")
    df = df.withColumn("len_ratio", F.nanvl("len_ratio", F.lit(None).cast("double")))
    return lexicon.strip_proverbs(df).select("entry_id", F.unix_micros("loaded_at").alias("at"), "french", "english", T.round4(F.col("len_ratio")).alias("len_ratio"))


def bitext_fields(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "pair_id", "english", "moore", "laser_score", "comet_qe")
    row = F.concat_ws("\t", F.coalesce("english", F.lit("")), F.coalesce("moore", F.lit("")), F.coalesce(F.col("laser_score").cast("string"), F.lit("")), F.lit("x"), F.lit("0.0"))
    fields = df.select("pair_id", F.split(row, "\t", -1).alias("f"))
    return fields.select("pair_id", *[bitext_field(n, F.get("f", F.lit(k))).alias(n) for k, n in enumerate(BITEXT_COLUMNS[:6])])


def running_offsets(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "parallel_text", "pt_id", "french", "source", "loaded_at")
    sized = df.select("pt_id", F.lower(F.trim("source")).alias("source"), F.size("french").cast("bigint").alias("n"))
    return lines.running_offset(sized, "source", "pt_id", "n")


def kinds_of_word(spark: SparkSession, sf: str) -> DataFrame:
    return report.kind_histogram(once(spark, sf, "lexicon_entries", "pos_tag"), "pos_tag")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        sentence_split, lines_joined, french_normalized, folded_keys, plain_cells, heading_groups, numbered_items, carried_headings,
        manual_units, chapter_replacement, language_boundary, positional_zip, aligned_threshold, regrouped_units, glossary_lookup,
        numbered_left_join, similarity_threshold, rowwise_score, dtw_align, synonym_rows, proverbs_stripped, bitext_fields,
        running_offsets, kinds_of_word,
    )
}

_S = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1C}-\x{1F}]"


def _strip(e: str) -> str:
    return f"regexp_replace(regexp_replace({e}, '^{_S}+', ''), '{_S}+$', '')"


def _one(name: str, key: str, columns: str = "*") -> str:
    return f"(SELECT {columns} FROM {name} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY loaded_at DESC NULLS LAST) = 1)"


_LINES = "(SELECT {0}, generate_subscripts(l, 1) AS line_no, unnest(l) AS line FROM (SELECT {0}, string_split(raw_text, chr(10)) AS l FROM {1} WHERE raw_text IS NOT NULL))"
_LIG = "replace(replace(replace(replace(replace(replace(replace(replace(raw_text,'ϧ','fi'),'ﬀ','ff'),'ﬁ','fi'),'ﬂ','fl'),'ﬃ','ffi'),'ﬄ','ffl'),'ﬅ','st'),'ﬆ','st')"


def _fold(e: str) -> str:
    return f"lower(strip_accents(lower({_strip(e)})))"


def _proverb(c: str) -> str:
    out = rf"regexp_replace({c}, '(?is)\s*\(\s*(?:Proverbe|Proverb)\s*:[^)]*\)', '', 'g')"
    out = rf"regexp_replace({out}, '(?is)([.!?])\s*(?:Proverbe|Proverb)\s*:.*$', '\1')"
    out = rf"regexp_replace({out}, '(?is)^\s*(?:Proverbe|Proverb)\s*:\s*', '')"
    return rf"regexp_replace({out}, '(^|[^.])\.\.([^.]|$)', '\1.\2', 'g')"


_MARKS = "('\"', '«', '»')"

SQL: dict[str, str] = {
    "sentence_split": rf"""WITH d AS (SELECT doc_id, string_split(regexp_replace({_strip(f"regexp_replace(coalesce(text,''), '{_S}+', ' ', 'g')")}, '([.!?]["»”]?)\s+', '\1' || chr(1), 'g'), chr(1)) AS parts FROM documents),
k AS (SELECT doc_id, list_transform(parts, lambda p: regexp_extract_all(p, '["«»]|[^"«»]+')) AS toks FROM d),
m AS (SELECT doc_id, flatten(list_transform(toks, lambda t: string_split(array_to_string(list_transform(t, lambda x, i:
  CASE WHEN x IN {_MARKS} OR len(list_filter(t[1:i-1], lambda u: u IN {_MARKS})) % 2 = 1 THEN x ELSE replace(x, ';', chr(1)) END), ''), chr(1)))) AS s FROM k),
f AS (SELECT doc_id, list_filter(list_transform(s, lambda x: {_strip("x")}), lambda x: x <> '') AS s FROM m)
SELECT doc_id, (generate_subscripts(s, 1) - 1)::INTEGER AS pos, unnest(s) AS sentence FROM f""",
    "lines_joined": rf"""SELECT chapter_id, epoch_us(loaded_at) AS at, {_strip(f"regexp_replace(raw_text, '{_S}+', ' ', 'g')")} AS squeezed,
  regexp_replace(raw_text, '(?i)\([^)]*\bp\.?\s*\d+\)', '', 'g') AS unreferenced, {_LIG} AS expanded FROM chapters WHERE raw_text IS NOT NULL""",
    "french_normalized": rf"""SELECT pair_id, {_strip(r"regexp_replace(regexp_replace(regexp_replace(translate(french, '“”', '" + '""' + r"'), ' +([!?:;».,])', '\1', 'g'), '« +', '«', 'g'), ' {2,}', ' ', 'g')")} AS french,
  {_strip("regexp_replace(translate(moore, '“”', '" + '""' + "'), ' {2,}', ' ', 'g')")} AS moore FROM fr_mos_combined""",
    "folded_keys": f"SELECT entry_id, {_fold('french')} AS folded FROM lexicon_entries",
    "plain_cells": f"""SELECT entry_id, {_strip(f"regexp_replace(replace(translate(coalesce(synonym,''), '‘’‚‛“”„‟–—―‐‑' || chr(160) || chr(8239), '''''''''" + '""""' + f"-----' || '  '), '…', '...'), '{_S}+', ' ', 'g')")} AS cell FROM lexicon_entries""",
    "heading_groups": rf"""WITH l AS {_LINES.format("section_id", _one("sections", "section_id"))},
g AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^\d+\. ') THEN 1 ELSE 0 END) OVER (PARTITION BY section_id ORDER BY line_no)::BIGINT AS group_no FROM l)
SELECT section_id, group_no, count(*) AS lines, min(line_no)::INTEGER AS first_line FROM g GROUP BY section_id, group_no""",
    "numbered_items": rf"""WITH l AS {_LINES.format("section_id", _one("sections", "section_id"))},
g AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^\s*(?:\([^)]*\)\s*)?(\d+)\.\s') THEN 1 ELSE 0 END) OVER (PARTITION BY section_id ORDER BY line_no)::BIGINT AS item_no FROM l),
i AS (SELECT section_id, item_no, string_agg(trim(line), ' ' ORDER BY line_no) FILTER (trim(line) <> '') AS text FROM g WHERE item_no > 0 GROUP BY section_id, item_no)
SELECT *, try_cast(regexp_extract(text, '^\s*(?:\([^)]*\)\s*)?(\d+)\.\s', 1) AS INTEGER) AS num FROM i""",
    "carried_headings": rf"""WITH l AS {_LINES.format("chapter_id", _one("chapters", "chapter_id"))},
c AS (SELECT chapter_id, last_value(CASE WHEN regexp_matches(line, '^(?:Chapitre|\d+\. )') THEN line END IGNORE NULLS) OVER (PARTITION BY chapter_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading FROM l)
SELECT chapter_id, heading, count(*) AS lines FROM c GROUP BY chapter_id, heading""",
    "manual_units": f"""WITH s AS {_one("sections", "section_id")},
u AS (SELECT section_id, list_filter(list_transform(list_filter(list_concat([body], coalesce(list_transform(items, lambda x: x.text), []), coalesce(list_transform(bullet_items, lambda x: x.text), []),
  flatten(coalesce(list_transform(subsections, lambda b: list_concat([b.title, b.body], coalesce(list_transform(b.items, lambda x: x.text), []), coalesce(list_transform(b.bullet_items, lambda x: x.text), []))), []))), lambda x: x IS NOT NULL),
  lambda x: {_strip("x")}), lambda x: x <> '') AS a FROM s)
SELECT section_id, (generate_subscripts(a, 1) - 1)::INTEGER AS pos, unnest(a) AS unit FROM u""",
    "chapter_replacement": f"""WITH c AS {_one("chapters", "chapter_id")}, n AS (SELECT chapter_id, manual_id || '-' || chapter_num AS number, coalesce(length(raw_text),0) AS size FROM c)
SELECT number, chapter_id, min(chapter_id) OVER (PARTITION BY number) AS place FROM n QUALIFY row_number() OVER (PARTITION BY number ORDER BY size DESC, chapter_id DESC) = 1""",
    "language_boundary": f"""WITH p AS {_one("parallel_text", "pt_id")},
u AS (SELECT pt_id, list_concat(coalesce(moore,[]), coalesce(french,[])) AS a, len(coalesce(moore,[])) AS m FROM p),
c AS (SELECT pt_id, len(a) AS n, list_position(list_transform(a, lambda x: coalesce(regexp_matches(x, '(?i)^kibar sebre'), false)), true) AS e, m FROM u)
SELECT pt_id, (CASE WHEN e > 0 THEN e ELSE m END)::INTEGER AS moore_units, (n - CASE WHEN e > 0 THEN e ELSE m END)::INTEGER AS french_units FROM c""",
    "positional_zip": """WITH z AS (SELECT pt_id, run_at, unnest(range(least(len(french), len(moore), len(scores)))) AS pos, french AS f, moore AS m, scores AS s FROM aligned_corpus)
SELECT pt_id, epoch_us(run_at) AS at, pos::INTEGER AS pos, f[pos+1] AS french, m[pos+1] AS moore, round_even(s[pos+1]*10000,0)/10000 AS score FROM z""",
    "aligned_threshold": """WITH z AS (SELECT pt_id, run_at, unnest(range(least(len(french), len(moore), len(scores)))) AS pos, french AS f, moore AS m, scores AS s FROM aligned_corpus)
SELECT pt_id, epoch_us(run_at) AS at, count(*) AS n FROM z WHERE s[pos+1] >= 0.6 AND trim(f[pos+1]) <> '' AND trim(m[pos+1]) <> '' GROUP BY pt_id, run_at""",
    "regrouped_units": f"""WITH p AS {_one("parallel_text", "pt_id")}, u AS (SELECT pt_id, list_filter(moore, lambda x: x IS NOT NULL) AS a FROM p)
SELECT pt_id, array_to_string(list_transform(a, lambda x: length(x)), ',') AS sizes FROM u WHERE len(a) > 0""",
    "glossary_lookup": f"""WITH p AS (SELECT pair_id, french FROM {_one("fr_mos_combined", "pair_id")} WHERE french IS NOT NULL),
b AS (SELECT entry_id, french AS term, moore AS gloss FROM {_one("lexicon_entries", "entry_id")}),
pk AS (SELECT pair_id, unnest([1,2,3]) AS pass, unnest([{_fold("french")}, {_fold("regexp_extract(french, '[(]([^)]*)[)]', 1)")}, regexp_replace({_fold("french")}, '\\s+', '', 'g')]) AS k FROM p),
bk AS (SELECT entry_id, gloss, unnest([1,2,3]) AS pass, unnest([{_fold("term")}, {_fold("regexp_extract(term, '[(]([^)]*)[)]', 1)")}, regexp_replace({_fold("term")}, '\\s+', '', 'g')]) AS k FROM b)
SELECT pair_id, entry_id, gloss, pass AS match_pass FROM pk JOIN bk USING (pass, k) WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY pair_id ORDER BY pass, entry_id DESC) = 1""",
    "numbered_left_join": "SELECT n_nationkey AS num, n_name, coalesce(r_name, '') AS r_name FROM nation LEFT JOIN region ON n_nationkey = r_regionkey",
    "similarity_threshold": """WITH s AS (SELECT a.label, a.vec_id AS vec_id_a, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c FROM embeddings a JOIN embeddings b USING (label) WHERE a.vec_id % 100 = 0)
SELECT label, vec_id_a, count(*) AS low FROM s WHERE c < 0.7 GROUP BY label, vec_id_a""",
    "rowwise_score": "SELECT a.vec_id, round_even(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])*10000,0)/10000 AS score FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "synonym_rows": rf"""WITH s AS (SELECT *, list_filter(regexp_split_to_array({_strip("french")}, '\s*[,;]\s*'), lambda x: x <> '') AS a,
  list_filter(regexp_split_to_array({_strip("coalesce(english,'')")}, '\s*[,;]\s*'), lambda x: x <> '') AS b FROM lexicon_entries),
w AS (SELECT *, len(list_filter(regexp_split_to_array({_strip("moore")}, '\s+'), lambda x: x <> '')) AS mw FROM s),
t AS (SELECT *, coalesce(regexp_matches(french, '[,;]') AND len(a) >= 2 AND mw <= 4 AND NOT regexp_matches(moore, '[,;]')
  AND len(list_filter(a, lambda x: len(list_filter(regexp_split_to_array(x, '\s+'), lambda y: y <> '')) > 4 OR regexp_matches(x, '[.!?]'))) = 0, false) AS y FROM w),
r AS (SELECT entry_id, loaded_at, french, english, a, b, y, unnest(range(CASE WHEN y THEN greatest(len(a), len(b)) ELSE 1 END)) AS k FROM t)
SELECT entry_id, epoch_us(loaded_at) AS at, CASE WHEN y THEN coalesce(a[k+1], a[len(a)], '') ELSE french END AS french, CASE WHEN y THEN coalesce(b[k+1], b[len(b)], '') ELSE english END AS english,
  CASE WHEN y THEN (k+1)::INTEGER END AS synonym_no FROM r""",
    "proverbs_stripped": rf"""WITH s AS (SELECT entry_id, epoch_us(loaded_at) AS at, moore, len_ratio AS l, {_proverb("french")} AS french, {_proverb("english")} AS english FROM lexicon_entries)
SELECT entry_id, "at", french, english, CASE WHEN isnan(l) THEN NULL WHEN l IS NOT NULL AND {_strip("coalesce(french,'')")} <> '' AND {_strip("coalesce(moore,'')")} <> ''
  THEN round_even(least(length(french),length(moore))/greatest(length(french),length(moore))*10000.0,0)/10000 ELSE round_even(l*10000,0)/10000 END AS len_ratio FROM s""",
    "bitext_fields": r"""WITH r AS (SELECT pair_id, string_split(coalesce(english,'') || chr(9) || coalesce(moore,'') || chr(9) || coalesce(laser_score::VARCHAR,'') || chr(9) || 'x' || chr(9) || '0.0', chr(9)) AS f FROM fr_mos_combined)
SELECT pair_id, nullif(f[1],'') AS eng_Latn, nullif(f[2],'') AS mos_Latn, nullif(try_cast(f[3] AS DOUBLE), 0) AS laser_score, nullif(try_cast(f[4] AS DOUBLE), 0) AS source_sentence_lid,
  nullif(try_cast(f[5] AS DOUBLE), 0) AS target_sentence_lid, nullif(f[6],'') AS source_sentence_source FROM r""",
    "running_offsets": f"""WITH p AS (SELECT pt_id, lower(trim(source)) AS source, len(french)::BIGINT AS n FROM {_one("parallel_text", "pt_id")})
SELECT pt_id, source, n, coalesce(sum(n) OVER (PARTITION BY source ORDER BY pt_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM p""",
    "kinds_of_word": "SELECT pos_tag, count(*) AS n FROM lexicon_entries GROUP BY pos_tag",
}

SQL = {name: each_once(text) for name, text in SQL.items()}
