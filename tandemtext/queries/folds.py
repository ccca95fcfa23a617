"""Further queries: word joins, ordered folds, page blocks, unions, titles and names."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemtext.functions import text as T
from tandemtext.operators import columns as C
from tandemtext.operators import filters, joins, lines, report, wordlists
from tandemtext.queries.once import each_once, once
from tandemtext.session import table

#: Title markers in order of priority.
MARKERS = (("le ", "masculine"), ("la ", "feminine"), ("l'", "elided"), ("the ", "english"))


#: Names of the texts and what takes their place; some change places.
NAMES = {"Nubo": "Loyougo", "Loyougo": "Nubo", "Dagén": "Tékuba", "Tékuba": "Dagén", "Suwa": "Zima", "Zima": "Ridi", "Lidiba": "Kadiba", "Niekogo": "Zoubugo", "Zoubugo": "Poko", "Nete": "Netego"}


def words_listed(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "pair_id", "french", "loaded_at").select("pair_id", "french")
    listed = wordlists.lexicon_words(once(spark, sf, "lexicon_entries", "english"), "english")
    return joins.semi_words(df, F.array_distinct(T.tokens(F.coalesce("french", F.lit("")))), listed, "pair_id").select("pair_id")


def words_unlisted(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "pair_id", "french", "loaded_at").select("pair_id", "french")
    listed = wordlists.words_in(once(spark, sf, "lexicon_entries", "french"), "french")
    return joins.unlisted_count(df, F.array_distinct(T.tokens(F.coalesce("french", F.lit("")))), listed, "pair_id")


def names_replaced(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "nation", "n_nationkey", "n_name")
    return df.select("n_nationkey", joins.substitute_names(F.col("n_name"), {"CHINA": "INDIA", "INDIA": "CHINA", "UNITED": "JOINED"}).alias("name"))


def names_in_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Names inside running text; ``names_replaced`` has names that are the whole value or its first word."""
    df = once(spark, sf, "fr_mos_combined", "pair_id", "french", "moore")
    return df.select("pair_id", *[joins.substitute_names(F.col(c), NAMES).alias(c) for c in ("french", "moore")])


def canonical_titles(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "sections", "section_id", "title", "loaded_at").select("section_id", F.col("title").alias("line"))
    return joins.canonical_title(df, "line", MARKERS).select("section_id", "title")


def lines_before_stop(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "sections", "section_id", "raw_text", "loaded_at").where("raw_text is not null")
    kept = lines.until_stop(lines.lines_of(df, "section_id", "raw_text"), "section_id", "line_no", F.trim("line") == "")
    return kept.groupBy("section_id").agg(F.count("*").alias("lines"), F.max("line_no").alias("last_line"))


def lines_rejoined(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "sections", "section_id", "raw_text", "loaded_at").where("raw_text is not null")
    return lines.join_broken_pages(lines.lines_of(df, "section_id", "raw_text"), "section_id", "line_no", "line")


def values_carried(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    return lines.carry_value(df, "o_custkey", "o_orderkey", F.col("o_totalprice"), F.col("o_totalprice") > 100000, "before").select("o_orderkey", "before")


def page_columns(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_linestatus")
    blocks = df.select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("block_no"), (F.col("l_quantity") * 10).cast("double").alias("x0"), F.lit(500.0).alias("page_width"), F.col("l_linestatus").alias("text"))
    return lines.columns_of_page(blocks, ["page"])


def chapters_by_page(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", F.col("l_quantity"))
    starts = [(1, 3), (2, 10), (3, 17), (4, 25), (5, 32)]
    out = lines.range_of(df.withColumn("page", F.col("l_quantity").cast("int")), "page", starts, stop=47)
    return out.groupBy("chapter_no").agg(F.count("*").alias("n"), F.min("page").alias("first_page"), F.max("page").alias("last_page"))


def sides_present(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "pair_id", "french", "moore")
    a, b = F.col("french"), F.col("moore")
    return df.select("pair_id", filters.both_sides(a, b).alias("both"), filters.any_side(a, b).alias("any"))


def sources_united(spark: SparkSession, sf: str) -> DataFrame:
    names = ("fr_mos_combined", "aligned_pairs", "lexicon_entries")
    parts = [once(spark, sf, n, "french", "moore", "source").select("french", "moore", "source").withColumn("file_ord", F.lit(k)) for k, n in enumerate(names)]
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return united.groupBy("file_ord", F.lower(F.trim("source")).alias("source")).agg(F.count("*").alias("n"))


def hyphens_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return once(spark, sf, "lexicon_entries", "entry_id", "moore").select("entry_id", T.fix_hyphens(F.col("moore")).alias("moore"))


def equal_sides(spark: SparkSession, sf: str) -> DataFrame:
    df = joins.equal_lengths(once(spark, sf, "aligned_corpus", "pt_id", "french", "moore"), ["french", "moore"])
    return df.select("pt_id", F.size("french").alias("n"))


def enumerated_lines(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "chapters", "chapter_id", "raw_text", "loaded_at").where("raw_text is not null")
    out = lines.lines_of(df, "chapter_id", "raw_text").select("chapter_id", "line_no", T.enum_number(F.col("line")).alias("num"))
    return out.where("num is not null")


def matched_share(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part", "p_partkey")
    used = table(spark, sf, "lineitem", F.col("l_partkey").alias("p_partkey")).distinct()
    return report.match_rate(parts.join(used, "p_partkey", "left_semi"), parts)


def columns_with_values(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "fr_mos_combined", "pair_id", "english").withColumn("nothing", F.lit(None).cast("string"))
    return C.drop_all_null(df, ["english", "nothing"])


def labels_plain(spark: SparkSession, sf: str) -> DataFrame:
    df = once(spark, sf, "aligned_pairs", "pair_id", "moore_glotlid_lang")
    return df.select("pair_id", T.language_label(F.concat(F.lit("__label__"), "moore_glotlid_lang")).alias("label"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        words_listed, words_unlisted, names_replaced, names_in_texts, canonical_titles, lines_before_stop, lines_rejoined, values_carried, page_columns,
        chapters_by_page, sides_present, sources_united, hyphens_fixed, equal_sides, enumerated_lines, matched_share, columns_with_values, labels_plain,
    )
}

_T = r"regexp_extract_all(lower(coalesce({},'')), '[\p{{L}}\p{{N}}_]+')"
_ONE = "(SELECT * FROM {0} QUALIFY row_number() OVER (PARTITION BY {1} ORDER BY loaded_at DESC NULLS LAST) = 1)"
_LINES = "(SELECT {0}, generate_subscripts(l, 1)::INTEGER AS line_no, unnest(l) AS line FROM (SELECT {0}, string_split(raw_text, chr(10)) AS l FROM {1} WHERE raw_text IS NOT NULL))"
_SEC = _LINES.format("section_id", _ONE.format("sections", "section_id"))

SQL: dict[str, str] = {
    "words_listed": rf"""WITH l AS (SELECT DISTINCT regexp_replace(regexp_replace(w, '^\.+', ''), '^-+', '') AS word FROM (SELECT unnest(regexp_split_to_array(lower(regexp_replace(english, '\[[^\]]*\]', ' ', 'g')), '\s+')) AS w FROM lexicon_entries) WHERE NOT starts_with(w, '@')),
p AS (SELECT pair_id, unnest({_T.format("french")}) AS word FROM {_ONE.format("fr_mos_combined", "pair_id")})
SELECT DISTINCT pair_id FROM p WHERE word IN (SELECT word FROM l WHERE length(word) >= 2)""",
    "words_unlisted": rf"""WITH l AS (SELECT DISTINCT unnest({_T.format("french")}) AS word FROM lexicon_entries), o AS {_ONE.format("fr_mos_combined", "pair_id")},
w AS (SELECT DISTINCT pair_id, unnest({_T.format("french")}) AS word FROM o), c AS (SELECT pair_id, count(*) AS n FROM w WHERE word NOT IN (SELECT word FROM l) GROUP BY pair_id)
SELECT o.pair_id, coalesce(n, 0) AS unlisted FROM o LEFT JOIN c USING (pair_id)""",
    "names_replaced": "SELECT n_nationkey, CASE n_name WHEN 'CHINA' THEN 'INDIA' WHEN 'INDIA' THEN 'CHINA' ELSE replace(n_name, 'UNITED', 'JOINED') END AS name FROM nation",
    "canonical_titles": f"""SELECT section_id, CASE WHEN starts_with(lower(title), 'le ') THEN 'masculine' WHEN starts_with(lower(title), 'la ') THEN 'feminine'
  WHEN starts_with(lower(title), 'l''') THEN 'elided' WHEN starts_with(lower(title), 'the ') THEN 'english' END AS title FROM {_ONE.format("sections", "section_id")}""",
    "lines_before_stop": f"""WITH l AS {_SEC}, s AS (SELECT section_id, min(line_no) AS stop FROM l WHERE trim(line) = '' GROUP BY section_id)
SELECT section_id, count(*) AS lines, max(line_no) AS last_line FROM l LEFT JOIN s USING (section_id) WHERE stop IS NULL OR line_no < stop GROUP BY section_id""",
    "lines_rejoined": rf"""WITH l AS {_SEC}, w AS (SELECT *, lag(line) OVER x AS p, lead(line) OVER x AS q FROM l WINDOW x AS (PARTITION BY section_id ORDER BY line_no)),
s AS (SELECT *, CASE WHEN regexp_matches(p, '[\p{{L}}\p{{M}}\p{{N}}_]-\s*$') THEN regexp_replace(line, '^\s*\S+\s*', '') ELSE line END AS body,
  regexp_matches(line, '[\p{{L}}\p{{M}}\p{{N}}_]-\s*$') AND q IS NOT NULL AS broken FROM w)
SELECT section_id, line_no, CASE WHEN broken THEN regexp_replace(body, '-\s*$', '') || regexp_extract(q, '^\s*(\S+)', 1) ELSE body END AS line FROM s""",
    "values_carried": """SELECT o_orderkey, last_value(CASE WHEN o_totalprice > 100000 THEN o_totalprice END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM orders""",
    "page_columns": """SELECT l_orderkey AS page, string_agg(l_linestatus, chr(10) || chr(10) ORDER BY least(floor(l_quantity*10/250.0), 1), l_linenumber, l_linestatus) AS text FROM lineitem
WHERE trim(l_linestatus) <> '' GROUP BY l_orderkey""",
    "chapters_by_page": """WITH p AS (SELECT trunc(l_quantity)::INTEGER AS page FROM lineitem), c AS (SELECT page, CASE WHEN page >= 32 THEN 5 WHEN page >= 25 THEN 4 WHEN page >= 17 THEN 3 WHEN page >= 10 THEN 2 WHEN page >= 3 THEN 1 END AS chapter_no FROM p)
SELECT chapter_no, count(*) AS n, min(page) AS first_page, max(page) AS last_page FROM c WHERE chapter_no IS NOT NULL AND page <= 47 GROUP BY chapter_no""",
    "sides_present": r"""SELECT pair_id, regexp_matches(coalesce(french,''), '\S') AND regexp_matches(coalesce(moore,''), '\S') AS both, regexp_matches(coalesce(french,''), '\S') OR regexp_matches(coalesce(moore,''), '\S') AS "any" FROM fr_mos_combined""",
    "sources_united": """SELECT file_ord, lower(trim(source)) AS source, count(*) AS n FROM (SELECT 0 AS file_ord, source FROM fr_mos_combined UNION ALL SELECT 1, source FROM aligned_pairs UNION ALL SELECT 2, source FROM lexicon_entries) GROUP BY 1, 2""",
    "hyphens_fixed": r"""SELECT entry_id, regexp_replace(regexp_replace(moore, '([\p{L}\p{M}\p{N}_])-\s+([\p{L}\p{M}\p{N}_])', '\1-\2', 'g'), '([\p{L}\p{M}\p{N}_])\s+-([\p{L}\p{M}\p{N}_])', '\1-\2', 'g') AS moore FROM lexicon_entries""",
    "equal_sides": "SELECT pt_id, len(french)::INTEGER AS n FROM aligned_corpus",
    "enumerated_lines": rf"""WITH l AS {_LINES.format("chapter_id", _ONE.format("chapters", "chapter_id"))} SELECT chapter_id, line_no, regexp_extract(line, '^(\d+)\.\s', 1)::INTEGER AS num FROM l WHERE regexp_matches(line, '^(\d+)\.\s')""",
    "matched_share": """SELECT count(*) FILTER (p_partkey IN (SELECT l_partkey FROM lineitem)) AS matched, count(*) AS total,
  round_even(count(*) FILTER (p_partkey IN (SELECT l_partkey FROM lineitem))*100.0::DOUBLE/count(*)*10000,0)/10000 AS percent FROM part""",
    "columns_with_values": "SELECT pair_id, english FROM fr_mos_combined",
    "labels_plain": "SELECT pair_id, moore_glotlid_lang AS label FROM aligned_pairs",
}

_NAMED = r"array_to_string(list_transform(regexp_extract_all({0}, '[\p{{L}}\p{{M}}\p{{N}}_]+|[^\p{{L}}\p{{M}}\p{{N}}_]+'), lambda w: CASE w {1} ELSE w END), '')"
_WHEN = " ".join(f"WHEN '{name}' THEN '{other}'" for name, other in NAMES.items())
SQL["names_in_texts"] = f"SELECT pair_id, {_NAMED.format('french', _WHEN)} AS french, {_NAMED.format('moore', _WHEN)} AS moore FROM fr_mos_combined"

SQL = {name: each_once(text) for name, text in SQL.items()}
