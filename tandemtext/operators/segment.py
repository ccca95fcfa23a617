"""Segmentation of text into sentences and language runs, as array expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandemtext.functions.text import join_lines, squeeze, strip

CUT = "\x01"
#: Marks that end a Moore article.
END_OF_MOORE = r"(?iu)^Kibar[aã]\s+yii|^Z[ɩi]ll\s+KAFAANDO"
EMPTY = "array<string>"


def _strings() -> Column:
    return F.array().cast(EMPTY)


def not_blank(parts: Column) -> Column:
    return F.filter(F.transform(parts, strip), lambda p: p != "")


def split_semicolons(text: Column) -> Column:
    """Parts between semicolons outside quotes; each of ``"``, ``«``, ``»`` opens or closes."""
    pieces = F.regexp_extract_all(text, F.lit("[\"«»]|[^\"«»]+"), F.lit(0))
    start = F.struct(F.lit("").alias("text"), F.lit(False).alias("quoted"))

    def step(acc: Column, piece: Column) -> Column:
        mark = piece.isin('"', "«", "»")
        shown = F.when(mark | acc["quoted"], piece).otherwise(F.replace(piece, F.lit(";"), F.lit(CUT)))
        return F.struct(F.concat(acc["text"], shown).alias("text"), F.when(mark, ~acc["quoted"]).otherwise(acc["quoted"]).alias("quoted"))

    return F.split(F.aggregate(pieces, start, step)["text"], CUT)


def split_sentences(text: Column) -> Column:
    """ARRAY of sentences: cut after ``. ! ?`` with an optional closing quote, then at free semicolons; none for null."""
    flat = squeeze(F.coalesce(text, F.lit("")))
    first = F.split(F.regexp_replace(flat, r"([.!?][\"»”]?)\s+", "$1" + CUT), CUT)
    return not_blank(F.flatten(F.transform(first, split_semicolons)))


def _open(text: Column) -> Column:
    def count(c: str) -> Column:
        return F.regexp_count(text, F.lit(c))

    return (count("«") > count("»")) | (count('"') % 2 == 1) | (count("“") > count("”"))


def merge_quotes(sentences: Column) -> Column:
    """Glue a sentence to the one before while a quotation is open, or where it is a closing mark alone."""

    def step(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        glue = (F.size(acc) > 0) & (_open(last) | strip(s).isin("»", "”", '"'))
        head = F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
        return F.when(glue, F.concat(head, F.array(F.concat(last, F.lit(" "), s)))).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(sentences, _strings(), step)


#: Titles before a name and abbreviations before a number, whose full stop ends no sentence; the character that holds a gap.
TITLES = ("M", "MM", "Mme", "Mmes", "Mlle", "Mgr", "Me", "Dr", "Pr", "Prof", "St", "Ste")
BEFORE_NUMBER = ("p", "pp", "n", "no", "art", "vol", "chap", "fig", "env")
HELD = "\ue1ff"


def segment(text: Column) -> Column:
    """Sentences of prose: lines joined, cut, quotations kept whole; the whole text where nothing cuts it."""
    flat = join_lines(F.coalesce(text, F.lit("")))
    # titles, initials and what goes on with a small letter or a number keep their full stop
    held = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(TITLES)}|\p{{Lu}})\.\s+(?=\p{{Lu}})|(?<=\.)\s+(?=\p{{Ll}})|(?<![\p{{L}}\p{{N}}])(?:{'|'.join(BEFORE_NUMBER)})\.\s+(?=\d)"
    kept = F.regexp_replace(flat, rf"({held})", "$1" + HELD)
    parts = not_blank(F.split(F.regexp_replace(kept, rf"([.!?]+[\"»”]?)\s+(?![\s{HELD}])", "$1" + CUT), CUT))
    return merge_quotes(F.transform(parts, lambda p: F.replace(p, F.lit(HELD), F.lit(""))))


def language_boundary(units: Column, langs: Column | None = None, end: str = END_OF_MOORE, second: str = "fra_Latn") -> Column:
    """STRUCT<moore, french>: units up to the end mark, or before the first one in the second language.

    Without either all units are Moore. An empty side is null.
    """
    marked = F.nullif(F.array_position(F.transform(units, lambda u: F.coalesce(u.rlike(end), F.lit(False))), True), F.lit(0).cast("long"))
    found = F.lit(None).cast("long") if langs is None else F.nullif(F.array_position(langs, second), F.lit(0).cast("long")) - 1
    cut = F.coalesce(marked, found, F.size(units).cast("long")).cast("int")

    def side(part: Column) -> Column:
        return F.when(F.size(part) > 0, part)

    return F.struct(side(F.slice(units, 1, cut)).alias("moore"), side(F.slice(units, cut + 1, F.greatest(F.size(units) - cut, F.lit(0)))).alias("french"))


def explode_sentences(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """(keep..., pos, sentence): one row per sentence with its 0-based place."""
    return df.select(*keep, F.posexplode(split_sentences(F.col(text))).alias("pos", "sentence"))


def manual_units(section: Column) -> Column:
    """ARRAY of the texts of a section in reading order: body, numbered items, bullets, then each subsection alike."""

    def own(s: Column) -> Column:
        items = F.transform(F.coalesce(s["items"], F.array().cast("array<struct<num:int,text:string>>")), lambda x: x["text"])
        bullets = F.transform(F.coalesce(s["bullet_items"], F.array().cast("array<struct<text:string>>")), lambda x: x["text"])
        return F.concat(F.array(s["body"]), items, bullets)

    subs = F.when(section["subsections"].isNull(), F.array(_strings())).otherwise(F.transform(section["subsections"], lambda s: F.concat(F.array(s["title"]), own(s))))
    return not_blank(F.filter(F.concat(own(section), F.flatten(subs)), lambda x: x.isNotNull()))
