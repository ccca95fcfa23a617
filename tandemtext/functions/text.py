"""Normalisation of text as Column expressions; null in, null out unless said otherwise."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Unicode, as a Java class.
SPACE = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1C}-\x{1F}]"
BLANKS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Quotes, dashes and blanks with a plain one-character form.
PLAIN_FORMS = {"‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"', "–": "-", "—": "-", "―": "-", "‐": "-", "‑": "-", " ": " ", " ": " "}
#: Ligatures that stand for two or three letters.
LIGATURES = {"ϧ": "fi", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}

PAGE_REFERENCE = r"(?i)\([^)]*\bp\.?\s*\d+\)"
STANDALONE_NUMBER = r"^\s*\d+(?:[-–]\d+)?(?:[.,;:\s]+\d+(?:[-–]\d+)?)*[.,;:]?\s*$"
NUMBER_DOTS = r"^\d+\.+$"
URL = r"(?i)https?://|www\."


def strip(text: Column) -> Column:
    """Without white space of any kind at the ends; a set of characters trims far faster than a pattern."""
    return F.btrim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


def squeeze(text: Column) -> Column:
    """Runs of white space become one blank; ends are stripped."""
    return strip(F.regexp_replace(text, f"{SPACE}+", " "))


def join_lines(text: Column) -> Column:
    """Line breaks become blanks, runs of blanks one, and a blank parts sentences that touch."""
    flat = F.regexp_replace(F.regexp_replace(text, r"\n+", " "), r" {2,}", " ")
    return F.regexp_replace(strip(flat), r"(?<=[.!?])(?=[A-ZÀ-Ö][a-zà-öø-ÿ])", " ")


def straight_quotes(text: Column) -> Column:
    return F.translate(text, "“”", '""')


def normalize_french(text: Column) -> Column:
    """Straight double quotes, no blank before closing punctuation nor after an opening guillemet; line breaks and tabs stay."""
    out = F.regexp_replace(straight_quotes(text), r" +([!?:;».,])", "$1")
    return strip(F.regexp_replace(F.regexp_replace(out, r"« +", "«"), r" {2,}", " "))


def normalize_moore(text: Column) -> Column:
    """Straight double quotes, single blanks, stripped ends."""
    return strip(F.regexp_replace(straight_quotes(text), r" {2,}", " "))


#: Clitics before which a hyphen at a line end stays.
CLITICS = ("ce", "il", "ils", "elle", "elles", "on", "je", "tu", "nous", "vous", "le", "la", "les", "lui", "y", "en", "t", "ci", "là", "moi", "toi", "soi")
#: Base letters and combining marks of the composed letters that French and Moore are written with.
_COMPOSED = {unicodedata.normalize("NFD", c): c for c in map(chr, range(0xC0, 0x250)) if len(unicodedata.normalize("NFD", c)) == 2}
_COMPOSED |= {unicodedata.normalize("NFD", c): c for c in "ẼẽṼṽỸỹ"}


def composed(text: Column) -> Column:
    """Letters followed by one combining mark become the composed letter (NFC for the letters of French and Moore)."""
    pairs = F.create_map(*[F.lit(x) for pair in _COMPOSED.items() for x in pair])
    pieces = F.regexp_extract_all(text, F.lit(r"(?s)[A-Za-z][\u0300-\u036f]|."), F.lit(0))
    return F.when(text.rlike(r"[\u0300-\u036f]"), F.array_join(F.transform(pieces, lambda p: F.coalesce(F.element_at(pairs, p), p)), "")).otherwise(text)


def typeset_french(text: Column) -> Column:
    """Book text: composed letters, straight quotes, lines joined (a hyphen stays before a clitic), a blank before tall marks."""
    out = F.translate(composed(text), "‘’“”‟„", "''\"\"\"\"")
    out = F.regexp_replace(out, rf"-\s*\n\s*(?=(?:{'|'.join(CLITICS)})\b)", "-")
    out = F.regexp_replace(out, r"(?<=\p{L})-\s*\n\s*(?=\p{Ll})", "")
    out = F.regexp_replace(F.regexp_replace(out, r"[ \t]+", " "), r"\s*([!?:;])", " $1")
    return strip(F.regexp_replace(out, r"\n{2,}", "\n"))


def typeset_moore(text: Column) -> Column:
    """As :func:`typeset_french`, but every hyphen at a line end joins its word."""
    out = F.translate(composed(text), "‘’“”‟„", "''\"\"\"\"")
    out = F.regexp_replace(F.regexp_replace(out, r"-\s*\n\s*", ""), r"[ \t]+", " ")
    return strip(F.regexp_replace(out, r"\n{2,}", "\n"))


def plain_forms(text: Column) -> Column:
    """Typographic quotes, dashes and blanks become plain; an ellipsis becomes three dots."""
    out = F.translate(text, "".join(PLAIN_FORMS), "".join(PLAIN_FORMS.values()))
    return F.replace(out, F.lit("…"), F.lit("..."))


def clean_cell(text: Column) -> Column:
    """A table cell: null becomes '', plain forms, white space squeezed."""
    return squeeze(plain_forms(F.coalesce(text, F.lit(""))))


def expand_ligatures(text: Column) -> Column:
    for one, many in LIGATURES.items():
        text = F.replace(text, F.lit(one), F.lit(many))
    return text


def fix_hyphens(text: Column) -> Column:
    """Blanks on one side of a hyphen inside a word go."""
    out = F.regexp_replace(text, r"(?U)(?<=\w)-\s+(?=\w)", "-")
    return F.regexp_replace(out, r"(?U)(?<=\w)\s+-(?=\w)", "-")


def drop_page_references(text: Column) -> Column:
    return F.regexp_replace(text, PAGE_REFERENCE, "")


def is_standalone_number(text: Column) -> Column:
    return text.rlike(STANDALONE_NUMBER)


def is_number_dots(text: Column) -> Column:
    return text.rlike(NUMBER_DOTS)


def has_url(text: Column) -> Column:
    return text.rlike(URL)


def has_copyright(text: Column) -> Column:
    return text.contains("©")


def one_line(text: Column, keep_single: bool = False) -> Column:
    """Newlines become blanks; with ``keep_single`` only runs of two or more collapse, to one newline."""
    if keep_single:
        return strip(F.regexp_replace(F.regexp_replace(text, r"\n{2,}", "\n"), r"[ \t]+", " "))
    return strip(F.regexp_replace(text, r"\s*\n\s*", " "))


#: Furniture of dictionary pages (letter marks, page numbers, lone hyphens, counters, time stamps, file links, the
#: running title), blanks after a hyphen, and what takes their place.
DICTIONARY_NOISE = (
    (r"\b[A-Z]\s+[a-z]\b", ""),
    (r"(?m)^[ \t]*\d+[ \t]*$", ""),
    (r"(?m)^[ \t]*-[ \t]*$", ""),
    (r"(\w)- +(\w)", "$1-$2"),
    (r"(?i)\b\d+\s+of\s+\d+\b", ""),
    (r"\b\d{1,2}/\d{1,2}/\d{4}\s+\d{1,2}:\d{2}\b", ""),
    (r"file:///\S+", ""),
    (r"(?is)Dictionnaire\s+Mooré.*?français.*?English", ""),
    (r"[ \t]+", " "),
    (r"\n[ \t]*(?:\n[ \t]*)+", "\n"),
)


def scrub_page(text: Column) -> Column:
    """Dictionary page without its furniture; ligatures expanded, a blank after a hyphen inside a word dropped."""
    out = expand_ligatures(text)
    for pattern, new in DICTIONARY_NOISE:
        out = F.regexp_replace(out, f"(?U){pattern}", new)
    return strip(out)


def rewrite_variant_stub(text: Column) -> Column:
    """``lemma [tone] unspec. var. of X`` becomes an entry whose French gloss names the variant."""
    pattern = r"(?m)^([^\[\n]+?)\s*(\[[^\]\n]*\])?\s*unspec\.\s*var\.\s*of[ \t]+([^\n(]+?)[ \t]*(?:\([^)\n]*\))?[ \t]*$"
    return F.regexp_replace(text, pattern, "$1 $2 n Frn (unspec. var. of $3) Eng")


def strip_entry_name(text: Column, lemma: Column) -> Column:
    """Drop the last line where it repeats the lemma."""
    lines = F.split(text, "\n")
    last = strip(F.element_at(lines, -1))
    return F.when((F.size(lines) > 1) & (last == strip(lemma)), F.array_join(F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(0))), "\n")).otherwise(text)


def repair_token(token: Column) -> Column:
    """STRUCT<token, tone>: a trailing sense number goes, an inline tone in brackets is split off."""
    bare = F.regexp_replace(token, r"\d+\)$", "")
    tone = F.regexp_extract(bare, r"^[^\[\]]+(\[[^\]]*\])$", 1)
    return F.struct(F.regexp_replace(bare, r"\[[^\]]*\]$", "").alias("token"), F.nullif(tone, F.lit("")).alias("tone"))


def enum_number(text: Column) -> Column:
    """Leading ``N. `` as INT; null without one."""
    return F.nullif(F.regexp_extract(text, r"^(\d+)\.\s", 1), F.lit("")).try_cast("int")


def remove_headers(text: Column) -> Column:
    """Without section letters, page numbers and dates on lines of their own."""
    out = F.regexp_replace(text, r"(?m)^[ \t]*\p{Lu}[ \t]*[-–][ \t]*\p{Ll}[ \t]*$", "")
    out = F.regexp_replace(out, r"(?m)^[ \t]*(?:Page[ \t]+)?\d{1,4}[ \t]*$", "")
    return F.regexp_replace(out, r"\b\d{1,2}/\d{1,2}/\d{4}\b", "")


def page_numbers(text: Column) -> Column:
    """ARRAY<INT> of the numbers that stand alone on a line."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(?m)^[ \t]*(\d{1,4})[ \t]*$"), F.lit(1)), lambda x: x.cast("int"))


def language_label(label: Column) -> Column:
    """A classifier's label without its prefix."""
    return F.regexp_replace(label, "^__label__", "")


def loose_pattern(phrase: str) -> str:
    """Regular expression of a phrase whose blanks may be any run of blanks, line breaks and hyphens."""
    return r"[\s-]+".join(re.escape(w) for w in phrase.split())


def nfc(text: Column) -> Column:
    """Composed Unicode form, in Arrow batches; there is no built-in for it."""

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")

    run.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string")(text)


#: Letters with a mark that decomposition takes off, from the Latin blocks, by rule.
_MARKED = [c for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]) if unicodedata.normalize("NFKD", c) != c]
_SINGLE = {c: b for c in _MARKED if len(b := "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))) == 1}


def fold_key(text: Column) -> Column:
    """Join key: lower case, stripped, Latin letters without their marks. Stays in the JVM."""
    out = F.translate(F.lower(strip(text)), "".join(_SINGLE), "".join(_SINGLE.values()))
    return F.regexp_replace(F.lower(out), r"\p{M}+", "")


def tokens(text: Column) -> Column:
    """Lower-case word tokens of letters, digits and underscores, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def length_ratio(source: Column, target: Column) -> Column:
    """Shorter by longer length in characters, to four places; 0.0 where a side is null or empty."""
    a, b = F.length(F.coalesce(source, F.lit(""))), F.length(F.coalesce(target, F.lit("")))
    return F.when((a == 0) | (b == 0), F.lit(0.0)).otherwise(round4(F.least(a, b) / F.greatest(a, b)))


def round4(number: Column) -> Column:
    """Four decimal places, halves to even."""
    return F.rint(number * 10000) / 10000
