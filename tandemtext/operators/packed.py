"""Several values packed in one field: split them into one value per row, place kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandemtext.functions.text import BLANKS

#: Separators between values, and the private characters that stand for them inside literals.
SEPARATORS = ",;|•·\t\n/"
MASKS = "".join(chr(0xE100 + i) for i in range(len(SEPARATORS)))
#: Opening and closing quotation marks.
QUOTES = (('"', '"'), ("“", "”"), ("«", "»"))

#: A quoted literal (doubled straight marks belong to it), a run without marks, or a stray mark.
PIECE = r'"(?:[^"]|"")*"|“[^”]*”|«[^»]*»|[^"“«]+|["“«]'
#: A slash separates only next to white space, a mark or an end; elsewhere it is part of a word (km/h).
SPLIT = r'[,;|•·\t\n]|(?<=[\s"”»)]|^)/|/(?=[\s"“«]|$)'
NUMBERED = r"^\s*\(?1[.)]\s"
NUMBER_GAP = r"\s+(?=\(?\d{1,2}[.)]\s)"
PLACEHOLDERS = ("", "-", "--", "—", "–", "?", "n/a", "N/A", "null", "None")
#: What a field without any of these signs holds is one value, or a sentence.
MARKED = rf"[{SEPARATORS}\"“”«».!?…]|^\s*\(?1[.)]"


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS + "\u200b"))


def is_sentence(text: Column) -> Column:
    """Running text: ends in a sentence mark, begins with a capital and has four words or more."""
    t = trimmed(text)
    return t.rlike(r"[.!?…][\"”»)]*$") & t.rlike(r"^[\"“«(]*\s*\p{Lu}") & (F.size(F.split(t, r"\s+")) >= 4)


def _protect(text: Column) -> Column:
    """Mask separators in parentheses and decimal commas. Texts without a parenthesis skip the fold for them."""
    pieces = F.regexp_extract_all(text, F.lit(r"\([^()]*\)|[^()]+|[()]"), F.lit(0))
    inside = F.transform(pieces, lambda p: F.when(p.rlike(r"(?s)^\(.*\)$"), F.translate(p, SEPARATORS, MASKS)).otherwise(p))
    return F.regexp_replace(F.when(text.contains("("), F.array_join(inside, "")).otherwise(text), r"(?<=\d),(?=\d)", MASKS[0])


def split_values(text: Column) -> Column:
    """``ARRAY<STRING>`` of the values packed in ``text``.

    The field is cut into quoted literals and the plain pieces between them;
    literals keep their separators, plain pieces are split, and a fold glues
    each piece to the value it continues. White space, list numbers, bullets
    and enclosing marks are taken off; empty values are skipped; repeated
    values stay. Null, blank and placeholder fields give an empty array, and so
    do sentences (they hold no list). A stray, unclosed mark is plain text.
    """
    numbered = text.rlike(NUMBERED)
    body = _protect(text)
    empty = F.array().cast("array<string>")

    def parted(piece: Column) -> Column:
        return F.split(F.when(numbered, F.regexp_replace(piece, NUMBER_GAP, "\n")).otherwise(piece), SPLIT, -1)

    def step(acc: Column, piece: Column) -> Column:
        literal = (F.length(piece) > 1) & piece.rlike(r'^["“«]')
        parts = F.when(literal, F.array(F.translate(piece, SEPARATORS, MASKS))).otherwise(parted(piece))
        head = F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
        glued = F.concat(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit("")), F.get(parts, F.lit(0)))
        return F.concat(head, F.array(glued), F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))))

    def bare(value: Column) -> Column:
        v = trimmed(F.translate(value, MASKS, SEPARATORS))
        return F.when(numbered, trimmed(F.regexp_replace(v, r"^\(?\d{1,2}[.)](?=\s|$)", ""))).otherwise(v)

    def unquoted(v: Column) -> Column:
        straight = v.rlike(r'(?s)^"(?:[^"]|"")*"$') & (F.length(v) > 1)
        curly = v.rlike(r"(?s)^“[^”]*”$") | v.rlike(r"(?s)^«[^»]*»$")
        inner = F.substring(v, F.lit(2), F.length(v) - 2)
        return F.when(straight | curly, trimmed(F.replace(inner, F.lit('""'), F.lit('"')))).otherwise(v)

    told = lambda v: ~v.isin(*PLACEHOLDERS)
    # a field without quotation marks is one plain piece and needs no fold
    plain = F.filter(F.transform(parted(body), bare), told)
    folded = F.aggregate(F.regexp_extract_all(body, F.lit(PIECE), F.lit(0)), empty, step)
    quoted = F.filter(F.transform(folded, lambda v: unquoted(bare(v))), told)
    values = F.when(body.rlike('["“«]'), quoted).otherwise(plain)
    single = F.filter(F.array(trimmed(text)), told)
    return F.when(text.isNull(), empty).when(~text.rlike(MARKED), single).when(is_sentence(text), empty).otherwise(values)


def unpack_fields(df: DataFrame, key: str, fields: list[str], keep: int = 1) -> DataFrame:
    """(key, field_name, item_no, item) of every field that holds ``keep`` values or more.

    One narrow pass without a shuffle: the scan reads only the key and the
    fields, each row explodes into its own values. Rows are taken as they come;
    give one row per key (see ``session.latest``) where repeats must count once.
    """
    lists = F.array(*[F.struct(F.lit(f).alias("field_name"), split_values(F.col(f)).alias("items")) for f in fields])
    return (
        df.select(F.col(key), F.explode(lists).alias("f"))
        .where(F.size("f.items") >= keep)
        .select(key, "f.field_name", F.posexplode("f.items").alias("pos", "item"))
        .select(key, "field_name", (F.col("pos") + 1).alias("item_no"), "item")
    )
