"""Queries over packed dictionary fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tandemtext.operators.packed import unpack_fields
from tandemtext.session import latest, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = table(spark, sf_dir, "lexicon_entries", "entry_id", "french", "moore", "synonym", "loaded_at")
    return unpack_fields(latest(entries, "entry_id"), "entry_id", ["french", "moore", "synonym"], keep=2)


QUERIES = {"p1_found": p1_found}

# The statement masks separators in literals, joins the pieces and splits the whole; no fold is needed there.
_SEPS, _MASKS = "',;|•·' || chr(9) || chr(10) || '/'", "'".join(["", "".join(chr(0xE100 + i) for i in range(8)), ""])
_WS = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1C}-\x{1F}]"


def _strip(e: str) -> str:
    return f"regexp_replace(regexp_replace({e}, '^{_WS}+', ''), '{_WS}+$', '')"


_VALUE = _strip(f"translate(x, {_MASKS}, {_SEPS})")
_UNNUMBERED = _strip(rf"regexp_replace(y, '^\(?\d{{1,2}}[.)](\s|$)', '\1')")
_INNER = _strip("replace(substring(y, 2, length(y) - 2), '\"\"', '\"')")

SQL: dict[str, str] = {
    "p1_found": rf"""WITH e AS (SELECT * FROM lexicon_entries QUALIFY row_number() OVER (PARTITION BY entry_id ORDER BY loaded_at DESC NULLS LAST) = 1),
f AS (SELECT entry_id, 'french' AS field_name, french AS t FROM e UNION ALL SELECT entry_id, 'moore', moore FROM e UNION ALL SELECT entry_id, 'synonym', synonym FROM e),
s AS (SELECT *, regexp_matches(t, '^\s*\(?1[.)]\s') AS numbered, {_strip("t")} AS st FROM f WHERE t IS NOT NULL),
k AS (SELECT * FROM s WHERE NOT (regexp_matches(st, '[.!?…]["”»)]*$') AND regexp_matches(st, '^["“«(]*\s*\p{{Lu}}') AND len(regexp_split_to_array(st, '\s+')) >= 4)),
a AS (SELECT *, regexp_replace(array_to_string(list_transform(regexp_extract_all(t, '\([^()]*\)|[^()]+|[()]'), lambda p: CASE WHEN starts_with(p, '(') AND ends_with(p, ')') AND length(p) > 1 THEN translate(p, {_SEPS}, {_MASKS}) ELSE p END), ''),
  '(\d),(\d)', '\1' || chr(57600) || '\2', 'g') AS u FROM k),
b AS (SELECT *, array_to_string(list_transform(regexp_extract_all(u, '"(?:[^"]|"")*"|“[^”]*”|«[^»]*»|[^"“«]+|["“«]'), lambda p: CASE WHEN length(p) > 1 AND regexp_matches(p, '^["“«]') THEN translate(p, {_SEPS}, {_MASKS})
  WHEN numbered THEN regexp_replace(p, '\s+(\(?\d{{1,2}}[.)]\s)', chr(10) || '\1', 'g') ELSE p END), '') AS m FROM a),
c AS (SELECT *, regexp_split_to_array(regexp_replace(regexp_replace(regexp_replace(m, '([\s"”»)])/', '\1' || chr(10), 'g'), '^/', chr(10)), '/([\s"“«]|$)', chr(10) || '\1', 'g'), '[,;|•·\t\n]') AS parts FROM b),
d AS (SELECT entry_id, field_name, list_filter(list_transform(list_transform(list_transform(parts, lambda x: {_VALUE}), lambda y: CASE WHEN numbered THEN {_UNNUMBERED} ELSE y END),
  lambda y: CASE WHEN regexp_matches(y, '(?s)^"(?:[^"]|"")*"$') AND length(y) > 1 OR regexp_matches(y, '(?s)^“[^”]*”$|^«[^»]*»$') THEN {_INNER} ELSE y END),
  lambda y: y NOT IN ('', '-', '--', '—', '–', '?', 'n/a', 'N/A', 'null', 'None')) AS v FROM c)
SELECT entry_id, field_name, generate_subscripts(v, 1)::INTEGER AS item_no, unnest(v) AS item FROM d WHERE len(v) >= 2""",
}
