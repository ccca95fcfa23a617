import pytest
from pyspark.sql import functions as F

from tandemtext.functions import quality as Q
from tandemtext.functions import text as T

C = F.col("t")


@pytest.mark.parametrize(
    "function, given, expected",
    [
        (T.join_lines, "hello\n\n\nworld", "hello world"),
        (T.join_lines, "smartphones.Les causes ne sont pas connues.", "smartphones. Les causes ne sont pas connues."),
        (T.join_lines, "BURKINA.F.A.S.O.", "BURKINA.F.A.S.O."),
        (T.join_lines, "E.AU TITRE DU MINISTERE", "E.AU TITRE DU MINISTERE"),
        (T.join_lines, "Il dit.«Bonjour»", "Il dit.«Bonjour»"),
        (T.join_lines, "fin.Écoles fermées.", "fin. Écoles fermées."),
        (T.normalize_french, "“Bonjour”", '"Bonjour"'),
        (T.normalize_french, "Bonjour !", "Bonjour!"),
        (T.normalize_french, "« Bonjour »", "«Bonjour»"),
        (T.normalize_french, "Oui\n! « Non »", "Oui\n! «Non»"),
        (T.typeset_french, "a-t-\nil dit-\nelle e\u0301te\u0301", "a-t-il dit-elle été"),
        (T.drop_page_references, "(Yamamori p.70) some text", " some text"),
        (T.drop_page_references, "(top.70)", "(top.70)"),
        (T.plain_forms, "l’un… – “x”", "l'un... - \"x\""),
        (T.expand_ligatures, "ﬁnal ﬂot", "final flot"),
        (T.fix_hyphens, "a- b a -b", "a-b a-b"),
        (T.strip, "  \t x　", "x"),
        (T.clean_cell, None, ""),
        (T.fold_key, " École Ã̃ ", "ecole a"),
        (T.enum_number, "12. Quoi", 12),
        (T.enum_number, "Quoi", None),
        (T.page_numbers, "a\n 12 \nb 3", [12]),
        (T.language_label, "__label__mos_Latn", "mos_Latn"),
        (T.nfc, "é", "é"),
        (T.typeset_moore, "wẽn-\nnaam", "wẽnnaam"),
        (T.one_line, "a \n b", "a b"),
        (T.scrub_page, "x\n12\n-\nfile:///a/b y", "x\ny"),
        (T.tokens, "Yaa sõama, COVID-19", ["yaa", "sõama", "covid", "19"]),
    ],
)
def test_text(one, function, given, expected):
    assert one(function(C), "t string", given) == expected


@pytest.mark.parametrize("text, expected", [("44", True), ("14–24", True), ("27, 2.", True), ("1, 2, 3", True), ("chapitre 3 de la Bible", False)])
def test_standalone_numbers(one, text, expected):
    assert one(T.is_standalone_number(C), "t string", text) is expected


def test_variant_stub_and_tail(one):
    assert "Frn (unspec. var. of wãbe) Eng" in one(T.rewrite_variant_stub(C), "t string", "ãbe [ã̀] unspec. var. of wãbe")
    assert one(T.strip_entry_name(C, F.lit("lemma")), "t string", "body\nlemma") == "body"
    repaired = one(T.repair_token(C), "t string", "gẽ[é]")
    assert (repaired["token"], repaired["tone"]) == ("gẽ", "[é]")
    assert T.loose_pattern("a b") == r"a[\s-]+b"


@pytest.mark.parametrize("a, b, ratio", [("ab", "abcd", 0.5), ("abcd", "ab", 0.5), ("abc", "abcdefg", 0.4286), ("", "abc", 0.0), ("a", "b" * 32, 0.0312), (None, "a", 0.0)])
def test_length_ratio(one, a, b, ratio):
    assert one(T.length_ratio(F.col("a"), F.col("b")), "a string, b string", a, b) == ratio


@pytest.mark.parametrize(
    "check, a, b, expected",
    [
        (lambda a, b: Q.has_emoji(b), "", "Hi 😀", True),
        (lambda a, b: Q.has_emoji(b), "", "● x", True),
        (lambda a, b: Q.has_emoji(b), "", "plain", False),
        (Q.number_mismatch, "le 12", "x", True),
        (Q.number_mismatch, "le 12", "le 13", True),
        (Q.number_mismatch, "le 12 et 7", "le 12", False),
        (Q.number_mismatch, "x", "y", False),
        (Q.parenthesis_asymmetry, "a (bc)", "x", True),
        (Q.parenthesis_asymmetry, "x", "a (bc)", False),
        (Q.parenthesis_asymmetry, "(a)", "x", False),
        (Q.bullet_asymmetry, "• a", "b", True),
        (Q.bullet_asymmetry, "- a", "b", False),
        (Q.dots_asymmetry, "fin..", "fin", True),
        (Q.dots_asymmetry, "fin…", "fin", False),
        (Q.dots_asymmetry, None, None, False),
    ],
)
def test_detectors(one, check, a, b, expected):
    assert one(check(F.col("a"), F.col("b")), "a string, b string", a, b) is expected


@pytest.mark.parametrize("a, b, score", [("A.", "B.", 0.0), ("A...", "B", -1.7918), ("A. B. C. D.", "E", -2.0794)])
def test_terminal_score(one, a, b, score):
    assert round(one(Q.terminal_score(F.col("a"), F.col("b")), "a string, b string", a, b), 4) == score


def test_consistency_both_ways(spark, one):
    foreign = F.array(F.lit("comment"), F.lit("game"))
    assert one(Q.consistency(C, foreign), "t string", "Yaa sõama comment game") == 0.5
    assert one(Q.consistency(C, foreign), "t string", "a bc de") == 0.0
    df = spark.createDataFrame([(1, "Yaa sõama comment game"), (2, "a bc de"), (3, None), (4, "yaa sõama")], "id int, t string")
    words = spark.createDataFrame([("comment",), ("game",), ("game",), (None,)], "word string")
    rows = {r.id: (r.identification_consistency, r.foreign_words) for r in Q.with_consistency(df, "t", words, "id").collect()}
    assert rows == {1: (0.5, True), 2: (0.0, False), 3: (0.0, False), 4: (1.0, False)}


def test_warning_order(one):
    found = one(Q.warnings(F.col("a"), F.col("b")), "a string, b string", "A. B. C. D. (xx) 12..", "😀 ")
    assert found == ["emoji", "dots_asymmetry", "number_mismatch", "parenthesis_asymmetry", "terminal_punctuation"]
