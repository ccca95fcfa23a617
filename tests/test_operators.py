import numpy as np
import pytest
from pyspark.sql import functions as F

from tandemtext.operators import ranges, columns, dedup, filters, joins, lexicon, lines, models, packed, report, segment, split, wordlists
from tandemtext.queries import documents, folds
from tandemtext.session import latest

C = F.col("t")


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, []),
        ("", []),
        (" - ", []),
        ("chien", ["chien"]),
        ("marché,", ["marché"]),
        ("a, b;c | d · e\tf\ng", ["a", "b", "c", "d", "e", "f", "g"]),
        ("sous-sol, sous-sol", ["sous-sol", "sous-sol"]),
        ("1,5 litre;  eau", ["1,5 litre", "eau"]),
        ("aimer, « la police; cour »,  nommer", ["aimer", "la police; cour", "nommer"]),
        ('"sous-sol ""stade""" ; vélo', ['sous-sol "stade"', "vélo"]),
        ("porte-parole (la poule sèche, sous-sol)", ["porte-parole (la poule sèche, sous-sol)"]),
        ("1) la cour (graine, le karité) 2) \"père, sel\"", ["la cour (graine, le karité)", "père, sel"]),
        ("(1) x\n(2) y", ["x", "y"]),
        ("1. garder, 2. «sel, puits»", ["garder", "sel, puits"]),
        ("1) tãbo; 2) pɛla (a; b); 3) x", ["tãbo", "pɛla (a; b)", "x"]),
        ("• grenier •femme", ["grenier", "femme"]),
        ("nommer et/ou", ["nommer et/ou"]),
        ("a / b/ c", ["a", "b", "c"]),
        ('la "grande", x', ['la "grande"', "x"]),
        ('stray " mark, x', ['stray " mark', "x"]),
        ("Le 9 avril 1998, le cheval a pris l'usine, mais il part.", []),
        ("x, " * 3000 + "y", ["x"] * 3000 + ["y"]),
    ],
)
def test_packed_values(one, text, expected):
    assert one(packed.split_values(C), "t string", text) == expected


def test_unpack_keeps_places_and_ignores_extra_columns(spark):
    df = spark.createDataFrame([(1, "a, b", None, "x", 5)], "id int, french string, moore string, item string, pos int")
    rows = packed.unpack_fields(df, "id", ["french", "moore"], keep=2).collect()
    assert [tuple(r) for r in rows] == [(1, "french", 1, "a"), (1, "french", 2, "b")]
    assert packed.unpack_fields(df.limit(0), "id", ["french"]).count() == 0


def test_latest_row(spark):
    df = spark.createDataFrame([(1, "old", "2020-01-01"), (1, "new", "2021-01-01"), (2, "x", None), (2, "x", None)], "id int, v string, at string").withColumn("loaded_at", F.to_timestamp("at"))
    assert sorted((r.id, r.v) for r in latest(df, "id").collect()) == [(1, "new"), (2, "x")]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Un. Deux! «Trois.» Quatre; cinq «a; b» six", ["Un.", "Deux!", "«Trois.»", "Quatre", "cinq «a; b» six"]),
        ("A. . B", ["A.", ".", "B"]),
        (None, []),
        ("  ", []),
    ],
)
def test_split_sentences(one, text, expected):
    assert one(segment.split_sentences(C), "t string", text) == expected


def test_merge_quotes(one):
    got = one(segment.merge_quotes(F.col("a")), "a array<string>", ["«a.", "b»", 'c "d.', 'e" f.', "»", "g"])
    assert got == ["«a. b»", 'c "d. e" f. »', "g"]
    assert one(segment.segment(C), "t string", "Il est parti. Elle est restée.") == ["Il est parti.", "Elle est restée."]
    assert one(segment.segment(C), "t string", "") == []
    assert one(segment.merge_quotes(F.col("a")), "a array<string>", ["Oui", "».", "Non"]) == ["Oui", "».", "Non"]
    assert one(segment.segment(C), "t string", "M. Dupont est venu. Voir p. 12 et J. Zongo. Il dort.") == ["M. Dupont est venu.", "Voir p. 12 et J. Zongo.", "Il dort."]


@pytest.mark.parametrize(
    "units, langs, moore, french",
    [
        (["m1", "Kibarã yii", "f1"], None, ["m1", "Kibarã yii"], ["f1"]),
        (["a", "b"], ["mos_Latn", "fra_Latn"], ["a"], ["b"]),
        (["a", "b"], ["fra_Latn", "fra_Latn"], None, ["a", "b"]),
        (["a"], None, ["a"], None),
    ],
)
def test_language_boundary(one, units, langs, moore, french):
    got = one(segment.language_boundary(F.col("u"), F.col("l")), "u array<string>, l array<string>", units, langs)
    assert (got["moore"], got["french"]) == (moore, french)


def test_synonyms_and_proverbs(spark, one):
    df = spark.createDataFrame([("quietly, peacefully; calm", "x", "a, b"), ("f", "x, y", "e"), ("p, q", "m, n", "e"), (None, None, None)], "french string, moore string, english string")
    rows = [(r.french, r.english, r.synonym_no) for r in lexicon.explode_synonyms(df).collect()]
    assert rows == [("quietly", "a", 1), ("peacefully", "b", 2), ("calm", "b", 3), ("f", "e", None), ("p, q", "e", None), (None, None, None)]
    for text, expected in [
        ("Il faut épargner. Proverbe: on doit", "Il faut épargner."),
        ("Le chien aboie (Proverbe: rien)", "Le chien aboie"),
        ("Proverbe : Qui dort dîne.", "Qui dort dîne."),
        ("écoute les proverbes»", "écoute les proverbes»"),
    ]:
        assert one(lexicon.strip_proverb(C), "t string", text) == expected
    with pytest.raises(ValueError):
        lexicon.clean_lexicon(df, False, False)


def test_nan_fails_filters(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, "mos_Latn"), (0.95, "mos_Latn"), (None, "mos_Latn")], "score double, lang string")
    for check in (filters.at_least("score", 0.6), filters.at_least_or_zero("score", 0.6), filters.identified("score", "lang", "mos_Latn", 0.6), filters.language_gate("score", "score", "lang")):
        assert [r.score for r in df.where(check).collect()] == [0.95]
    assert df.where(filters.at_least_or_null("score", 0.6)).count() == 3


def test_folds_in_ranges_against_brute_force(spark):
    random = np.random.default_rng(2)
    rows = [(None if k % 7 == 0 else "ab"[k % 2], k, int(random.integers(0, 9)), None if random.random() < 0.4 else float(random.integers(0, 20))) for k in range(200)]
    df = spark.createDataFrame(rows, "s string, k int, n int, v double")
    got = {r.k: r.offset for r in lines.running_offset(df, "s", "k", "n").collect()}
    assert got == {k: sum(n2 for s2, k2, n2, _ in rows if s2 == s and k2 < k) for s, k, _, _ in rows}
    assert {r.k: r.offset for r in lines.running_offset(df, None, "k", "n").collect()} == {k: sum(r[2] for r in rows[:k]) for k in range(200)}
    got = {r.k: r.w for r in lines.carry_value(df, "s", "k", F.col("v"), F.col("v") > 3, "w").collect()}
    assert got == {k: next((v2 for s2, k2, _, v2 in reversed(rows[:k]) if s2 == s and v2 is not None and v2 > 3), None) for s, k, _, _ in rows}
    for a, b in [(None, None), (3, 10), (-5, None), (2, -2), (150, -80), (0, 0)]:
        assert [r.k for r in split.row_slice(df, ["k"], a, b).orderBy("k").collect()] == [r[1] for r in rows[a:b]]
    exact = {(r.s, r.share): r.value for r in ranges.quantiles(df, "v", [0.0, 0.25, 0.5, 0.99, 1.0], ["s"]).collect()}
    for (s, share), value in exact.items():
        assert abs(value - np.quantile([v for s2, _, _, v in rows if s2 == s and v is not None], share)) < 1e-9
    assert len(exact) == 15 and ranges.quantiles(df.limit(0), "v", [0.5]).count() == 0


def test_null_rules_of_filters(spark):
    df = spark.createDataFrame([(0.1,), (0.1001,), (None,)], "len_ratio double")
    assert [r[0] for r in df.where(filters.at_least_or_null("len_ratio", 0.1, strict=True)).collect()] == [0.1001, None]
    assert df.where(filters.at_least("len_ratio", 0.1)).count() == 2
    assert df.where(filters.at_least_or_zero("len_ratio", 0.0)).count() == 3
    assert df.where(filters.at_least_or_zero("len_ratio", 0.1)).count() == 2
    stages = {"a": filters.at_least("len_ratio", 0.05), "b": filters.at_least("len_ratio", 0.1001)}
    assert {r.stage: r.dropped for r in filters.cascade_counts(df, stages).collect()} == {"a": 1, "b": 1, "kept": 1}
    scored = filters.gate_then_score(df, F.col("len_ratio") > 0.1, lambda d: d.withColumn("s", F.lit(1.0)), "s")
    assert sorted((r.len_ratio is None, r.s) for r in scored.collect() if r.s) == [(False, 1.0)]


def test_glossary_lookup(spark):
    probe = spark.createDataFrame([(1, "ADSL", "ADSL"), (2, "Communicatio ns électroniques", "x"), (3, "rien", "x"), (4, None, None)], "id int, term string, text string")
    build = spark.createDataFrame([(1, "Asymetric Digital Subscriber Line (ADSL)", "d1"), (2, "Communications électroniques", "d2"), (3, "communications electroniques", "d3")], "ord int, fr string, definition string")
    a, b = joins.term_keys(F.col("term"), F.col("text")), joins.term_keys(F.col("fr"), F.col("fr"))
    inside = F.regexp_extract(F.col("fr"), r"\(([^)]*)\)", 1)
    passes = [(a[0], b[0]), (a[0], joins.fold_key(inside)), (a[2], b[2])]
    rows = {r.id: (r.definition, r.match_pass) for r in joins.prioritised_lookup(probe, build, passes, ["definition"], "ord").collect()}
    assert rows == {1: ("d1", 2), 2: ("d3", 3)}


def test_glossary_lookup_probes_every_source(spark, tmp_path):
    probe = [(1, "Sel", "lexicon_entries", 1), (2, "sel", " Lexicon_Entries ", 1), (3, "SÉL ", "digital-terms", 1), (4, "sel", None, 1), (5, None, "web", 1), (6, "rien", "web", 1), (7, "sel", "web", 1), (7, "rien", "web", 2)]
    spark.createDataFrame(probe, "pair_id bigint, french string, source string, loaded_at int").write.parquet(f"{tmp_path}/fr_mos_combined.parquet")
    spark.createDataFrame([(1, "sel", "yamsem", 1)], "entry_id bigint, french string, moore string, loaded_at int").write.parquet(f"{tmp_path}/lexicon_entries.parquet")
    assert sorted(r.pair_id for r in documents.glossary_lookup(spark, str(tmp_path)).collect()) == [1, 2, 3, 4]


def test_zip_and_equal_lengths(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x"])], "id int, f array<string>, m array<string>")
    assert joins.zip_places(df, ["f", "m"], "id").count() == 1
    assert joins.zip_places(df, ["f", "m"], "id", shortest=False).count() == 2
    with pytest.raises(Exception, match="different lengths"):
        joins.equal_lengths(df, ["f", "m"]).collect()


def test_dtw_properties(spark):
    random = np.random.default_rng(1)
    for n, m in [(1, 1), (1, 5), (6, 3), (7, 7)]:
        path = joins.dtw_path(random.random((n, m)))
        assert path[0] == (0, 0) and path[-1] == (n - 1, m - 1)
        assert all((c - a, d - b) in {(1, 0), (0, 1), (1, 1)} for (a, b), (c, d) in zip(path, path[1:]))
    vectors = [[float(i == j) for j in range(4)] for i in range(4)]
    df = spark.createDataFrame([("d", i, v) for i, v in enumerate(vectors)], "doc string, pos int, vec array<double>")
    rows = joins.sequence_join(df, df, "doc", "pos", "vec").collect()
    assert sorted((r.pos_a, r.pos_b) for r in rows) == [(i, i) for i in range(4)]
    assert joins.sequence_join(df, df.limit(0), "doc", "pos", "vec").count() == 0


def test_words_joins(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"]), (3, [])], "id int, w array<string>")
    listed = spark.createDataFrame([("a",), ("a",)], "word string")
    assert [r.id for r in joins.semi_words(df, F.col("w"), listed, "id").collect()] == [1]
    assert {r.id: r.unlisted for r in joins.unlisted_count(df, F.col("w"), listed, "id").collect()} == {1: 1, 2: 1, 3: 0}
    assert joins.substitute_names(F.lit("x"), {"Kadé": "Poko"}) is not None


def test_names_are_replaced_at_once(one):
    assert one(joins.substitute_names(C, {"A": "B", "B": "C"}), "t string", "A B AB") == "B C AB"


def test_names_in_running_texts(spark, tmp_path):
    rows = [(1, "À Nubo, Nubogo et l'Dagén : Loyougo (Nubo).", "Suwa-Zima Suwã xSuwa"), (2, None, "")]
    spark.createDataFrame(rows, "pair_id bigint, french string, moore string").write.parquet(f"{tmp_path}/fr_mos_combined.parquet")
    got = sorted(tuple(r) for r in folds.names_in_texts(spark, str(tmp_path)).collect())
    assert got == [(1, "À Loyougo, Nubogo et l'Tékuba : Nubo (Loyougo).", "Zima-Ridi Suwã xSuwa"), (2, None, "")]


def test_components_against_union_find(spark):
    df = spark.createDataFrame([(1, "A", "p", 0.2), (2, "A", "q", 0.9), (3, "B", "q", 0.5), (4, "C", "r", None), (5, None, "p", 0.1), (6, "Z", None, 0.3)], "id int, s string, m string, q double")
    got = {r.id: r.component for r in dedup.components(df, "id", ["s", "m"]).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1, 6: 6}
    assert sorted(r.id for r in dedup.keep_best(df, "id", ["s", "m"], "q").collect()) == [2, 4, 6]
    chain = spark.createDataFrame([(i, f"s{i // 2}", f"m{(i + 1) // 2}") for i in range(60)], "id int, s string, m string")
    assert {r.component for r in dedup.components(chain, "id", ["s", "m"]).collect()} == {0}
    assert dedup.components(df.limit(0), "id", ["s", "m"]).count() == 0
    assert sorted(r.id for r in dedup.repeated(df, ["s", "m"]).collect()) == [1, 2, 3, 5]


def test_stratified_split(spark):
    rows = [(s, f"{s}{i}") for s, n in (("a", 100), ("b", 10), ("c", 2), ("d", 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "source string, k string")
    got = split.stratified_split(df, "source", ["k"], 20, 20)
    counts = {(r.source, r.split): r.n for r in got.groupBy("source", "split").agg(F.count("*").alias("n")).collect()}
    assert counts == {("a", "validation"): 17, ("a", "test"): 17, ("a", "train"): 66, ("b", "validation"): 2, ("b", "test"): 2, ("b", "train"): 6, ("c", "train"): 2, ("d", "validation"): 1, ("d", "test"): 1, ("d", "train"): 1}
    assert [r.k for r in split.row_slice(df, ["k"], -2, None).collect()] == sorted(k for _, k in rows)[-2:]


def test_reports(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", 0.4), ("a", 0.9), ("a", None), ("b", float("nan"))], "s string, v double")
    row = report.score_stats(df, "v", "s").collect()
    assert len(row) == 1 and round(row[0]["median"], 4) == 0.3
    assert {r.bin: r.n for r in report.histogram(df, "v", 4).collect()} == {0: 2, 1: 1, 3: 1}
    chapters = spark.createDataFrame([(1, 0, 2), (1, 1, 2), (1, 2, 1), (2, 3, 1)], "num int, ord int, size int")
    assert sorted((r.num, r.ord, r.place) for r in report.replace_if_larger(chapters, "num", "ord", "size").collect()) == [(1, 1, 0), (2, 3, 3)]


def test_word_sets(spark):
    f = spark.createDataFrame([("a",), ("b",), ("c",)], "word string")
    m = spark.createDataFrame([("b",)], "word string")
    assert [r.word for r in wordlists.foreign_words([f], [m]).collect()] == ["a", "c"]
    assert wordlists.foreign_words([], [m], spark).count() == 0
    assert tuple(wordlists.overlap_sizes(f, m).first()) == (3, 1, 1, 2, 0)
    lex = spark.createDataFrame([("-Bãga [tone] ..x @y .daga",)], "t string")
    assert sorted(r.word for r in wordlists.lexicon_words(lex, "t").collect()) == ["bãga", "daga"]


def test_lines(spark):
    df = spark.createDataFrame([("d", "pre\n(Ayo) 2. First line of item\ncontinuation of item\n3. next\nSTOP\nx")], "doc string, text string")
    ln = lines.lines_of(df, "doc", "text")
    items = {r.num: r.text for r in lines.numbered_items(lines.until_stop(ln, "doc", "line_no", F.col("line") == "STOP"), "doc", "line_no").collect()}
    assert items == {2: "(Ayo) 2. First line of item continuation of item", 3: "3. next"}
    pages = spark.createDataFrame([("d", 1, "un mot cou-"), ("d", 2, "pé ici"), ("d", 3, "fin")], "doc string, page int, text string")
    assert [r.text for r in lines.join_broken_pages(pages, "doc", "page", "text").orderBy("page").collect()] == ["un mot coupé", "ici", "fin"]
    assert [r.chapter_no for r in lines.range_of(pages, "page", [(1, 2), (2, 3)]).orderBy("page").collect()] == [1, 2]
    blocks = spark.createDataFrame([("d", 1, 0, 300.0, 600.0, "R"), ("d", 1, 1, 10.0, 600.0, "L"), ("d", 1, 2, 10.0, 600.0, " 7 ")], "doc_id string, page int, block_no int, x0 double, page_width double, text string")
    assert lines.columns_of_page(blocks, ["doc_id", "page"]).first().text == "L\n\nR"
    rules = spark.createDataFrame([("d", 1, 250.0, 250.4, 500.0), ("d", 1, 30.0, 30.0, 50.0)], "doc_id string, page int, x0 double, x1 double, height double")
    assert {r.block_no: r.side for r in lines.split_at_separator(blocks, rules, ["doc_id", "page"]).collect()} == {0: "right", 1: "left", 2: "left"}


def test_columns(spark):
    df = spark.createDataFrame([("x", 0.12345, None)], "french string, score double, english string")
    out = columns.migrate_score(df)
    assert out.columns == ["french", "english", "laser_score"] and out.first().laser_score in (0.1234, 0.1235)
    assert columns.needs_migration(df) and not columns.needs_migration(out)
    assert columns.drop_all_null(df, ["english", "score"]).columns == ["french", "score"]
    with pytest.raises(ValueError, match="there are french"):
        columns.require(df, "moore")
    assert columns.score_column("laser", "fra_Latn", "mos_Latn") == "laser_fra_mos"


def test_models(spark):
    df = spark.createDataFrame([(1, "aa", "x"), (2, "bb", "x"), (3, "cc", "z"), (4, None, "y")], "id int, french string, moore string")
    lid = lambda: lambda texts: [("__label__mos_Latn" if "a" in t else "fra_Latn", 0.98765) for t in texts]
    rows = {r.id: (r.french_glotlid_lang, r.french_glotlid_prob) for r in models.identified(df, "french", lid).collect()}
    assert rows[1] == ("mos_Latn", 0.9876) or rows[1] == ("mos_Latn", 0.9877)
    estimate = lambda: lambda a, b: [float(len(x)) + (x == "bb") for x in a]
    best = models.deduplicated(df, "id", "french", "moore", estimate)
    assert sorted((r.id, r.comet_qe) for r in best.collect()) == [(2, 3.0), (3, None), (4, None)]
    embed = lambda: lambda texts: np.array([[len(t) or 1.0, 1.0] for t in texts])
    assert models.embedding_score(df, "french", "moore", embed, embed).where("laser_score > 0").count() == 4

    def translate():
        def model(texts):
            if texts == ["bb"]:
                raise OSError
            return [t.upper() for t in texts]

        return model

    assert [r.e for r in models.translated(df, "french", translate, "e").orderBy("id").collect()] == ["AA", "", "CC", ""]
