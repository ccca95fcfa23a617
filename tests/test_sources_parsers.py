import json

import pytest
from pyspark.sql import functions as F

from tandemtext.functions import quality
from tandemtext.operators import models, parsers, report
from tandemtext.plans import jobs, pipelines
from tandemtext.sources import readers, sinks
from tandemtext.streaming import annotators


def test_pairs_and_registry(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"french": " x ", "moore": "y"}\n\n{"french": "", "moore": "z"}\n', encoding="utf-8")
    df = readers.registry(spark, [("news", str(path)), ("gone", str(tmp_path / "no.jsonl"))])
    assert [(r.french, r.source, r.file_ord) for r in df.collect()] == [("x", "news", 0)]
    with pytest.raises(FileNotFoundError):
        readers.json_lines(spark, str(tmp_path / "no.jsonl"))


def test_bitext(spark, tmp_path):
    path = tmp_path / "b.tsv"
    path.write_text("a\tb\t0.0\tx\nonly\n", encoding="utf-8")
    rows = readers.bitext_table(spark, str(path)).collect()
    assert len(rows) == 1 and rows[0].eng_Latn == "a" and rows[0].laser_score is None and rows[0].source_sentence_lid is None and rows[0].target_sentence_url is None


def test_aligned_tree(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"french": ["a", "b"], "moore": ["x"], "english": []}), encoding="utf-8")
    rows = readers.aligned_records(spark, str(path), "kade").collect()
    assert [(r.french, r.moore, r.laser_score, r.source) for r in rows] == [("a", "x", 1.0, "kade")]


def test_articles(spark):
    html = '<h1>T <b>i</b></h1><div class="entry-content"><figure><p>no</p></figure><p>One <a href="u">two</a></p><p> </p></div><p>out</p><a href="/l"><img class="attachment-bam-featured x"></a>'
    df = spark.createDataFrame([("u1", html), ("u2", None)], "url string, html string")
    rows = {r.url: r for r in readers.articles(df).collect()}
    assert (rows["u1"].title, rows["u1"].text_units, rows["u1"].links) == ("T i", ["One two"], ["/l"])
    assert rows["u2"].title == "No Title"
    assert [r.url for r in readers.listed_links(df).collect()] == ["/l"]


def test_write_and_migrate(spark, tmp_path):
    df = spark.createDataFrame([("é", "m", 0.123456, None)], "french string, moore string, score double, english string")
    path = str(tmp_path / "out")
    sinks.write_json_lines(df, path)
    assert sinks.migrate_file(spark, path, dry_run=True) and sinks.migrate_file(spark, path) and not sinks.migrate_file(spark, path)
    row = spark.read.json(path).first()
    assert row.laser_score == 0.1235 and row.french == "é"
    sinks.write_pairs(df.withColumnRenamed("score", "laser_score").withColumn("source", F.lit("s")), str(tmp_path / "p"))
    assert spark.read.json(str(tmp_path / "p")).columns == ["french", "laser_score", "moore", "source"]
    sinks.write_configs(df.withColumn("source", F.lit("s")), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2
    assert sinks.output_paths(["a/x", "b/y"], "o") == ["o/x", "o/y"] and sinks.output_paths(["a"], None) == ["a"]


def test_page_texts_and_tables(spark):
    blocks = spark.createDataFrame([("d", 1, 1, "ﬁn"), ("d", 1, 0, "a"), ("d", 2, 0, "b"), ("d", 3, 0, "c")], "doc_id string, page int, block_no int, text string")
    assert readers.page_texts(blocks, 1, 2).first().text == "a\n\nfin\n\nb"
    cells = spark.createDataFrame([("d", 7, "strict", 0, 0, ["N", "T", "D"]), ("d", 7, "strict", 0, 1, ["1", "t", "d"])], "doc_id string, page int, setting string, table_no int, row_no int, cells array<string>")
    assert json.loads(sinks.table_dump(cells).first().value) == {"page": 7, "table_index": 0, "columns": ["N", "T", "D"], "rows": [["1", "t", "d"]]}
    assert [r.fr_term for r in readers.french_glossary_rows(cells).collect()] == ["T", "t"]


def test_dictionary_senses():
    raw = "tãnga [tã́-gá] 1) n Frncolline Enghill\n2) n Frntas de pierres Engheap of stones\n3) adj Frnhaut Enghigh"
    (entry,) = parsers.parse_dictionary(raw)
    assert (entry["lemma"], entry["ipa"], entry["pos"]) == ("tãnga", "tã́-gá", "n")
    assert [(s["french"], s["english"], s["pos"]) for s in entry["senses"]] == [("colline", "hill", "n"), ("tas de pierres", "heap of stones", "n"), ("haut", "high", "adj")]


def test_dictionary_stub_and_uncertain_tag():
    raw = "lobe [ló-bé] v\nFrnjeter loin Engthrow far\nsũ ri [sṹ] unspec. var. of sũure (unspec. var. of sũ)\n"
    entries = {e["lemma"]: e for e in parsers.parse_dictionary(raw)}
    assert entries["sũ ri"]["senses"] == [] and entries["sũ ri"]["variants"] == {"variant": ["sũure"]} and entries["sũ ri"]["pos"] == ""
    assert len(entries["lobe"]["senses"]) == 1 and "unspec" not in entries["lobe"]["senses"][0]["english"]
    (entry,) = parsers.parse_dictionary("yaa <Not Sure> Frnainsi Engthus")
    assert entry["pos"] == "<Not Sure>" and (entry["senses"][0]["french"], entry["senses"][0]["english"]) == ("ainsi", "thus")


def test_dictionary_furniture_and_letter_case():
    raw = "Dictionnaire Mooré -\nfrançais - English\nA a\n3 of 12\n1/2/2020 10:30\nfile:///c/x\n17\nbas- yaare n Frnmarché Engmarket Var: raa Syn: daaga (Catégorie : Lieu.)"
    (entry,) = parsers.parse_dictionary(raw)
    (sense,) = entry["senses"]
    assert entry["lemma"] == "bas-yaare" and entry["variants"] == {"variant": ["raa"]}
    assert (sense["french"], sense["english"], sense["synonym"], sense["category"]) == ("marché", "market", "daaga", "Lieu")


def test_dictionary_extras_and_examples():
    raw = "daga n Frnmarché Engmarket {e.g. A kẽnga daga} syn: raaga; (catégorie : lieu.)\nFrnIl va au marché Enghe goes to market syn: raaga"
    (entry,) = parsers.parse_dictionary(raw)
    sense = entry["senses"][0]
    assert sense["examples"] == [{"moore": "A kẽnga daga", "french": "Il va au marché", "english": "he goes to market"}]
    assert sense["synonym"] == "raaga" and sense["english"] == "market"


def test_columns_dictionary(spark):
    text = "baaga [báá] Nom. chien; dog. Variant: baa. A tara baaga. Il a un chien. He has a dog. biiga Nom. enfant; child."
    entries, failed = parsers.parse_columns_dictionary(text)
    assert [(e["lemma"], e["ipa"]) for e in entries] == [("baaga", "báá"), ("biiga", "")] and failed == 0
    assert entries[0]["variants"] == {"Variant": ["baa"]}
    assert entries[0]["senses"][0]["examples"] == [{"moore": "A tara baaga.", "french": "Il a un chien.", "english": "He has a dog."}]
    (entry,), _ = parsers.parse_columns_dictionary("tiiga Nom. arbre; tree. Category: Plante 1.2. Khaya senegalensis. Synonyme: ra. antonyme: rɩ.")
    (sense,) = entry["senses"]
    assert (sense["category"], sense["scientific_name"], sense["synonym"], sense["antonym"], sense["examples"]) == ("Plante 1.2", "Khaya senegalensis", "ra", "rɩ", [])
    (entry,), failed = parsers.parse_columns_dictionary("ko Verbe. cultiver. Une phrase seule.")
    assert failed == 1 and entry["senses"][0]["french"] == "cultiver" and entry["senses"][0]["examples"] == []
    (entry,), failed = parsers.parse_columns_dictionary("ko Verbe. 1• cultiver; farm. 2• bêcher; dig with a hoe. in the rain.")
    assert failed == 0 and [s["english"] for s in entry["senses"]] == ["farm.", "dig with a hoe. in the rain."]
    assert [sorted((parsers.sentence_triples("A. " * n) or [{}])[0].items()) for n in (0, 1, 7)] == [[], [], []]
    assert parsers.sentence_triples("A. B c. D. E f. G.") == [{"moore": "A.", "french": "B c. D.", "english": "E f. G."}]
    assert parsers.sentence_triples("A. B.") == [{"moore": "A.", "french": "B.", "english": None}]
    pages = spark.createDataFrame([("d", 1, text), ("d", 2, "ko Verbe.\ncultiver. Une\nphrase."), ("d", 3, None)], "doc_id string, page int, text string")
    found = parsers.columns_dictionary(pages)
    assert sorted((r.page, r.lemma, r.parse_status) for r in found.collect()) == [(1, "baaga", "ok"), (1, "biiga", "ok"), (2, "ko", "partial")]
    assert report.failures(found).first().asDict() == {"failed": 1, "total": 3}
    stats = report.dictionary_stats(found).first()
    assert (stats.entries, stats.senses, stats.examples, stats.with_variants, stats.with_ipa) == (3, 3, 1, 1, 1)


def test_manual():
    text = "avant\nChapitre 1 : Titre\nintro\nQuestions à discuter\n1. un\nsuite\n• puce\nlibre\nChapitre 2\n\nDeux\nfin\nAnnexe\nx"
    chapters = parsers.parse_manual(text, ["Questions à discuter"], stops=["Annexe"])
    assert [(c["number"], c["title"]) for c in chapters] == [(0, ""), (1, "Titre"), (2, "Deux")]
    section = chapters[1]["sections"][1]
    assert section["title"] == "Questions à discuter" and section["items"] == [{"num": 1, "text": "1. un suite • puce libre"}]
    assert section["bullet_items"] == [{"text": "puce libre"}] and section["body"] == "suite\nlibre"
    assert parsers.split_by_titles("x 1. Qui\nest là ? oui 2. Quoi ? non", ["1. Qui est là ?", "2. Quoi ?"]) == [(1, "1. Qui est là ?", "oui"), (2, "2. Quoi ?", "non")]
    assert parsers.is_subheading("Lisez Jean") and parsers.is_subheading("Quoi ?") and not parsers.is_subheading("Non")


def test_parsed_documents(spark):
    pages = spark.createDataFrame([("d", 2, "suite\nbala adv Frnseulement Engonly"), ("d", 1, "foo n Frnun Engone"), ("e", 1, None)], "doc_id string, page int, text string")
    rows = parsers.dictionary(pages).orderBy("doc_id", "place").collect()
    assert [(r.lemma, r.parse_status) for r in rows] == [("foo", "ok"), ("bala", "ok")]
    assert rows[0].senses[0].english == "one\nsuite"
    bad = parsers.parsed(pages, "doc_id", "text", lambda t: 1 / 0, parsers.ENTRY_SCHEMA).where("parse_status <> 'ok'")
    assert bad.count() == 2


def test_annotate_and_assemble(spark):
    a = spark.createDataFrame([("un", "x", "news", 1), ("un", "x", "news", 2), ("", "y", "news", 3)] + [(f"f{i}", f"m{i}", "news", 10 + i) for i in range(9)], "french string, moore string, source string, line_no int")
    b = spark.createDataFrame([("un", "x", "lexicon_entries", 1), ("lx", "ly", "lexicon_entries", 2)], "french string, moore string, source string, line_no int")
    corpus = pipelines.assemble([a, b], dev=3, test=3)
    counts = {(r.source, r.split): r["count"] for r in corpus.groupBy("source", "split").count().collect()}
    assert counts == {("news", "validation"): 3, ("news", "test"): 3, ("news", "train"): 4, ("lexicon_entries", "train"): 1}
    out = pipelines.annotate(a, warnings=True, len_ratio=True)
    assert {"quality_warnings", "len_ratio"} <= set(out.columns) and "identification_consistency" not in out.columns
    words = spark.createDataFrame([("xyz",)], "word string")
    marked = pipelines.annotate(spark.createDataFrame([(1, "a", "xyz abc")], "id int, french string, moore string"), warnings=True, consistency=True, foreign=words, key="id").first()
    assert marked.quality_warnings == ["foreign_words"] and marked.identification_consistency == 0.5
    with pytest.raises(ValueError):
        pipelines.annotate(a)


def test_flatten(spark):
    news = spark.createDataFrame([("u", (["Yaa sõma. Barka."], None))], "url string, segments struct<moore:array<string>,french:array<string>>")
    assert [(r.side, r.pos, r.sentence) for r in pipelines.flatten_news(news).collect()] == [("moore", 0, "Yaa sõma."), ("moore", 1, "Barka.")]
    assert pipelines.flatten_news(news, per_entry=True).count() == 0
    session = spark.createDataFrame([("d", "mos", [("T", ["a", "1."])], [("U", ["b"])])], "date string, src_lang string, src_sections array<struct<title:string,sentences:array<string>>>, tgt_sections array<struct<title:string,sentences:array<string>>>")
    assert sorted((r.side, r.sentence) for r in pipelines.flatten_sessions(session).collect()) == [("french", "U"), ("french", "b"), ("moore", "T"), ("moore", "a")]


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([("le 12", "x"), ("a", "😀")], "french string, moore string")
    df.write.json(str(tmp_path / "in"))
    query = annotators.write(annotators.annotated(annotators.stream_pairs(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(60)
    got = sorted(tuple(r.quality_warnings) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted(tuple(r.quality_warnings) for r in quality.annotate(df).collect())


def _lines(path):
    return [json.loads(x) for f in sorted(path.glob("*.json")) for x in f.read_text(encoding="utf-8").splitlines()]


def test_commands_from_pages_to_pairs(spark, tmp_path):
    pages = [{"doc_id": "d", "page": 1, "text": "tãnga n Frncolline Enghill"}, {"doc_id": "d", "page": 2, "text": "moogo n Frnmonde Engworld"}]
    (tmp_path / "pages.json").write_text("\n".join(map(json.dumps, pages)), encoding="utf-8")
    assert pipelines.main(["parse", str(tmp_path / "pages.json"), "--kind", "dictionary", "--output", str(tmp_path / "parsed")]) == 0
    assert [r["lemma"] for r in _lines(tmp_path / "parsed")] == ["tãnga", "moogo"]
    assert pipelines.main(["flatten", str(tmp_path / "parsed"), "--kind", "entries", "--output", str(tmp_path / "flat")]) == 0
    assert sorted((r["french"], r["moore"], r["kind"]) for r in _lines(tmp_path / "flat")) == [("colline", "tãnga", "entry"), ("monde", "moogo", "entry")]
    documents = [{"doc_id": "x", "french": ["Kadiogo 12", "Zéba 1987", " "], "moore": ["Kadiogo 12", "Zéba 1987"]}, {"doc_id": "y", "french": ["Seul"], "moore": []}]
    (tmp_path / "docs.json").write_text("\n".join(map(json.dumps, documents)), encoding="utf-8")
    assert pipelines.main(["align", str(tmp_path / "docs.json"), "--least", "0.9", "--output", str(tmp_path / "aligned")]) == 0
    assert sorted((r["french_pos"], r["moore_pos"]) for r in _lines(tmp_path / "aligned")) == [(0, 0), (1, 1)]
    assert pipelines.main(["e2e", str(tmp_path / "docs.json"), "--least", "0.9", "--embed", "tandemtext.plans.jobs:hashed_embedder", "--output", str(tmp_path / "done")]) == 0
    assert sorted((r["french"], r["quality_warnings"], r["len_ratio"]) for r in _lines(tmp_path / "done")) == [("Kadiogo 12", [], 1.0), ("Zéba 1987", [], 1.0)]
    for name, rows in (("a", [("un", "x"), ("un", "x"), ("", "y")]), ("b", [("un", "x"), ("deux", "z")])):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps({"french": f, "moore": m}) for f, m in rows), encoding="utf-8")
    assert pipelines.main(["assemble", f"news={tmp_path / 'a.jsonl'}", f"web={tmp_path / 'b.jsonl'}", "--output", str(tmp_path / "corpus")]) == 0
    corpus = [r for f in {x.parent for x in (tmp_path / "corpus").rglob("*.parquet")} for r in spark.read.parquet(str(f)).collect()]
    assert sorted((r.french, r.source) for r in corpus) == [("deux", "web"), ("un", "news")]


def test_manual_pair_and_book(spark):
    chapters = parsers.parse_manual("Chapitre 1 : Le début\nQuestions\n1. Où va Kadé ? (p. 3)\n2. 12\n3. voir www.x.org\nChapitre 2 : Fin\nTexte. Encore.", ["Questions"])
    french = spark.createDataFrame(chapters, jobs.MANUAL_SCHEMA)
    rows = jobs.flatten_manual_pair(french, french, {"Kadé": "Poko"}).orderBy("side", "block", "chapter", "section", "place", "pos").collect()
    told = {side: [r.sentence for r in rows if r.side == side] for side in ("french", "moore")}
    assert told["french"][:2] == ["Le début", "Questions"] and "Où va Poko?" in told["french"] and "Où va Kadé ?" in told["moore"]
    assert told["french"][-2:] == ["Texte.", "Encore."] and not any("www" in s for s in told["french"])
    page = "page_number int, french_text string, moore_text string"
    book = spark.createDataFrame([(1, "Titre", "Gom", [(38, "Un.", "Ye."), (39, "Deux.", "Yi.")], [])], f"chapter_number int, title_french string, title_moore string, pages array<struct<{page}>>, enums array<struct<french_title:string,french_text:string,moore_title:string,moore_text:string>>".replace("page_number int, french_text string, moore_text string", "page_number:int,french_text:string,moore_text:string"))
    count = lambda df: df.where("block = 1 and side = 'french'").count()
    assert count(pipelines.flatten_book(book)) == 2 and count(pipelines.flatten_book(book, before=jobs.LAST_PAGE)) == 1


def test_identifier_in_the_jvm(spark):
    rows = [(t, lang) for lang, texts in (("fra", ["le chien du village", "la maison est belle", "il mange le pain"]), ("mos", ["biig wã yãa baagã", "a kẽnga daagẽ wã", "sɩngr wã yaa sõma"])) for t in texts]
    model = models.naive_bayes(spark.createDataFrame(rows, "text string, lang string"), "text", "lang")
    out = models.identified_by(model, spark.createDataFrame([("le pain du chien",), ("baagã wã yaa",), (None,)], "french string"), "french").collect()
    assert [r.french_glotlid_lang for r in out][:2] == ["fra", "mos"] and all(0 < r.french_glotlid_prob <= 1 for r in out)


def test_three_word_lists(spark):
    words = lambda *w: spark.createDataFrame([(x,) for x in w], "word string")
    lists = jobs.foreign_lists({"fr": words("chat", "wa", "sel"), "en": words("cat")}, words("wa", "biiga"), words("sel"))
    assert {k: [r.word for r in df.collect()] for k, df in lists.items()} == {"foreign": ["cat", "chat", "sel"], "foreign_strict": ["cat", "chat"], "native": ["biiga", "wa"]}
