"""Small cases of the operators for training data: brute force, round trips, held-out accuracy, odd inputs."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tandemtext.llm import bitext, cutoffs, langid, leaks, overlaps, reading, scans, sentences, tokenize
from tandemtext.llm.text import words
from tandemtext.session import latest, table

WORDS = [f"{a}{b}{c}" for a in "bdkt" for b in "aeiou" for c in ("lo", "mi", "ra", "su")]


# --- encoding -------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    return tokenize.load_ranks()


TEXTS = ["", " ", "a  b", "  x", " \n b", "a \nb", "x  \nb", "  y", "  ", "\t \t z", "é" * 999, "ab" * 4000, "<|endoftext|> x", "a'll 'll s's", "1 234,5 km", "日本語 ａ", "🙂🙂 x\r\n"]


def test_ids_equal_the_public_encoder(ranks):
    tiktoken = pytest.importorskip("tiktoken")
    encoder = tiktoken.Encoding("own", pat_str=tokenize.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("ab é\n\t 1,.'’ʋẽZ") for _ in range(rng.randrange(60))) for _ in range(400)]
    memo = tokenize.Chunks(ranks)
    for text in texts:
        ids = tokenize.encode(text, memo)
        assert ids == (encoder.encode_ordinary(text) if text else [])
        assert encoder.decode(ids) == text


def test_token_ids_rows(spark):
    df = spark.createDataFrame([(1, "Yaa sõama", "x"), (1, "Yaa sõama", "y"), (2, None, "z"), (None, "", "z")], "doc_id bigint, text string, ids string")
    rows = sorted(((r.doc_id or 0), r.ids) for r in tokenize.token_ids(spark, df).collect())
    assert rows[0] == (0, []) and rows[1] == rows[2] and rows[3] == (2, []) and rows[1][1]
    assert tokenize.token_ids(spark, df.limit(0)).count() == 0


# --- cutoffs --------------------------------------------------------------------------------------------------------


def test_cutoffs_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["News", " news", "kade", None]), rng.choice([None, float("nan"), -0.0, 0.0, -0.1, 0.5, 0.5, 0.51, rng.random(), 7.0])) for i in range(600)]
    records = spark.createDataFrame(rows, "pair_id bigint, source string, laser_score double")
    goals = [("news", "laser_score", 33), ("news", "laser_score", 33), ("kade", "laser_score", 100), ("kade", "laser_score", 1), ("gone", "laser_score", 50)]
    targets = spark.createDataFrame(goals, "source string, score_name string, keep_pct int")
    got = {(r.source, r.keep_pct): (r.cutoff, r.kept, r.total) for r in cutoffs.cutoffs(records, targets, ["laser_score"]).collect()}
    expected = {}
    for source, _, share in goals:
        own = sorted((s for _, n, s in rows if n and n.strip().lower() == source and s is not None and s == s), reverse=True)
        for s in own:
            kept = sum(x >= s for x in own)
            if kept * 100 >= share * len(own):
                expected[source, share] = (s, kept, len(own))
                break
    assert got == expected
    kept = cutoffs.kept_records(records, targets, ["laser_score"])
    assert kept.groupBy("source", "keep_pct").count().count() == 3
    assert cutoffs.cutoffs(records.limit(0), targets, ["laser_score"]).count() == 0


# --- sentences ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, []),
        (" \n ", []),
        ("Le sac de M. Toga est là. Il part.", ["Le sac de M. Toga est là.", "Il part."]),
        ("Il coûte 2.5 kg env. 30 fois. Fin", ["Il coûte 2.5 kg env. 30 fois.", "Fin"]),
        ("A a dit : « Viens ! Pars. » Le chat dort.", ["A a dit : « Viens ! Pars. »", "Le chat dort."]),
        ("« Viens ! Pars ! », a dit A. B. Kora. Oui.", ["« Viens ! Pars ! », a dit A. B. Kora.", "Oui."]),
        ("Il dort (elle part.) puis rit. Oui !", ["Il dort (elle part.) puis rit.", "Oui !"]),
        ("Un… deux trois. Quatre... Cinq", ["Un… deux trois.", "Quatre...", "Cinq"]),
        ("forêt.La pluie tombe", ["forêt.", "La pluie tombe"]),
        ("Sans point\n\nSuite ; reste\nici", ["Sans point", "Suite ; reste\nici"]),
        ("l'an 52 av. J.-C. environ. Du sel, etc. Le roi", ["l'an 52 av. J.-C. environ.", "Du sel, etc.", "Le roi"]),
        ("昨天老师看见了水井……去年护士修理了学校。商人说：「去年。我们走吧！」今天？", ["昨天老师看见了水井……", "去年护士修理了学校。", "商人说：「去年。我们走吧！」", "今天？"]),
        ("昨天我3.5公斤。", ["昨天我3.5公斤。"]),
        ("ትናንት ዶ/ር ሞራ አየ።ዛሬ 2.5 ኪሎ ገዛ፧", ["ትናንት ዶ/ር ሞራ አየ።", "ዛሬ 2.5 ኪሎ ገዛ፧"]),
        ("कल डॉ. मोरा ने देखा । आज दाई ने?", ["कल डॉ. मोरा ने देखा ।", "आज दाई ने?"]),
        ("أمس د. مورا شاهد، ود. مورا حفظ. أمس المعلم؟", ["أمس د. مورا شاهد، ود. مورا حفظ.", "أمس المعلم؟"]),
        ('stray " mark. Next one.', ['stray " mark.', "Next one."]),
    ],
)
def test_sentence_units(text, expected):
    assert [text[a:b] for a, b in sentences.units(text)] == expected


def test_units_cover_every_character_once():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(["Le chat", " dort", ". ", "!", "? ", "« ", " »", '"', "(", ")", "\n", "\n\n", "M. ", "…", "。", "昨天", " B", "1.5"]) for _ in range(rng.randrange(40)))
        parts = sentences.units(text)
        assert all(a < b for a, b in parts) and all(b <= c for (_, b), (c, _) in zip(parts, parts[1:]))
        assert "".join("".join(text[a:b].split()) for a, b in parts) == "".join(text.split())


def test_sentence_rows(spark):
    sub = "array<struct<title:string,items:array<struct<num:int,text:string>>,bullet_items:array<struct<text:string>>,body:string>>"
    df = spark.createDataFrame([(1, "Un. Deux.", [("t", [], [], None), ("t", [], [], "Trois.")]), (2, None, None), (3, " ", []), (None, "Un.", [])], f"section_id bigint, body string, subsections {sub}")
    rows = sorted(tuple(r) for r in sentences.sentence_units(spark, df).collect())
    assert rows == [(1, 0, 0, 3), (1, 0, 4, 9), (1, 2, 0, 6)]
    assert sentences.sentence_units(spark, df.limit(0)).count() == 0


def test_spaceless_gaps_walk_the_word_lattice(spark):
    rng = random.Random(5)
    when, who, did, what = ["昨天", "去年", "雨季以后", "每个月"], ["商人", "农民", "助产士", "老师"], ["看见", "修理", "购买"], ["粮仓", "会议记录", "水井", "学校"]

    def clause():
        return "".join(map(rng.choice, (when, who, did, what)))

    bodies = [f"{clause()}。{rng.choice(who)}说：「{clause()}。」{clause()}，{rng.choice(who)}{rng.choice(did)}{rng.choice(what)}。" for _ in range(60)]
    planted = ["昨天商人看见粮仓……农民说：「去年老师购买水井。」", "昨天商人看见……粮仓。"]
    sub = "array<struct<title:string,items:array<struct<num:int,text:string>>,bullet_items:array<struct<text:string>>,body:string>>"
    df = spark.createDataFrame([(k, t, None) for k, t in enumerate(planted + bodies)], f"section_id bigint, body string, subsections {sub}")
    got = [(r.section_id, planted[r.section_id][r.start_at : r.end_at]) for r in sentences.sentence_units(spark, df).collect() if r.section_id < 2]
    assert set(got) == {(0, "昨天商人看见粮仓……"), (0, "农民说：「去年老师购买水井。」"), (1, "昨天商人看见……粮仓。")}
    lattice = sentences.learn_lattice(sentences.body_rows(df))
    assert lattice.path("雨季以后助产士购买会议记录") == ["雨季以后", "助产士", "购买", "会议记录"]
    assert "农民" in lattice.openers and "粮仓" not in lattice.openers


# --- language -------------------------------------------------------------------------------------------------------


FRENCH = ["Le chien rouge a mangé la farine du village", "La mère de l'enfant a fermé la porte hier", "Il faut acheter le pain et laver les habits"]
ENGLISH = ["The red dog ate the flour of the village", "The mother of the child closed the door yesterday", "One must buy the bread and wash the clothes"]
MOORE = ["Baaga rɩta sagbo wã zaabre sɩda yɩɩlle", "Pʋgẽ wã kẽnga daaga n tar sẽn ya sõma", "Segd n da bur la f pek fut wã ne koom"]


def test_language_of_stretches():
    rows = [(t, lang) for texts, lang in ((FRENCH, "fra_Latn"), (ENGLISH, "eng_Latn"), (MOORE, "mos_Latn")) for t in texts * 3]
    memo = langid.WordScores(langid.fit(rows))
    for texts, lang in ((FRENCH, "fra_Latn"), (ENGLISH, "eng_Latn"), (MOORE, "mos_Latn")):
        for t in texts:
            for form in (t, t.upper()):
                assert [p[0] for p in langid.analyse(form, memo)] == [lang]
    mixed = langid.analyse(FRENCH[0] + ". " + MOORE[0], memo)
    assert [p[0] for p in mixed] == ["fra_Latn", "mos_Latn"] and all(0 < p[3] <= 1 for p in mixed)
    assert mixed[0][1] == 0 and mixed[0][2] == mixed[1][1] and mixed[1][2] == len(FRENCH[0] + ". " + MOORE[0])
    assert [p[0] for p in langid.analyse("Le chien « sagbo » a mangé la farine du village", memo)] == ["fra_Latn"]
    assert langid.analyse("12 450 ...", memo) == [] and langid.analyse(None, memo) == [] and langid.analyse("", memo) == []


def test_mislabelled_rows(spark):
    columns = "pair_id bigint, french string, moore string, english string, french_glotlid_lang string, moore_glotlid_lang string"
    rows = [(k * 10 + i, FRENCH[i], MOORE[i], ENGLISH[i], "fr", "MOS_LATN") for k in range(5) for i in range(3)]
    rows += [(100, FRENCH[0], FRENCH[1], None, None, "mos_Latn"), (101, None, "...", None, None, None), (102, FRENCH[0] + ". " + MOORE[1], MOORE[0], None, "fra", "")]
    df = spark.createDataFrame(rows, columns)
    found = sorted((r.pair_id, r.side, r.lang) for r in langid.mislabelled(langid.field_stretches(spark, df)).collect())
    assert found == [(100, "french", "fra_Latn"), (100, "moore", "fra_Latn"), (102, "french", "fra_Latn+mos_Latn"), (102, "moore", "mos_Latn")]
    assert sorted((r.pair_id, r.side, r.lang) for r in langid.wrong_labels(langid.field_languages(spark, df)).collect()) == found


# --- overlaps -------------------------------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def edited(rng, tokens, times):
    out = list(tokens)
    for _ in range(times):
        k = rng.randrange(len(out) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            out.insert(k, rng.choice(WORDS))
        elif len(out) > 1:
            k = min(k, len(out) - 1)
            out[k : k + 1] = [] if kind == 1 else [rng.choice(WORDS)]
    return out


def test_banded_distance():
    rng = random.Random(4)
    for _ in range(400):
        a = rng.choices(WORDS[:12], k=rng.randrange(1, 14))
        b = edited(rng, a, rng.randrange(6))
        for most in range(5):
            assert overlaps.within(a, b, most) == (distance(a, b) <= most)


def test_cross_split_pairs_against_brute_force(spark):
    rng = random.Random(5)
    rows, k = [], 0
    for _ in range(40):
        f, m = rng.choices(WORDS, k=rng.randrange(1, 26)), rng.choices(WORDS, k=rng.randrange(1, 26))
        for name in ("train", "train", "test", "validation"):
            k += 1
            text = lambda t: "  ".join(edited(rng, t, rng.randrange(1 + len(t) // 3))).capitalize() + rng.choice(["", " !", "."])
            rows.append((k, text(f), text(m), name, "x"))
    rows += [(901, "même", "a", "train", "x"), (902, "MEME.", "À", "test", "x"), (903, None, "a", "test", "x"), (904, " ", "a", "train", "x"), (905, "même", "a", None, "x")]
    df = spark.createDataFrame(rows, "pair_id bigint, french string, moore string, split_name string, source string")
    got = sorted(tuple(r) for r in overlaps.cross_split_pairs(spark, df, shard=17).collect())
    expected = []
    plain = [(i, words(f), words(m), s) for i, f, m, s, _ in rows if s]
    for i, f, m, s in plain:
        for j, g, n, t in plain:
            if s == "train" and t != "train" and f and m and g and n:
                if distance(f, g) <= max(len(f), len(g)) // 5 and distance(m, n) <= max(len(m), len(n)) // 5:
                    expected.append((min(i, j), max(i, j)))
    assert got == sorted(expected) and len(got) > 20
    report = overlaps.overlap_report(overlaps.cross_split_pairs(spark, df), df)
    assert sum(r.pairs for r in report.collect()) == len(expected)
    assert sorted(map(tuple, overlaps.overlap_counts(spark, df).select("split_name", "source", "records", "pairs").collect())) == sorted(map(tuple, report.select("split_name", "source", "records", "pairs").collect()))
    assert overlaps.cross_split_pairs(spark, df.limit(0)).count() == 0


def test_texts_within_the_limit_share_a_key_and_candidates_stay_few():
    rng = random.Random(14)
    held = [rng.choices(WORDS, k=rng.randrange(1, 30)) for _ in range(3000)] + [rng.choices(WORDS, k=rng.randrange(40, 130)) for _ in range(150)] + [["lo"] * n for n in (4, 5, 21, 55, 70)]
    near = [edited(rng, t, rng.randrange(1 + len(t) // 4)) for t in held]
    counts = {w: sum(w in t for t in held) for w in WORDS}
    sketches = overlaps.Sketches(overlaps.Codes(counts, len(held)), 1, round(4 * (np.log2(len(held)) - 3)), 5)
    a, b = ([" ".join(t) for t in texts] for texts in (held, near))
    words, bits, row, key = sketches.of((a, a))
    places = (key >> np.uint64(32) << np.uint64(32)) | row.astype(np.uint64)
    index = overlaps.Index([(bytes(16 * len(a)), *(x.astype(np.int32).tobytes() for x in words), *(x.tobytes() for x in (*bits, places)))], 5, 1)
    words, bits, row, key = sketches.of((b, b))
    found = set(zip(*(x.tolist() for x in index.candidates(words, bits, row, key))))
    due = [k for k, (x, y) in enumerate(zip(held, near)) if distance(x, y) <= max(len(x), len(y)) // 5]
    assert len(due) > 2000 and all((k, k) in found for k in due)
    assert index.within_reach(words)[due].all()
    assert len(found) < 4 * len(held)  # of nine million pairs


def test_overlaps_of_several_blocks_are_those_of_one(spark):
    rng = random.Random(15)
    rows = []
    for k in range(100):
        f, m = rng.choices(WORDS, k=rng.randrange(1, 90)), rng.choices(WORDS, k=rng.randrange(1, 90))
        for name in ("train", "test"):
            rows.append((len(rows), " ".join(edited(rng, f, len(f) // 8)), " ".join(edited(rng, m, len(m) // 8)), name, "x"))
    df = spark.createDataFrame(rows, "pair_id bigint, french string, moore string, split_name string, source string")
    got = sorted(map(tuple, overlaps.cross_split_pairs(spark, df, shard=9, block=13).collect()))
    within = lambda x, y: distance(x, y) <= max(len(x), len(y)) // 5
    split = [(i, f.split(" "), m.split(" "), s) for i, f, m, s, _ in rows]
    assert got == sorted((min(i, j), max(i, j)) for i, f, m, s in split for j, g, n, t in split if s == "train" and t == "test" and within(f, g) and within(m, n)) and len(got) > 20


# --- alignment ------------------------------------------------------------------------------------------------------


def test_alignment_of_an_invented_language(spark):
    rng = random.Random(6)
    vocabulary = [f"{a}{b}" for a in WORDS for b in ("na", "vo", "shi")]
    other = {w: w[::-1] + "q" for w in vocabulary}
    rows, truth = [], set()
    for doc in range(60):
        french = [rng.sample(vocabulary, rng.randrange(5, 12)) for _ in range(8)]
        moore, links = [], []
        k = 0
        while k < 8:
            if k < 7 and rng.random() < 0.15:  # joined
                moore.append(([other[w] for s in french[k : k + 2] for w in s], [k, k + 1]))
                k += 2
            elif rng.random() < 0.1:  # left out
                k += 1
            else:
                moore.append(([other[w] for w in french[k] if rng.random() < 0.9] + ["wa"], [k]))
                k += 1
        if len(moore) > 2 and rng.random() < 0.5:
            i = rng.randrange(len(moore) - 1)
            moore[i], moore[i + 1] = moore[i + 1], moore[i]
        place = rng.randrange(len(moore) + 1)
        moore.insert(place, (None, []))
        for j, (_, sources) in enumerate(moore):
            links += [(doc, i, j) for i in sources]
        truth |= set(links)
        rows.append((doc, [" ".join(s).capitalize() + "." for s in french] + ["44"], [None if t is None else " ".join(t) for t, _ in moore] + ["44"]))
    rows += [(900, None, ["a b c"]), (901, [], []), (902, ["", None], [" "]), (None, ["chat noir du roi"], ["chat noir du roi"])]
    df = spark.createDataFrame(rows, "pt_id bigint, french array<string>, moore array<string>")
    got = {(r.pt_id, r.french_no, r.moore_no) for r in bitext.sentence_pairs(spark, df).collect()}
    assert len(got & truth) / len(truth) > 0.9 and len(got & truth) / len(got) > 0.9


def test_few_seeds_turn_the_space_a_little():
    rng = np.random.default_rng(3)

    def unit(n):
        rows = rng.normal(size=(n, bitext.DIM))
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)

    turn, _ = np.linalg.qr(np.eye(bitext.DIM) + 0.02 * rng.normal(size=(bitext.DIM, bitext.DIM)))
    turn *= np.sign(np.diag(turn))
    likeness = []
    for n in (0, 1, 50, 2 * bitext.DIM - 1, 4 * bitext.DIM):
        x = unit(n)
        found = bitext.rotation(x, x @ turn)
        assert np.allclose(found @ found.T, np.eye(bitext.DIM), atol=1e-8)
        likeness.append(np.trace(found.T @ turn) / bitext.DIM)
    assert np.allclose(bitext.rotation(unit(0), unit(0)), np.eye(bitext.DIM)) and np.all(np.diff(likeness) > 0) and likeness[-1] > 0.999
    shared = [f"nom{k}" for k in range(60)]
    base = unit(60)
    lines = [(side * bitext.BUCKETS + 7 * k, 20, 20, (base[k] @ (turn if side else np.eye(bitext.DIM))).astype(np.float32).tobytes()) for side in (0, 1) for k in range(len(shared))]
    lines.append((-1, 1000, 4000, np.zeros(bitext.DIM, np.float32).tobytes()))
    vectors = bitext.Vectors(pd.DataFrame(lines, columns=["row", "windows", "sentences", "vector"]))
    first, second = vectors.side == 0, vectors.side == 1
    before = (vectors.matrix[first] * vectors.matrix[second]).sum()
    seeds = vectors.rotate()
    assert 0 < seeds < 2 * bitext.DIM and (vectors.matrix[first] * vectors.matrix[second]).sum() > before


def test_warping_path():
    rng = np.random.default_rng(7)
    for n, m in [(1, 1), (2, 9), (17, 12), (40, 41), (200, 150)]:
        a, b = rng.normal(size=(n, 64)), rng.normal(size=(m, 64))
        path = [(i, j) for i, j, _ in bitext._path(a, b, 0.5)]
        assert path[-1] == (n - 1, m - 1) and 0 in path[0]
        assert all((c - a, d - b) in {(1, 0), (0, 1), (1, 1)} for (a, b), (c, d) in zip(path, path[1:]))
    rows = rng.normal(size=(120, 64))
    assert [(i, j) for i, j, _ in bitext.warp(rows, rows)] == [(i, i) for i in range(120)]
    left_out = np.delete(rows, [30, 31, 77], axis=0)
    kept = [i for i in range(120) if i not in (30, 31, 77)]
    assert [(i, j) for i, j, _ in bitext.warp(rows, left_out)] == [(i, j) for j, i in enumerate(kept)]
    joined = np.concatenate([rows[:10], rows[10:12].sum(axis=0, keepdims=True), rows[12:]])
    assert {(10, 10), (11, 10), (12, 11)} <= {(i, j) for i, j, _ in bitext.warp(rows, joined)}


def test_the_path_decides_between_equal_sentences_and_rematch_recovers_moved_ones():
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(9, 64))
    rows[6] = rows[2]  # one sentence twice: only the order tells which is meant
    links = {(i, j): s for i, j, s in bitext.warp(rows, rows)}
    assert set(links) == {(i, i) for i in range(9)}
    alone: dict = {}
    bitext.rematch(rows, rows, alone)
    assert (6, 6) not in alone and (6, 2) in alone
    moved = rows[[4, 0, 1, 2, 3, 5, 6, 7, 8]]
    links = {(i, j): s for i, j, s in bitext.warp(rows, moved)}
    assert (4, 0) not in links
    bitext.rematch(rows, moved, links)
    assert links[4, 0] > 0.99 and len(links) == 9


# --- scans ----------------------------------------------------------------------------------------------------------


def test_noise_of_a_page():
    clean = {w: 500 for w in "le chien a mangé la farine du village avec moderne porte parole décret et puis maison kadiogo".split()}
    vocabulary = scans.Vocabulary(clean, {"rnaison": 1, "modeme": 1}, {"porte-parole": 9})
    text = "Chapitre 1 : Le chien\nle chien a rnangé la fa-\n\n12\n\x0cLE CHIEN DU VlLLAGE | 12\n\nrine du vil|age avec porte-\nparole et COVID-19, 1er B12\nmodeme puis la mai¬\nson K4diogo."
    noise, paragraphs = scans.analyse(text, ["Le chien du village", "Le chien"], vocabulary, chapter=True)
    assert noise == [(2, "char"), (2, "hyphen"), (4, "page_number"), (5, "header"), (7, "char"), (9, "char"), (9, "hyphen"), (10, "char")]
    assert paragraphs[-1] == "le chien a mangé la farine du village avec porte-parole et COVID-19, 1er B12 moderne puis la maison Kadiogo." or paragraphs[-1].endswith("moderne puis la maison Kadiogo.")
    assert scans.analyse(None, [], vocabulary, False) == ([], []) and scans.analyse(" \n", [], vocabulary, False) == ([], [])


def test_candidates_are_complete():
    rng = random.Random(8)
    lexicon = {"".join(rng.choices("abcm", k=rng.randrange(1, 6))): 1 for _ in range(150)}
    vocabulary = scans.Vocabulary(lexicon, {}, {})

    def reach(w):
        out = set()
        for i in range(len(w) + 1):
            for x in "abcm":
                out |= {w[:i] + x + w[i:], w[:i] + x + w[i + 1 :], w[:i] + x + w[i + 2 :]} if i < len(w) else {w[:i] + x + w[i:]}
                if i < len(w):
                    out |= {w[:i] + x + y + w[i + 1 :] for y in "abcm"}
            out.add(w[:i] + w[i + 1 :])
        return out - {w}

    for _ in range(100):
        w = "".join(rng.choices("abcm", k=rng.randrange(1, 6)))
        assert {c for c, _ in vocabulary.candidates(w)} == reach(w) & set(lexicon)


@pytest.mark.parametrize("line, kind", [("– 12 –", True), ("Page 3", True), ("[14]", True), ("p. 5l", True), ("3/80", True), ("| 7", True), ("12 moutons", False), ("pʋgẽ.", False), ("", False)])
def test_page_numbers(line, kind):
    assert bool(scans.PAGE_NUMBER.match(line)) is kind


# --- leaks ----------------------------------------------------------------------------------------------------------


def test_leaks_with_planted_passages(spark):
    rng = random.Random(9)
    vocabulary = [f"{a}{b}" for a in WORDS for b in ("na", "vo", "shi", "ke")]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(16, 60))), None) for k in range(30)]
    docs, truth = [], set()
    for d in range(120):
        body = rng.choices(vocabulary, k=rng.randrange(20, 200))
        k = rng.randrange(30)
        tokens = items[k][1].split()
        share = rng.choice([0.25, 0.6, 1.0])
        n = int(len(tokens) * share)
        start = rng.randrange(len(tokens) - n + 1)
        part = tokens[start : start + n]
        part = [w + "x" if rng.random() < 0.04 and 0 < i < len(part) - 1 else w for i, w in enumerate(part)]
        if rng.random() < 0.5 and len(part) > 4:
            part.insert(len(part) // 2, "zz")
        at = rng.randrange(len(body))
        docs.append((d, " ".join(body[:at]) + ".\n" + " ".join(part).upper() + ", " + " ".join(body[at:]), "x"))
        if share > 0.5:
            truth.add((d, k))
    docs += [(900, None, "x"), (901, "", "x"), (None, items[0][1], "x")]
    documents = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string")
    held_out = spark.createDataFrame(items + [(30, None, " ")], "item_id bigint, french string, moore string")
    for block in (7, 1000):
        got = {tuple(r) for r in leaks.leaked_items(spark, documents, held_out, ("french", "moore"), block=block).collect()}
        assert got == truth
    assert leaks.leaked_items(spark, documents, held_out.limit(0), ("french", "moore")).count() == 0


def test_one_run_of_half_the_words_is_a_leak_whatever_its_weight(spark):
    rng = random.Random(11)
    common = ["le", "chef", "du", "village", "a", "dit", "que", "pluie", "viendra", "demain"]
    items = [(0, " ".join(common + [f"rare{k}" for k in range(10)]))]
    items += [(k, " ".join(rng.sample(common, 10) + [f"mot{k}x{n}" for n in range(10)])) for k in range(1, 25)]
    docs = [(0, "On sait : " + " ".join(common) + ". Voilà."), (1, "On sait : " + " ".join(common[:9]) + ". Voilà."), (2, " ".join(common[:4] + ["rare0"] + common[7:]))]
    documents = spark.createDataFrame(docs, "doc_id bigint, text string")
    held_out = spark.createDataFrame(items, "item_id bigint, french string")
    assert {tuple(r) for r in leaks.leaked_items(spark, documents, held_out, ("french",)).collect()} == {(0, 0)}


def test_items_with_the_same_short_passage_and_slips_in_every_fourth_word(spark):
    rng = random.Random(12)
    vocabulary = [f"{a}{b}" for a in WORDS for b in ("na", "vo", "shi", "ke")]
    passages = [" ".join(rng.sample(vocabulary, 40)) for _ in range(3)]
    items = [(1, "oui chef"), (2, "Oui, chef !")] + [(k, p) for k, p in enumerate(passages, 3)]
    misspelt = " ".join(w + "zz" if n % 4 == 3 else w for n, w in enumerate(passages[0].split()))
    tokens = passages[1].split()
    turned = " ".join(tokens[20:30] + ["loin"] + tokens[5:20] + tokens[30:35])
    docs = [(0, "Elle dit oui, chef."), (1, "Avant " + misspelt + " après"), (2, turned), (3, " ".join(tokens[:12]))]
    documents = spark.createDataFrame(docs, "doc_id bigint, text string")
    held_out = spark.createDataFrame(items, "item_id bigint, french string")
    found = lambda **more: {tuple(r) for r in leaks.leaked_items(spark, documents, held_out, ("french",), **more).collect()}
    assert found() == found(block=1) == {(0, 1), (0, 2), (1, 3)}
    assert found(ordered=False) == {(0, 1), (0, 2), (1, 3), (2, 4)}


def test_the_block_of_a_passage_changes_nothing(spark):
    rng = random.Random(13)
    common = [f"mot{k}" for k in range(60)]
    first = rng.sample(common, 40)
    items = [(0, " ".join(first))] + [(k, " ".join(rng.sample(common, 40))) for k in range(1, 49)]
    scattered = [w for k, w in enumerate(first) if k % 9 < 5][:22]
    documents = spark.createDataFrame([(0, " ".join(scattered))], "doc_id bigint, text string")
    held_out = spark.createDataFrame(items, "item_id bigint, french string")
    answers = [{tuple(r) for r in leaks.leaked_items(spark, documents, held_out, ("french",), block=b).collect()} for b in (1, 7, 1000)]
    assert answers[0] == answers[1] == answers[2]


def test_runs_are_found_by_rolling_hashes():
    rng = random.Random(4)
    for _ in range(50):
        ids = [rng.randrange(1, 4) for _ in range(rng.randrange(40))]
        for size in (1, 2, 5):
            runs = [tuple(ids[i : i + size]) for i in range(len(ids) - size + 1)]
            hashes = leaks._rolling(ids, size)
            assert len(hashes) == len(runs) and len(set(zip(runs, hashes))) == len(set(runs)) == len(set(hashes))
    a, b = np.array([1, 2, 3, 4, 5, 6, 1, 2]), np.array([4, 5, 6, 0, 1, 2, 3])
    assert leaks.tiles(a, b) == [(0, 4, 3), (3, 0, 3)]


def test_tiles_are_maximal_and_disjoint():
    rng = np.random.default_rng(10)
    for _ in range(50):
        a, b = rng.integers(1, 6, 30), rng.integers(1, 6, 25)
        found = leaks.tiles(a, b)
        assert all((a[i : i + k] == b[j : j + k]).all() and k >= leaks.TILE for i, j, k in found)
        assert len({x for i, _, k in found for x in range(i, i + k)}) == sum(k for *_, k in found)
        assert leaks.held(a, b).sum() <= leaks._bound(a, b)


# --- reading --------------------------------------------------------------------------------------------------------


def test_grades_of_held_out_texts(spark):
    rng = random.Random(11)
    easy, hard = ["chat", "sel", "eau", "pain", "nuit"], ["désertification", "épistémologie", "jurisprudence", "rationalisation"]

    def text(grade):
        return ". ".join(" ".join(rng.choice(hard if rng.random() < grade / 6 else easy) for _ in range(4 + 3 * grade)) for _ in range(6)) + "."

    rows = [(i, text(g), f"s{i % 7}", g) for i in range(300) for g in [1 + i % 5]]
    documents = spark.createDataFrame([r[:3] for r in rows] + [(900, None, "s"), (901, " 12 ", "s"), (902, "", None), (None, "chat", "s")], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, g if i % 50 else None) for i, _, _, g in rows[:200]] + [(999, 3)], "doc_id bigint, grade int")
    got = {r.doc_id: r.grade for r in reading.reading_levels(spark, documents, labels).collect()}
    assert got[900] is None and got[901] is None and got[902] is None
    errors = [abs(got[i] - g) for i, _, _, g in rows[200:]]
    assert np.mean(errors) < 0.6
    by_source = reading.check_by_source(spark, documents, labels).collect()
    assert len(by_source) == 7 and all(r.mean_error < 0.8 for r in by_source)
    few = reading.reading_levels(spark, documents, labels.limit(5)).where(F.col("grade").isNotNull())
    assert few.select("grade").distinct().count() == 1


def test_calibration_rises():
    x, y = reading.calibration(np.array([1.0, 2.0, 3.0, 4.0]), np.array([1.0, 3.0, 2.0, 5.0]))
    assert list(x) == [1.0, 2.5, 4.0] and list(y) == [1.0, 2.5, 5.0]


def test_a_vocabulary_that_is_not_sent_gives_the_same_lines_and_paragraphs(spark):
    folder = "/root/testdata/sf0.001"
    sections, chapters = (latest(table(spark, folder, name), key) for name, key in (("sections", "section_id"), ("chapters", "chapter_id")))
    for query in (scans.noisy_lines, scans.repaired):
        sent, joined = (sorted(map(tuple, query(spark, sections, chapters, most=most).collect())) for most in (scans.VOCABULARY, 10))
        assert sent == joined and len(sent) > 20
