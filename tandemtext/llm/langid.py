"""Language of texts and of the stretches of mixed texts, with confidence."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemtext.llm.text import composed, plain_word
from tandemtext.session import cut_lineage, spread

#: The languages told apart and the spellings of their labels.
LANGUAGES = ("eng_Latn", "fra_Latn", "mos_Latn")
SPELLINGS = {"eng_Latn": ("en", "eng", "eng_latn"), "fra_Latn": ("fr", "fra", "fra_latn"), "mos_Latn": ("mos", "mos_latn")}

#: Hash space of the n-grams and their lengths.
SPACE = 1 << 18
SIZES = (1, 2, 3, 4, 5)
#: Labelled fields of one language the classifier is fitted on (a bounded sample, by hash order of the key).
SAMPLE = 6000
#: Steps of the hash threshold by which the sample is drawn.
STEPS = 1 << 20
#: A word speaks for a language by at most so many nats; a change of language costs so many.
WORD_CAP = 4.0
CHANGE = 9.0
#: Words and nats that a stretch must have to make a field mixed.
LEAST_WORDS = 3
LEAST_NATS = 7.0

WORD = re.compile(r"[^\W\d_]+")


def canonical(label: Column) -> Column:
    """Standard form of a language label; null, blank and unknown labels stay as they are, lower case."""
    low = F.lower(F.trim(label))
    out = low
    for name, forms in SPELLINGS.items():
        out = F.when(low.isin(*forms), F.lit(name)).otherwise(out)
    return out


def grams(word: str) -> list[int]:
    """Hashed n-grams of a word with its edges marked."""
    text = f"^{word}$"
    return [zlib.crc32(text[i : i + n].encode()) & (SPACE - 1) for n in SIZES for i in range(len(text) - n + 1)]


def fit(rows: list[tuple[str, str]]) -> np.ndarray:
    """Log-probability matrix (n-gram, language) of a multinomial naive Bayes model.

    Each word counts as written (lower case) and without accents, so that texts
    typed without diacritics are known too.
    """
    counts = np.full((SPACE, len(LANGUAGES)), 0.05)
    words: Counter[tuple[str, int]] = Counter()
    for text, lang in rows:
        k = LANGUAGES.index(lang)
        for w in WORD.findall(composed(text).lower()):
            words[w, k] += 1
    for (w, k), n in words.items():
        for form in {w, plain_word(w)}:
            for g in grams(form):
                counts[g, k] += n
    return np.log(counts / counts.sum(axis=0)).astype(np.float32)


class WordScores(dict):
    """Word -> its row in ``capped`` and ``full``: log-likelihood of each language below the best one, capped and in full.

    New words of a batch are scored together, as the product of their sparse
    n-gram counts with the model. The table is emptied when it holds ``limit`` spellings.
    """

    def __init__(self, model: np.ndarray, limit: int = 1_000_000):
        super().__init__()
        self.model, self.limit = model, limit
        self.capped = self.full = np.empty((0, len(LANGUAGES)))

    def learn(self, words: set[str]) -> None:
        """Score the words that are not known yet."""
        if len(self) + len(words) > self.limit:
            self.clear()
            self.capped = self.full = np.empty((0, len(LANGUAGES)))
        new = sorted(words.difference(self))
        if not new:
            return
        spelt = [grams(w) for w in new]
        sizes = np.array([len(g) for g in spelt])
        starts = np.cumsum(sizes) - sizes
        total = np.add.reduceat(self.model[np.concatenate(spelt)], starts, axis=0, dtype=np.float64)
        total /= np.maximum(1.0, np.array([len(w) for w in new]) / 4)[:, None]  # n-grams overlap: weigh a word, not each of its n-grams
        below = total - total.max(axis=1, keepdims=True)
        self.update(zip(new, range(len(self), len(self) + len(new))))
        self.capped = np.concatenate([self.capped, np.maximum(below, -WORD_CAP)])
        self.full = np.concatenate([self.full, below])


def stretches(scores: list[tuple[float, ...]]) -> list[tuple[int, int, int]]:
    """(language, first word, last word + 1) of the most likely path with costly changes (Viterbi)."""
    k = len(LANGUAGES)
    best, back = list(scores[0]), []
    for row in scores[1:]:
        top = max(range(k), key=best.__getitem__)
        jump = best[top] - CHANGE
        step, new = [], []
        for j in range(k):
            if best[j] >= jump:
                step.append(j)
                new.append(best[j] + row[j])
            else:
                step.append(top)
                new.append(jump + row[j])
        back.append(step)
        best = new
    at = max(range(k), key=best.__getitem__)
    path = [at]
    for step in reversed(back):
        at = step[at]
        path.append(at)
    path.reverse()
    out, start = [], 0
    for i in range(1, len(path) + 1):
        if i == len(path) or path[i] != path[start]:
            out.append((path[start], start, i))
            start = i
    return out


def analyse_all(texts: list[str | None], memo: WordScores) -> list[list[tuple[str, int, int, float]]]:
    """(language, start, end, confidence) of each stretch of each text; offsets are characters of the composed text.

    A text without words has none. Stretches of another language with fewer
    than LEAST_WORDS words or LEAST_NATS of evidence (names, borrowed words)
    belong to their surroundings. The confidence is the posterior of the
    stretch's language, flattened by the number of its words. A batch is
    scored as a whole; where a change of language costs more than it could
    bring, the best path is one stretch, and only other texts are searched for one.
    """
    bodies = [composed(t) if t else "" for t in texts]
    lowered = [b.lower() if len(b.lower()) == len(b) else b for b in bodies]
    found = [[w.lower() for w in WORD.findall(b)] for b in lowered]
    memo.learn({w for words in found for w in words})
    out: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
    some = [k for k, words in enumerate(found) if words]
    if not some:
        return out
    sizes = np.array([len(found[k]) for k in some])
    rows = np.fromiter((memo[w] for k in some for w in found[k]), np.int64, int(sizes.sum()))
    starts = np.cumsum(sizes) - sizes
    capped, full = memo.capped[rows], memo.full[rows]
    light, total = np.add.reduceat(capped, starts, axis=0), np.add.reduceat(full, starts, axis=0)
    plain = -light.max(axis=1) < CHANGE
    best = total.argmax(axis=1)
    sure = _confidence(total / np.sqrt(sizes)[:, None], best)
    for n, k in enumerate(some):
        if plain[n]:
            out[k] = [(LANGUAGES[best[n]], 0, len(bodies[k]), float(sure[n]))]
        else:
            a, b = starts[n], starts[n] + sizes[n]
            out[k] = _stretched(bodies[k], lowered[k], capped[a:b].tolist(), full[a:b], int(best[n]))
    return out


def _confidence(sums: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Posterior of ``lang`` in each row of log-likelihoods."""
    own = np.take_along_axis(sums, np.asarray(lang)[:, None], axis=1)
    return np.round(1.0 / np.exp(np.minimum(50.0, sums - own)).sum(axis=1), 4)


def _stretched(body: str, lowered: str, scores: list[list[float]], full: np.ndarray, main: int) -> list[tuple[str, int, int, float]]:
    """The stretches of a text on the most likely path; ``main`` is the language of the whole."""
    parts = stretches(scores)
    if len(parts) > 1:
        kept: list[tuple[int, int, int]] = []
        for lang, a, b in parts:
            if lang != main:
                gains = [scores[i][lang] - scores[i][main] for i in range(a, b)]
                if b - a < LEAST_WORDS or sum(gains) < LEAST_NATS or sum(g > 1.0 for g in gains) < LEAST_WORDS - 1:
                    lang = main
            if kept and kept[-1][0] == lang:
                kept[-1] = (lang, kept[-1][1], b)
            else:
                kept.append((lang, a, b))
        parts = kept
    if len(parts) == 1:
        parts = [(main, 0, len(scores))]
    places = [m.start() for m in WORD.finditer(lowered)]
    edges = [0, *(places[a] for _, a, _ in parts[1:]), len(body)]
    sums = np.array([full[a:b].sum(axis=0) / math.sqrt(b - a) for _, a, b in parts])
    sure = _confidence(sums, np.array([lang for lang, _, _ in parts]))
    return [(LANGUAGES[lang], edges[n], edges[n + 1], float(sure[n])) for n, (lang, _, _) in enumerate(parts)]


def analyse(text: str | None, memo: WordScores) -> list[tuple[str, int, int, float]]:
    """The stretches of one text, see :func:`analyse_all`."""
    return analyse_all([text], memo)[0]


def labelled(pairs: DataFrame, key: str = "pair_id", sample: int = SAMPLE) -> list[tuple[str, str]]:
    """(text, language) training rows: fields whose label is one of the languages, at most ``sample`` of each.

    English comes from the english column as well, which has no label column.
    The sample is drawn by a hash of the key below a threshold that follows from
    the number of fields of a kind, so it is the same on every run, no text is
    shuffled, and about ``sample`` rows of a kind reach the driver.
    """
    fields = F.array(
        F.struct(F.lit("french").alias("column"), F.col("french").alias("text"), canonical(F.col("french_glotlid_lang")).alias("lang")),
        F.struct(F.lit("moore").alias("column"), F.col("moore").alias("text"), canonical(F.col("moore_glotlid_lang")).alias("lang")),
        F.struct(F.lit("english").alias("column"), F.col("english").alias("text"), F.lit("eng_Latn").alias("lang")),
    )
    long = pairs.select(F.col(key).alias("k"), F.explode(fields).alias("f")).select("f.*", F.xxhash64("k", "f.column").alias("h"))
    usable = long.where(F.col("text").isNotNull() & F.col("lang").isin(*LANGUAGES))
    usable = usable.withColumn("step", F.pmod("h", F.lit(STEPS)))
    share = {(r["column"], r["lang"]): math.ceil(STEPS * sample / r["n"]) for r in usable.groupBy("column", "lang").agg(F.count("*").alias("n")).collect()}
    chosen = F.lit(False)
    for (column, lang), most in sorted(share.items()):
        chosen = chosen | ((F.col("column") == column) & (F.col("lang") == lang) & (F.col("step") < most))
    return [(r[0], r[1]) for r in usable.where(chosen).orderBy("h", "text").select("text", "lang").collect()]


def purified(rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The training rows whose label the model fitted on all of them confirms, as unmixed text."""
    memo = WordScores(fit(rows))
    out = []
    for (text, lang), parts in zip(rows, analyse_all([text for text, _ in rows], memo)):
        if len(parts) == 1 and parts[0][0] == lang:
            out.append((text, lang))
    return out if {lang for _, lang in out} == {lang for _, lang in rows} else rows


def _fields(spark: SparkSession, pairs: DataFrame, key: str, sample: int, schema: str, rows) -> DataFrame:
    """What ``rows`` makes of (key, side, label, stretches) of both fields of each row.

    The pairs are written to a checkpoint once. The model (one float matrix of
    fixed size, 3 MB) is fitted on a bounded sample of labelled fields and
    broadcast; every field is scored whole, in Arrow batches, without a shuffle.
    """
    pairs = cut_lineage(pairs.where(F.col(key).isNotNull()).select(key, "french", "moore", "english", "french_glotlid_lang", "moore_glotlid_lang"))
    shared = spark.sparkContext.broadcast(fit(purified(labelled(pairs, key, sample))))
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = WordScores(shared.value)
        for batch in batches:
            out = []
            for side, label in (("french", "a"), ("moore", "b")):
                for k, name, parts in zip(batch[key], batch[label], analyse_all(batch[side].tolist(), memo)):
                    if parts:
                        out += rows(k, side, name, parts)
            yield pd.DataFrame(out, columns=[key, *names])

    columns = [key, "french", canonical(F.col("french_glotlid_lang")).alias("a"), "moore", canonical(F.col("moore_glotlid_lang")).alias("b")]
    return spread(pairs.select(*columns)).mapInPandas(run, f"`{key}` {pairs.schema[key].dataType.simpleString()}, {schema}")


def field_stretches(spark: SparkSession, pairs: DataFrame, key: str = "pair_id", sample: int = SAMPLE) -> DataFrame:
    """(key, side, label, segment_no, lang, start_at, end_at, confidence) of the stretches of both fields of each row.

    Null fields, fields without words and rows without a key give no row.
    """
    schema = "side string, label string, segment_no int, lang string, start_at int, end_at int, confidence double"
    return _fields(spark, pairs, key, sample, schema, lambda k, side, label, parts: [(k, side, label, n, *part) for n, part in enumerate(parts, 1)])


def field_languages(spark: SparkSession, pairs: DataFrame, key: str = "pair_id", sample: int = SAMPLE) -> DataFrame:
    """(key, side, label, lang, confidence): the language of each field, several joined by + in alphabetical order, and its least confidence."""
    schema = "side string, label string, lang string, confidence double"
    return _fields(spark, pairs, key, sample, schema, lambda k, side, label, parts: [(k, side, label, "+".join(sorted({p[0] for p in parts})), min(p[3] for p in parts))])


def wrong_labels(fields: DataFrame, key: str = "pair_id") -> DataFrame:
    """(key, side, lang, confidence): fields in several languages, or whose label is missing or names another (of :func:`field_languages`)."""
    return fields.where(F.col("label").isNull() | (F.col("label") != F.col("lang"))).select(key, "side", "lang", "confidence")


def mislabelled(stretches_: DataFrame, key: str = "pair_id") -> DataFrame:
    """As :func:`wrong_labels`, from the stretches of :func:`field_stretches`."""
    whole = stretches_.groupBy(key, "side").agg(
        F.first("label").alias("label"), F.array_join(F.array_sort(F.collect_set("lang")), "+").alias("lang"), F.min("confidence").alias("confidence")
    )
    return wrong_labels(whole, key)
