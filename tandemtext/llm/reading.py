"""Reading level of texts: gradient-boosted regression trees over text statistics."""

from __future__ import annotations

import math
import pickle
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemtext.llm.text import composed

#: Labelled texts the model is fitted on (a bounded sample, by hash order of the key).
SAMPLE = 4000
#: Trees, their depth, shrinkage, bins of a feature, and least rows of a leaf.
TREES, DEPTH, RATE, BINS, LEAF = 160, 3, 0.08, 48, 8
#: Pseudo-count that draws the level of a rarely labelled word to the mean of its length class.
PRIOR = 3.0
#: Grade from which a text counts as demanding.
DEMANDING = 3.5

WORD = re.compile(r"[^\W\d_]+")
#: Words and the marks that end sentences.
MARKED = re.compile(r"[^\W\d_]+|[.!?…]+(?=\s|$)|\n\s*\n")
CLAUSE = re.compile(r"[,;:.!?…–—()]+")
QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)


def length_class(word: str) -> int:
    return min(len(word), 20)


class Levels(dict):
    """Word -> mean grade of the labelled texts that hold it, drawn to the mean of words as long."""

    def __init__(self, totals: dict[str, tuple[float, int]], by_length: np.ndarray, limit: int = 1_000_000):
        super().__init__()
        self.totals, self.by_length, self.limit = totals, by_length, limit

    def __missing__(self, word: str) -> float:
        if len(self) >= self.limit:
            self.clear()
        total, n = self.totals.get(word, (0.0, 0))
        found = self[word] = (total + PRIOR * self.by_length[length_class(word)]) / (n + PRIOR)
        return found


def vocabulary(texts: list[list[str]], grades: np.ndarray) -> Levels:
    totals: dict[str, list[float]] = defaultdict(lambda: [0.0, 0])
    sums, counts = np.zeros(21), np.zeros(21)
    for words, grade in zip(texts, grades):
        for w in set(words):
            entry = totals[w]
            entry[0] += grade
            entry[1] += 1
            sums[length_class(w)] += grade
            counts[length_class(w)] += 1
    mean = float(grades.mean()) if len(grades) else 3.0
    by_length = (sums + 20 * mean) / (counts + 20)
    return Levels({w: (t, n) for w, (t, n) in totals.items()}, by_length)


def tokens(text: str) -> list[str]:
    return WORD.findall(composed(text).lower())


def shape(text: str, words: list[str]) -> list[float]:
    """Length, syntax and cohesion statistics, which need no vocabulary."""
    n = len(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=n)
    order = np.sort(size)
    lengths, shared, last, run, mine = [], [], None, 0, set()
    for token in MARKED.findall(text):
        if token[0].isalpha():
            run += 1
            if len(token) > 3:
                mine.add(token)
        elif run:
            lengths.append(run)
            if last is not None:
                shared.append(len(last & mine) / max(1, min(len(last), len(mine))))
            last, mine, run = mine, set(), 0
    if run:
        lengths.append(run)
        if last is not None:
            shared.append(len(last & mine) / max(1, min(len(last), len(mine))))
    lengths.sort()
    return [
        math.log1p(n), float(size.sum()) / n, (n - int(order.searchsorted(9, "right"))) / n, (n - int(order.searchsorted(12, "right"))) / n,
        *[float(order[min(n - 1, int(q * n))]) for q in QUANTILES[2:]],
        len(set(words)) / n**0.5, n / max(1, len(lengths)), float(lengths[len(lengths) // 2]) if lengths else n, float(lengths[-1]) if lengths else n,
        n / (1 + len(CLAUSE.findall(text))), text.count(",") / n, sum(shared) / len(shared) if shared else 0.0, text.count("\n") / n,
    ]


def difficulty(words: list[str], levels: Levels, own: float | None = None) -> list[float]:
    """Distribution of the words' levels.

    ``own`` is the text's own grade where it took part in ``levels``: its share
    is taken out of each word's level, so that a text does not predict itself.
    """
    n = len(words)
    if own is None:
        level = np.fromiter(map(levels.__getitem__, words), dtype=np.float64, count=n)
    else:
        level = np.empty(n)
        for k, w in enumerate(words):
            total, count = levels.totals.get(w, (0.0, 0))
            if count:
                total, count = total - own, count - 1
            level[k] = (total + PRIOR * levels.by_length[length_class(w)]) / (count + PRIOR)
    level.sort()
    mean = float(level.sum()) / n
    return [
        mean, max(0.0, float(level @ level) / n - mean * mean) ** 0.5, *[float(level[min(n - 1, int(q * n))]) for q in QUANTILES],
        (n - int(level.searchsorted(3.5))) / n, (n - int(level.searchsorted(4.0))) / n,
    ]


def features(text: str, words: list[str], levels: Levels) -> list[float]:
    return shape(text, words) + difficulty(words, levels)


class Trees:
    """Gradient-boosted regression trees of squared loss over binned features."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = self.bins(x)
        self.base = float(y.mean())
        self.nodes: list[list[tuple[int, int, float]]] = []  # per tree, heap order: feature, bin, value of a leaf
        fitted = np.full(len(y), self.base)
        wide = BINS + 1
        for _ in range(TREES):
            rest = y - fitted
            at = np.zeros(len(y), dtype=np.int64)
            tree: list[tuple[int, int, float]] = [(-1, 0, 0.0)] * (2 ** (DEPTH + 1) - 1)
            for depth in range(DEPTH):
                first, count = 2**depth - 1, 2**depth
                local = at - first
                best_gain, best = np.full(count, 1e-9), [None] * count
                whole_n = np.bincount(local, minlength=count)
                whole_s = np.bincount(local, rest, count)
                for j in range(x.shape[1]):
                    key = local * wide + binned[:, j]
                    n = np.bincount(key, minlength=count * wide).reshape(count, wide).cumsum(axis=1)[:, :-1]
                    s = np.bincount(key, rest, count * wide).reshape(count, wide).cumsum(axis=1)[:, :-1]
                    rn, rs = whole_n[:, None] - n, whole_s[:, None] - s
                    ok = (n >= LEAF) & (rn >= LEAF)
                    gain = np.where(ok, s**2 / np.maximum(n, 1) + rs**2 / np.maximum(rn, 1) - (whole_s**2 / np.maximum(whole_n, 1))[:, None], -1)
                    cut = gain.argmax(axis=1)
                    for k in range(count):
                        if gain[k, cut[k]] > best_gain[k]:
                            best_gain[k], best[k] = gain[k, cut[k]], (j, int(cut[k]))
                for k in range(count):
                    mine = local == k
                    if best[k] is None:
                        tree[first + k] = (0, wide, 0.0)  # all rows go left
                        at[mine] = 2 * (first + k) + 1
                    else:
                        j, cut_ = best[k]
                        tree[first + k] = (j, cut_, 0.0)
                        at[mine] = 2 * (first + k) + 1 + (binned[mine, j] > cut_)
            first = 2**DEPTH - 1
            n = np.bincount(at - first, minlength=2**DEPTH)
            s = np.bincount(at - first, rest, 2**DEPTH)
            leaf = RATE * s / (n + 1.0)
            for k in range(2**DEPTH):
                tree[first + k] = (-1, 0, float(leaf[k]))
            fitted += leaf[at - first]
            self.nodes.append(tree)
        self._pack()
        return self

    def _pack(self) -> None:
        self.feature = np.array([[t[0] for t in tree] for tree in self.nodes])
        self.cut = np.array([[t[1] for t in tree] for tree in self.nodes])
        self.value = np.array([[t[2] for t in tree] for tree in self.nodes])

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], axis=1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        binned, out, rows = self.bins(x), np.full(len(x), self.base), np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (binned[rows, f[at]] > c[at])
            out += v[at]
        return out


def calibration(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic map (pool adjacent violators) from raw predictions to grades, as interpolation points."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []
    for r, g in zip(raw[order], y[order]):
        blocks.append([g, 1.0, r, r])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            g2, n2, _, hi = blocks.pop()
            g1, n1, lo, _ = blocks.pop()
            blocks.append([(g1 * n1 + g2 * n2) / (n1 + n2), n1 + n2, lo, hi])
    x = np.array([(b[2] + b[3]) / 2 for b in blocks])
    return x, np.array([b[0] for b in blocks])


def _fitted(data: tuple, part: int) -> tuple[Trees | None, np.ndarray]:
    """The trees fitted without fold ``part`` and their predictions for it; -1 leaves nothing out and predicts nothing."""
    texts, still, y, fold = data
    train, test = np.flatnonzero(fold != part), np.flatnonzero(fold == part)
    if part >= 0 and len(train) < 30:
        return None, np.full(len(test), y.mean())
    levels = vocabulary([texts[k] for k in train], y[train])
    table = lambda ks, own: np.hstack([still[ks], [difficulty(texts[k], levels, y[k] if own else None) for k in ks]])
    trees = Trees().fit(table(train, True), y[train])
    return trees, trees.predict(table(test, False)) if len(test) else np.empty(0)


def _fitted_in_tasks(spark: SparkSession, data: tuple, parts: list[int]) -> list[tuple[Trees | None, np.ndarray]]:
    """As :func:`_fitted`, each part in a task of its own."""
    shared = spark.sparkContext.broadcast(data)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "fitted": [pickle.dumps(_fitted(shared.value, parts[k])) for k in batch["id"]]})

    made = spark.range(0, len(parts), 1, len(parts)).mapInPandas(run, "id bigint, fitted binary").collect()
    return [pickle.loads(r["fitted"]) for r in sorted(made, key=lambda r: r["id"])]


class Grader:
    """Word levels, trees and calibration, fitted on labelled texts and checked source by source.

    ``checked`` has the calibrated prediction of each text by trees and a
    calibration that saw none of its fold's sources. With a session the models
    of the folds are fitted in tasks beside the whole one.
    """

    def __init__(self, rows: list[tuple[str, str | None, float]], folds: int = 4, spark: SparkSession | None = None):
        texts = [tokens(t) for t, _, _ in rows]
        keep = [k for k, w in enumerate(texts) if w]
        texts = [texts[k] for k in keep]
        y = np.array([rows[k][2] for k in keep], dtype=np.float64)
        self.sources = [rows[k][1] or "" for k in keep]
        self.y, self.ready = y, len(y) >= 40
        self.mean = float(y.mean()) if len(y) else None
        if not self.ready:
            return
        self.levels = vocabulary(texts, y)
        still = np.array([shape(rows[k][0], w) for k, w in zip(keep, texts)])
        names = sorted(set(self.sources))
        fold = np.array([names.index(s) % folds for s in self.sources])
        if len(set(fold.tolist())) < 2:
            fold = np.arange(len(y)) % folds
        data, parts = (texts, still, y, fold), [-1, *sorted(set(fold.tolist()))]
        (self.trees, _), *held = _fitted_in_tasks(spark, data, parts) if spark else [_fitted(data, p) for p in parts]
        self.held_out, self.checked = np.empty(len(y)), np.empty(len(y))
        for part, (_, predicted) in zip(parts[1:], held):
            self.held_out[fold == part] = predicted
        for part in parts[1:]:
            others = fold != part
            self.checked[~others] = np.interp(self.held_out[~others], *calibration(self.held_out[others], y[others]))
        self.points = calibration(self.held_out, y)

    def grades(self, texts: list[str | None]) -> list[float | None]:
        """Estimated grade of each text; texts without words (null, blank, figures only) have none."""
        words = [tokens(t) if t else [] for t in texts]
        at = [k for k, w in enumerate(words) if w]
        out: list[float | None] = [None] * len(texts)
        if at and self.ready:
            raw = self.trees.predict(np.array([features(texts[k], words[k], self.levels) for k in at]))
            smooth = np.interp(raw, *self.points)
            for k, g in zip(at, np.clip(smooth, 1, 5)):
                out[k] = float(g)
        elif at:
            for k in at:
                out[k] = self.mean
        return out


def labelled(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[tuple[str, str | None, float]]:
    """(text, source, mean grade) of at most ``sample`` graded texts, the first by a hash of the key."""
    graded = labels.where("grade is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("grade").alias("grade"))
    graded = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = documents.select("doc_id", "text", "source").join(F.broadcast(graded), "doc_id").where("text is not null")
    found = rows.select("doc_id", "text", "source", "grade").collect()
    return [(r[1], r[2], float(r[3])) for r in sorted(found, key=lambda r: r[0])]


def reading_levels(spark: SparkSession, documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, grade): estimated grade, 1 to 5, of each text; null where a text has no words.

    The model and those of the folds are fitted side by side in tasks from at most ``sample`` graded texts
    (their number is the bound of what is collected and broadcast) and applied
    to every whole text in one narrow pass. Repeated rows are graded each; with
    fewer than 40 graded texts every text gets their mean. Rows without an id are left out.
    """
    shared = spark.sparkContext.broadcast(Grader(labelled(documents, labels, sample), spark=spark))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            grades = shared.value.grades(batch["text"].tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "grade": pd.array(grades, dtype="Float64")})

    return documents.select("doc_id", "text").where("doc_id is not null").mapInPandas(run, "doc_id bigint, grade double")


def check_by_source(spark: SparkSession, documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(source, texts, mean_error, right): cross-validated error of the calibrated grades; neither trees nor calibration saw a source they grade."""
    model = Grader(labelled(documents, labels, sample), spark=spark)
    rows = []
    if model.ready:
        for s in sorted(set(model.sources)):
            mine = np.array([x == s for x in model.sources])
            error = np.abs(model.checked[mine] - model.y[mine])
            rows.append((s, int(mine.sum()), round(float(error.mean()), 4), round(float((error < 1).mean()), 4)))
    return spark.createDataFrame(rows, "source string, texts bigint, mean_error double, right double")
