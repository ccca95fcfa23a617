"""Pairs of sentences that translate one another in bilingual documents."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemtext.llm.text import WORD, composed, plain_word
from tandemtext.session import cut_lineage, spread

#: Dimensions of the vectors, a multiple of 64.
DIM = 192
#: Vector rows of a language. Words are hashed into them, so every word has one and the tables have a fixed size.
BUCKETS = 1 << 16
#: Passes of training after the first.
REFINED = 1
#: Windows a word must occur in for its vector to mean something; rarer words are known by their spelling.
LEAST_WINDOWS = 4
#: Leading components that the vectors of a language share and that are taken off.
COMMON = 4
#: Rows a side that seeds of the rotation are sought among, the most frequent.
SEEDED = 4000
#: Share of the shorter sentence that its counterpart must hold, on the path and in the rematch beside it.
PATH_LEAST, REMATCH_LEAST = 0.55, 0.65
#: Most that one word weighs in its sentence.
WEIGHT_MOST = 5.0
#: Half width of the band around the coarser path, and length below which a problem is solved whole.
RADIUS, WHOLE = 4, 12
#: Documents, and words, that a task handles at once.
PART, BLOCK = 64, 1 << 16
#: Words with a letter that a sentence must have; shorter elements are page marks and the like.
LEAST_WORDS = 3
SIDES = ("french", "moore")


class Spellings(dict):
    """Raw word -> (31-bit hash of its plain form, whether it is a real word); emptied at ``limit`` entries."""

    def __init__(self, limit: int = 1_000_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> tuple[int, bool]:
        if len(self) >= self.limit:
            self.clear()
        plain = plain_word(word)
        found = self[word] = (zlib.crc32(plain.encode()) & 0x7FFFFFFF, len(plain) > 1 and not plain.isdigit())
        return found


def spoken(sentence: str | None, memo: Spellings) -> list[int]:
    """Distinct word ids of an element; none for null, blank and stray elements (fewer than LEAST_WORDS real words)."""
    if not isinstance(sentence, str):
        return []
    found = [memo[w] for w in WORD.findall(composed(sentence))]
    return list(dict.fromkeys(x for x, _ in found)) if sum(real for _, real in found) >= LEAST_WORDS else []


def worded(documents: DataFrame, key: str) -> DataFrame:
    """(key, ids and lens of each side): word ids of all elements end to end, and how many each element has."""
    names = [f"{side}_{part}" for side in SIDES for part in ("ids", "lens")]
    schema = f"`{key}` {documents.schema[key].dataType.simpleString()}, " + ", ".join(f"{n} array<int>" for n in names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = Spellings()
        for batch in batches:
            out: dict[str, list] = {key: batch[key], **{n: [] for n in names}}
            for side in SIDES:
                for elements in batch[side]:
                    found = [spoken(e, memo) for e in (elements if elements is not None else ())]
                    out[f"{side}_ids"].append([x for words in found for x in words])
                    out[f"{side}_lens"].append([len(words) for words in found])
            yield pd.DataFrame(out)

    return documents.select(key, *SIDES).mapInPandas(run, schema)


def signs(numbers: np.ndarray) -> np.ndarray:
    """A random direction of unit length for each 64-bit number, the same wherever it is asked for."""
    out = []
    with np.errstate(over="ignore"):
        for k in range(DIM // 64):
            x = numbers.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & 0xFFFFFFFFFFFFFFFF)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
            out.append((x ^ (x >> np.uint64(31))).view(np.uint8).reshape(len(x), 8))
    bits = np.unpackbits(np.concatenate(out, axis=1), axis=1) if len(numbers) else np.zeros((0, DIM), np.uint8)
    return (bits.astype(np.float32) * 2 - 1) / np.float32(math.sqrt(DIM))


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def _flat(arrays: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """All values end to end, and how many each row has."""
    parts = [np.asarray(a, dtype=np.int64) for a in arrays]
    return np.concatenate(parts) if parts else np.empty(0, np.int64), np.array([len(p) for p in parts], dtype=np.int64)


def rotation(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Orthogonal matrix that turns the rows of ``x`` onto those of ``y`` (Procrustes).

    The windows of both languages are the same, so the spaces lie near one
    another; seeds missing to two a dimension are made up by weight on the
    identity, a trace at least, so that directions no seed speaks for keep their
    place. The matrix is the orthogonal polar factor of the product of the
    seeds, found by scaled Newton steps, which need no singular values.
    """
    missing = max(0.01, 2 * DIM - len(x))
    turn = x.T.astype(np.float64) @ y.astype(np.float64) + missing * np.eye(x.shape[1])
    if not np.isfinite(turn).all():
        raise FloatingPointError("a seed vector is not finite")
    for _ in range(100):
        inverse = np.linalg.inv(turn).T
        scale = math.sqrt(np.linalg.norm(inverse) / np.linalg.norm(turn))
        before, turn = turn, (scale * turn + inverse / scale) / 2
        if np.linalg.norm(turn - before) < 1e-12 * len(turn):
            break
    return turn


class Vectors:
    """Vectors of the hashed words of both languages: row ``side * BUCKETS + bucket``."""

    def __init__(self, rows: pd.DataFrame):
        own = rows[rows["row"] >= 0]
        whole = rows[rows["row"] < 0]
        self.total = int(whole["windows"].iloc[0]) if len(whole) else 0
        mean = np.frombuffer(whole["vector"].iloc[0], np.float32) / max(1, self.total) if len(whole) else np.zeros(DIM, np.float32)
        self.place = np.full(2 * BUCKETS, -1, dtype=np.int64)
        self.place[own["row"].to_numpy(np.int64)] = np.arange(len(own))
        self.windows = own["windows"].to_numpy(np.int64)
        self.side = own["row"].to_numpy(np.int64) // BUCKETS
        self.bucket = own["row"].to_numpy(np.int64) % BUCKETS
        matrix = np.frombuffer(b"".join(own["vector"]), np.float32).reshape(len(own), DIM)
        self.matrix = unit(matrix - self.windows[:, None].astype(np.float32) * mean)
        self.often = self.windows >= LEAST_WINDOWS
        self._strip()
        sentences = own["sentences"].to_numpy(np.float64)
        spoken_ = np.array([whole["sentences"].iloc[0] / 2 if len(whole) else 1.0] * 2)
        self.weight = np.minimum(WEIGHT_MOST, np.log((spoken_[self.side] + 1) / np.maximum(sentences, 1))).clip(0).astype(np.float32)

    def _strip(self) -> None:
        """Take off what all vectors of a side share: their mean and the COMMON leading components (style, not sense)."""
        for s in (0, 1):
            own = self.side == s
            often = own & self.often
            if not often.any():
                continue
            rows = self.matrix[own] - self.matrix[often].mean(axis=0)
            _, axes = np.linalg.eigh(np.cov((self.matrix[often] - self.matrix[often].mean(axis=0)).T.astype(np.float64), bias=True))
            top = axes[:, -COMMON:].astype(np.float32)
            self.matrix[own] = unit(rows - (rows @ top) @ top.T)

    def rotate(self) -> int:
        """Orthogonal Procrustes: turn the French vectors onto the Moore ones by seed pairs; how many there were.

        Seeds are words spelt alike in both languages (names, figures) and
        mutual nearest words among the SEEDED most frequent of each side.
        """
        sides = [np.flatnonzero((self.side == s) & self.often) for s in (0, 1)]
        a, b = (s[np.argsort(-self.windows[s], kind="stable")[:SEEDED]] for s in sides)
        if not len(a) or not len(b):
            return 0
        near = self.matrix[a] @ self.matrix[b].T
        forward, backward = near.argmax(axis=1), near.argmax(axis=0)
        mutual = [(x, b[y]) for x, y, back in zip(a, forward, backward[forward] == np.arange(len(a))) if back]
        alike = self.place[BUCKETS + self.bucket[a]]
        pairs = np.array([(x, y) for x, y in zip(a, alike) if y >= 0 and self.often[y]] + mutual).reshape(-1, 2)
        turn = rotation(self.matrix[pairs[:, 0]], self.matrix[pairs[:, 1]])
        first = self.side == 0
        self.matrix[first] = (self.matrix[first] @ turn).astype(np.float32)
        return len(pairs)

    @cached_property
    def weighted(self) -> np.ndarray:
        return self.matrix * self.weight[:, None]

    def look(self, side: int, ids: np.ndarray) -> np.ndarray:
        """Vectors of word ids by their weights; a rare word has the direction of its spelling, the same on both sides."""
        at = self.place[side * BUCKETS + (ids & (BUCKETS - 1))]
        if not len(self.often):
            return signs(ids) * np.float32(WEIGHT_MOST)
        vectors = self.weighted[at]
        rare = np.flatnonzero((at < 0) | ~self.often[at])
        if len(rare):
            vectors[rare] = signs(ids[rare]) * np.float32(WEIGHT_MOST)
        return vectors

    def sentences(self, side: int, ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Vector of each sentence: the sum of its words' vectors. No element may be empty."""
        return np.add.reduceat(self.look(side, ids), np.cumsum(lens) - lens, axis=0)


def _gradient(words: DataFrame, windows: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    """(row, windows, sentences, vector): what the words of every row of the vectors are drawn to, over all documents.

    ``windows`` gives the windows of a batch: the sum of the output vectors of
    each one's words, and the (window, row) pairs of these words. Line -1 sums
    all windows. Each task adds up its documents in tables of fixed size and
    hands on one line a row, so a word that every document has costs one line
    a task; the lines of a row are then added as they stream in.
    """
    schema = "row int, windows bigint, sentences bigint, vector binary"
    size = 2 * BUCKETS + 1

    def lines(totals: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        at = np.flatnonzero(counts.any(axis=1))
        return pd.DataFrame({"row": np.where(at == size - 1, -1, at).astype(np.int32), "windows": counts[at, 0], "sentences": counts[at, 1], "vector": [v.tobytes() for v in totals[at]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals, counts = np.zeros((size, DIM), np.float32), np.zeros((size, 2), np.int64)
        for batch in (whole[k : k + PART] for whole in batches for k in range(0, len(whole), PART)):
            for s, side in enumerate(SIDES):
                ids, _ = _flat(batch[f"{side}_ids"])
                counts[:, 1] += np.bincount(s * BUCKETS + (ids & (BUCKETS - 1)), minlength=size)
                counts[-1, 1] += sum(int(np.count_nonzero(x)) for x in batch[f"{side}_lens"])
            sums, window, row = windows(batch)
            if not len(row):
                continue
            totals[-1] += sums.sum(axis=0)
            counts[-1, 0] += len(sums)
            order = np.argsort(row, kind="stable")
            _add_up(sums, window[order], row[order], totals)
            counts[:, 0] += np.bincount(row, minlength=size)
        yield lines(totals, counts)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals, counts = np.zeros((size, DIM), np.float32), np.zeros((size, 2), np.int64)
        for batch in batches:
            for row, *count, vector in batch.itertuples(index=False):
                totals[row] += np.frombuffer(vector, np.float32)
                counts[row] += count
        yield lines(totals, counts)

    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return words.mapInPandas(run, schema).repartition(parts, "row").mapInPandas(add, schema)


def _add_up(rows: np.ndarray, taken: np.ndarray, owner: np.ndarray, out: np.ndarray) -> None:
    """Add ``rows[taken]`` to ``out[owner]``, block by block; ``owner`` is ascending."""
    for k in range(0, len(owner), BLOCK):
        own = owner[k : k + BLOCK]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        out[own[first]] += np.add.reduceat(rows[taken[k : k + BLOCK]], first, axis=0)


def _windows(words: np.ndarray, window: np.ndarray, weigh: Callable[[np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of the output vectors of each window's words, and the (window, row) pairs.

    A word is its id with the side above it; ``window`` ascends and ``weigh``
    gives the weights of rows.
    """
    forms, at = np.unique(words, return_inverse=True)
    rows = (forms >> 31) * BUCKETS + (forms & (BUCKETS - 1))
    outputs = signs(forms & 0x7FFFFFFF)
    if weigh is not None:
        outputs *= weigh(rows)[:, None]
    window = np.cumsum(np.r_[0, window[1:] != window[:-1]]) if len(window) else window
    sums = np.zeros((int(window[-1]) + 1 if len(window) else 0, DIM), np.float32)
    _add_up(outputs, at, window, sums)
    return sums, window, rows[at]


def document_windows(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A window for each document: the distinct words of both sides."""
    keys = []
    for s, side in enumerate(SIDES):
        ids, sizes = _flat(batch[f"{side}_ids"])
        keys.append(np.repeat(np.arange(len(batch)), sizes) << 32 | s << 31 | ids)
    pairs = np.unique(np.concatenate(keys))
    return _windows(pairs & 0xFFFFFFFF, pairs >> 32)


def linked_windows(batch: pd.DataFrame, vectors: Vectors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A window for each pair of sentences that the present vectors link: the words of both."""
    parts, sizes = [np.empty(0, np.int64)], []
    for fi, fl, mi, ml in zip(*(batch[f"{side}_{part}"] for side in SIDES for part in ("ids", "lens"))):
        links = align(vectors, (fi, fl), (mi, ml))
        if links:
            fi, mi = np.asarray(fi, np.int64), np.asarray(mi, np.int64) | 1 << 31
            ends = np.cumsum(fl), np.cumsum(ml)
            for i, j, _ in links:
                parts += [fi[ends[0][i] - fl[i] : ends[0][i]], mi[ends[1][j] - ml[j] : ends[1][j]]]
                sizes.append(fl[i] + ml[j])
    return _windows(np.concatenate(parts), np.repeat(np.arange(len(sizes)), sizes), lambda rows: vectors.weight[vectors.place[rows]])


def trained(spark: SparkSession, words: DataFrame) -> Vectors:
    """Skip-gram vectors with negative sampling, fitted on all documents.

    A word is to tell the words of its window, on both sides. The output
    vectors are frozen random directions, one for each spelling; then the
    gradient of the loss from a standing start is a sum over all windows, the
    negative samples taken at their mean, and a step is one pass over the data.
    The window of the first pass is the whole bilingual document; that of each
    further one is a sentence with the sentence that the vectors so far link
    to it, and frequent output words count less there, as in subsampling. After each
    pass Procrustes turns the French vectors onto the Moore ones. Tables of
    2 * BUCKETS rows are all that is sent, whatever the corpus holds.
    """

    def collected(frame: DataFrame) -> Vectors:
        vectors = Vectors(frame.toPandas())
        vectors.rotate()
        return vectors

    vectors = collected(_gradient(words, document_windows))
    for _ in range(REFINED):
        shared = spark.sparkContext.broadcast(vectors)
        vectors = collected(_gradient(words, lambda batch, shared=shared: linked_windows(batch, shared.value)))
    return vectors


def _coarser(rows: np.ndarray) -> np.ndarray:
    """Every two neighbouring sentences as one."""
    return np.add.reduceat(rows, np.arange(0, len(rows), 2), axis=0)


def _square(rows: np.ndarray) -> np.ndarray:
    return np.maximum(np.einsum("ij,ij->i", rows, rows), 1e-9)


def warp(a: np.ndarray, b: np.ndarray, least: float = PATH_LEAST) -> list[tuple[int, int, float]]:
    """(first, second, share) of the sentences linked on the best monotone path, found from coarse to fine.

    The path of the halved problem bounds the finer one: likenesses are made
    within its band only, so the work grows with the length and not with its
    square. A step takes a sentence of both sides, or one of a side that joins
    the other side's last sentence or has no counterpart (at the cost of a link
    just too weak).
    """
    return [(i, j, s) for i, j, s in _path(a, b, least) if s >= least]


def _path(a: np.ndarray, b: np.ndarray, least: float) -> list[tuple[int, int, float]]:
    n, m = len(a), len(b)
    if min(n, m) <= WHOLE:
        low, high = [0] * n, [m] * n
    else:
        low, high = [m] * n, [0] * n
        for i, j, _ in _path(_coarser(a), _coarser(b), least):
            for r in range(max(0, 2 * i - RADIUS), min(n, 2 * i + 2 + RADIUS)):
                low[r], high[r] = min(low[r], max(0, 2 * j - RADIUS)), max(high[r], min(m, 2 * j + 2 + RADIUS))
        for i in range(n):  # the band is one piece from corner to corner
            low[i] = 0 if i == 0 else min(low[i], high[i - 1])
            high[i] = max(high[i], low[i] + 1, high[i - 1] if i else 0)
        high[-1] = m
        for i in range(n - 2, -1, -1):
            low[i] = min(low[i], low[i + 1])
            high[i] = max(high[i], low[i + 1] + 1)
    gap, far = 1.0 - least, math.inf
    sizes = _square(a), _square(b)
    like = [np.minimum(1.0, b[low[i] : high[i]] @ a[i] / np.minimum(sizes[0][i], sizes[1][low[i] : high[i]])).tolist() for i in range(n)]
    # before[j - low]: best cost with the sentences before i of one side and before j of the other taken
    steps: list[list[int]] = []
    above, above_low = [gap * j for j in range(high[0] + 1)], 0
    for i in range(n):
        start, row, own, step = low[i], [far] * (high[i] - low[i] + 1), like[i], []
        upto = above_low + len(above)
        row[0] = above[start - above_low] + gap if start < upto else far
        for k in range(high[i] - start):
            j = start + k
            cost = 1.0 - own[k]
            weak = cost if cost < gap else gap
            best, kind = (above[j - above_low] + cost, 0) if j < upto else (far, 0)
            if j + 1 < upto and above[j + 1 - above_low] + weak < best:
                best, kind = above[j + 1 - above_low] + weak, 1
            if row[k] + weak < best:
                best, kind = row[k] + weak, 2
            row[k + 1] = best
            step.append(kind)
        steps.append(step)
        above, above_low = row, start
    out, i, j = [], n - 1, m - 1
    while i >= 0 and j >= 0:
        k = j - low[i]
        if k < 0:
            i -= 1
            continue
        out.append((i, j, like[i][k]))
        kind = steps[i][k]
        i, j = i - (kind != 2), j - (kind != 1)
    return out[::-1]


def rematch(a: np.ndarray, b: np.ndarray, links: dict[tuple[int, int], float], least: float = REMATCH_LEAST) -> None:
    """Give each sentence that the path left unaligned its most alike one anywhere, if alike enough: moved sentences."""
    for one, other, turned in ((a, b, False), (b, a, True)):
        taken = {j if turned else i for i, j in links}
        open_ = [i for i in range(len(one)) if i not in taken]
        for part in np.array_split(np.array(open_, dtype=np.int64), len(open_) // 256 + 1):
            like = np.minimum(1.0, one[part] @ other.T / np.minimum(_square(one[part])[:, None], _square(other)))
            for i, j, s in zip(part.tolist(), like.argmax(axis=1).tolist(), like.max(axis=1).tolist()):
                if s >= least:
                    links[(j, i) if turned else (i, j)] = s


def align(vectors: Vectors, first: tuple, second: tuple) -> list[tuple[int, int, float]]:
    """(first_no, second_no, score) of the elements that translate one another; a side is (word ids, words of each element)."""
    sides = []
    for s, (ids, lens) in enumerate((first, second)):
        lens = np.asarray(lens if lens is not None else (), dtype=np.int64)
        at = np.flatnonzero(lens)
        if not len(at):
            return []
        sides.append((at, vectors.sentences(s, np.asarray(ids, dtype=np.int64), lens[at])))
    (at_a, a), (at_b, b) = sides
    links = {(i, j): s for i, j, s in warp(a, b)}
    rematch(a, b, links)
    return [(int(at_a[i]), int(at_b[j]), round(float(s), 4)) for (i, j), s in sorted(links.items())]


def sentence_pairs(spark: SparkSession, documents: DataFrame, key: str = "pt_id") -> DataFrame:
    """(key, french_no, moore_no, score): translated elements of each document, 0-based places in the arrays as stored.

    ``documents`` has one row per key; rows without one are left out. The
    word ids of all documents are written to a checkpoint once; skip-gram
    vectors are trained on them (see ``trained``) and the French ones turned
    onto the Moore ones; then each document is aligned by itself: the warping
    path links what keeps its order, joined and divided sentences included, and
    what it leaves unaligned is matched again without order. Null arrays and
    null, blank or stray elements have no counterpart. Vectors of all words
    are broadcast in two tables of BUCKETS rows (at most 100 MB).
    """
    words = cut_lineage(worded(spread(documents.where(F.col(key).isNotNull())), key))
    shared = spark.sparkContext.broadcast(trained(spark, words))
    schema = f"`{key}` {documents.schema[key].dataType.simpleString()}, french_no int, moore_no int, score double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            columns = [batch[f"{side}_{part}"] for side in SIDES for part in ("ids", "lens")]
            out = [(k, *link) for k, fi, fl, mi, ml in zip(batch[key], *columns) for link in align(shared.value, (fi, fl), (mi, ml))]
            yield pd.DataFrame(out, columns=[key, "french_no", "moore_no", "score"])

    return words.mapInPandas(run, schema)
