"""Evaluation passages that have got into training texts, found by greedy string tiling."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemtext.llm.text import WORD, WordIds, composed, words

#: Words of a shared seed. A passage with at most one slip in SEED + 1 words keeps a seed whole.
SEED = 3
#: Words a match must have to become a tile.
TILE = 2
#: Share of a passage's words that a document must hold.
SHARE = 0.5
#: Part of that share which scattered held words must have of the passage's weight (rarity among the passages).
WEIGHT = 1.0
#: Words of a passage that a slip may take from a fragment that is still one run.
SLIP = 1
#: Words that slips may put between two tiles of one passage.
GAP = 4
#: Passages of one block; more passages are searched block by block.
BLOCK = 20_000
#: Documents whose seeds are looked up at once.
PART = 128
#: Counters of the words of all passages, by hash: a table of fixed size.
COUNTERS = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


def _grams(ids: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin style 64-bit hash of each run of ``size`` ids."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = (out * _MIX) ^ (ids[k : k + n].astype(np.uint64) + np.uint64(0x632BE5AB))
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out


def counter(word: str) -> int:
    """Counter of a word."""
    return zlib.crc32(word.encode()) & (COUNTERS - 1)


def counted(texts: list[str]) -> tuple[np.ndarray, int]:
    """(passages that hold a word, by its counter; passages with words)."""
    held_ = [{counter(w) for w in words(t)} for t in texts]
    return np.bincount([c for h in held_ for c in h], minlength=COUNTERS), sum(map(bool, held_))


class Passages:
    """Passages as word ids with an index of their seeds.

    ``seen`` and ``total`` tell how common each word is among all passages;
    without them these passages are all.
    """

    def __init__(self, rows: list[tuple[int, str]], seed: int = SEED, seen: np.ndarray | None = None, total: int | None = None):
        self.known: dict[str, int] = {}
        self.item: list[int] = []
        self.ids: list[np.ndarray] = []
        for item, text in rows:
            found = words(text)
            if found:
                self.item.append(item)
                self.ids.append(np.array([self.known.setdefault(w, len(self.known) + 1) for w in found], dtype=np.int64))
        self.size = np.array([len(x) for x in self.ids], dtype=np.int64)
        self.pairs = [_pairs(x) for x in self.ids]
        self.rolled = [_rolling(x.tolist(), TILE) for x in self.ids]
        if seen is None:
            seen, total = counted([text for _, text in rows])
        at = np.array([0] + [counter(w) for w in self.known], dtype=np.int64)
        self.weight = np.log((total + 1) / np.maximum(seen[at], 1))
        keys, which, place = [], [], []
        self.seed = seed
        for k, ids in enumerate(self.ids):
            h = _grams(ids, min(seed, len(ids)))
            if len(ids) >= seed:
                keys.append(h)
                which.append(np.full(len(h), k))
                place.append(np.arange(len(h)))
        if keys:
            key, which_, place_ = np.concatenate(keys), np.concatenate(which), np.concatenate(place)
            order = np.argsort(key, kind="stable")
            self.key, self.which, self.place = key[order], which_[order], place_[order]
        else:
            self.key, self.which, self.place = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.short: dict[tuple[int, ...], list[int]] = defaultdict(list)
        for k, x in enumerate(self.ids):
            if len(x) < seed:
                self.short[tuple(x.tolist())].append(k)


def _rolling(ids: list[int], size: int) -> list[int]:
    """Karp-Rabin hash of each run of ``size`` ids, rolled from one run to the next."""
    if len(ids) < size:
        return []
    out, value, leaving = [], 0, pow(_BASE, size, _PRIME)
    for n, x in enumerate(ids):
        value = (value * _BASE + x - (ids[n - size] * leaving if n >= size else 0)) % _PRIME
        if n >= size - 1:
            out.append(value)
    return out


def tiles(a: np.ndarray, b: np.ndarray, least: int = TILE, hashes: tuple[list[int], list[int]] | None = None) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two id arrays: (start in a, start in b, length), longest first.

    The runs of ``least`` ids are found by their rolling Karp-Rabin hashes,
    once (``hashes`` gives them where they are known). Each round compares the unmarked ones id by id as far as they go,
    takes the longest non-overlapping common runs as tiles and marks them.
    """
    la, lb = a.tolist(), b.tolist()
    marked_a, marked_b = bytearray(len(la)), bytearray(len(lb))
    found: list[tuple[int, int, int]] = []
    where = defaultdict(list)
    of_a, of_b = hashes or (_rolling(la, least), _rolling(lb, least))
    for j, h in enumerate(of_b):
        where[h].append(j)
    starts = [(i, where[h]) for i, h in enumerate(of_a) if la[i] and h in where]
    while True:
        best, matches = least, []
        for i, places in starts:
            if marked_a[i]:
                continue
            for j in places:
                if marked_b[j] or (i and j and la[i - 1] == lb[j - 1] and not marked_a[i - 1] and not marked_b[j - 1]):
                    continue
                k = 0
                while i + k < len(la) and j + k < len(lb) and la[i + k] == lb[j + k] and not marked_a[i + k] and not marked_b[j + k]:
                    k += 1
                if k > best:
                    best, matches = k, [(i, j, k)]
                elif k == best:
                    matches.append((i, j, k))
        if not matches:
            return found
        for i, j, k in matches:
            if not any(marked_a[i : i + k]) and not any(marked_b[j : j + k]):
                marked_a[i : i + k] = marked_b[j : j + k] = b"\1" * k
                found.append((i, j, k))


def held(item: np.ndarray, part: np.ndarray, gap: int = GAP) -> np.ndarray:
    """Mask of the words of ``item`` that ``part`` holds in their order, slips aside."""
    return held_and_tiled(item, part, gap)[0]


def held_and_tiled(item: np.ndarray, part: np.ndarray, gap: int = GAP, hashes: tuple[list[int], list[int]] | None = None) -> tuple[np.ndarray, int, int]:
    """Mask of the words of ``item`` that ``part`` holds in their order, slips aside, how many of them are in tiles, and in how many.

    The tiles are chained in order in both texts (heaviest chain), with at most
    ``gap`` words of the passage and twice as many added ones between two of
    them. Words there that no passage knows (id 0) stand for misspelt words of
    the passage and count.
    """
    mask = np.zeros(len(item), bool)
    chain = sorted(tiles(item, part, TILE, hashes))
    if not chain:
        return mask, 0, 0
    best: list[int] = []
    back: list[tuple[int, int]] = []
    for n, (i, j, k) in enumerate(chain):
        score, step = k, (-1, 0)
        for m in range(n):
            pi, pj, pk = chain[m]
            di, dj = i - pi - pk, j - pj - pk
            if 0 <= di <= gap and 0 <= dj <= 2 * gap:
                slips = min(di, part[pj + pk : j].tolist().count(0))
                if best[m] + k + slips > score:
                    score, step = best[m] + k + slips, (m, slips)
        best.append(score)
        back.append(step)
    n, tiled, number = max(range(len(best)), key=best.__getitem__), 0, 0
    _reach(item, part, chain[n][0] + chain[n][2], chain[n][1] + chain[n][2], 1, gap, mask)
    while n >= 0:
        if back[n][0] < 0:
            _reach(item, part, chain[n][0] - 1, chain[n][1] - 1, -1, gap, mask)
        i, _, k = chain[n]
        mask[i : i + k] = True
        tiled, number = tiled + k, number + 1
        m, slips = back[n]
        if m >= 0:
            end = chain[m][0] + chain[m][2]
            mask[end : end + slips] = True
        n = m
    return mask, tiled, number


def _covered(item: np.ndarray, part: np.ndarray, least: int = SEED) -> int:
    """Words of ``item`` in tiles of ``least`` words or more, whatever their order."""
    return sum(k for _, _, k in tiles(item, part, least))


def _reach(item: np.ndarray, part: np.ndarray, i: int, j: int, step: int, gap: int, mask: np.ndarray) -> None:
    """Carry the mask over misspelt words at an end of the chain as far as a word beyond them agrees again."""
    for far in range(gap):
        a, b = i + step * far, j + step * far
        if not (0 <= a < len(item) and 0 <= b < len(part)) or (part[b] != item[a] and part[b] != 0):
            return
        if part[b] == item[a]:
            mask[min(i, a) : max(i, a) + 1] = True


def _run(mask: np.ndarray, slip: int = SLIP) -> int:
    """Most held words of one run: at most ``slip`` words that are not held between two of them."""
    at = np.flatnonzero(mask)
    if not len(at):
        return 0
    return int(max(len(part) for part in np.split(at, np.flatnonzero(np.diff(at) > slip + 1) + 1)))


def _bound(item: np.ndarray, part: np.ndarray) -> int:
    """At most so many words can be held: those in shared word pairs, and two for each unknown word."""
    return _inside(_pairs(item), _pairs(part)) + 2 * int((part == 0).sum())


def _pairs(ids: np.ndarray) -> list[int]:
    """Each two neighbouring ids as one number."""
    return ((ids[:-1] << 32) | ids[1:]).tolist()


def _inside(pairs: list[int], of_part: list[int]) -> int:
    """Words in pairs that are also in the other list."""
    shared = set(of_part)
    inside, before = 0, False
    for pair in pairs:
        now = pair in shared
        inside += 1 if now and before else 2 if now else 0
        before = now
    return inside


def _scan(passages: Passages, texts: list[str | None], memo: WordIds, share: float, gap: int, ordered: bool = True) -> Iterator[tuple[int, int]]:
    """(place in the batch, passage) of every text that holds enough of a passage."""
    arrays, ends, total = [], [], 0
    for text in texts:
        ids = [memo[w] for w in WORD.findall(composed(text))] if text else []
        arrays.append(np.array(ids + [0] * passages.seed, dtype=np.int64))
        total += len(arrays[-1])
        ends.append(total)
    if not arrays:
        return
    flat, ends_ = np.concatenate(arrays), np.array(ends, dtype=np.int64)
    if passages.short:
        for size in {len(t) for t in passages.short}:
            for d, ids in enumerate(arrays):
                seen = ids.tolist()
                for run in {tuple(seen[i : i + size]) for i in range(len(seen) - size + 1)} & passages.short.keys():
                    yield from ((d, p) for p in passages.short[run])
    grams = _grams(flat, passages.seed)
    lo = np.searchsorted(passages.key, grams, "left")
    hi = np.searchsorted(passages.key, grams, "right")
    at = np.flatnonzero(hi > lo)
    if not len(at):
        return
    count = (hi - lo)[at]
    spot = np.repeat(at, count)
    entry = np.repeat(lo[at], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    which, place = passages.which[entry], passages.place[entry]
    doc = np.searchsorted(ends_, spot, "right")
    start = spot - np.where(doc > 0, ends_[doc - 1], 0) - place  # diagonal: where the passage would begin
    order = np.lexsort((start, which, doc))
    doc, which, place, start = doc[order], which[order], place[order], start[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (which[1:] != which[:-1]) | (start[1:] - start[:-1] > gap)
    group = np.cumsum(new) - 1
    # distinct seed places of a group, a lower bound of the words it can share
    key = group * (int(passages.size.max()) + 1) + place
    key.sort()
    distinct = np.bincount(key[np.r_[True, key[1:] != key[:-1]]] // (int(passages.size.max()) + 1), minlength=group[-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    done: set[tuple[int, int]] = set()
    pairs: dict[int, list[int]] = {}
    rolled: dict[int, list[int]] = {}
    need = np.ceil(share * passages.size[which[first]])
    # of n words with at most one slip in seed + 1, at least n / (seed + 1) seeds stand whole, but for the first slip's
    for g in np.flatnonzero(distinct >= np.maximum(1, need / (passages.seed + 1) - passages.seed + 1)):
        d, p = int(doc[first[g]]), int(which[first[g]])
        if (d, p) in done:
            continue
        size = int(passages.size[p])
        margin = size // 4 + gap
        a, b = int(start[first[g]]) - margin, int(start[last[g]]) + size + margin
        part = arrays[d][max(0, a) : max(0, b)]
        if not ordered:
            if _covered(passages.ids[p], arrays[d]) >= share * size:
                done.add((d, p))
                yield d, p
            continue
        if d not in pairs:
            pairs[d], rolled[d] = _pairs(arrays[d]), _rolling(arrays[d].tolist(), TILE)
        # of the held words all but the slips, one in seed + 1, are in tiles and so in shared pairs
        inside = _inside(passages.pairs[p], pairs[d][max(0, a) : max(0, b - 1)])
        if inside * (passages.seed + 1) < share * size * passages.seed - passages.seed or inside + 2 * (len(part) - np.count_nonzero(part)) < share * size:
            continue
        mask, tiled, number = held_and_tiled(passages.ids[p], part, gap, (passages.rolled[p], rolled[d][max(0, a) : max(0, b - TILE + 1)]))
        # more slips, or breaks between tiles, than one in seed + 1 words, one at an end aside
        if max(mask.sum() - tiled, number - 1) * (passages.seed + 1) > mask.sum() + passages.seed:
            continue
        weight = passages.weight[passages.ids[p]]
        # scattered coincidences are made of words that every passage has: unless one run is enough, the held words must weigh something too
        if mask.sum() >= share * size and (_run(mask) >= share * size or weight[mask].sum() >= WEIGHT * share * weight.sum()):
            done.add((d, p))
            yield d, p


def passage_counts(items: DataFrame, texts: tuple[str, ...]) -> tuple[np.ndarray, int]:
    """(passages that hold a word, by its counter; passages with words) over all items: at most COUNTERS rows are collected."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, total = np.zeros(COUNTERS, np.int64), 0
        for batch in batches:
            seen, n = counted([t for c in texts for t in batch[c] if isinstance(t, str)])
            sums, total = sums + seen, total + n
        at = np.flatnonzero(sums)
        yield pd.DataFrame({"counter": np.append(at, -1), "n": np.append(sums[at], total)})

    seen, total = np.zeros(COUNTERS, np.int64), 0
    for at, n in items.select(*texts).mapInPandas(run, "counter bigint, n bigint").groupBy("counter").agg(F.sum("n")).toLocalIterator():
        if at < 0:
            total = n
        else:
            seen[at] = n
    return seen, total


def leaked_items(
    spark: SparkSession,
    documents: DataFrame,
    items: DataFrame,
    texts: tuple[str, ...] = ("french", "moore", "english"),
    share: float = SHARE,
    seed: int = SEED,
    gap: int = GAP,
    block: int = BLOCK,
    ordered: bool = True,
) -> DataFrame:
    """(doc_id, item_id): documents that hold at least ``share`` of the words of one of an item's texts.

    They must stand in the passage's order, slips and a few added words aside;
    unless ``ordered``, tiles of SEED words or more count in whatever order.

    The held-out items are the query set: they stream to the driver in blocks
    of ``block`` passages, each block is broadcast with the index of its seeds,
    and every document is scanned whole in one narrow pass per block. Seeds
    shared on neighbouring diagonals nominate a passage; greedy string tiling
    of the passage with that stretch decides. Every passage with at most one
    slip in ``seed`` + 1 words is nominated. How common a word is among the
    passages is counted over all items, so blocks and their order change
    nothing. Null and empty texts hold
    nothing; each repeated document is a case of its own; passages shorter than
    a seed must occur whole. Duplicated item rows give one pair;
    rows without an id are left out.
    """
    found: DataFrame | None = None
    rows: list[tuple[int, str]] = []
    seen, total = passage_counts(items.where("item_id is not null"), texts)

    def scan(rows: list[tuple[int, str]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(Passages(rows, seed, seen, total))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            passages = shared.value
            memo = WordIds(passages.known)
            for batch in batches:
                keys, bodies = batch["doc_id"].to_numpy(), batch["text"].tolist()
                parts = range(0, len(bodies), PART)
                pairs = {(keys[k + d], passages.item[p]) for k in parts for d, p in _scan(passages, bodies[k : k + PART], memo, share, gap, ordered)}
                yield pd.DataFrame(sorted(pairs), columns=["doc_id", "item_id"]).astype("int64")

        return documents.select("doc_id", "text").where("text is not null and doc_id is not null").mapInPandas(run, "doc_id bigint, item_id bigint")

    for row in items.select("item_id", *texts).toLocalIterator():
        rows += [(row[0], t) for t in row[1:] if t and row[0] is not None]
        if len(rows) >= block:
            part = scan(rows)
            found, rows = part if found is None else found.union(part), []
    if rows or found is None:
        part = scan(rows)
        found = part if found is None else found.union(part)
    return found.distinct()
