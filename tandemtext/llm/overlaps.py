"""Same or near-same records across the splits of a corpus."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cached_property
from hashlib import blake2b
from itertools import islice

import ahocorasick
import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemtext.llm.text import PlainWords
from tandemtext.session import stored

#: One word in so many may differ.
EVERY = 5
#: Candidates of one shard of automata.
SHARD = 2_000
#: Evaluation classes of one index, which the driver sorts, and indexes that a worker searches at once (about 50 MB each).
BLOCK, TOGETHER = 250_000, 4
#: Texts of more words are keyed by runs of GRAM words, others by sets of words.
LONG, GRAM = 50, 4
#: Most words (or runs) of a key.
DEPTH = 4
#: Key and candidate pairs that are compared at once.
AT_ONCE = 1_000_000
#: Layout of a code: rarity (quarters of a bit, counted down, so that rare words sort first) above LOW bits of hash.
LOW, TOP = 54, 255
#: Rarity is told apart up to one text in 2 ** SEEN.
SEEN = 14


def limit(n: int, every: int = EVERY) -> int:
    """Words that may differ between texts of which the longer has ``n`` words."""
    return n // every


def pieces(tokens: list[str], weight: list[float], every: int = EVERY) -> list[str]:
    """Passages of a text, one of which stands unchanged in every text within the limit.

    With up to d edits, one of d + 1 consecutive pieces stays whole. d is the
    limit of the longest text still within reach (n + d words). The cuts give
    each piece, of one word or more, about the same total ``weight``
    (rarity), so that no piece consists of words that every text has.
    """
    n = len(tokens)
    count = n // (every - 1) + 1
    total, run, cuts = sum(weight) or 1.0, 0.0, [0]
    for k, w in enumerate(weight):
        run += w
        left, open_ = n - k - 1, count - len(cuts)
        if open_ and (left == open_ or (left > open_ and run >= total * len(cuts) / count)):
            cuts.append(k + 1)
    cuts.append(n)
    return [" ".join(tokens[a:b]) for a, b in zip(cuts, cuts[1:])]


def within(a: list[str], b: list[str], most: int) -> bool:
    """Whether ``a`` becomes ``b`` by at most ``most`` word edits (banded Levenshtein)."""
    if abs(len(a) - len(b)) > most:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return max(len(a), len(b)) <= most
    far = most + 1
    row = [j if j <= most else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        low, high = max(1, i - most), min(len(b), i + most)
        new = [far] * (len(b) + 1)
        if i <= most:
            new[0] = i
        for j in range(low, high + 1):
            new[j] = min(row[j - 1] + (x != b[j - 1]), row[j] + 1, new[j - 1] + 1)
        row = new
        if min(row[low - 1 : high + 1]) > most:
            return False
    return row[len(b)] <= most


class Side:
    """Passages of one language of a shard of evaluation records, and their automaton, made where it is first used."""

    def __init__(self, texts: list[str], every: int):
        self.owners: dict[str, list[int]] = defaultdict(list)
        seen = Counter(w for text in texts for w in set(text.split(" ")))
        rarity = {w: math.log((len(texts) + 1) / n) for w, n in seen.items()}
        self.whole: dict[str, list[int]] = defaultdict(list)
        self.words, self.passages, self.every = [], [], every
        for k, text in enumerate(texts):
            tokens = text.split(" ")
            self.words.append(len(tokens))
            if len(tokens) < every - 1:
                self.whole[text].append(k)
                self.passages.append(0)
            else:
                cut = set(pieces(tokens, [rarity[w] for w in tokens], every))
                self.passages.append(len(cut))
                for p in cut:
                    self.owners[f" {p} "].append(k)

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for n, (p, who) in enumerate(self.owners.items()):
            made.add_word(p, (n, frozenset(who)))
        made.make_automaton()
        return made

    def touched(self, text: str) -> tuple[set[int], list[frozenset[int]]]:
        """(records of which a passage, or the whole short text, occurs in ``text``; the records of each passage that does)."""
        found = list(dict(who for _, who in self.automaton.iter(f" {text} ")).values()) if self.owners else []
        return set(self.whole.get(text, ())).union(*found), found

    def covers(self, record: int, size: int, found: list[frozenset[int]]) -> bool:
        """Whether the matched intervals of a record, merged, cover enough of it for a text of ``size`` words.

        The passages of a record lie end to end, so its merged coverage is that
        of its matched passages, each counted once. An edit breaks one
        passage at most: all but as many as words may differ must be covered.
        """
        differ = limit(max(self.words[record], size), self.every)
        return sum(record in who for who in found) >= self.passages[record] - differ


class Shard:
    def __init__(self, rows: list[tuple[str, str, str]], every: int):
        self.keys = [r[0] for r in rows]
        self.sides = [Side([r[k] for r in rows], every) for k in (1, 2)]
        self.tokens = [(r[1].split(" "), r[2].split(" ")) for r in rows]
        self.sets = [(frozenset(a), frozenset(b)) for a, b in self.tokens]
        self.every = every

    def matches(self, first: str, second: str) -> Iterator[str]:
        left, right = self.sides
        records, in_first = left.touched(first)
        if not records:
            return
        others, in_second = right.touched(second)
        records &= others
        if not records:
            return
        a, b = first.split(" "), second.split(" ")
        in_a, in_b = set(a), set(b)
        for k in sorted(records):
            x, y = self.tokens[k]
            most_x, most_y = limit(max(len(x), len(a)), self.every), limit(max(len(y), len(b)), self.every)
            # an edit takes away at most one distinct word
            if len(self.sets[k][0] - in_a) <= most_x and len(self.sets[k][1] - in_b) <= most_y:
                if left.covers(k, len(a), in_first) and right.covers(k, len(b), in_second) and within(x, a, most_x) and within(y, b, most_y):
                    yield self.keys[k]


class Codes(dict):
    """Word -> its code, rare words before frequent ones; made once a word, emptied at ``limit`` words."""

    def __init__(self, counts: dict[str, int], texts: int, limit: int = 1_000_000):
        super().__init__()
        self.counts, self.texts, self.limit = counts, texts, limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        n = self.counts.get(word)
        bits = math.log2(self.texts / n) if n else min(SEEN, math.log2(self.texts + 1))
        hashed = int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "little") >> (64 - LOW)
        found = self[word] = (TOP - round(4 * bits)) << LOW | hashed
        return found

    def __reduce__(self):
        return Codes, (self.counts, self.texts, self.limit)


def reach(n: int, every: int = EVERY) -> int:
    """Words of the longest text within the limit of one of ``n`` words."""
    m = n
    while m + 1 - n <= limit(m + 1, every):
        m += 1
    return m


def broken(n: int, size: int, every: int = EVERY) -> int:
    """Runs of ``size`` words of a text of ``n`` words that the edits within the limit can break.

    A word replaced or lost breaks ``size`` runs, one added between two words
    breaks ``size - 1``; a longer text has at least as many words added as it
    is longer.
    """
    return max(size * limit(m, every) - (m - n) for m in range(n, reach(n, every) + 1))


def runs(codes: list[int], size: int) -> list[int]:
    """Codes of the runs of ``size`` words; the rarity of a run is that of its words."""
    out, low = [], (1 << LOW) - 1
    for k in range(len(codes) - size + 1):
        bits, mixed = 0, 0
        for c in codes[k : k + size]:
            bits += TOP - (c >> LOW)
            mixed = (mixed * 0x100000001B3 + (c & low)) & low
        out.append((TOP - min(TOP, bits)) << LOW | mixed)
    return out


def keys(codes: np.ndarray, starts: np.ndarray, spare: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every row; rows that keep all but ``spare`` of their codes in common have a key in common.

    ``codes`` has the sorted codes of row k at starts[k]:starts[k + 1]. Codes
    in common, rarest first, stand behind ``spare`` others at most; a key is
    made of the first of them, of as many as are together rare enough
    (``need`` quarters of a bit) or DEPTH, or of all where there are no more.
    Each row gives the keys of all the choices that it leaves open.
    """
    count = np.diff(starts)
    fresh = np.ones(len(codes), bool)
    fresh[1:] = codes[1:] != codes[:-1]
    fresh[starts[:-1][count > 0]] = True
    first = np.flatnonzero(fresh)
    again = np.arange(len(codes)) - first[np.cumsum(fresh) - 1] if len(codes) else np.zeros(0, np.int64)
    mixed = codes + again.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # a repeated word is another word
    rarity = TOP - (codes >> np.uint64(LOW)).astype(np.int64)
    row = np.arange(len(count))
    place, skipped, bits, key = np.zeros(len(count), np.int64), np.zeros(len(count), np.int64), np.zeros(len(count), np.int64), np.zeros(len(count), np.uint64)
    rows, found = [], []
    for depth in range(1, DEPTH + 1):
        left, open_ = count[row] - place, spare[row] - skipped
        ends = left <= open_
        rows.append(row[ends])
        found.append(key[ends] ^ np.uint64(1))
        room = np.maximum(np.minimum(open_ + 1, left), 0)
        at = np.repeat(np.arange(len(row)), room)
        skip = np.arange(len(at)) - np.repeat(np.cumsum(room) - room, room)
        row, place, skipped, bits, key = row[at], place[at] + skip, skipped[at] + skip, bits[at], key[at]
        token = starts[row] + place
        key = (key ^ mixed[token]) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
        bits = bits + rarity[token]
        done = bits >= need if depth < DEPTH else np.ones(len(row), bool)
        rows.append(row[done])
        found.append(key[done])
        row, place, skipped, bits, key = row[~done], place[~done] + 1, skipped[~done], bits[~done], key[~done]
    return np.concatenate(rows), np.concatenate(found)


class Sketches:
    """Word counts, sketches and keys of texts, the keys of one language (``side``)."""

    def __init__(self, codes: Codes, side: int, need: int, every: int):
        self.codes, self.side, self.need, self.every = codes, side, need, every

    def counts(self, texts: list[str]) -> np.ndarray:
        return np.fromiter((t.count(" ") + 1 for t in texts), np.int64, len(texts))

    def bits(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A bit for each code, those that meet cancelled: it differs in no more places than the texts in words."""
        return np.bitwise_xor.reduceat(np.uint64(1) << (codes & np.uint64(63)), starts[:-1]) if len(codes) else np.zeros(0, np.uint64)

    def of(self, texts: tuple[list[str], list[str]]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
        """(words of both sides, sketches of both sides, row of each key, key)."""
        words, flat = [self.counts(t) for t in texts], []
        for side in texts:
            tokens = " ".join(side).split(" ") if side else []
            flat.append(np.fromiter(map(self.codes.__getitem__, tokens), np.uint64, len(tokens)))
        starts = [np.cumsum([0, *n]) for n in words]
        sketches = [self.bits(f, x) for f, x in zip(flat, starts)]
        n, codes, starts = words[self.side], flat[self.side], starts[self.side]
        sizes, size_of = np.unique(n, return_inverse=True)
        lost = lambda size: np.array([broken(m, size, self.every) for m in sizes.tolist()], np.int64)[size_of]
        of_row = np.repeat(np.arange(len(n)), n)
        short = n <= LONG
        some, own = short[of_row], np.flatnonzero(short)
        codes_, of_row_ = codes[some], of_row[some]
        row, key = keys(codes_[np.lexsort((codes_, of_row_))], np.cumsum([0, *n[own]]), lost(1)[own], self.need)
        rows, found = [own[row]], [key]
        far = np.flatnonzero(np.array([reach(m, self.every) for m in sizes.tolist()], np.int64)[size_of] > LONG)
        if len(far):
            lists = [sorted(runs(codes[starts[k] : starts[k + 1]].tolist(), GRAM)) for k in far]
            row, key = keys(np.array([c for x in lists for c in x], np.uint64), np.cumsum([0, *map(len, lists)]), lost(GRAM)[far], self.need)
            rows.append(far[row])
            found.append(key)
        return words, sketches, np.concatenate(rows), np.concatenate(found)


class Index:
    """Evaluation classes of a block by their keys: places in ``held`` between two of ``starts`` have the bucket's classes."""

    def __init__(self, parts: list[tuple], every: int, side: int):
        self.every, self.side = every, side
        self.classes = b"".join(p[0] for p in parts)
        self.words = [np.concatenate([np.frombuffer(p[k], np.int32) for p in parts]) for k in (1, 2)]
        self.bits = [np.concatenate([np.frombuffer(p[k], np.uint64) for p in parts]) for k in (3, 4)]
        base = np.cumsum([0, *(len(p[0]) // 16 for p in parts)]).astype(np.uint64)
        both = np.concatenate([np.frombuffer(p[5], np.uint64) + b for p, b in zip(parts, base)])  # a key's upper half, and the place of its class
        parts.clear()
        both.sort()
        self.size = max(8, min(24, int(len(both)).bit_length() - 1))
        self.held = both.astype(np.uint32)
        edges = np.arange(1 << self.size, dtype=np.uint64) << np.uint64(64 - self.size)
        self.starts = np.append(np.searchsorted(both, edges), len(both)).astype(np.uint32)
        self.near = [self._near(w) for w in self.words]

    def _near(self, words: np.ndarray) -> np.ndarray:
        """Whether texts of so many words can be within the limit of one of the block; longer ones than the last cannot."""
        out = np.zeros(reach(int(words.max()), self.every) + 2, bool)
        for m in np.unique(words).tolist():
            out[m - limit(m, self.every) : reach(m, self.every) + 1] = True
        return out

    def within_reach(self, words: list[np.ndarray]) -> np.ndarray:
        return np.logical_and(*(n[np.minimum(w, len(n) - 1)] for n, w in zip(self.near, words)))

    def candidates(self, words: list[np.ndarray], bits: list[np.ndarray], row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, class) pairs that share a bucket and whose sketches allow the texts to be within the limit in both languages."""
        bucket = (key >> np.uint64(64 - self.size)).astype(np.int64)
        begin = self.starts[bucket].astype(np.int64)
        count = self.starts[bucket + 1] - begin
        some = count > 0
        row, begin, count = row[some], begin[some], count[some]
        upto = np.cumsum(count)
        pairs, at, side = [], 0, self.side
        while at < len(row):
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + AT_ONCE)))
            c = count[at:to]
            i = np.repeat(row[at:to], c)
            j = self.held[np.arange(int(c.sum())) + np.repeat(begin[at:to] - (np.cumsum(c) - c), c)]
            for k in (side, 1 - side):
                n, m = words[k][i], self.words[k][j]
                allowed = 2 * (np.maximum(n, m) // self.every) - np.abs(n - m)
                fits = np.bitwise_count(bits[k][i] ^ self.bits[k][j]) <= allowed
                i, j = i[fits], j[fits]
            pairs.append(i.astype(np.uint64) << np.uint64(32) | j)
            at = to
        both = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.uint64)
        return (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)


def classes(records: DataFrame, key: str, texts: tuple[str, str], split: str) -> DataFrame:
    """(key, split, class, first, second): plain forms of both texts; records without either are left out."""
    columns = [key, split, *texts]
    schema = f"`{key}` {records.schema[key].dataType.simpleString()}, `{split}` string, first string, second string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain = PlainWords()
        for batch in batches:
            a, b = ([plain.line(t) for t in batch[c]] for c in texts)
            out = pd.DataFrame({key: batch[key], split: batch[split], "first": a, "second": b})
            yield out[(out["first"] != "") & (out["second"] != "")]

    usable = records.select(*columns).where(f"`{texts[0]}` is not null and `{texts[1]}` is not null and `{split}` is not null and `{key}` is not null")
    plain = usable.mapInPandas(run, schema)
    return plain.withColumn("class", F.unhex(F.md5(F.concat_ws("\x1f", "first", "second"))))


def _sketches(held: DataFrame, block: int, every: int) -> Sketches | None:
    """How texts are keyed: by the side that tells evaluation classes apart in fewer words, and by the rarity of its words among them."""
    sides = ("first", "second")
    about = [x for c in sides for x in (F.approx_count_distinct(c), F.sum(F.size(F.split(c, " "))))]
    n, first, long_first, second, long_second = held.agg(F.count("*"), *about).first()
    if not n:
        return None
    side = int(second >= 0.9 * first and (long_second < long_first or first < 0.9 * second))
    words = held.select(F.explode(F.array_distinct(F.split(sides[side], " "))).alias("w")).groupBy("w").count().where(F.col("count") * 2**SEEN >= n)
    counts = words.toPandas()
    need = round(4 * max(1, math.log2(min(n, block * TOGETHER)) - 5))
    return Sketches(Codes(dict(zip(counts["w"], counts["count"].tolist())), n), side, need, every)


def _blocks(spark: SparkSession, held: DataFrame, sketches: Sketches, block: int) -> Iterator[Broadcast]:
    """Indexes of ``block`` evaluation classes each, one at a time in the driver's memory; sketches and keys are made in tasks, the driver sorts them."""
    shared = spark.sparkContext.broadcast(sketches)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for k in range(0, len(whole), block):
                batch = whole.iloc[k : k + block]
                words, bits, row, key = shared.value.of((batch["first"].tolist(), batch["second"].tolist()))
                both = (key >> np.uint64(32) << np.uint64(32)) | row.astype(np.uint64)
                yield pd.DataFrame([[b"".join(map(bytes, batch["class"])), *(x.astype(np.int32).tobytes() for x in words), *(x.tobytes() for x in (*bits, both))]], columns=list("abcdef"))

    parts: list[tuple] = []
    count = 0
    for part in held.select("class", "first", "second").mapInPandas(run, ", ".join(f"{c} binary" for c in "abcdef")).toLocalIterator():
        size = len(part[0]) // 16
        if parts and count + size > block:
            yield spark.sparkContext.broadcast(Index(parts, sketches.every, sketches.side))
            count = 0
        parts.append(tuple(map(bytes, part)))
        count += size
    if parts:
        yield spark.sparkContext.broadcast(Index(parts, sketches.every, sketches.side))


def matched_classes(
    spark: SparkSession,
    records: DataFrame,
    key: str = "pair_id",
    texts: tuple[str, str] = ("french", "moore"),
    split: str = "split_name",
    train: str = "train",
    every: int = EVERY,
    shard: int = SHARD,
    block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """((key, split, class) of all records, (train_class, eval_class) whose texts are the same or near).

    Copies are one class each. Evaluation classes are indexed by their keys
    (see :func:`keys`) in blocks of ``block``; training texts find in each
    index the few classes whose words can be within the limit, by keys that
    grow rarer with the number of classes, so that the work follows the
    input. Candidates meet the evaluation texts in a join; Aho-Corasick
    automata over the passages of ``shard`` candidates give the coverage of
    each record, and edit distance verifies. Plain texts are stored once; a
    pass over them searches TOGETHER indexes, all passes are one job.
    """
    plain = stored(classes(records, key, texts, split))
    columns = ["class", "first", "second"]
    held = plain.where(F.col(split) != train).select(*columns).dropDuplicates(["class"])
    trained = plain.where(F.col(split) == train).select(*columns)
    near: DataFrame | None = None

    def search(sketches: Sketches, shared: list) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            indexes = [x.value for x in shared]
            for batch in batches:
                batch = batch.drop_duplicates("class")
                counts = [sketches.counts(batch[c].tolist()) for c in ("first", "second")]
                batch = batch[np.logical_or.reduce([x.within_reach(counts) for x in indexes])]
                words, bits, row, key = sketches.of((batch["first"].tolist(), batch["second"].tolist()))
                for own in indexes:
                    i, found = own.candidates(words, bits, row, key)
                    out = batch.iloc[i].rename(columns={"class": "train_class"})
                    out["eval_class"] = [own.classes[16 * j : 16 * j + 16] for j in found]
                    yield out

        return trained.mapInPandas(run, "train_class binary, first string, second string, eval_class binary")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            whole = whole.sort_values("eval_class", kind="stable")
            for k in range(0, max(1, len(whole)), shard):
                batch = whole.iloc[k : k + shard]
                wanted = set(zip(batch["train_class"], batch["eval_class"]))
                made = Shard(list(batch.drop_duplicates("eval_class")[["eval_class", "held_first", "held_second"]].itertuples(index=False, name=None)), every)
                own = batch.drop_duplicates("train_class")
                pairs = [(c, e) for c, a, b in zip(own["train_class"], own["first"], own["second"]) for e in made.matches(a, b) if (c, e) in wanted]
                yield pd.DataFrame(pairs, columns=["train_class", "eval_class"], dtype=object)

    sketches = _sketches(held, block, every)
    indexes = _blocks(spark, held, sketches, block) if sketches else iter(())
    while shared := list(islice(indexes, TOGETHER)):
        part = search(sketches, shared)
        near = part if near is None else near.union(part)
    members = plain.select(key, split, "class")
    if near is None:
        return members, spark.createDataFrame([], "train_class binary, eval_class binary")
    near = near.dropDuplicates(["train_class", "eval_class"])
    texts_ = held.select(F.col("class").alias("eval_class"), F.col("first").alias("held_first"), F.col("second").alias("held_second"))
    return members, near.join(texts_, "eval_class").mapInPandas(verify, "train_class binary, eval_class binary")


def cross_split_pairs(
    spark: SparkSession,
    records: DataFrame,
    key: str = "pair_id",
    texts: tuple[str, str] = ("french", "moore"),
    split: str = "split_name",
    train: str = "train",
    every: int = EVERY,
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """(key_a, key_b): pairs of a training record and another split's record whose texts are the same or near.

    Case, accents, punctuation and spacing aside, both texts of a pair differ
    in at most one word in ``every`` (word edits against the longer text).
    Matched classes (see :func:`matched_classes`) become record pairs in a join
    at the end. Records without either text (null, blank, no words) and
    records without a split form no pair; repeated rows should have been
    reduced to one per key.
    """
    members, found = matched_classes(spark, records, key, texts, split, train, every, shard, block)
    a = members.where(F.col(split) == train).select(F.col(key).alias("a"), F.col("class").alias("train_class"))
    b = members.where(F.col(split) != train).select(F.col(key).alias("b"), F.col("class").alias("eval_class"))
    pairs = found.join(b, "eval_class").join(a, "train_class")
    return pairs.select(F.least("a", "b").alias(f"{key}_a"), F.greatest("a", "b").alias(f"{key}_b"))


def overlap_counts(
    spark: SparkSession, records: DataFrame, key: str = "pair_id", texts: tuple[str, str] = ("french", "moore"), split: str = "split_name", source: str = "source", train: str = "train"
) -> DataFrame:
    """As :func:`overlap_report`, from counts per class: no record pair is made."""
    members, found = matched_classes(spark, records, key, texts, split, train)
    copies = members.where(F.col(split) == train).groupBy(F.col("class").alias("train_class")).agg(F.count("*").alias("copies"))
    twins = found.join(copies, "train_class").groupBy("eval_class").agg(F.sum("copies").alias("twins"))
    own = records.where((F.col(split) != train) & F.col(split).isNotNull()).select(key, F.lower(F.trim(source)).alias("source"))
    held = members.where(F.col(split) != train).join(own, key).groupBy(F.col("class").alias("eval_class"), split, "source").agg(F.count("*").alias("n"))
    return held.join(twins, "eval_class").groupBy(split, "source").agg(F.sum("n").alias("records"), F.sum(F.col("n") * F.col("twins")).alias("pairs"))


def overlap_report(pairs: DataFrame, records: DataFrame, key: str = "pair_id", split: str = "split_name", train: str = "train") -> DataFrame:
    """(split, source, records, pairs): evaluation records with a training twin, and their pairs, per split and source."""
    long = pairs.select(F.explode(F.array(f"{key}_a", f"{key}_b")).alias(key))
    hits = long.groupBy(key).agg(F.count("*").alias("n"))
    own = records.where((F.col(split) != train) & F.col(split).isNotNull()).select(key, split, F.lower(F.trim("source")).alias("source"))
    return own.join(hits, key).groupBy(split, "source").agg(F.count("*").alias("records"), F.sum("n").alias("pairs"))
