"""Sentence units of running text in spaced and spaceless scripts."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Marks that end sentences. The strong ones end one wherever they stand outside quotes.
WEAK, STRONG = ".!?…؟", "。！？።፧।॥"
#: Opening and closing marks.
PAIRS = {"«": "»", "“": "”", "(": ")", "[": "]", "「": "」", "『": "』", "（": "）", "„": "”"}
QUOTES = "«“\"「『„"
#: Abbreviations before a name or word, whatever follows (titles only with a capital).
TITLES = {"M", "MM", "Mme", "Mmes", "Mlle", "Mlles", "Mgr", "Me", "Dr", "Pr", "Prof", "Mr", "Mrs", "Ms", "St", "Ste", "Rev", "Hon", "Gen", "Col", "Capt", "Sr", "Jr", "Co"}
NEVER_LAST = {"av", "apr", "éd", "ed", "cf", "vs", "e.g", "i.e", "c.-à-d", "p.ex", "env", "approx", "vug"}
#: Abbreviations before a number.
BEFORE_NUMBER = {"p", "pp", "no", "nos", "n", "vol", "fig", "art", "al", "sak", "vug", "env", "approx", "sec", "ch", "chap", "v", "h", "b", "ca", "tél", "tel", "boul", "ann", "i.e", "c.-à-d", "e.g"}
#: Particles that close and words that open sentences in spaceless scripts.
FINAL_PARTICLES = ("了", "吧", "吗", "呢", "啊", "呀", "嘛", "的", "。", "ครับ", "ค่ะ")
OPENING_WORDS = ("昨天", "今天", "明天", "去年", "今年", "明年", "每", "但是", "因为", "所以", "如果", "虽然", "然后", "后来", "我们", "他们", "她", "他", "我", "你", "这", "那")
#: Opening words learned from a corpus: least occurrences and most entries (a documented bound).
LEARNED_LEAST, LEARNED_MOST = 3, 5000
#: Words of the lattice: most characters and most entries (a documented bound), characters looked at beside a gap.
WORD_MOST, DICTIONARY_MOST, WINDOW = 5, 200_000, 24
#: Partial counts a worker holds before it hands them on.
HELD_COUNTS = 200_000

SPACELESS = r"぀-ヿ㐀-䶿一-鿿฀-๿຀-໿က-႟ក-៿"
_SPACELESS = re.compile(f"[{SPACELESS}]")
_RUN = re.compile(f"[{SPACELESS}]+")
_HEAD = re.compile(rf"(?:^|[。！？]|[」”])\s*([{SPACELESS}]+)")
_DEVANAGARI = re.compile("[ऀ-ॿ]")
BLANK_LINE = re.compile(r"\n[^\S\n]*\n\s*")
MARK = re.compile(rf"[{WEAK}{STRONG}]+|[«»“”\"()\[\]「」『』（）„]")
TOKEN_BEFORE = re.compile(r"[^\s\"“”«»()\[\],;:]+$")


def _matched(text: str, start: int, end: int) -> dict[int, int]:
    """Places of opening and closing marks that pair up, both ways; stray marks are left out."""
    open_: list[tuple[str, int]] = []
    pairs: dict[int, int] = {}
    for m in MARK.finditer(text, start, end):
        c, i = m.group(), m.start()
        if c == '"':
            if any(o == '"' for o, _ in open_):
                while open_[-1][0] != '"':
                    open_.pop()
                j = open_.pop()[1]
                pairs[i], pairs[j] = j, i
            else:
                open_.append((c, i))
        elif c in PAIRS:
            open_.append((c, i))
        elif c in PAIRS.values():
            for k in range(len(open_) - 1, -1, -1):
                if PAIRS.get(open_[k][0]) == c:
                    j = open_[k][1]
                    del open_[k:]
                    pairs[i], pairs[j] = j, i
                    break
    return pairs


def _starts(text: str, at: int, end: int) -> bool:
    """Whether what stands at ``at`` can begin a sentence: anything but a small letter or a mark that goes on."""
    c = text[at]
    if c.isalpha():
        return not c.islower()
    return c.isdigit() or c in QUOTES or c in "([¿¡–—•*-（" or at >= end


def _abbreviation(text: str, start: int, dot: int, after: int, end: int) -> bool:
    """Whether the single full stop at ``dot`` belongs to an abbreviation and ends nothing."""
    found = TOKEN_BEFORE.search(text, start, dot)
    token = found.group() if found else ""
    token = token.rsplit("'", 1)[-1].rsplit("’", 1)[-1]
    follows = text[after] if after < end else ""
    if token in TITLES or token.lower() in NEVER_LAST:
        return True
    last = token.rsplit(".", 1)[-1].rsplit("-", 1)[-1]
    if len(last) == 1 and last.isupper() and "-" not in token:  # initials
        return follows.isupper() or follows.islower()
    if follows.isdigit() and (token.lower() in BEFORE_NUMBER or last.lower() in BEFORE_NUMBER and "." in token):
        return True
    if 1 <= len(token) <= 2 and token.isalpha() and token.lower() == token.upper():
        return True  # one letter of a caseless script, a joined particle before it
    return bool(token and len(token) <= 4 and _DEVANAGARI.search(token))


@dataclass(frozen=True)
class Lattice:
    """Dictionary of spaceless scripts: the worth of each word a character, and the words that open sentences."""

    worth: dict[str, float] = field(default_factory=dict)
    openers: frozenset[str] = frozenset(OPENING_WORDS)

    @cached_property
    def edges(self) -> dict[str, float]:
        """Worth of every word; listed opening words that the corpus does not hold count as words too."""
        return {**{w: 1.0 for w in OPENING_WORDS if len(w) > 1}, **self.worth}

    def path(self, run: str) -> list[str]:
        """Words of the best path: every dictionary word is an edge as worthy as its characters together; single characters always are."""
        n = len(run)
        best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
        for i in range(n):
            for j in range(i + 1, min(n, i + WORD_MOST) + 1):
                worth = self.edges.get(run[i:j], 0.0 if j == i + 1 else None)
                if worth is not None and best[i] + worth * (j - i) > best[j]:
                    best[j], back[j] = best[i] + worth * (j - i), i
        out: list[str] = []
        while n:
            out.append(run[back[n] : n])
            n = back[n]
        return out[::-1]

    def first(self, text: str, at: int) -> str:
        """First word of the best path over the run that begins at ``at``."""
        run = _RUN.match(text, at, at + WINDOW)
        return self.path(run.group())[0] if run else ""


def _gap(text: str, at: int, stop: int, lattice: Lattice) -> bool:
    """Class of an ambiguous gap, from the mark at ``stop`` to ``at``, in a spaceless script: opening word after it, or final particle before it."""
    if lattice.first(text, at) in lattice.openers:
        return True
    return text.endswith(FINAL_PARTICLES, 0, stop) or text[at] in QUOTES or text[at].isdigit()


def units(text: str | None, lattice: Lattice = Lattice()) -> list[tuple[int, int]]:
    """(start, end) offsets of the sentence units of a text; null and blank texts have none.

    Blank lines end units. Within a paragraph each terminator outside quotes
    and brackets is a node of a lattice whose outgoing edge is a boundary or
    not: strong terminators end a unit; a full stop, question or exclamation
    mark or ellipsis ends one where the next thing can begin a sentence and no
    abbreviation, initial, number or address claims the stop. A quotation that
    ends in a terminator closes its sentence likewise. In spaceless scripts an
    ellipsis is judged by the word after it (the first on the best path through
    the word lattice) and the particle before it.
    """
    out: list[tuple[int, int]] = []
    if not text:
        return out
    begin = 0
    edges = [m.span() for m in BLANK_LINE.finditer(text)] + [(len(text), len(text))]
    for stop, resume in edges:
        _paragraph(text, begin, stop, lattice, out)
        begin = resume
    return out


def _paragraph(text: str, start: int, end: int, lattice: Lattice, out: list[tuple[int, int]]) -> None:
    pairs = _matched(text, start, end)
    first = start
    i = start

    def emit(upto: int) -> None:
        nonlocal first
        a, b = first, upto
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a < b:
            out.append((a, b))
        first = upto

    while True:
        m = MARK.search(text, i, end)
        if not m:
            break
        at, mark = m.start(), m.group()
        i = m.end()
        if at in pairs and pairs[at] > at:  # a matched opening: jump to its end
            close = pairs[at]
            i = close + 1
            inner = close - 1
            while inner > at and text[inner].isspace():
                inner -= 1
            opened_unit = not text[first:at].strip()
            if text[inner] in WEAK + STRONG and (text[at] in QUOTES or opened_unit):
                after = i
                while after < end and text[after].isspace():
                    after += 1
                if after >= end:
                    continue
                spaceless = _SPACELESS.match(text, after) is not None
                if spaceless or _starts(text, after, end) and (after > i or text[after].isupper() or text[after] in QUOTES):
                    emit(i)
            continue
        if mark[0] not in WEAK + STRONG:
            continue
        # closing marks right after the terminator that no opening claims belong to the unit
        while i < end and text[i] in "»”\"」』)" and i not in pairs:
            i += 1
        after = i
        while after < end and text[after].isspace():
            after += 1
        if after >= end:
            break
        if any(c in STRONG for c in mark):
            emit(i)
            continue
        before = text[at - 1] if at > start else ""
        if _SPACELESS.match(before or " ") and _SPACELESS.match(text, after):
            if mark.strip(".…") or _gap(text, after, at, lattice):
                emit(i)
            continue
        if after == i:  # no white space: only a glued capital begins a sentence
            c = text[after]
            glued = c.isupper() or (c.isalpha() and not c.islower() and not before.isdigit()) or c in "«“„"
            if not glued or not (before.isalnum() or before in ")»”"):
                continue
            if mark == "." and (_abbreviation(text, first, at, after, end) or before.isupper() or "www" in (TOKEN_BEFORE.search(text, first, at) or [""])[0]):
                continue
            emit(i)
            continue
        if not _starts(text, after, end):
            continue
        if mark == "." and _abbreviation(text, first, at, after, end):
            continue
        emit(i)
    emit(end)


def body_rows(sections: DataFrame, key: str = "section_id") -> DataFrame:
    """(key, sub_no, body): the section's own body as 0 and its subsections' by place; null bodies and keys are left out."""
    own = F.array(F.struct(F.lit(0).alias("sub_no"), F.col("body")))
    subs = F.coalesce(F.transform("subsections", lambda s, i: F.struct((i + 1).cast("int").alias("sub_no"), s["body"].alias("body"))), F.array().cast("array<struct<sub_no:int,body:string>>"))
    return sections.select(key, F.explode(F.concat(own, subs)).alias("b")).select(key, "b.sub_no", "b.body").where(F.col("body").isNotNull() & F.col(key).isNotNull())


def _contexts(texts: Iterable[str]) -> Iterator[tuple[str, str, str]]:
    """(string of up to WORD_MOST characters, character before, character after) of all runs; '' is an edge."""
    for text in texts:
        for found in _RUN.finditer(text):
            run = found.group()
            for i in range(len(run)):
                for j in range(i + 1, min(len(run), i + WORD_MOST) + 1):
                    yield run[i:j], run[i - 1 : i], run[j : j + 1]


def _counted(keys: Iterable[tuple]) -> Iterator[list[tuple]]:
    """Lists of (*key, count), never more than HELD_COUNTS keys held."""
    held: Counter = Counter()
    for key in keys:
        held[key] += 1
        if len(held) >= HELD_COUNTS:
            yield [(*k, n) for k, n in held.items()]
            held.clear()
    yield [(*k, n) for k, n in held.items()]


def autonomy(rows: Iterable[tuple[str, float, float]]) -> dict[str, float]:
    """Worth of each string as a word, from (string, entropy of the character before, of the one after).

    A word's neighbours are less certain than those of its parts: the growth
    of either entropy by the last character, less the mean growth of strings
    of that length. '' stands for any place.
    """
    entropy = {w: (left, right) for w, left, right in rows}
    growth = {w: (e[0] - entropy.get(w[1:], (0.0, 0.0))[0], e[1] - entropy.get(w[:-1], (0.0, 0.0))[1]) for w, e in entropy.items() if w}
    out: dict[str, float] = {}
    for size in range(1, WORD_MOST + 1):
        own = {w: sum(g) for w, g in growth.items() if len(w) == size}
        mean = sum(own.values()) / max(1, len(own))
        out.update({w: g - mean for w, g in own.items()})
    return out


def learn_lattice(bodies: DataFrame, text: str = "body") -> Lattice:
    """Dictionary and opening words of the spaceless scripts, over all texts.

    Every string of up to WORD_MOST characters is counted with its neighbours,
    and the strings that behave like words make the lattice. The opening words
    are those that often head a run after a strong terminator, a closing quote
    or at the start of a text, of whatever length. Counts are partial before
    the shuffle; at most DICTIONARY_MOST and LEARNED_MOST entries reach the
    driver. Short texts of many copies only raise counts.
    """
    long = bodies.select(text).where(F.col(text).rlike(f"[{SPACELESS}]"))

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            both = ((w, side, c) for w, *near in _contexts(batch[text]) for side, c in enumerate(near))
            for rows in _counted(both):
                yield pd.DataFrame(rows, columns=["w", "side", "c", "n"])

    counts = long.mapInPandas(contexts, "w string, side int, c string, n bigint").groupBy("w", "side", "c").agg(F.sum("n").alias("n"))
    # an edge is no character: each stands for a neighbour of its own
    n, spread = F.col("n"), F.when(F.col("c") == "", 0.0).otherwise(F.col("n") * F.log(F.col("n").cast("double")))
    words = counts.groupBy("w").agg((F.sum("n") / 2).alias("n"), *[F.sum(F.when(F.col("side") == k, spread)).alias(f"s{k}") for k in (0, 1)]).where(n >= LEARNED_LEAST)
    top = words.orderBy(F.desc("n"), F.length("w"), "w").limit(DICTIONARY_MOST).collect()
    if not top:
        return Lattice()
    single = [r["n"] for r in top if len(r["w"]) == 1]
    total = sum(single)
    anywhere = math.log(total) - sum(x * math.log(x) for x in single) / total if total else 0.0
    worth = autonomy([("", anywhere, anywhere), *((r["w"], *[math.log(r["n"]) - r[s] / r["n"] for s in ("s0", "s1")]) for r in top)])
    lattice = Lattice(worth)
    shared = bodies.sparkSession.sparkContext.broadcast(lattice)

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            first = ((shared.value.first(t, m.start(1)),) for t in batch[text] for m in _HEAD.finditer(t))
            for rows in _counted(first):
                yield pd.DataFrame(rows, columns=["w", "n"])

    often = long.mapInPandas(heads, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n")).where(n >= LEARNED_LEAST)
    learned = [r["w"] for r in often.orderBy(F.desc("n"), "w").limit(LEARNED_MOST).collect()]
    return Lattice(worth, lattice.openers.union(learned))


def sentence_units(spark: SparkSession, sections: DataFrame, key: str = "section_id") -> DataFrame:
    """(key, sub_no, start_at, end_at): one row per sentence unit of every body, offsets in characters.

    A narrow pass over whole bodies; only the bounded dictionary of words and
    opening words is broadcast. Null and blank bodies have no units, repeated rows should
    have been reduced before.
    """
    bodies = body_rows(sections, key)
    shared = spark.sparkContext.broadcast(learn_lattice(bodies))
    schema = f"`{key}` {sections.schema[key].dataType.simpleString()}, sub_no int, start_at int, end_at int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(k, n, a, b) for k, n, body in zip(batch[key], batch["sub_no"], batch["body"]) for a, b in units(body, shared.value)]
            yield pd.DataFrame(out, columns=[key, "sub_no", "start_at", "end_at"])

    return bodies.mapInPandas(run, schema)
