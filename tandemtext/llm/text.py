"""Word-level text helpers shared by the operators of this package."""

from __future__ import annotations

import re
import unicodedata

WORD = re.compile(r"[^\W_]+")
#: Characters that layout programs add and that no reader sees.
INVISIBLE = dict.fromkeys(map(ord, "­​‌‍⁠﻿"))
_INVISIBLE = re.compile("[­​‌‍⁠﻿]")


def composed(text: str) -> str:
    """NFC form without invisible layout characters."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    if not text.isascii() and _INVISIBLE.search(text):
        text = text.translate(INVISIBLE)
    return text


def plain_word(word: str) -> str:
    """Lower case, without accents."""
    word = unicodedata.normalize("NFKD", word.lower())
    return "".join(c for c in word if not unicodedata.combining(c))


class WordIds(dict):
    """Raw word -> id of its plain form; forms outside ``known`` get ``other``.

    Each distinct spelling is normalised once. The memo is emptied when it
    holds ``limit`` spellings, so memory stays bounded whatever the corpus.
    """

    def __init__(self, known: dict[str, int], other: int = 0, limit: int = 2_000_000):
        super().__init__()
        self.known, self.other, self.limit = known, other, limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        found = self[word] = self.known.get(plain_word(word), self.other)
        return found


class PlainWords(dict):
    """Raw word -> its plain form, made once a spelling; emptied at ``limit`` spellings."""

    def __init__(self, limit: int = 1_000_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> str:
        if len(self) >= self.limit:
            self.clear()
        found = self[word] = plain_word(word)
        return found

    def line(self, text: str | None) -> str:
        """Plain words of a text with single blanks between them."""
        return " ".join([self[w] for w in WORD.findall(composed(text))]) if text else ""


def words(text: str | None) -> list[str]:
    """Plain words of a text, in order."""
    return [plain_word(w) for w in WORD.findall(composed(text))] if text else []
