"""Token ids of white-space words, remembered between texts.

The vocabulary's normaliser works character by character inside a word, its pattern never
matches across white space, and its special strings hold none.  So the ids of a text are the
ids of its words, one after the other, and a word met before needs no encoder.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

#: Words remembered by one Python worker before it starts afresh (about 200 bytes each).
REMEMBERED_WORDS = 600_000

#: One run of Latin-1 letters, then at most one mark: two matches of the vocabulary's pattern.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies, by Latin-1 code point."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds:
    """Ids as little-endian unsigned 32-bit integers, four bytes a token."""

    def __init__(self, path: str, remembered: int = REMEMBERED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.known: dict[bytes, bytes] = {}
        self.remembered = remembered
        self.marks = {m: self._encode(m) for m in ".,;:!?"} | {"": b""}

    def _encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "surrogatepass")
        plain = PLAIN.fullmatch(text)
        if plain:
            stem = plain[1].lower().encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.tokenizer.model.tokenize(stem)]
            value = np.array(ids, "<u4").tobytes() + self.marks[plain[2]]
        else:
            value = self._encode(text)
        if len(self.known) >= self.remembered:
            self.known.clear()
        self.known[word] = value
        return value

    def words(self, text: str) -> list[bytes]:
        """Ids of each white-space word of ``text``."""
        data = text.encode("utf-8", "surrogatepass")
        if data.isascii() and b"<|" not in data:
            data = data.lower()  # plain letters only: the same ids, fewer words to remember
        get, learn = self.known.get, self._learn
        return [get(w) or learn(w) for w in data.split()]

    def ids(self, text: str) -> bytes:
        return b"".join(self.words(text))


@lru_cache(maxsize=4)
def word_ids(path: str) -> WordIds:
    """One encoder for each Python worker and vocabulary, kept between its tasks."""
    return WordIds(path)
