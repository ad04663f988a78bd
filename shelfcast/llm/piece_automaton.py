"""SentencePiece encoding and decoding with an Aho-Corasick automaton over the pieces.

One pass over a word; at each position the automaton's output links give every piece that ends
there, and the piece is relaxed into the best path to that position:

* *unigram* models: the largest sum of scores, the longer last piece on ties (Viterbi);
* *BPE* models: merges leave exactly one path whose neighbouring pieces do not merge otherwise,
  so the path to a position is extended by the piece that merging the pair of last pieces
  leaves as it is.  That is the sequence the merges give, without running them over the word.

A word is a run of ``▁`` (the mark of a space) and what follows up to the next; pieces hold the
mark in front only, so words are independent and each is solved once in a Python worker.
Characters without a piece become their UTF-8 bytes, or the unknown id where the model has no
byte pieces.  Decoding joins pieces and bytes again and takes the dummy space away.

Defined results: a null text has null ids and null text; an empty text has no ids; rows and
their order are kept, other columns are not read.  A literal ``▁`` decodes to a space, as in the
library.  Models that normalise texts are refused: only the identity is implemented.
"""

from __future__ import annotations

import re
from functools import lru_cache
from math import inf
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, IntegerType, LongType, StringType, StructField, StructType,
)

from shelfcast.llm.arrow import map_lists
from shelfcast.llm.memo import Memo

SPACE = "▁"
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

#: Fixed values of the model format: kinds of pieces, kinds of models, penalty of the unknown.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0

#: Words, and pairs of pieces, remembered by one Python worker.
REMEMBERED_WORDS, REMEMBERED_PAIRS = 600_000, 600_000
#: Characters of the longest word remembered: text without spaces is one word.
LONGEST_REMEMBERED = 64


class PieceModel:
    """Pieces, scores and automaton of one model file's content."""

    def __init__(self, content: bytes):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as format_of

        model = format_of.ModelProto()
        model.ParseFromString(content)
        how = model.normalizer_spec
        if how.precompiled_charsmap or how.remove_extra_whitespaces or not how.escape_whitespaces:
            raise ValueError("only models without normalisation are supported")
        if model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with the space mark behind words are not supported")
        self.kind = model.trainer_spec.model_type
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        self.prefix = SPACE if how.add_dummy_prefix else ""
        self.id, self.score, self.bytes_of, self.byte_id = {}, {}, [], {}
        self.unknown = 0
        self.automaton = ahocorasick.Automaton()
        for number, piece in enumerate(model.pieces):
            raw = b""
            if piece.type == BYTE:
                raw = bytes([int(piece.piece[3:5], 16)])
                self.byte_id[raw[0]] = number
            elif piece.type == UNKNOWN:
                self.unknown, raw = number, model.trainer_spec.unk_surface.encode()
            elif piece.type == NORMAL:
                raw = piece.piece.replace(SPACE, " ").encode()
                self.id[piece.piece], self.score[piece.piece] = number, piece.score
                self.automaton.add_word(piece.piece, piece.piece)
                if SPACE in piece.piece.lstrip(SPACE):
                    raise ValueError("a piece goes on after the next space mark")
            elif piece.type != CONTROL:
                raise ValueError("user-defined and unused pieces are not supported")
            self.bytes_of.append(raw)
        self.automaton.make_automaton()
        self.least = min(self.score.values()) - UNKNOWN_PENALTY
        self.characters = frozenset(p for p in self.id if len(p) == 1)
        #: pairs of characters side by side in some piece: no piece spans any other pair
        self.adjacent = {p[i : i + 2] for p in self.id for i in range(len(p) - 1)}
        self.stays = Memo(self._stay, REMEMBERED_PAIRS)
        self.known = Memo(self._solve, REMEMBERED_WORDS)
        if self.kind == BPE:
            self._trace_merges()

    # paths through one word

    def _trace_merges(self) -> None:
        """How each piece comes about: the pair that its last merge joins, and when.

        A piece is born by its score, characters first of all.  Pieces that merging does not
        give back, or whose parts are born after them, are ``odd``.
        """
        self.made_of: dict[str, tuple[str, str]] = {}
        self.born = dict.fromkeys(self.characters, inf)
        self.odd = set()
        for piece, score in self.score.items():
            if len(piece) == 1:
                continue
            parts = self._merged(piece, until=2)
            if len(parts) == 2 and piece in self.score:
                self.made_of[piece] = (parts[0], parts[1])
                self.born[piece] = score
            else:
                self.odd.add(piece)
        for piece, parts in self.made_of.items():
            if any(len(p) > 1 and not self.born.get(p, -inf) > self.born[piece] for p in parts):
                self.odd.add(piece)

    def _merged(self, text: str, until: int = 1) -> list[str]:
        """The merges, run over a short text: best score first, then leftmost."""
        parts = list(text)
        while True:
            if len(parts) <= until:
                return parts
            best, at = None, -1
            for i, pair in enumerate(zip(parts, parts[1:])):
                score = self.score.get(pair[0] + pair[1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _stay(self, pair: tuple[str, str]) -> bool:
        """Whether merging the two pieces' text gives just these two (the left may be empty)."""
        left, right = pair
        if self.odd.isdisjoint(pair):
            return self._stay_apart(left, right)
        return self._merged(left + right) == ([left, right] if left else [right])

    def _stay_apart(self, left: str, right: str) -> bool:
        """The same for pieces that are not odd, by taking their merges back, latest first.

        Before each merge the two pieces' ends meet; had these merged at an earlier rank, or at
        the same rank and further left, the pair would not have come about.
        """
        if not left:
            return True
        score, born, made_of = self.score, self.born, self.made_of
        limit, tie = -inf, False
        while True:
            across = score.get(left + right)
            if across is not None and (across > limit or (tie and across == limit)):
                return False
            born_left, born_right = born.get(left, inf), born.get(right, inf)
            if born_left < born_right:
                limit, tie, left = born_left, False, made_of[left][1]
            elif born_right < inf:
                limit, tie, right = born_right, True, made_of[right][0]
            else:
                return True

    def _endings(self, word: str) -> list[list[str]]:
        """By end position: the pieces that end there, longest first."""
        ends: list[list[str]] = [[] for _ in range(len(word) + 1)]
        for end, piece in self.automaton.iter(word):
            ends[end + 1].append(piece)
        for end, pieces in enumerate(ends):
            pieces.sort(key=len, reverse=True)
            if end and (not pieces or len(pieces[-1]) > 1):
                pieces.append(word[end - 1])  # a character without a piece
        return ends

    def _path_bpe(self, word: str) -> list[str]:
        last: list[str | None] = [""] + [None] * len(word)
        if self.characters.issuperset(word):
            stays = self.stays
            for at, piece in self.automaton.iter(word):  # by end, longest first
                end = at + 1
                if last[end] is None:
                    before = last[end - len(piece)]
                    if before is not None and stays[before, piece]:
                        last[end] = piece
            return self._back(word, last)
        for end, pieces in enumerate(self._endings(word)):
            for piece in pieces:
                before = last[end - len(piece)]
                if before is not None and self.stays[before, piece]:
                    last[end] = piece
                    break
        return self._back(word, last)

    def _path_unigram(self, word: str) -> list[str]:
        last: list[str | None] = [""] + [None] * len(word)
        best = [0.0] + [0.0] * len(word)
        for end, pieces in enumerate(self._endings(word)):
            for piece in pieces:
                score = best[end - len(piece)] + self.score.get(piece, self.least)
                if last[end] is None or score > best[end]:
                    last[end], best[end] = piece, score
        return self._back(word, last)

    def _back(self, word: str, last: list[str | None]) -> list[str]:
        out, end = [], len(word)
        while end:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def _solve(self, word: str) -> bytes:
        adjacent = self.adjacent
        cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in adjacent]
        if cuts:  # often before a comma or full stop; everywhere in text of rare characters
            ends = [*cuts, len(word)]
            return self._joined([word[i:j] for i, j in zip([0, *cuts], ends)])
        ids: list[int] = []
        for piece in self._path_bpe(word) if self.kind == BPE else self._path_unigram(word):
            number = self.id.get(piece)
            if number is not None:
                ids.append(number)
            elif self.byte_id:
                ids += [self.byte_id[b] for b in piece.encode("utf-8", "surrogatepass")]
            else:
                ids.append(self.unknown)
        return np.array(ids, "<i4").tobytes()

    def _joined(self, words: list[str]) -> bytes:
        if len(max(words, key=len)) <= LONGEST_REMEMBERED:
            return b"".join(map(self.known.__getitem__, words))
        return b"".join(
            self.known[w] if len(w) <= LONGEST_REMEMBERED else self._solve(w) for w in words
        )

    # texts

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not text:
            return b""
        marked = self.prefix + text.replace(" ", SPACE)
        ids = self._joined(WORD.findall(marked))
        if self.byte_id or self.unknown not in np.frombuffer(ids, "<i4"):
            return ids
        values = np.frombuffer(ids, "<i4")  # a run of unknown characters is one unknown piece
        again = (values[1:] == self.unknown) & (values[:-1] == self.unknown)
        return values[np.r_[True, ~again]].tobytes()

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        if self.prefix and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def piece_model(content: bytes) -> PieceModel:
    return PieceModel(content)


def read_model(path: str) -> bytes:
    """The content of a model file, a parameter of a few hundred kB sent with the tasks."""
    with open(path, "rb") as file:
        return file.read()


IDS = StructType(
    [StructField("ids", ArrayType(IntegerType())), StructField("ids_crc32", LongType())]
)


def encode(
    docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, text, ids, ids_crc32`` for every row.

    The sum is that of the ids as little-endian 32-bit integers.
    """

    def start():
        pieces = piece_model(model)

        def work(texts: list) -> dict[str, list]:
            found = [None if t is None else pieces.encode(t) for t in texts]
            sizes = [0 if f is None else len(f) // 4 for f in found]
            ends = np.cumsum([0, *sizes]).astype(np.int32)
            values = np.frombuffer(b"".join(f or b"" for f in found), "<i4")
            none = pa.array([f is None for f in found], pa.bool_())
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(values), mask=none)
            sums = [None if f is None else crc32(f) for f in found]
            return {"ids": ids, "ids_crc32": sums}

        return work

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    twice = source.select("doc_id", "text", F.col("text").alias("read"))
    return map_lists(twice, start, IDS, carry=2)


def decode(encoded: DataFrame, model: bytes, ids_col: str = "ids") -> DataFrame:
    """All columns and ``decoded``, the text of the ids."""

    def start():
        pieces = piece_model(model)

        def work(ids: list) -> dict[str, list]:
            return {"decoded": [None if i is None else pieces.decode(i.tolist()) for i in ids]}

        return work

    names = encoded.columns
    read = encoded.select(*names, F.col(ids_col).alias("read"))
    return map_lists(
        read, start, StructType([StructField("decoded", StringType())]), carry=len(names)
    )

