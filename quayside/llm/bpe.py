"""Byte-pair encoding with word ends by backtracking over longest token matches, and decoding by an offset table.

The encoder works on one white-space delimited token of text at a time, since no piece of the pre-tokenizer spans
white space. A piece is a string of byte symbols closed by an end mark. An Aho-Corasick automaton lists the tokens that
match at each position; the longest is tried first, shorter prefixes after it. Two neighbours are accepted only if the
merge order could have left that boundary standing, which a memo of token pairs answers. A position that no token can
leave is marked dead and never tried again, so the work is linear in the length of the piece.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import regex

WORD_BPE = "word_bpe_49k.json"

# Words and pieces of up to this many characters are remembered, this many words in each of two generations (a full one
# replaces the older) and this many pieces. Any other word is encoded each time it occurs.
CACHED_WORDS, CACHED_CHARS = 300_000, 40
CACHED_PAIRS = 400_000

_END = "\x00"
# str.split() takes these for white space, the pre-tokenizer does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"\s+")


def byte_symbols() -> list[str]:
    """The printable symbol of each byte: itself where printable in Latin-1, else the next code point from 256 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class WordBpe:
    """The tokenizer of one vocabulary file. Build it once per Python worker with ``load``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, suffix = described["model"], described["model"]["end_of_word_suffix"]
        self._symbols = dict(enumerate(byte_symbols()))
        pattern = described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._pieces = regex.compile(pattern)
        specials = {t["content"]: t["id"] for t in described["added_tokens"]}
        self._specials = specials
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")")

        vocab: dict[str, int] = model["vocab"]
        size = 1 + max([*vocab.values(), *specials.values()])
        surface: list[str] = [""] * size
        for token, number in (vocab | specials).items():
            surface[number] = token
        # Inside the automaton the word end is one symbol of its own.
        spelled = {t[: -len(suffix)] + _END if t.endswith(suffix) else t: n for t, n in vocab.items()}
        self._length = [0] * size
        self._shorter = [-1] * size
        automaton = ahocorasick.Automaton()
        for token, number in spelled.items():
            self._length[number] = len(token)
            self._shorter[number] = next((spelled[token[:k]] for k in range(len(token) - 1, 0, -1)
                                          if token[:k] in spelled), -1)
            automaton.add_word(token, number)
        automaton.make_automaton()
        self._automaton = automaton

        # For each token: the rank of the merge that makes it (-1: a base symbol) and its two parts.
        self._rank = [-1] * size
        self._left, self._right = list(range(size)), list(range(size))
        self._merged: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            self._rank[made], self._left[made], self._right[made] = rank, left, right
            self._merged[left, right] = rank
        self._compatible: dict[int, bool] = {}
        self._cache: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._cache_of_pieces: dict[str, bytes] = {}

        # Decoding: all surfaces in one byte array, each behind the blank that joins tokens, and where each begins.
        encoded = [b" " + s.encode() for s in surface]
        self._offsets = np.concatenate([[0], np.cumsum([len(e) for e in encoded])]).astype(np.int64)
        self._bytes = np.frombuffer(b"".join(encoded), np.uint8)

    def _may_stand(self, a: int, b: int) -> bool:
        """Whether the merges leave token a next to token b. Undo the later of the two merges again and again; the
        boundary falls if its own merge would have come before the one just undone (at equal rank, the left one)."""
        first, second, limit, stands = a, b, len(self._rank), True
        while True:
            across = self._merged.get((first, second))
            if across is not None and across < limit:
                stands = False
                break
            ra, rb = self._rank[first], self._rank[second]
            if ra < 0 and rb < 0:
                break
            if ra > rb:
                limit, first = ra, self._right[first]
            else:
                limit, second = rb + 1, self._left[second]
        if len(self._compatible) >= CACHED_PAIRS:
            self._compatible.clear()
        self._compatible[a << 20 | b] = stands
        return stands

    def encode_piece(self, piece: str) -> list[int]:
        """The ids of one piece of the pre-tokenizer."""
        if not (piece.isascii() and piece.isprintable()):
            piece = piece.encode("utf-8").decode("latin-1").translate(self._symbols)
        spelled = piece + _END
        n = len(spelled)
        length, shorter, compatible = self._length, self._shorter, self._compatible
        longest = [-1] * (n + 1)
        for end, token in self._automaton.iter(spelled):
            longest[end - length[token] + 1] = token  # later ends come later, so the longest stays
        dead: set[int] = set()
        out: list[int] = []
        at, last, token = 0, -1, longest[0]
        while at < n:
            while token >= 0:
                end = at + length[token]
                if end not in dead:
                    stands = last < 0 or compatible.get(last << 20 | token)
                    if stands is None:
                        stands = self._may_stand(last, token)
                    if stands:
                        out.append(token)
                        at, last, token = end, token, longest[end]
                        break
                token = shorter[token]
            else:
                dead.add(at)
                token = out.pop()
                at -= length[token]
                last, token = out[-1] if out else -1, shorter[token]
        return out

    def _piece(self, piece: str) -> bytes:
        found = self._cache_of_pieces.get(piece)
        if found is None:
            ids = self.encode_piece(piece)
            found = array("I", ids).tobytes()
            if len(piece) <= CACHED_CHARS:
                if len(self._cache_of_pieces) >= CACHED_WORDS:
                    self._cache_of_pieces.clear()
                self._cache_of_pieces[piece] = found
        return found

    def _encode_word(self, word: str) -> bytes:
        found = self._cache.get(word) or self._older.get(word)
        if found is None:
            if word.isalpha():  # letters alone are one piece
                found = self._piece(word)
            elif word[-1] in ".,!" and word[:-1].isalpha():
                found = self._piece(word[:-1]) + self._piece(word[-1])
            else:
                found = b"".join(map(self._piece, self._pieces.findall(word)))
        if len(word) <= CACHED_CHARS:
            if len(self._cache) >= CACHED_WORDS:
                self._cache, self._older = {}, self._cache
            self._cache[word] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text, as unsigned little-endian 32-bit numbers."""
        if "<|" not in text:
            return np.frombuffer(self._encode_plain(text), "<u4")
        parts = self._special.split(text)
        return np.frombuffer(b"".join(
            np.array([self._specials[p]], "<u4").tobytes() if k % 2 else self._encode_plain(p)
            for k, p in enumerate(parts)), "<u4")

    def _encode_plain(self, text: str) -> bytes:
        # Lower case by character, so no final sigma.
        plain = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        split = _SPACE.split(plain) if _SEPARATORS.search(plain) else plain.split()
        found = list(map(self._cache.get, split))
        if None in found:
            encode = self._encode_word
            found = [encode(w) if f is None and w else f or b"" for w, f in zip(split, found)]
        return b"".join(found)

    def decode(self, ids: np.ndarray) -> bytes:
        """The surfaces of the ids joined by blanks, in UTF-8. The offset table says which bytes each id copies."""
        if not len(ids):
            return b""
        starts = self._offsets[ids]
        lengths = self._offsets[ids + 1] - starts
        ends = np.cumsum(lengths)
        source = np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)
        return self._bytes[source][1:].tobytes()


@lru_cache(maxsize=2)
def load(path: str | None = None) -> WordBpe:
    return WordBpe(path or public_tokenizers.path(WORD_BPE))
