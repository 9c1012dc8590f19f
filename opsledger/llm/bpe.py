"""Byte-pair merging with a heap of merge ranks over a linked symbol list.

``PairTable`` holds a vocabulary file's merges. ``PieceCounter`` counts tokens of a byte-level vocabulary without
producing ids; ``ByteEncoder`` gives its ids; ``WordCodec`` encodes and decodes a vocabulary with word ends.
All caches are bounded, which costs time and never changes a result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import regex

SPACE = "\t-\r \x85\xa0  -     　"
#: The pre-split patterns that the two vocabulary files state.
BYTE_SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|[" + SPACE + r"]+(?![^" + SPACE
              + r"])|[" + SPACE + r"]+")
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + SPACE + r"\p{L}\p{N}]+"
WORD_END = "</w>"

CACHE_ENTRIES = 250_000
CACHED_CHARS = 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PairTable:
    """Merge ranks of a vocabulary file: ``left << 16 | right`` gives ``rank << 16 | merged``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model = whole["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in whole["added_tokens"]}
        if max(self.ids.values()) >= 1 << 16:
            raise ValueError("vocabularies of more than 65,536 entries need wider keys")
        ids, self.pairs = self.ids, {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs[ids[left] << 16 | ids[right]] = rank << 16 | ids[left + right]
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        letters = byte_letters()
        self.byte_id = [ids[c] for c in letters]
        self.last_byte_id = [ids.get(c + WORD_END, -1) for c in letters]

    def parts(self, text: str) -> list[str]:
        """Texts between special strings at even places, the special strings themselves at odd ones."""
        if self.split_special is None or not any(s in text for s in self.special):
            return [text]
        return self.split_special.split(text)


@lru_cache(maxsize=4)
def pair_table(path: str) -> PairTable:
    return PairTable(path)


def merge(symbols: list[int], pairs: dict[int, int]) -> int:
    """Merge ``symbols`` in place by rank, leftmost first; dead places become -1. Returns the number of merges.

    The heap may hold entries whose symbols have changed since; such an entry is skipped when it is popped.
    """
    n, get, merges = len(symbols), pairs.get, 0
    heap = []
    for i in range(n - 1):
        hit = get(symbols[i] << 16 | symbols[i + 1])
        if hit is not None:
            heap.append(hit << 32 | i)
    if not heap:
        return 0
    heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        item = heappop(heap)
        i, hit = item & 0xFFFFFFFF, item >> 32
        left, j = symbols[i], after[i]
        if left < 0 or j >= n or get(left << 16 | symbols[j]) != hit:
            continue
        left = symbols[i] = hit & 0xFFFF
        symbols[j] = -1
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            hit = get(left << 16 | symbols[k])
            if hit is not None:
                heappush(heap, hit << 32 | i)
        k = before[i]
        if k >= 0:
            hit = get(symbols[k] << 16 | left)
            if hit is not None:
                heappush(heap, hit << 32 | k)
    return merges


class Irregular(Exception):
    """A text in which a run of white space reaches over a single space."""


class _Cache(dict):
    """Value per piece of text, made on first use, in two generations; long pieces are not kept.

    When the younger generation is full it becomes the older one, whose pieces come back when they are used again. So
    frequent pieces stay, and only those that were not used for a whole generation are made anew.
    """

    def __init__(self, make):
        self.make, self.older = make, {}

    def __missing__(self, piece):
        value = self.older.get(piece)
        if value is None:
            value = self.make(piece)
            if len(piece) > CACHED_CHARS:
                return value
        if len(self) >= CACHE_ENTRIES:
            self.older = dict(self)
            self.clear()
        self[piece] = value
        return value


class _BytePieces:
    """Values of a byte-level text piece by piece.

    A text is cut before each single space; the pre-split pattern never joins such pieces unless white space stands
    on both sides of that space. A piece that is empty or starts with white space therefore raises ``Irregular``
    and the text is split as a whole.
    """

    def __init__(self, path: str):
        self.table = pair_table(path)
        self.tokens = regex.compile(BYTE_SPLIT).findall
        self.words = _Cache(self.word)
        self.after_space = _Cache(self._after_space)

    def _after_space(self, piece: str):
        if not piece or piece[0].isspace():
            raise Irregular
        return self.joined(map(self.words.__getitem__, self.tokens(" " + piece)))

    def _part(self, text: str) -> list:
        """Values of a text without special strings, to be joined."""
        first, *rest = text.split(" ")
        try:
            return [*map(self.words.__getitem__, self.tokens(first)), *map(self.after_space.__getitem__, rest)]
        except Irregular:
            return list(map(self.words.__getitem__, self.tokens(text)))

    def of(self, text: str | None):
        values = []
        for place, part in enumerate(self.table.parts(text or "")):
            if place % 2:
                values.append(self.special(part))
            elif part:
                values += self._part(part)
        return self.joined(values)


class PieceCounter(_BytePieces):
    """Number of tokens: the initial symbols less the merges; no ids are emitted."""

    joined = staticmethod(sum)

    def word(self, token: str) -> int:
        symbols = [*map(self.table.byte_id.__getitem__, token.encode("utf-8"))]
        return len(symbols) - merge(symbols, self.table.pairs)

    def special(self, _part: str) -> int:
        return 1


class ByteEncoder(_BytePieces):
    """Token ids as little-endian 16-bit numbers in one bytes object."""

    joined = staticmethod(b"".join)

    def word(self, token: str) -> bytes:
        symbols = [*map(self.table.byte_id.__getitem__, token.encode("utf-8"))]
        merge(symbols, self.table.pairs)
        return array("H", [s for s in symbols if s >= 0]).tobytes()

    def special(self, part: str) -> bytes:
        return array("H", [self.table.special[part]]).tobytes()


class WordCodec:
    """Ids and back for a vocabulary whose words end in a mark: text is composed, lower-cased, white space dropped."""

    def __init__(self, path: str):
        self.table = pair_table(path)
        self.other_space = re.compile("[" + SPACE.replace(" ", "") + "]")
        self.tokens = regex.compile(WORD_SPLIT).findall
        self.words = _Cache(self._word)
        self.pieces = _Cache(lambda piece: tuple(chain.from_iterable(map(self.words.__getitem__, self.tokens(piece)))))
        named = {**self.table.ids, **self.table.special}
        self.strings = [""] * (max(named.values()) + 1)
        for s, i in named.items():
            self.strings[i] = s

    def _word(self, token: str) -> tuple[int, ...]:
        raw = token.encode("utf-8")
        symbols = [*map(self.table.byte_id.__getitem__, raw)]
        symbols[-1] = self.table.last_byte_id[raw[-1]]
        merge(symbols, self.table.pairs)
        return tuple(s for s in symbols if s >= 0)

    def _normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # lower-casing looks at single characters, so no final sigma
                text = text.replace("Σ", "σ")
        return self.other_space.sub(" ", text).lower()

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        for place, part in enumerate(self.table.parts(text or "")):
            if place % 2:
                ids.append(self.table.special[part])
            elif part:
                ids.extend(chain.from_iterable(map(self.pieces.__getitem__, self._normal(part).split(" "))))
        return ids

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings one after the other; this vocabulary file names no joiner, so one space stands between."""
        return " ".join(map(self.strings.__getitem__, ids))
