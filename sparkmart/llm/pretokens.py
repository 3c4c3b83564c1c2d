"""Pre-tokens of whole texts, found over Arrow batches at once.

The split is that of the pattern that the byte-level vocabularies name: English
contractions; runs of letters, of numbers or of other characters, each with a
space before it if there is one; and white space, whose last character is left
to what follows.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import regex

from .words import piece_hashes, utf8

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: The characters of the White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
APOSTROPHE = 0x27
#: The endings that an apostrophe takes with it.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")


@cache
def classes() -> np.ndarray:
    """The class of each code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    whole = "".join(every)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
        out[[ord(c) for c in regex.findall(pattern, whole)]] = kind
    out[WHITE_SPACE] = SPACE
    return out


class Pretokens:
    """Pre-tokens of the texts of one batch: `begin` and `end` in `bytes`, `hash`, and `first` of each text (one place more than texts)."""

    def __init__(self, texts: pa.Array):
        self.bytes, places = utf8(texts)
        char_at = np.flatnonzero((self.bytes & 0xC0) != 0x80)  # bytes that begin a character
        n = len(char_at)
        points = self._points(char_at)
        kind = classes()[points]
        doc_start = np.zeros(n + 1, bool)
        text_first = np.searchsorted(char_at, places)
        doc_start[text_first] = True
        doc_start[n] = True
        begins = doc_start.copy()
        begins[1:n] |= kind[1:] != kind[:-1]
        self._spaces(begins, doc_start, kind, points, n)
        self._contractions(begins, doc_start, kind, points, n)
        at = np.flatnonzero(begins[:n])
        self.begin = char_at[at]
        self.end = np.append(self.begin[1:], len(self.bytes))
        self.first = np.searchsorted(self.begin, places)
        self.hash = piece_hashes(self.bytes, self.begin, self.end)

    def _points(self, char_at: np.ndarray) -> np.ndarray:
        padded = np.concatenate([self.bytes, np.zeros(4, np.uint8)])
        lead = padded[char_at].astype(np.int32)
        points = lead.copy()
        for least, size, keep in ((0xC0, 2, 0x1F), (0xE0, 3, 0x0F), (0xF0, 4, 0x07)):
            own = np.flatnonzero(lead >= least)
            if not len(own):
                break
            value = lead[own] & keep
            for k in range(1, size):
                value = value << 6 | (padded[char_at[own] + k] & 0x3F)
            points[own] = value
        return points

    @staticmethod
    def _spaces(begins, doc_start, kind, points, n) -> None:
        """The last of some white space before other characters belongs to them if it is a space, and stands alone if not."""
        if not n:
            return
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~doc_start[1:n])
        begins[last] = True
        begins[last[points[last] == 0x20] + 1] = False

    @staticmethod
    def _contractions(begins, doc_start, kind, points, n) -> None:
        at = np.flatnonzero((points == APOSTROPHE) & begins[:n])
        at = at[(at + 1 < n)]
        at = at[~doc_start[at + 1] & (kind[at + 1] == LETTER)]
        if not len(at):
            return
        one = points[at + 1]
        length = np.where(np.isin(one, [ord(c) for c in SHORT_ENDINGS]), 2, 0)
        two = np.where((at + 2 < n) & ~doc_start[np.minimum(at + 2, n)], points[np.minimum(at + 2, n - 1)], 0)
        for ending in LONG_ENDINGS:
            length[(one == ord(ending[0])) & (two == ord(ending[1]))] = 3
        at, length = at[length > 0], length[length > 0]
        begins[at + 1] = False
        after = at + length
        begins[after[after < n]] = True

    def piece(self, i: int) -> bytes:
        return self.bytes[self.begin[i] : self.end[i]].tobytes()

    def distinct(self) -> tuple[list[bytes], np.ndarray]:
        """The different pre-tokens and, for each one, which of them it is, by 64-bit hashes."""
        _, one, which = np.unique(self.hash, return_index=True, return_inverse=True)
        data = self.bytes.tobytes()
        return [data[a:b] for a, b in zip(self.begin[one].tolist(), self.end[one].tolist(), strict=True)], which
