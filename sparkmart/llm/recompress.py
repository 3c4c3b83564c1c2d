"""Recompression of word sequences: rounds that name runs and pairs of symbols.

A round first names every maximal run of one symbol, then every pair of a left
symbol followed by a right one; which symbols are left and which right is a
bit of their names, drawn anew in each round. A name is a 64-bit hash of what
it stands for, so that all tasks give equal content the same name without
asking each other. Equal substrings therefore get the same symbols, but for a
few at their edges.

Every symbol carries the words it stands for and its *context*: the words that
fix it. Wherever the words of its context stand, the same symbol stands at the
same place. Contexts that reach over an end of their text are open there.
"""

from __future__ import annotations

import numpy as np

from .words import U, mix, pair_hash

#: Stands for "beyond the text" in contexts.
OPEN = 1 << 40


class Symbols:
    """Symbols of all texts of a batch: `name`, context `low` to `high` (numbers of words), `text`."""

    def __init__(self, words: np.ndarray, text: np.ndarray):
        self.name = words
        self.low = np.arange(len(words), dtype=np.int64)
        self.high = self.low + 1
        self.text = text

    def round(self, salt: int, runs: bool) -> None:
        if runs:
            self._name_runs(salt)
        self._name_pairs(salt)

    def _keep(self, kept: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        self.name, self.text = self.name[kept], self.text[kept]
        self.low, self.high = low, high

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Contexts of the symbols before and after each; open at the ends of a text."""
        same = self.text[1:] == self.text[:-1]
        before = np.full(len(self.name), -OPEN)
        before[1:][same] = self.low[:-1][same]
        after = np.full(len(self.name), OPEN)
        after[:-1][same] = self.high[1:][same]
        return before, after

    def _name_runs(self, salt: int) -> None:
        """A symbol beside an equal one becomes part of a run, whose context reaches its neighbours."""
        if len(self.name) < 2:
            return
        equal = (self.name[1:] == self.name[:-1]) & (self.text[1:] == self.text[:-1])
        if not equal.any():
            self.low, self.high = self._widened(np.ones(len(self.name), bool), np.ones(len(self.name), bool))
            return
        first = np.concatenate([[True], ~equal])
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(first)) - 1
        low, high = self._widened(first, np.append(~equal, True))
        length = ends - starts + 1
        named = np.where(length > 1, pair_hash(self.name[starts], length.astype(U), 2 * salt + 1), self.name[starts])
        self._keep(starts, np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts))
        self.name = named

    def _widened(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Contexts with those of the neighbour before where `left`, after where `right`."""
        before, after = self._neighbours()
        return np.where(left, np.minimum(self.low, before), self.low), np.where(right, np.maximum(self.high, after), self.high)

    def _name_pairs(self, salt: int) -> None:
        """A left symbol and the right one after it become a pair; a symbol alone depends on the neighbour it might have joined."""
        if len(self.name) < 2:
            return
        is_right = (mix(self.name + U(salt + 1)) & U(1)).astype(bool)
        joins = ~is_right[:-1] & is_right[1:] & (self.text[1:] == self.text[:-1])
        opens = np.append(joins, False)
        closes = np.concatenate([[False], joins])
        low, high = self._widened(is_right & ~closes, ~is_right & ~opens)
        at = np.flatnonzero(opens)
        self.name = self.name.copy()
        self.name[at] = pair_hash(self.name[at], self.name[at + 1], 2 * salt)
        low[at], high[at] = np.minimum(low[at], low[at + 1]), np.maximum(high[at], high[at + 1])
        kept = ~closes
        self._keep(kept, low[kept], high[kept])


def symbols(words: np.ndarray, text: np.ndarray, rounds: int, run_rounds: int) -> Symbols:
    """Symbols after `rounds` rounds; the first `run_rounds` of them name runs as well."""
    out = Symbols(words, text)
    for salt in range(rounds):
        out.round(salt, salt < run_rounds)
    return out
