"""Benchmark decontamination by suffix arrays of the training texts (operator 7).

Training texts are cut into shards of some million words. A shard gets a word
suffix array, in which every suffix of every benchmark item is looked up by
binary search. That gives the longest verbatim matches and their places; the
words of matches of a window or more are hit. Suffixes that begin with fewer
words of the benchmark's vocabulary than any window has can't match and are
left out of the array.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .texts import steps
from .words import NOT_ALNUM, Words

WINDOW = 13
#: A benchmark is searched in blocks of so many bytes of text; a block is all that is sent to the tasks at once.
BLOCK_BYTES = 16 << 20
#: Bytes of training text in one shard.
SHARD_BYTES = 8 << 20
#: A document is contaminated from one hit word in so many on.
SHARE = 20


class Suffixes:
    """The suffixes of one block of benchmark items that a window starts at."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int = WINDOW):
        words = Words(pa.array(texts, pa.string()), NOT_ALNUM, lower=True)
        counts = np.diff(words.first)
        self.ids = ids
        self.vocabulary, own = np.unique(words.hash, return_inverse=True)
        self.words = np.append(own.astype(np.int64) + 1, np.zeros(window, np.int64))
        length = np.minimum(counts, window)[words.text]
        left = words.first[words.text + 1] - np.arange(len(words.hash))
        self.start = np.flatnonzero(left >= length)
        self.length = length[self.start]
        self.item = words.text[self.start]
        self.left = left[self.start]
        self.shortest = int(self.length.min(initial=window))
        self.window = window

    def __len__(self) -> int:
        return len(self.start)


class SuffixArray:
    """Suffixes of a shard in the order of their first `depth` words, as numbers of a vocabulary (0: not in it)."""

    def __init__(self, words: np.ndarray, text: np.ndarray, shortest: int, depth: int):
        n = len(words)
        breaks = np.ones(n + 1, bool)
        breaks[:n] = words == 0
        ends = np.flatnonzero(breaks)
        inside = np.minimum(ends[np.searchsorted(ends, np.arange(n))], np.searchsorted(text, text, side="right")) if n else np.zeros(0, np.int64)
        self.run = inside - np.arange(n)
        at = np.flatnonzero(self.run >= shortest)
        self.words = np.append(words, np.zeros(depth, np.int64))
        keys = []
        for d in range(depth):
            keys.append(np.where(self.run[at] > d, self.words[at + d], 0))
        packed = [keys[d] << 32 | (keys[d + 1] if d + 1 < depth else 0) for d in range(0, depth, 2)]
        self.places = at[np.lexsort(packed[::-1])] if len(at) else at
        self.sorted = [key[np.lexsort(packed[::-1])] for key in keys] if len(at) else keys
        self.depth = depth

    def interval(self, wanted: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the suffixes that begin with the first `length` words of each wanted row begin and end in the array."""
        low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(self.places))
        return self._search(wanted, length, low.copy(), high.copy(), False), self._search(wanted, length, low, high, True)

    def _search(self, wanted: np.ndarray, length: np.ndarray, low: np.ndarray, high: np.ndarray, after: bool) -> np.ndarray:
        table = np.stack(self.sorted, axis=1) if len(self.places) else np.zeros((0, self.depth), np.int64)
        used = np.arange(self.depth)[None, :] < length[:, None]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) >> 1
            differ = (table[middle] - wanted[open_]) * used[open_]
            first = (differ != 0).argmax(axis=1)
            sign = differ[np.arange(len(open_)), first]
            right = sign <= 0 if after else sign < 0
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]


def matches(texts: pa.Array, suffixes: Suffixes) -> tuple[Words, dict[str, np.ndarray]]:
    """All places where a window of the benchmark stands: text, word, item, word of the item, and the length of the longest match there."""
    words = Words(texts, NOT_ALNUM, lower=True)
    at = np.searchsorted(suffixes.vocabulary, words.hash)
    at[at == len(suffixes.vocabulary)] = 0
    number = np.where(suffixes.vocabulary[at] == words.hash, at + 1, 0) if len(suffixes.vocabulary) else np.zeros(len(at), np.int64)
    array = SuffixArray(number, words.text, suffixes.shortest, suffixes.window)
    wanted = suffixes.words[suffixes.start[:, None] + np.arange(suffixes.window)[None, :]]
    low, high = array.interval(wanted, suffixes.length)
    counts = high - low
    which = np.repeat(np.arange(len(suffixes)), counts)
    place = array.places[np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + low[which]]
    length = suffixes.length[which].copy()
    # the match goes on as long as both do
    open_ = np.flatnonzero((length < suffixes.left[which]) & (length < array.run[place]))
    while len(open_):
        same = suffixes.words[suffixes.start[which[open_]] + length[open_]] == number[place[open_] + length[open_]]
        open_ = open_[same]
        length[open_] += 1
        open_ = open_[(length[open_] < suffixes.left[which[open_]]) & (length[open_] < array.run[place[open_]])]
    return words, {"text": words.text[place], "word": place - words.first[words.text[place]], "item": suffixes.item[which], "item_word": suffixes.start[which], "length": length}


def _blocks(items: DataFrame, item: str, text: str, window: int) -> Iterator[Suffixes]:
    """Items that have text, in blocks of at most about BLOCK_BYTES, each fetched on its own."""
    rows = items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-2 * size // BLOCK_BYTES) if size > BLOCK_BYTES else 1)
    for i in range(n):
        own = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        got = own.dropDuplicates(["item", "text"]).collect()
        yield Suffixes([r["item"] for r in got], [r["text"] for r in got], window)


def scan(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """`docs` with `n_words`, `n_hit` (words inside a window of an item), `items` (sorted ids of the items found) and `longest` (match in words).

    Words are runs of digits, letters and characters beyond ASCII, A-Z
    lower-cased. An item of fewer words than the window is one window, one
    without words none. Null texts have no words; null item ids count as empty
    ones; columns of the four names are replaced.
    """
    blocks = [docs.sparkSession.sparkContext.broadcast(b) for b in _blocks(items, item, item_text, window)]
    new = ("n_words", "n_hit", "items", "longest")
    spare = next(name for name in ("_text", *(f"_text_{i}" for i in range(len(docs.columns) + 1))) if name not in docs.columns)
    rest = [c for c in docs.columns if c not in new]

    def search(batch: pa.Table) -> pa.Table:
        texts = batch.column(batch.num_columns - 1)
        covered, found, longest = None, [set() for _ in range(batch.num_rows)], np.zeros(batch.num_rows, np.int64)
        for block in blocks:
            suffixes = block.value
            words, got = matches(texts, suffixes)
            if covered is None:
                covered = np.zeros(len(words.hash) + 1, np.int64)
            start = words.first[got["text"]] + got["word"]
            np.add.at(covered, start, 1)
            np.add.at(covered, start + got["length"], -1)
            np.maximum.at(longest, got["text"], got["length"])
            for t, i in np.unique(np.stack([got["text"], got["item"]]), axis=1).T.tolist():
                found[t].add(suffixes.ids[i])
        hit = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
        values = [np.diff(words.first), np.diff(hit[words.first]), pa.array([sorted(x, key=str.encode) for x in found], pa.list_(pa.string())), longest]
        out = batch.drop_columns([batch.column_names[-1]])
        for name, value in zip(new, values, strict=True):
            out = out.append_column(name, value if isinstance(value, pa.Array) else pa.array(value.astype(np.int64)))
        return out

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in steps(batches):
            held.append(batch)
            size += batch.column(batch.num_columns - 1).nbytes
            if size >= SHARD_BYTES:
                yield from search(pa.Table.from_batches(held)).to_batches()
                held, size = [], 0
        if held:
            yield from search(pa.Table.from_batches(held)).to_batches()

    added = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("longest", T.LongType())]
    ready = docs.select(*(F.col(f"`{c}`") for c in rest), F.col(text).alias(spare))
    return ready.mapInArrow(shards, T.StructType([*(docs.schema[c] for c in rest), *added]))


def is_contaminated():
    return (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))


def clean(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents that aren't contaminated, with the columns they had."""
    kept = [F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(docs.columns)]
    found = scan(docs.select(*kept), items, f"kept_{docs.columns.index(text)}")
    return found.where(~is_contaminated()).select(*(F.col(f"kept_{i}").alias(c) for i, c in enumerate(docs.columns)))


def digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()
