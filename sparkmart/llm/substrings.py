"""Substring dedup by recompression (operator 1).

1. Texts are dealt by content, equal ones once.
2. Each is recompressed (`recompress.py`) into symbols of about six words. Every
   symbol whose context fits in a window is counted over all texts. A window
   around the context of a symbol that stands nowhere else can't be repeated;
   shared symbols leave windows over.
3. The windows left over are compared by 128-bit hashes of their words, which
   tells the repeated ones exactly.
4. Words inside a repeated window go.

Symbols and windows leave a bucket of texts once each, whatever their number
in it, so a passage that a third of all documents share sends one record per
bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blobs
from .recompress import symbols
from .texts import KEYS, distinct_texts, gathered, text_keys
from .words import U, Words, rolling

WINDOW = 35
#: Six rounds give symbols of 5.8 words and contexts of half a window; runs are named in the first.
ROUNDS, RUN_ROUNDS = 6, 1

NAMES = {"name": np.uint64, "ordinal": np.uint32, "low": np.uint32, "span": np.uint16}
KILLS = {"ordinal": np.uint32, "low": np.uint32, "span": np.uint16}
WINDOWS = {"one": np.uint64, "two": np.uint64, "ordinal": np.uint32, "place": np.uint32, "again": np.uint8}
MARKS = {"ordinal": np.uint32, "place": np.uint32}


def _local_counts(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each distinct key, and whether it stands at others too."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    starts = np.flatnonzero(new)
    return order[starts], np.diff(np.append(starts, len(order))) > 1


def _alone(name: np.ndarray) -> np.ndarray:
    first, again = _local_counts(name)
    return first[~again]


def _bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> U(32)) % U(n)).astype(np.int64)


def _by_sender(table: pa.Table, rows: np.ndarray) -> np.ndarray:
    return table["sender"].combine_chunks().to_numpy()[rows]


def _alive(words: Words, table: pa.Table, window: int) -> np.ndarray:
    """First words of the windows that no symbol rules out."""
    n = len(words.hash)
    if n < window:
        return np.zeros(0, np.int64)
    _, kills = blobs.unpack(table, KILLS)
    low = words.first[kills["ordinal"]] + kills["low"]
    first = np.maximum(low + kills["span"] - window, words.first[kills["ordinal"]])
    turn = np.bincount(first, minlength=n + 1) - np.bincount(low + 1, minlength=n + 2)[: n + 1]
    inside = words.text[window - 1 :] == words.text[: n - window + 1]
    return np.flatnonzero(inside & (np.cumsum(turn)[: n - window + 1] == 0))


def _window_keys(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    return rolling(words.hash, window, 1), rolling(words.hash, window, 2)


def repeated_passages(docs: DataFrame, text: str = "text", window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """Each distinct text once, without the words that lie in a window found elsewhere.

    A window is `window` consecutive words of one text; words are separated by
    ASCII white space. Returns the two text keys, `n_words`, `n_removed` and
    `kept_text` (the words left, joined by one space). Every row of `docs`
    counts: two rows of one text repeat all its windows. A null text is an
    empty one; texts shorter than the window keep all words; an empty table
    gives no rows. Columns other than `text` don't matter here.
    """
    texts = distinct_texts(docs, text)
    n = blobs.buckets(docs)
    deal = blobs.partitions(docs)

    def name(table: pa.Table) -> pa.Table:
        own, _ = gathered(table)
        words = Words(own["text"])
        got = symbols(words.hash, words.text, rounds, RUN_ROUNDS)
        fits = np.flatnonzero(got.high - got.low <= window)
        hashes = got.name[fits]
        first, again = _local_counts(hashes)
        at = fits[first]
        return blobs.pack(
            _bucket(got.name[at], n),
            table["bucket"][0].as_py(),
            {"name": got.name[at], "ordinal": got.text[at].astype(np.uint32), "low": (got.low[at] - words.first[got.text[at]]).astype(np.uint32), "span": np.where(again, 0, got.high[at] - got.low[at]).astype(np.uint16)},
        )

    def rule_out(table: pa.Table) -> pa.Table:
        rows, got = blobs.unpack(table, NAMES)
        at = _alone(got["name"])
        at = at[got["span"][at] > 0]
        return blobs.pack(_by_sender(table, rows)[at], table["bucket"][0].as_py(), {k: got[k][at] for k in KILLS})

    def left_over(table: pa.Table, kills: pa.Table) -> pa.Table:
        if not table.num_rows:
            return blobs.empty(WINDOWS)
        own, _ = gathered(table)
        words = Words(own["text"])
        alive = _alive(words, kills, window)
        one, two = (x[alive] for x in _window_keys(words, window)) if len(alive) else (np.zeros(0, U), np.zeros(0, U))
        first, again = _local_counts(one, two)
        at = alive[first]
        return blobs.pack(
            _bucket(one[first], n),
            table["bucket"][0].as_py(),
            {"one": one[first], "two": two[first], "ordinal": words.text[at].astype(np.uint32), "place": (at - words.first[words.text[at]]).astype(np.uint32), "again": again.astype(np.uint8)},
        )

    def repeated(table: pa.Table) -> pa.Table:
        rows, got = blobs.unpack(table, WINDOWS)
        order = np.lexsort((got["two"], got["one"]))
        one, two = got["one"][order], got["two"][order]
        same = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
        hit = np.concatenate([[False], same]) | np.append(same, False) if len(one) else np.zeros(0, bool)
        at = np.sort(order[hit | (got["again"][order] > 0)])
        return blobs.pack(_by_sender(table, rows)[at], table["bucket"][0].as_py(), {k: got[k][at] for k in MARKS})

    kept_schema = f"{KEYS[0]} long, {KEYS[1]} long, n_words long, n_removed long, kept_text string"

    def without(table: pa.Table, marks: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({k: pa.array([], t) for k, t in zip([*KEYS, "n_words", "n_removed", "kept_text"], [*[pa.int64()] * 4, pa.string()], strict=True)})
        own, copied = gathered(table)
        words = Words(own["text"])
        gone = _covered(words, marks, copied, window)
        return pa.table(
            {
                **{k: own[k] for k in KEYS},
                "n_words": np.diff(words.first),
                "n_removed": np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first]),
                "kept_text": pa.array(_kept(words, gone), pa.binary()).cast(pa.string()),
            }
        )

    kills = (
        texts.groupBy("bucket")
        .applyInArrow(name, blobs.schema(NAMES))
        .repartition(deal, "bucket")
        .groupBy("bucket")
        .applyInArrow(rule_out, blobs.schema(KILLS))
    )
    marks = (
        texts.groupBy("bucket")
        .cogroup(kills.groupBy("bucket"))
        .applyInArrow(left_over, blobs.schema(WINDOWS))
        .repartition(deal, "bucket")
        .groupBy("bucket")
        .applyInArrow(repeated, blobs.schema(MARKS))
    )
    return texts.groupBy("bucket").cogroup(marks.groupBy("bucket")).applyInArrow(without, kept_schema)


def _covered(words: Words, marks: pa.Table, copied: np.ndarray, window: int) -> np.ndarray:
    """Words in windows that stand elsewhere: in other buckets (marked), again in this one, or in a copy of the text."""
    n = len(words.hash)
    if n < window:
        return np.zeros(n, bool)
    _, got = blobs.unpack(marks, MARKS)
    hit = words.first[got["ordinal"]] + got["place"]
    one, two = _window_keys(words, window)
    inside = words.text[window - 1 :] == words.text[: n - window + 1]
    starts = inside & copied[words.text[: n - window + 1]]
    if len(hit):
        # a small table of bits leaves few windows to look up
        bits = np.zeros(1 << 22, bool)
        low = U((1 << 22) - 1)
        bits[(one[hit] & low).astype(np.int64)] = True
        maybe = np.flatnonzero(bits[(one & low).astype(np.int64)] & inside)
        order = np.lexsort((two[hit], one[hit]))
        known_one, known_two = one[hit][order], two[hit][order]
        at = np.minimum(np.searchsorted(known_one, one[maybe]), len(known_one) - 1)
        found = (known_one[at] == one[maybe]) & (known_two[at] == two[maybe])
        # equal first halves with different second ones are searched in full
        odd = np.flatnonzero((known_one[at] == one[maybe]) & ~found)
        if len(odd):
            known = set(zip(known_one.tolist(), known_two.tolist(), strict=True))
            found[odd] = [key in known for key in zip(one[maybe[odd]].tolist(), two[maybe[odd]].tolist(), strict=True)]
        starts[maybe[found]] = True
    turn = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(starts)
    turn[at] += 1
    turn[at + window] -= 1
    return np.cumsum(turn[:-1]) > 0


def _kept(words: Words, gone: np.ndarray) -> list[bytes]:
    out = []
    for first, end in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        own = ~gone[first:end]
        turns = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]])))
        pieces = (words.bytes[words.begin[first + a] : words.end[first + b - 1]].tobytes() for a, b in turns.reshape(-1, 2).tolist())
        out.append(b" ".join(w for piece in pieces for w in piece.split()))
    return out


def attach(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs`, each with what `found` says of its text; columns may have any names."""
    first, second = text_keys(F.col(f"`{text}`"))
    own = docs.select(*(F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(docs.columns)), first.alias("own_key_1"), second.alias("own_key_2"))
    other = [c for c in found.columns if c not in KEYS]
    found = found.select(F.col(KEYS[0]).alias("found_key_1"), F.col(KEYS[1]).alias("found_key_2"), *(F.col(f"`{c}`").alias(f"found_{i}") for i, c in enumerate(other)))
    joined = own.join(found, (F.col("own_key_1") == F.col("found_key_1")) & (F.col("own_key_2") == F.col("found_key_2")), "left")
    return joined.select(*(F.col(f"own_{i}").alias(c) for i, c in enumerate(docs.columns)), *(F.col(f"found_{i}").alias(c) for i, c in enumerate(other)))


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """`docs` with `text` replaced by what `repeated_passages` leaves of it; other columns stay as they are, whatever their names."""
    spare = next(name for name in ("_kept_text", *(f"_kept_text_{i}" for i in range(len(docs.columns) + 1))) if name not in docs.columns)
    found = repeated_passages(docs, text, window).select(*KEYS, F.col("kept_text").alias(spare))
    columns = [F.col(spare).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return attach(docs, found, text).select(*columns)
