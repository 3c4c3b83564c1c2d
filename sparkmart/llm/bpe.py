"""Byte-level BPE encoding and decoding in two tiers (operator 3).

Pre-tokens that are in the vocabulary as a whole are resolved by a minimal
perfect hash. The others are merged from bytes: a heap holds the possible
merges by rank, and linked lists the parts that are left.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pretokens import Pretokens
from .texts import steps
from .words import U, mix, piece_hashes

#: Keys per bucket of the perfect hash; pieces that a worker remembers, and bytes of the longest one.
KEYS_PER_BUCKET = 4
REMEMBERED, LONGEST = 1 << 18, 64
#: Text bytes that are split at once (a longer text is taken whole): a byte takes some sixty bytes of arrays.
STEP_BYTES = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file with one base64 token and its rank a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class PerfectHash:
    """Maps n known 64-bit keys to 0..n-1 without gaps; others to any of these places.

    Keys are dealt into buckets; starting with the largest, each bucket gets
    the first displacement that sends its keys to free places. All buckets of
    one size that are still open try their next displacement together.
    """

    def __init__(self, keys: np.ndarray):
        self.n = len(keys)
        buckets = max(1, -(-self.n // KEYS_PER_BUCKET))
        self.shift = np.zeros(buckets, np.uint64)
        home = (keys % U(buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        starts = np.searchsorted(home[order], np.arange(buckets + 1))
        taken = np.zeros(max(self.n, 1), bool)
        for bucket in np.argsort(-(np.diff(starts)), kind="stable").tolist():
            own = keys[order[starts[bucket] : starts[bucket + 1]]]
            if not len(own):
                break
            shift = 0
            while True:
                # candidates are tried many at a time; single keys late in the table need many
                tries = np.arange(shift, shift + 64, dtype=U)
                places = self._place(own[None, :], tries[:, None])
                fine = ~taken[places].any(axis=1)
                if len(own) > 1:
                    ranked = np.sort(places, axis=1)
                    fine &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
                if fine.any():
                    good = int(fine.argmax())
                    self.shift[bucket] = tries[good]
                    taken[places[good]] = True
                    break
                shift += 64

    def _place(self, keys: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mix(keys + (shift + U(1)) * U(0x9E3779B97F4A7C15)) % U(max(self.n, 1))).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        return self._place(keys, self.shift[(keys % U(len(self.shift))).astype(np.int64)])


class Vocabulary:
    """Ranks of byte sequences, with the perfect hash over those that are whole tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        known = list(ranks)
        end = np.cumsum([len(token) for token in known], dtype=np.int64)
        hashes = piece_hashes(np.frombuffer(b"".join(known), np.uint8), np.concatenate([[0], end[:-1]]), end)
        self.perfect = PerfectHash(hashes)
        at = self.perfect(hashes)
        self.keys = np.zeros(max(len(known), 1), np.uint64)
        self.keys[at] = hashes
        self.ids = np.full(max(len(known), 1), -1)
        self.ids[at] = list(ranks.values())
        self.remembered: dict[bytes, tuple[str, bytes, int]] = {}

    def whole(self, hashes: np.ndarray) -> np.ndarray:
        """The rank of each piece that is a token as a whole, -1 for others."""
        at = self.perfect(hashes)
        return np.where(self.keys[at] == hashes, self.ids[at], -1)

    def merged(self, piece: bytes) -> list[int]:
        """The ranks that merging by lowest rank, leftmost first, leaves of a piece."""
        n = len(piece)
        ranks = self.ranks
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        part = [piece[i : i + 1] for i in range(n)]
        heap = []
        for i in range(n - 1):
            rank = ranks.get(piece[i : i + 2])
            if rank is not None:
                heap.append((rank, i, 2))
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            left = part[i]
            if left is None:
                continue
            j = after[i]
            if j == n or len(left) + len(part[j]) != size:
                continue  # one of the two has been merged since
            part[i] = left = left + part[j]
            part[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                rank = ranks.get(left + part[k])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, size + len(part[k])))
            h = before[i]
            if h >= 0:
                both = part[h] + left
                rank = ranks.get(both)
                if rank is not None:
                    heapq.heappush(heap, (rank, h, len(both)))
        return [ranks[p] for p in part if p is not None]

    def pieces(self, found: Pretokens) -> tuple[list[tuple[str, bytes, int]], np.ndarray]:
        """For each distinct pre-token its ids as text, what they decode to, and their number; and which one each pre-token is."""
        pieces, which = found.distinct()
        _, one = np.unique(which, return_index=True)
        whole = self.whole(found.hash[one])
        out = []
        remembered = self.remembered
        if len(remembered) + len(pieces) > REMEMBERED:
            remembered.clear()
        for piece, rank in zip(pieces, whole.tolist(), strict=True):
            known = remembered.get(piece)
            if known is None:
                # the vocabulary itself has the last word on a whole piece
                ids = [rank] if rank >= 0 and self.tokens[rank] == piece else [self.ranks[piece]] if piece in self.ranks else self.merged(piece)
                known = (" ".join(map(str, ids)), self.decode(ids), len(ids))
                if len(piece) <= LONGEST:
                    remembered[piece] = known
            out.append(known)
        return out, which

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


@cache
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, built once by the driver and sent to all tasks; its size is the file's."""
    return Vocabulary(read_ranks(path))


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`docs` with `n_tokens`, `ids` (decimal, joined by one space) and `decoded` (the bytes that the ids stand for).

    Every pre-token is encoded by itself, without special tokens. A null or
    empty text has no ids. Columns of the three names are replaced. `path` is
    a file of the driver's.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    new = ("n_tokens", "ids", "decoded")
    rest = [c for c in docs.columns if c not in new]
    spare = next(name for name in ("_text", *(f"_text_{i}" for i in range(len(docs.columns) + 1))) if name not in docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in steps(batches, STEP_BYTES):
            found = Pretokens(batch.column(batch.num_columns - 1))
            pieces, which = known.pieces(found)
            ids = np.array([p[0] for p in pieces], object)
            decoded = np.array([p[1] for p in pieces], object)
            counts = np.concatenate([[0], np.cumsum(np.array([p[2] for p in pieces], np.int64)[which])])[found.first]
            id_texts, byte_texts = [], []
            for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
                own = which[a:b]
                id_texts.append(" ".join(ids[own].tolist()))
                byte_texts.append(b"".join(decoded[own].tolist()))
            arrays = [pa.array(np.diff(counts)), pa.array(id_texts, pa.string()), pa.array(byte_texts, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=[*rest, *new])

    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.StringType()), T.StructField("decoded", T.BinaryType())]
    ready = docs.select(*(F.col(f"`{c}`") for c in rest), F.col(text).alias(spare))
    return ready.mapInArrow(run, T.StructType([*(docs.schema[c] for c in rest), *added]))


def decode(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """`docs` with `decoded`, the bytes of the decimal ids in `ids`; null where that is null. An id outside the vocabulary raises."""
    rest = [c for c in docs.columns if c != "decoded"]
    place = rest.index(ids)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            out = [None if x is None else known.decode(list(map(int, x.split()))) for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*rest, "decoded"])

    return docs.select(*(F.col(f"`{c}`") for c in rest)).mapInArrow(run, T.StructType([*(docs.schema[c] for c in rest), T.StructField("decoded", T.BinaryType())]))
