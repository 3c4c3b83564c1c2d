"""Words of whole texts as 64-bit hashes, computed over Arrow batches at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
#: Odd multipliers of the polynomial over bytes and of the mixing steps; any odd numbers do.
BYTE_BASE = U(0x9E3779B97F4A7C15)
MIX_1, MIX_2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII apart from digits and letters parts alphanumeric words; bytes of longer characters belong to words.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
#: Keeps the first n of eight bytes.
MASKS = np.array([2 ** (8 * n) - 1 for n in range(9)], U)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all bits; a bijection."""
    x = x ^ (x >> U(30))
    x = x * MIX_1
    x ^= x >> U(27)
    x *= MIX_2
    x ^= x >> U(31)
    return x


def pair_hash(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    return mix(mix(a + U((salt * 0x9E3779B97F4A7C15 + 0x1B873593) % 2**64)) + b * BYTE_BASE)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), U)
    out[1:] = base
    return np.multiply.accumulate(out, out=out)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each text starts in them (one place more than texts); null has none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    texts = texts.cast(pa.large_binary()).fill_null(b"") if texts.null_count else texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[places[0] : places[-1]], places - places[0]


def piece_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of pieces of `data`; eight bytes at a time are folded into all that are long enough."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    lengths = end - begin
    out = mix(eights[begin] & MASKS[np.minimum(lengths, 8)]) + lengths.astype(U)
    rest, at = np.flatnonzero(lengths > 8), 8
    while len(rest):
        value = eights[begin[rest] + at] & MASKS[np.minimum(lengths[rest] - at, 8)]
        out[rest] = mix(out[rest] * BYTE_BASE + value)
        at += 8
        rest = rest[lengths[rest] > at]
    return mix(out)


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sort(np.concatenate([a, b]), kind="stable") if len(b) else a


class Words:
    """Words of the texts of one batch.

    `hash`: of each word; `begin`, `end`: its place in `bytes`; `first`: number
    of the first word of each text (one place more than texts); `text`: the
    text that each word is in.
    """

    def __init__(self, texts: pa.Array, parts: np.ndarray = SPACES, lower: bool = False):
        self.bytes, places = utf8(texts)
        if lower:
            self.bytes = LOWER[self.bytes]
        inside = np.zeros(len(self.bytes) + 2, bool)
        np.take(~parts, self.bytes, out=inside[1:-1])
        turns = inside[1:] != inside[:-1]
        turns[places] = False
        begin = np.flatnonzero(turns & inside[1:])
        end = np.flatnonzero(turns & inside[:-1])
        # a word ends where its text ends, and begins where its text begins
        cuts = np.unique(places)
        self.begin = _merged(begin, cuts[inside[cuts + 1]])
        self.end = _merged(end, cuts[inside[cuts]])
        self.first = np.searchsorted(self.begin, places)
        self.text = np.repeat(np.arange(len(places) - 1), np.diff(self.first))
        self.hash = piece_hashes(self.bytes, self.begin, self.end)

    def word(self, i: int) -> bytes:
        return self.bytes[self.begin[i] : self.end[i]].tobytes()


def rolling(values: np.ndarray, width: int, salt: int) -> np.ndarray:
    """A hash of every `width` consecutive values, in order of their first ones (whatever texts they are in)."""
    if len(values) < width:
        return np.zeros(0, U)
    out = mix(values + U((salt * 2 + 1) * 0x632BE59BD9B4E019 % 2**64))
    base, total, done = U(0xD6E8FEB86659FD93 + 4 * salt), out, 1
    # doubling: the hash of 2n values from two of n values, then of the remaining bits
    spans = {1: out}
    while done * 2 <= width:
        high = U(pow(int(base), done, 2**64))
        total = total[:-done] * high + total[done:]
        done *= 2
        spans[done] = total
    length = done
    while length < width:
        step = 1 << ((width - length).bit_length() - 1)
        n = len(values) - length - step + 1
        total = total[:n] * U(pow(int(base), step, 2**64)) + spans[step][length : length + n]
        length += step
    return mix(total)
