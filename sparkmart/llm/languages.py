"""Language ID by bit-sliced Bloom filters over n-grams (operator 10).

Every language has a Bloom filter of its characteristic n-grams. The filters
are stored bit-sliced: one array whose element i holds bit i of all filters,
so that two look-ups and an AND give all languages that contain an n-gram.
More than 64 languages take several such arrays, one per 64 of them. A text
counts hits for each language, takes off the false positives to be
expected from how full its filter is, and goes to the language with most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blobs
from .components import written
from .texts import steps
from .words import U, mix, utf8

UNDECIDED = "und"
#: Bits of one language's filter: fixed, whatever the corpus; with one byte for up to eight languages it is 4 MB to broadcast.
FILTER_BITS = 22
HASHES = 2
#: An n-gram belongs to the languages in which it is at least this share as frequent as in the one where it is most frequent.
CHARACTERISTIC = 0.5
#: N-grams rarer than this among a language's are left out.
RAREST = 1e-6
#: Languages of one block of filters, the bits of one word.
BLOCK = 64
#: Text bytes whose n-grams are listed at once (a longer text is taken whole), and n-grams looked up at once: an n-gram takes some sixty bytes of arrays.
STEP_BYTES, LOOKUPS = 1 << 20, 1 << 19

#: Bytes apart from ASCII letters (lower case by then) and longer characters count as space.
LETTERS = np.full(256, 0x20, np.uint8)
LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
LETTERS[0x80:] = np.arange(0x80, 0x100)



def _counts(languages: int) -> dict[str, type]:
    return {"gram": np.uint32, "language": np.uint8 if languages <= 256 else np.uint32, "count": np.int64}


def prepared(text: Column) -> Column:
    return F.concat(F.lit("  "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All four-byte sequences of the prepared texts as numbers, white space and punctuation drawn together; and their texts."""
    raw, places = utf8(texts)
    data = LETTERS[raw]
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20)
    keep[places[:-1][places[:-1] < len(data)]] = True
    second = places[:-1] + 1
    keep[second[second < len(data)]] = True
    data = data[keep]
    first = np.concatenate([[0], np.cumsum(keep)])[places]
    if len(data) < 4:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    four = np.ndarray((len(data) - 3,), "<u4", data.data, strides=(1,)).astype(np.uint32)
    owner = np.repeat(np.arange(len(places) - 1), np.diff(first))
    inside = owner[3:] == owner[: len(four)]
    return four[inside], owner[: len(four)][inside]


def _counted(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    order = None if weights is None else np.argsort(values, kind="stable")
    values = np.sort(values) if order is None else values[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(values))) if order is None else np.add.reduceat(weights[order], starts) if len(starts) else weights
    return values[starts], counts


def _places(gram: np.ndarray) -> list[np.ndarray]:
    one = mix(gram.astype(U) + U(1))
    return [((one >> U(shift)) & U((1 << FILTER_BITS) - 1)).astype(np.int64) for shift in range(0, 24 * HASHES, 24)]


def _kinds(languages: int) -> list[type]:
    """The words of each block of filters: the smallest that have a bit for each of its languages."""
    sizes = [min(BLOCK, languages - first) for first in range(0, languages, BLOCK)]
    return [next(k for k, n in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 64)) if size <= n) for size in sizes]


@dataclass
class Filters:
    """`languages`, most frequent first; `blocks`: the sliced filters of 64 languages each; `wrong`: chance that a filter holds a foreign n-gram."""

    languages: list[str]
    blocks: list[np.ndarray]
    wrong: np.ndarray

    def hits(self, places: list[np.ndarray], block: int) -> np.ndarray:
        """The set of languages of one block that each n-gram, given by its places, is in, one bit each."""
        first, *rest = places
        bits = self.blocks[block]
        out = bits[first]
        for place in rest:
            out &= bits[place]
        return out

    def counts(self, block: int, gram: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """How many n-grams of each text each language of one block claims."""
        out = np.zeros((min(BLOCK, len(self.languages) - block * BLOCK), texts), np.int64)
        for at in range(0, len(gram), LOOKUPS):
            sets, own = self.hits(_places(gram[at : at + LOOKUPS]), block), owner[at : at + LOOKUPS]
            for i in range(len(out)):
                out[i] += np.bincount(own[(sets >> sets.dtype.type(i)) & sets.dtype.type(1) > 0], minlength=texts)
        return out


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Filters:
    """Filters learned from all rows of `labelled` that have a text and a language.

    Counts are summed by Spark over all rows. The driver gets the languages
    with their row numbers and the finished filters, half a megabyte for each
    language. Without any labelled
    row there are no languages, and every text is undecided.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    frequent = rows.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()
    languages = [r["lang"] for r in frequent]
    if not languages:
        return Filters([], [], np.zeros(0))
    kinds, layout = _kinds(len(languages)), _counts(len(languages))
    n = blobs.partitions(labelled)
    number = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def add(language: int, new: tuple[np.ndarray, np.ndarray]) -> None:
            known = sums.setdefault(language, [])
            known.append(new)
            if len(known) > 8:
                sums[language] = [_counted(np.concatenate([g for g, _ in known]), np.concatenate([c for _, c in known]))]

        for batch in steps(batches, STEP_BYTES):
            mine = np.array([number.get(x, -1) for x in batch["lang"].to_pylist()])
            for language in np.unique(mine[mine >= 0]).tolist():
                gram, _ = grams(batch["text"].filter(pa.array(mine == language)))
                add(language, _counted(gram))
        for language, known in sums.items():
            gram, counts = _counted(np.concatenate([g for g, _ in known]), np.concatenate([c for _, c in known]))
            table = blobs.pack((mix(gram.astype(U)) % U(n)).astype(np.int64), language, {"gram": gram, "language": np.full(len(gram), language, layout["language"]), "count": counts.astype(np.int64)})
            yield from table.to_batches()

    def total(table: pa.Table) -> pa.Table:
        _, got = blobs.unpack(table, layout)
        key, counts = _counted(got["gram"].astype(np.int64) << 31 | got["language"].astype(np.int64), got["count"])
        return blobs.pack(np.full(len(key), table["bucket"][0].as_py()), 0, {"gram": (key >> 31).astype(np.uint32), "language": (key & 0x7FFFFFFF).astype(layout["language"]), "count": counts})

    counted = rows.select(F.col(lang).alias("lang"), prepared(F.col(text)).alias("text")).mapInArrow(count, blobs.schema(layout)).groupBy("bucket").applyInArrow(total, blobs.schema(layout))
    counted = written(counted, "grams")  # a few numbers per distinct n-gram and language

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(len(languages), np.int64)
        for batch in batches:
            _, got = blobs.unpack(pa.table(batch), layout)
            out += np.bincount(got["language"], got["count"], len(languages)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(languages)), pa.int32()), pa.array(out)], names=["language", "n"])

    sizes = np.zeros(len(languages))
    for r in counted.mapInArrow(sums, "language int, n long").groupBy("language").agg(F.sum("n").alias("n")).collect():
        sizes[r["language"]] = r["n"]

    slices = 64
    per = (1 << FILTER_BITS) // slices

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [np.zeros(1 << FILTER_BITS, kind) for kind in kinds]
        for batch in batches:
            _, got = blobs.unpack(pa.table(batch), layout)
            gram, at = np.unique(got["gram"], return_inverse=True)
            share = got["count"] / sizes[got["language"]]
            most = np.zeros(len(gram))
            np.maximum.at(most, at, share)
            own = np.flatnonzero((share >= RAREST) & (share >= CHARACTERISTIC * most[at]))
            own = own[np.argsort(got["language"][own], kind="stable")]
            language, first = np.unique(got["language"][own], return_index=True)
            for i, part in zip(language.tolist(), np.split(got["gram"][own], first[1:]), strict=False):
                bits = blocks[i // BLOCK]
                for place in _places(part):
                    bits[place] |= bits.dtype.type(1 << i % BLOCK)
        for block, bits in enumerate(blocks):
            for i in range(slices):
                own = bits[i * per : (i + 1) * per]
                if own.any():
                    yield pa.RecordBatch.from_arrays([pa.array([block * slices + i], pa.int32()), pa.array([own.tobytes()])], names=["slice", "bits"])

    def either(table: pa.Table) -> pa.Table:
        bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in table["bits"].to_pylist()])
        return pa.table({"slice": table["slice"][:1], "bits": pa.array([bits.tobytes()])})

    whole = [np.zeros(1 << FILTER_BITS, kind) for kind in kinds]
    # 64 rows per block, as large as the filters
    for at, bits in counted.mapInArrow(mark, "slice int, bits binary").groupBy("slice").applyInArrow(either, "slice int, bits binary").collect():
        block, i = divmod(at, slices)
        whole[block][i * per : (i + 1) * per] = np.frombuffer(bits, kinds[block])
    full = np.array([np.count_nonzero(whole[i // BLOCK] & kinds[i // BLOCK](1 << i % BLOCK)) / (1 << FILTER_BITS) for i in range(len(languages))])
    return Filters(languages, whole, full**HASHES)


def predict(docs: DataFrame, filters: Filters, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """`docs` with the language and the share of n-grams that its filter claims, false positives taken off (0 to 1).

    A text that is null or has no letter is `und` with score 0. One with
    letters but no known n-gram gets the most frequent language, with score 0;
    equal counts go to the more frequent language. Columns of the two names
    are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(filters)
    rest = [c for c in docs.columns if c not in (pred, score)]
    spare = next(name for name in ("_prepared", *(f"_prepared_{i}" for i in range(len(docs.columns) + 1))) if name not in docs.columns)
    ready = docs.select(*(F.col(f"`{c}`") for c in rest), F.when(F.col(text).rlike(r"\p{L}"), prepared(F.col(text))).alias(spare))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in steps(batches, STEP_BYTES):
            own = batch.column(batch.num_columns - 1)
            lettered = np.array(own.is_valid())
            best, most = np.zeros(batch.num_rows, np.int64), np.full(batch.num_rows, -1.0)
            gram, owner = grams(own)
            n = np.maximum(np.bincount(owner, minlength=batch.num_rows), 1)
            for block in range(len(known.blocks)):
                for i, hit in enumerate(known.counts(block, gram, owner, batch.num_rows), block * BLOCK):
                    wrong = known.wrong[i]
                    share = np.clip((hit - n * wrong) / (1 - wrong) / n, 0, 1) if wrong < 1 else np.zeros(batch.num_rows)
                    more = share > most
                    best[more], most[more] = i, share[more]
            if known.languages:
                names = np.array(known.languages, object)[best]
                names[~lettered] = UNDECIDED
                scores = np.where(lettered, most, 0.0)
            else:
                names, scores = np.full(batch.num_rows, UNDECIDED, object), np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*rest, pred, score])

    shape = T.StructType([*(docs.schema[c] for c in rest), T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])
    return ready.mapInArrow(decide, shape)


def held_out(key: Column) -> Column:
    """Rows kept out of the fit: a quarter, by the checksum of the key's text (a null key is not held out)."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))
