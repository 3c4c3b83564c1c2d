"""Phrase collocations (operator 11) by the stream layout of external estimation.

Words are counted first; those that are too rare for any phrase part the runs
of the others. Each place of a run then gives a window of the next five names.
Windows are dealt by ranges of their order and sorted, so that all phrases of
two to five words lie in runs of one stream, and a phrase that reaches over an
end of its range is summed from its parts. What is frequent is kept as a stream
of counts in prefix order (by first word, then second, ...) and one in suffix
order (by last word, then the one before, ...). A walk through the first, in
step with its own shorter phrases, gives each phrase the counts of all its
beginnings and tells which phrases one more word on the right doesn't thin out;
the walk through the second does the same for endings and words on the left.
No stream is looked up by hashing; a range that opens inside a phrase is sent
that phrase (four at most a range).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import blobs, texts, words
from .components import written

U = np.uint64
LEAST, LONGEST, FIRST = 100, 5, 2000
NO_LANG = "und"
#: Frequent words that tasks get numbers for, 16 bytes each; where there are more, the others go by their 64-bit hashes.
LISTED = 1 << 21
#: Windows sorted at once in a task; windows planned for one range; one place of so many helps to set the ranges, with this number of windows at most.
CHUNK, RANGE, SAMPLED, SETTING = 1 << 19, 1 << 20, 1 << 14, 1 << 20
#: Parts of a language that are ranked on their own before the last ranking.
RANKED = 64

PIECE_ENDS = np.zeros(256, bool)
PIECE_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
PARTS = PIECE_ENDS.copy()
PARTS[[0x20, 0x09]] = True
_CODEC = pa.Codec("zstd", compression_level=1)


@dataclass(frozen=True)
class _Names:
    """Numbers of the listed words, 1 for the most frequent; `whole` if no other word is frequent."""

    hashes: np.ndarray
    ranks: np.ndarray
    whole: bool

    @property
    def bits(self) -> int:
        return max(1, len(self.hashes).bit_length()) if self.whole else 64

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words; 0 parts runs; an unlisted word that may be frequent is its hash, above all numbers."""
        other = np.zeros(len(hashes), U) if self.whole else hashes | U(1 << 63)
        if not len(self.hashes):
            return other
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.ranks[at], other)

    def _places(self) -> list[tuple[int, int]]:
        """Column and shift of each place of a window: as many names in 64 bits as there is room for."""
        per = 64 // self.bits
        return [(j // per, self.bits * (per - 1 - j % per)) for j in range(LONGEST)]

    def keys(self, windows: list[np.ndarray]) -> list[np.ndarray]:
        """Columns whose order is that of the windows."""
        out = [np.zeros(len(windows[0]), U) for _ in range(self._places()[-1][0] + 1)]
        for (column, shift), names in zip(self._places(), windows, strict=True):
            out[column] |= names << U(shift)
        return out

    def windows(self, keys: list[np.ndarray]) -> list[np.ndarray]:
        mask = U(2**self.bits - 1)
        return [(keys[column] >> U(shift)) & mask for column, shift in self._places()]


def _runs(text: pa.Array, lang: pa.Array) -> tuple[words.Words, np.ndarray, np.ndarray]:
    """Words, their names (hashes of language and word) and whether each is followed by the next in its piece."""
    found = words.Words(text, PARTS, lower=True)
    data, places = words.utf8(lang)
    own = words.piece_hashes(data, places[:-1], places[1:])
    names = words.pair_hash(found.hash, own[found.text], 11)
    ends = np.zeros(len(found.bytes) + 1, np.int32)
    np.cumsum(PIECE_ENDS[found.bytes], out=ends[1:])
    next_to = np.zeros(len(names), bool)
    next_to[:-1] = (found.text[1:] == found.text[:-1]) & (ends[found.begin[1:]] == ends[found.end[:-1]])
    return found, names, next_to


def _windows(names: np.ndarray, next_to: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The names from each place of `at` on, 0 from the end of its run on."""
    padded = np.concatenate([names, np.zeros(LONGEST, U)])
    joined = np.concatenate([next_to, np.zeros(LONGEST, bool)])
    alive = padded[at] != 0
    out = [padded[at]]
    for j in range(1, LONGEST):
        alive = alive & joined[at + j - 1] & (padded[at + j] != 0)
        out.append(np.where(alive, padded[at + j], U(0)))
    return out


def _taken(found: words.Words, at: np.ndarray) -> pa.Array:
    """The words at `at` as binary values."""
    lengths = found.end[at] - found.begin[at]
    places = np.zeros(len(at) + 1, np.int64)
    np.cumsum(lengths, out=places[1:])
    index = np.arange(places[-1]) + np.repeat(found.begin[at] - places[:-1], lengths)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(places), pa.py_buffer(found.bytes[index])]).cast(pa.binary())


def _word_counts(docs: DataFrame) -> DataFrame:
    """`lang`, `word`, `name`, `n` of all words; and with a null `lang`, in `word`, windows from places taken evenly over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        draw = np.random.default_rng(TaskContext.get().partitionId())
        for batch in texts.steps(batches):
            found, names, next_to = _runs(batch["text"], batch["lang"])
            if not len(names):
                continue
            one, first, n = np.unique(names, return_index=True, return_counts=True)
            langs = batch["lang"].take(pa.array(found.text[first]))
            columns = [langs, _taken(found, first), pa.array(one.view(np.int64)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "name", "n"])
            at = np.flatnonzero(draw.random(len(names), np.float32) < 1 / SAMPLED)
            seen = np.stack(_windows(names, next_to, at), axis=1)
            columns = [pa.nulls(len(at), pa.string()), pa.array([row.tobytes() for row in seen], pa.binary()), pa.array(np.zeros(len(at), np.int64)), pa.array(np.zeros(len(at), np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "name", "n"])

    rows = docs.mapInArrow(count, "lang string, word binary, name long, n long")
    return written(rows.groupBy("lang", "word").agg(F.first("name").alias("name"), F.sum("n").alias("n")), "words")


def _sample(windows: DataFrame, parts: int) -> list[bytes]:
    """Windows to set the ranges by, SETTING at most; others are left out before any are brought together."""
    n = min(64 * parts, SETTING)
    place = F.xxhash64("word")
    thin = max(1, windows.count() // (2 * n))
    return windows.where(F.pmod(place, F.lit(thin)) == 0).orderBy(place).limit(n).select("word").toArrow()["word"].to_pylist()


def _ranges(sample: list[bytes], names: _Names, parts: int) -> list[np.ndarray]:
    """First windows of all ranges but the first."""
    if not sample:
        return names.keys([np.zeros(0, U)] * LONGEST)
    seen = np.frombuffer(b"".join(sample), U).reshape(-1, LONGEST)
    known = np.stack([np.where(seen[:, j] != 0, names.of(seen[:, j]), U(0)) for j in range(LONGEST)], axis=1)
    known *= np.logical_and.accumulate(known != 0, axis=1)
    keys = names.keys(list(known[known[:, 1] != 0].T.copy()))
    order = np.lexsort(keys[::-1])
    at = order[np.arange(1, parts) * len(order) // parts] if len(order) else order
    keys = [k[at] for k in keys]
    new = np.ones(len(at), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return [k[new] for k in keys]


def _place(keys: list[np.ndarray], bound: list[np.uint64]) -> int:
    """How many of the sorted windows come before `bound`."""
    low, high = 0, len(keys[0])
    for column, value in zip(keys, bound, strict=True):
        part = column[low:high]
        low, high = low + int(np.searchsorted(part, value, "left")), low + int(np.searchsorted(part, value, "right"))
    return low


def _summed(keys: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Windows in order, each once, with its count."""
    if not len(n):
        return keys, n
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    starts = np.flatnonzero(new)
    return [k[starts] for k in keys], np.add.reduceat(n[order], starts)


def _squeezed(columns: list[np.ndarray]) -> bytes:
    """Columns byte plane by byte plane: the upper bytes of sorted numbers hardly change."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T) for c in columns]
    return _CODEC.compress(np.concatenate(planes, axis=0).tobytes(), asbytes=True)


def _stretched(data: bytes, n: int, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(_CODEC.decompress(data, n * 8 * columns, asbytes=True), np.uint8).reshape(columns, 8, n)
    return [np.ascontiguousarray(p.T).view(U).ravel() for p in planes]


def _lists(rows: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The first `sizes` values of each row as lists of longs."""
    places = np.zeros(len(rows) + 1, np.int32)
    np.cumsum(sizes, out=places[1:])
    own = np.arange(rows.shape[1]) < sizes[:, None]
    return pa.ListArray.from_arrays(pa.array(places), pa.array(rows[own].view(np.int64)))


def _frequent(docs: DataFrame, names: _Names, bounds: list[np.ndarray], parts: int, least: int) -> DataFrame:
    """`ids` and `f` of all phrases of two words and more that occur `least` times."""
    sent = docs.sparkSession.sparkContext.broadcast((names, bounds))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, bounds = sent.value
        held: list[list[np.ndarray]] = []

        def dealt() -> pa.RecordBatch:
            keys = [np.concatenate(columns) for columns in zip(*held, strict=True)]
            held.clear()
            keys, n = _summed(keys, np.ones(len(keys[0]), U))
            ends = [0, *(_place(keys, [b[i] for b in bounds]) for i in range(len(bounds[0]))), len(n)]
            own = [(i, a, b) for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if a < b]
            data = [_squeezed([*(k[a:b] for k in keys), n[a:b]]) for _, a, b in own]
            columns = [pa.array([i for i, _, _ in own], pa.int32()), pa.array([b - a for _, a, b in own], pa.int64()), pa.array(data, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["range", "n", "windows"])

        for batch in texts.steps(batches):
            _, hashes, next_to = _runs(batch["text"], batch["lang"])
            numbers = names.of(hashes)
            at = np.flatnonzero((numbers != 0) & next_to)
            at = at[numbers[np.minimum(at + 1, len(numbers) - 1)] != 0]
            for start in range(0, len(at), CHUNK):
                held.append(names.keys(_windows(numbers, next_to, at[start : start + CHUNK])))
                if sum(len(h[0]) for h in held) >= CHUNK:
                    yield dealt()
        if held:
            yield dealt()

    def phrases(table: pa.Table) -> pa.Table:
        names, bounds = sent.value
        parts = [_stretched(data, n, len(bounds) + 1) for n, data in zip(table["n"].to_pylist(), table["windows"].to_pylist(), strict=True)]
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        keys, n = _summed(columns[:-1], columns[-1])
        window = np.stack(names.windows(keys), axis=1)
        new = np.zeros(len(n), bool)
        new[:1] = True
        out, counts = [], []
        for k in range(1, LONGEST + 1):
            new[1:] |= window[1:, k - 1] != window[:-1, k - 1]
            starts = np.flatnonzero(new)
            f = np.add.reduceat(n, starts).astype(np.int64)
            open_end = np.zeros(len(starts), bool)
            open_end[[0, -1]] = True
            keep = (window[starts, k - 1] != 0) & ((f >= least) | open_end)
            if k > 1:
                out.append(_lists(window[starts[keep]], np.full(int(keep.sum()), k)))
                counts.append(f[keep])
        return pa.table({"ids": pa.chunked_array(out), "f": pa.array(np.concatenate(counts))})

    windows = docs.mapInArrow(cut, "range int, n long, windows binary").repartition(parts, "range")
    found = windows.groupBy("range").applyInArrow(phrases, "ids array<long>, f long")
    found = written(found.groupBy("ids").agg(F.sum("f").alias("f")).where(F.col("f") >= least), "phrases")
    sent.destroy()
    return found


def _walked(counts: DataFrame, backwards: bool) -> DataFrame:
    """`ids`, `f`, `starts` and `covered` of each phrase of two words and more, from one walk through the stream.

    `starts`: counts of its first 1, 2, ... words (backwards: of its last
    ones); `covered`: one more word at the other end leaves its count as it is.
    A phrase can have a second row, with `covered` alone.
    """
    parts = blobs.partitions(counts)
    key = F.reverse("ids") if backwards else F.col("ids")
    stream = counts.select(key.alias("key"), "f").repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id())
    stream = written(stream, "suffix_stream" if backwards else "prefix_stream")
    opens = stream.groupBy("part").agg(F.min("key").alias("first")).where(F.size("first") > 1)
    asked = opens.select("part", F.explode(F.transform(F.sequence(F.lit(1), F.size("first") - 1), lambda k: F.slice("first", F.lit(1), k))).alias("key"))
    carried = stream.drop("part").join(F.broadcast(asked), "key").select("key", "f", "part", F.lit(False).alias("own"))

    def walk(table: pa.Table) -> pa.Table:
        lists, f, own = table["key"].combine_chunks(), table["f"].to_numpy(), table["own"].to_numpy()
        sizes = np.diff(lists.offsets.to_numpy())
        key = np.full((len(f), LONGEST), np.iinfo(np.int64).min)
        key[np.arange(LONGEST) < sizes[:, None]] = lists.flatten().to_numpy()
        order = np.lexsort([sizes, *key.T[::-1]])
        key, sizes, f, own = key[order], sizes[order], f[order], own[order]
        row = np.arange(len(f))
        starts, covered = np.zeros((len(f), LONGEST), np.int64), np.zeros(len(f), bool)
        for k in range(1, LONGEST):
            shorter = np.maximum.accumulate(np.where(sizes == k, row, -1))
            longer = np.flatnonzero(sizes > k)
            starts[longer, k - 1] = f[shorter[longer]]
            longer = np.flatnonzero(sizes == k + 1)
            covered[shorter[longer[f[longer] >= f[shorter[longer]]]]] = True
        keep = np.flatnonzero((sizes > 1) & (own | covered))
        key, sizes = key[keep], sizes[keep]
        if backwards:
            place = np.maximum(sizes[:, None] - 1 - np.arange(LONGEST), 0)
            key = np.take_along_axis(key, place, axis=1)
        starts = _lists(starts[keep], np.where(own[keep], sizes - 1, 0))
        return pa.table({"ids": _lists(key, sizes), "f": pa.array(f[keep]), "starts": starts, "covered": pa.array(covered[keep])})

    rows = stream.select("key", "f", "part", F.lit(True).alias("own")).unionByName(carried).repartition(parts, "part")
    return rows.groupBy("part").applyInArrow(walk, "ids array<long>, f long, starts array<long>, covered boolean")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, first: int = FIRST, listed: int = LISTED) -> DataFrame:
    """`lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score` of each language's `first` collocations.

    A phrase is two to five words of one piece that occur `least` times in all;
    `a` counts it, `l` and `r` the parts before and after its weakest cut, `n`
    all words, and the score is 1000 a n / (l r), floored. Phrases that one
    more word leaves as frequent are dropped. Texts are whole and lower-cased
    in A-Z; null ones are empty, null languages count as `und`, repeated rows
    count again; a table without words gives no row. Other columns are not
    read, whatever their names.
    """
    docs = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text}`").alias("text"))
    spark = docs.sparkSession
    counted = _word_counts(docs)
    totals = counted.where("lang is not null").groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = counted.where((F.col("lang").isNotNull()) & (F.col("n") >= least))
    most = frequent.orderBy(F.desc("n"), "name").limit(listed).select("name").toArrow()["name"].to_numpy().view(U)
    order = np.argsort(most)
    names = _Names(most[order], (order + 1).astype(U), frequent.count() <= listed)
    total = totals.agg(F.sum("n")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE))
    phrases = _frequent(docs, names, _ranges(_sample(counted.where("lang is null"), parts), names, parts), parts, least)
    sent = spark.sparkContext.broadcast(names)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = sent.value.of(batch["name"].to_numpy().view(U)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), batch["lang"], batch["word"], batch["n"]], names=["id", "lang", "word", "f"])

    vocabulary = written(frequent.select("lang", "word", "name", "n").mapInArrow(numbered, "id long, lang string, word binary, f long"), "vocabulary")
    sent.destroy()
    counts = phrases.unionByName(vocabulary.select(F.array("id").alias("ids"), "f"))
    begins = _walked(counts, False).select("ids", "f", "covered", F.when(F.size("starts") > 0, F.col("starts")).alias("begins"), F.lit(None).cast("array<long>").alias("ends"))
    ends = _walked(counts, True).select("ids", "f", "covered", F.lit(None).cast("array<long>").alias("begins"), F.when(F.size("starts") > 0, F.col("starts")).alias("ends"))
    known = begins.unionByName(ends).groupBy("ids").agg(F.max("f").alias("a"), F.max("begins").alias("begins"), F.max("ends").alias("ends"), F.max("covered").alias("covered"))
    kept = known.where(~F.col("covered")).select("ids", "a", F.arrays_zip(F.col("begins").alias("l"), F.reverse("ends").alias("r")).alias("cuts"))
    worded = kept.select("*", F.posexplode("ids").alias("at", "id")).join(vocabulary.select("id", "lang", "word"), "id")
    spelt = worded.groupBy("ids").agg(
        F.first("a").alias("a"), F.first("cuts").alias("cuts"), F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", F.col("word").cast("string").alias("word")))).alias("words")
    )
    spelt = spelt.join(totals, "lang").withColumn("phrase", F.array_join("words.word", " "))
    # products of three counts have up to 38 digits
    scored = spelt.withColumn(
        "best",
        F.expr(
            """array_min(transform(cuts, (c, i) -> struct(
                (cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0)))
                    div (cast(c.l as decimal(16,0)) * cast(c.r as decimal(16,0))) as score,
                i as k, c.l as l, c.r as r)))"""
        ),
    ).select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    ranking = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANKED)))
    scored = scored.withColumn("rank", F.row_number().over(part.orderBy(*ranking))).where(F.col("rank") <= first)
    scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*ranking)).cast("long")).where(F.col("rank") <= first)
    return scored.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
