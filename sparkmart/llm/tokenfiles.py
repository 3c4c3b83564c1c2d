"""Token files: Arrow files of equal-length sequences with masks (operator 4).

A file holds record batches of two columns: `ids`, fixed-size lists of token
ids, and `mask`, fixed-size lists that tell ids from padding. Batches are not
compressed, and the footer names their places, so any sequence of a mapped file
is a slice of it. Documents follow each other without gaps in the order of
their keys; a manifest, a Parquet table, says where each begins.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from functools import cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.session import scratch_folder

from . import blobs
from .components import written
from .pretokens import Pretokens
from .texts import steps

#: Ids in a sequence, sequences in a record batch, pieces that a worker remembers, and pieces that the library takes at once.
LENGTH, SEQUENCES, REMEMBERED, PIECES = 2048, 64, 1 << 20, 1 << 13
#: Text bytes that are encoded, and bytes of ids that are read, at once (a longer text is taken whole): a byte takes some sixty bytes of arrays.
STEP_BYTES = 1 << 20
PADDING = 0


class _Remembered:
    """Ids of the pieces that a worker has seen, in flat arrays of some sixty bytes a piece: found by hash, then compared byte by byte."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.hash, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # in order of the hashes
        self.bytes, self.byte_first = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.id_first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.row)

    def find(self, hashes: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The row of each piece of `data`, -1 for those that aren't known."""
        out = np.full(len(hashes), -1)
        if not len(self):
            return out
        place = np.minimum(np.searchsorted(self.hash, hashes), len(self) - 1)
        row = self.row[place]
        size = self.byte_first[row + 1] - self.byte_first[row]
        same = np.flatnonzero((self.hash[place] == hashes) & (size == end - begin))
        row, size = row[same], size[same]
        differ = data[_spans(begin[same], size)] != self.bytes[_spans(self.byte_first[row], size)]
        out[same] = row
        out[same[np.repeat(np.arange(len(same)), size)[differ]]] = -1
        return out

    def add(self, hashes: np.ndarray, pieces: list[bytes], ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Rows for new pieces with ascending hashes."""
        rows = np.arange(len(self), len(self) + len(pieces))
        place = np.searchsorted(self.hash, hashes)
        self.hash, self.row = np.insert(self.hash, place, hashes), np.insert(self.row, place, rows)
        self.byte_first = np.append(self.byte_first, self.byte_first[-1] + np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))))
        self.id_first = np.append(self.id_first, self.id_first[-1] + np.cumsum(counts))
        self.bytes = np.append(self.bytes, np.frombuffer(b"".join(pieces), np.uint8))
        self.ids = np.append(self.ids, ids)
        return rows


def _spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin..begin + size of all spans, one after another."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


@cache
def _library(file: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(file)
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values() if token.content]
    return tokenizer, _Remembered(), "|".join(map(re.escape, added))


def _library_ids(tokenizer, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The library's ids of all pieces, one after another, and their numbers."""
    ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for at in range(0, len(pieces), PIECES):
        found = [got.ids for got in tokenizer.encode_batch_fast([p.decode() for p in pieces[at : at + PIECES]], add_special_tokens=False)]
        counts.append(np.fromiter(map(len, found), np.int64, len(found)))
        ids.append(np.fromiter(chain.from_iterable(found), np.uint32, counts[-1].sum()))
    return np.concatenate(ids), np.concatenate(counts)


def encoded(file: str, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each followed by `end`, and where each text's begin (one place more than texts).

    The library encodes every pre-token that it hasn't seen yet by itself,
    which is what it does inside whole texts; others are looked up. A text in
    which the name of an added token stands goes to the library as a whole.
    """
    tokenizer, remembered, added = _library(file)
    named = pc.match_substring_regex(texts, added) if added else pa.array(np.zeros(len(texts), bool))
    marked = np.flatnonzero(named.to_numpy(zero_copy_only=False))
    found = Pretokens(pc.if_else(named, "", texts) if len(marked) else texts)
    hashes, one, which = np.unique(found.hash, return_index=True, return_inverse=True)
    begin, end_of = found.begin[one], found.end[one]
    row = remembered.find(hashes, found.bytes, begin, end_of)
    if len(remembered) + np.count_nonzero(row < 0) > REMEMBERED:
        remembered.clear()
        row[:] = -1
    new = np.flatnonzero(row < 0)
    pieces = [found.bytes[a:b].tobytes() for a, b in zip(begin[new].tolist(), end_of[new].tolist(), strict=True)]
    row[new] = remembered.add(hashes[new], pieces, *_library_ids(tokenizer, pieces))
    start = remembered.id_first[row]
    size = remembered.id_first[row + 1] - start
    counts = size[which]
    # places of pieces and of the end ids in the output
    text = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
    begin = np.cumsum(counts) - counts + text
    out = np.empty(int(counts.sum()) + len(found.first) - 1, np.uint32)
    out[_spans(begin, counts)] = remembered.ids[_spans(start[which], counts)]
    before = np.concatenate([[0], np.cumsum(counts)])[found.first]
    bounds = before + np.arange(len(found.first))
    out[bounds[1:] - 1] = end
    if len(marked):
        whole, at, more = [], 0, np.zeros(len(bounds), np.int64)
        for i in marked.tolist():
            ids = np.array(tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
            whole += [out[at : bounds[i]], ids]
            at, more[i + 1] = bounds[i], len(ids)
        out, bounds = np.concatenate([*whole, out[at:]]), bounds + np.cumsum(more)
    return out, bounds


class _Writer:
    """One file, written as ids come in."""

    def __init__(self, stream, kind: type, length: int):
        self.kind, self.length = kind, length
        ids = pa.uint16() if kind is np.uint16 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.stream = stream
        self.file = pa.ipc.new_file(stream, self.schema)
        self.held = np.zeros(0, kind)

    def add(self, ids: np.ndarray) -> None:
        self.held = np.concatenate([self.held, ids.astype(self.kind)])
        size = self.length * SEQUENCES
        whole = len(self.held) // size * size
        for at in range(0, whole, size):
            self._batch(self.held[at : at + size], size)
        self.held = self.held[whole:]

    def _batch(self, ids: np.ndarray, n: int) -> None:
        mask = np.arange(len(ids)) < n
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.file.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        if n := len(self.held):
            padded = np.full(-(-n // self.length) * self.length, PADDING, self.kind)
            padded[:n] = self.held
            self._batch(padded, n)
        self.file.close()
        self.stream.close()


def write(docs: DataFrame, tokenizer: str, end: int, folder: str, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Token files of all texts in `folder`, and their manifest: key, `file`, `part`, `at` (in the file), `n_tokens`, `start` (over all files).

    `tokenizer` is the content of a tokenizers file. Documents are in ascending
    order of their keys (nulls first, equal keys by two hashes of the text, so that no text is
    needed to set ranges); a null text has only the end id. A task that is run again writes another file; only files that
    the manifest names count.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(whole).alias("one"), F.xxhash64(F.lit("second"), whole).alias("two"), whole.alias("text"))
    ordered = rows.repartitionByRange(blobs.partitions(docs), "key", "one", "two").sortWithinPartitions("key", "one", "two", "text").select("key", "text")
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer)
    kind = np.uint16 if _largest_id(tokenizer, end) < 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # a task has one core; threads of the library's own would each hold buffers
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.arrow"
        system, path = pyarrow.fs.FileSystem.from_uri(name)
        writer, at = None, 0
        for batch in steps(batches, STEP_BYTES):
            if writer is None:
                system.create_dir(path.rpartition("/")[0], recursive=True)
                writer = _Writer(system.open_output_stream(path), kind, length)
            ids, bounds = encoded(sent.value, batch["text"], end)
            writer.add(ids)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array([name] * n), pa.array(np.full(n, part)), pa.array(bounds[:-1] + at), pa.array(np.diff(bounds))], names=["key", "file", "part", "at", "n_tokens"])
            at += len(ids)
        if writer is not None:
            writer.close()  # before the task ends, so before any of its rows counts

    key_type = docs.schema[key].dataType.simpleString()
    manifest = written(ordered.mapInArrow(run, f"key {key_type}, file string, part long, at long, n_tokens long"), "manifest")
    sums = manifest.groupBy("file", "part").agg(F.sum("n_tokens").alias("n"))  # a row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return manifest.join(offsets, "file").select(F.col("key").alias(key), "file", "part", "at", "n_tokens", (F.col("at") + F.col("before")).alias("start"))


def _largest_id(tokenizer: str, end: int) -> int:
    library, _, _ = _library(tokenizer)
    return max(end, max(library.get_vocab(with_added_tokens=True).values(), default=0))


def open_file(name: str) -> pa.ipc.RecordBatchFileReader:
    """A token file, mapped if it is on a local disk."""
    system, path = pyarrow.fs.FileSystem.from_uri(name)
    source = pa.memory_map(path) if isinstance(system, pyarrow.fs.LocalFileSystem) else system.open_input_file(path)
    return pa.ipc.open_file(source)


def sequence(reader: pa.ipc.RecordBatchFileReader, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of one sequence; the ids are a view of the file."""
    size = SEQUENCES
    batch = reader.get_batch(i // size)
    return batch["ids"][i % size].values.to_numpy(), batch["mask"][i % size].values.to_numpy(zero_copy_only=False)


def _ids(reader: pa.ipc.RecordBatchFileReader, begin: int, end: int, length: int) -> Iterator[np.ndarray]:
    """The ids of places begin..end of a file, in views of its batches."""
    size = length * SEQUENCES
    for i in range(begin // size, -(-end // size)):
        yield reader.get_batch(i)["ids"].flatten().to_numpy()[max(begin - i * size, 0) : end - i * size]


def read(manifest: DataFrame, key: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """Key, `start`, `n_tokens` and `ids` (little-endian, four bytes each) of every document, from the files."""
    key_type = manifest.schema[key].dataType.simpleString()
    rows = manifest.select("file", F.col(key).alias("key"), "at", "n_tokens", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            if reader is None:
                reader = open_file(batch["file"][0].as_py())
            # documents of about a step's bytes of ids at a time, or one
            place = (np.cumsum(batch["n_tokens"].to_numpy()) * 4 - 1) // STEP_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), batch.num_rows]
            for some in (batch.slice(a, b - a) for a, b in pairwise(cuts)):
                ids = []
                for at, n in zip(some["at"].to_pylist(), some["n_tokens"].to_pylist(), strict=True):
                    ids.append(b"".join(x.astype("<u4").tobytes() for x in _ids(reader, at, at + n, length)))
                yield pa.RecordBatch.from_arrays([some["key"], some["start"], some["n_tokens"], pa.array(ids, pa.binary())], names=["key", "start", "n_tokens", "ids"])

    return rows.groupBy("file").applyInArrow(run, f"key {key_type}, start long, n_tokens long, ids binary").withColumnRenamed("key", key)


def folder(spark: SparkSession) -> str:
    return scratch_folder(spark, "tokens")
