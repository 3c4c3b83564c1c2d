"""Records of lines whose quoted values may hold line breaks, over Arrow batches of lines in file order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Batches = Iterator[pa.RecordBatch]


class _Block:
    """What is known of one block while its lines go by."""

    def __init__(self, row: dict) -> None:
        self.file, self.block = row["file"], row["block"]
        self.inside = row["inside"] or 0
        self.offset, self.opens = row.get("offset"), row.get("opens")
        self.records = self.blank = 0
        self.open: list[str] = []  # lines of the record that isn't closed yet
        self.open_number: int | None = None
        self.whole: list[tuple[int, str]] = []
        self.pieces: list[tuple[int, str]] = []

    def take(self, lines: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last lines of the records that begin and end among these, and the numbers of all lines within the block."""
        odd = (pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) & 1).astype(np.int64)
        after = (self.inside + np.cumsum(odd)) & 1
        before = after ^ odd
        begins = before == 0
        number = self.records + np.cumsum(begins) - 1
        single = begins & (after == 0)
        blank = pc.is_in(lines, pa.array(["", "\r"], lines.type)).to_numpy(zero_copy_only=False)
        self.blank += int(np.count_nonzero(single & blank))
        first, last = np.flatnonzero(begins), np.flatnonzero(after == 0)
        if not len(after):
            return first, last, number
        if not begins[0]:  # of a record that is open already
            self.open += lines[: last[0] + 1 if len(last) else len(after)].to_pylist()
            if len(last):
                self._close()
            last = last[1:]
        if len(first) > len(last):  # the last one stays open
            self.open_number = int(number[first[-1]])
            self.open += lines[first[-1] :].to_pylist()
            first = first[:-1]
        self.inside = int(after[-1])
        self.records += int(np.count_nonzero(begins))
        return first, last, number

    def _close(self) -> None:
        text = "\n".join(self.open).removesuffix("\r")
        if self.open_number is None:  # began in an earlier block
            self.pieces.append((-1, text))
        else:
            self.whole.append((self.open_number, text))
        self.open, self.open_number = [], None

    def end(self) -> None:
        """What is open now goes on in a later block."""
        if self.open:
            self.pieces.append((-1 if self.open_number is None else self.open_number, "\n".join(self.open)))
            self.open = []


def _joined(lines: pa.Array, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """Texts of the records that go from a first to a last line."""
    if (first == last).all():
        texts = lines.take(pa.array(first))
    else:
        ends = np.cumsum(last - first + 1)
        starts = ends - (last - first + 1)
        at = np.repeat(first - starts, ends - starts) + np.arange(ends[-1])
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        texts = pc.binary_join(pa.ListArray.from_arrays(offsets, lines.take(pa.array(at))), "\n")
    return pc.replace_substring_regex(texts, "\r$", "")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[dict, pa.Array]]:
    """Lines of one block after another."""
    files = batch["file"].dictionary_encode().indices.to_numpy(zero_copy_only=False)
    blocks = batch["block"].to_numpy(zero_copy_only=False)
    turns = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
    names = [n for n in batch.schema.names if n != "value"]
    for a, b in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows], strict=True):
        if a < b:
            yield {n: batch[n][a].as_py() for n in names}, batch["value"].slice(a, b - a)


def records_of_blocks(what: str) -> Callable[[Batches], Batches]:
    """A map over lines with `file`, `block`, `inside` (and `opens`, `offset`).

    `counts`: the records that begin in each block, and blank ones; `whole`:
    records that begin and end in a block; `pieces`: the parts of those that
    reach over its ends. A piece at the beginning of a block has the number of
    the last record before it.
    """

    def rows(block: _Block, numbers: np.ndarray, texts: pa.Array) -> pa.RecordBatch:
        header = numbers == 0 if block.opens else np.zeros(len(numbers), bool)
        n = len(numbers)
        columns = [pa.array([block.file] * n, pa.string()), pa.array(np.full(n, block.block)), pa.array(header)]
        known = block.offset is not None
        number = pa.array(numbers + block.offset) if known else pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays(
            [*columns, number, texts.cast(pa.string())], names=["file", "block", "header", "number", "record"]
        )

    def finished(block: _Block | None) -> Iterator[pa.RecordBatch]:
        if block is None:
            return
        block.end()
        if what == "counts":
            values = [[block.file], [block.block], [block.records], [block.blank]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in values], names=["file", "block", "records", "blank"]
            )
        elif found := getattr(block, what):
            yield rows(block, np.array([i for i, _ in found]), pa.array([t for _, t in found], pa.string()))

    def scan(batches: Batches) -> Batches:
        block: _Block | None = None
        for batch in batches:
            for row, lines in _runs(batch):
                if block is None or (block.file, block.block) != (row["file"], row["block"]):
                    yield from finished(block)
                    block = _Block(row)
                first, last, number = block.take(lines)
                if what == "whole" and len(first):
                    yield rows(block, number[first], _joined(lines, first, last))
        yield from finished(block)

    return scan
