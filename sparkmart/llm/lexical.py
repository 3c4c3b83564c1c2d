"""Ranked lexical search (operator 13): MaxScore with bounds of term pairs.

Texts are read once for a block of queries; what holds a query's term becomes
segments of postings, written as a table. Counts over all segments give each
term its weight. A segment then has, for each term, the largest impact and, for
pairs of terms that stand next to each other in a query's order by weight, the
list of documents with both, with their joint impacts and the largest of these.

A query takes disjoint pairs, those first whose joint maximum lies furthest
below the sum of the two single ones; no document gets more from a pair than
its joint maximum or the larger of the single ones. Pairs and single terms are
set aside, lowest bounds first, while their bounds stay below the score to
beat, which joint lists give from the start. Documents that hold set-aside
terms alone are never looked at; the others are completed term by term and
leave as soon as what is left can't lift them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import texts, words
from .components import written

U = np.uint64
FIRST = 10
#: Query terms planned for one block of queries; documents and postings of one segment.
BLOCK_TERMS, SEGMENT_DOCS, SEGMENT_POSTINGS = 1 << 20, 8192, 1 << 21


def _terms(column: pa.Array) -> words.Words:
    return words.Words(column, words.NOT_ALNUM, lower=True)


def _numbered(queries: DataFrame, key: str, text: str) -> DataFrame:
    """`number`, `item` and the hashes of the distinct `terms` of each query; equal rows have numbers of their own."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.steps(batches):
            found = _terms(batch["text"])
            own = [np.unique(found.hash[a:b]).view(np.int64) for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch["number"], batch["item"], pa.array(own, pa.list_(pa.int64()))], names=["number", "item", "terms"])

    rows = queries.select(F.monotonically_increasing_id().alias("number"), F.col(f"`{key}`").alias("item"), F.col(f"`{text}`").alias("text"))
    kind = T.StructType([T.StructField("number", T.LongType()), T.StructField("item", rows.schema["item"].dataType), T.StructField("terms", T.ArrayType(T.LongType()))])
    return written(rows.mapInArrow(distinct, kind), "queries")


def _postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Segments: `keys` and lengths `n` of documents, postings (`term`, `doc`, `tf`) in order, and counts of all documents read."""
    kind = T.StructType(
        [T.StructField("keys", T.ArrayType(docs.schema["key"].dataType)), *(T.StructField(name, T.BinaryType()) for name in ("n", "term", "doc", "tf")), T.StructField("docs", T.LongType()), T.StructField("words", T.LongType())]
    )
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        held, docs, postings = [], 0, 0

        def cut() -> pa.RecordBatch:
            nonlocal held, docs, postings
            keys = pa.chunked_array([h["keys"] for h in held]).combine_chunks()
            shift = np.cumsum([0, *(len(h["keys"]) for h in held)])
            term, tf = (np.concatenate([h[name] for h in held]) for name in ("term", "tf"))
            doc = np.concatenate([h["doc"] + s for h, s in zip(held, shift[:-1], strict=True)])
            order = np.lexsort([doc, term])
            blobs = [np.concatenate([h["n"] for h in held]), *(x[order].astype(np.uint32) for x in (term, doc, tf))]
            whole = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
            columns = [whole, *(pa.array([b.tobytes()], pa.binary()) for b in blobs), pa.array([sum(h["docs"] for h in held)]), pa.array([sum(h["words"] for h in held)])]
            held, docs, postings = [], 0, 0
            return pa.RecordBatch.from_arrays(columns, names=kind.names)

        for batch in texts.steps(batches):
            found = _terms(batch["text"])
            n = np.diff(found.first)
            at = np.minimum(np.searchsorted(vocabulary, found.hash), len(vocabulary) - 1)
            hit = np.flatnonzero(vocabulary[at] == found.hash)
            pairs, tf = np.unique(found.text[hit].astype(U) << U(32) | at[hit].astype(U), return_counts=True)
            owners, doc = np.unique((pairs >> U(32)).astype(np.int64), return_inverse=True)
            own = {"keys": batch["key"].take(pa.array(owners)), "n": n[owners].astype(np.int64), "term": (pairs & U(2**32 - 1)).astype(np.int64), "doc": doc, "tf": tf}
            held.append(own | {"docs": int(np.count_nonzero(n)), "words": int(n.sum())})
            docs, postings = docs + len(owners), postings + len(tf)
            if docs >= SEGMENT_DOCS or postings >= SEGMENT_POSTINGS:
                yield cut()
        if held:
            yield cut()

    out = written(docs.select("key", "text").mapInArrow(scan, kind), "postings")
    sent.destroy()
    return out


def _document_counts(segments: DataFrame) -> DataFrame:
    """`term` and `df` over all segments."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch["term"].to_pylist():
                term, df = np.unique(np.frombuffer(data, np.uint32), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int64)), pa.array(df)], names=["term", "df"])

    return segments.select("term").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class _Segment:
    """Impacts of one segment, their maxima, and the joint ones of term pairs."""

    def __init__(self, row: dict, weights: np.ndarray, n_docs: int, n_words: int, pairs: np.ndarray):
        n = np.frombuffer(row["n"], np.int64)
        term, self.doc, tf = (np.frombuffer(row[name], np.uint32).astype(np.int64) for name in ("term", "doc", "tf"))
        m = 10 + 90 * n * n_docs // n_words
        self.impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[self.doc]))
        self.size = len(n)
        self.ends = np.searchsorted(term, np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        here = np.flatnonzero(np.diff(self.ends))
        if len(here):
            self.most[here] = np.maximum.reduceat(self.impact, self.ends[here])
        self._join(pairs)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.ends[term], self.ends[term + 1]
        return self.doc[a:b], self.impact[a:b]

    def _join(self, pairs: np.ndarray) -> None:
        """Of each pair the documents with both terms and their joint impacts; `joint`: the largest, 0 if there is none."""
        self.joint, self.both = np.zeros(len(pairs), np.int64), [None] * len(pairs)
        row = np.zeros(self.size, np.int64)
        lengths, last = np.diff(self.ends), -1
        for i, (a, b) in enumerate(pairs.tolist()):
            if not (lengths[a] and lengths[b]):
                continue
            if a != last:  # pairs come in order of their first terms
                if last >= 0:
                    row[self.postings(last)[0]] = 0
                docs, impacts = self.postings(a)
                row[docs], last = impacts, a
            docs, impacts = self.postings(b)
            shared = np.flatnonzero(row[docs])
            if len(shared):
                self.both[i] = docs[shared], impacts[shared] + row[docs[shared]]
                self.joint[i] = self.both[i][1].max()

    def _to_beat(self, pairs: np.ndarray, least: int, first: int) -> int:
        """A score that `first` documents reach by one pair alone, if it is more than `least`."""
        for i in pairs[self.joint[pairs] > least].tolist():
            sums = self.both[i][1]
            if len(sums) >= first:
                least = max(least, int(np.partition(sums, len(sums) - first)[-first]))
        return least

    def search(self, terms: np.ndarray, pairs: np.ndarray, pair_terms: np.ndarray, least: int, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that can be among the `first` of the query, with whole scores; `least`: the score of its last one so far."""
        terms = terms[self.most[terms] > 0]
        least = max(self._to_beat(pairs, least, first), 1)
        # combine bounds: disjoint pairs, the largest savings first
        bound = np.maximum(np.maximum(self.most[pair_terms[:, 0]], self.most[pair_terms[:, 1]]), self.joint[pairs])
        saved = self.most[pair_terms].sum(axis=1) - bound
        units, taken = [], set()
        for i in np.argsort(-saved, kind="stable").tolist():
            a, b = pair_terms[i].tolist()
            if saved[i] > 0 and a not in taken and b not in taken:
                taken |= {a, b}
                units.append((int(bound[i]), (a, b)))
        units += [(int(self.most[t]), (t,)) for t in terms.tolist() if t not in taken]
        units.sort()
        aside, rest = 0, 0
        while aside < len(units) and rest + units[aside][0] < least:
            rest += units[aside][0]
            aside += 1
        score = np.zeros(self.size, np.int64)
        for _, own in units[aside:]:
            for t in own:
                docs, impacts = self.postings(t)
                score[docs] += impacts
        left = np.flatnonzero((score > 0) & (score + rest >= least))
        for most, own in reversed(units[:aside]):
            if not len(left):
                break
            for t in own:
                docs, impacts = self.postings(t)
                at = np.minimum(np.searchsorted(docs, left), len(docs) - 1)
                score[left] += np.where(docs[at] == left, impacts[at], 0)
            rest -= most
            left = left[score[left] + rest >= least]
        return left, score[left]


def _searched(segments: DataFrame, numbers: np.ndarray, starts: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_docs: int, n_words: int, first: int) -> DataFrame:
    """`number`, `key`, `score`: the first documents of each query, from each task."""
    kind = T.StructType([T.StructField("number", T.LongType()), T.StructField("key", segments.schema["keys"].dataType.elementType), T.StructField("score", T.LongType())])
    own, all_pairs = [], []
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        t = terms[a:b]
        t = t[weights[t] > 0]
        t = t[np.lexsort([t, -weights[t]])]
        own.append(t)
        all_pairs.append(np.sort(np.stack([t[:-1], t[1:]], axis=1), axis=1))
    sizes = [len(p) for p in all_pairs]
    pairs, places = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *all_pairs]), axis=0, return_inverse=True)
    places = np.split(places.ravel(), np.cumsum(sizes)[:-1])
    sent = segments.sparkSession.sparkContext.broadcast((numbers, own, pairs, places, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, own, pairs, places, weights = sent.value
        best: list[list[tuple]] = [[] for _ in own]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in ("n", "term", "doc", "tf")}
                keys = batch["keys"][i].values
                segment = _Segment(row, weights, n_docs, n_words, pairs)
                place = np.zeros(len(keys), np.int64)
                place[pc.sort_indices(keys).to_numpy()] = np.arange(len(keys))  # null last
                for q, (terms, mine) in enumerate(zip(own, places, strict=True)):
                    if not len(terms):
                        continue
                    least = best[q][-1][0] if len(best[q]) == first else 0
                    docs, scores = segment.search(terms, mine, pairs[mine], least, first)
                    top = np.lexsort([place[docs], -scores])[:first]
                    if len(top):
                        found = zip(scores[top].tolist(), keys.take(pa.array(docs[top])).to_pylist(), strict=True)
                        best[q] = sorted([*best[q], *found], key=lambda x: (-x[0], x[1] is None, x[1]))[:first]
        rows = [(int(numbers[q]), key, score) for q, found in enumerate(best) for score, key in found]
        if rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    out = to_arrow_schema(kind)
    found = written(segments.select("keys", "n", "term", "doc", "tf").mapInArrow(search, kind), "found")
    sent.destroy()
    return found


def ranked(docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", query_key: str = "item_id", query_text: str = "text", first: int = FIRST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """`query_key`, `rank`, `key` and `score` of the `first` documents of each query with a score above 0.

    Terms are maximal runs of digits, letters a-z after lower-casing A-Z, and
    characters beyond ASCII, in whole texts; null has none. Equal scores rank
    by ascending key, a null key last. Rows count as they stand: a repeated
    document can be found twice, a repeated query has its rows twice; a table
    without rows gives none. Other columns are not read, whatever their names.
    Queries go in blocks of about `block_terms` terms, over all documents each.
    """
    docs = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    items = _numbered(queries, query_key, query_text)
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // block_terms)
    found = []
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).select("number", "terms").toArrow()
        lists = own["terms"].combine_chunks()
        lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
        vocabulary, terms = np.unique(lists.flatten().to_numpy().view(U), return_inverse=True)
        if not len(vocabulary):
            continue
        segments = _postings(docs, vocabulary)
        n_docs, n_words = segments.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
        if not n_words:
            continue
        weights = np.zeros(len(vocabulary), np.int64)
        counts = _document_counts(segments).toArrow()
        weights[counts["term"].to_numpy()] = [weight(n_docs, df) for df in counts["df"].to_pylist()]
        starts = np.append(0, np.cumsum(np.diff(lists.offsets.to_numpy())))
        found.append(_searched(segments, own["number"].to_numpy(), starts, terms.ravel(), weights, n_docs, n_words, first))
    if not found:
        return items.select(F.col("item").alias(query_key), F.lit(0).alias("rank"), F.lit(None).cast(docs.schema["key"].dataType).alias(key), F.lit(0).cast("long").alias("score")).where("false")
    ranking = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    rows = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= first)
    rows = rows.join(items.select("number", "item"), "number")
    return rows.select(F.col("item").alias(query_key), "rank", F.col("key").alias(key), "score")
