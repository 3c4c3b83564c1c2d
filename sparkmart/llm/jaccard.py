"""N-gram Jaccard join (operator 9): a blocked sparse product of document by n-gram incidence.

Two sets with `100 * |x & y| >= 75 * |x | y|` share an n-gram among the first
`n - ceil(0.75 n) + 1` of each, in any order common to all documents. The order
taken puts rare n-grams first, as counted over all documents in a table of
bounded size, and hashes decide among equals; it only steers the amount of work.

1. These n-grams of every distinct text, the sparse columns of the incidence
   matrix, are dealt into blocks by hash. Each block says which cells of the
   product are asked for: documents that share a column and whose sizes allow a
   link. In a column of more than `SMALL` documents only those of one row, its
   leader's, are.
2. Rows travel to the document blocks of their partners. There the asked cells
   are summed over blocks of n-grams, and a cell is dropped as soon as its count
   and the n-grams left in both sets can't reach what their sizes demand.
3. Columns of more than `SMALL` documents that this leaves in several parts make
   clusters. Tiles of documents outside a cluster's largest part by documents of
   like size are multiplied whole, and say only which of their documents are
   joined: as many rows as documents, not as pairs. What isn't multiplied is
   joined already or ruled out by size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blobs
from .components import components, local_labels, written
from .substrings import attach
from .texts import KEYS, distinct_texts, gathered, steps, text_keys
from .words import U, Words, mix, rolling

SHINGLE = 5
PERCENT = 75
SMALL = 16
#: Documents and n-grams of the blocks that large groups are multiplied in.
BLOCK, COLUMNS = 1024, 4096
#: A column with more than this part of all pairs of two blocks is multiplied as a dense one; pairs counted at once for the others.
DENSE, PAIRS = 128, 1 << 22
#: Parts of the range of hashes that the columns of asked cells are summed in; n-grams looked up at once.
SLICES, LOOKUPS = 4, 1 << 20
#: Counters of the rarity table, at least and at most, and bytes of input for each; the table is sent to all tasks with one byte each.
RARITY_BITS = (22, 26)
BYTES_A_COUNTER = 64

FIRSTS = {"gram": np.uint64, "ordinal": np.uint32, "size": np.uint32}
KIND_LINK, KIND_NODE, KIND_ENTRY, KIND_TEXT = 0, 1, 2, 3


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, and where each text's begin (one place more than texts)."""
    words = Words(texts, lower=True)
    n, counts = len(words.hash), np.diff(words.first)
    owner, grams = np.zeros(0, np.int64), np.zeros(0, U)
    if n >= width:
        inside = words.text[width - 1 :] == words.text[: n - width + 1]
        grams, owner = rolling(words.hash, width, 3)[inside], words.text[: n - width + 1][inside]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        whole = [mix(np.array([int(c) + 1], U) + np.bitwise_xor.reduce(mix(words.hash[a : a + c] + np.arange(1, c + 1, dtype=U) * U(0x9E3779B97F4A7C15))))[0] for a, c in zip(words.first[short], counts[short], strict=True)]
        grams, owner = np.concatenate([grams, np.array(whole, U)]), np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return grams, np.searchsorted(owner, np.arange(len(counts) + 1))


def _rarity(docs: DataFrame, text: str, width: int, bits: int) -> np.ndarray:
    """For each value of the low `bits` of a shingle's hash, the binary order of how many shingles have it, over all documents."""
    slices = 1 << 6
    per = (1 << bits) // slices

    def count(batches):
        total = np.zeros(1 << bits, np.uint16)  # counts of one task; those beyond its range are as good as frequent
        for batch in steps(batches):
            grams, _ = shingle_sets(batch["text"], width)
            at, n = np.unique((grams & U((1 << bits) - 1)).astype(np.uint32), return_counts=True)
            total[at] = np.minimum(total[at] + n, 65535)
        for i in range(slices):
            own = total[i * per : (i + 1) * per]
            at = np.flatnonzero(own > 255).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([own.astype(np.uint8).tobytes()]), pa.array([at.tobytes()]), pa.array([(own[at] >> 8).astype(np.int64).tobytes()])],
                names=["slice", "low", "place", "high"],
            )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(per, np.int64)
        for low, place, high in zip(*(table[c].to_pylist() for c in ("low", "place", "high")), strict=True):
            total += np.frombuffer(low, np.uint8)
            total[np.frombuffer(place, np.uint32)] += np.frombuffer(high, np.int64) << 8
        level = np.frexp(total.astype(np.float64))[1].astype(np.uint8)
        return pa.table({"slice": table["slice"][:1], "level": pa.array([level.tobytes()])})

    rows = (
        docs.select(F.col(text).alias("text"))
        .mapInArrow(count, "slice int, low binary, place binary, high binary")
        .groupBy("slice")
        .applyInArrow(add, "slice int, level binary")
        .collect()  # 64 rows, one byte a counter
    )
    out = np.zeros(1 << bits, np.uint8)
    for i, level in rows:
        out[i * per : (i + 1) * per] = np.frombuffer(level, np.uint8)
    return out


def _may_link(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Sizes that allow a link: the overlap is at most the smaller set, the union at least the larger one."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _priority(ref: np.ndarray) -> np.ndarray:
    return mix(ref.astype(U))


def _paired(gram: np.ndarray, ref: np.ndarray, size: np.ndarray, percent: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Pairs (leader, other, sizes) of a block, and which of its entries are in groups of more than SMALL.

    Entries come in groups of one gram; the first of a group by priority leads.
    In groups of SMALL or fewer each leads those after it.
    """
    order = np.lexsort((_priority(ref), gram))
    gram, ref, size = gram[order], ref[order], size[order]
    starts = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(gram)))
    rank = np.arange(len(gram)) - np.repeat(starts, counts)
    large = np.repeat(counts > SMALL, counts)
    pairs = []
    for lead in range(SMALL - 1):
        after = np.flatnonzero((rank > lead) & ~(large & (lead > 0)))
        if not len(after):
            break
        leader = after - rank[after] + lead
        fine = _may_link(size[leader].astype(np.int64), size[after].astype(np.int64), percent)
        pairs.append(np.stack([ref[leader][fine], ref[after][fine]]))
    pairs = np.unique(np.concatenate(pairs, axis=1), axis=1) if pairs else np.zeros((2, 0), np.int64)
    return [pairs[0], pairs[1]], order[large]


class _Out:
    """Rows of one shape for all that the blocks have to say."""

    SCHEMA = f"kind int, bucket int, a long, b long, gram long, size long, {KEYS[0]} long, {KEYS[1]} long, text string"
    COLUMNS = {"bucket": pa.int32(), "a": pa.int64(), "b": pa.int64(), "gram": pa.int64(), "size": pa.int64(), KEYS[0]: pa.int64(), KEYS[1]: pa.int64(), "text": pa.string()}

    def __init__(self) -> None:
        self.tables: list[pa.Table] = []

    def add(self, kind: int, n: int, **columns) -> None:
        out = {"kind": pa.array(np.full(n, kind, np.int32))}
        for name, form in self.COLUMNS.items():
            value = columns.get(name)
            if value is None:
                out[name] = pa.nulls(n, form)
            elif isinstance(value, np.ndarray):
                out[name] = pa.array(value.astype(np.int32 if form == pa.int32() else np.int64))
            else:
                out[name] = value
        self.tables.append(pa.table(out))

    def table(self) -> pa.Table:
        if not self.tables:
            self.add(0, 0)
        return pa.concat_tables([t.cast(self.tables[0].schema) for t in self.tables])


def _refs(bucket: int, ordinals: np.ndarray) -> np.ndarray:
    return (np.int64(bucket) << np.int64(32)) | ordinals.astype(np.int64)


def _sent(own_bucket: int, texts: pa.Table, ordinals: np.ndarray, pairs: pa.Table) -> pa.Table:
    """The text of each leader of this bucket, once for every bucket that holds partners, with their numbers in it."""
    a, b = pairs["a"].to_numpy(), pairs["b"].to_numpy()
    order = np.lexsort((b, b >> 32, a))
    a, b = a[order], b[order]
    target = b >> 32
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (target[1:] != target[:-1])
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(a))
    partners = [(b[s:e] & 0xFFFFFFFF).astype(np.uint32).tobytes() for s, e in zip(starts, ends, strict=True)]
    rows = np.searchsorted(ordinals, a[starts] & 0xFFFFFFFF)
    text = texts["text"].take(pa.array(rows))
    return pa.table({"bucket": pa.array(target[starts].astype(np.int32)), "a": pa.array(a[starts]), "partners": pa.array(partners, pa.binary()), "text": text})


_SENT = "bucket int, a long, partners binary, text string"


def _overlaps(sets: tuple[np.ndarray, np.ndarray], ordinals: np.ndarray, sent: pa.Table, width: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (leader, ordinal here) among the pairs that were sent."""
    partners = [np.frombuffer(p, np.uint32) for p in sent["partners"].to_pylist()]
    counts = np.fromiter(map(len, partners), np.int64, len(partners))
    leader = np.repeat(np.arange(len(partners)), counts)
    here = np.searchsorted(ordinals, np.concatenate(partners)) if partners else np.zeros(0, np.int64)
    linked = _asked_cells(shingle_sets(sent["text"], width), sets, leader, here, percent)
    return sent["a"].to_numpy()[leader[linked]], ordinals[here[linked]]


def _asked_cells(rows: tuple[np.ndarray, np.ndarray], others: tuple[np.ndarray, np.ndarray], x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Which cells (x, y) of the product of two incidence blocks are links.

    Columns come in SLICES by hash. After each, cells go whose count and the
    columns left in the smaller rest stay below the overlap that their sizes
    demand.
    """
    (grams, first), (other_grams, other_first) = rows, others
    size, other_size = np.diff(first)[x], np.diff(other_first)[y]
    demand = -(-percent * (size + other_size) // (100 + percent))
    counts = np.zeros(len(x), np.int64)
    left = np.flatnonzero((size > 0) & (np.minimum(size, other_size) >= demand))
    asked = np.zeros(len(other_first) - 1, bool)
    asked[y[left]] = True
    columns, at = np.unique(grams, return_inverse=True)
    owner = np.repeat(np.flatnonzero(asked), np.diff(other_first)[asked])
    other = other_grams[np.repeat(asked, np.diff(other_first))]
    column = np.searchsorted(columns, other)
    column[column == len(columns)] = 0
    known = columns[column] == other if len(columns) else np.zeros(len(other), bool)
    places = owner[known] * len(columns) + column[known]  # ascending
    edges, other_edges = _slice_edges(grams, first), _slice_edges(other_grams, other_first)
    for part in range(SLICES):
        begin, n = edges[part][x[left]], (edges[part + 1] - edges[part])[x[left]]
        turns = np.cumsum(n) // LOOKUPS
        for own in np.split(np.arange(len(left)), np.flatnonzero(np.diff(turns)) + 1):
            cell = np.repeat(own, n[own])
            entry = begin[cell] + np.arange(len(cell)) - np.repeat(np.cumsum(n[own]) - n[own], n[own])
            if not len(cell) or not len(places):
                continue
            place = y[left[cell]] * len(columns) + at[entry]
            found = np.searchsorted(places, place)
            found[found == len(places)] = 0
            cell = cell[places[found] == place]
            counts[left] += np.bincount(cell, minlength=len(left))
        rest = np.minimum((first[1:] - edges[part + 1])[x[left]], (other_first[1:] - other_edges[part + 1])[y[left]])
        left = left[counts[left] + rest >= demand[left]]
    return left


def _slice_edges(grams: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Where each slice of the range of hashes begins in each set (one place more than slices)."""
    part = ((grams >> U(32)) * U(SLICES) >> U(32)).astype(np.int64)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return [first[:-1] + np.bincount(owner[part < s], minlength=len(first) - 1) for s in range(SLICES + 1)]


def similar_texts(docs: DataFrame, text: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Each distinct text once: its two keys, `ref`, `n_shingles` and `component`, the smallest ref that links lead to.

    Shingles are `width` consecutive words (A-Z lower-cased, separated by ASCII
    white space); a text of fewer words is one shingle; one without words, or
    null, has none and links with nothing. Texts link when 100 * overlap >=
    percent * union. An empty table gives no rows.
    """
    texts = distinct_texts(docs, text)
    n, deal = blobs.buckets(docs), blobs.partitions(docs)
    bits = min(max(RARITY_BITS[0], (blobs.planned_bytes(docs) // BYTES_A_COUNTER).bit_length()), RARITY_BITS[1])
    level = docs.sparkSession.sparkContext.broadcast(_rarity(docs, text, width, bits))

    def firsts(table: pa.Table) -> pa.Table:
        own, _ = gathered(table)
        grams, first = shingle_sets(own["text"], width)
        size = np.diff(first)
        owner = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((grams, level.value[(grams & U((1 << bits) - 1)).astype(np.int64)], owner))
        rank = np.arange(len(grams)) - first[owner]
        # ceil(percent * size / 100) of them need to be shared
        kept = order[rank < (size - (percent * size + 99) // 100 + 1)[owner]]
        return blobs.pack(
            ((grams[kept] >> U(32)) % U(n)).astype(np.int64), table["bucket"][0].as_py(), {"gram": grams[kept], "ordinal": owner[kept].astype(np.uint32), "size": size[owner[kept]].astype(np.uint32)}
        )

    def pair(table: pa.Table) -> pa.Table:
        rows, got = blobs.unpack(table, FIRSTS)
        order = np.argsort(got["gram"], kind="stable")
        gram = got["gram"][order]
        same = gram[1:] == gram[:-1]
        order = order[np.concatenate([[False], same]) | np.append(same, False)] if len(gram) else order
        ref = _refs(0, got["ordinal"][order]) | (table["sender"].to_numpy()[rows[order]].astype(np.int64) << np.int64(32))
        (a, b), large = _paired(got["gram"][order], ref, got["size"][order], percent)
        out = _Out()
        out.add(KIND_LINK, len(a), bucket=a >> 32, a=a, b=b)
        out.add(KIND_ENTRY, len(large), bucket=ref[large] >> 32, a=ref[large], gram=got["gram"][order][large].view(np.int64), size=got["size"][order][large])
        return out.table()

    def send(table: pa.Table, pairs: pa.Table) -> pa.Table:
        pairs = pairs.filter(pa.compute.equal(pairs["kind"], KIND_LINK))
        if not table.num_rows or not pairs.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "a": pa.array([], pa.int64()), "partners": pa.array([], pa.binary()), "text": pa.array([], pa.string())})
        own, _ = gathered(table)
        pairs = pairs.select(["a", "b"]).group_by(["a", "b"]).aggregate([])
        return _sent(table["bucket"][0].as_py(), own, np.arange(own.num_rows), pairs)

    def multiply(table: pa.Table, sent: pa.Table) -> pa.Table:
        out = _Out()
        if not table.num_rows:
            return out.table()
        own, _ = gathered(table)
        bucket = table["bucket"][0].as_py()
        entries = pa.compute.is_null(sent["partners"])
        pairs, entries = sent.filter(pa.compute.invert(entries)), sent.filter(entries)
        sets = shingle_sets(own["text"], width)
        a, b = _overlaps(sets, np.arange(own.num_rows), pairs, width, percent)
        out.add(KIND_LINK, len(a), a=a, b=_refs(bucket, b))
        out.add(KIND_NODE, own.num_rows, a=_refs(bucket, np.arange(own.num_rows)), size=np.diff(sets[1]), **{k: own[k] for k in KEYS})
        if entries.num_rows:
            at = np.unique(entries["a"].to_numpy() & 0xFFFFFFFF)
            out.add(KIND_TEXT, len(at), bucket=np.full(len(at), bucket), a=_refs(bucket, at), text=own["text"].take(pa.array(at)))
            out.add(KIND_ENTRY, entries.num_rows, a=entries["a"], gram=entries["gram"], size=entries["size"])
        return out.table()

    said = texts.groupBy("bucket").applyInArrow(firsts, blobs.schema(FIRSTS)).repartition(deal, "bucket").groupBy("bucket").applyInArrow(pair, _Out.SCHEMA)
    sent = texts.groupBy("bucket").cogroup(said.groupBy("bucket")).applyInArrow(send, _SENT)
    nothing = F.lit(None).cast("long")
    sent = sent.select("bucket", "a", "partners", "text", nothing.alias("gram"), nothing.alias("size")).union(
        said.where(F.col("kind") == KIND_ENTRY).select("bucket", "a", F.lit(None).cast("binary"), F.lit(None).cast("string"), "gram", "size")
    )
    found = written(texts.groupBy("bucket").cogroup(sent.groupBy("bucket")).applyInArrow(multiply, _Out.SCHEMA), "jaccard", "kind")
    level.unpersist()  # what follows reads the written table
    links = found.where(F.col("kind") == KIND_LINK).select("a", "b")
    links = _tile_links(found, links, width, percent, deal)
    labels = components(links)
    nodes = found.where(F.col("kind") == KIND_NODE).select(*KEYS, F.col("a").alias("ref"), F.col("size").alias("n_shingles"))
    return nodes.join(labels, nodes["ref"] == labels["node"], "left").select(*KEYS, "ref", "n_shingles", F.coalesce("label", "ref").alias("component"))


def _tile_links(found: DataFrame, links: DataFrame, width: int, percent: int, deal: int) -> DataFrame:
    """`links`, and those that join parts of columns of many documents that the leaders left in several parts.

    Such columns make clusters. Documents of one are banded by size, so that
    links reach the next band at most, and dealt into blocks of about BLOCK in
    a band. One task multiplies a tile: a block of documents outside the
    cluster's largest part by one of the largest part, or by another one
    outside.
    """
    entries = found.where(F.col("kind") == KIND_ENTRY).select("gram", F.col("a").alias("ref"), "size")
    own = entries.select("ref").distinct()
    near = links.join(own.withColumnRenamed("ref", "a"), "a", "left_semi").join(own.withColumnRenamed("ref", "b"), "b", "left_semi")
    parts = components(near)
    marked = entries.join(parts, entries["ref"] == parts["node"], "left").select("gram", "ref", "size", F.coalesce("label", "ref").alias("part"))
    groups = marked.groupBy("gram").agg(F.min("ref").alias("first"), F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("gram", "first")
    open_ = written(marked.join(groups, "gram").select("ref", "size", "part", "first"), "open_groups")
    clusters = components(open_.select(F.col("ref").alias("a"), F.col("first").alias("b")))
    band = F.floor(F.log(F.col("size")) / (math.log(100 / percent) + 1e-6)).cast("int")  # sizes that allow a link differ by one band at most
    members = open_.select("ref", "part", band.alias("band")).distinct()
    members = members.join(clusters, F.col("ref") == clusters["node"], "left").select("ref", "part", "band", F.coalesce("label", "ref").alias("cluster"))
    largest = members.groupBy("cluster", "part").agg(F.count("*").alias("n")).groupBy("cluster").agg(F.max_by("part", F.struct("n", "part")).alias("largest"))
    members = members.join(largest, "cluster").select("ref", "cluster", "band", (F.col("part") != F.col("largest")).alias("outside"))
    sizes = members.groupBy("cluster", "band", "outside").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    texts = found.where(F.col("kind") == KIND_TEXT).select(F.col("a").alias("ref"), "text")
    place = F.struct("band", F.pmod(F.xxhash64("ref"), "blocks").cast("int").alias("block"), "outside")
    placed = written(members.join(sizes, ["cluster", "band", "outside"]).select("ref", "cluster", place.alias("place")), "clusters")
    blocks = sizes.select("cluster", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct("band", i.alias("block"), "outside"))).alias("place"))
    left = blocks.where("place.outside").withColumnRenamed("place", "one")
    tiles = left.join(blocks.withColumnRenamed("place", "two"), "cluster").where("abs(one.band - two.band) <= 1 AND (NOT two.outside OR one <= two)")
    tiles = written(tiles.select("cluster", "one", "two"), "tiles")
    sides = [
        placed.join(tiles.select("cluster", F.col(side).alias("place"), "one", "two"), ["cluster", "place"]).select("cluster", "one", "two", F.lit(side == "one").alias("leads"), "ref")
        for side in ("one", "two")
    ]

    def multiply(table: pa.Table) -> pa.Table:
        leads = table["leads"].to_numpy(zero_copy_only=False)
        ref = table["ref"].to_numpy()
        one, two = np.flatnonzero(leads), np.flatnonzero(~leads)
        edges = _product(table["text"].take(pa.array(one)), table["text"].take(pa.array(two)), ref[one], ref[two], width, percent)
        known, at = np.unique(np.concatenate([ref[one], ref[two]]), return_inverse=True)
        labels = local_labels(len(known), at[edges[0]], at[len(one) + edges[1]])
        joined = np.flatnonzero(labels != np.arange(len(known)))
        return pa.table({"a": pa.array(known[joined]), "b": pa.array(known[labels[joined]])})

    held = sides[0].union(sides[1]).join(texts, "ref").select("cluster", "one", "two", "leads", "ref", "text")
    more = held.repartition(deal, "cluster", "one", "two").groupBy("cluster", "one", "two").applyInArrow(multiply, "a long, b long")
    return links.union(written(more, "links"))


def _product(one: pa.Array, two: pa.Array, refs_one: np.ndarray, refs_two: np.ndarray, width: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two blocks of texts by the product of their incidence matrices.

    Columns of many documents are multiplied as dense matrices, some at a time;
    the few documents of each other column are counted pair by pair.
    """
    (grams, first), (other_grams, other_first) = shingle_sets(one, width), shingle_sets(two, width)
    size, other_size = np.diff(first), np.diff(other_first)
    n, m = len(size), len(other_size)
    columns = np.intersect1d(grams, other_grams)
    rows, begin = _by_column(grams, first, columns)
    other_rows, other_begin = _by_column(other_grams, other_first, columns)
    here, there = np.diff(begin), np.diff(other_begin)
    pairs = here * there
    dense = pairs * DENSE > n * m
    counts = np.zeros((n, m), np.float32)
    full = np.flatnonzero(dense)
    for at in range(0, len(full), COLUMNS):
        own = full[at : at + COLUMNS]
        counts += _incidence(rows, begin, own, n) @ _incidence(other_rows, other_begin, own, m).T
    thin = np.flatnonzero(~dense)
    turns = np.cumsum(pairs[thin]) // PAIRS
    for own in np.split(thin, np.flatnonzero(np.diff(turns)) + 1):
        column = np.repeat(own, pairs[own])
        k = np.arange(len(column)) - np.repeat(np.cumsum(pairs[own]) - pairs[own], pairs[own])
        a = rows[begin[column] + k // there[column]]
        b = other_rows[other_begin[column] + k % there[column]]
        counts += np.bincount(a * m + b, minlength=n * m).reshape(n, m)
    counts = counts.astype(np.int64)
    union = size[:, None] + other_size[None, :] - counts
    return np.nonzero((counts > 0) & (100 * counts >= percent * union) & (refs_one[:, None] != refs_two[None, :]))


def _by_column(grams: np.ndarray, first: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents that hold each of `columns` (sorted n-grams), column by column, and where each column's begin."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.searchsorted(columns, grams)
    at[at == len(columns)] = 0
    hit = np.flatnonzero(columns[at] == grams) if len(columns) else np.zeros(0, np.int64)
    order = hit[np.argsort(at[hit], kind="stable")]
    return owner[order], np.searchsorted(at[order], np.arange(len(columns) + 1))


def _incidence(rows: np.ndarray, begin: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
    """The 0/1 matrix of n documents by the given columns."""
    counts = begin[columns + 1] - begin[columns]
    column = np.repeat(np.arange(len(columns)), counts)
    k = np.arange(len(column)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = np.zeros((n, len(columns)), np.float32)
    out[rows[begin[columns][column] + k], column] = 1
    return out


def with_components(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """`docs` with `n_shingles` and `component_id`, the smallest key that links lead to, itself included.

    Rows without shingles keep their own key, null as it may be; a null key is
    never the smallest of others. Rows of equal texts with shingles are linked.
    Columns of the two new names are replaced.
    """
    own = docs.select(*(F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(docs.columns)))  # names that can't clash
    own_key, own_text = (f"kept_{docs.columns.index(c)}" for c in (key, text))
    found = attach(own, similar_texts(own, own_text, width, percent), own_text)
    smallest = found.where("n_shingles > 0").groupBy("component").agg(F.min(own_key).alias("_smallest")).withColumnRenamed("component", "_component")
    out = found.join(smallest, (found["component"] == smallest["_component"]) & (found["n_shingles"] > 0), "left")
    rest = [(i, c) for i, c in enumerate(docs.columns) if c not in ("n_shingles", "component_id")]
    return out.select(*(F.col(f"kept_{i}").alias(c) for i, c in rest), "n_shingles", F.coalesce("_smallest", own_key).alias("component_id"))


def first_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group of linked texts: that of the smallest key, nulls last; among equal keys hashes of the text, then of the row decide.

    Groups are told apart by their texts, not by their smallest key, which may
    be null or stand in several. Rows without shingles link with nothing and
    stay, but repeated ones stay once.
    """
    own = docs.select(*(F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(docs.columns)))  # names that can't clash
    own_key, own_text = (f"kept_{docs.columns.index(c)}" for c in (key, text))
    found = attach(own, similar_texts(own, own_text, width, percent), own_text)
    whole = F.xxhash64(*(c for c in own.columns if "map<" not in own.schema[c].dataType.simpleString()))
    order = F.struct(F.col(own_key).isNull().alias("last"), F.col(own_key), *text_keys(F.col(own_text)), whole.alias("whole"))
    alone = F.when(F.col("n_shingles") == 0, F.struct(F.col(own_key).alias("key"), whole.alias("whole")))
    # combined before the shuffle: a group sends one row per task
    first = found.groupBy("component", alone.alias("alone")).agg(F.min_by(F.struct(*own.columns), order).alias("row"))
    return first.select(*(F.col(f"row.kept_{i}").alias(c) for i, c in enumerate(docs.columns)))
