"""SimHash near-duplicates: fingerprints, links found with BK-trees, and groups of linked texts.

A fingerprint has 64 bits. Texts of equal fingerprints form a class; only classes are linked. Two
fingerprints that differ in at most two bits agree in at least two of four 16-bit quarters, so
each class is filed under its six pairs of quarters, and only classes of one file can be linked.
A file is searched with BK-trees: a child hangs at the Hamming distance to its parent, and a search
follows only edges within the radius of its own distance. A file of more than ``TREE_SIZE`` classes
is cut into shards, and each shard's tree is searched with each other shard, in separate groups of
rows. Each search returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from fareflow.llm.columns import only, renamed
from fareflow.llm.words import LOWER, row_slices
from fareflow.session import materialise

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
#: Classes in one tree; larger files are searched shard by shard.
TREE_SIZE = 4096
#: (query, node) pairs that a search holds at once.
FRONTIER = 1 << 20

_LOWER = LOWER.tobytes()
_PAIRS = [(a, b) for a in range(4) for b in range(a + 1, 4)]


def fingerprint(text: str | None) -> int:
    """The signed 64-bit fingerprint: a bit is set if it is set in over half of the shingle hashes."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE_WORDS:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-SHINGLE_WORDS].tolist()]
        digest, view = xxhash.xxh64_intdigest, memoryview(joined)
        hashes = np.array([digest(view[a:b], SEED) for a, b in zip(starts, (ends[SHINGLE_WORDS - 1:] - 1).tolist())], np.uint64)
    return int(_majority(hashes).view(np.int64))


def _majority(hashes: np.ndarray) -> np.uint64:
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0]


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        for a, b in row_slices(texts):
            prints = [fingerprint(t) for t in texts.slice(a, b - a).to_pylist()]
            rest = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([rest.column("doc_id"), rest.column("_key"), pa.array(prints, pa.int64())], ["doc_id", "_key", "print"])


def _row_key() -> Column:
    """Stands for a row's id and text."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")), F.col("doc_id").isNull())


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, _key, print) of every row; null, empty and blank texts have the fingerprint zero."""
    rows = only(docs, "doc_id", "text").withColumn("_key", _row_key())
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_fingerprints, f"doc_id {kind}, _key long, print long")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class BKTrees:
    """One tree for each value of ``group``; values are distinct within a group. Built level by level."""

    def __init__(self, group: np.ndarray, value: np.ndarray):
        n = len(value)
        order = np.argsort(group, kind="stable")
        self.value = value
        parent, edge = np.full(n, -1), np.zeros(n, np.int64)
        key = group[order]
        pending = order
        owner = np.full(n, -1)  # the node below which a value waits
        self.root = np.empty(n, np.int64)
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if n else np.zeros(0, np.int64)
        self.root[order] = np.repeat(order[heads], np.diff(np.append(heads, n)))
        owner[:] = self.root
        pending = pending[owner[pending] != pending]
        while len(pending):
            d = distance(value[pending], value[owner[pending]]).astype(np.int64)
            slot = owner[pending] * 65 + d
            at = np.argsort(slot, kind="stable")
            pending, slot, d = pending[at], slot[at], d[at]
            first = np.concatenate([[True], slot[1:] != slot[:-1]])
            heads = np.flatnonzero(first)
            node = np.repeat(pending[heads], np.diff(np.append(heads, len(pending))))
            parent[pending[heads]], edge[pending[heads]] = owner[pending[heads]], d[heads]
            owner[pending] = node
            pending = pending[~first]
        children = np.flatnonzero(parent >= 0)
        at = np.argsort(parent[children] * 65 + edge[children], kind="stable")
        self.child = children[at]
        self.slot = parent[self.child] * 65 + edge[self.child]

    def links(self, query: np.ndarray, root: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(position in ``query``, node) within the radius; each query starts at its root."""
        stack = [(at, root[at]) for at in np.array_split(np.arange(len(query)), max(1, len(query) * 8 // FRONTIER))]
        while stack:
            asked, node = stack.pop()
            if not len(asked):
                continue
            d = distance(query[asked], self.value[node]).astype(np.int64)
            near = d <= radius
            if near.any():
                yield asked[near], node[near]
            # The edges a search follows: those labelled within the radius of the distance.
            lo = np.searchsorted(self.slot, node * 65 + np.maximum(d - radius, 0), "left")
            hi = np.searchsorted(self.slot, node * 65 + np.minimum(d + radius, 64), "right")
            count = hi - lo
            if not count.any():
                continue
            ends = np.cumsum(count)
            for part in np.split(np.arange(len(count)), np.searchsorted(ends, np.arange(FRONTIER, int(ends[-1]), FRONTIER))):
                c = count[part]
                flat = np.repeat(lo[part] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
                stack.append((np.repeat(asked[part], c), self.child[flat]))


def _forest(a: np.ndarray, b: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Hang each node below the smallest one it is linked to, until nothing changes."""
    while len(a):
        ra, rb = parent[a], parent[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        if (low == high).all():
            break
        np.minimum.at(parent, high, low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    return parent


def search(file: np.ndarray, side: np.ndarray, value: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (value, smaller value) that span what is linked within each file.

    Values of side 0 form the file's tree and are searched with each other; values of side 1 are
    only searched for among them.
    """
    parent = np.arange(len(value))
    tree = np.flatnonzero(side != 1)
    if len(tree):
        trees = BKTrees(file[tree], value[tree])
        order = np.argsort(file[tree], kind="stable")
        sorted_file = file[tree][order]
        # Files with members of side 1 hold two shards; their own links are searched elsewhere.
        crossed = np.zeros(len(value), bool)
        crossed[np.isin(file, file[side == 1])] = True
        asked = np.flatnonzero(~crossed | (side == 1))
        at = np.minimum(np.searchsorted(sorted_file, file[asked]), len(tree) - 1)
        has = sorted_file[at] == file[asked]
        asked, at = asked[has], at[has]
        for q, node in trees.links(value[asked], trees.root[order[at]], radius):
            parent = _forest(asked[q], tree[node], parent)
    hung = np.flatnonzero(parent != np.arange(len(value)))
    return value[hung], value[parent[hung]]


def _search_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by file; whole files are searched together, many at a time."""
    held: list[pa.RecordBatch] = []

    def found(table: pa.Table) -> pa.RecordBatch:
        column = lambda c: table.column(c).to_numpy()
        keys = [column(c) for c in ("quarter", "file", "i", "j")]
        change = np.zeros(len(keys[0]), bool)
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        a, b = search(np.cumsum(change), column("side"), column("print").view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) < 1 << 16:
            continue
        table = pa.Table.from_batches(held)
        keys = [table.column(c).to_numpy() for c in ("quarter", "file", "i", "j")]
        ends = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        if len(ends):
            yield found(table.slice(0, int(ends[-1])))
            table = table.slice(int(ends[-1]))
        held = table.to_batches()
    if held:
        yield found(pa.Table.from_batches(held))


def links(classes: DataFrame, tree_size: int = TREE_SIZE) -> DataFrame:
    """(a, b) of linked fingerprints: enough of them to connect all that are linked.

    ``classes`` holds each fingerprint once, as ``print``.
    """
    filed = classes.select("print", F.posexplode(F.array(*[
        F.shiftleft(F.shiftrightunsigned("print", 16 * a).bitwiseAND(0xFFFF), 16)
        .bitwiseOR(F.shiftrightunsigned("print", 16 * b).bitwiseAND(0xFFFF)) for a, b in _PAIRS])).alias("quarter", "file"))
    sizes = materialise(filed.groupBy("quarter", "file").agg(F.count("*").alias("n")).where("n > 1")
                             .select("quarter", "file", F.ceil(F.col("n") / tree_size).alias("shards")), "files")
    placed = filed.join(sizes, ["quarter", "file"]).withColumn("i", F.pmod(F.xxhash64("print"), "shards"))
    # Shard i meets shard j >= i: as the tree in (i, j), as the queries in (j, i).
    met = placed.select("print", "quarter", "file", F.col("i").alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("other"))
    met = met.select("print", "quarter", "file", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     (F.col("own") > F.col("other")).cast("int").alias("side"))
    keys = ["quarter", "file", "i", "j"]
    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_search_files, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``edges`` (a, b): the smallest node that can be reached.

    Rounds of large-star and small-star: each node's neighbours are hung below its smallest
    neighbour. The edges of a node are only ever reduced to their minimum and joined back, so no
    task gathers a node's neighbours. Each round is written to the shared folder.
    """
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    before = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialise(large, "large-star")
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = materialise(small.where("a <> b").distinct(), "small-star")
        after = state(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, _key, print, root, component_id) of every row.

    ``root`` is the group's smallest fingerprint, ``component_id`` the smallest doc_id of all texts
    that can be reached over links. A null doc_id is larger than any other; a group of null ids
    only has a null component_id. Repeated rows are members like any other.
    """
    prints = materialise(fingerprints(docs), "fingerprints")
    classes = materialise(prints.groupBy("print").agg(F.min("doc_id").alias("rep")), "classes")
    roots = components(links(classes.select("print")))
    rooted = classes.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = materialise(rooted.join(smallest, "root").select("print", "root", "component_id"), "named-classes")
    return prints.join(named, "print").select("doc_id", "_key", "print", "root", "component_id")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hex digits and component_id of every row of ``docs``."""
    return groups(docs).select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group: that of the smallest doc_id. Rows of equal id and text stay once."""
    rows = renamed(docs, "doc_id", "text").withColumn("_key", _row_key())
    members = groups(docs).groupBy("root", "_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("_key").alias("c"))).alias("r"),
        F.count("*").alias("n"))
    chosen = materialise(members.groupBy("root").agg(F.min(F.struct("r", "n")).alias("s"))
                         .select(F.col("s.r.c").alias("_key"), F.col("s.n").alias("_n")), "chosen")
    # Sorted and merged at every size, so that a small table shows what a large one costs.
    kept = rows.join(chosen.hint("merge"), "_key")
    first = Window.partitionBy("_key").orderBy(F.xxhash64(*[F.col(c) for c in rows.columns]))
    again = kept.where("_n > 1").withColumn("_r", F.row_number().over(first)).where("_r = 1")
    names = [c for c in rows.columns if c != "_key"]
    return kept.where("_n = 1").select(*names).unionByName(again.select(*names)).toDF(*docs.columns)
