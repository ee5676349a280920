"""Ranked lexical search without an index: one automaton of all query terms reads the documents.

Terms are runs of ASCII digits, ASCII letters (A-Z as a-z) and all bytes beyond ASCII. In the text
that is scanned every other byte is a space, and each pattern is a term between two spaces, so only
whole terms match. The outputs of the automaton are term numbers; a table maps these to the items.

The documents are read twice. The first pass counts documents, terms and, for each query term, the
documents that hold it. The second one knows all weights, scores every document against the items
with which it shares a term, and keeps the best of its task for each item; Spark merges these.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from fareflow.llm.columns import only, renamed
from fareflow.llm.words import ALNUM, LOWER, buffers, row_slices
from fareflow.operators.dedup import top_per_group
from fareflow.session import materialise

TOP = 10
#: Bytes of distinct terms in one automaton (about 100 bytes of memory for each). A larger set of
#: items is searched for in blocks, each of which reads the documents anew.
BLOCK_BYTES = 1 << 20
#: Cells of documents times items that are scored at once, and candidates held before they are cut back.
CELLS, CANDIDATES = 1 << 20, 1 << 17
#: Tasks whose best rows one task merges before the last merge.
MERGED_TASKS = 256

_NORMAL = np.where(ALNUM[LOWER], LOWER, 0x20).astype(np.uint8)
_LAST = np.iinfo(np.int64).max
_automata: dict[str, ahocorasick.Automaton] = {}


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_NORMAL.tobytes()).split()


@dataclass
class Block:
    """Query items by number, and which of them hold each term."""
    key: str
    terms: list[bytes]
    start: np.ndarray  # for each term the first of its entries in ``items``, one more entry at the end
    items: np.ndarray  # places in ``numbers``
    numbers: np.ndarray


def _blocks(items: DataFrame) -> Iterator[Block]:
    """Blocks of whole items; the driver holds one at a time."""
    known: dict[bytes, list[int]] = {}
    numbers: list[int] = []
    size = 0

    def block() -> Block:
        lists = list(known.values())
        start = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        return Block(uuid.uuid4().hex, list(known), start, np.array([i for x in lists for i in x], np.int64), np.array(numbers, np.int64))

    for row in items.select("_item", "text").toLocalIterator(prefetchPartitions=False):
        found = dict.fromkeys(terms_of(row.text))
        if not found:
            continue
        for term in found:
            if term not in known:
                known[term], size = [], size + len(term)
            known[term].append(len(numbers))
        numbers.append(row["_item"])
        if size >= BLOCK_BYTES:
            yield block()
            known, numbers, size = {}, [], 0
    if numbers:
        yield block()


def _automaton(block: Block) -> ahocorasick.Automaton:
    """Built once in each Python worker and kept for its later tasks."""
    if block.key not in _automata:
        automaton = ahocorasick.Automaton()
        for i, term in enumerate(block.terms):
            automaton.add_word(f" {term.decode('latin-1')} ", i)
        automaton.make_automaton()
        _automata.clear()
        _automata[block.key] = automaton
    return _automata[block.key]


@dataclass
class Counts:
    """Documents of one slice: their terms with repeats, and (document, term, occurrences) of query terms."""
    lengths: np.ndarray
    doc: np.ndarray
    term: np.ndarray
    tf: np.ndarray


def _count(texts: pa.Array, automaton: ahocorasick.Automaton, n_terms: int) -> Counts:
    """One run of the automaton over all texts of a slice; a space parts them."""
    data, old = buffers(texts)
    offsets = old + np.arange(len(old)) + 1
    spaced = np.full(int(offsets[-1]), 0x20, np.uint8)
    for at, a, b in zip(offsets.tolist(), old[:-1].tolist(), old[1:].tolist()):
        spaced[at:at + b - a] = _NORMAL[data[a:b]]
    starts = np.flatnonzero((spaced[1:] != 0x20) & (spaced[:-1] == 0x20))
    lengths = np.diff(np.searchsorted(starts, offsets - 1))
    hits = np.fromiter(automaton.iter(spaced.tobytes().decode("latin-1")), np.dtype([("end", np.int64), ("term", np.int64)]))
    doc = np.searchsorted(offsets, hits["end"], "left") - 1
    pairs, tf = np.unique(doc * n_terms + hits["term"], return_counts=True)
    return Counts(lengths, pairs // n_terms, pairs % n_terms, tf)


def _slices(batch: pa.RecordBatch, block: Block) -> Iterator[tuple[int, Counts]]:
    texts = batch.column("text")
    for a, b in row_slices(texts):
        yield a, _count(texts.slice(a, b - a), _automaton(block), len(block.terms))


def _statistics(shared: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each task (term, documents that hold it); term -1 stands for documents, -2 for all terms."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, n, total = shared.value, 0, 0
        holding = np.zeros(len(block.terms), np.int64)
        for batch in batches:
            for _, counts in _slices(batch, block):
                holding += np.bincount(counts.term, minlength=len(holding))
                n, total = n + int((counts.lengths > 0).sum()), total + int(counts.lengths.sum())
        used = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([used, [-1, -2]])), pa.array(np.concatenate([holding[used], [n, total]]))],
                                         ["term", "n"])
    return count


class _Best:
    """The ``k`` best documents of each item, by score and then by id; a null id counts as the largest."""

    def __init__(self, items: int, k: int):
        self.k, self.rows, self.size = k, [], 0
        self.least = np.ones(items, np.int64)  # scores below cannot be among the best

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        self.rows.append((item, score, doc, null))
        self.size += len(item)
        if self.size > CANDIDATES:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        item, score, doc, null = (np.concatenate(x) for x in zip(*self.rows))
        order = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[order], score[order], doc[order], null[order]
        head = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.zeros(0, np.int64)
        place = np.arange(len(item)) - np.repeat(head, np.diff(np.append(head, len(item))))
        last = place == self.k - 1
        self.least[item[last]] = score[last]
        kept = place < self.k
        self.rows = [(item[kept], score[kept], doc[kept], null[kept])]
        self.size = int(kept.sum())
        return self.rows[0]


def _search(shared: Broadcast, weights: Broadcast, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best documents of each task for each item of the block."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, (weight, n_docs, n_terms) = shared.value, weights.value
        of_term, items = np.diff(block.start), len(block.numbers)
        step = max(1, CELLS // items)
        best = _Best(items, k)
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            null = ids.is_null().to_numpy(zero_copy_only=False)
            ids = pc.fill_null(ids, _LAST).to_numpy(zero_copy_only=False)
            for base, c in _slices(batch, block):
                # Exact at any size: Python's own integers for the product of three counts.
                m = np.array([100 - 90 + (90 * n * n_docs) // max(n_terms, 1) for n in c.lengths.tolist()], np.int64)
                part = weight[c.term] * ((1_000_000_000 * c.tf) // (1000 * c.tf + 8 * m[c.doc]))
                for a in range(0, len(c.lengths), step):
                    lo, hi = np.searchsorted(c.doc, [a, a + step])
                    reach = of_term[c.term[lo:hi]]
                    entry = np.repeat(block.start[c.term[lo:hi]] - (np.cumsum(reach) - reach), reach) + np.arange(reach.sum())
                    cells = np.repeat((c.doc[lo:hi] - a) * items, reach) + block.items[entry]
                    scores = np.zeros(min(step, len(c.lengths) - a) * items, np.int64)
                    np.add.at(scores, cells, np.repeat(part[lo:hi], reach))
                    doc, item = np.nonzero(scores.reshape(-1, items) >= best.least)
                    row = base + a + doc
                    best.add(item, scores[doc * items + item], ids[row], null[row])
        if best.size:
            item, score, doc, null = best.cut()
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.numbers[item]), pa.array(doc, mask=null), pa.array(score)], ["_item", "doc_id", "score"])
    return search


def _block_hits(docs: DataFrame, block: Block, k: int) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(block)
    counts = docs.select("text").mapInArrow(_statistics(shared), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in counts.collect()}  # a number for each term of the block
    n_docs, n_terms = found.pop(-1, 0), found.pop(-2, 0)
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * found.get(t, 0) + 1))) for t in range(len(block.terms))]
    return docs.mapInArrow(_search(shared, sc.broadcast((np.array(weight, np.int64), n_docs, n_terms)), k), "_item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` best documents for each item: all columns of ``items``, then ``_rank``, ``_doc_id`` and ``_score``.

    ``docs``: an integer ``doc_id`` and ``text``; ``items``: ``text`` and any other columns. Whole texts are
    read. Equal scores go by ascending ``doc_id``, null last; documents with score 0 are no results. A null
    or empty text has no terms; such an item has no results. Repeated documents are results of their
    own, repeated items have the same results each. Empty tables give an empty result.
    """
    rows, plain = only(docs, "doc_id", "text"), renamed(items, "text")
    named = materialise(plain.withColumn("_item", F.monotonically_increasing_id()), "items")
    parts = []
    for block in _blocks(named):
        hits = _block_hits(rows, block, k).withColumn("_merge", F.floor(F.spark_partition_id() / MERGED_TASKS))
        order = ["-score", "doc_id"]
        some = top_per_group(hits, ["_item", "_merge"], order, k).drop("row_number", "_merge")
        parts.append(materialise(top_per_group(some, ["_item"], order, k), "found"))
    if not parts:
        parts = [docs.sparkSession.createDataFrame([], "_item long, doc_id long, score long, row_number int")]
    found = reduce(DataFrame.unionByName, parts)
    return named.join(found, "_item").select(*plain.columns, F.col("row_number").alias("_rank"), "doc_id", "score").toDF(
        *items.columns, "_rank", "_doc_id", "_score")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ten best documents, see ``search``."""
    return search(docs, only(benchmark, "item_id", "text")).select(
        "item_id", F.col("_rank").alias("rank"), F.col("_doc_id").alias("doc_id"), F.col("_score").alias("score"))
