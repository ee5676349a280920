"""Benchmark decontamination with one Aho-Corasick automaton over the normalised test items.

Texts are lower-cased (A-Z only) and cut into words of ASCII digits, ASCII letters and all bytes
beyond ASCII. A window is ten consecutive words of an item; an item of fewer words is one window.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from fareflow.llm.columns import only, renamed
from fareflow.llm.words import ALNUM, LOWER, Words
from fareflow.session import materialise

WINDOW = 10
#: Normalised window text held by one automaton (about 50 bytes of memory for each). A larger
#: benchmark is scanned for in several passes of this size.
AUTOMATON_BYTES = 2 << 20

_NORMAL = np.where(ALNUM[LOWER], LOWER, 0x20).astype(np.uint8).tobytes()
_automata: dict[str, tuple[ahocorasick.Automaton, list[list[str]], list[int]]] = {}


def item_windows(text: str | None) -> set[bytes]:
    """The windows of one item, each with a space on either side."""
    words = (text or "").encode().translate(_NORMAL).split()
    count = max(1, len(words) - WINDOW + 1) if words else 0
    return {b" " + b" ".join(words[i:i + WINDOW]) + b" " for i in range(count)}


def _blocks(benchmark: DataFrame, unnamed: bool) -> Iterator[dict[bytes, set[str]]]:
    """Windows with their items, an automaton's worth at a time; the driver never holds more.

    With ``unnamed``, items without an id have windows too, but name no item.
    """
    block, size = {}, 0
    wanted = "text IS NOT NULL" if unnamed else "item_id IS NOT NULL AND text IS NOT NULL"
    for row in only(benchmark, "item_id", "text").where(wanted).select(
            F.col("item_id").cast("string").alias("item_id"), "text").toLocalIterator(prefetchPartitions=False):
        for window in item_windows(row.text):
            if window not in block:
                block[window], size = set(), size + len(window)
            if row.item_id is not None:
                block[window].add(row.item_id)
        if size >= AUTOMATON_BYTES:
            yield block
            block, size = {}, 0
    if block:
        yield block


def _automaton(key: str, windows: Broadcast) -> tuple[ahocorasick.Automaton, list[list[str]], list[int]]:
    """Built once in each Python worker and kept for its later tasks."""
    if key not in _automata:
        automaton, items, sizes = ahocorasick.Automaton(), [], []
        for window, ids in windows.value.items():
            automaton.add_word(window.decode("latin-1"), len(items))
            items.append(sorted(ids))
            sizes.append(window.count(b" ") - 1)
        automaton.make_automaton()
        _automata.clear()
        _automata[key] = automaton, items, sizes
    return _automata[key]


def _scan(windows: Broadcast | None, name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Add what one automaton finds to the columns ``_ranges`` (first word, words, ...) and ``_items``."""
    key = uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, items, sizes = _automaton(key, windows) if windows is not None else (None, [], [])
        for batch in batches:
            counts, ranges, found = [], [], []
            for value, ranged, listed in zip(batch.column(name), batch.column("_ranges"), batch.column("_items")):
                words = (value.as_py() or "").encode().translate(_NORMAL).split()
                counts.append(len(words))
                hits, ids = ranged.as_py(), set(listed.as_py())
                text = (b" " + b" ".join(words) + b" ").decode("latin-1")  # one character for each byte
                matches = list(automaton.iter(text)) if automaton is not None and words else []
                if matches:
                    spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 0x20)
                    last = np.searchsorted(spaces, [end for end, _ in matches])
                    for stop, (_, k) in zip(last.tolist(), matches):
                        hits += (stop - sizes[k], sizes[k])
                        ids.update(items[k])
                ranges.append(hits)
                found.append(sorted(ids))
            rest = [c for c in batch.schema.names if c not in ("_n_words", "_ranges", "_items")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in rest], pa.array(counts, pa.int64()),
                 pa.array(ranges, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.string()))],
                [*rest, "_n_words", "_ranges", "_items"])
    return scan


def find(docs: DataFrame, benchmark: DataFrame, unnamed: bool = False) -> DataFrame:
    """``docs`` with ``_n_words``, ``_ranges`` (first word and word count of each hit, flat) and ``_items``.

    Null and empty texts have no words and no hits; an empty benchmark finds nothing. An item
    without a text or a word has no windows, nor has one without an id, unless ``unnamed``: its hits
    then count, without an item. Repeated items count once, by id.
    """
    rows = renamed(docs, "text")
    out = rows.select("*", F.lit(0).cast("long").alias("_n_words"),
                                   F.array().cast("array<bigint>").alias("_ranges"),
                                   F.array().cast("array<string>").alias("_items"))
    sc, passes = docs.sparkSession.sparkContext, 0
    for block in _blocks(benchmark, unnamed):
        if passes:
            out = materialise(out, "scanned")
        out = out.mapInArrow(_scan(sc.broadcast(block), "text"), out.schema)
        passes += 1
    if not passes:
        out = out.mapInArrow(_scan(None, "text"), out.schema)
    return out.toDF(*docs.columns, "_n_words", "_ranges", "_items")


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hit, digest = [], []
        for n, flat, ids in zip(batch.column("n_words").to_pylist(), batch.column("_ranges").to_pylist(),
                                batch.column("_items").to_pylist()):
            mark = np.zeros(n + 1 if flat else 1, np.int64)
            pairs = np.array(flat, np.int64).reshape(-1, 2)
            np.add.at(mark, pairs[:, 0], 1)
            np.add.at(mark, pairs[:, 0] + pairs[:, 1], -1)
            hit.append(int((np.cumsum(mark) > 0).sum()))
            digest.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(hit, pa.int64()),
             pa.array([len(x) for x in batch.column("_items").to_pylist()], pa.int64()), pa.array(digest, pa.string()),
             pa.array([h > 0 for h in hit])],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def spans(text: str | None, ranges: list[int]) -> list[tuple[int, int]]:
    """The hits of ``find`` as character offsets in the original text, merged and in order."""
    words = Words.of(pa.array([text]), ALNUM, lower=True)
    characters = np.cumsum((words.data & 0xC0) != 0x80)  # characters up to and with each byte
    out: list[tuple[int, int]] = []
    for first, count in sorted(zip(ranges[::2], ranges[1::2])):
        start = int(characters[words.start[first]]) - 1
        stop = int(characters[words.end[first + count - 1] - 1])
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(stop, out[-1][1])
        else:
            out.append((start, stop))
    return out


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    found = find(only(docs, "doc_id", "text"), benchmark).select("doc_id", F.col("_n_words").alias("n_words"), "_ranges", "_items")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(_covered, f"doc_id {id_type}, n_words long, n_hit long, n_items long, "
                                      "items_sha256 string, contaminated boolean")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their columns as they were.

    Unlike ``report``, which follows its SQL, this also looks for items without an id.
    """
    rows = renamed(docs, "text")
    return find(rows, benchmark, unnamed=True).where("size(_ranges) = 0").select(*rows.columns).toDF(*docs.columns)
