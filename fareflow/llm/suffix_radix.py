"""Removal of byte sequences that an earlier document holds, by a radix sort of suffixes to a limited depth.

Two suffixes are equal as far as it matters when their first ``WINDOW`` bytes (their *windows*) are.
Suffixes are sorted by digits, the most significant first; every digit is a function of the window, so
equal windows never part. Digits that one document alone holds are done with the pass that finds it out.
Three digits end the sort at the depth of the window:

1. the *gram*, one of the stretches of ``GRAM`` bytes in the window. The window's stretch of ``SEED`` bytes with
   the smallest hash (the leftmost of equal ones) points to it: its distance from the window's start, modulo the
   number of grams, is the gram's. Neighbouring suffixes mostly have the same gram and travel as one record, a *run*;
2. the *core*: the window's distance from its gram in steps of ``STEP``, and the ``WINDOW - STEP + 1`` bytes
   that all windows of that step share;
3. the window itself.

A pass deals the records out by digit and sorts them by digit, digest of all their bytes, and document. Equal
records hold equal windows: all but those of the smallest document are copies, and that document stands for them.
Where a digit has several different records, the documents that stand for them cut these for the next pass;
after the last digit no record is left to cut. Digits are hashes: groups need to be told apart, not put in the
order of their bytes. A record that follows an equal one of a smaller document in the same slice of texts
is known to be a copy and is not dealt out by its digit, so a digit has at most one such record for each slice.
Records are told apart by 96 bits of hash: those of the digit and 32 more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fareflow.llm.columns import only, renamed, schema_of
from fareflow.llm.words import buffers, mix, row_slices
from fareflow.session import materialise, release

WINDOW = 50
#: Bytes of a gram, and of the stretches that choose it: of 8 to 16 bytes, and as many less than a gram as a window has grams.
GRAM, SEED = 30, 9
#: Windows of a run that one core stands for.
STEP = 7
#: Bytes of text handled at once, at most 2^19 less a window; a longer text is handled in parts of so many windows.
PART_BYTES = 256 << 10
#: Records that are compared with each other before they are dealt out.
SLICE_RECORDS = 1 << 17

#: The lowest bit of ``check`` says that the record is known to be a copy.
_RECORD = "name long, check long, _id long"
_POSITION_BITS = 19
_LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number; zeros follow the last byte."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), np.dtype("<u8"), padded.data, 0, (1,))


def digest(lanes: np.ndarray, start: np.ndarray, size: np.ndarray | int, salt: int) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes."""
    left = np.broadcast_to(np.asarray(size, np.int64), start.shape)
    out, at, where = mix(left.astype(np.uint64), salt), start, slice(None)
    while len(at):
        part = (out[where] ^ (lanes[at] & _LOW_BYTES[np.minimum(left, 8)])) * np.uint64(0x9E3779B97F4A7C15)
        part ^= part >> np.uint64(29)
        part *= np.uint64(0xBF58476D1CE4E5B9)
        part ^= part >> np.uint64(32)
        out[where] = part
        more = np.flatnonzero(left > 8)
        where = more if isinstance(where, slice) else where[more]
        at, left = at[more] + 8, left[more] - 8
    return out


def joined(name: np.ndarray, check: np.ndarray) -> np.ndarray:
    """A record's digest, from its digit and 32 bits that check its bytes."""
    return mix(name.view(np.uint64) + check.view(np.uint64), 23)


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, place of the gram, text) of each run; windows do not cross the ``offsets``."""
    n = len(data)
    if n < WINDOW:
        return (np.zeros(0, np.int64),) * 4
    lanes = np.ndarray((n - 7,), np.dtype("<u8"), np.ascontiguousarray(data).data, 0, (1,))
    seeds = lanes[:n - SEED + 1] * np.uint64(0x9E3779B97F4A7C15)
    seeds ^= seeds >> np.uint64(31)
    seeds += lanes[SEED - 8:]
    seeds *= np.uint64(0xD6E8FEB86659FD93)
    seeds >>= np.uint64(32)
    place = np.arange(n, dtype=np.uint32)
    # The upper bits of the hash, then the place: the smallest is the leftmost of the smallest hashes.
    least = (seeds.astype(np.uint32) & np.uint32(-1 << _POSITION_BITS & 0xFFFFFFFF)) | place[:len(seeds)]
    width, size = WINDOW - SEED + 1, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    starts, grams = n - WINDOW + 1, np.uint32(WINDOW - GRAM + 1)
    away = (np.minimum(least[:starts], least[width - size:]) & np.uint32((1 << _POSITION_BITS) - 1)) - place[:starts]
    away -= grams * (away >= grams)  # at most twice as many seeds as grams
    chosen = away + place[:starts]
    fresh = np.empty(starts, bool)
    fresh[0] = True
    np.not_equal(chosen[1:], chosen[:-1], out=fresh[1:])
    edges = np.concatenate([offsets, offsets - WINDOW + 1])
    fresh[edges[(edges >= 0) & (edges < starts)]] = True
    heads = np.flatnonzero(fresh)
    text = np.searchsorted(offsets, heads, "right") - 1
    count = np.diff(np.append(heads, starts))
    inside = heads <= offsets[text + 1] - WINDOW
    heads = heads[inside]
    return heads, count[inside], chosen[heads].astype(np.int64), text[inside]


def _of(names: np.ndarray, row: np.ndarray) -> np.ndarray:
    return names.view(np.uint64) + mix(row.astype(np.uint64), 17)


def _listed(names: np.ndarray, row: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Which names are in the list of their row."""
    lists = lists.cast(pa.large_list(pa.int64()))
    owner = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0), np.int64))
    return np.isin(_of(names, row), _of(np.asarray(lists.flatten(), np.int64), owner))


class _Records:
    """Records of some texts: windows in a row that share their digit."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, base: int):
        self.size, self.base = len(data), base  # base: where ``data`` starts in the slice of texts
        self.begin, self.count, self.gram, self.row = runs(data, offsets)
        self.lanes = _lanes(data)
        self._named(digest(self.lanes, self.gram, GRAM, 3), 7)

    def _named(self, name: np.ndarray, salt: int) -> _Records:
        self.name = name
        self.check = digest(self.lanes, self.begin, self.count + WINDOW - 1, salt) >> np.uint64(32)
        self.whole = joined(self.name, self.check)
        return self

    def _cut(self, which: np.ndarray) -> _Records:
        """A copy with the chosen records, whose digit and digest are still to be set."""
        other = object.__new__(_Records)
        other.__dict__ |= self.__dict__
        other.begin, other.count, other.gram, other.row = (x[which] for x in (self.begin, self.count, self.gram, self.row))
        return other

    def cores(self, which: np.ndarray) -> _Records:
        """The chosen runs, cut at every ``STEP`` of distance from the gram."""
        first, last = (self.gram - self.begin - self.count + 1)[which] // STEP, (self.gram - self.begin)[which] // STEP
        pieces = last - first + 1
        out = self._cut(np.repeat(which, pieces))
        step = np.repeat(last + np.cumsum(pieces) - pieces, pieces) - np.arange(pieces.sum())
        near = out.gram - step * STEP  # the window next to the gram, whether this run has it or not
        low, high = np.maximum(out.begin, near - STEP + 1), np.minimum(out.begin + out.count - 1, near)
        out.begin, out.count = low, high - low + 1
        return out._named(digest(out.lanes, near, WINDOW - STEP + 1, 9) ^ mix(step.astype(np.uint64), 5), 7)

    def windows(self, which: np.ndarray) -> _Records:
        """The windows of the chosen records, one by one; two digests tell them apart."""
        count = self.count[which]
        out = self._cut(np.repeat(which, count))
        out.begin = out.begin + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        out.count = np.ones_like(out.begin)
        return out._named(digest(out.lanes, out.begin, WINDOW, 11), 13)


def _passes(runs_: _Records, lists: Sequence[pa.Array]) -> Iterator[_Records]:
    """The records of each pass, as far as the lists (of runs, then of cores to cut) lead."""
    yield (found := runs_)
    for cut, names in zip((_Records.cores, _Records.windows), lists):
        yield (found := cut(found, np.flatnonzero(_listed(found.whole, found.row, names))))


def _slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of texts that are handled together."""
    data, offsets = buffers(texts)
    for a, b in row_slices(texts, PART_BYTES):
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]


def _parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[_Records]:
    if len(offsets) == 2:
        for at in range(0, max(1, len(data) - WINDOW + 1), PART_BYTES):
            part = data[at:at + PART_BYTES + WINDOW - 1]
            yield _Records(part, np.array([0, len(part)]), at)
    else:
        yield _Records(data, offsets, 0)


def _first_of_equal(name: np.ndarray, check: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
    """Each different record of each document once, known to be a copy where an earlier document in here has the same."""
    order = np.lexsort((doc, check, name))
    n, c, d = name[order], check[order], doc[order]
    later = np.zeros(len(order), bool)
    later[1:] = (n[1:] == n[:-1]) & (c[1:] == c[:-1])
    kept = ~later
    kept[1:] |= d[1:] != d[:-1]
    known = np.empty(len(order), np.uint64)
    known[order] = later
    at = np.sort(order[kept])  # rows of one document stay together, which takes less room
    return pa.RecordBatch.from_arrays(
        [pa.array(name[at].view(np.int64)), pa.array((check[at] * np.uint64(2) + known[at]).view(np.int64)), pa.array(doc[at])],
        ["name", "check", "_id"])


def _emit(*columns: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The records of the pass that the columns with those to cut lead to."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = batch.column("_id").to_numpy(zero_copy_only=False)
            for a, b, data, offsets in _slices(batch.column("text")):
                lists = [batch.column(c).slice(a, b - a) for c in columns]
                for part in _parts(data, offsets):
                    *_, found = _passes(part, lists)
                    held.append((found.name, found.check, ids[a:b][found.row]))
                    size += len(found.name)
                    if size >= SLICE_RECORDS:
                        yield _first_of_equal(*map(np.concatenate, zip(*held)))
                        held, size = [], 0
        if held:
            yield _first_of_equal(*map(np.concatenate, zip(*held)))
    return emit


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_id, whole, copied) from records in order: copies, and those that stand for one of several records of a digit.

    Only the first of the last equal records is carried to the next batch.
    """
    carried, was_open = (np.zeros(0, np.int64),) * 3, False
    for batch in batches:
        name, check, doc = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("name", "check", "_id"))
        known = check & 1 == 1
        whole = joined(name, check >> 1).view(np.int64)
        rest = [np.concatenate(x) for x in zip(carried, (name[~known], whole[~known], doc[~known]))]
        n, w, d = rest
        if not len(n):
            yield pa.RecordBatch.from_arrays([pa.array(doc[known]), pa.array(whole[known]), pa.array(np.ones(known.sum(), bool))],
                                             ["_id", "whole", "copied"])
            continue
        fresh = np.ones(len(n), bool)
        fresh[1:] = (n[1:] != n[:-1]) | (w[1:] != w[:-1])
        heads = np.flatnonzero(fresh)
        first = np.repeat(d[heads], np.diff(np.append(heads, len(n))))
        later = d > first
        beside = n[heads][1:] == n[heads][:-1]
        several = np.zeros(len(heads), bool)
        several[1:] |= beside
        several[:-1] |= beside
        last_open = bool(several[-1]) or (was_open and len(heads) == 1)
        if was_open:
            several[0] = False  # it was given out with the batch before
        opened = heads[several]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([doc[known], d[later], d[opened]])), pa.array(np.concatenate([whole[known], w[later], w[opened]])),
             pa.array(np.repeat([True, False], [known.sum() + later.sum(), len(opened)]))], ["_id", "whole", "copied"])
        at = heads[-1]
        carried, was_open = (n[at:at + 1], w[at:at + 1], d[at:at + 1]), last_open


def _gone(data: np.ndarray, offsets: np.ndarray, lists: Sequence[pa.Array], copied: pa.Array) -> np.ndarray:
    """Which bytes of a slice are covered by copied windows."""
    gone = np.zeros(len(data), bool)
    if not len(copied.flatten()):
        return gone
    for part in _parts(data, offsets):
        change = np.zeros(part.size + 1, np.int32)
        for found in _passes(part, lists):
            at = np.flatnonzero(_listed(found.whole, found.row, copied))
            np.add.at(change, found.begin[at], 1)
            np.add.at(change, found.begin[at] + found.count[at] + WINDOW - 1, -1)
        gone[part.base:part.base + part.size] |= np.cumsum(change)[:-1] > 0
    return gone


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes left of every text, with counts."""
    marks = ["copied", "runs", "cores"]
    for batch in batches:
        for a, b, data, offsets in _slices(batch.column("text")):
            copied, *lists = [batch.column(m).slice(a, b - a) for m in marks]
            gone = _gone(data, offsets, lists, copied)
            kept = data[~gone]
            ends = np.concatenate([[0], np.cumsum(~gone)])[offsets]
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            heads = offsets[:-1][np.diff(offsets) > 0]
            first[heads] = gone[heads]
            spans = np.diff(np.searchsorted(np.flatnonzero(first), offsets))
            texts = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(kept)])
            out = batch.slice(a, b - a).drop_columns(["_id", *marks])
            size = np.diff(offsets)
            for name, values in (("_n_bytes", size), ("_n_removed", size - np.diff(ends)), ("_n_spans", spans)):
                out = out.append_column(name, pa.array(values.astype(np.int64)))
            yield out.append_column("_kept", texts.cast(pa.binary()))


def _pass(found: DataFrame, opened: str) -> DataFrame:
    """(_id, copied, ``opened``): digests of a document's records that an earlier one has, and of those it cuts further."""
    dealt = found.repartition(F.when(F.col("check") % 2 == 1, F.xxhash64("_id")).otherwise(F.col("name"))).sortWithinPartitions("name", "check", "_id")
    compared = dealt.mapInArrow(_compare, "_id long, whole long, copied boolean")
    out = materialise(compared.groupBy("_id").agg(
        F.collect_set(F.when(F.col("copied"), F.col("whole"))).alias("copied"),
        F.collect_set(F.when(~F.col("copied"), F.col("whole"))).alias(opened)), opened)
    release(found.sparkSession)
    return out


def cut_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_n_bytes``, ``_n_removed``, ``_n_spans`` (maximal removed runs) and ``_kept``, the bytes left.

    ``docs``: an integer ``doc_id`` and ``text``, read as UTF-8 bytes; what is left may be no UTF-8. A byte
    goes when a string of ``WINDOW`` bytes that covers it also starts in a document with a smaller id; all
    strings are judged on the input. Null and empty texts have no bytes, texts of fewer than ``WINDOW``
    bytes lose none. Documents with the same id, repeated rows among them, take nothing from each other; one
    without an id takes nothing and loses nothing. Columns with other names are kept, whatever they are called.
    """
    plain = renamed(docs, "doc_id", "text")
    keyed = plain.withColumn("_id", F.col("doc_id").cast("long"))
    texts = keyed.where("_id IS NOT NULL").select("_id", "text")

    # Each pass cuts what the one before left open, in fewer documents.
    runs_ = _pass(texts.mapInArrow(_emit(), _RECORD), "runs")
    cores = _pass(texts.join(runs_.where("size(runs) > 0").select("_id", "runs"), "_id").mapInArrow(_emit("runs"), _RECORD), "cores")
    open_ = cores.where("size(cores) > 0").select("_id", "cores").join(runs_.select("_id", "runs"), "_id")
    windows = _pass(texts.join(open_, "_id").mapInArrow(_emit("runs", "cores"), _RECORD), "windows")

    copies = reduce(DataFrame.unionByName, [p.select("_id", F.explode("copied").alias("copied")) for p in (runs_, cores, windows)])
    marks = materialise(copies.groupBy("_id").agg(F.collect_set("copied").alias("copied"))
                        .join(runs_.select("_id", "runs"), "_id", "left").join(cores.select("_id", "cores"), "_id", "left"), "marks")
    release(docs.sparkSession, runs_, cores, windows)
    out = (keyed.join(marks, "_id", "left").select(*keyed.columns, "copied", "runs", "cores")
           .mapInArrow(_cut, f"{schema_of(plain)}, _n_bytes long, _n_removed long, _n_spans long, _kept binary"))
    return out.toDF(*docs.columns, "_n_bytes", "_n_removed", "_n_spans", "_kept")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every text, see ``cut_copies``."""
    return cut_copies(only(docs, "doc_id", "text")).select(
        "doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"))
