"""Removal of long repeated word sequences by recompression.

Texts are parsed in rounds. A round first names runs of one symbol (symbol, count), then pairs of
neighbours of which the left is in one half of all names and the right in the other; which half
follows from the name. Names are 64-bit hashes, so all tasks give equal content the same name
without talking to each other. Whether two neighbours merge depends only on themselves and, at the
edges, on the symbol beside them, so each symbol has a known *reach*: the words that fix it.
Two equal windows of words therefore hold the same symbols wherever a symbol's reach lies inside.

Every window is represented by one such symbol, of the highest round that has one, and there the
one of the smallest name. Consecutive windows with the same representative form a stretch. Spark
counts the representatives of all texts: one that occurs once means unique windows; one whose
stretches are all equal (checked by an independent hash of the whole stretch) means repeated
windows; in all other cases the windows themselves are compared by 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fareflow.llm.columns import only, renamed, schema_of
from fareflow.llm.words import Words, mix, mix2, rolling, row_slices, span
from fareflow.session import materialise

WINDOW = 35
ROUNDS = 3
#: Bytes of text handled at once: a worker holds some tens of numbers for each of its words.
SLICE_BYTES = 256 << 10
FACTORS = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)

# A stretch or window of one text in one 64-bit number: first word, count of windows, text check.
COUNT_BITS, CHECK_BITS = 8, 24


def compress(names: np.ndarray, first: np.ndarray, rounds: int = ROUNDS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each round the symbols' names and their reach ``[low, high)`` in words, in text order.

    ``first`` holds each text's first word and the number of words. The reach of a symbol that
    depends on a text's edge ends one word outside of the text.
    """
    filled = np.diff(first) > 0
    before, after = first[:-1][filled] - 1, first[1:][filled] + 1  # what an edge's symbol reaches to
    heads = first[:-1][filled]  # each text's first symbol
    low = np.arange(len(names))
    high = low + 1
    out = [(names, low, high)]
    for r in range(rounds if len(names) else 0):
        for pairs in (False, True):
            if pairs:
                right_half = mix(names, 2 * r + 12) >> np.uint64(63) == 1
                joined = right_half[1:] & ~right_half[:-1]
            else:
                joined = names[1:] == names[:-1]
            joined[heads[1:] - 1] = False
            at = np.flatnonzero(np.concatenate([[True], ~joined]))
            stop = np.append(at[1:], len(names))
            new_low, new_high = low[at - 1], high[np.minimum(stop, len(names) - 1)]
            heads = np.searchsorted(at, heads)
            new_low[heads] = before
            new_high[np.append(heads[1:], len(at)) - 1] = after
            long = np.flatnonzero(stop - at > 1)
            if pairs:
                # A left half's left edge and a right half's right edge depend on nothing beside them.
                new_low = np.where(right_half[at], new_low, low[at])
                new_high = np.where(right_half[stop - 1], high[stop - 1], new_high)
                merged = mix2(names[at[long]], names[at[long] + 1], 2 * r + 13)
            else:
                merged = mix2(names[at[long]], (stop - at)[long].astype(np.uint64), 2 * r + 11)
            names = names[at]
            names[long] = merged
            low, high = new_low, new_high
        out.append((names, low, high))
    return out


def _smallest(names: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Position of the smallest name in each ``[start, stop)``, the leftmost of equal ones."""
    size = stop - start
    level = np.frexp(size.astype(np.float64))[1] - 1
    best, out = np.arange(len(names)), np.empty(len(start), np.int64)
    for k in range(int(level.max(initial=-1)) + 1):
        at = np.flatnonzero(level == k)
        a, b = best[start[at]], best[stop[at] - (1 << k)]
        out[at] = np.where(names[b] < names[a], b, a)
        if len(best) > 1 << k:
            a, b = best[:-(1 << k)], best[1 << k:]
            best = np.where(names[b] < names[a], b, a)
    return out


def stretches(hashes: np.ndarray, first: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, name of the representative) of each stretch."""
    n = len(hashes)
    sums = rolling(hashes, FACTORS[0])
    is_window = np.zeros(n + 1, np.int64)
    has = np.diff(first) >= window
    np.add.at(is_window, first[:-1][has], 1)
    np.add.at(is_window, first[1:][has] - window + 1, -1)
    left = np.flatnonzero(np.cumsum(is_window)[:-1])
    chosen = np.empty(n, np.int64)
    name = np.empty(n, np.uint64)
    base = 0
    for r, (names, low, high) in reversed(list(enumerate(compress(hashes, first)))):
        if not len(left):
            break
        if r:
            starts = np.cumsum(np.bincount(low + 1, minlength=n + 3))[left]  # symbols with low < window
            stops = np.cumsum(np.bincount(high, minlength=n + 3))[left + window]  # with high <= its end
        else:
            starts, stops = left, left + window
        found = stops > starts
        at = _smallest(mix(names, 99), starts[found], stops[found])
        windows = left[found]
        chosen[windows] = base + at
        name[windows] = mix2(mix2(names[at], span(sums, low[at], high[at])), np.full(len(at), r, np.uint64))
        base += len(names)
        left = left[~found]
    windows = np.flatnonzero(np.cumsum(is_window)[:-1])
    fresh = np.ones(len(windows), bool)
    if len(windows):
        fresh[1:] = (np.diff(windows) != 1) | (np.diff(chosen[windows]) != 0)
    heads = np.flatnonzero(fresh)
    return windows[heads], np.diff(np.append(heads, len(windows))), name[windows[heads]]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _packed(first: np.ndarray, count: np.ndarray, check: np.ndarray) -> np.ndarray:
    return (first << (COUNT_BITS + CHECK_BITS)) | (count << CHECK_BITS) | (check & ((1 << CHECK_BITS) - 1))


def _emit_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        for a, b in row_slices(texts, SLICE_BYTES):
            words = Words.of(texts.slice(a, b - a))
            h = words.hashes(1)
            begin, count, name = stretches(h, words.first)
            other = rolling(words.hashes(2), FACTORS[1])
            text = np.searchsorted(words.first, begin, "right") - 1
            keys = batch.column("_key").to_numpy(zero_copy_only=False)[a:b][text]
            checks = batch.column("_check").to_numpy(zero_copy_only=False)[a:b][text]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_signed(name)), pa.array(_signed(span(other, begin, begin + count + WINDOW - 1))),
                 pa.array(keys), pa.array(_packed(begin - words.first[text], count, checks))],
                ["name", "whole", "_key", "stretch"])


def _open_windows(words: Words, lists: pa.Array, checks: np.ndarray) -> tuple[np.ndarray, ...]:
    """128-bit hash, text, place and number within its text of each distinct window of the open stretches.

    The last result holds all places of windows that a text has twice or more: these are repeated
    whatever other texts hold.
    """
    one, two = rolling(words.hashes(1), FACTORS[0]), rolling(words.hashes(2), FACTORS[1])
    begin, count, text = _ranges(lists, checks)
    begin, text = np.repeat(begin, count), np.repeat(text, count)
    start = begin + np.arange(len(begin)) - np.repeat(np.cumsum(count) - count, count) + words.first[text]
    w1, w2 = _signed(span(one, start, start + WINDOW)), _signed(span(two, start, start + WINDOW))
    order = np.lexsort((w2, w1, text))
    w1, w2, text, start = w1[order], w2[order], text[order], start[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(fresh)
    times = np.diff(np.append(head, len(order)))
    return w1[head], w2[head], text[head], start[head], times, start[np.repeat(times > 1, times)]


def _emit_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct windows of each text in the stretches that are left open, and how often it has them."""
    for batch in batches:
        texts, open_ = batch.column("text"), batch.column("open")
        for a, b in row_slices(texts, SLICE_BYTES):
            words = Words.of(texts.slice(a, b - a))
            checks = batch.column("_check").to_numpy(zero_copy_only=False)[a:b]
            w1, w2, text, start, times, _ = _open_windows(words, open_.slice(a, b - a), checks)
            keys = batch.column("_key").to_numpy(zero_copy_only=False)[a:b][text]
            place = _packed(start - words.first[text], np.ones_like(start), checks[text])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (w1, w2, keys, place, times)], ["w1", "w2", "_key", "stretch", "times"])


def _ranges(lists: pa.Array, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word in its text, windows, row) of packed stretches that belong to the row's text."""
    lists = lists.cast(pa.large_list(pa.int64()))
    flat = np.asarray(lists.flatten(), np.int64)
    row = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0), np.int64))
    own = (flat & ((1 << CHECK_BITS) - 1)) == (checks[row] & ((1 << CHECK_BITS) - 1))
    flat, row = flat[own], row[own]
    return flat >> (COUNT_BITS + CHECK_BITS), (flat >> CHECK_BITS) & ((1 << COUNT_BITS) - 1), row


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The kept words of every text, with counts."""
    for batch in batches:
        texts = batch.column("text")
        for a, b in row_slices(texts, SLICE_BYTES):
            words = Words.of(texts.slice(a, b - a))
            mark = np.zeros(len(words.start) + 1, np.int64)
            checks = batch.column("_check").to_numpy(zero_copy_only=False)[a:b]
            for name in ("repeated", "matched"):
                begin, count, text = _ranges(batch.column(name).slice(a, b - a), checks)
                at = begin + words.first[text]
                np.add.at(mark, at, 1)
                np.add.at(mark, at + count + WINDOW - 1, -1)
            *_, own = _open_windows(words, batch.column("open").slice(a, b - a), checks)
            np.add.at(mark, own, 1)
            np.add.at(mark, own + WINDOW, -1)
            kept = np.cumsum(mark)[:-1] == 0
            raw, kept_texts = words.data.tobytes(), []
            for i in range(b - a):
                lo, hi = int(words.first[i]), int(words.first[i + 1])
                at = lo + np.flatnonzero(kept[lo:hi])
                kept_texts.append(b" ".join([raw[x:y] for x, y in zip(words.start[at].tolist(), words.end[at].tolist())]))
            total = np.diff(words.first)
            left = np.add.reduceat(np.append(kept, 0), words.first[:-1]) * (total > 0)
            out = batch.slice(a, b - a).drop_columns(["_key", "_check", "repeated", "open", "matched"])
            out = out.append_column("_n_words", pa.array(total.astype(np.int64)))
            out = out.append_column("_n_removed", pa.array((total - left).astype(np.int64)))
            yield out.append_column("_kept", pa.array([t.decode() for t in kept_texts], pa.string()))


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with three more columns: ``_n_words``, ``_n_removed`` and ``_kept``, the words left, joined by a space.

    A word goes when a window of 35 consecutive words that covers it also starts anywhere else in
    any text, the same one included; all windows are judged on the input. A null or empty text has
    no words; a text of fewer than 35 words loses none. Repeated rows count as texts of their own,
    so they lose all their windows. ``doc_id`` may be null or repeated: a text is known by a hash
    of its id and content. Columns with other names are kept, whatever they are called.
    """
    plain = renamed(docs, "doc_id", "text")
    t, d = F.coalesce("text", F.lit("")), F.col("doc_id").cast("string")
    keyed = plain.withColumns({"_key": F.xxhash64(F.coalesce(d, F.lit("")), t), "_check": F.xxhash64(t, F.coalesce(d, F.lit("-")))})

    found = keyed.select("text", "_key", "_check").mapInArrow(
        _emit_stretches, "name long, whole long, _key long, stretch long")
    shared = materialise(found.groupBy("name").agg(F.count("*").alias("n"), F.min("whole").alias("a"), F.max("whole").alias("b"))
                         .where("n > 1").select("name", (F.col("a") == F.col("b")).alias("same")), "shared-names")
    marked = materialise(found.select("name", "_key", "stretch").join(shared, "name").groupBy("_key").agg(
        F.collect_set(F.when(F.col("same"), F.col("stretch"))).alias("repeated"),
        F.collect_set(F.when(~F.col("same"), F.col("stretch"))).alias("open")), "stretches")

    opened = keyed.join(marked.where("size(open) > 0").select("_key", "open"), "_key")
    # A window that one text repeats needs no join: that text knows by itself, other texts see the count.
    windows = opened.mapInArrow(_emit_windows, "w1 long, w2 long, _key long, stretch long, times long")
    twice = windows.groupBy("w1", "w2").agg(F.sum("times").alias("n")).where("n > 1").select("w1", "w2")
    matched = windows.where("times = 1").join(twice, ["w1", "w2"]).groupBy("_key").agg(F.collect_set("stretch").alias("matched"))

    out = (keyed.join(marked, "_key", "left").join(matched, "_key", "left")
           .select(*keyed.columns, "repeated", "open", "matched")
           .mapInArrow(_cut, f"{schema_of(plain)}, _n_words long, _n_removed long, _kept string"))
    return out.toDF(*docs.columns, "_n_words", "_n_removed", "_kept")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every text, see ``cut_repeats``."""
    return cut_repeats(only(docs, "doc_id", "text")).select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"),
        F.sha2("_kept", 256).alias("kept_sha256"))
