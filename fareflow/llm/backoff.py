"""Stupid-backoff language-model scores of documents, from the counts of the same corpus.

The score of a text is a sum over its words: log(f(cw) / f(c)) where the word w follows c and the
pair occurs at least ``MIN_COUNT`` times in the corpus, else log(f(w) / N), with log(0.4) added
unless w is the first word. f counts words and pairs within texts, N is the number of all words.
Every distinct word and pair is counted, in the same way at any size of the corpus.

Texts are dealt to blocks of about ``BLOCK_BYTES`` by a hash of the row. A block asks for the counts of
its distinct words and pairs, each known by 64 bits of hash. Hashes are cut into as many ranges as there are
blocks, and what a block asks of a range is one row: its hashes in order and how often the block
holds each. A range meets the questions of all blocks, adds them up and answers each with the counts in the order
of the question; a block then scores its texts by the answers. So no block, range or row outgrows a fixed size
as the corpus grows, a word or pair comes at most once from each block however frequent it is, and
what is exchanged grows with the words of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fareflow.llm.columns import only
from fareflow.llm.words import Words, mix2, row_slices

MIN_COUNT = 2
BACKOFF = math.log(0.4)
#: Text in a block, unless one text has more, and the fewest blocks.
BLOCK_BYTES, FEWEST_BLOCKS = 8 << 20, 32


def _packed(numbers: np.ndarray) -> bytes:
    """64-bit numbers as all their first bytes, all their second bytes and so on, which compress well."""
    return numbers.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view(np.uint64).ravel() for x in column.to_pylist()]


def _names(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and then of all pairs, and the place of each pair's second word."""
    word = words.hashes(1)
    inner = np.ones(len(word), bool)
    inner[words.first[:-1][np.diff(words.first) > 0]] = False
    second = np.flatnonzero(inner)
    return np.concatenate([word, mix2(word[second - 1], word[second], 2)]), second


def _size(rows: DataFrame) -> tuple[int, int]:
    """Bytes and words of all texts."""
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = count = 0
        for batch in batches:
            for a, b in row_slices(batch.column("text")):
                words = Words.of(batch.column("text").slice(a, b - a))
                size, count = size + len(words.data), count + len(words.start)
        yield pa.RecordBatch.from_arrays([pa.array([size]), pa.array([count])], ["size", "words"])

    found = rows.select("text").mapInArrow(sizes, "size long, words long").agg(F.sum("size"), F.sum("words")).first()
    return found[0] or 0, found[1] or 0


def score(docs: DataFrame, vocabulary_size: int | None = None, frequent: int | None = None, sample_docs: int | None = None, *,
          block_bytes: int = BLOCK_BYTES, fewest_blocks: int = FEWEST_BLOCKS) -> DataFrame:
    """(doc_id, n_words, n_backoff, log_score) of every row.

    ``n_backoff`` counts words scored by their own frequency, the first word not included. Null and
    empty texts have no words and the score 0. Equal rows are counted as texts of their own, and are in one block.
    Words were once looked up in tables of the sizes ``vocabulary_size`` and ``frequent``, the latter drawn
    from ``sample_docs`` texts; there are no such tables any more, and these arguments have no effect.
    """
    rows = only(docs, "doc_id", "text")
    size, total = _size(rows)
    n = max(fewest_blocks, -(-size // block_bytes))
    log_n = math.log(max(total, 1))
    own = F.xxhash64(F.coalesce("text", F.lit("")), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    blocks = rows.withColumn("_block", F.pmod(own, F.lit(n)).cast("int")).repartition(n, "_block")

    def ask(texts: pa.Table) -> pa.Table:
        name, count = np.unique(_names(Words.of(texts["text"]))[0], return_counts=True)
        reach = ((name >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)  # ascending, as the names are
        part, first = np.unique(reach, return_index=True)
        cuts = [*zip(first.tolist(), [*first[1:].tolist(), len(name)])]
        return pa.table({
            "_block": pa.array([texts["_block"][0].as_py()] * len(part), pa.int32()), "_range": pa.array(part, pa.int32()),
            "names": pa.array([_packed(np.diff(name[a:b], prepend=np.uint64(0))) for a, b in cuts], pa.binary()),
            "counts": pa.array([_packed(count[a:b]) for a, b in cuts], pa.binary())})

    def answer(asked: pa.Table) -> pa.Table:
        names = [np.cumsum(x, dtype=np.uint64) for x in _unpacked(asked["names"])]
        _, place = np.unique(np.concatenate(names), return_inverse=True)
        added = np.bincount(place, np.concatenate(_unpacked(asked["counts"]))).astype(np.int64)[place]
        parts = np.split(added, np.cumsum([len(x) for x in names])[:-1])
        return pa.table({"_block": asked["_block"], "_range": asked["_range"], "counts": pa.array([_packed(x) for x in parts], pa.binary())})

    def scored(texts: pa.Table, answers: pa.Table) -> pa.Table:
        words = Words.of(texts["text"])
        names, second = _names(words)
        name, place = np.unique(names, return_inverse=True)
        count = np.concatenate([np.zeros(0, np.uint64), *_unpacked(answers.sort_by("_range")["counts"])])
        if len(count) != len(name):
            raise ValueError("a block was read with other texts than before")
        f = count[place].astype(np.float64)
        word, pair, text = f[:len(words.start)], f[len(words.start):], words.text_of_word()
        value = np.log(word) - log_n
        often = pair >= MIN_COUNT
        value[second] = np.where(often, np.log(pair) - np.log(word[second - 1]), BACKOFF + value[second])
        return pa.table({
            "doc_id": texts["doc_id"], "n_words": np.diff(words.first).astype(np.int64),
            "n_backoff": np.bincount(text[second], ~often, minlength=len(texts)).astype(np.int64),
            "log_score": np.bincount(text, value, minlength=len(texts)).astype(np.float64)})

    asked = blocks.groupBy("_block").applyInArrow(ask, "_block int, _range int, names binary, counts binary")
    answers = asked.repartition(n, "_range").groupBy("_range").applyInArrow(answer, "_block int, _range int, counts binary")
    return blocks.groupBy("_block").cogroup(answers.repartition(n, "_block").groupBy("_block")).applyInArrow(
        scored, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_backoff long, log_score double")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_backoff and log_score to four decimals."""
    return score(docs).withColumn("log_score", F.round("log_score", 4))
