"""Language identification of whole texts and of the spans of mixed ones.

A word is a run of letters; its score in a language is the sum of the log-probabilities of its
n-grams of bytes, with a space on either side. The scripts of its letters narrow the languages it
may belong to. Viterbi over a text's words, with a penalty for each switch, labels the spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from fareflow.llm.columns import only
from fareflow.llm.words import LOWER, Words, mix, row_slices

#: About as many labelled texts, drawn by a hash of the id, fit the model; each is read whole. Languages
#: get equal parts of it, and one with fewer texts keeps all of them and leaves the rest to the others.
SAMPLE_DOCS = 20_000
SHARES = 1_000_000_000_000
ORDERS = (2, 3, 4)
BUCKETS = 1 << 15
SMOOTHING = 0.5
#: What a change of language costs, in nats.
SWITCH = 12.0
#: A script belongs to a language if it has at least this share of its letters.
SCRIPT_SHARE = 0.001
#: Words over which Viterbi runs at once, over many texts in step.
GROUP_WORDS = 4_000_000
UNKNOWN = "und"

# First and last code point of the main blocks of each script.
SCRIPTS = {
    "Latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "Devanagari": [(0x900, 0x97F)],
    "Bengali": [(0x980, 0x9FF)],
    "Gurmukhi": [(0xA00, 0xA7F)],
    "Gujarati": [(0xA80, 0xAFF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Telugu": [(0xC00, 0xC7F)],
    "Kannada": [(0xC80, 0xCFF)],
    "Malayalam": [(0xD00, 0xD7F)],
    "Thai": [(0xE00, 0xE7F)],
    "Tibetan": [(0xF00, 0xFFF)],
    "Georgian": [(0x10A0, 0x10FF)],
    "Hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "Ethiopic": [(0x1200, 0x137F)],
    "Khmer": [(0x1780, 0x17FF)],
    "Kana": [(0x3040, 0x30FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F)],
}

_b = np.arange(256)
_WORD = ((_b >= 0x41) & (_b <= 0x5A)) | ((_b >= 0x61) & (_b <= 0x7A)) | (_b >= 0x80)


@lru_cache(1)
def _script_bits() -> np.ndarray:
    """For each code point the bit of its script; the last bit for letters of other scripts, 0 for no letter."""
    bits = np.full(0x110000, 1 << len(SCRIPTS), np.int32)
    for k, ranges in enumerate(SCRIPTS.values()):
        for first, last in ranges:
            bits[first:last + 1] = 1 << k
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(letter, bits, 0)


@dataclass
class Letters:
    """Words of many texts with what scoring needs."""
    words: Words
    buffer: np.ndarray  # lower-cased words, each after one space; a space and padding at the end
    place: np.ndarray   # of each word's space in the buffer; one more entry at the end
    scripts: np.ndarray
    letters: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Letters:
        words = Words.of(column, _WORD)
        length = words.end - words.start
        place = np.concatenate([[0], np.cumsum(length + 1)])
        inside = np.zeros(len(words.data) + 1, np.int8)
        inside[words.start] += 1
        inside[words.end] -= 1
        taken = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8)) if len(words.data) else np.zeros(0, np.int64)
        # Words that touch at a text's end have no gap between them; runs of bytes are still in order.
        buffer = np.full(int(place[-1]) + 1 + 8, 0x20, np.uint8)
        raw = np.ones(int(place[-1]), bool)
        raw[place[:-1]] = False
        original = words.data[taken] if len(taken) == int(length.sum()) else np.concatenate(
            [words.data[a:b] for a, b in zip(words.start, words.end)] or [words.data[:0]])
        buffer[:int(place[-1])][raw] = LOWER[original]
        scripts, letters = cls._scripts(buffer[:int(place[-1])], place)
        return cls(words, buffer, place, scripts, letters)

    @staticmethod
    def _scripts(b: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bits = np.where((b >= 0x61) & (b <= 0x7A), 1, 0).astype(np.int32)
        lead = np.flatnonzero(b >= 0xC0)
        if len(lead):
            p = np.concatenate([b, np.zeros(3, np.uint8)]).astype(np.int32)
            c = p[lead]
            two = (c & 0x1F) << 6 | p[lead + 1] & 0x3F
            three = (c & 0x0F) << 12 | (p[lead + 1] & 0x3F) << 6 | p[lead + 2] & 0x3F
            four = (c & 0x07) << 18 | (p[lead + 1] & 0x3F) << 12 | (p[lead + 2] & 0x3F) << 6 | p[lead + 3] & 0x3F
            bits[lead] = _script_bits()[np.where(c < 0xE0, two, np.where(c < 0xF0, three, np.minimum(four, 0x10FFFF)))]
        if len(place) < 2:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.bitwise_or.reduceat(bits, place[:-1]), np.add.reduceat(bits != 0, place[:-1], dtype=np.int64)

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(bucket of each n-gram, first n-gram of each word) for each order. Every word has one of order 3 at least."""
        view = np.ndarray((len(self.buffer) - 7,), np.dtype("<u8"), np.ascontiguousarray(self.buffer).data, 0, (1,))
        size = np.diff(self.place) + 1  # with the spaces on both sides
        for n in ORDERS:
            count = np.maximum(size - n + 1, 1)  # a shorter word has one gram, up to the next word's start
            first = np.concatenate([[0], np.cumsum(count)])
            at = np.arange(first[-1]) + np.repeat(self.place[:-1] - first[:-1], count)
            yield (mix(view[at] & np.uint64((1 << 8 * n) - 1), n) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), first


@dataclass
class Model:
    languages: list[str]
    tables: list[np.ndarray]  # for each order, log-probabilities by bucket and language
    allowed: np.ndarray       # for each language, the bits of its scripts

    def scores(self, x: Letters) -> np.ndarray:
        out = np.zeros((len(x.letters), len(self.languages)), np.float32)
        if not len(out):
            return out
        for table, (bucket, first) in zip(self.tables, x.grams()):
            out += np.add.reduceat(table[bucket], first[:-1], axis=0)
        out[x.letters == 0] = 0
        fits = (x.scripts[:, None] & self.allowed[None, :]) != 0
        narrow = fits.any(axis=1)[:, None] & ~fits
        out = np.where(fits.any(axis=1)[:, None], out, 0)
        return np.where(narrow, np.float32(-1e4), out)


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word; texts go in step, the longest first. Ties take the earlier language and stay."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    start, size = first[:-1][order], size[order]
    active = np.searchsorted(-size, -np.arange(1, (int(size[0]) if len(size) else 0) + 1), "right")
    label = np.zeros(len(scores), np.int16)
    came, stay = np.zeros(len(scores), np.int16), np.ones(scores.shape, bool)
    value = scores[start[:active[0]]] if len(active) else None
    ends = np.zeros(len(size), np.int64)
    for t, n in enumerate(active):
        if t:
            done = value[n:]
            ends[n:len(value)] = done.argmax(axis=1)
            value = value[:n]
            at = start[:n] + t
            came[at] = best = value.argmax(axis=1)
            jump = value[np.arange(n), best] - np.float32(switch)
            stay[at] = keep = value >= jump[:, None]
            value = np.where(keep, value, jump[:, None]) + scores[at]
    if len(active):
        ends[:len(value)] = value.argmax(axis=1)
    state = ends
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at, s = start[:n] + t, state[:n]
        label[at] = s
        state[:n] = np.where(stay[at, s], s, came[at])
    return label


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of one task by language: n-grams by order and bucket, then letters by script."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for a, b in row_slices(batch.column("text")):
            x = Letters.of(batch.column("text").slice(a, b - a))
            langs = batch.column("lang").slice(a, b - a).to_pylist()
            if not len(x.letters):
                continue
            names = {c: k for k, c in enumerate(sorted(set(langs)))}
            of_word = np.array([names[c] for c in langs])[x.words.text_of_word()]
            used = x.letters > 0
            for name, k in names.items():
                sums = counts.setdefault(name, np.zeros(len(ORDERS) * BUCKETS + len(SCRIPTS) + 1, np.int64))
                own = used & (of_word == k)
                for i, (bucket, first) in enumerate(x.grams()):
                    sums[i * BUCKETS:(i + 1) * BUCKETS] += np.bincount(bucket[np.repeat(own, np.diff(first))], minlength=BUCKETS)
                for s in range(len(SCRIPTS) + 1):
                    sums[len(ORDERS) * BUCKETS + s] += int(x.letters[own & (x.scripts >> s & 1 == 1)].sum())
    for name, sums in counts.items():
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(sums[at])], ["lang", "slot", "n"])


def shares(counts: dict[str, int], sample_docs: int) -> dict[str, float]:
    """The share of its texts that each language gives, from its number of texts."""
    level, left = float("inf"), sample_docs
    for i, n in enumerate(sorted(counts.values())):
        if n * (len(counts) - i) > left:
            level = left / (len(counts) - i)
            break
        left -= n
    return {c: min(1.0, level / n) for c, n in counts.items()}


def draw(rows: DataFrame, share: dict[str, float]) -> DataFrame:
    """The rows (doc_id, text, lang) whose hash is below the share of their language."""
    part = [x for c, s in share.items() if s < 1 for x in (F.lit(c), F.lit(int(s * SHARES)))]
    if not part:
        return rows
    # Rows without an id are told apart by their texts.
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample"), F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(SHARES))
    return rows.where(place < F.coalesce(F.create_map(*part)[F.col("lang")], F.lit(SHARES)))


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """The model of the labelled rows (text, lang, doc_id); rows with a null among text and lang teach nothing.

    The driver receives one table of ``len(ORDERS) * BUCKETS`` numbers for each language.
    """
    rows = only(labelled, "doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.withColumn("lang", F.col("lang").cast("string"))
    share = shares({r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}, sample_docs)
    counted = draw(rows, share).select("lang", "text").mapInArrow(_count, "lang string, slot long, n long")
    table = counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    names, sums = sorted(set(table["lang"].to_pylist())), {}
    for name in names:
        sums[name] = np.zeros(len(ORDERS) * BUCKETS + len(SCRIPTS) + 1)
    which = np.array(table["lang"].to_pylist(), object)
    for name in names:
        own = which == name
        sums[name][table["slot"].to_numpy()[own]] = table["n"].to_numpy()[own]
    names.sort(key=lambda c: (-sums[c][:BUCKETS].sum() / share[c], c))  # what is tied goes to the commonest language
    tables, allowed = [], np.zeros(len(names), np.int32)
    for i in range(len(ORDERS)):
        c = np.array([sums[n][i * BUCKETS:(i + 1) * BUCKETS] for n in names]).reshape(len(names), BUCKETS).T
        p = np.log((c + SMOOTHING) / (c.sum(axis=0) + SMOOTHING * BUCKETS))
        tables.append(((p - p.max(axis=1, keepdims=True)) / len(ORDERS)).astype(np.float32) if names else p)
    for k, n in enumerate(names):
        letters = sums[n][len(ORDERS) * BUCKETS:]
        allowed[k] = sum(1 << s for s in np.flatnonzero(letters >= SCRIPT_SHARE * max(letters.sum(), 1)).tolist())
    return Model(names, tables, allowed)


def _labeller(shared: Broadcast):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            held: list[tuple[int, int, np.ndarray, Letters]] = []
            for a, b in row_slices(batch.column("text")):
                x = Letters.of(batch.column("text").slice(a, b - a))
                held.append((a, b, model.scores(x), x))
                if sum(len(h[2]) for h in held) >= GROUP_WORDS:
                    yield _labelled(batch, held, model)
                    held = []
            if held:
                yield _labelled(batch, held, model)
    return label


def _labelled(batch: pa.RecordBatch, held: list, model: Model) -> pa.RecordBatch:
    a, b = held[0][0], held[-1][1]
    first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x.words.first) for *_, x in held]))])
    letters = np.concatenate([x.letters for *_, x in held])
    text = np.repeat(np.arange(b - a), np.diff(first))
    k = max(1, len(model.languages))
    names, score, spans = [UNKNOWN] * (b - a), np.zeros(b - a), [[] for _ in range(b - a)]
    if model.languages:
        label = viterbi(np.concatenate([s for _, _, s, _ in held]), first)
        sums = np.bincount(text * k + label, letters, minlength=(b - a) * k).reshape(b - a, k)
        total = sums.sum(axis=1)
        best = sums.argmax(axis=1)
        names = [model.languages[i] if n else UNKNOWN for i, n in zip(best.tolist(), total.tolist())]
        score = np.where(total > 0, sums.max(axis=1) / np.maximum(total, 1), 0.0)
        change = np.flatnonzero(np.concatenate([[True], (label[1:] != label[:-1]) | (text[1:] != text[:-1])])) if len(label) else []
        count = np.diff(np.append(change, len(label)))
        for w, n in zip(np.asarray(change, np.int64).tolist(), count.tolist()):
            if total[text[w]]:
                spans[text[w]].append({"first_word": w - int(first[text[w]]), "n_words": n, "lang": model.languages[label[w]]})
    rest = batch.slice(a, b - a)
    kind = pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())]))
    return pa.RecordBatch.from_arrays(
        [*[rest.column(c) for c in rest.schema.names if c != "text"], pa.array(names, pa.string()), pa.array(score), pa.array(spans, kind)],
        [*[c for c in rest.schema.names if c != "text"], "lang_pred", "score", "spans"])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every row, from its text alone.

    ``lang_pred`` has most of the text's letters, ``score`` their share, and ``spans`` are runs of
    words of one language. Null texts and texts without a letter, and all texts if nothing was
    learned, are ``und`` with score 0 and no spans.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return only(docs, "doc_id", "text").mapInArrow(
        _labeller(shared), f"doc_id {kind}, lang_pred string, score double, spans array<struct<first_word:long,n_words:long,lang:string>>")


def fold(doc_id: Column) -> Column:
    """0, 1 or 2 by the id's checksum; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3, F.lit(-1))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and n_spans; the model learns from the rows that are not held out.

    A null doc_id is not held out.
    """
    rows = only(docs, "doc_id", "text", "lang")
    model = fit(rows.where(fold(F.col("doc_id")) != 1))
    return identify(rows, model).select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "lang_pred", "score",
                                        F.size("spans").cast("long").alias("n_spans"))
