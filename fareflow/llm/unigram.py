"""Unigram encoding and decoding with the pieces of a SentencePiece model.

Text is cut before each run of whitespace markers and around line ends, where no piece can cross.
The best pieces of each distinct cut are found once in a while by Viterbi: a double-array trie over
the bytes of the pieces gives all matches, and many cuts go through the trie in step. Characters
without a piece become byte pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame

from fareflow.llm.columns import only, renamed, schema_of
from fareflow.llm.words import row_slices

MARK = "▁"
#: Fixed value of the format: an unknown character scores this much below the worst piece.
UNKNOWN_PENALTY = 10.0
#: Cuts whose pieces a worker remembers; beyond, it starts to remember anew.
MEMORY = 100_000
#: Longer cuts are encoded one by one.
LONG_BYTES = 128
STEP_CUTS = 16_384


@dataclass
class DoubleArray:
    """State t = base[s] + byte is a child of s if check[t] = s. ``piece`` is the id that ends at a state, or -1."""
    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray

    @classmethod
    def of(cls, pieces: dict[bytes, int]) -> DoubleArray:
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for text, k in pieces.items():
            node = 0
            for b in text:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                node = children[node][b]
            ends[node] = k
        size = 2 * len(children) + 1024
        base, check, piece = np.zeros(size, np.int64), np.full(size, -1), np.full(size, -1)
        used = np.zeros(size, bool)
        used[0] = True
        place = {0: 0}
        from_ = [1] * 257  # where to look for room for so many children
        queue = [0]
        for node in queue:
            s = place[node]
            piece[s] = ends.get(node, -1)
            keys = sorted(children[node])
            if not keys:
                continue
            at, found = max(from_[len(keys)], keys[0]), None
            while found is None:
                if at + 4096 + 256 > len(used):
                    grow = len(used)
                    base, check, piece = (np.concatenate([x, np.full(grow, v)]) for x, v in ((base, 0), (check, -1), (piece, -1)))
                    used = np.concatenate([used, np.zeros(grow, bool)])
                free = np.arange(at, at + 4096)
                for k in keys:
                    free = free[~used[free + (k - keys[0])]]
                found, at = (int(free[0]) if len(free) else None), at + 4096
            from_[len(keys)] = max(from_[len(keys)], found - 256) if len(keys) > 1 else found
            base[s] = found - keys[0]
            for k in keys:
                t = int(base[s]) + k
                used[t], check[t], place[children[node][k]] = True, s, t
                queue.append(children[node][k])
        end = int(np.flatnonzero(used)[-1]) + 257
        pad = max(0, end - len(used))
        return cls(*(np.concatenate([x, np.full(pad, v)])[:end].astype(np.int32) for x, v in ((base, 0), (check, -1), (piece, -1))))


@dataclass
class Pieces:
    """A model: the pieces by id, their scores, the ids of the byte pieces, and the trie of all others."""
    text: list[str]
    score: np.ndarray
    byte_ids: list[int]
    trie: DoubleArray

    @classmethod
    def load(cls, path: str, ranked: bool = False) -> Pieces:
        """``ranked``: the file's scores are negative merge ranks, as of a pair-merging model; a
        piece of rank r then has the log score -log(r + 1), as frequencies fall about with the rank.
        """
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        text = [model.id_to_piece(i) for i in ids]
        by_byte = {int(text[i][3:5], 16): i for i in ids if model.is_byte(i)}
        if len(by_byte) != 256:
            raise ValueError("the model has no byte pieces")
        plain = {text[i].encode(): i for i in ids
                 if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
        score = np.array([model.get_score(i) for i in ids])
        return cls(text, -np.log1p(np.maximum(-score, 0.0)) if ranked else score, [by_byte[b] for b in range(256)], DoubleArray.of(plain))

    @cached_property
    def unknown_score(self) -> float:
        return float(min(self.score[i] for i in self.trie.piece[self.trie.piece >= 0])) - UNKNOWN_PENALTY

    @cached_property
    def cuts(self) -> re.Pattern:
        """Cuts that no piece crosses; whole texts, if some piece has a marker or line end inside."""
        inside = [self.text[i] for i in self.trie.piece[self.trie.piece >= 0]]
        if any(re.search(f"[^{MARK}]{MARK}|\n.|.\n", p, re.S) for p in inside):
            return re.compile(r".+", re.S)
        return re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")

    def split(self, text: str) -> list[str]:
        return self.cuts.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode_one(self, cut: bytes) -> list[int]:
        """Viterbi over one cut. Of equal scores the longer last piece wins."""
        base, check, piece, score = self.trie.base, self.trie.check, self.trie.piece, self.score
        n = len(cut)
        best, start, used = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for p in range(n):
            if best[p] == -np.inf:
                continue
            width = 1 if cut[p] < 0xC0 else 2 if cut[p] < 0xE0 else 3 if cut[p] < 0xF0 else 4
            state, single, q = 0, False, p
            while q < n:
                t = int(base[state]) + cut[q]
                if check[t] != state:
                    break
                state, q = t, q + 1
                if piece[t] >= 0:
                    single |= q - p == width
                    value = best[p] + float(score[piece[t]])
                    if value > best[q]:
                        best[q], start[q], used[q] = value, p, int(piece[t])
            q = min(p + width, n)
            if not single and best[p] + self.unknown_score > best[q]:
                best[q], start[q], used[q] = best[p] + self.unknown_score, p, -1
        out, q = [], n
        while q:
            out += [used[q]] if used[q] >= 0 else [self.byte_ids[b] for b in reversed(cut[start[q]:q])]
            q = start[q]
        return out[::-1]

    def encode_many(self, cuts: list[bytes]) -> list[bytes]:
        """As ``encode_one`` for many cuts, position by position in step; ids as little-endian 32-bit numbers."""
        out = [b""] * len(cuts)
        short = [i for i, c in enumerate(cuts) if len(c) <= LONG_BYTES]
        for i in set(range(len(cuts))) - set(short):
            out[i] = np.array(self.encode_one(cuts[i]), "<i4").tobytes()
        short.sort(key=lambda i: len(cuts[i]))
        for k in range(0, len(short), STEP_CUTS):
            some = short[k:k + STEP_CUTS]
            for i, ids in zip(some, self._in_step([cuts[i] for i in some])):
                out[i] = ids
        return out

    def _in_step(self, cuts: list[bytes]) -> list[bytes]:
        base, check, piece, score = self.trie.base, self.trie.check, self.trie.piece, self.score
        size = np.array([len(c) for c in cuts])
        n, width = len(cuts), int(size.max())
        text = np.zeros((n, width), np.uint8)
        text[np.arange(width)[None, :] < size[:, None]] = np.frombuffer(b"".join(cuts), np.uint8)
        text = text.astype(np.int32)
        best = np.full((width + 1, n), -np.inf)
        start, used = np.zeros((width + 1, n), np.int16), np.full((width + 1, n), -1, np.int32)
        best[0] = 0.0
        for p in range(width):
            rows = np.flatnonzero((size > p) & (best[p] > -np.inf))
            if not len(rows):
                continue
            lead = text[rows, p]
            wide = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
            single = np.zeros(n, bool)
            live, state, q = rows, np.zeros(len(rows), np.int32), p
            length = np.zeros(n, np.int64)
            length[rows] = wide
            while len(live):
                t = base[state] + text[live, q]
                ok = check[t] == state
                live, state, q = live[ok], t[ok], q + 1
                ends = piece[state]
                hit = np.flatnonzero(ends >= 0)
                if len(hit):
                    at, ids = live[hit], ends[hit]
                    single[at] |= length[at] == q - p
                    value = best[p, at] + score[ids]
                    better = value > best[q, at]
                    at = at[better]
                    best[q, at], start[q, at], used[q, at] = value[better], p, ids[better]
                more = size[live] > q
                live, state = live[more], state[more]
            lone = rows[~single[rows]]
            to = np.minimum(p + length[lone], size[lone])
            value = best[p, lone] + self.unknown_score
            better = value > best[to, lone]
            lone, to = lone[better], to[better]
            best[to, lone], start[to, lone], used[to, lone] = value[better], p, -1
        # Walk back over all cuts at once; the ids of a cut come out last to first.
        at, rows, taken, owner = size.copy(), np.arange(n), [], []
        odd = set()
        while len(rows):
            ids, begin = used[at[rows], rows], start[at[rows], rows]
            odd.update(rows[ids < 0].tolist())
            taken.append(ids)
            owner.append(rows)
            at[rows] = begin
            rows = rows[begin > 0]
        taken, owner = np.concatenate(taken)[::-1], np.concatenate(owner)[::-1]
        order = np.argsort(owner, kind="stable")
        raw = taken[order].astype("<i4").tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=n))).tolist()
        out = [raw[a:b] for a, b in zip([0, *ends], ends)]
        for i in odd:
            out[i] = np.array(self.encode_one(cuts[i]), "<i4").tobytes()
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Pieces joined, byte pieces put together as UTF-8, markers as spaces without the first one."""
        raw = b"".join(map(self._bytes.__getitem__, ids.tolist()))
        text = raw.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    @cached_property
    def _bytes(self) -> list[bytes]:
        out = [p.replace(MARK, " ").encode() for p in self.text]
        for b, i in enumerate(self.byte_ids):
            out[i] = bytes([b])
        return out


class Encoder:
    """Encodes texts in a worker and remembers the pieces of cuts it has seen, within a bound."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.known = pieces, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        split = [self.pieces.split(t) for t in texts]
        fresh = list({c for cuts in split for c in cuts if c not in self.known})
        if len(self.known) + len(fresh) > MEMORY:
            self.known, fresh = {}, list({c for cuts in split for c in cuts})
        for c, ids in zip(fresh, self.pieces.encode_many([c.encode() for c in fresh])):
            self.known[c] = ids
        known = self.known
        return [b"".join([known[c] for c in cuts]) for cuts in split]


_encoders: dict[int, Encoder] = {}


def _encoder(shared: Broadcast) -> Encoder:
    pieces = shared.value
    if id(pieces) not in _encoders:
        _encoders.clear()
        _encoders[id(pieces)] = Encoder(pieces)
    return _encoders[id(pieces)]


def _slices(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    for a, b in row_slices(column, 2 << 20):
        yield a, ["" if t is None else t for t in column.slice(a, b - a).to_pylist()]


def encode(docs: DataFrame, pieces: Pieces, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with one more column, the piece ids of the text. Null and empty texts have none."""
    rows = renamed(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            for a, texts in _slices(batch.column(text)):
                found = encoder.encode(texts)
                flat = pa.array(np.frombuffer(b"".join(found), "<i4"))
                ends = pa.array(np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])]).astype(np.int32))
                yield batch.slice(a, len(texts)).append_column("_ids", pa.ListArray.from_arrays(ends, flat))

    return rows.mapInArrow(run, f"{schema_of(rows)}, _ids array<int>").toDF(*docs.columns, ids)


def decode(coded: DataFrame, pieces: Pieces, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``coded`` with one more column, the text of its piece ids; a null has the text of no pieces."""
    rows = renamed(coded, ids)
    shared = coded.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [model.decode(np.array(x.as_py() or [], np.int64)) for x in batch.column(ids)]
            yield batch.append_column("_text", pa.array(texts, pa.string()))

    return rows.mapInArrow(run, f"{schema_of(rows)}, _text string").toDF(*coded.columns, text)


def round_trip(docs: DataFrame, pieces: Pieces, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``decode(encode(docs))``, with one worker for a task instead of two."""
    rows = renamed(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, model = _encoder(shared), shared.value
        for batch in batches:
            for a, texts in _slices(batch.column(text)):
                found = encoder.encode(texts)
                flat = pa.array(np.frombuffer(b"".join(found), "<i4"))
                ends = pa.array(np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])]).astype(np.int32))
                back = pa.array([model.decode(np.frombuffer(f, "<i4")) for f in found], pa.string())
                yield (batch.slice(a, len(texts)).append_column("_ids", pa.ListArray.from_arrays(ends, flat))
                       .append_column("_text", back))

    return rows.mapInArrow(run, f"{schema_of(rows)}, _ids array<int>, _text string").toDF(*docs.columns, ids, decoded)


def report(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id, n_pieces, n_bytes (byte pieces), ids_crc32 and round_trip of every row of ``docs``.

    ``round_trip`` says whether the decoded ids are the text; it fails only where the text itself
    holds whitespace markers. Null is an empty text.
    """
    rows = only(docs, "doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, model = _encoder(shared), shared.value
        is_byte = np.zeros(len(model.text), bool)
        is_byte[model.byte_ids] = True
        for batch in batches:
            for a, texts in _slices(batch.column("text")):
                found = encoder.encode(texts)
                ids = [np.frombuffer(f, "<i4") for f in found]
                back = [model.decode(i) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, len(texts)), pa.array([len(i) for i in ids], pa.int64()),
                     pa.array([int(is_byte[i].sum()) for i in ids], pa.int64()), pa.array([zlib.crc32(f) for f in found], pa.int64()),
                     pa.array([b == t for b, t in zip(back, texts)])],
                    ["doc_id", "n_pieces", "n_bytes", "ids_crc32", "round_trip"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_pieces long, n_bytes long, ids_crc32 long, round_trip boolean")
