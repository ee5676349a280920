"""Adaptive context-mixing range coder for token ids below 65,536, over many blocks in step.

Each block is coded by itself from a fresh model. Two tables remember the id that last followed the
last two ids (order 2) and the last id (order 1). A first flag says whether the id is the order-2
prediction (the order-1 prediction where there is none); its probability mixes what the confidences
of both orders have told so far, in the logistic domain, with weights that learn. A second flag
does the same for the order-1 prediction. What is left is coded by order 0: the two halves of the
high byte by adaptive counts, then the low byte. All arithmetic is on integers, so any machine decodes the same.
"""

from __future__ import annotations

import numpy as np

BLOCK_IDS = 4096
#: Blocks in step; about 50 MB of tables.
LANES = 2048

_SLOTS = 1 << 10, 1 << 12  # of the tables
_FACTORS, _SHIFTS, _MASKS = np.array([[40503], [31337]]), np.array([[4], [3]]), np.array(_SLOTS)[:, None] - 1
_BITS = 61
_FLOOR, _LEAST = 1 << _BITS - 16, 1 << 40  # a literal narrows by 38 bits at most
_RATE, _LEARN = 4, 10

# Logistic tables on integers: probabilities of 12 bits, logits in 1/256.
_p = (np.arange(4096) + 0.5) / 4096
_STRETCH = np.round(256 * np.log(_p / (1 - _p))).astype(np.int64)
_SQUASH = np.clip(np.round(65536 / (1 + np.exp(-np.arange(-2048, 2048) / 256))), 32, 65504).astype(np.int64)
#: Where a probability moves to after a miss and a hit; it stays within 32 and 65504.
_TARGET = np.array([47, 65504])
_ALL = np.array([0, 65535])
#: Twice the confidence after an id, by twice the one before if the id is the remembered one; else that of 1.
_SURER = np.array([min(c + 2, 32) if c <= 32 else 2 for c in range(65)], np.int32)
#: Counts above this one are halved, so that 16 of them add up to 16 bits.
_MOST = 4094
_ONES = np.arange(17, dtype=np.uint16)
_ROW = np.dtype("V34")
_CELLS = np.arange(0, 17 * 2 * LANES, 17)
_STEP = np.array([[32 * (i > v) for i in range(17)] for v in range(16)], np.uint16).reshape(-1).view(_ROW)


class _Model:
    """What all lanes have learned so far; lanes leave from the end.

    Pairs of rows belong to order 1 and order 2. Tables are flat, one stretch for each lane.
    """

    def __init__(self, n: int):
        self.lanes, self.ids = n, np.zeros(n * sum(_SLOTS), np.int32)  # id << 6 | twice the confidence
        self.hits, self.alone = np.full(n * 68, 32768), np.full(n * 34, 32768)
        # Running counts of high halves and, by high half, of low halves: 17 numbers, moved as one.
        self.ends = np.tile(np.arange(0, 68, 4, dtype=np.uint16), n * 17).view(_ROW)
        self.weights = np.full((2, n), 32768)
        self.last, self.before = np.zeros(n, np.int64), np.zeros(n, np.int64)  # before: already multiplied
        self.keep(n)

    def keep(self, n: int) -> None:
        self.weights, self.last, self.before, rows = np.ascontiguousarray(self.weights[:, :n]), self.last[:n], self.before[:n], np.arange(n)
        self.id_base = np.stack([rows * _SLOTS[0], rows * _SLOTS[1] + self.lanes * _SLOTS[0]])
        self.hit_base, self.row_base, self.alone_base = np.stack([rows * 68, rows * 68 + 34]), rows * 17, rows * 34

    def predict(self) -> None:
        at = self.last * _FACTORS
        before, self.before = self.before, at[0].copy()
        at[1] += before
        at >>= _SHIFTS
        at &= _MASKS
        at += self.id_base
        self.at, self.known = at, self.ids.take(at)
        guess = self.known >> 6
        self.second_guess = guess[0]
        self.first_guess = np.where(self.known[1] > 0, guess[1], guess[0])
        self.same = self.first_guess == guess[0]
        self.slot = (self.known & 63) + self.hit_base
        self.slot[0] += self.same
        self.seen = self.hits.take(self.slot)
        self.told = _STRETCH.take(self.seen >> 4)
        dot = self.weights * self.told
        self.p = _SQUASH.take((dot[0] + dot[1] >> 16) + 2048, mode="clip")

    def learn_flag(self, hit: np.ndarray) -> None:
        self.weights += self.told * (_ALL.take(hit) - self.p) >> _LEARN + 6
        self.hits[self.slot] = _moved(self.seen, hit)

    def learn_id(self, ids: np.ndarray) -> None:
        entry = ids << 6
        self.ids[self.at] = _SURER.take(self.known ^ entry, mode="clip") | entry
        self.last = ids.astype(np.int64)


def _moved(p: np.ndarray, hit: np.ndarray) -> np.ndarray:
    return p + (_TARGET.take(hit) - p >> _RATE)


class _Coder:
    """Widths of the lanes' intervals, of ``_BITS`` bits; a word is settled once its interval is below ``_FLOOR``."""

    def __init__(self, n: int):
        self.lanes, self.width, self.size = n, np.full(n, 1 << _BITS), np.zeros(n, np.int64)

    def keep(self, n: int) -> None:
        self.width = self.width[:n]

    def settle(self, limit: int = _FLOOR) -> None:
        """Moves words out of intervals below ``limit``. Lanes do so by their own width alone, as a reader has others beside them."""
        rows = (self.width < limit).nonzero()[0]
        while len(rows):
            self.shift(rows)
            width = self.width.take(rows) << 16
            self.width[rows] = width
            if width.min() >= _FLOOR:
                return
            rows = rows[width < _FLOOR]

    def shift(self, rows: np.ndarray) -> None:
        raise NotImplementedError

    def symbol(self, ends: np.ndarray, at: np.ndarray, value: np.ndarray | None, width: np.ndarray | None = None, place: np.ndarray | None = None):
        """A half, its start, its count and the total by the running counts at rows ``at``.

        Without a value, it is that at ``place`` of ``width``, and instead of the total comes the width of one count.
        """
        rows = ends.take(at)
        flat = rows.view(np.uint16)
        table = flat.reshape(-1, 17)
        part = table[:, 16].astype(np.int64)
        if value is None:
            part = width // part
            below = table[:, 1:] <= np.minimum(place // part, 65535).astype(np.uint16)[:, None]
            ones = np.bitwise_count(below.view(np.uint64))
            value = np.minimum(ones[:, 0] + ones[:, 1], 15).astype(np.int64)
        cell = _CELLS[:len(at)] + value
        start = flat.take(cell).astype(np.int64)
        count = flat.take(cell + 1) - start
        flat += _STEP.take(value).view(np.uint16)
        if count.max() > _MOST - 32:
            full = (count > _MOST - 32).nonzero()[0]
            table[full] = table[full] + _ONES >> 1  # halves all counts; none gets below 1
        ends[at] = rows
        return value, start, count, part

class _Writer(_Coder):
    """Words are put down with their carries, which ``finish`` adds up."""

    def __init__(self, n: int, ids: int):
        super().__init__(n)
        self.low, self.final = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.room = 4 * ids + 8
        self.out = np.zeros(self.room * n, np.int32)

    def keep(self, n: int) -> None:
        super().keep(n)
        self.final[n:len(self.low)], self.low = self.low[n:], self.low[:n]

    def shift(self, rows: np.ndarray) -> None:
        size, low = self.size.take(rows), self.low.take(rows)
        self.out[rows * self.room + size] = low >> _BITS - 16
        self.size[rows] = size + 1
        self.low[rows] = (low & _FLOOR - 1) << 16

    def bit(self, p: np.ndarray, bit: np.ndarray) -> np.ndarray:
        bound = (self.width >> 16) * p
        self.low = self.low + np.where(bit, 0, bound)
        self.width = np.where(bit, bound, self.width - bound)
        return bit

    def some_bit(self, rows: np.ndarray, p: np.ndarray, bit: np.ndarray) -> np.ndarray:
        width = self.width.take(rows)
        bound = (width >> 16) * p
        self.low[rows] = self.low.take(rows) + np.where(bit, 0, bound)
        self.width[rows] = np.where(bit, bound, width - bound)
        return bit

    def literal(self, rows: np.ndarray, model: _Model, ids: np.ndarray) -> np.ndarray:
        n, width, base, high = len(rows), self.width.take(rows), model.row_base.take(rows), ids >> 12
        _, start, count, total = self.symbol(model.ends, np.concatenate([base, base + high + 1]), np.concatenate([high, ids >> 8 & 15]))
        low = self.low.take(rows)
        for half in (slice(n), slice(n, None)):
            width //= total[half]
            low += width * start[half]
            width *= count[half]
        width >>= 8
        self.low[rows] = low + width * (ids & 255)
        self.width[rows] = width
        return ids

    def finish(self) -> list[bytes]:
        self.keep(0)
        rows = np.arange(self.lanes)
        self.out[rows * self.room + self.size] = self.final + _FLOOR - 1 >> _BITS - 16  # the rest of the word and all after it may be zero
        self.size += 1
        words = np.ascontiguousarray(self.out.reshape(-1, self.room)[:, :int(self.size.max(initial=0))].T)
        for k in range(len(words) - 1, 0, -1):
            words[k - 1] += words[k] >> 16
        data = np.ascontiguousarray(words.T).astype(">u2")
        return [data[i, :n].tobytes() for i, n in enumerate(self.size.tolist())]


class _Reader(_Coder):
    """``code``: how far the read words are above the interval's low end."""

    def __init__(self, payloads: list[bytes]):
        n = len(payloads)
        super().__init__(n)
        words = np.zeros((n, max((len(x) for x in payloads), default=0) // 2 + 8), np.uint32)
        for i, x in enumerate(payloads):
            words[i, :len(x) // 2] = np.frombuffer(x, ">u2")
        short = 64 - _BITS  # bits that the fourth word has more than the interval
        self.code = np.zeros(n, np.int64)
        for k in range(4):
            self.code = self.code << (16 if k < 3 else 16 - short) | words[:, k] >> (0 if k < 3 else short)
        self.data = (words[:, 3:-1] << 16 | words[:, 4:]) >> short & 0xFFFF
        self.data, self.room = self.data.astype(np.uint16).reshape(-1), self.data.shape[1]

    def keep(self, n: int) -> None:
        super().keep(n)
        self.code = self.code[:n]

    def shift(self, rows: np.ndarray) -> None:
        size = self.size.take(rows)
        self.code[rows] = self.code.take(rows) << 16 | self.data.take(rows * self.room + size, mode="clip")
        self.size[rows] = size + 1

    def bit(self, p: np.ndarray, _: np.ndarray | None) -> np.ndarray:
        bound = (self.width >> 16) * p
        bit = self.code < bound
        self.code = np.where(bit, self.code, self.code - bound)
        self.width = np.where(bit, bound, self.width - bound)
        return bit

    def some_bit(self, rows: np.ndarray, p: np.ndarray, _: np.ndarray | None) -> np.ndarray:
        width, code = self.width.take(rows), self.code.take(rows)
        bound = (width >> 16) * p
        bit = code < bound
        self.code[rows] = np.where(bit, code, code - bound)
        self.width[rows] = np.where(bit, bound, width - bound)
        return bit

    def literal(self, rows: np.ndarray, model: _Model, _: np.ndarray | None) -> np.ndarray:
        width, code, at, ids = self.width.take(rows), self.code.take(rows), model.row_base.take(rows), 0
        for _ in range(2):
            half, start, count, part = self.symbol(model.ends, at, None, width, code)
            code -= part * start
            width = part * count
            at, ids = at + half + 1, ids << 4 | half
        width >>= 8
        last = np.minimum(code // width, 255)
        self.code[rows] = code - last * width
        self.width[rows] = width
        return ids << 8 | last


def _run(coder: _Writer | _Reader, sizes: np.ndarray, ids: np.ndarray) -> None:
    """One id of each lane after the other; ``ids`` (position, lane) is read by a writer, filled by a reader."""
    writing, model = isinstance(coder, _Writer), _Model(len(sizes))
    active = np.searchsorted(-sizes, -np.arange(1, (int(sizes[0]) if len(sizes) else 0) + 1), "right")
    lanes = len(sizes)
    for t, n in enumerate(active.tolist()):
        if n < lanes:
            lanes = n
            model.keep(n)
            coder.keep(n)
        model.predict()
        now = ids[t, :n].astype(np.int32) if writing else None
        hit = coder.bit(model.p, now == model.first_guess if writing else None)
        model.learn_flag(hit)
        if not writing:
            now = model.first_guess.copy()
        rest = ~hit
        asked = (rest > model.same).nonzero()[0]
        if len(asked):
            known, slot = model.known[0].take(asked), model.alone_base.take(asked)
            guess, slot = known >> 6, slot + (known & 63)
            p = model.alone.take(slot)
            hit = coder.some_bit(asked, p, now.take(asked) == guess if writing else None)
            model.alone[slot] = _moved(p, hit)
            found = asked[hit]
            rest[found] = False
            if not writing:
                now[found] = guess[hit]
        coder.settle(_LEAST)
        rest = rest.nonzero()[0]
        if len(rest):
            known = coder.literal(rest, model, now.take(rest).astype(np.int64) if writing else None)
            if not writing:
                now[rest] = known
        coder.settle()
        if not writing:
            ids[t, :n] = now
        model.learn_id(now)


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """The code of each block of ids; an empty block has an empty code."""
    out = [b""] * len(blocks)
    order = sorted((i for i in range(len(blocks)) if len(blocks[i])), key=lambda i: -len(blocks[i]))
    for k in range(0, len(order), LANES):
        some = order[k:k + LANES]
        sizes = np.array([len(blocks[i]) for i in some])
        ids = np.zeros((len(some), int(sizes[0])), np.uint16)
        for row, i in enumerate(some):
            ids[row, :len(blocks[i])] = blocks[i]
        coder = _Writer(len(some), int(sizes[0]))
        _run(coder, sizes, np.ascontiguousarray(ids.T))
        for i, code in zip(some, coder.finish()):
            out[i] = code
    return out


def decode(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each block from its code and length."""
    out = [np.zeros(0, np.uint16)] * len(payloads)
    order = sorted((i for i in range(len(payloads)) if sizes[i]), key=lambda i: -sizes[i])
    for k in range(0, len(order), LANES):
        some = order[k:k + LANES]
        lengths = np.array([sizes[i] for i in some])
        ids = np.zeros((int(lengths[0]), len(some)), np.uint16)
        _run(_Reader([payloads[i] for i in some]), lengths, ids)
        ids = np.ascontiguousarray(ids.T)
        for row, i in enumerate(some):
            out[i] = ids[row, :sizes[i]]
    return out
