"""Copied bytes against a direct look at all windows."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from fareflow.llm import suffix_radix as sx

W = sx.WINDOW


def naive(rows):
    texts = [(t or "").encode() for _, t in rows]
    first = {}
    for (d, _), t in zip(rows, texts):
        if d is not None:
            for i in range(len(t) - W + 1):
                first[t[i:i + W]] = min(d, first.get(t[i:i + W], d))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - W + 1):
            if d is not None and first[t[i:i + W]] < d:
                gone[i:i + W] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(t) else 0
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in sx.report(df).collect()), key=repr)


def sample():
    rng = np.random.default_rng(3)
    text = lambda n, kinds=26: "".join(map(chr, rng.integers(97, 97 + kinds, n)))
    shared, other = text(300), text(51)
    near = lambda: "".join(c if rng.random() > .02 else "#" for c in shared)
    rows = [(5, shared), (1, text(80) + shared[20:200] + text(9)), (9, shared + shared), (2, other), (3, "x" + other + "y"), (4, other[:49]),
            (6, other[:50]), (7, None), (8, ""), (None, shared), (10, "é" * 60), (11, "ü" + "é" * 40), (12, "a" * 200), (13, "a" * 90 + "b"),
            (14, "ab" * 70), (15, "ba" * 70), (16, text(2000, 2)), (17, text(2000, 2)), (20, shared), (20, shared), (20, "z" + shared[:80])]
    return rows + [(30 + i, near() + text(20)) for i in range(12)] + [(60 + i, rows[16][1][i * 37:i * 37 + 400] + near()) for i in range(8)]


def test_copied_bytes(spark):
    rows = sample()
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, _id string, runs int").repartition(5)
    assert got(docs) == naive(rows)
    cut = sx.cut_copies(docs)
    assert cut.columns == [*docs.columns, "_n_bytes", "_n_removed", "_n_spans", "_kept"] and cut.count() == len(rows)
    assert got(docs.limit(0)) == []


@pytest.mark.parametrize("part", [64, 200, 1000])
def test_long_texts_in_parts_and_small_slices(spark, monkeypatch, part):
    """Runs end at the parts' edges, and records are compared in many small slices; nothing else changes."""
    rows = sample()
    texts = pa.array([t for _, t in rows], pa.string())
    monkeypatch.setattr(sx, "PART_BYTES", part)
    whole = {}
    for a, b, data, offsets in sx._slices(texts):
        for records in sx._parts(data, offsets):
            for begin, count, row in zip(records.begin, records.count, records.row):
                whole.setdefault(a + row, []).extend(range(records.base + begin, records.base + begin + count))
    for i, (_, t) in enumerate(rows):
        size, at = len((t or "").encode()), whole.get(i, [])
        base = 0 if len(at) == 0 or at[0] == 0 else at[0]
        assert [x - base for x in at] == list(range(max(0, size - W + 1)))


def test_equal_windows_share_their_digits():
    rng = np.random.default_rng(0)
    for kinds in (2, 3, 26):
        data = rng.integers(97, 97 + kinds, 3000).astype(np.uint8)
        data[1500:2100] = data[200:800]
        records = sx._Records(data, np.array([0, 1400, 3000]), 0)
        assert (records.gram >= records.begin + records.count - 1).all() and (records.gram - records.begin <= W - sx.GRAM).all()
        cores = records.cores(np.arange(len(records.begin)))
        for r in (records, cores):
            names = {}
            for begin, count, name in zip(r.begin, r.count, r.name):
                for i in range(begin, begin + count):
                    assert names.setdefault(data[i:i + W].tobytes(), name) == name
            covered = np.concatenate([np.arange(b, b + c) for b, c in zip(r.begin, r.count)])
            assert sorted(covered) == [*range(1400 - W + 1), *range(1400, 3000 - W + 1)]


def test_records_that_cross_batches():
    """However the sorted records are cut into batches, copies and open records are the same."""
    rng = np.random.default_rng(1)
    rows = sorted((int(n), int(c) * 2, int(d)) for n, c, d in rng.integers(0, 6, (60, 3)))
    batch = pa.table({k: pa.array([r[i] for r in rows], pa.int64()) for i, k in enumerate(("name", "check", "_id"))}).to_batches()[0]

    def result(sizes):
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        out = sx._compare(iter([batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]))
        return {tuple(r.values()) for b in out for r in b.to_pylist()}
    want = result([60])
    kinds = {(n, c): min(d for m, e, d in rows if (m, e) == (n, c)) for n, c, _ in rows}
    whole = lambda n, c: int(sx.joined(np.array([n]), np.array([c >> 1])).view(np.int64)[0])
    assert {r for r in want if r[2]} == {(d, whole(n, c), True) for n, c, d in rows if d > kinds[n, c]}
    assert {r for r in want if not r[2]} == {(d, whole(n, c), False) for (n, c), d in kinds.items() if sum(m == n for m, _ in kinds) > 1}
    for sizes in ([1] * 60, [7] * 8 + [4], [0, 30, 0, 30]):
        assert result(sizes) == want
