"""Ranked search against a direct count, with items in one block and in many."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from fareflow.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def naive(docs, items, k=10):
    terms = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    n, total = sum(map(bool, terms)), sum(map(len, terms))
    tf = [Counter(t) for t in terms]
    out = []
    for item, text in items:
        query = set(TERM.findall((text or "").translate(LOWER)))
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in c for c in tf) + 1))) for t in query}
        scored = []
        for (d, _), words, c in zip(docs, terms, tf):
            m = 100 - 90 + (90 * len(words) * n) // max(total, 1)
            s = sum(w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, w in weight.items() if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def got(spark, docs, items):
    d = spark.createDataFrame([(*r, 1.0) for r in docs], "doc_id long, text string, score double").repartition(3)
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in lexical.report(d, b).collect()), key=repr)


@pytest.mark.parametrize("block, cells, candidates", [(1 << 20, 1 << 20, 1 << 17), (30, 16, 20)])
def test_ranks(spark, monkeypatch, block, cells, candidates):
    for name, value in (("BLOCK_BYTES", block), ("CELLS", cells), ("CANDIDATES", candidates)):
        monkeypatch.setattr(lexical, name, value)
    rng = np.random.default_rng(5)
    words = ["a", "ab", "abc", "Ünd", "日本", "x1", "1", "the", "THE", "of"] + [f"w{i}" for i in range(30)]
    text = lambda n: "".join(w + s for w, s in zip(rng.choice(words, n), rng.choice([" ", ", ", "\n", "_", "-"], n)))
    docs = [(i, text(int(rng.integers(1, 60)))) for i in range(60)] + [(70, None), (71, ""), (72, " ,;"), (None, "abc the w1"), (73, text(4000))]
    docs += [docs[3], docs[3], (90, docs[4][1]), (89, docs[4][1]), (91, "zz")]
    items = [(1, "The abc w1 w2, of"), (2, None), (3, ""), (4, "nowhere"), (5, "日本 Ünd ab"), (5, "w3"), (None, "1 x1"), (6, "zz"), (7, "the the THE")]
    items += [(10 + i, text(12)) for i in range(12)] + [items[0]]
    assert got(spark, docs, items) == naive(docs, items)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == [] and got(spark, [(1, "a")], []) == []
    docs = spark.createDataFrame([(1, "b a")], "doc_id long, text string")
    items = spark.createDataFrame([("q", "a", 2)], "_rank string, text string, _item int")
    found = lexical.search(docs, items)
    assert found.columns == ["_rank", "text", "_item", "_rank", "_doc_id", "_score"]
    (row,) = found.collect()
    assert tuple(row)[:5] == ("q", "a", 2, 1, 1)
