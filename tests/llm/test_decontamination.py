"""Benchmark hits in awkward texts, against a direct comparison of windows."""

import hashlib
import re

import pytest

from fareflow.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def naive(docs, items):
    windows = {}
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add(str(item))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for win, ids in windows.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found |= ids
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


LONG = "Alpha beta, gamma-delta EPSILON zeta eta theta iota kappa lambda mu"
ITEMS = [(1, LONG), (2, "Short question?"), (10, "short question"), (3, None), (4, " .,;"), (5, "é è ê"), (6, LONG), (7, "x " * 30)]
DOCS = [(1, "so " + LONG.lower() + " end"), (2, "a SHORT   question, short question short"), (3, None), (4, ""), (5, "éclair é  è ê!"),
        (6, "unshort question"), (None, "beta gamma delta epsilon zeta eta theta iota kappa lambda"), (7, "x " * 45), (7, "x " * 45), (8, "clean " * 3000)]


@pytest.mark.parametrize("limit", [dc.AUTOMATON_BYTES, 64])
def test_hits(spark, monkeypatch, limit):
    monkeypatch.setattr(dc, "AUTOMATON_BYTES", limit)
    docs = spark.createDataFrame([(*d, "z") for d in DOCS], "doc_id long, text string, _items string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert sorted((tuple(r) for r in dc.report(docs, items).collect()), key=repr) == naive(DOCS, ITEMS)
    clean = dc.clean(docs, items)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 6, 8]


@pytest.mark.parametrize("limit", [dc.AUTOMATON_BYTES, 16])
def test_items_without_an_id_do_not_leak(spark, monkeypatch, limit):
    monkeypatch.setattr(dc, "AUTOMATON_BYTES", limit)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame([(None, LONG), (None, "short question"), (2, "Short question?"), (None, None), (None, " .")], "item_id long, text string")
    assert sorted(r.doc_id for r in dc.clean(docs, items).collect()) == [3, 4, 5, 6, 7, 7, 8]
    assert sorted((tuple(r) for r in dc.report(docs, items).collect()), key=repr) == naive(DOCS, [(2, "short question")])
    row = dc.find(docs, items, unnamed=True).where("doc_id = 1").first()
    assert row._ranges and row._items == []


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert not any(r.contaminated for r in dc.report(docs, items.limit(0)).collect())
    assert dc.report(docs.limit(0), items).collect() == []


def test_offsets_of_the_original(spark):
    text = "Ünder — A SHORT;  question é è ê."
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    row = dc.find(docs, items).first()
    assert [text[a:b] for a, b in dc.spans(text, row._ranges)] == ["SHORT;  question", "é è ê"]
