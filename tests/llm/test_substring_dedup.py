"""Repeated windows against a direct count of all windows."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from fareflow.llm import substring_dedup as sd
from fareflow.llm.words import Words, mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def naive(rows, window=35):
    texts = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, texts):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in sd.report(df).collect()), key=repr)


def test_equal_windows_have_equal_representatives():
    rng = np.random.default_rng(0)
    for trial in range(40):
        texts = [rng.integers(0, (2, 3, 20)[trial % 3], rng.integers(0, 120)) for _ in range(6)]
        shared = rng.integers(0, 4, 80)
        texts[0], texts[1] = np.concatenate([texts[0], shared]), np.concatenate([shared, texts[1]])
        texts += [np.zeros(90, int), np.tile([0, 1], 60), np.concatenate([np.ones(3, int), np.zeros(70, int)])]
        hashes = mix(np.concatenate(texts).astype(np.uint64), 5)
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        name = {}
        for begin, count, x in zip(*sd.stretches(hashes, first)):
            name.update({begin + k: x for k in range(count)})
        windows = {p: tuple(hashes[p:p + 35]) for a, b in zip(first, first[1:]) for p in range(a, b - 34)}
        assert set(name) == set(windows)
        of_window = {}
        assert all(of_window.setdefault(w, name[p]) == name[p] for p, w in windows.items())


def test_words_do_not_cross_texts():
    words = Words.of(pa.array(["ab cd", None, "", " x  longer_word_of_many_bytes\n", "cd"]))
    assert words.strings() == [b"ab", b"cd", b"x", b"longer_word_of_many_bytes", b"cd"]
    assert words.first.tolist() == [0, 2, 2, 2, 4, 5]
    assert words.hashes()[1] == words.hashes()[4] and len(set(words.hashes().tolist())) == 4


def test_planted_and_awkward_texts(spark):
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(400)] + ["ü", "日本", "a" * 50]
    text = lambda n: " ".join(rng.choice(words, n))
    shared, other = text(60), text(36)
    rows = [(1, text(100) + " " + shared + "\n" + text(30)), (2, shared), (3, text(10) + "\t" + shared + " " + other),
            (4, other + " tail"), (5, None), (6, ""), (7, "one two"), (None, text(50)), (8, "a " * 34), (9, "a " * 36), (10, "b c " * 40),
            (11, text(34)), (12, text(35)), (13, shared.upper()), (14, text(3000)), (14, "same id " + text(40)), (15, text(80))]
    rows += [rows[14], (16, rows[14][1])]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, _key string, open int")
    assert got(docs) == naive(rows)
    cut = sd.cut_repeats(docs)
    assert cut.columns == ["doc_id", "text", "_key", "open", "_n_words", "_n_removed", "_kept"] and cut.count() == len(rows)
    assert got(docs.limit(0)) == []
