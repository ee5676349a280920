"""SimHash groups against a comparison of all pairs."""

import numpy as np
import pytest
import xxhash

from fareflow.llm import simhash

SF = "/root/testdata/sf0.001"


def naive_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_groups(rows):
    prints = [naive_print(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2 and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (d, _), x in zip(rows, label):
        if d is not None:
            least[x] = min(d, least.get(x, d))
    return sorted(((d, f"{p:016x}", least.get(x)) for (d, _), p, x in zip(rows, prints, label)), key=repr)


def got(df):
    return sorted((tuple(r) for r in simhash.report(df).collect()), key=repr)


def test_groups_of_the_smallest_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(docs) == naive_groups(rows)


def test_nulls_repeats_and_short_texts(spark):
    rows = [(5, None), (3, ""), (9, " \n"), (None, "a b c d e f"), (7, "A B C D E F"), (7, "A B C D E F"), (1, "one"), (2, "ONE"),
            (None, "alone here"), (4, "x " * 5000)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, print string")
    assert got(docs) == naive_groups(rows)
    assert got(docs.limit(0)) == []


@pytest.mark.parametrize("tree_size", [4096, 7])
def test_links_of_dense_files(spark, tree_size):
    rng = np.random.default_rng(3)
    values = set()
    for base in rng.integers(0, 2**63, 4):
        for _ in range(120):
            x = int(base)
            for b in rng.integers(0, 64, rng.integers(0, 6)):
                x ^= 1 << int(b)
            values.add(x)
    values = sorted(values)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "print long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(df, tree_size)).collect()}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    label = {v: v for v in signed}
    for i, v in enumerate(values):
        for j in range(i):
            if bin(v ^ values[j]).count("1") <= 2:
                a, b = sorted((label[signed[i]], label[signed[j]]))
                label = {k: a if x == b else x for k, x in label.items()}
    assert {v: roots.get(v, v) for v in signed} == label
