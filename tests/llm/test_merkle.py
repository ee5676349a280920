"""Manifests against a tree that is built level by level."""

import hashlib
import zlib

import pytest

from fareflow.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    text = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*map(text, row))


def up(level):
    return [h(*level[i:i + merkle.FANOUT]) for i in range(0, len(level), merkle.FANOUT)]


def path(level, i):
    """Siblings from node ``i`` to the top, and the top."""
    out = []
    while len(level) > 1:
        run = i - i % merkle.FANOUT
        out.append((level[run:i], level[i + 1:run + merkle.FANOUT]))
        level, i = up(level), i // merkle.FANOUT
    return out, level[0]


def naive(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is None, r[0] or 0, leaf(r)))
    tops = [path([leaf(r) for r in groups[x]], 0)[1] for x in langs]
    out = []
    for n, lang in enumerate(langs):
        above, root = path(tops, n)
        for i, r in enumerate(groups[lang]):
            siblings = path([leaf(x) for x in groups[lang]], i)[0] + above
            changed = r[3] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = leaf((*r[:3], r[3] + 1, r[4])) if changed else leaf(r)
            for before, after in siblings:
                folded = h(*before, folded, *after)
            proof = h(*[x for before, after in siblings for x in (*before, *after)])
            out.append((r[0], leaf(r), tops[n], root, proof, folded, folded == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("fanout, levels", [(2, 8), (2, 2), (3, 1), (4, 2)])
def test_manifest(spark, monkeypatch, fanout, levels):
    monkeypatch.setattr(merkle, "FANOUT", fanout)
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = [(i, f"s{i % 3}", ("en", "en", "en", "de", "é", "zz", None)[i % 7], i * 10, f"text {i} ü") for i in range(90)]
    rows += [(100, None, "one", 5, None), (101, "s", "", None, ""), (102, "s", "en", None, "x" * 5000), (None, "s", "en", 3, "no id"),
             (None, "s", "en", 4, "no id"), rows[0], rows[0], (0, "other", "en", 1, "same id"), (-7, "s", "de", -1, "")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf int, path string")
    result = sorted((tuple(r) for r in merkle.report(docs.repartition(4)).collect()), key=repr)
    assert result == naive(rows)
    assert {r[-1] for r in result} == {True, False}


def test_few_rows(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.report(spark.createDataFrame([], schema)).collect() == []
    one = [(1, "s", "en", 2, "ab")]
    (row,) = merkle.report(spark.createDataFrame(one, schema)).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == h("") and [tuple(row)] == naive(one)
