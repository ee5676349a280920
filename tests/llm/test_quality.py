"""Counts against plain Python, outliers against a direct estimate."""

import re
from collections import Counter, defaultdict

import numpy as np

from fareflow.llm import quality as q

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def naive_counts(text):
    w = WORD.findall(text or "")
    seen, covered = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if seen[tuple(w[i:i + 3])] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)), len(lines)


def naive_kept(rows):
    """The contract's verdicts by numpy: concentration steps per group from each start, the smallest determinant wins."""
    stats = [(naive_counts(t), lang, src) for _, t, lang, src in rows]
    failed = [c[0] < 50 or 100 * c[4] > 50 * c[0] for (c, _), _, _ in stats]
    x = np.array([[np.log((c[1] + 1) / max(c[0], 1)), np.log1p(100 * c[2] / max(c[0], 1)), np.arcsin(np.sqrt(c[3] / max(n, 1))),
                   np.arcsin(np.sqrt(c[4] / max(c[0], 1)))] for (c, n), _, _ in stats])
    members = defaultdict(list)
    for i, (_, lang, src) in enumerate(stats):
        if not failed[i]:
            for key in (("s", lang, src), ("l", lang), ("c",)):
                members[key].append(i)
    estimates, floors = {}, np.array(q.FLOORS)
    for key, at in members.items():
        if len(at) < q.MIN_ROWS:
            continue
        v = np.floor(x[at] * 2**20 + 0.5) / 2**20
        quartiles = np.percentile(np.floor(v * q.GRID + 0.5) / q.GRID, (25, 50, 75), axis=0)
        ends = []
        for centre, by_quartiles in q.STARTS:
            mean = quartiles[centre]
            cov = np.diag((np.maximum((quartiles[2] - quartiles[0]) / 1.349, floors) if by_quartiles else 4 * floors) ** 2)
            for _ in range(q.STEPS):
                d = v - mean
                d2 = np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)
                bins = np.floor(q.BINS * np.log(d2 + 1e-6))
                sizes = Counter(bins.tolist())
                before, chosen = 0, set()
                for b in sorted(sizes):
                    if before < q.SUBSET * len(at):
                        chosen.add(b)
                    before += sizes[b]
                s = v[[b in chosen for b in bins.tolist()]]
                mean = s.mean(axis=0)
                cov = q.CONSISTENCY * ((s.T @ s) / len(s) - np.outer(mean, mean)) + np.diag(floors**2)
            ends.append((np.linalg.slogdet(cov)[1], mean, cov))
        _, mean, cov = min(ends, key=lambda e: e[0])
        estimates[key] = mean, np.linalg.inv(cov)
    out = []
    for i, (_, lang, src) in enumerate(stats):
        key = next((k for k in (("s", lang, src), ("l", lang), ("c",)) if len(members[k]) >= q.MIN_ROWS), None)
        d = x[i] - estimates[key][0] if key else np.zeros(4)
        out.append(not failed[i] and (key is None or bool(d @ estimates[key][1] @ d <= q.CUTOFF)))
    return out


def test_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    got = {r.doc_id: r for r in q.report(docs).collect()}
    kept = naive_kept(rows)
    for (d, t, *_), k in zip(rows, kept):
        counts = naive_counts(t)[0]
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0]) and r.kept == k
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [d for d in labels if d in got and not got[d].base_failed]
    assert all(got[d].kept for d in judged if labels[d] == 1)
    assert np.mean([got[d].kept for d in judged if labels[d] == 0]) < 0.1


def test_nulls_and_odd_texts(spark):
    rows = [(1, None, None, None), (2, "", "en", None), (2, "", "en", None), (None, "a b c a b c", None, "s"), (4, "x " * 20000, "en", "s"),
            (5, " \n\t\n x \n x \nx", "en", "s"), (6, "日 本 " + " ".join(f"w{i}" for i in range(60)), "ja", "s"), (7, "a|b<c>#*$%&", "", "")]
    docs = spark.createDataFrame([(*r, 1.0, "z") for r in rows], "doc_id long, text string, lang string, source string, _x0 double, key string")
    got = sorted((tuple(r) for r in q.report(docs).collect()), key=repr)
    want = [(d, *c, f, not f) for d, t, *_ in rows for c in [naive_counts(t)[0]] for f in [c[0] < 50 or 100 * c[4] > 50 * c[0]]]
    assert got == sorted(want, key=repr)
    clean = q.clean(docs)
    assert clean.columns == docs.columns and [r.doc_id for r in clean.collect()] == [6]
    assert q.report(docs.limit(0)).collect() == [] and q.clean(docs.limit(0)).count() == 0


def test_estimates_do_not_depend_on_partitions(spark):
    rows = q.counts(spark.read.parquet(f"{SF}/documents.parquet")).drop("text").cache()
    one, seven = (sorted(map(repr, q.fit(rows.repartition(n, "_n_words", "_word_chars")).collect())) for n in (1, 7))
    assert one == seven


def test_the_smallest_determinant_wins(spark, monkeypatch):
    """A third of the rows forms a tight cluster of its own, where the start at a quartile finds less scatter."""
    rng = np.random.default_rng(8)
    bulk, tight = rng.normal((1.5, 1.0, 0.2, 0.2), (0.5, 0.9, 0.15, 0.15), (600, 4)), rng.normal((1.2, 0.1, 0.0, 0.0), 0.01, (300, 4))
    data = [(False, "en", "s", *map(float, np.abs(v))) for v in np.concatenate([bulk, tight])]
    rows = spark.createDataFrame(data, "_base_failed boolean, lang string, source string, " + ", ".join(f"_x{i} double" for i in range(4)))
    best = q.fit(rows).first().det
    single = []
    for start in q.STARTS:
        monkeypatch.setattr(q, "STARTS", (start,))
        single.append(q.fit(rows).first().det)
    assert best == min(single)


def test_no_python_on_the_main_path(spark, capsys):
    q.report(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
