"""Language, shards, pages, pieces, token files, scores and the pipeline on small tables."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fareflow.llm import backoff, html_text, language_id, queries, range_coder, sharding, token_store, unigram

SF = "/root/testdata/sf0.001"
public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ---- language ------------------------------------------------------------
def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language_id.report(docs).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98 and all(0 <= r.score <= 1 for r in rows)


def test_spans_of_mixed_text_and_odd_texts(spark, docs):
    model = language_id.fit(docs)
    text = {r.lang: r.text for r in docs.where("length(text) > 1500").dropDuplicates(["lang"]).collect()}
    part = lambda lang, n: " ".join(w for w in text[lang].split()[:n])
    rows = [(1, part("en", 60) + " " + part("de", 60)), (2, None), (3, ""), (4, "123 !? ### 4.5"), (5, "日本語"), (None, part("fr", 40)), (6, "a " * 20000)]
    got = {r.doc_id: r for r in language_id.identify(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int"), model).collect()}
    assert [s.lang for s in got[1].spans][0] == "en" and [s.lang for s in got[1].spans][-1] == "de" and len(got[1].spans) <= 4
    assert sum(s.n_words for s in got[1].spans) > 110
    assert [(got[k].lang_pred, got[k].score, got[k].spans) for k in (2, 3, 4)] == [("und", 0.0, [])] * 3
    assert got[5].lang_pred in model.languages and got[None].lang_pred == "fr"
    nothing = language_id.fit(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_rare_languages_keep_their_texts(spark):
    rows = ([(i, "the common words", "en") for i in range(4000)] + [(i, "les mots", "fr") for i in range(4000, 6000)] + [(9000 + i, "harvinainen sana", "fi") for i in range(12)]
            + [(None, f"ritka {chr(97 + i // 26)}{chr(97 + i % 26)} magyar", "hu") for i in range(600)] + [(1, "x", None), (2, None, "fi")])
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    share = language_id.shares({"en": 4000, "fr": 2000, "fi": 12, "hu": 600}, 312)
    assert share == {"en": 100 / 4000, "fr": 100 / 2000, "fi": 1.0, "hu": 100 / 600}
    assert language_id.shares({"a": 3, "b": 4}, 7) == {"a": 1.0, "b": 1.0} and language_id.shares({}, 7) == {}
    n = Counter(r.lang for r in language_id.draw(labelled.where("lang IS NOT NULL AND text IS NOT NULL"), share).collect())
    assert n["fi"] == 12 and all(60 < n[c] < 140 for c in ("en", "fr", "hu"))
    model = language_id.fit(labelled, 312)
    assert sorted(model.languages) == ["en", "fi", "fr", "hu"] and model.languages[0] == "en"
    probe = spark.createDataFrame([(1, "harvinainen sana"), (2, "ritka magyar")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in language_id.identify(probe, model).collect()} == {1: "fi", 2: "hu"}


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    for _ in range(30):
        sizes = rng.integers(0, 6, 4)
        first = np.concatenate([[0], np.cumsum(sizes)])
        scores = rng.normal(0, 3, (first[-1], 3)).astype(np.float32)
        label = language_id.viterbi(scores, first, 2.0)
        for a, b in zip(first, first[1:]):
            worth = lambda path, a=a: sum(float(scores[a + i, s]) for i, s in enumerate(path)) - 2.0 * sum(x != y for x, y in zip(path, path[1:]))
            best = max((worth(p) for p in np.ndindex(*[3] * (b - a))), default=0.0)
            assert abs(worth(tuple(label[a:b])) - best) < 1e-4


# ---- shards --------------------------------------------------------------
def test_every_shard_fits(spark):
    rows = [(i, "x" * (i % 90)) for i in range(400)] + [(7, "same" * 10)] * 50 + [(None, None), (None, "n"), (8, "y" * 5000)]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, shard string")
    got = sharding.assign(docs, limit=300).collect()
    assert len(got) == len(rows)
    total, shards = Counter(), {r.shard for r in got}
    for r in got:
        total[r.shard] += r.n_bytes
    assert all(total[r.shard] == r.shard_bytes and len(r.shard) == r.depth for r in got)
    assert [r.n_bytes for r in got if r.too_large] == [5000] and all(t <= 300 for s, t in total.items() if t != 5000)
    assert not any(a != b and b.startswith(a) for a in shards for b in shards)
    assert sharding.assign(docs.limit(0)).collect() == []


# ---- pages ---------------------------------------------------------------
LONG = "This is a paragraph of the article and it is long enough to be taken as good text by the rules that we have here for it. "


def test_page_rules():
    page = f"""<html><head><title>T</title></head><body class="has-sidebar"><div id=header>Site</div><div class="menu"><a href=x>Home</a></div>
      <h1>The title</h1><p>{LONG} A&nbsp;&amp;&#66;<p>Short   one.<div class='cookie-notice'><p>{LONG}</p></div><p>{LONG}</p><script>var a="</p>";</script>
      <div class="comments"><p>{LONG}</p></div><form><label>Name</label></form><footer>&copy; us</footer></body></html>"""
    good = " ".join(LONG.split())
    assert html_text.main_text(page) == f"The title {good} A &B Short one. {good}"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<!-- x") == ""
    assert html_text.main_text("<p " + "a='" * 2000) is not None


@pytest.mark.parametrize("start, end", [
    ('<div class="content has-sidebar">', "</div>"), ('<main class="with-sidebar">', "</main>"),
    ('<article class="post category-social">', "</article>"), ('<article class="post comment-open">', "</article>"),
    ('<article class="post related">', "</article>"), ('<div class="widget"><article>', "</article></div>"),
    ('<div data-id="comments">', "</div>"), ('<div class="ad">Buy<article>', "</article>")])
def test_names_do_not_reject_the_article(start, end):
    good = " ".join(LONG.split())
    rest = f"""<div class="site-footer ad-slot"><p>{LONG}</p></div><div class="related"><p>{LONG}</p></div><div id=comments>{LONG}<p>{LONG}</p></div>"""
    assert html_text.main_text(f"<body>{start}<p>{LONG}</p><p>{LONG}</p>{end}{rest}</body>") == f"{good} {good}"


def test_comments_behind_an_article_stay_out():
    page = f"<main><article><p>{LONG}</p></article><div id='comments'><article class='reply'><p>{LONG}</p></article></div></main>"
    assert html_text.main_text(page) == " ".join(LONG.split())


@pytest.mark.parametrize("word, gap, lang", [("kissa istui puun alla", " ", ""), ("国破山河在城春草木深", "", ""), ("国破山河在城春草木深", "", "en"), ("para o que os de", " ", "pt")])
def test_articles_in_other_languages(word, gap, lang):
    long, middling = gap.join([word] * 40), gap.join([word] * 10)
    page = f"<html lang='{lang}'><body><nav>{LONG}</nav><div><p>{long}</p><p>{middling}</p></div><div>&copy; {LONG}</div></body></html>"
    assert html_text.main_text(page) == f"{long} {middling}"


def test_long_blocks_without_stop_words_stay_out_of_english_pages():
    listed = "Alpha Beta Gamma " * 20
    assert html_text.main_text(f"<html lang=en-GB><p>{LONG * 9}</p><p>{listed}</p><p>{LONG * 9}</p>") == " ".join([" ".join((LONG * 9).split())] * 2)


@pytest.mark.parametrize("mark", [
    '<svg class="icon"/>', "<math/>", '<iframe src="x" />', '<object data="x"/>', '<script src="x"/>', "<svg><path/></svg>", "<svg><foreignObject><p>x</p></foreignObject></svg>",
    "<select><option>One", "<svg><path d='m'>", "<title>Icon", "<object data=x>", "<video-player></video-player>", "<script>var a='<p>'</script>"])
def test_elements_of_no_text_end(mark):
    good = " ".join(LONG.split())
    page = f"<article><p>{LONG}</p>{mark}<p>{LONG}</p>"
    assert html_text.main_text(page + "</article>") == html_text.main_text(page + f"<svg><path/></svg><select><option>2</select><p>{LONG}</article>")[:2 * len(good) + 1] == f"{good} {good}"
    assert html_text.main_text(page + f"{mark}<p>{LONG}</p></article>") == f"{good} {good} {good}"


def test_unclosed_elements_take_no_longer_on_long_pages():
    page = "<title>T<body><article>" + "<svg><select><object><p>one</p>" * 20_000 + "</article>"
    assert html_text.main_text(page) == " ".join(["one"] * 20_000)


def test_pages_keep_the_article_only(spark):
    import html
    import re
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in html_text.report(pages).collect()}
    for r in pages.collect():
        article = re.sub(r"<!--.*?-->", "", re.search(r"<article>(.*?)</article>", r.html, re.S)[1], flags=re.S)
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h\d|div|li|ul|br)\b[^>]*>", " ", article))).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


# ---- pieces --------------------------------------------------------------
def test_pieces_are_the_best_and_decode_back(spark, docs):
    model = queries.pieces()
    in_trie = set(model.trie.piece.tolist())
    piece = {t: i for i, t in enumerate(model.text) if i in in_trie}

    def best(cut):
        score = [0.0] + [-math.inf] * len(cut)
        for i in range(len(cut)):
            for j in range(i + 1, min(len(cut), i + 16) + 1):
                if cut[i:j] in piece:
                    score[j] = max(score[j], score[i] + float(model.score[piece[cut[i:j]]]))
                elif j == i + 1:
                    score[j] = max(score[j], score[i] + model.unknown_score)
        return score[-1]

    texts = [r.text for r in docs.limit(20).collect()] + ["", " ", "  two  spaces ", "\n\nx\n", "日本語 🎉 \x00 é", "ab" * 400]
    for t, raw in zip(texts, unigram.Encoder(model).encode(texts)):
        ids = np.frombuffer(raw, "<i4")
        assert model.decode(ids) == t
        plain = [i for i in ids.tolist() if i not in set(model.byte_ids)]
        unknown = sum(c not in piece for c in "".join(model.split(t)))
        assert abs(sum(best(c) for c in model.split(t)) - float(model.score[plain].sum()) - unknown * model.unknown_score) < 1e-6
    rows = spark.createDataFrame([(1, None, "q"), (2, "▁ mark", "q"), (2, "a b", "q")], "doc_id long, text string, ids string")
    assert sorted((r.doc_id, r.n_pieces > 0, r.round_trip) for r in unigram.report(rows, model).collect()) == [(1, False, True), (2, True, False), (2, True, True)]
    back = unigram.decode(unigram.encode(rows, model, ids="codes"), model, ids="codes")
    assert sorted(map(str, unigram.round_trip(rows, model, ids="codes").collect())) == sorted(map(str, back.collect()))
    assert back.columns == ["doc_id", "text", "ids", "codes", "decoded"] and sorted(r.decoded for r in back.collect()) == ["", "  mark", "a b"]


# ---- token files ---------------------------------------------------------
def test_coder_round_trip():
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, 65536, 700), np.zeros(0, np.int64), np.full(4096, 7), rng.integers(0, 5, 3000), np.array([65535])]
    codes = range_coder.encode(blocks)
    assert all((a == b).all() for a, b in zip(blocks, range_coder.decode(codes, [len(b) for b in blocks])))
    assert len(codes[2]) < 40 and len(codes[1]) == 0


def test_coder_round_trip_of_many_blocks():
    rng = np.random.default_rng(1)
    phrases = [rng.integers(0, 65536, 6) for _ in range(40)]
    blocks = [rng.integers(0, 300, int(n)) for n in rng.integers(0, 40, range_coder.LANES + 50)]
    blocks += [np.concatenate([phrases[k] for k in rng.integers(0, 40, 650)]) for _ in range(3)]  # predicted, and often wrongly
    blocks += [np.arange(4096) % 16 * 4096, np.arange(4096) * 16 % 65536, np.concatenate([np.full(4000, 5), rng.integers(0, 65536, 96)])]
    codes = range_coder.encode(blocks)
    assert all((a == b).all() for a, b in zip(blocks, range_coder.decode(codes, [len(b) for b in blocks])))
    assert all(len(c) < 2 * len(b) for b, c in zip(blocks[-6:-3], codes[-6:-3]))


def test_blocks_are_read_beside_others_than_when_coded():
    rng = np.random.default_rng(2)
    blocks = [np.where(rng.random(600) < 0.95, 7, rng.integers(0, 65536, 600)) for _ in range(300)]
    codes = range_coder.encode(blocks)
    for some in (slice(0, 300, 7), slice(5, 6), slice(200, 300)):
        back = range_coder.decode(codes[some], [600] * len(codes[some]))
        assert all((a == b).all() for a, b in zip(blocks[some], back))


def test_each_piece_is_encoded_once():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        words, asked = token_store.WordTokenizer(f.read()), []

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def encode_batch_fast(self, texts, **options):
            asked.extend(p for t in texts for p in t.split())
            return self.inner.encode_batch_fast(texts, **options)

    words.tokenizer, words.pieces = Counted(words.tokenizer), Counted(words.pieces)
    ids, lengths = words.encode(pa.array(["Über über, ÜBER. don't", None, "日本 don't日本 <|endoftext|>"]))
    words.encode(pa.array(["(über) don 't 日本"]))
    assert sorted(asked) == sorted(["über", ",", ".", "don", "'t", "日本", "don't日本", "<|endoftext|>", "(", ")"])
    assert lengths.tolist()[1] == 1 and len(ids) == lengths.sum()


def test_words_have_the_ids_of_the_library():
    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(0)
    with open(path, encoding="utf-8") as f:
        words = token_store.WordTokenizer(f.read())
    letters = "abzABZ09'’\".,-<|>_ſßÿ×÷µªÀÖØöøŸéẞİıΣσςǅ́̈日🎉²½١ \t\n\r\x0b\x0c\x1c\x7f\x00\x85\xa0\u2003strevmld"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [f"{chr(c)}a{chr(c)} {chr(c).upper()}'{chr(c)}9" for c in range(1, 0x500)]
    ids, lengths = words.encode(pa.array(texts))
    want = [e.ids + [token_store.END_ID] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert lengths.tolist() == list(map(len, want)) and ids.tolist() == [i for x in want for i in x]


def test_files_hold_all_ids_in_order(spark, docs, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    odd = [(-3, None), (-2, ""), (-1, "Ünïcode ſ <|endoftext|> don't ́x\t日本 🎉"), (None, "no id"), (10**6, "again"), (10**6, "again"), (10**6 + 1, "w " * 70000)]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    tokenizer, start, want = Tokenizer.from_file(path), 0, []
    for r in sorted(rows.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in token_store.report(rows, path).collect()), key=repr) == sorted(want, key=repr)
    token_store.write(rows.limit(3), path, f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t").withColumn("checksums", wrong_checksums())
    stored.write.parquet(f"{tmp_path}/damaged")
    with pytest.raises(Exception, match="checksum"):
        token_store.read(spark, f"{tmp_path}/damaged").collect()
    assert token_store.report(rows.limit(0), path).collect() == []


def wrong_checksums():
    return F.transform("checksums", lambda c: c + 1)


# ---- scores --------------------------------------------------------------
def test_scores_do_not_depend_on_the_vocabulary(spark, docs):
    """Every word and pair counts, and is scored the same wherever it was counted."""
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").limit(60).collect()]
    rows += [(900, None), (901, ""), (902, "one"), (902, "one"), (903, "zq zq zq zr zq zr"), (904, "zr"), (905, "zs one"), (906, "one zs zt")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, _key int")
    texts = [(t or "").split() for _, t in rows]
    f1, f2 = Counter(w for t in texts for w in t), Counter(p for t in texts for p in zip(t, t[1:]))
    n, want = sum(f1.values()), []
    for (d, _), t in zip(rows, texts):
        score = math.log(f1[t[0]] / n) if t else 0.0
        for c, w in zip(t, t[1:]):
            score += math.log(f2[c, w] / f1[c]) if f2[c, w] >= 2 else math.log(0.4) + math.log(f1[w] / n)
        want.append((d, len(t), sum(f2[p] < 2 for p in zip(t, t[1:])), score))
    want.sort(key=repr)
    for size, frequent, sample in ((50, 40, 30), (50, 1, 1), (1, 1, 1), (1 << 18, 1 << 19, 20_000)):
        got = sorted((tuple(r) for r in backoff.score(df, size, frequent, sample).collect()), key=repr)
        assert [x[:3] for x in got] == [x[:3] for x in want] and np.allclose([x[3] for x in got], [x[3] for x in want])
    assert backoff.score(df.limit(0)).collect() == []


def rows_made(df):
    """Most rows that one operator of a plan that has run gave out."""
    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        made = node.metrics().get("numOutputRows")
        below = [walk(node.children().apply(i)) for i in range(node.children().size())]
        return max([made.get().value() if made.isDefined() else 0, *below])
    return walk(df._jdf.queryExecution().executedPlan())


def test_rows_of_counts_grow_with_the_input(spark):
    """A frequent pair, rare words and words seen once; the same texts in few and many blocks."""
    rng = np.random.default_rng(1)
    text = lambda i: " ".join(f"hot pair w{rng.zipf(1.3) % 5000} r{i}x{k}" for k in range(60))
    rows, made, scores = [(i, text(i)) for i in range(500)], {}, {}
    for n, blocks in ((100, 4), (500, 20), (500, 4)):
        df = backoff.score(spark.createDataFrame(rows[:n], "doc_id long, text string").repartition(n // 25), fewest_blocks=blocks)
        scores[n, blocks] = {r.doc_id: (r.n_words, r.n_backoff, round(r.log_score, 6)) for r in df.collect()}
        made[n, blocks] = rows_made(df)
    assert scores[500, 4] == scores[500, 20] and len(scores[500, 4]) == 500
    f1 = Counter(w for _, t in rows for w in t.split())
    f2 = Counter(p for _, t in rows for p in zip(t.split(), t.split()[1:]))
    total = sum(f1.values())
    for i in (0, 77, 499):
        t = rows[i][1].split()
        want = math.log(f1[t[0]] / total) + sum(
            math.log(f2[p] / f1[p[0]]) if f2[p] >= 2 else math.log(0.4) + math.log(f1[p[1]] / total) for p in zip(t, t[1:]))
        assert scores[500, 20][i] == (240, sum(f2[p] < 2 for p in zip(t, t[1:])), round(want, 6))
    assert made[100, 4] == 100 and made[500, 20] <= 500  # texts, or one row for each block and range


# ---- pipeline ------------------------------------------------------------
def test_pipeline_stages_take_effect(spark):
    from fareflow.llm import decontamination, quality, simhash, substring_dedup
    sf = "/root/testdata/sf0.01"
    docs, names = spark.read.parquet(f"{sf}/documents.parquet"), ["doc_id", "text", "lang", "source", "n_chars"]
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    first = corpus_pipeline.materialise(corpus_pipeline.quality_rules(spark, docs, sf), "t")
    assert first.columns == names and ids(first) == ids(quality.report(docs).where("kept"))
    second = corpus_pipeline.materialise(corpus_pipeline.near_duplicates(spark, first, sf), "t")
    assert ids(second) == ids(simhash.report(first).where("doc_id = component_id"))
    third = corpus_pipeline.materialise(corpus_pipeline.repeated_passages(spark, second, sf), "t")
    cut = {r.doc_id: r for r in substring_dedup.cut_repeats(second).collect()}
    assert third.columns == names and len(cut) == third.count()
    assert all(r.text == (cut[r.doc_id]._kept if cut[r.doc_id]._n_removed else cut[r.doc_id].text) and r.n_chars == len(r.text) for r in third.collect())
    fourth = corpus_pipeline.materialise(corpus_pipeline.benchmark_leaks(spark, third, sf), "t")
    found = decontamination.report(third, spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert ids(fourth) == ids(found.where("NOT contaminated"))
    last = corpus_pipeline.piece_ids(spark, fourth, sf)
    assert ids(last) == ids(fourth) and last.where("text <> decoded OR size(ids) = 0 AND text <> ''").count() == 0
    assert ids(corpus_pipeline.run(spark, sf)) == ids(fourth)
    assert corpus_pipeline.near_duplicates(spark, first.limit(0), sf).count() == 0
