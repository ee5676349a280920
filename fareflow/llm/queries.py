"""The queries of this subpackage, one for each operator, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fareflow.llm import (
    backoff, decontamination, html_text, language_id, lexical, merkle, quality, sharding, simhash, substring_dedup,
    suffix_radix, token_store, unigram)
from fareflow.llm.workers import send_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    send_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(model: str | None = None) -> unigram.Pieces:
    """The public pair-merging model of 32,000 pieces, its ranks read as frequencies; or another file like it."""
    import public_tokenizers
    return unigram.Pieces.load(model or public_tokenizers.path("piece_bpe_32k.model"), ranked=True)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(_table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.report(_table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    return unigram.report(_table(spark, sf_dir, "documents"), pieces(model))


def op7_token_ids(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers
    return token_store.report(_table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("word_bpe_49k.json"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.report(_table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(_table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(_table(spark, sf_dir, "documents"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_radix.report(_table(spark, sf_dir, "documents"))


OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM documents),
p AS (SELECT d.*, t.depth, h // (CAST(1 AS BIGINT) << (32 - t.depth)) AS prefix FROM d, range(33) AS t(depth)),
s AS (SELECT *, sum(n_bytes) OVER w AS shard_bytes, count(*) OVER w AS n FROM p WINDOW w AS (PARTITION BY depth, prefix)),
m AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY depth) AS r FROM s WHERE shard_bytes <= {sharding.SHARD_BYTES} OR n = 1)
SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE substr(lpad(bin(h), 32, '0'), 1, CAST(depth AS INTEGER)) END AS shard,
       CAST(depth AS BIGINT) AS depth, n_bytes, CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_bytes > {sharding.SHARD_BYTES} AS too_large
FROM m WHERE r = 1
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP3_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT k, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
g AS (SELECT p.k, p.i, md5(array_to_string(d.w[p.i : p.i + 34], ' ')) AS h FROM p JOIN d USING (k)),
r AS (SELECT k, i FROM g JOIN (SELECT h FROM g GROUP BY h HAVING count(*) > 1) USING (h)),
c AS (SELECT DISTINCT k, i + o AS i FROM r, range(35) AS t(o)),
x AS (SELECT k, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
s AS (SELECT x.k, string_agg(x.word, ' ' ORDER BY x.i) AS kept, count(*) AS n FROM x ANTI JOIN c USING (k, i) GROUP BY x.k)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(s.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(s.kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (k)
"""

_NORMAL = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP9_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
x AS (SELECT k, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i, unnest(list_prepend(NULL, w)[: len(w)]) AS c FROM d WHERE len(w) > 0),
u AS (SELECT w, count(*) AS f FROM x GROUP BY w),
b AS (SELECT c, w, count(*) AS f FROM x WHERE i > 1 GROUP BY c, w),
t AS (SELECT sum(f) AS n FROM u),
s AS (SELECT x.k, CASE WHEN x.i = 1 THEN ln(u.f / t.n) WHEN b.f >= {backoff.MIN_COUNT} THEN ln(b.f / v.f)
                  ELSE ln(0.4) + ln(u.f / t.n) END AS p, x.i > 1 AND b.f < {backoff.MIN_COUNT} AS back
      FROM x CROSS JOIN t JOIN u ON u.w = x.w LEFT JOIN u v ON v.w = x.c LEFT JOIN b ON b.c = x.c AND b.w = x.w AND x.i > 1),
r AS (SELECT k, sum(p) AS p, count(*) FILTER (back) AS n FROM s GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(r.n, 0) AS BIGINT) AS n_backoff, round(coalesce(r.p, 0.0), 4) AS log_score
FROM d LEFT JOIN r USING (k)
"""

OP8_SQL = f"""
WITH b AS (SELECT item_id, {_NORMAL} AS w FROM benchmark WHERE item_id IS NOT NULL),
q AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
             unnest([array_to_string(w[i : i + 9], ' ') for i in range(1, greatest(len(w) - 8, 2))]) AS win
      FROM b WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS k, doc_id, {_NORMAL} AS w FROM documents),
p AS (SELECT d.k, z.n, unnest(range(1, len(d.w) - z.n + 2)) AS i FROM d, (SELECT DISTINCT n FROM q) z WHERE len(d.w) >= z.n),
g AS (SELECT p.k, p.n, p.i, array_to_string(d.w[p.i : p.i + p.n - 1], ' ') AS win FROM p JOIN d USING (k)),
m AS (SELECT g.k, g.i, g.n, q.item_id FROM g JOIN q USING (win, n)),
h AS (SELECT k, count(*) AS n_hit FROM (SELECT DISTINCT k, unnest(range(i, i + n)) AS i FROM m) GROUP BY k),
t AS (SELECT k, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
      FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY k)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (k) LEFT JOIN t USING (k)
"""


_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

OP11_SQL = f"""
WITH q AS (SELECT row_number() OVER () AS q, item_id, unnest(list_distinct({_TERMS})) AS term FROM benchmark),
d AS (SELECT row_number() OVER () AS k, doc_id, {_TERMS} AS w FROM documents),
s AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS terms FROM d WHERE len(w) > 0),
x AS (SELECT k, unnest(w) AS term FROM d),
f AS (SELECT k, term, count(*) AS tf FROM x WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, s GROUP BY term),
m AS (SELECT k, doc_id, 100 - 90 + ((90 * len(w) * docs) // terms) AS m FROM d, s),
r AS (SELECT q.q, q.item_id, m.k, m.doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m.m)))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (k) GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= {lexical.TOP}
"""


def _field(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR) END"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


# The checksum goes through the bits of the id's digits, eight steps for each.
_CRC = ("xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten([[CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0] "
        "FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])), lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))))")

OP12_SQL = f"""
WITH RECURSIVE docs AS (SELECT doc_id, lang, {_leaf('n_chars')} AS leaf, CASE WHEN {_CRC} % 7 = 0 THEN {_leaf('n_chars + 1')} END AS changed
                        FROM documents),
d AS (SELECT *, row_number() OVER () AS k, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos FROM docs),
langs AS (SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM d GROUP BY lang),
nodes AS (SELECT tree, 0 AS level, pos, n, leaf AS h FROM d JOIN langs ON d.lang IS NOT DISTINCT FROM langs.lang
          UNION ALL SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1
          GROUP BY tree, level, n, pos // 2),
subroots AS (SELECT tree, h FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS level, tree AS pos, (SELECT count(*) FROM langs) AS n, h FROM subroots
         UNION ALL SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1
         GROUP BY level, n, pos // 2),
steps AS (SELECT d.k, s.level, d.pos >> s.level AS place, coalesce(b.h, '') AS beside
          FROM d JOIN langs ON d.lang IS NOT DISTINCT FROM langs.lang JOIN (SELECT DISTINCT tree, level FROM nodes WHERE n > 1) s USING (tree)
          LEFT JOIN nodes b ON b.tree = s.tree AND b.level = s.level AND b.pos = xor(d.pos >> s.level, 1)
          UNION ALL
          SELECT d.k, 100 + s.level, tree >> s.level, coalesce(b.h, '')
          FROM d JOIN langs ON d.lang IS NOT DISTINCT FROM langs.lang CROSS JOIN (SELECT DISTINCT level FROM tops WHERE n > 1) s
          LEFT JOIN tops b ON b.level = s.level AND b.pos = xor(langs.tree >> s.level, 1)),
proofs AS (SELECT k, sha256(string_agg(beside, '' ORDER BY level)) AS proof,
                  list(CASE WHEN place % 2 = 1 THEN beside || '<' ELSE '>' || beside END ORDER BY level) AS path FROM steps GROUP BY k),
folds AS (SELECT d.k, coalesce(path, []) AS path, 0 AS i, coalesce(changed, leaf) AS h FROM d LEFT JOIN proofs USING (k)
          UNION ALL SELECT k, path, i + 1, sha256(CASE WHEN path[i + 1][1] = '>' THEN h || path[i + 1][2:] ELSE path[i + 1][:-2] || h END)
          FROM folds WHERE i < len(path))
SELECT doc_id, leaf, subroots.h AS subroot, tops.h AS root, coalesce(proof, sha256('')) AS proof_sha256, folds.h AS folded_root,
       folds.h = tops.h AS verified
FROM d JOIN langs ON d.lang IS NOT DISTINCT FROM langs.lang JOIN subroots USING (tree) JOIN tops ON tops.n = 1
JOIN folds ON folds.k = d.k AND folds.i = len(folds.path) LEFT JOIN proofs ON proofs.k = d.k
"""

OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT k, doc_id, unnest(range(0, len(h) // 2 - {suffix_radix.WINDOW - 1})) AS i FROM d WHERE len(h) >= 2 * {suffix_radix.WINDOW}),
g AS (SELECT p.k, p.doc_id, p.i, md5(substr(d.h, 2 * p.i + 1, 2 * {suffix_radix.WINDOW})) AS win FROM p JOIN d USING (k)),
f AS (SELECT win, min(doc_id) AS doc_id FROM g GROUP BY win HAVING count(*) > 1),
r AS (SELECT g.k, g.i FROM g JOIN f USING (win) WHERE g.doc_id > f.doc_id),
n AS (SELECT k, i, coalesce(i > lag(i) OVER w + {suffix_radix.WINDOW}, true) AS fresh FROM r WINDOW w AS (PARTITION BY k ORDER BY i)),
t AS (SELECT k, i, sum(fresh::INT) OVER (PARTITION BY k ORDER BY i) AS span FROM n),
s AS (SELECT k, span, min(i) AS a, max(i) + {suffix_radix.WINDOW} AS b FROM t GROUP BY ALL),
e AS (SELECT k, a, b, lag(b, 1, 0) OVER (PARTITION BY k ORDER BY a) AS prev FROM s),
c AS (SELECT e.k, count(*) AS spans, sum(b - a)::BIGINT AS gone, max(b) AS last,
             string_agg(substr(d.h, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY a) AS kept FROM e JOIN d USING (k) GROUP BY e.k)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN c USING (k)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_language_id, op2_sharding, op3_substring_dedup, op4_html_extraction, op5_quality_rules, op6_sentencepiece,
        op7_token_ids, op8_decontamination, op9_lm_scoring, op10_simhash_near_dedup,
        op11_lexical_search, op12_merkle_manifest, op13_suffix_dedup)}


def oracles() -> dict[str, str]:
    return {"op2_sharding": OP2_SQL, "op3_substring_dedup": OP3_SQL, "op8_decontamination": OP8_SQL,
            "op9_lm_scoring": OP9_SQL, "op11_lexical_search": OP11_SQL, "op12_merkle_manifest": OP12_SQL,
            "op13_suffix_dedup": OP13_SQL}
