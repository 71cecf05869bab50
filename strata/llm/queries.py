"""One query per operator over whole tables, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (exact_dup, lexical, licenses, near_dup, ngram_join, packing, pieces, pii, quality,
                        sharding, spelling, token_counts, urls)
from strata.llm._util import table, tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


_WORDS = "list_filter(regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

ORACLES["op1_minhash_near_dedup"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
  FROM documents),
u AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM w),
g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id) AS c,
         concat_ws(' ', w, lead(w, 1) OVER d, lead(w, 2) OVER d, lead(w, 3) OVER d, lead(w, 4) OVER d) AS x
  FROM u WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
e AS (SELECT DISTINCT doc_id, x FROM g WHERE i <= greatest(1, c - 4)),
n AS (SELECT w.doc_id, count(e.x) AS n FROM w LEFT JOIN e USING (doc_id) GROUP BY w.doc_id),
t AS (SELECT x, row_number() OVER () AS term FROM e GROUP BY x HAVING count(*) > 1),
p AS (SELECT doc_id, term FROM e JOIN t USING (x)),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM p a JOIN p b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY 1, 2),
h AS (
  SELECT l.a, l.b FROM l JOIN n na ON na.doc_id = l.a JOIN n nb ON nb.doc_id = l.b
  WHERE 100 * l.i >= 75 * (na.n + nb.n - l.i)),
k AS (SELECT a, b FROM h UNION ALL SELECT b, a FROM h),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM n
  UNION SELECT k.a, r.reached FROM r JOIN k ON k.b = r.doc_id),
c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN c USING (doc_id)
"""


@query
def op4_bfd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), 8)


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dup.exact_duplicates(table(spark, sf_dir, "documents"),
                                      carry={"text_sha256": F.sha2("lowered", 256)})


ORACLES["op5_exact_dedup"] = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
"""


@query
def op7_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents")).drop("host_rate")


ORACLES["op7_host_quality_rules"] = f"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents),
u AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM w),
g AS (
  SELECT doc_id, i, w || ' ' || lead(w, 1) OVER d || ' ' || lead(w, 2) OVER d AS x
  FROM u WINDOW d AS (PARTITION BY doc_id ORDER BY i) QUALIFY x IS NOT NULL),
t AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
c AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS p FROM t) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, source, len(ws) AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN c USING (doc_id)),
j AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines
           OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS soft_failed
  FROM f),
y AS (  -- analysis of variance over the documents that have a host
  SELECT source, y, avg(y) OVER (PARTITION BY source) AS own, avg(y) OVER () AS m,
         count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total
  FROM (SELECT source, CASE WHEN base_failed OR soft_failed THEN 1.0::DOUBLE ELSE 0 END AS y FROM j WHERE source IS NOT NULL)),
v AS (
  SELECT any_value(m) AS m, any_value(total) AS total, count(DISTINCT source) AS k, sum((own - m) ** 2) AS ssb,
         sum((y - own) ** 2) AS ssw, sum(n) / any_value(total) AS mean_size
  FROM y),
a AS (
  SELECT m, ssb / (k - 1) AS msb, ssw / nullif(total - k, 0) AS msw, (total - mean_size) / (k - 1) AS n0 FROM v),
s AS (
  SELECT m, greatest(10, least(1e4, CASE WHEN msb > msw THEN n0 * msw / (msb - msw) ELSE 1e4 END)) AS k FROM a),
r AS (SELECT source, (sum(y) + any_value(s.m) * any_value(k)) / (count(*) + any_value(k)) AS rate FROM y, s GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, soft_failed,
       NOT base_failed AND NOT (soft_failed AND coalesce(rate, 0) > 0.5) AS kept
FROM j LEFT JOIN r USING (source)
"""


@query
def op9_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                  special_tokens=True)


@query
def op3_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(table(spark, sf_dir, "documents"))


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


@query
def op8_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op10_shared_prefix_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = ("regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")

ORACLES["op12_ranked_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS.format("text")} AS ts FROM documents WHERE text IS NOT NULL),
q AS (SELECT row_number() OVER () AS q, item_id, {_TERMS.format("text")} AS ts FROM benchmark WHERE text IS NOT NULL),
a AS (SELECT count(*) AS N, sum(len(ts))::BIGINT AS L FROM d WHERE len(ts) > 0),
e AS (SELECT q, item_id, t, count(*) AS c FROM (SELECT q, item_id, unnest(ts) AS t FROM q) GROUP BY ALL),
p AS (SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM e) GROUP BY ALL),
f AS (SELECT t, count(*) AS df FROM p GROUP BY t),
w AS (SELECT t, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM f, a),
m AS (SELECT d, doc_id, 25 + (75 * len(ts) * N) // L AS m FROM d, a WHERE len(ts) > 0),
s AS (
  SELECT q, item_id, d, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM e JOIN w USING (t) JOIN p USING (t) JOIN m USING (d) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
"""


@query
def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


ORACLES["op13_ngram_jaccard_join"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
  FROM documents),
u AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM w),
g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id) AS c,
         concat_ws(' ', w, lead(w, 1) OVER d, lead(w, 2) OVER d, lead(w, 3) OVER d) AS x
  FROM u WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
e AS (SELECT DISTINCT doc_id, x FROM g WHERE i <= greatest(1, c - 3)),
n AS (SELECT w.doc_id, count(e.x) AS n FROM w LEFT JOIN e USING (doc_id) GROUP BY w.doc_id),
t AS (SELECT x, row_number() OVER () AS term FROM e GROUP BY x HAVING count(*) > 1),
p AS (SELECT doc_id, term FROM e JOIN t USING (x)),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM p a JOIN p b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY 1, 2),
h AS (
  SELECT l.a, l.b FROM l JOIN n na ON na.doc_id = l.a JOIN n nb ON nb.doc_id = l.b
  WHERE 100 * l.i >= 85 * (na.n + nb.n - l.i)),
k AS (SELECT a, b FROM h UNION ALL SELECT b, a FROM h),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM n
  UNION SELECT k.a, r.reached FROM r JOIN k ON k.b = r.doc_id),
c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
SELECT n.doc_id, n.n AS n_shingles, c.component_id
FROM n JOIN c USING (doc_id)
"""
