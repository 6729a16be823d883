"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (attention_lm, decontaminate, hard_negatives, html_text, jaccard_join, licenses, line_dedup,
                            packing, quality_rules, sharding, toxicity, url_filter, vector_codes)
from ledgerlake.llm.common import documents


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_corpus(documents(spark, sf_dir))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shuffle_into_shards(documents(spark, sf_dir).select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    judged = quality_rules.judge(docs, quality_rules.fit_rules(docs, documents(spark, sf_dir, "labels")))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *[F.col(f"__stats.{c}").alias(c) for c in base], "base_failed", "kept", "rule")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, documents(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select("doc_id", "severity", "p_toxic", "grade", "toxic")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = documents(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, url_filter.listed_urls(pages, tracked_only=False)).select(
        "page_id", "host", "path", "rule", "verdict")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir).select("doc_id", "text", "source"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(documents(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "url", "text", "n_chars")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_table(*vector_codes.encode(documents(spark, sf_dir, "embeddings")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_decontamination": op4_decontamination,
    "op5_sharding": op5_sharding,
    "op6_quality_rules": op6_quality_rules,
    "op7_toxicity": op7_toxicity,
    "op8_url_filter": op8_url_filter,
    "op9_packing": op9_packing,
    "op10_licenses": op10_licenses,
    "op11_html_text": op11_html_text,
    "op12_vector_codes": op12_vector_codes,
    "op13_hard_negatives": op13_hard_negatives,
}

_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP1_SQL = f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM cut),
keyed AS (SELECT *, trim(translate(line, {_FOLD}), {_BLANKS}) AS key FROM line),
shared AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
           GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT k.doc_id, k.pos, k.line, s.owner IS NOT NULL AND s.owner <> k.doc_id AS gone
           FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP3_SQL = f"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_FOLD}),
         '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM cut),
size AS (SELECT c.doc_id, count(s) AS n FROM cut c LEFT JOIN sh USING (doc_id) GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
         GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
         WHERE 100 * i >= 90 * (x.n + y.n - i)),
reach(node, seen) AS (SELECT doc_id, doc_id FROM size UNION SELECT r.node, l.b FROM reach r JOIN link l ON l.a = r.seen)
SELECT doc_id, n AS n_shingles, min(seen) AS component_id FROM size JOIN reach ON node = doc_id GROUP BY 1, 2
"""


def _op8_sql() -> str:
    host = f"translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), {_FOLD})"
    path = "coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '')"
    query = "regexp_extract(url, '^.*?://[^?#]*\\?([^#]*)', 1, 's')"
    whens = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in whens) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in whens) + " END"
    labels = ", ".join(f"'{x}'" for x in url_filter.LISTED_LABELS)
    params = (f"list_sort(list_filter(string_split(coalesce({query}, ''), '&'), lambda p: p <> '' AND NOT "
              f"regexp_matches(p, '^({url_filter.TRACKING})(=|$)')))")
    return f"""
WITH cut AS (SELECT page_id, {host} AS host, {path} AS path, {params} AS params FROM pages),
url AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '')
          || regexp_replace(regexp_replace(path, '/+$', ''), '\\.html?$', '')
          || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canonical FROM cut),
listed AS (SELECT DISTINCT canonical AS c FROM url WHERE list_has_any(string_split(host, '.'), [{labels}]))
SELECT page_id, host, path, {rule} AS rule,
       coalesce({verdict}, CASE WHEN c IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM url LEFT JOIN listed ON canonical = c
"""


# The text of the article element: what the density search has to find on these pages.
OP11_SQL = r"""
WITH cut AS (SELECT page_id, url, coalesce(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '') AS a FROM pages),
plain AS (SELECT page_id, url, regexp_replace(replace(a, '<br>', ' '), '<(?:[^hp/>]|/[^hp>])[^>]*>', '', 'g') AS a FROM cut),
block AS (SELECT page_id, url, list_filter(list_transform(string_split_regex(a, '</?(h1|p)>'),
    lambda b: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      b, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&copy;?', chr(169), 'g'),
      '&middot;?', chr(183), 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda b: b <> '') AS b FROM plain),
whole AS (SELECT page_id, url, array_to_string(b, chr(10) || chr(10)) AS text FROM block)
SELECT page_id, url, text, length(text) AS n_chars FROM whole
"""


def _op12_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """The rounds written out: full scans of every codebook, entry by entry."""
    out = """
WITH v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda c: floor(4096 * c::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
part AS MATERIALIZED (SELECT vec_id, p, x[p * (len(x) // 8) + 1 : (p + 1) * (len(x) // 8)] AS x FROM v, range(8) AS t(p)),
b0 AS MATERIALIZED (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM part
  WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 16)),
"""
    for k in range(rounds + 1):
        out += f"""
a{k} AS MATERIALIZED (SELECT vec_id, p, min({{'d': list_sum(list_transform(list_zip(part.x, b.x),
      lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': b.e}}) AS best FROM part JOIN b{k} b USING (p) GROUP BY vec_id, p),
"""
        if k < rounds:
            out += f"""
s{k} AS (SELECT p, best.e AS e, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM a{k} JOIN part USING (vec_id, p)),
m{k} AS (SELECT p, e, list(c ORDER BY i) AS x FROM (
  SELECT p, e, i, floor(sum(c)::DOUBLE / count(*))::BIGINT AS c FROM s{k} GROUP BY p, e, i) GROUP BY p, e),
b{k + 1} AS MATERIALIZED (SELECT b.p, coalesce(m.x, b.x) AS x, b.e FROM b{k} b LEFT JOIN m{k} m ON m.p = b.p AND m.e = b.e),
"""
    return out + f"""
flat AS (SELECT p, e, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM b{rounds}),
digest AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, i)) AS d FROM flat),
coded AS (SELECT vec_id, string_agg(lower(printf('%02x', best.e::INTEGER)), '' ORDER BY p) AS code,
  sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT d FROM digest) AS codebooks_sha256 FROM coded JOIN v USING (vec_id)
"""


OP13_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    list_dot_product(a.x, b.x) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (SELECT anchor_id, other AS positive_id, score AS ps FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id,
  (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other))::INTEGER AS rank,
  s.other AS negative_id, p.ps::BIGINT AS positive_score, s.score::BIGINT AS negative_score
FROM pos p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.ps <= 100 * s.score AND 100 * s.score <= 100 * p.ps
QUALIFY rank <= 5
"""

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op3_jaccard_join": OP3_SQL,
    "op8_url_filter": _op8_sql(),
    "op11_html_text": OP11_SQL,
    "op12_vector_codes": _op12_sql(),
    "op13_hard_negatives": OP13_SQL,
}
