"""The registered queries of this subpackage, with their parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import embedding_dedup, language_id, mixing, ngram_join, packing, quality_rules, shared, substring_dedup, token_counts, token_output, url_filter


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_records(spark, sf_dir):
    return token_output.token_records(_table(spark, sf_dir, "documents"), _vocabulary(), end_id=2)


def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), _vocabulary(), limit=512)


def op3_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return language_id.languages(docs, language_id.train(docs))


def op4_packing(spark, sf_dir):
    return packing.packed(_table(spark, sf_dir, "documents"), _vocabulary(), length=1024, end_id=0)


def op5_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"), policy="v1")


def quality_ablation(spark, sf_dir):
    """What each rule of two policies rejects, alone or at all, from one stored ledger."""
    book = shared.staged(quality_rules.ledger(_table(spark, sf_dir, "documents")), "quality-ledger")
    each = [quality_rules.ablation(book, policy).withColumn("policy", F.lit(policy)) for policy in ("v1", "v1_lenient")]
    return each[0].unionByName(each[1])


def op6_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_classes(_table(spark, sf_dir, "documents"))


def op7_mixing(spark, sf_dir):
    return mixing.mixed(_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2).drop("times", "rank")


def op8_embedding_dedup(spark, sf_dir):
    return embedding_dedup.linked(_table(spark, sf_dir, "embeddings"), threshold=0.95)


#: The rules of op9.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op9_url_filter(spark, sf_dir):
    return url_filter.url_verdicts(_table(spark, sf_dir, "pages"), URL_RULES)


def op10_substring_dedup(spark, sf_dir):
    return substring_dedup.deduplicated(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_token_records, op2_token_counts, op3_language_id, op4_packing, op5_quality_rules, op6_ngram_join, op7_mixing, op8_embedding_dedup, op9_url_filter, op10_substring_dedup, quality_ablation)
}

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_BARE = r"regexp_replace({}, '[\x20\x09-\x0D]+', '', 'g')"

ORACLE: dict[str, str] = {
    "op5_quality_rules": rf"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
p AS (SELECT r, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS g FROM w, unnest(range(1, len(ws) - 1)) AS u(i)),
q AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM p),
h AS (SELECT r, count(DISTINCT i + k) AS n FROM q, unnest([0, 1, 2]) AS v(k) WHERE c > 1 GROUP BY r),
m AS (
  SELECT doc_id, len(ws) AS n_words, length({_BARE.format("t")}) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: {_BARE.format("x")} <> '') AS ls, coalesce(h.n, 0) AS n_repeat_words
  FROM w LEFT JOIN h USING (r)),
b AS (
  SELECT *, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
f AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (n_words > 200000)::BIGINT
    + 8 * (word_chars < 2 * n_words)::BIGINT + 16 * (word_chars > 15 * n_words)::BIGINT
    + 32 * (10 * n_symbols > 3 * n_words)::BIGINT + 64 * (10 * n_dup_lines > 3 * n_lines)::BIGINT AS failed_bits FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_bits = 0 AS kept, failed_bits FROM f""",
    "op9_url_filter": r"""
WITH s AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM s),
r(rule, verdict) AS (VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')),
j AS (
  SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict FROM h JOIN r
  ON (host = string_split(rule, '/')[1] OR ends_with(host, '.' || string_split(rule, '/')[1]))
    AND starts_with(path, substr(rule, strpos(rule, '/'))) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN j USING (page_id)""",
    "op7_mixing": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, len({_WORDS}) AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT AS draw FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE / count(*)::DOUBLE AS mean FROM d GROUP BY source),
w AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w, 2 * source_size AS cap FROM s),
o AS (
  SELECT *, row_number() OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST) AS k,
    (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level FROM w
  WINDOW b AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a AS (SELECT min(k) AS k0, arg_min(level, k) AS level0 FROM o WHERE level * w < cap),
t AS (
  SELECT source, source_size, mean, CASE WHEN k0 IS NULL OR k < k0 THEN cap::DOUBLE ELSE level0 * w END AS target FROM o, a),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies FROM t),
p AS (
  SELECT d.*, g.source_size, g.target, g.copies, g.target - g.copies * g.source_size AS need,
    (d.draw::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u,
    least(2::DOUBLE, greatest(0.5::DOUBLE, CASE WHEN mean > 0 THEN d.size::DOUBLE / mean ELSE 1::DOUBLE END)) AS odds
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
q AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY u / (1 - u) / odds) AS upto FROM p)
SELECT doc_id, size, source_size, target,
  (size * (copies + CASE WHEN need > 0 AND upto - size / 2.0::DOUBLE <= need THEN 1 ELSE 0 END))::BIGINT AS taken FROM q""",
    "op8_embedding_dedup": r"""
WITH RECURSIVE n AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
v AS (SELECT * FROM n WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
c AS (SELECT vec_id AS node, vec_id AS top FROM v UNION SELECT l.b, c.top FROM c JOIN l ON c.node = l.a WHERE c.top < l.b),
m AS (SELECT node, min(top) AS component_id FROM c GROUP BY node),
k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, vec_id = coalesce(component_id, vec_id) AS kept
FROM n LEFT JOIN m ON vec_id = node LEFT JOIN k ON vec_id = a""",
}

_RULES = ", ".join(f"('{name}', {1 << k})" for k, (name, _) in enumerate(quality_rules.RULES))
ORACLE["quality_ablation"] = (
    ORACLE["op5_quality_rules"].partition("SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_bits = 0")[0].rstrip()
    + f""",
r(rule, bit) AS (VALUES {_RULES}), y(policy, whole) AS (VALUES ('v1', 127), ('v1_lenient', 27)),
z AS (SELECT policy, rule, bit, failed_bits & whole AS bits FROM f, r, y WHERE bit & whole <> 0)
SELECT policy, rule, count(*) FILTER (bits & bit <> 0) AS failing, count(*) FILTER (bits = bit) AS only_this, count(*) FILTER (bits & ~bit = 0) AS kept_without, bit_or(bits)::BIGINT AS seen_bits FROM z GROUP BY policy, rule"""
)
