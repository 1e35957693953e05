"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import crf_quality, embedding_dedup, exact_dedup, lbl_lm, mixing, packing, pii, prefix_trie, quality_rules, simhash, token_alignment, token_counts, warc


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, count_col="n_replaced")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))


def op4_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(_table(spark, sf_dir, "documents"))


def op7_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return crf_quality.quality_scores(docs, crf_quality.fit_field(docs, _table(spark, sf_dir, "labels")))


def op9_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl_lm.language_scores(_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations")).drop("node_key")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_source_mixing, op2_feistel_pii, op3_token_counts, op4_warc_bundles, op5_harmonic_packing, op6_quality_rules,
              op7_simhash_golay, op8_crf_quality, op9_rotation_codes, op10_log_bilinear, op11_token_alignment, op12_prefix_trie, op13_exact_dedup)
}

ORACLE_SQL: dict[str, str] = {
    "op1_source_mixing": r"""
WITH d AS (
  SELECT doc_id, source, md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
             row_number() OVER (ORDER BY source NULLS LAST) AS pos, 3 * source_size AS cap FROM s),
r AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER l, 0) AS room,
             sum(weight) OVER () - coalesce(sum(weight) OVER l, 0) AS share
      FROM w WINDOW l AS (ORDER BY CAST(cap AS DOUBLE) / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, CAST(cap AS DOUBLE) * share <= CAST(room AS DOUBLE) * weight AS capped FROM r),
f AS (SELECT CAST(room AS DOUBLE) AS room, share FROM c WHERE NOT capped ORDER BY CAST(cap AS DOUBLE) / weight, pos LIMIT 1),
t AS (SELECT source, source_size,
             CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE (SELECT room / share FROM f) * weight END AS target FROM c),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(floor(target) / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
g AS (SELECT d.source, k, sum(size) AS words FROM d GROUP BY ALL),
p AS (SELECT g.source, k, words, sum(words) OVER (PARTITION BY g.source ORDER BY k) AS upto,
             CAST(floor(target) AS BIGINT) - epochs * source_size AS rest
      FROM g JOIN e ON g.source IS NOT DISTINCT FROM e.source)
SELECT d.doc_id, d.size, e.source_size, e.target,
       CAST(e.epochs * d.size + CASE WHEN p.upto <= p.rest THEN d.size
         WHEN p.upto - p.words < p.rest THEN floor(CAST(d.size AS DOUBLE) * (p.rest - p.upto + p.words) / p.words) ELSE 0 END AS BIGINT) AS taken
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.k = p.k
""",
    # every pair of a label: for tables of some thousand vectors
    "op9_rotation_codes": r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS node, vec_id AS root FROM embeddings UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.node WHERE r.root < p.b),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node), n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN c ON c.node = vec_id LEFT JOIN n ON n.a = vec_id
""",
    "op4_warc_bundles": r"""
WITH b AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS hex FROM b),
q AS (SELECT page_id, n, hex, list_reduce(list_prepend(CAST(0 AS HUGEINT), [CAST(instr('0123456789abcdef', c) - 1 AS HUGEINT) FOR c IN string_split(hex[1:20], '')]), lambda a, x: a * 16 + x) AS hi,
             list_reduce(list_prepend(CAST(0 AS HUGEINT), [CAST(instr('0123456789abcdef', c) - 1 AS HUGEINT) FOR c IN string_split(hex[21:40], '')]), lambda a, x: a * 16 + x) AS lo FROM h),
r AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM q)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((hi >> (75 - 5 * i)) & 31 AS INT) + 1, 1) FOR i IN range(16)], '')
       || array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((lo >> (75 - 5 * i)) & 31 AS INT) + 1, 1) FOR i IN range(16)], '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM r
""",
    # every pair of a node and one below it in some conversation: for tables of some thousand turns
    "op12_prefix_trie": r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT) FOR i IN range(8)]), lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, t.n, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.n <= h
  UNION ALL SELECT c.conv_id, t.n, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.n > h),
p AS (
  SELECT conv_id, row_number() OVER o AS depth, length(text) AS n_chars,
         string_agg(CAST(length(role) AS VARCHAR) || ':' || CAST(length(text) AS VARCHAR) || ':' || role || text, '') OVER o AS path
  FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
m AS (SELECT path, depth, min(n_chars) AS n_chars, min(conv_id) AS conv_id, count(*) AS n_convs FROM p GROUP BY path, depth),
k AS (SELECT DISTINCT a.path, a.depth, b.path AS parent FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.depth = b.depth + 1),
n AS (SELECT m.*, k.parent, (SELECT count(*) FROM k AS x WHERE x.parent = m.path AND x.depth = m.depth + 1) AS n_children FROM m LEFT JOIN k USING (path, depth)),
s AS (SELECT DISTINCT a.path AS top, a.depth AS top_depth, b.path, b.depth FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
u AS (SELECT top, top_depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * n_chars) AS saved FROM s JOIN n USING (path, depth) GROUP BY ALL),
l AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
e AS (SELECT path, depth, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM p JOIN l USING (conv_id, depth) GROUP BY path, depth)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs, CAST(n.n_children AS BIGINT) AS n_children,
       CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM n JOIN u ON u.top = n.path AND u.top_depth = n.depth LEFT JOIN m AS up ON up.path = n.parent AND up.depth = n.depth - 1 LEFT JOIN e ON e.path = n.path AND e.depth = n.depth
""",
    "op13_exact_dedup": r"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d
""",
}
