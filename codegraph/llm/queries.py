"""Registered queries of the training-data operators."""

from __future__ import annotations

from . import bloomlm, chunkstore, decontamination, jaccardjoin, linededup, lshforest, media, mixing, packing, periodicruns, prefixtrie, tokencounts, toxicity
from .common import table


def op1_media_columns(spark, sf_dir):
    return media.store_texts(table(spark, sf_dir, "documents")).drop("tile")


def op2_chunk_store(spark, sf_dir):
    return chunkstore.store_documents(table(spark, sf_dir, "documents"))


def op3_token_counts(spark, sf_dir):
    return tokencounts.count_tokens(table(spark, sf_dir, "documents"))


def op4_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark, sf_dir):
    return bloomlm.score_documents(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark, sf_dir):
    return jaccardjoin.jaccard_components(table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_line_dedup(spark, sf_dir):
    return linededup.line_dedup_digest(table(spark, sf_dir, "documents"))


def op9_hash_prefix_forest(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return lshforest.nearest(vectors, lshforest.query_rows(vectors, 100))


def op10_mixing(spark, sf_dir):
    return mixing.schedule(table(spark, sf_dir, "documents"))


def op11_decontamination(spark, sf_dir):
    return decontamination.contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark, sf_dir):
    return periodicruns.run_digest(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark, sf_dir):
    return prefixtrie.shared_head_nodes(table(spark, sf_dir, "conversations"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


OPERATORS = (op1_media_columns, op2_chunk_store, op3_token_counts, op4_packing, op5_lm_scoring, op6_jaccard_join, op7_toxicity, op8_line_dedup, op9_hash_prefix_forest, op10_mixing, op11_decontamination, op12_periodic_runs, op13_prefix_trie)
QUERIES = {f.__name__: f for f in (*OPERATORS, pipeline)}

#: Exact where SQL can say it: components by links between distinct shingle sets.
ORACLE_SQL = {
    "op6_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
  FROM w),
e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS g FROM s),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS inter FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * inter >= 75 * (na + nb - inter)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS x, b AS y FROM sym UNION SELECT r.x, t.b FROM reach r JOIN sym t ON r.y = t.a)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, least(s.doc_id, coalesce(min(r.y), s.doc_id)) AS component_id
FROM s LEFT JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id, len(s.shingles)""",
    "op11_decontamination": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents),
i AS (
  SELECT item_id::VARCHAR AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM benchmark),
w AS (SELECT DISTINCT item, size, array_to_string(words[k:k + size - 1], ' ') AS win FROM (SELECT item, words, least(len(words), 10) AS size, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS k FROM i WHERE len(words) > 0)),
p AS (SELECT doc_id, size, k, array_to_string(words[k:k + size - 1], ' ') AS win FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS k FROM d, (SELECT DISTINCT size FROM w))),
o AS (SELECT p.doc_id, p.k, p.size, w.item FROM p JOIN w USING (size, win)),
h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS pos FROM o) GROUP BY doc_id),
n AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM o GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op12_periodic_runs": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
h AS (SELECT *, len(words) AS n, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda z, i: xor(z >> 1, 3988292384 * (z & 1)))), 4294967295) AS h FROM d),
p AS (SELECT *, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM h),
w AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN words[1:a] || list_transform(range(a, n), lambda i: words[a + (i - a) % p + 1]) ELSE words END AS words FROM p),
g AS (SELECT r, i, array_to_string(words[i + 1:i + 16], ' ') AS gram FROM (SELECT r, words, unnest(range(0, n - 15)) AS i FROM w WHERE n >= 16)),
e AS (SELECT x.r, x.i, y.i - x.i AS q FROM g x JOIN g y ON x.r = y.r AND x.gram = y.gram AND x.i < y.i),
c AS (SELECT r, q, min(i) AS s, max(i) - min(i) + 16 + q AS size FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS stretch FROM e) GROUP BY r, q, stretch),
u AS (SELECT * FROM c WHERE size >= greatest(24, 3 * q) AND NOT EXISTS (SELECT 1 FROM c b WHERE b.r = c.r AND b.q < c.q AND b.s <= c.s AND b.s + b.size >= c.s + c.size)),
m AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || size || ',' || q || chr(10), '' ORDER BY s, q) AS runs, first({'s': s, 'size': size, 'q': q} ORDER BY size::DOUBLE / q DESC, s, q) AS best FROM u GROUP BY r),
k AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS kept FROM (SELECT r, unnest(words) AS word, unnest(range(0, n)) AS i FROM w) x WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.r = x.r AND x.i >= u.s + u.q AND x.i < u.s + u.size) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.size::BIGINT AS length, best.q::BIGINT AS period, (1000 * best.size // best.q)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM w LEFT JOIN m USING (r) LEFT JOIN k USING (r)""",
    "op13_prefix_trie": r"""
WITH c AS (SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda z, i: xor(z >> 1, 3988292384 * (z & 1)))), 4294967295) % 4 AS h FROM c),
r AS (SELECT h.conv_id, coalesce(d.turns, [])[1:h.h] || h.turns[h.h + 1:] AS turns FROM h LEFT JOIN c d ON d.conv_id = h.conv_id - h.conv_id % 20),
m AS (SELECT conv_id, d, turns[1:d] AS path, len(turns) = d AS ends, CASE WHEN d > 0 THEN len(regexp_extract_all(turns[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM r)),
n AS (SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ends FROM m GROUP BY path, d),
k AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
s AS (SELECT path[1:up] AS path, up AS depth, count(*) FILTER (leaf) AS n_leaves, sum((n_convs - 1) * words) AS saved FROM (SELECT n.*, k.path IS NULL AS leaf, unnest(range(0, n.depth + 1)) AS up FROM n LEFT JOIN k ON k.path = n.path) GROUP BY 1, 2)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s ON s.path = n.path AND s.depth = n.depth LEFT JOIN k ON k.path = n.path LEFT JOIN n p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]""",
}
