"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as vocabularies
from pyspark.sql import DataFrame, SparkSession, functions as F

from chronoloom.llm import (exact_dedup, merge_replay, minhash, mixing, page_text, phrases, prefix_trie, ptolemaic, quality, rank_array,
                            token_files, topk, toxicity)
from chronoloom.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


@query("op5_exact_dedup", r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
n AS (SELECT doc_id, length(x) AS pts, sha256(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM t),
k AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
      FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY pts DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k""")
def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.dedup(read_table(spark, sf_dir, "documents"), place=F.input_file_name())


@query("op10_mixing")
def op10_mixing(spark, sf_dir):
    return mixing.mix(read_table(spark, sf_dir, "documents"))


@query("op8_minhash", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(d, c) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.d, e.b FROM r JOIN e ON r.c = e.a),
m AS (SELECT d, min(c) AS component_id FROM r GROUP BY d)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN m ON m.d = w.doc_id LEFT JOIN n USING (doc_id)""")
def op8_minhash(spark, sf_dir):
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op3_repeated_phrases", r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - 18, 1))) AS i FROM t),
g AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS h FROM p JOIN t USING (doc_id)),
o AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM g),
r AS (SELECT DISTINCT doc_id, i + unnest(range(0, 20)) AS j FROM o WHERE k > 1),
x AS (SELECT doc_id, ws[j] AS w, j FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS j FROM t)),
y AS (SELECT x.doc_id, string_agg(x.w, ' ' ORDER BY x.j) AS kept, count(*) AS n FROM x ANTI JOIN r ON r.doc_id = x.doc_id AND r.j = x.j GROUP BY 1)
SELECT t.doc_id, len(ws) AS n_words, len(ws) - coalesce(y.n, 0) AS n_removed, sha256(coalesce(y.kept, '')) AS kept_sha256
FROM t LEFT JOIN y USING (doc_id)""")
def op3_repeated_phrases(spark, sf_dir):
    return phrases.repeated_passages(read_table(spark, sf_dir, "documents"))


@query("op9_merge_replay")
def op9_merge_replay(spark, sf_dir):
    return merge_replay.encoded(read_table(spark, sf_dir, "documents"), vocabularies.path("byte_bpe_multi_50k.tiktoken"), vocabularies.PATTERN)


@query("op7_topk", """
WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""")
def op7_topk(spark, sf_dir):
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query("op1_token_files")
def op1_token_files(spark, sf_dir):
    return token_files.tokenized(read_table(spark, sf_dir, "documents"), vocabularies.path("word_bpe_49k.json"))


@query("op4_page_text")
def op4_page_text(spark, sf_dir):
    return page_text.extracted(read_table(spark, sf_dir, "pages"))


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    return toxicity.scored(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op2_quality")
def op2_quality(spark, sf_dir):
    return quality.scored(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).drop("rank")


def _clustering_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds one after the other; a vector is a list of integers."""
    square = "list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    parts = [f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR), q) - 1)::INTEGER AS cluster, q FROM v
  ORDER BY cluster LIMIT {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, vec_id, v.q, cluster, {square} AS distance FROM v CROSS JOIN c{i} c
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1)""")
        if i < rounds:
            parts.append(f"""m{i} AS (SELECT cluster, p, sum(x)::BIGINT AS s, count(*) AS n FROM
  (SELECT cluster, unnest(q) AS x, unnest(range(1, 65)) AS p FROM a{i}) GROUP BY cluster, p),
c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(f.q, c{i}.q) AS q FROM c{i} LEFT JOIN
  (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY p) AS q FROM m{i} GROUP BY cluster) f USING (cluster))""")
    return ",\n".join(parts) + f"""
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c{rounds}.q, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} USING (cluster)"""


@query("op11_ptolemaic", _clustering_sql())
def op11_ptolemaic(spark, sf_dir):
    return ptolemaic.clusters(read_table(spark, sf_dir, "embeddings")).drop("measured")


@query("op12_prefix_trie", """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS f, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''),
    lambda x: ascii(x)::BIGINT), lambda crc, byte: list_reduce([xor(crc, byte)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda u, z: CASE WHEN u % 2 = 1 THEN xor(u // 2, 3988292384) ELSE u // 2 END)), 4294967295) % 9 AS h FROM t),
r AS (SELECT c.conv_id, 0 AS own, p, role, text FROM c JOIN t ON t.conv_id = c.f AND p <= h
  UNION ALL SELECT c.conv_id, 1, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND p > h),
k AS (SELECT conv_id, strlen(text) AS bytes, list(md5(strlen(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY own, p) AS key FROM r
  UNION ALL SELECT conv_id, 0, [] FROM c),
n AS (SELECT key, len(key) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM k GROUP BY key),
kids AS (SELECT key[1:depth - 1] AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
up AS (SELECT n.key[1:i] AS key, (n_convs - 1) * bytes AS worth, (n_children IS NULL)::INTEGER AS leaf
  FROM (SELECT key, n_convs, bytes, unnest(range(0, depth + 1)) AS i FROM n) n LEFT JOIN kids USING (key)),
below AS (SELECT key, sum(worth)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves FROM up GROUP BY key),
ends AS (SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM
  (SELECT conv_id, max_by(key, len(key)) AS key FROM k GROUP BY conv_id) GROUP BY key)
SELECT n.conv_id, n.depth, o.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
  coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM n LEFT JOIN n o ON n.depth > 0 AND o.key = n.key[1:n.depth - 1] LEFT JOIN kids ON kids.key = n.key
JOIN below ON below.key = n.key LEFT JOIN ends ON ends.key = n.key""")
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(read_table(spark, sf_dir, "conversations"))


@query("op13_rank_array")
def op13_rank_array(spark, sf_dir):
    return rank_array.encoded(read_table(spark, sf_dir, "documents"), vocabularies.path("word_bpe_49k.json"))
