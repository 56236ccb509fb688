"""Registered queries of the training-data operators and their DuckDB SQL.

Each ``opN_`` query applies its operator with production parameters to its
whole table and derives the contract's columns from the operator's output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riverbed.llm import (bpe, decontam, fingerprints, langid, licences, minhash, mixing, packing, ranked, secrets,
                          substring_dedup, topk, whitening)

VOCABULARY, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after every repeated 35-word window is gone."""
    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five highest inner products of every fiftieth vector against all others."""
    vectors = topk.quantised(_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows of 2,048 token ids."""
    return packing.pack_tokens(_table(spark, sf_dir, "documents"), VOCABULARY, PATTERN)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.digest(secrets.find_secrets(_table(spark, sf_dir, "documents")))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence passages of every document."""
    return licences.find_licences(_table(spark, sf_dir, "documents"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes they decode to, as hashes."""
    out = bpe.encode(_table(spark, sf_dir, "documents"), VOCABULARY, PATTERN, with_ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.fingerprint_documents(_table(spark, sf_dir, "documents"), spans=True)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all sources takes of every document."""
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("copies")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components at four-word shingles and similarity 0.8."""
    out = minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first 32 whitened components."""
    out = whitening.whiten(_table(spark, sf_dir, "embeddings"), k=32)
    return out.withColumn("deviation", out["deviation"].cast("long"))


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty best documents of every benchmark item."""
    return ranked.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages of ten words in every document."""
    return decontam.digest(decontam.mark(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10))


_OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
n AS (SELECT row_number() OVER () AS rid, doc_id, w FROM d),
p AS (SELECT rid, unnest(range(1, len(w) - 33)) AS i FROM n WHERE len(w) >= 35),
g AS (SELECT p.rid, p.i, md5(array_to_string(list_slice(n.w, p.i, p.i + 34), ' ')) AS h FROM p JOIN n USING (rid)),
r AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY h) AS c FROM g) WHERE c > 1),
c AS (SELECT DISTINCT rid, i + unnest(range(0, 35)) AS j FROM r),
a AS (SELECT rid, list(j) AS gone FROM c GROUP BY rid),
k AS (SELECT n.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
        CASE WHEN gone IS NULL THEN w ELSE
          list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(gone, x[2])),
                         lambda x: x[1]) END AS kept
      FROM n LEFT JOIN a USING (rid))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM k
"""

_OP10_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')))
        END AS g FROM d),
x AS (SELECT rid, unnest(g) AS t FROM s),
i AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM x a JOIN x b ON a.t = b.t AND a.rid < b.rid GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN s p ON p.rid = a JOIN s q ON q.rid = b WHERE 100 * c >= 80 * (len(p.g) + len(q.g) - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT rid AS a, rid AS b FROM s UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT r.a AS rid, min(s.doc_id) AS component_id FROM r JOIN s ON s.rid = r.b GROUP BY 1)
SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM s JOIN m USING (rid)
"""

_OP2_SQL = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % 50 = 0),
s AS (SELECT q.vec_id AS query_id, q.v AS qv, v.vec_id, list_dot_product(q.v, v.v)::BIGINT AS score
  FROM q JOIN v ON q.vec_id <> v.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, qv ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
WHERE rank <= 5
"""

_OP9_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|' || md5(coalesce(text, ''))), 1, 12))::BIGINT::DOUBLE
      + 0.5) / 281474976710656.0 AS u FROM documents),
z AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2 * source_size::DOUBLE AS cap,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1)::INTEGER]::DOUBLE AS w,
    1.5 * sum(source_size::DOUBLE) OVER () AS budget FROM z),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM w WINDOW b AS (ORDER BY cap / w, source COLLATE "C" NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, cap <= w * level AS is_full FROM l),
t AS (SELECT source, source_size, CASE WHEN is_full THEN cap
    ELSE w * (SELECT arg_min(level, cap / w) FROM f WHERE NOT is_full) END AS target FROM f),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS due FROM t),
p AS (SELECT d.doc_id, d.size, d.u, r.source, r.source_size, r.target, floor(due)::BIGINT AS whole, due - floor(due) AS p,
    target - (floor(due)::BIGINT * source_size)::DOUBLE AS need
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
q AS (SELECT *, CASE WHEN p > 0 THEN (u / (1.0 - u)) * ((1.0 - p) / p) END AS q FROM p),
k AS (SELECT *, floor(q / (q + 1.0) * 4294967296.0)::BIGINT AS rnk FROM q),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rnk) AS upto,
    sum(size) OVER (PARTITION BY source, rnk) AS s FROM k)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN p > 0 AND 2 * upto - s <= 2 * need THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
"""

_OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT row_number() OVER () AS qid, item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
t AS (SELECT qid, t, count(*) AS times FROM (SELECT qid, unnest(w) AS t FROM i) GROUP BY ALL),
p AS (SELECT rid, t, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(w) AS t FROM d) SEMI JOIN t USING (t) GROUP BY ALL),
f AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM p, c GROUP BY t, n_docs),
m AS (SELECT rid, doc_id, 100 - 25 + (25 * len(w)::BIGINT * n_docs) // n_terms AS m FROM d, c WHERE len(w) > 0),
s AS (SELECT qid, rid, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM t JOIN f USING (t) JOIN p USING (t) JOIN m USING (rid) GROUP BY ALL),
r AS (SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM s JOIN m USING (rid) JOIN i USING (qid) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""

_OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + 9), ' ') AS t, least(len(w), 10)::BIGINT AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
g AS (SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n),
o AS (SELECT g.rid, g.i, g.n, array_to_string(list_slice(d.w, g.i, g.i + g.n - 1), ' ') AS t FROM g JOIN d USING (rid)),
h AS (SELECT rid, i, n, t FROM o SEMI JOIN p USING (t, n)),
c AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, i + unnest(range(0, n)) AS j FROM h) GROUP BY rid),
k AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM h JOIN p USING (t, n)) WHERE item IS NOT NULL GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN k USING (rid)
"""

QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_topk, op3_packing, op4_secrets, op5_licences, op6_langid, op7_bpe, op8_fingerprints,
    op9_mixing, op10_minhash, op11_whitening, op12_ranked, op13_decontamination)}
ORACLE = {
    "op1_substring_dedup": _OP1_SQL,
    "op2_topk": _OP2_SQL,
    "op9_mixing": _OP9_SQL,
    "op10_minhash": _OP10_SQL,
    "op12_ranked": _OP12_SQL,
    "op13_decontamination": _OP13_SQL,
}
