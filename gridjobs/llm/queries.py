"""The registered queries of this subpackage: each applies its operator to a whole table. `ORACLES` holds their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ball_kmeans, bpe, ctw, html_text, itq_dedup, ngram_join, packing, quality_mil, repair_ids, toxicity_knn, whitening
from .common import held_out, shared_dir, table
from .sharding import assign_shards
from .topk import exact_top_k

QUALITY_AT, TOXIC_AT = 0.3, 0.5


def op1_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality_mil.score_quality(docs, quality_mil.learn(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= QUALITY_AT).cast("int").alias("predicted"), "passage")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 7, 2))


def op4_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, terms = toxicity_knn.learn_with(docs, table(spark, sf_dir, "labels"))
    out = toxicity_knn.score_terms(terms, model)
    return out.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"), "nearest")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign_shards(table(spark, sf_dir, "documents"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op7_itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    return packing.pack(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op11_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_kmeans.cluster(table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    repair_ids.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), 2)
    return repair_ids.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_mil, op2_bpe, op3_ctw, op4_toxicity_knn, op5_sharding, op6_ngram_join, op7_itq_dedup, op8_exact_topk, op9_packing, op10_html_text,
        op11_ball_kmeans, op12_whitening, op13_repair_ids,
    )
}


def kmeans_sql(k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2) -> str:
    """Every round of k-means in SQL: all distances, the least of each vector (ties: the smaller number), floors of the means."""
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT c, e FROM (SELECT row_number() OVER (ORDER BY sha256(concat('{seed}:', vec_id)), e) - 1 AS c, e FROM v WHERE vec_id IS NOT NULL) WHERE c < {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, min(CAST(list_dot_product(v.e, v.e) - 2 * list_dot_product(v.e, c.e) + list_dot_product(c.e, c.e) AS BIGINT) * {k} + c) AS least FROM v CROSS JOIN c{i} c GROUP BY r)""")
        if i < rounds:
            parts.append(f"""s{i} AS (SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT least % {k} AS c, unnest(e) AS x, unnest(range({dim})) AS i FROM a{i} JOIN v USING (r)) GROUP BY c, i)""")
            parts.append(f"""m{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS e FROM s{i} GROUP BY c)""")
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m{i}.e, c{i}.e) AS e FROM c{i} LEFT JOIN m{i} USING (c))""")
    return f"""WITH {", ".join(parts)},
f AS (SELECT r, CAST(least % {k} AS INT) AS c, least // {k} AS distance FROM a{rounds}), t AS (SELECT c, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM f GROUP BY c)
SELECT vec_id, f.c AS cluster, distance, cluster_inertia, (SELECT CAST(sum(distance) AS BIGINT) FROM f) AS inertia,
  sha256(array_to_string(list_transform(k.e, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM f JOIN v USING (r) JOIN t ON t.c = f.c JOIN c{rounds} k ON k.c = f.c"""


ORACLES: dict[str, str] = {
    "op7_itq_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
), u AS (
  SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), r AS (
  SELECT vec_id, vec_id AS root FROM v UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.vec_id
), c AS (
  SELECT vec_id, min(root) AS component_id FROM r GROUP BY vec_id
)
SELECT c.vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, component_id, c.vec_id = component_id AS kept FROM c
""",
    "op8_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM s
)
SELECT query_id, CAST(rk AS INT) AS rank, vec_id, score FROM r WHERE rk <= 20
""",
    "op11_ball_kmeans": kmeans_sql(),
}
