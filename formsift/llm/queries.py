"""The operators' queries over the whole given tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formsift.llm import base
from formsift.llm.centroids import centroid_clusters
from formsift.llm.exact_dedup import exact_duplicates
from formsift.llm.hard_negatives import hard_negatives
from formsift.llm.html_main import extract_pages
from formsift.llm.line_dedup import dedup_lines
from formsift.llm.lm_scoring import lm_scores
from formsift.llm.ngram_join import ngram_components
from formsift.llm.packing import pack
from formsift.llm.pii import KINDS, fit_pii, joined, pii_spans
from formsift.llm.quality import fit_quality, quality_scores
from formsift.llm.sentencepiece_scan import sentencepiece_decode, sentencepiece_encode
from formsift.llm.token_counts import token_counts
from formsift.llm.topk import exact_topk

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_duplicates(base.table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents")
    return quality_scores(docs, fit_quality(docs, base.table(spark, sf_dir, "labels")))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents")
    rows = pii_spans(docs, fit_pii(docs))
    counts = (F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in KINDS)
    return rows.select(
        "doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("all").alias("spans")
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(base.table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(base.table(spark, sf_dir, "documents"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(base.table(spark, sf_dir, "embeddings"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(base.table(spark, sf_dir, "pages"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(base.table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(base.table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path(PIECE_BPE)
    encoded = sentencepiece_encode(base.table(spark, sf_dir, "documents"), model)
    # the model writes a space for its own sign, so that sign alone does not come back
    wanted = F.xxhash64(F.translate("text", "\u2581", " ")).alias("wanted")
    rows = sentencepiece_decode(encoded.select("doc_id", "ids", wanted), model)
    return rows.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
        (F.xxhash64("decoded") == F.col("wanted")).alias("round_trip"),
    )


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup_lines(base.table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base.table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", moved.alias("label")))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = centroid_clusters(base.table(spark, sf_dir, "embeddings"))
    return rows.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.col("centroid").cast("binary"), 256).alias("centroid_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_quality, op3_pii, op4_token_counts, op5_ngram_join, op6_exact_topk, op7_html, op8_lm_scoring,
        op9_packing, op10_sentencepiece, op11_line_dedup, op12_hard_negatives, op13_centroids,
    )
}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
FINITE = """vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"""


def lloyd_sql(k: int = 40, rounds: int = 5) -> str:
    """Lloyd's rounds one after the other, a row for each component."""
    parts = [
        f"""e AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE {FINITE} AND len(embedding) = 64
        )""",
        "x AS MATERIALIZED (SELECT vec_id, unnest(v) AS a, generate_subscripts(v, 1) AS i FROM e)",
        f"""c0 AS MATERIALIZED (
            SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS INTEGER) AS cluster, v
            FROM (SELECT * FROM e ORDER BY sha256('2:' || vec_id) LIMIT {k})
        )""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
                SELECT vec_id, cluster, d FROM (
                    SELECT vec_id, cluster, d, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS place
                    FROM (
                        SELECT e.vec_id, c.cluster, CAST(list_sum(list_transform(
                            list_zip(e.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
                        FROM e CROSS JOIN c{r} c
                    )
                ) WHERE place = 1
            )"""
        )
        if r < rounds:
            parts.append(
                f"""c{r + 1} AS MATERIALIZED (
                    SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
                        SELECT cluster, list(f ORDER BY i) AS v FROM (
                            SELECT cluster, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS f FROM (
                                SELECT cluster, i, CAST(sum(a) AS BIGINT) AS s, count(*) AS n
                                FROM x JOIN a{r} USING (vec_id) GROUP BY cluster, i
                            )
                        ) GROUP BY cluster
                    ) m ON m.cluster = c.cluster
                )"""
            )
    return "WITH " + ",\n".join(parts) + f"""
        SELECT vec_id, a.cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.cluster
    """


STRIPPED = "translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = {
    "op13_centroids": lloyd_sql(),
    "op12_hard_negatives": f"""
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
            FROM embeddings WHERE label IS NOT NULL AND {FINITE}
        ), s AS (
            SELECT a.vec_id AS anchor_id, o.vec_id AS vec_id, a.label = o.label AS alike,
                   CAST(list_inner_product(a.v, o.v) AS BIGINT) AS score
            FROM e a JOIN e o ON a.vec_id <> o.vec_id AND len(a.v) = len(o.v)
            WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT * FROM s WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.vec_id AS positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
               s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike
            AND 80 * p.score <= 100 * s.score AND s.score <= p.score
        QUALIFY rank <= 5
    """,
    "op11_line_dedup": f"""
        WITH l AS (
            SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
        ), k AS (
            SELECT *, {STRIPPED} AS line_key FROM l
        ), often AS (
            SELECT line_key, max(doc_id) AS top FROM k WHERE length(line_key) >= 20
            GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
        ), j AS (
            SELECT k.*, coalesce(o.top <> k.doc_id, false) AS gone FROM k LEFT JOIN often o USING (line_key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM j GROUP BY doc_id
    """,
    "op6_exact_topk": """
        WITH e AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 10
    """,
    "op1_exact_dedup": f"""
        WITH t AS (SELECT doc_id, {LOWER} AS txt FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(txt) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY txt)
    """,
}
