"""One thin query for each operator of this folder, under the production parameters, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bwt, edit_embedding, exact_dedup, minhash, mixing, packing, quality, sharding, suffix_trees, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op2_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt.dedup_bytes(_table(spark, sf_dir, "documents"))


def op3_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_trees.dedup_words(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_copies(_table(spark, sf_dir, "documents"), words=4)


def op7_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_embedding.follow(_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the sampler keeps."""
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).filter("kept")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_bwt": op2_bwt,
    "op3_suffix_trees": op3_suffix_trees,
    "op4_mixing": op4_mixing,
    "op5_warc": op5_warc,
    "op6_minhash": op6_minhash,
    "op7_edit_embedding": op7_edit_embedding,
    "op8_packing": op8_packing,
    "op9_quality": op9_quality,
    "op10_exact_dedup": op10_exact_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op3_suffix_trees": r"""
        WITH w AS (SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
        s AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i, ws FROM w WHERE len(ws) >= 20),
        k AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(ws[i:i + 19], ' ') ORDER BY doc_id, i) AS r FROM s),
        g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM k WHERE r > 1),
        l AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM g GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(l.n, 0) AS n_removed,
               sha256(array_to_string([ws[p] FOR p IN range(1, len(ws) + 1) IF NOT list_contains(coalesce(ps, []), p)], ' ')) AS kept_sha256
        FROM w LEFT JOIN l USING (doc_id)""",
    "op5_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
        g AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY d) ELSE page_id END AS r FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest, CASE WHEN r = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN r <> page_id THEN r END AS refers_to FROM g""",
    "op6_minhash": r"""
        WITH RECURSIVE
        w AS (SELECT doc_id, string_split_regex(trim(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+') AS ws FROM documents),
        n AS (SELECT doc_id, CASE WHEN ws = [''] THEN [] WHEN len(ws) < 4 THEN [len(ws)::VARCHAR || '|' || array_to_string(ws, ' ')]
              ELSE list_distinct([array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)]) END AS s FROM w),
        c AS (SELECT min(doc_id) AS rep, s FROM (SELECT doc_id, list_sort(s) AS s FROM n) WHERE len(s) > 0 GROUP BY s),
        e AS (SELECT rep, unnest(s) AS g FROM c),
        p AS (SELECT a.rep AS x, b.rep AS y, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.rep < b.rep GROUP BY 1, 2),
        l AS (SELECT x, y FROM p JOIN c cx ON cx.rep = x JOIN c cy ON cy.rep = y WHERE 100 * k >= 80 * (len(cx.s) + len(cy.s) - k)),
        b AS (SELECT x AS u, y AS v FROM l UNION ALL SELECT y, x FROM l),
        r(u, v) AS (SELECT rep, rep FROM c UNION SELECT r.u, b.v FROM r JOIN b ON r.v = b.u),
        m AS (SELECT u, min(v) AS component_id FROM r GROUP BY u)
        SELECT n.doc_id, CAST(len(n.s) AS BIGINT) AS n_shingles, coalesce(m.component_id, n.doc_id) AS component_id, n.doc_id = coalesce(m.component_id, n.doc_id) AS kept
        FROM n LEFT JOIN c ON c.s = list_sort(n.s) LEFT JOIN m ON m.u = c.rep""",
    "op10_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t)""",
}
