"""Registered queries of the subpackage: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utxoflow.llm import (bpe, centroids, divergence, exact_dedup, jaccard, langid, license_scan, packing, pii, quality_gbt,
                           quality_rules, secret_scan, warc)
from utxoflow.llm.common import crc_mod, table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 4) == 2
    out = langid.predict(docs, langid.learn(docs.filter(~held)), held_out=held)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans"), 256).alias("base_sha256"), "spans",
                      "n_random")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", F.col("llr").alias("llr"))


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archive_pages(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_quality_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = crc_mod(F.col("doc_id"), 5) == 0
    out = quality_gbt.score(docs, quality_gbt.fit(docs, labels, learn=~held), held_out=held)
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = pii.scan(docs, pii.fit(docs))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base_spans"), 256).alias("base_sha256"), "spans")


def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def _clustering_sql(rounds: int = 3) -> str:
    parts = [r"""
        WITH e AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS xs
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        v AS MATERIALIZED (SELECT r, unnest(range(64)) AS dim, unnest(xs) AS x FROM e),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, xs) - 1 AS c, unnest(range(64)) AS dim, unnest(xs) AS x
            FROM (SELECT sha256('1:' || vec_id) AS h, xs FROM e WHERE vec_id IS NOT NULL ORDER BY h, xs LIMIT 16))"""]
    for n in range(rounds + 1):
        parts.append(f"""
        a{n} AS MATERIALIZED (
            SELECT r, CAST(min(d * 16 + c) % 16 AS INTEGER) AS c, CAST(min(d * 16 + c) // 16 AS BIGINT) AS d
            FROM (SELECT v.r, c.c, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{n} AS c USING (dim) GROUP BY v.r, c.c)
            GROUP BY r)""")
        if n < rounds:
            parts.append(f"""
        c{n + 1} AS MATERIALIZED (
            SELECT c.c, c.dim, coalesce(CAST((m.s - ((m.s % m.n) + m.n) % m.n) // m.n AS BIGINT), c.x) AS x
            FROM c{n} AS c LEFT JOIN (SELECT a.c, v.dim, sum(v.x) AS s, count(*) AS n FROM a{n} AS a JOIN v USING (r) GROUP BY ALL) AS m
            USING (c, dim))""")
    return ",".join(parts) + f"""
        SELECT e.vec_id, a.c AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.sha AS centroid_sha256
        FROM a{rounds} AS a JOIN e USING (r)
        JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY dim)) AS sha FROM c{rounds} GROUP BY c) AS h ON h.c = a.c"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_license_scan, op2_packing, op3_language_id, op4_secret_scan, op5_jaccard_join, op6_exact_dedup, op7_bpe,
    op8_quality_rules, op9_warc_revisits, op10_quality_gbt, op11_pii, op12_divergence_audit,
    op13_centroid_clustering)}

ORACLE: dict[str, str] = {
    "op12_divergence_audit": r"""
        WITH d AS MATERIALIZED (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
            FROM documents),
        t AS (SELECT r, lang, source, unnest(ws) AS term FROM d),
        kept AS MATERIALIZED (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
        n AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
        g AS (SELECT DISTINCT lang, source FROM d),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        total AS (SELECT lang, source, sum(n) AS total FROM n GROUP BY ALL),
        p AS MATERIALIZED (
            SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n,
                   1 + CAST(1000000000 AS HUGEINT) * (coalesce(n.n, 0) + 1) // (coalesce(total.total, 0) + v.v) AS p
            FROM g JOIN v USING (lang) JOIN kept AS k USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term
            LEFT JOIN total ON total.lang = g.lang AND total.source = g.source),
        q AS (
            SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (sum(n) + 1) // (sum(sum(n)) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)) AS q
            FROM n GROUP BY lang, term),
        pair AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(pair.value, 0) AS BIGINT) AS value
            FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
    "op13_centroid_clustering": _clustering_sql(),
    "op5_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS ws
            FROM documents),
        starts AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) AS i FROM w),
        s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle FROM starts),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        both_ AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_n
            FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        link AS (
            SELECT x, y FROM both_ JOIN n AS p ON p.doc_id = x JOIN n AS q ON q.doc_id = y
            WHERE 100 * both_n >= 75 * (p.n + q.n - both_n)),
        reach AS (
            SELECT doc_id AS x, doc_id AS y FROM w
            UNION
            SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.y) AS component_id
        FROM w LEFT JOIN n USING (doc_id) JOIN reach ON reach.x = w.doc_id GROUP BY w.doc_id, n.n""",
    "op6_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
            FROM documents),
        g AS (
            SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
                   first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id
            FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    "op9_warc_revisits": r"""
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS original
            FROM pages),
        r AS (SELECT *, payload_bytes >= 1000 AND page_id <> original AS again FROM p)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN original END AS refers_to
        FROM r""",
}
