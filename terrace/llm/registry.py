"""Registered queries of the operators, with DuckDB texts where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from terrace.llm import (
    decontam,
    language,
    lexical,
    linededup,
    merkle,
    neardup,
    packing,
    projected,
    quality,
    suffix,
    toxicity,
    vafile,
    warc,
)
from terrace.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return rows.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), root)
    return warc.read_warc(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = linededup.drop_repeated_lines(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents against their manifest, some of them tampered with since."""
    rows = merkle.verified(table(spark, sf_dir, "documents"), {"text": merkle.tampered_text()})
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_quality": op1_quality,
    "op2_top_k": op2_top_k,
    "op3_language": op3_language,
    "op4_decontamination": op4_decontamination,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_near_dedup": op6_near_dedup,
    "op7_warc": op7_warc,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op10_packing": op10_packing,
    "op11_nearest": op11_nearest,
    "op12_lexical": op12_lexical,
    "op13_merkle": op13_merkle,
}

SQL: dict[str, str] = {
    "op2_top_k": """WITH v AS (SELECT DISTINCT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op7_warc": """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
first AS (SELECT digest, min(page_id) AS low FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest,
    CASE WHEN page_id <> low THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id <> low THEN low END AS refers_to
FROM p LEFT JOIN first USING (digest)""",
    "op9_line_dedup": r"""WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k FROM documents),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
hot AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keyed.*, hot.key IS NOT NULL AND doc_id <> hot.last AS gone FROM keyed LEFT JOIN hot USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op12_lexical": r"""WITH cut AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT k, doc_id, term, count(*) AS tf FROM cut GROUP BY ALL),
sizes AS (SELECT k, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY k),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM tf, totals GROUP BY term),
item AS MATERIALIZED (SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT DISTINCT i, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM item),
scored AS (SELECT i, item_id, k, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
    FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (k), totals GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50""",
    "op13_merkle": """WITH RECURSIVE crc AS (SELECT DISTINCT doc_id, xor(4294967295::BIGINT, list_reduce(
        list_prepend(4294967295::BIGINT, [CAST(ascii(c) AS BIGINT) for c in string_split(CAST(doc_id AS VARCHAR), '')]),
        lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) AS crc
    FROM documents WHERE doc_id IS NOT NULL),
held AS (SELECT d.*, CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    ELSE text END AS now FROM documents d LEFT JOIN crc USING (doc_id)),
parts AS (SELECT doc_id, source, text, now,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM held),
leaves AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(now) || ':' || now, '-')) AS claimed FROM parts),
placed AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf, claimed) AS k,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS place FROM leaves),
up AS (SELECT tree, 0 AS height, place, leaf AS digest, n FROM placed
    UNION ALL SELECT tree, height + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (max(n) + 15) // 16
    FROM up WHERE n > 1 GROUP BY tree, height, place // 16),
sides AS (SELECT *, coalesce(string_agg(digest, '') OVER (PARTITION BY tree, height, place // 16 ORDER BY place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER (PARTITION BY tree, height, place // 16 ORDER BY place
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM up),
fold AS (SELECT k, tree, 0 AS height, place, claimed AS cur, '' AS seen FROM placed
    UNION ALL SELECT k, f.tree, f.height + 1, f.place // 16, sha256(l || cur || r), seen || l || r
    FROM fold f JOIN sides s ON f.tree = s.tree AND f.height = s.height AND f.place = s.place WHERE n > 1),
subroots AS (SELECT tree AS place, digest AS subroot FROM up WHERE n = 1),
top AS (SELECT 0 AS height, place, subroot AS digest, count(*) OVER () AS n FROM subroots
    UNION ALL SELECT height + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place)), (max(n) + 15) // 16
    FROM top WHERE n > 1 GROUP BY height, place // 16),
top_sides AS (SELECT *, coalesce(string_agg(digest, '') OVER (PARTITION BY height, place // 16 ORDER BY place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER (PARTITION BY height, place // 16 ORDER BY place
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM top),
top_fold AS (SELECT k, 0 AS height, f.tree AS place, cur, seen FROM fold f JOIN sides s
        ON f.tree = s.tree AND f.height = s.height AND f.place = s.place WHERE s.n = 1
    UNION ALL SELECT k, f.height + 1, f.place // 16, sha256(l || cur || r), seen || l || r
    FROM top_fold f JOIN top_sides s ON f.height = s.height AND f.place = s.place WHERE n > 1),
ends AS (SELECT k, cur, seen FROM top_fold f JOIN top s ON f.height = s.height AND f.place = s.place WHERE n = 1)
SELECT p.doc_id, p.leaf, s.subroot, t.digest AS root, sha256(e.seen) AS proof_sha256, e.cur AS folded_root, e.cur = t.digest AS verified
FROM placed p JOIN ends e USING (k) JOIN subroots s ON s.place = p.tree, (SELECT digest FROM top WHERE n = 1) t""",
}
