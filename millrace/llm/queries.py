"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from millrace.llm import (
    exact_dedup, id_files, mixing, multi_index, packing, perspectives, pii, quality, spelling, toxicity, url_filter, vector_links, weighted_minhash)
from millrace.llm.registry import query, table


@query("op1_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW same AS (PARTITION BY t)""")
def op1(spark, folder):
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


@query("op10_mix_sources", """
    WITH d AS (
      SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
    q AS (SELECT doc_id, pow(2.0, 2 * avg(quality) - 1) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
    k AS (
      SELECT d.*, -ln((CAST(('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null:' || d.size)), 1, 12)) AS BIGINT) + 0.5) / pow(2.0, 48))
             / coalesce(quality, 1.0) AS key
      FROM d LEFT JOIN q ON d.doc_id = q.doc_id),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0 * sum(size)::DOUBLE AS cap FROM d GROUP BY source),
    w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM s),
    c AS (SELECT DISTINCT cap / weight AS r FROM w),
    l AS (SELECT r, ((SELECT sum(source_size) FROM s)::DOUBLE * 1.5 - coalesce((SELECT sum(cap) FROM w WHERE cap / weight < r), 0))
             / (SELECT sum(weight) FROM w WHERE cap / weight >= r) AS level FROM c),
    g AS (SELECT source, source_size, least(cap, weight * (SELECT level FROM l WHERE level <= r ORDER BY r LIMIT 1)) AS target FROM w),
    e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM g),
    f AS (
      SELECT k.doc_id, k.source, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
             sum(k.size) OVER (PARTITION BY k.source ORDER BY key, k.doc_id, k.size ROWS UNBOUNDED PRECEDING) AS upto
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
    SELECT doc_id, size, source_size, target, CAST(size * n AS BIGINT) AS taken, CAST(n AS BIGINT) AS copies, source
    FROM (SELECT *, epochs + CASE WHEN upto <= rest OR (upto - size < rest AND rest - (upto - size) >= upto - rest) THEN 1 ELSE 0 END AS n FROM f)""")
def op10(spark, folder):
    return mixing.mixture(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op2_pii", pii.sql())
def op2(spark, folder):
    return pii.digest(table(spark, folder, "documents"))


@query("op5_pack")
def op5(spark, folder):
    return packing.pack(table(spark, folder, "documents"))


@query("op6_id_files")
def op6(spark, folder):
    return id_files.write_and_read(table(spark, folder, "documents"))


@query("op4_perspectives", perspectives.SQL)
def op4(spark, folder):
    return perspectives.perspectives(table(spark, folder, "conversations"))


@query("op9_toxicity")
def op9(spark, folder):
    return toxicity.severity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_quality")
def op3(spark, folder):
    return quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("tie")


@query("op7_vector_links")
def op7(spark, folder):
    return vector_links.link(table(spark, folder, "embeddings"))


@query("op8_weighted_minhash")
def op8(spark, folder):
    return weighted_minhash.near_dedup(table(spark, folder, "documents"))


@query("op11_spelling_variants", spelling.SQL)
def op11(spark, folder):
    return spelling.spelling_variants(table(spark, folder, "documents"))


@query("op12_url_filter")
def op12(spark, folder):
    return url_filter.judge(table(spark, folder, "pages").select("page_id", "url"))


@query("op13_hard_negatives", multi_index.SQL)
def op13(spark, folder):
    return multi_index.mined(table(spark, folder, "embeddings"))
