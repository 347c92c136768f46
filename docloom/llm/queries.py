"""The operators as named queries over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docloom.llm.common import Scratch
from docloom.llm.exact import exact_groups
from docloom.llm.idfiles import round_trip
from docloom.llm.langid import identify, train
from docloom.llm.merkle import fold, leaf_digest, manifest, proof_digest
from docloom.llm.minhash import near_groups
from docloom.llm.mixing import mix
from docloom.llm.packing import pack
from docloom.llm.quality import quality
from docloom.llm.repeats import remove_repeats
from docloom.llm.syncmers import fingerprints
from docloom.llm.urls import filter_urls
from docloom.llm.warc import dedup_archives
from docloom.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if check:
            CHECKS[name] = check
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query(
    "op7_url_filter",
    r"""
    WITH rules(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
        ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    split AS (
      SELECT page_id,
        translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
      FROM pages),
    ranked AS (
      SELECT s.*, r.*, row_number() OVER (PARTITION BY page_id ORDER BY length(rh) + length(rp) DESC NULLS LAST) AS n
      FROM split s LEFT JOIN rules r
        ON (s.host = r.rh OR ends_with(s.host, '.' || r.rh)) AND starts_with(s.path, r.rp))
    SELECT page_id, host, path, rh || rp AS rule, coalesce(v, 'allow') AS verdict FROM ranked WHERE n = 1
    """,
)
def url_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    return filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op8_mix_sources")
def mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken", "shards")


@query("op9_quality_rules")
def quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_line_words"
    )


@query(
    "op1_exact_dedup",
    r"""
    WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
      doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
    FROM t WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)
    """,
)
def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_groups(table(spark, sf, "documents"))


@query("op4_language_id")
def language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    model = train(docs.where(fold != 2))
    found = identify(docs, model)
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query(
    "op5_warc_revisits",
    """
    WITH t AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM t)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
    FROM f
    """,
)
def warc_revisits(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    records = dedup_archives(pages, Scratch(spark, "warc").path)
    return records.select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query("op6_token_ids")
def token_ids(spark: SparkSession, sf: str) -> DataFrame:
    return round_trip(table(spark, sf, "documents")).drop("ids")


@query("op10_packing")
def packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(table(spark, sf, "documents"))


@query("op3_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_groups(table(spark, sf, "documents"))


@query("op2_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeats(table(spark, sf, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query(
    "op11_merkle_manifest",
    """
    WITH RECURSIVE docs AS (
      SELECT doc_id, coalesce(lang, '') AS g, lang IS NOT NULL AS named, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END AS p1,
        CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS p2,
        n_chars, CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS p4,
        -- The usual CRC-32, bit by bit.
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
          lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) AS crc
      FROM documents),
    parts AS (
      SELECT *, CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS p3,
        n_chars + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END AS changed FROM docs),
    leaves AS (
      SELECT doc_id, g, named, sha256(p1 || p2 || p3 || p4) AS leaf,
        sha256(p1 || p2 || CASE WHEN changed IS NULL THEN '-' ELSE strlen(changed::VARCHAR) || ':' || changed END || p4) AS tampered FROM parts),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY named, g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY named, g) AS n,
        dense_rank() OVER (ORDER BY named, encode(g)) AS t, row_number() OVER () AS k FROM leaves),
    low(t, level, i, n, d) AS (
      SELECT t, 0, r, n, leaf FROM ranked
      UNION ALL
      SELECT t, level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY t, level, i // 2),
    tops AS (SELECT t - 1 AS i, d, count(*) OVER () AS n FROM low WHERE n = 1),
    high(level, i, n, d) AS (
      SELECT 0, i, n, d FROM tops
      UNION ALL
      SELECT level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY level, i // 2),
    nodes AS (
      SELECT t, level, i, n, d FROM low
      UNION ALL
      SELECT 0, level, i, n, d FROM high),
    way(k, t, own, level, i, n, proof, folded) AS (
      SELECT k, t, t - 1, 0, r, n, '', tampered FROM ranked
      UNION ALL
      SELECT k, CASE WHEN w.n = 1 THEN 0 ELSE w.t END, own, CASE WHEN w.n = 1 THEN 0 ELSE w.level + 1 END,
        CASE WHEN w.n = 1 THEN own ELSE w.i // 2 END, CASE WHEN w.n = 1 THEN (SELECT count(*) FROM tops) ELSE (w.n + 1) // 2 END,
        proof || coalesce(s.d, ''),
        CASE WHEN w.n = 1 THEN folded WHEN w.i % 2 = 0 THEN sha256(folded || coalesce(s.d, '')) ELSE sha256(s.d || folded) END
      FROM way w LEFT JOIN nodes s ON s.t = w.t AND s.level = w.level AND s.i = xor(w.i, 1) AND w.n > 1
      WHERE w.t > 0 OR w.n > 1)
    SELECT doc_id, leaf, d.d AS subroot, h.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h.d AS verified
    FROM ranked r JOIN way USING (k) JOIN (SELECT t, d FROM low WHERE n = 1) d ON d.t = r.t CROSS JOIN (SELECT d FROM high WHERE n = 1) h
    WHERE way.t = 0 AND way.n = 1
    """,
)
def merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    parts = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaf = leaf_digest(*parts)
    changed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    parts[3] = F.col("n_chars") + 1
    tampered = F.when(changed, leaf_digest(*parts)).otherwise(leaf)
    rows = manifest(docs, "lang", "doc_id", leaf, keep=[tampered.alias("tampered")]).rows
    folded = fold(F.col("row.tampered"), F.col("path"))
    return rows.select(
        F.col("row.order").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op13_document_fingerprints")
def document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints(table(spark, sf, "documents"))


@query("op12_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whiten(table(spark, sf, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))
