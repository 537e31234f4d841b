"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import bpe, fixity, huffman, licences
from riskloom.llm.caps import near_duplicates
from riskloom.llm.fingerprints import edited_fingerprints
from riskloom.llm.hard_negatives import hard_negatives
from riskloom.llm.jaccard_tree import jaccard_components
from riskloom.llm.lines import drop_repeated_lines
from riskloom.llm.mixing import mix
from riskloom.llm.quality import fit, score
from riskloom.llm.repeats import repeated_spans
from riskloom.llm.whitening import whitened
from riskloom.session import fresh_path, materialise


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"))


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"), shingle=4, percent=85)


def op3_weighted_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(table(spark, folder, "documents"))


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = repeated_spans(table(spark, folder, "documents"), length=200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op5_merkle_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Audit of a replica of the pages' archive in which records were altered and lost by rule:
    of each 97 page ids, record 5 lost the first bracket of its page, and record 7 is not there."""
    archive = materialise(fixity.volumes(table(spark, folder, "pages")), "warc-archive")
    spoilt = F.when(F.col("id") % 97 == 5, F.regexp_replace("record", "\r\n\r\n<", "\r\n\r\n ")).otherwise(F.col("record"))
    replica = archive.where("id % 97 != 7 or id is null").withColumn("record", spoilt)
    return fixity.audit(fixity.leaves(archive), fixity.leaves(replica))


OP5_SQL = """
WITH records AS (
  SELECT page_id // 1024 AS volume, page_id AS id, html,
    'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
    || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'Content-Type: text/html'
    || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages),
placed AS (
  SELECT *, strlen(record) AS length,
    coalesce(sum(strlen(record)) OVER (PARTITION BY volume ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM records)
SELECT CAST(volume AS BIGINT) AS volume, CAST(start AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length, id,
  CASE WHEN id % 97 = 7 THEN 'missing' ELSE 'altered' END AS state
FROM placed WHERE id % 97 = 7 OR (id % 97 = 5 AND contains(record, chr(13) || chr(10) || chr(13) || chr(10) || '<'))
"""


def op6_fair_queue_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).drop("copies")


def op7_cap_filters(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))


def op8_quality_discriminant(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = fit(docs, table(spark, folder, "labels").where(~held_out))
    scored = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_forced_boundary_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    both = bpe.decode(bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), path).drop("text"), path)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_huffman_ids(spark: SparkSession, folder: str) -> DataFrame:
    store = fresh_path(spark, "token-ids")
    huffman.write(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), store, end_id=1)
    return huffman.read(spark, store).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = drop_repeated_lines(table(spark, folder, "documents"), min_documents=3, min_chars=20)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT doc_id, place, line, last IS NOT NULL AND doc_id <> last AS gone FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def op12_cholesky_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened(table(spark, folder, "embeddings"), components=16, scale=64.0)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), anchors=F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT * FROM scores WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.other AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
  n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.alike
  AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_licence_scan,
    op2_jaccard_join,
    op3_weighted_fingerprints,
    op4_suffix_dedup,
    op5_merkle_audit,
    op6_fair_queue_mix,
    op7_cap_filters,
    op8_quality_discriminant,
    op9_forced_boundary_bpe,
    op10_huffman_ids,
    op11_line_dedup,
    op12_cholesky_whitening,
    op13_hard_negatives,
)}

QUERIES["pipeline"] = corpus_pipeline.run

ORACLES: dict[str, str] = {"op1_licence_scan": licences.SQL, "op5_merkle_audit": OP5_SQL, "op11_line_dedup": OP11_SQL,
                           "op13_hard_negatives": OP13_SQL}
