"""The queries of the training-data operators and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import decontamination, html, jaccard, maxent, mixing, quality, secrets, sharding, tokencounts, warc
from .oracles import oracle_sql  # noqa: F401
from .shared import scratch_path


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_nearest_url_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(_read(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = _read(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"))
    out = sharding.shard_rows(rows, ["doc_id", "text_crc32"], 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_hashed_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score_texts(_read(spark, sf_dir, "documents"))


def op4_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontamination.contamination(_read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "benchmark"), out="f")
    return rows.select(
        "doc_id", "f.n_words", "f.n_hit", F.size("f.items").cast("long").alias("n_items"), F.sha2(F.array_join("f.items", ","), 256).alias("items_sha256"), (F.col("f.n_hit") > 0).alias("contaminated")
    )


def op5_token_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_classes(_read(spark, sf_dir, "documents"))


def op6_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(_read(spark, sf_dir, "pages"), path)
    rows = warc.assemble(warc.read_warc(spark, path, payloads=False))
    field = lambda name: F.col("metadata.fields")[name].cast("long")
    return rows.select(
        field("page-id").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.digest").alias("payload_digest"), F.col("response.type").alias("record_type"), field("refers-to-page-id").alias("refers_to")
    )


def op7_splitting_tree_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's draws are those that the tree dealt to the shards; ``shards`` lists them."""
    rows = mixing.plan(_read(spark, sf_dir, "documents").select("doc_id", "source", "text"), ["doc_id"])
    return rows.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).cast("long").alias("taken"), "row.source", "shards")


#: End of a document: the first id that the vocabulary leaves free.
SEPARATOR = 50256


def op8_separator_scan(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Tokens of each document, counted in flat token files of a published vocabulary (``vocabulary``: the place of its ranks)."""
    import public_tokenizers

    encoder = tokencounts.Bpe(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    manifest = tokencounts.write_token_files(_read(spark, sf_dir, "documents"), scratch_path(spark, "tokens"), encoder, SEPARATOR)
    return tokencounts.counts_by_document(manifest, SEPARATOR).select("doc_id", "n_tokens")


def op9_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the table, the earlier with half its rows: the second scan reads only blobs that the first has not entered in the ledger."""
    docs, ledger = _read(spark, sf_dir, "documents"), scratch_path(spark, "ledger")
    for version in (docs.where(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 2 == 0), docs):
        scanned = secrets.record(version, ledger)
    found = secrets.findings(docs, scanned, ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secrets.RULES]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


def op10_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.score(_read(spark, sf_dir, "documents"), ["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in (op1_nearest_url_differencing, op2_feistel_shards, op3_hashed_maxent_scores, op4_wu_manber_decontamination, op5_token_group_join, op6_warc_transactions, op7_splitting_tree_mix, op8_separator_scan, op9_blob_ledger_secrets, op10_weak_supervision)}
