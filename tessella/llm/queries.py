"""The registered queries of the training-data operators, one ``opN_<name>`` each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import brown, bytebpe, licences, media, merkle, packing, periods, quality, simhash, suffixes, toxicity, urls, warc


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _crc(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary"))


def _tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: The rules of the URL query: what they say, and host with path.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op1_url_model_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(_read(spark, sf_dir, "pages"), URL_RULES)


def op2_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = brown.score_documents(docs, train=_crc(F.col("doc_id")) % 10 != 0)
    return scored.withColumn("held_out", F.coalesce(_crc(F.col("doc_id")) % 10 == 0, F.lit(False))).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return bytebpe.round_trip(docs, _tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).select("doc_id", "bpe.*")


def op4_licence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan(docs).select("doc_id", "licence.*")


def op5_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    classifier = toxicity.fit(docs, _read(spark, sf_dir, "labels"), usable=lambda i: _crc(i) % 3 != 1)
    scored = toxicity.score(docs, classifier)
    return scored.select("doc_id", F.coalesce(_crc(F.col("doc_id")) % 3 == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"), _tokenizer_file("byte_bpe_50k.json"))


def op7_signature_sniffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return media.digest_column(media.store_column(docs)).select("doc_id", "digest.*")


def op8_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.measure_quality(docs).select("doc_id", "quality.*")


def op9_transaction_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return warc.captures(warc.round_trip(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op11_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.cut_repeats(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", F.sha2("cut.kept", 256).alias("kept_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, upper = _read(spark, sf_dir, "documents"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return merkle.manifest(docs, changed=_crc(F.col("doc_id")) % 3 == 0, change=F.translate("text", upper, upper.lower()))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, key = _read(spark, sf_dir, "documents").select("doc_id", "text"), F.col("doc_id")
    docs = docs.withColumn("text", F.when(_crc(key) % 10 == 0, periods.looped(F.col("text"), key)).otherwise(F.col("text")))
    return periods.measure_runs(docs).select("doc_id", "runs.*")


_WARC_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_model_ratio": op1_url_model_ratio,
        "op2_brown_classes": op2_brown_classes,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_licence_sentences": op4_licence_sentences,
        "op5_noisy_channel_toxicity": op5_noisy_channel_toxicity,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_signature_sniffing": op7_signature_sniffing,
        "op8_repetition_coverage": op8_repetition_coverage,
        "op9_transaction_assembly": op9_transaction_assembly,
        "op10_simhash_variants": op10_simhash_variants,
        "op11_suffix_repeats": op11_suffix_repeats,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_licence_sentences": licences.scan_sql(), "op9_transaction_assembly": _WARC_SQL, "op11_suffix_repeats": suffixes.cut_sql(), "op12_merkle_manifest": merkle.manifest_sql()}
