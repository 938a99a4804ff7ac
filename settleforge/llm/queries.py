"""The registered queries of this subpackage: each operator over its whole table, and the SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import dedup_substrings

    out = dedup_substrings(_table(spark, sf_dir, "documents"), min_words=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    out = dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import filter_urls

    return filter_urls(_table(spark, sf_dir, "pages"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import scan_licenses

    return scan_licenses(_table(spark, sf_dir, "documents")).drop("matches")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge_quality

    return judge_quality(_table(spark, sf_dir, "documents"))


def op8_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .matroska import store_texts

    out = store_texts(_table(spark, sf_dir, "documents"))
    load, media = F.col("payload"), F.col("media")
    return out.select(
        "doc_id", "n_bytes", F.octet_length(load).cast("long").alias("payload_bytes"),
        F.sha2(load, 256).alias("payload_sha256"), F.crc32(F.expr("substring(payload, -32, 32)")).alias("tail_crc32"),
        F.octet_length(media).cast("long").alias("media_bytes"), F.sha2(media, 256).alias("media_sha256"), "feature"
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents

    out = pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity

    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import group_variants

    return group_variants(_table(spark, sf_dir, "documents"), drop_every=31)


def op12_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_lm import score_texts

    return score_texts(_table(spark, sf_dir, "documents"), order=2)


def op13_cobucketed_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .cobucket import bucket_of, rewrite_pair

    sales, lines = _table(spark, sf_dir, "sales"), _table(spark, sf_dir, "sale_lines")
    b = F.coalesce(bucket_of(F.col("sale_id"), 600), F.lit(601))
    item = (F.crc32(F.col("item_id").cast("string").cast("binary")) % 600).cast("int")
    return rewrite_pair(
        sales, lines, "sale_id", F.when(b % 4 == 1, b - 1).otherwise(b), F.coalesce(item, F.lit(0)),
        names=("sales", "sale_lines")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    from . import license_scan, line_dedup, mixing, near_dedup, quality, spelling, substring_dedup, url_filter

    return {
        "op1_substring_dedup": substring_dedup.oracle(),
        "op2_near_dedup": near_dedup.oracle(),
        "op3_line_dedup": line_dedup.oracle(),
        "op4_url_filter": url_filter.oracle(),
        "op5_license_scan": license_scan.oracle(),
        "op6_source_mixing": mixing.oracle(),
        "op7_quality_rules": quality.oracle(),
        "op11_spelling_variants": spelling.oracle(),
    }
