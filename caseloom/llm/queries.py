"""The registered queries of this subpackage, and SQL where it can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytepairs import decode_ids, encode_texts, read_ranks
from .common import table
from .decontam import contaminated
from .divergence import audit_sources
from .html_template import extract_pages
from .jaccard import jaccard_components
from .licenses import scan_licenses
from .mixing import mix_sources
from .neighbours import nearest
from .resampling import resample
from .secrets import secret_report
from .substrings import dedup_report
from .tokens import token_counts, unigram_scores
from .toxicity import held_out, score_toxicity, train_toxicity


def op1_html_template(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(spark, table(spark, folder, "pages"))


def op2_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return nearest(spark, rows, rows.where("vec_id % 100 = 0"))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), unigram_scores())


def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(spark, table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_report(spark, table(spark, folder, "documents"))


def op7_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(spark, table(spark, folder, "documents"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_report(spark, table(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = train_toxicity(docs, table(spark, folder, "labels"))
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(spark, table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of each text's token ids and of the bytes they decode to."""
    import public_tokenizers

    ranks = read_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = encode_texts(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return decode_ids(encoded, ranks).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return audit_sources(spark, table(spark, folder, "documents"))


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample(spark, table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def registered() -> dict:
    """The operators over their whole tables, with production parameters."""
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
