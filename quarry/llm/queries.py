"""The registered queries of this subpackage, one per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import alignment, attention, html, langid, mixing, packing, pii, quality, resampling, simhash, substring, topk, toxicity
from .common import read_table
from .registry import REGISTRY, register  # noqa: F401


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@register("op3_best_fit_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


@register("op7_host_quality_rules", quality.oracle_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rows(read_table(spark, sf_dir, "documents"))


@register("op9_branch_and_bound_topk", topk.oracle_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


@register("op6_factorization_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op2_ecoc_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(read_table(spark, sf_dir, "documents"))


@register("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@register("op8_count_min_substring_dedup", substring.oracle_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removal_rows(read_table(spark, sf_dir, "documents"))


@register("op5_attention_lm_scoring")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.score(read_table(spark, sf_dir, "documents"), tokenizer_path())


@register("op1_wrapper_html_extraction")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(read_table(spark, sf_dir, "pages"))


@register("op10_proportional_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_rows(read_table(spark, sf_dir, "documents"))


@register("op11_importance_resampling", resampling.oracle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return alignment.align(read_table(spark, sf_dir, "documents"), tokenizer_path(),
                           public_tokenizers.path("piece_bpe_32k.model"))


@register("op13_skip_chain_pii")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read_table(spark, sf_dir, "documents"))
