"""The operators' queries over the whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, filter_audit, fingerprints, html_text, ngram_join, packing, periodic_runs, pii, quality, secrets, sharding, token_counts, vector_pairs
from .common import table


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.by_line(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(docs, table(spark, sf_dir, "labels")))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(table(spark, sf_dir, "documents"))


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_pairs.near(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_decontaminate, op2_html_text, op3_pack, op4_token_counts, op5_personal_data, op6_quality, op7_secrets, op8_shards, op9_ngram_join, op10_fingerprints, op11_filter_audit, op12_periodic_runs, op13_near_vectors)}


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": decontaminate.DIGEST_SQL, "op9_ngram_join": ngram_join.CLASSES_SQL, "op11_filter_audit": filter_audit.AUDIT_SQL, "op13_near_vectors": vector_pairs.NEAR_SQL}
