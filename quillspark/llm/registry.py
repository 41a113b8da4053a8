"""One query for each operator, over its whole table and with the parameters for production, and the SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm import decontaminate, divergence, langid, lexical, licenses, line_dedup, phrases, pieces, pii, sharding, simhash, telephony, toxicity
from quillspark.llm.common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), pii.KEY)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.judge_lines(table(spark, sf_dir, "documents")).select("doc_id", "line_no", "group_doc", "group_line", "kept")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telephony.store_as_audio(table(spark, sf_dir, "documents"), keep_media=False)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), keep_ids=False)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_license_scan, op2_pii_pseudonyms, op3_line_dedup, op4_decontamination, op5_simhash_dedup, op6_toxicity, op7_telephony,
        op8_substring_dedup, op9_sentencepiece, op10_language_id, op11_sharding, op12_source_divergence,
        op13_lexical_search,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": licenses.scan_sql(), "op12_source_divergence": divergence.audit_sql(), "op13_lexical_search": lexical.rank_sql()}
