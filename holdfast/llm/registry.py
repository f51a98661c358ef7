"""The operators' queries over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import common, decontaminate, hyper_langid, jaccard_join, license_scan, mixing, ordinal_quality, pitman_yor, quality_rules, token_store, toxicity


def _over_documents(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(common.table(spark, sf_dir, "documents"))


def _with_labels(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_contaminated_documents": lambda spark, sf_dir: decontaminate.contaminated_documents(
        common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")
    ),
    "op2_joined_documents": _over_documents(jaccard_join.joined_documents),
    "op3_mix_sources": _over_documents(mixing.mix_sources),
    "op4_score_texts": _over_documents(pitman_yor.score_texts),
    "op5_toxic_documents": _with_labels(toxicity.toxic_documents),
    "op6_graded_documents": _with_labels(ordinal_quality.graded_documents),
    "op7_token_store": _over_documents(token_store.token_digests),
    "op8_identified_documents": _over_documents(hyper_langid.identified_documents),
    "op9_scanned_documents": _over_documents(license_scan.scanned_documents),
    "op10_quality_verdicts": _with_labels(quality_rules.quality_verdicts),
}

ORACLE_SQL: dict[str, str] = {
    "op1_contaminated_documents": decontaminate.DECONTAMINATION_SQL,
    "op2_joined_documents": jaccard_join.NEAR_DUPLICATES_SQL,
    "op3_mix_sources": mixing.MIX_SQL,
    "op9_scanned_documents": license_scan.scan_sql(),
}
