"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from stockyard.llm import exact_dedup, filter_audit, group_join, merkle, mixing, packing, personal_data, quality_rules, sharding, sql, substring_dedup, suffix_dedup, toxicity, url_filter
from stockyard.llm.common import table, tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, statement: str | None = None):
    def add(query: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = query
        if statement:
            SQL[name] = statement
        return query

    return add


@register("op1_personal_data")
def op1_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.personal_data(table(spark, folder, "documents"))


@register("op2_jaccard_join")
def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return group_join.jaccard_components(table(spark, folder, "documents"))


@register("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), tokenizer_path())


@register("op4_exact_dedup", sql.EXACT_DEDUP)
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


@register("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, folder, "documents"))


@register("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality(table(spark, folder, "documents"))


@register("op7_url_filter", sql.URL_FILTER)
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged(table(spark, folder, "pages"))


@register("op8_source_mixing")
def op8_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Sources drawn towards equal weights until the smallest would be seen four times."""
    return mixing.mixed(table(spark, folder, "documents"), most_epochs=4.0)


@register("op9_toxicity")
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register("op10_sharding")
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"))


@register("op11_merkle_manifest", sql.MERKLE)
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verified_documents(table(spark, folder, "documents"))


@register("op12_suffix_dedup")
def op12_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.without_repeated_strings(table(spark, folder, "documents"))


@register("op13_filter_audit", sql.FILTER_AUDIT)
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    # By the query's SQL, labels without an identifier are no document's.
    labels = table(spark, folder, "labels").filter("doc_id IS NOT NULL")
    return filter_audit.audit(table(spark, folder, "documents"), labels)


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
