"""Registered queries of the text operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from leaguelake.llm import (
    collocations, edit_counts, html_density, license_scan, line_dedup, packing, pii_pseudonyms, prefix_trie, quality_rules, simhash_dedup,
    template_decontamination, token_files, url_filter,
)
from leaguelake.llm.common import table


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = template_decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("key")


def op2_html_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.extract(table(spark, sf_dir, "pages"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_counts.cleaned_counts(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "text", "lines_dropped")


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_output(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_pseudonyms.pseudonymised(table(spark, sf_dir, "documents"), pii_pseudonyms.EXAMPLE_KEY)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_template_decontamination,
        op2_html_text_density,
        op3_simhash_near_dedup,
        op4_license_scan,
        op5_token_counts,
        op6_line_dedup,
        op7_token_output,
        op8_packing,
        op9_pii_pseudonyms,
        op10_quality_rules,
        op11_collocations,
        op12_url_filter,
        op13_prefix_trie,
    )
}
# the other operators have no SQL form: fingerprints, models, tokenizers, parsers, ciphers and tries are tested against brute force
SQL: dict[str, str] = {"op6_line_dedup": line_dedup.SQL, "op11_collocations": collocations.SQL, "op12_url_filter": url_filter.sql()}
