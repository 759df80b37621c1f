"""The queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationkit.llm import (
    classlm,
    decontamination,
    divergence,
    forest,
    langid,
    licenses,
    mixing,
    quality,
    quotations,
    separators,
    superminhash,
    warc,
    whitening,
)
from stationkit.plans.shipping import ship


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables. Python workers are given this package."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_license_spans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_spans(table(spark, folder, "documents"))


def op2_line_field_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )


def op3_golden_ratio_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, folder, "documents")).drop("source")


def op4_class_bigrams(spark: SparkSession, folder: str) -> DataFrame:
    return classlm.log_probabilities(table(spark, folder, "documents"))


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op6_cross_parsing_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.languages(table(spark, folder, "documents"))


def op7_separator_scan(spark: SparkSession, folder: str) -> DataFrame:
    return separators.document_tokens(table(spark, folder, "documents"))


def op8_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    """The given messages quote nothing, so they are put into a quoting form first."""
    return quotations.reply_ordered(quotations.with_quotes(table(spark, folder, "conversations")))


def op9_projection_forest(spark: SparkSession, folder: str) -> DataFrame:
    return forest.near_vectors(table(spark, folder, "embeddings"))


def op10_superminhash(spark: SparkSession, folder: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, folder, "documents"), 3, 85)


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"))


def op12_transaction_assembly(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op13_qdwh_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline  # the pipeline itself takes its tables from this module

    table(spark, folder, "documents")
    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_spans": op1_license_spans,
    "op2_line_field_quality": op2_line_field_quality,
    "op3_golden_ratio_mix": op3_golden_ratio_mix,
    "op4_class_bigrams": op4_class_bigrams,
    "op5_decontaminate": op5_decontaminate,
    "op6_cross_parsing_language": op6_cross_parsing_language,
    "op7_separator_scan": op7_separator_scan,
    "op8_quotation_links": op8_quotation_links,
    "op9_projection_forest": op9_projection_forest,
    "op10_superminhash": op10_superminhash,
    "op11_source_divergence": op11_source_divergence,
    "op12_transaction_assembly": op12_transaction_assembly,
    "op13_qdwh_whitening": op13_qdwh_whitening,
    "pipeline": pipeline,
}

# Exact linked pairs by their shared shingles, then components by repeated spreading.
NEAR_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN
           list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i:i+2]))
         WHEN len(w) > 0 THEN [w] ELSE [] END AS s
  FROM worded),
items AS (SELECT doc_id, unnest(s) AS item, len(s) AS n FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM items x JOIN items y ON x.item = y.item AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reached AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT links.b, reached.root FROM reached JOIN links ON links.a = reached.node
  WHERE reached.root < links.b)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id,
       s.doc_id = r.component_id AS kept
FROM sets s JOIN (SELECT node, min(root) AS component_id FROM reached GROUP BY node) r
  ON r.node = s.doc_id"""

ORACLE: dict[str, str] = {
    "op3_golden_ratio_mix": mixing.SQL,
    "op8_quotation_links": quotations.SQL,
    "op9_projection_forest": forest.SQL,
    "op10_superminhash": NEAR_SQL,
    "op11_source_divergence": divergence.SQL,
    "op12_transaction_assembly": warc.SQL,
}
