"""One query per operator over the given tables, and SQL that must agree where SQL can say it."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from panelcast.llm import (
    bpe,
    decontam,
    fingerprints,
    jaccard,
    langid,
    packing,
    pii,
    prefix_trie,
    quality,
    ranked_search,
    sharding,
    sql_search,
    sql_text,
    token_counts,
    warc,
)
from panelcast.llm.common import table

SHARDS = 24


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents"), jaccard.Rule(words=4, num=85, den=100))


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def op3_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_through_edits(table(spark, sf_dir, "documents"))


def op4_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_edits(table(spark, sf_dir, "documents"))


def personal_data_field(spark: SparkSession) -> pii.Field:
    """The field fitted to the small labelled table. An Arrow table needs no Python workers to become rows."""
    texts, spans = zip(*pii.examples(), strict=True)
    found = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    spans = [[{"kind": kind, "start": start, "end": end} for kind, start, end in x] for x in spans]
    return pii.fit(spark.createDataFrame(pa.table({"text": pa.array(texts, pa.string()), "spans": pa.array(spans, found)})))


def op5_crf_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"), personal_data_field(spark))


def op6_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontam.report(found)


def op7_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"), sharding.tree(SHARDS))


def op10_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.learn_and_identify(table(spark, sf_dir, "documents"))


def op11_geometric_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_warc_derivatives": op2_warc_derivatives,
    "op3_edit_aware_counts": op3_edit_aware_counts,
    "op4_closed_syncmers": op4_closed_syncmers,
    "op5_crf_personal_data": op5_crf_personal_data,
    "op6_fm_decontamination": op6_fm_decontamination,
    "op7_kneser_ney_quality": op7_kneser_ney_quality,
    "op8_vector_packing": op8_vector_packing,
    "op9_hash_tree": op9_hash_tree,
    "op10_ppm_language": op10_ppm_language,
    "op11_geometric_blocks": op11_geometric_blocks,
    "op12_prefix_bpe": op12_prefix_bpe,
    "op13_prefix_trie": op13_prefix_trie,
}
SQL: dict[str, str] = {
    "op1_ngram_jaccard": sql_text.jaccard_groups(4, 85, 100),
    "op2_warc_derivatives": sql_text.warc_derivatives(),
    "op6_fm_decontamination": sql_text.contamination(13),
    "op9_hash_tree": sql_text.placement(3, 2, 4, 4096),
    "op11_geometric_blocks": sql_search.ranked(),
    "op13_prefix_trie": sql_search.prefix_trie(),
}
